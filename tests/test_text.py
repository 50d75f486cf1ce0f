"""Column rules on rows with hand-derived answers."""

import pytest
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names, text


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    out = rows.select("i", column(F.col("s")).alias("v")).orderBy("i").collect()
    return [r.v for r in out]


@pytest.mark.parametrize(
    "line, kind, title",
    [
        ("# Uno", "hash", "Uno"),
        ("####### x", "hash", "x"),
        ("#x", None, None),
        ("#", None, None),
        ("Sección 2", "chapter", "Capítulo 2"),
        ("sección mil", "chapter", "Capítulo mil"),
        ("capítulo iv - Fin", "chapter", "Capítulo iv: Fin"),
        ("CHAPTER 3: The End", "chapter", "Capítulo 3: The End"),
        ("ſeccion X", "chapter", "Capítulo X"),
        ("PARTE 1x", None, None),
        ("CHAPTER\x0b1", None, None),
        ("CAPıTULO 1", None, None),
        ("1. Áb", None, None),
        ("1. Ábc", "numbered", "Sección 1: Ábc"),
        ("1. abc", None, None),
        ("1. " + "A" * 61, "numbered", "Sección 1: " + "A" * 61),
        ("1. " + "A" * 62, None, None),
        ("# a b\rc", "hash", "a b\rc"),
    ],
)
def test_heading_forms(spark, line, kind, title):
    got = values(spark, lambda s: F.struct(text.heading_kind(s), text.heading_title(s)), [line])
    assert tuple(got[0]) == (kind, title)


def test_break_agrees_with_line_rule(spark):
    """Splitting a text at headings finds exactly the lines the line rule finds."""
    lines = [
        " # a", "　## b  ", "#", "#  ", "# x", "\tCHAPTER 1 ", "CHAPTER 1 x",
        "parte ii: x", "PARTE 1x", "1. Ábc ", "1. Áb ", "2.\tXyz", "2.\x0bXyz", " 1. " + "A" * 61 + " ",
        "1. " + "A" * 62, "seccion 1\r", "sección mil-", "capitulo:1", "chapter 12 -- x", "", "plain",
    ]
    body = "start\n" + "\n".join(lines)
    split = values(spark, lambda s: F.split(s, text.HEADING_BREAK, -1), [body])[0]
    titles = values(spark, lambda s: text.heading_title(text.trim_white(s)), lines)
    assert [p.split("\n")[0] for p in split[1:]] == [
        line for line, t in zip(lines, titles) if t is not None
    ]


def test_trim_takes_all_unicode_white_space(spark):
    inputs = [fixed.WHITE + "a b" + fixed.WHITE, "​x", "", fixed.WHITE, "x" + " " * 5000]
    trim = lambda s: text.trim_white_right(text.trim_white_left(s))
    expected = ["a b", "​x", "", "", "x"]
    assert values(spark, trim, inputs) == expected
    assert values(spark, text.trim_white, inputs) == expected


def test_filename_parts(spark):
    inputs = ["a.b.md", "x", ".txt", "dir.v1/x", "X.PDF"]
    assert values(spark, text.extension, inputs) == [".md", "", ".txt", "", ".PDF"]
    assert values(spark, text.stem, inputs) == ["a.b", "x", "", "dir.v1/x", "X"]


def test_numbers_in_names_widen(spark):
    rows = spark.range(1).select(
        *[names.unit_filename(F.lit(n)).alias(f"n{n}") for n in (1, 9, 10, 99, 100, 1234)]
    )
    assert list(rows.first()) == [
        "capitulo-01.md", "capitulo-09.md", "capitulo-10.md", "capitulo-99.md",
        "capitulo-100.md", "capitulo-1234.md",
    ]


def test_readable_ratio(spark):
    inputs = ["", "abc", "¿?", "aaaaaaa???", "aaaaaa????", "çççá"]
    assert values(spark, text.readable_ratio, inputs) == [0.0, 1.0, 0.0, 0.7, 0.6, 0.25]
    assert values(spark, text.is_readable, inputs) == [False, True, False, True, False, False]


def test_printable_only(spark):
    assert values(spark, text.printable_only, ["¿Qué\x07\ttal? ", "\x7fÀ\u0085b\r"]) == [
        "Qué\ttal?", "Àb",
    ]


MARKUP = (
    "<w:document><w:t>stray</w:t><w:body>"
    "<w:p><w:r><w:t>one </w:t></w:r><w:r><w:t xml:space='preserve'>two &amp; &#233;&#x41;&#38;lt;</w:t>"
    "</w:r><w:t/></w:p><w:p/><w:pPr/><p><!-- <w:t>no</w:t> --><t>th&lt;ree&gt;</t></p>"
    "</w:body></w:document>"
)


def test_markup_paragraphs(spark):
    assert values(spark, text.markup_text, [MARKUP]) == [
        "stray\n\none two & éA&lt;\n\n\n\nth<ree>"
    ]


def test_prepared_text_by_format(spark):
    rows = spark.createDataFrame(
        [("a.txt", "x"), ("a.md", " \n#tag"), ("b.docx", "<p/>"), ("c.pdf", "¿¿¿¿\n"),
         ("c.PDF", " ok line \n¿¿¿\nmore"), (".txt", "y"), ("p.html", "<p>x</p>")],
        "f string, s string",
    ).select(text.prepared_text(F.col("s"), F.col("f")).alias("t"))
    assert [r.t for r in rows.collect()] == [
        "# a\n\nx", " \n#tag", f"# b\n\n{fixed.EMPTY_MARKUP}", f"# c\n\n{fixed.EMPTY_SCAN}",
        "ok line\n\nmore", "# \n\ny", "# p\n\n<p>x</p>",
    ]


def test_canonical_ids(spark):
    plain = "0a1b2c3d-0000-4000-8000-00000000000f"
    good = [plain, plain.upper(), "urn:uuid:" + plain, "{" + plain + "}", plain.replace("-", "")]
    assert values(spark, names.canonical_id, good) == [plain] * 5
    assert values(spark, names.canonical_id, ["", "job-1", plain + "0"]) == [None] * 3


def test_log_row(spark):
    row = spark.range(1).select(
        names.log_row(
            F.lit("2024-01-02 03:04:05").cast("timestamp"), F.lit("A"), F.lit("INFO"), F.lit("m|n")
        )
    )
    assert row.first()[0] == "| 03:04:05 | A | INFO | m|n |"
