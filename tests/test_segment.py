"""Segmentation: edge rows, properties, and DuckDB on random documents."""

import random

import duckdb
import pytest

from quirebind.operators import segment
from quirebind.workload import oracle


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, filename string, text string")


def units(spark, filename, text):
    found = segment.segment_documents(docs(spark, [("d", filename, text)]))
    return found.orderBy("unit_no").collect()


def test_short_text_is_one_unit(spark):
    (u,) = units(spark, "simple.txt", "Una frase corta.")
    assert (u.route, u.filename, u.title) == ("single", "documento.md", "simple")
    assert u.content == "# simple\n\nUna frase corta."


def test_chapters_with_subtitles(spark):
    text = (
        "The Book\nA Subtitle\n\nCHAPTER 1\nThe Beginning\nIt began.\n\n"
        "CHAPTER 2\nThe Middle\nIt went on.\n\nCHAPTER 3\nThe End\nIt ended.\n"
    )
    found = units(spark, "book.txt", text)
    assert [u.title for u in found] == [
        "book", "Capítulo 1 - The Beginning", "Capítulo 2 - The Middle", "Capítulo 3 - The End",
    ]
    assert found[1].content == "CHAPTER 1\nIt began.\n"


def test_long_text_is_chunked(spark):
    text = "\n\n".join(f"Párrafo {i}. " + "palabra " * 20 for i in range(30))
    found = units(spark, "long.txt", text)
    assert len(found) > 1 and {u.route for u in found} == {"chunks"}
    assert found[0].content.startswith("# long\n\n# long\n\nPárrafo 0.")


@pytest.mark.parametrize("size, absorbed", [(59, True), (60, False)])
def test_subtitle_limit_is_in_bytes(spark, size, absorbed):
    line = "é" * (size // 2) + "x" * (size % 2)
    found = units(spark, "a.md", f"# A\n{line}\ntext.\n# B")
    assert (found[0].title == f"A - {line}") is absorbed
    assert (line in found[0].content) is not absorbed


def test_subtitle_must_not_end_in_a_stop_or_be_a_heading(spark):
    found = units(spark, "a.md", "# A\nA sentence.\n# B\n# C\n\ntext")
    assert [u.title for u in found] == ["A", "B", "C"]


@pytest.mark.parametrize("size, count", [(1500, 1), (1501, 2)])
def test_long_limit_is_in_bytes(spark, size, count):
    # Two paragraphs; a small chunk limit makes them two chunks.
    body = "#t\n\n" + "é" * 700
    text = body + "x" * (size - len(body.encode()))
    found = segment.segment_documents(docs(spark, [("d", "a.md", text)]), chunk_bytes=2)
    assert found.count() == count


@pytest.mark.parametrize("size, chunks", [(1799, 1), (1800, 2)])
def test_chunk_limit(spark, size, chunks):
    text = "é" * 800 + "\n\n" + "x" * (size - 1600) + "\n\ntail"
    found = segment.segment_long(docs(spark, [("d", "a.md", text)]))
    assert found.count() == chunks


def test_chunk_title_skips_empty_and_long_lines(spark):
    long = "w" * 60
    text = f"{long}\n\n# \nx\n\n# Título\ncuerpo\n\n" + "y" * 1800 + f"\n\n{long}"
    found = segment.segment_long(docs(spark, [("d", "a.md", text)])).orderBy("unit_no").collect()
    assert [u.title for u in found] == ["Título", "Capítulo 02"]


def test_false_heading_keeps_an_unnamed_preamble(spark):
    found = units(spark, "a.txt", " \n#tag\nx\n# Fin \ny.")
    assert [u.title for u in found] == ["Capítulo 01", "Fin"]
    assert found[0].content == "#tag\nx"


def test_empty_stem(spark):
    (u,) = units(spark, ".txt", "  ")
    assert (u.title, u.content) == ("Documento Principal", "#")


def test_many_units_widen_names(spark):
    found = units(spark, "a.md", "\n".join(f"# H{i}\n\nx" for i in range(120)))
    assert [found[i].filename for i in (8, 98, 99)] == [
        "capitulo-09.md", "capitulo-99.md", "capitulo-100.md",
    ]


def test_three_newlines_and_white_paragraphs(spark):
    found = segment.segment_long(docs(spark, [("d", "a.md", "a\n\n\nb\n\n \t\n\nc")])).collect()
    assert [u.content for u in found] == ["# a\n\na\n\nb\n\nc"]


WORDS = ["alpha", "béta", "γ", "x.", "a longer piece of text without any stop in it", "¿qué?"]
LINES = [
    "# Uno", "##  Dos  ", " # Tres", "#tag", "# ", "CHAPTER 1", "chapter iv: Sub", "Sección mil",
    "PARTE 1x", "1. Ábc", "1. Áb", "12. Title here", "", "", " ", "\t", "　", "tail\r",
    "capítulo 2 ", "w" * 59, "w" * 60, "é" * 30, "p " * 300, "see [g](g.md)", "# See [g](g.md)",
]


def random_docs(n, seed):
    rng = random.Random(seed)

    def line():
        if rng.random() < 0.6:
            return rng.choice(LINES)
        return " ".join(rng.choices(WORDS, k=rng.randint(1, 40)))

    names = ["a.txt", "b.md", "c.MD", ".txt", "d.html", "e", "f.g.markdown", "h.docx", "i.pdf"]
    return [
        (f"d{i}", rng.choice(names),
         rng.choice(["\n", "\n\n", "\n \n"]).join(line() for _ in range(rng.randint(1, 60))))
        for i in range(n)
    ]


def duck(rows, select, needs, opened):
    con = duckdb.connect()
    con.execute("CREATE TABLE given (doc_id VARCHAR, filename VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?, ?, ?)", rows)
    sql = oracle.build(select, needs, {
        **opened, "fx_docs": ([], "SELECT * FROM given"),
        "src": (["fx_docs"], "SELECT * FROM fx_docs"),
    })
    return sorted(map(repr, con.execute(sql).fetchall()))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_documents_match_duckdb(spark, seed):
    rows = random_docs(150, seed)
    columns = "doc_id, route, unit_no, filename, title, content"
    ours = segment.segment_documents(docs(spark, rows)).selectExpr(*columns.split(", "))
    assert sorted(repr(tuple(r)) for r in ours.collect()) == duck(
        rows, f"SELECT {columns} FROM units", ["units"], oracle.PREPARED
    )


def test_heading_units_keep_every_other_line(spark):
    """All lines of a text are in its units but the absorbed subtitles."""
    rows = random_docs(80, 3)
    found = segment.segment_headings(docs(spark, rows)).collect()
    by_doc = {}
    for u in sorted(found, key=lambda u: u.unit_no):
        by_doc.setdefault(u.doc_id, []).append(u)
    for doc_id, _, text in rows:
        kept = "\n".join(u.content for u in by_doc.get(doc_id, [])).split("\n")
        lost = sum(u.subtitle is not None for u in by_doc.get(doc_id, []))
        trimmed = duckdb.execute(f"SELECT {oracle.trim('?')}", [text]).fetchone()[0]
        assert len(kept) + lost == len(trimmed.split("\n"))


def test_chunks_hold_every_paragraph_and_are_full(spark):
    rows = [r for r in random_docs(60, 4)]
    found = segment.segment_long(docs(spark, rows), chunk_bytes=300).collect()
    last = {}
    for u in found:
        last[u.doc_id] = max(u.unit_no, last.get(u.doc_id, 0))
    for u in found:
        paragraphs = u.content.split("\n\n", 1)[1]
        size = sum(len(p.encode()) for p in paragraphs.split("\n\n"))
        assert u.unit_no == last[u.doc_id] or size + 1 >= 300


def test_chunks_across_fold_blocks_match_duckdb(spark):
    """More paragraphs than one inner fold takes."""
    rows = [("d", "a.txt", "\n\n".join(f"p{i} " + "x" * (i * 37 % 90) for i in range(1700)))]
    ours = segment.segment_long(docs(spark, rows)).select("doc_id", "unit_no", "title", "content")
    assert sorted(repr(tuple(r)) for r in ours.collect()) == duck(
        rows, "SELECT doc_id, unit_no, title, content FROM l_units", ["l_units"], oracle.LONG
    )
