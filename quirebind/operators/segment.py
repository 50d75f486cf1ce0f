"""Splitting documents into titled units.

A document is one row and stays one row until its units exist: pieces, titles
and chunks are arrays of that row, so no text crosses a shuffle and a long
document costs its own task only.  The steps are separate projections on
purpose.  An array that a lambda walks must be a stored column or the lambda's
argument; inlined into a lambda body it would be rebuilt per element.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names, text
from quirebind.functions.built import built_once

# Paragraphs per inner fold of the chunking.
_BLOCK = 512
_BODY, _PIECES, _CHUNKS, _STEM = "_qb_body", "_qb_pieces", "_qb_chunks", "_qb_stem"


def _split_heads(pieces: Column) -> Column:
    """array<piece> -> array<struct(piece, head, title, next)>"""
    heads = F.transform(
        pieces, lambda p: F.struct(p.alias("piece"), text.first_line(p).alias("head"))
    )
    rest = lambda s: F.substr(s["piece"], F.char_length(s["head"]) + 2)
    return F.transform(
        heads,
        lambda s: F.struct(
            s["piece"],
            s["head"],
            text.heading_title(text.trim_white(s["head"])).alias("title"),
            text.first_line(rest(s)).alias("next"),
        ),
    )


def _absorbs(title: Column, line: Column, title_bytes: int) -> Column:
    """Does the line under a heading become its subtitle?  The line is known
    not to be a heading: one would have started a piece of its own."""
    t = text.trim_white(line)
    return title.isNotNull() & F.octet_length(t).between(1, title_bytes - 1) & ~t.endswith(".")


def _heading_units(pieces: Column, title_bytes: int) -> Column:
    """array<piece> -> array<struct(heading, subtitle, title, content)>"""

    def unit(s: Column) -> Column:
        absorbed = _absorbs(s["title"], s["next"], title_bytes)
        subtitle = F.when(absorbed, text.trim_white(s["next"]))
        below = F.char_length(s["head"]) + 1 + F.char_length(s["next"]) + 1
        return F.struct(
            s["title"].alias("heading"),
            subtitle.alias("subtitle"),
            F.when(s["title"].isNull(), names.untitled(F.lit(1)))
            .when(absorbed, F.concat(s["title"], F.lit(" - "), subtitle))
            .otherwise(s["title"])
            .alias("title"),
            F.when(absorbed, F.concat(s["head"], F.substr(s["piece"], below)))
            .otherwise(s["piece"])
            .alias("content"),
        )

    return F.transform(_split_heads(pieces), unit)


def _chunk_ends(sizes: Column, chunk_bytes: int) -> Column:
    """Positions (from 1) of the last paragraph of each greedy chunk.

    Spark copies the state of ``aggregate`` at every step, so the state must
    stay small: it holds numbers only, and an inner fold over a block of
    paragraphs collects the ends of that block before the outer one adds them.
    """
    none = F.expr("cast(array() as array<int>)")
    count = F.size(sizes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
        lambda i: F.slice(sizes, i * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def state(size: Column, at: Column, ends: Column) -> Column:
        return F.struct(
            size.cast("bigint").alias("size"), at.cast("int").alias("at"), ends.alias("ends")
        )

    def paragraph(s: Column, x: Column) -> Column:
        full = s["size"] + x >= chunk_bytes
        return state(
            F.when(full, 0).otherwise(s["size"] + x),
            s["at"] + 1,
            F.when(full, F.concat(s["ends"], F.array(s["at"] + 1))).otherwise(s["ends"]),
        )

    def block(a: Column, xs: Column) -> Column:
        return F.aggregate(
            xs, state(a["size"], a["at"], none), paragraph,
            lambda s: state(s["size"], s["at"], F.concat(a["ends"], s["ends"])),
        )

    def finish(a: Column) -> Column:
        rest = F.when(a["size"] > 0, F.array(a["at"])).otherwise(none)
        return F.concat(a["ends"], rest)

    zero = state(F.lit(0), F.lit(0), none)
    return F.when(count > 0, F.aggregate(blocks, zero, block, finish)).otherwise(none)


def _fold_chunks(body: Column, title_bytes: int, chunk_bytes: int) -> Column:
    """Greedy chunks of a text: array<struct(title, body)>, '' for no title."""
    paragraphs = F.filter(
        F.transform(F.split(body, "\n\n", -1), text.trim_white), lambda p: p != ""
    )

    def candidate(p: Column) -> Column:
        line = text.first_line(p)
        short = F.octet_length(line) < title_bytes
        return F.when(short, F.regexp_replace(line, "^# ", "")).otherwise("")

    def chunk(ps: Column) -> Column:
        titles = F.filter(F.transform(ps, candidate), lambda t: t != "")
        return F.struct(
            F.coalesce(F.get(titles, F.lit(0)), F.lit("")).alias("title"),
            F.array_join(ps, "\n\n").alias("body"),
        )

    def chunks(ps: Column) -> Column:
        def cut(ends: Column) -> Column:
            start = lambda i: F.coalesce(F.get(ends, i - 1), F.lit(0))
            pieces = F.transform(ends, lambda e, i: F.slice(ps, start(i) + 1, e - start(i)))
            return F.transform(pieces, chunk)

        sizes = F.transform(ps, F.octet_length)
        return text.bind(text.bind(sizes, lambda x: _chunk_ends(x, chunk_bytes)), cut)

    return text.bind(paragraphs, chunks)


def _chunk_units(chunks: Column) -> Column:
    """Chunks to array<struct(title, content)>."""
    titled = F.transform(
        chunks,
        lambda c, i: F.struct(
            F.when(c["title"] == "", names.untitled(i + 1)).otherwise(c["title"]).alias("title"),
            c["body"],
        ),
    )
    return F.transform(
        titled,
        lambda c: F.struct(
            c["title"],
            F.concat(F.lit("# "), c["title"], F.lit("\n\n"), c["body"]).alias("content"),
        ),
    )


def _numbered(units: Column) -> Column:
    return F.transform(
        units,
        lambda u, i: F.struct(
            (i + 1).alias("unit_no"),
            names.unit_filename(i + 1).alias("filename"),
            u["title"].alias("title"),
            u["content"].alias("content"),
        ),
    )


@built_once
def _unit_columns(
    text_col: str, filename_col: str, title_bytes: int, long_bytes: int, chunk_bytes: int
) -> dict[str, Column]:
    filename = F.col(filename_col)
    one_piece = F.size(_PIECES) == 1
    by_heading, by_size = ~one_piece, F.size(_CHUNKS) > 1
    single = F.array(
        F.struct(
            F.lit(1).alias("unit_no"),
            F.lit(fixed.SINGLE_FILE).alias("filename"),
            F.when(F.col(_STEM) == "", fixed.SINGLE_TITLE).otherwise(F.col(_STEM)).alias("title"),
            F.col(_BODY).alias("content"),
        )
    )
    return {
        "left": text.trim_white_left(text.prepared_text(F.col(text_col), filename)),
        "stem": text.stem(filename),
        "both": text.trim_white_right(F.col(_BODY)),
        "pieces": F.split(F.col(_BODY), text.HEADING_BREAK, -1),
        "chunks": F.when(
            one_piece & (F.octet_length(_BODY) > long_bytes),
            _fold_chunks(F.col(_BODY), title_bytes, chunk_bytes),
        ),
        "route": F.when(F.col(_BODY).isNull(), F.lit(None).cast("string"))
        .when(by_heading, "headings").when(by_size, "chunks").otherwise("single"),
        "units": F.when(by_heading, _numbered(_heading_units(F.col(_PIECES), title_bytes)))
        .when(by_size, _numbered(_chunk_units(F.col(_CHUNKS))))
        .when(F.col(_BODY).isNotNull(), single),
    }


def with_units(
    docs: DataFrame,
    text_col: str = "text",
    filename_col: str = "filename",
    title_bytes: int = fixed.TITLE_BYTES,
    long_bytes: int = fixed.LONG_DOCUMENT_BYTES,
    chunk_bytes: int = fixed.CHUNK_BYTES,
) -> DataFrame:
    """Replace the text by ``route`` and ``units``.

    Headings if they give more than one unit ('headings'); else, for long
    texts, greedy chunks if they give more than one ('chunks'); else the whole
    text ('single').  A null text gives null units.
    """
    made = _unit_columns(text_col, filename_col, title_bytes, long_bytes, chunk_bytes)
    body = (
        docs.withColumn(_BODY, made["left"])
        .withColumn(_STEM, made["stem"])
        .drop(text_col)
        .withColumn(_BODY, made["both"])
    )
    chunks = body.withColumn(_PIECES, made["pieces"]).withColumn(_CHUNKS, made["chunks"])
    return (
        chunks.withColumn("route", made["route"])
        .withColumn("units", made["units"])
        .drop(_BODY, _STEM, _PIECES, _CHUNKS)
    )


def explode_units(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per unit of ``with_units`` output.

    The outer generator, because the plain one makes Catalyst add a filter on
    the array's size, push it to the scan and so build every array twice.
    """
    return docs.select(*keep, F.inline_outer("units")).filter("unit_no is not null")


def segment_documents(docs: DataFrame, key: str = "doc_id", **limits) -> DataFrame:
    """Units of every document: key, route, unit_no, filename, title, content."""
    return explode_units(with_units(docs.select(key, "filename", "text"), **limits), key, "route")


def segment_headings(
    docs: DataFrame, key: str = "doc_id", title_bytes: int = fixed.TITLE_BYTES
) -> DataFrame:
    """Heading units alone, whatever their number; ``text`` is split as given
    after trimming.  Lines above the first heading form a unit of their own."""
    trimmed = docs.select(key, text.trim_white_left(F.col("text")).alias(_BODY)).withColumn(
        _BODY, text.trim_white_right(F.col(_BODY))
    )
    pieces = trimmed.select(key, F.split(_BODY, text.HEADING_BREAK, -1).alias(_PIECES))
    units = pieces.select(
        key,
        F.when(
            F.element_at(_PIECES, 1) != "", _heading_units(F.col(_PIECES), title_bytes)
        ).alias("units"),
    )
    return units.select(key, F.posexplode_outer("units").alias("pos", "u")).filter(
        "pos is not null"
    ).select(
        key, (F.col("pos") + 1).alias("unit_no"), "u.heading", "u.subtitle", "u.title", "u.content"
    )


def subtitle_lookahead(
    docs: DataFrame, key: str = "doc_id", title_bytes: int = fixed.TITLE_BYTES
) -> DataFrame:
    """Every heading with the subtitle it takes from the line below, if any."""
    return segment_headings(docs, key, title_bytes).filter("heading is not null").select(
        key, "unit_no", "heading", "subtitle", "title"
    )


def segment_long(
    docs: DataFrame,
    key: str = "doc_id",
    title_bytes: int = fixed.TITLE_BYTES,
    chunk_bytes: int = fixed.CHUNK_BYTES,
) -> DataFrame:
    """Greedy chunks alone, whatever the length of the text."""
    chunks = docs.select(
        key, _fold_chunks(F.col("text"), title_bytes, chunk_bytes).alias(_CHUNKS)
    )
    units = chunks.select(key, _numbered(_chunk_units(F.col(_CHUNKS))).alias("units"))
    return explode_units(units, key)


def unit_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Units per document, read off the row."""
    return with_units(docs.select(key, "filename", "text")).select(
        key, "route", F.size("units").alias("units_count")
    )


def unit_sizes(units: DataFrame, key: str = "doc_id") -> DataFrame:
    """Bytes of every unit's content."""
    return units.select(
        key, "unit_no", "filename", F.octet_length("content").alias("content_bytes")
    )
