"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders; what is left of a benchmark
item is cut into windows of ``WINDOW`` words, and so is every whole document.
Windows meet by hash.  Matches of one document and item on one alignment are then
checked for slot consistency: a number or name of the item must stand for one and
the same value of the document wherever it occurs.  So a question asked with
other numbers is found, and a chance match of placeholders is not.

Windows with too many placeholders say little by their template, and a document in
title case has none of an item's plain words.  So windows also meet by their exact
words, without placeholders and without a least number of literals.  An item of fewer
than ``WINDOW`` words is one such window of its own length; the lengths that occur, one
to seven, reach the driver.  One of fewer than ``LITERALS`` words ("yes") is found in any
text, so it is a leak only where it is all a document says.

Before the windows of the documents are spread into rows they pass a bitmap of
``2 ** 20`` bits of the benchmark's window hashes.  Its size is fixed; a larger
benchmark lets more windows through, never fewer.  Window hashes of the benchmark
reach the driver only in that bitmap.

Defined cases: null and empty texts match nothing; items of numbers alone match nothing;
items of fewer than ``WINDOW`` words, and windows with fewer than ``LITERALS`` plain
words, match by their exact words only; a document is a (doc_id, text), so
rows of null or of one doc_id are judged by their own text each; repeated rows are judged
alike; with an empty benchmark all documents are clean; further columns are
dropped by ``leak_report`` and carried along by ``without_leaks``.
"""

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind.llm.pii import let
from quirebind.llm.words import named, own_prefix

WINDOW = 8
LITERALS = 4
SHARE = 0.25
_BITS = 20
_NUMBER, _NAME, _UNIT = "#", "ⁿ", "ᵘ"

# --- fixed values: units of measure ---------------------------------------------
UNITS = [
    "cents", "centimeters", "cm", "days", "degrees", "dollars", "euros", "feet", "ft", "g",
    "grams", "hours", "inches", "kg", "kilograms", "kilometers", "km", "l", "lb", "liters", "m",
    "meters", "mg", "miles", "minutes", "ml", "mm", "months", "mph", "ounces", "percent",
    "pounds", "seconds", "weeks", "yards", "years",
]
# --- end of fixed values --------------------------------------------------------


def _marked(text: Column) -> Column:
    """Names and units marked, numbers in one word, other signs gone."""
    text = F.coalesce(text, F.lit(""))
    named = F.regexp_replace(text, r"(?<=[\p{Ll}\p{N},;]\x20)(?=\p{Lu}\p{Ll})", _NAME)
    digits = text.rlike(r"\p{N}")
    joined = F.regexp_replace(named, r"(?<=\p{N})[.,:](?=\p{N})", "_")
    units = F.regexp_replace(joined, rf"(?<=\p{{N}}\x20)(?=(?i:{'|'.join(UNITS)})\b)", _UNIT)
    return F.trim(F.regexp_replace(
        F.lower(F.when(digits, units).otherwise(named)), r"[^\p{L}\p{N}_]+", " "
    ))


def _template(marked: Column) -> Column:
    named = F.when(
        F.contains(marked, F.lit(_NAME)), F.regexp_replace(marked, rf"{_NAME}\S+", _NAME)
    ).otherwise(marked)
    return F.when(
        marked.rlike(r"\p{N}"),
        F.regexp_replace(
            F.regexp_replace(named, rf"{_UNIT}\S+", _UNIT), r"(?<!\S)\p{Nd}\S*", _NUMBER
        ),
    ).otherwise(named)


def _is_slot(word: Column) -> Column:
    return word.isin(_NUMBER, _NAME, _UNIT)


def _plain(marked: Column) -> Column:
    return F.translate(marked, _NAME + _UNIT, "")


def _forms(text: Column) -> Column:
    """The words of a text, cleaned once: as marked (raw), as template (form), as they are
    (plain); ``bare`` if template and words are the same."""
    return let(_marked(text), lambda m: let(
        F.struct(_template(m).alias("form"), _plain(m).alias("plain")), lambda s: F.struct(
            F.split(m, " ").alias("raw"), F.split(s["form"], " ").alias("form"),
            F.split(s["plain"], " ").alias("plain"), (s["form"] == s["plain"]).alias("bare"),
        )
    ))


def _hash(words: Column, at: Column, n: Column | int = WINDOW) -> Column:
    """Of ``WINDOW`` words one by one, which is the faster way; of fewer as a slice."""
    if isinstance(n, int) and n == WINDOW:
        return F.xxhash64(*[F.get(words, at + k) for k in range(n)])
    return F.xxhash64(F.slice(words, at + 1, n))


def _no_places() -> Column:
    return F.array().cast("array<int>")


def _places(words: Column, n: Column | int) -> Column:
    last = F.size(words) - n
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(_no_places())


def _held(hashes: Column, keep: Column) -> Column:
    return F.call_function("bit_get", F.get(keep, _word(hashes)), _bit(hashes)) == 1


def _templates(b: Column, places: Column) -> Column:
    """Array of (pos, hash, slots) of the windows at ``places`` with enough plain words.

    ``slots`` has the word behind each placeholder of the window, null for plain
    words."""
    rows = F.transform(places, lambda i: F.struct(
        i.alias("pos"), _hash(b["form"], i).alias("hash"),
        F.transform(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda k: F.when(
            _is_slot(F.get(b["form"], i + k)), F.get(b["raw"], i + k)
        )).alias("slots"),
    ))
    return F.filter(rows, lambda r: F.size(F.array_compact(r["slots"])) <= WINDOW - LITERALS)


def _exact(b: Column, places: Column, n: Column | int) -> Column:
    """Windows of ``n`` words as in ``_templates`` by exact words; no slots."""
    return F.transform(places, lambda i: F.struct(
        i.alias("pos"), _hash(b["plain"], i, n).alias("hash"),
        F.array().cast("array<string>").alias("slots"),
    ))


def _changed(b: Column) -> Column:
    """Places of the windows whose template has other words than the text, ascending.

    Each changed word adds the windows that hold it and not the one before."""
    at = F.filter(
        F.sequence(F.lit(0), F.size(b["form"]) - 1),
        lambda i: F.get(b["form"], i) != F.get(b["plain"], i),
    )
    near = lambda all_: F.transform(all_, lambda i, k: let(
        F.struct(
            F.greatest(i - (WINDOW - 1), F.get(all_, k - 1) + 1, F.lit(0)).alias("from"),
            F.least(i, F.size(b["form"]) - WINDOW).alias("to"),
        ),
        lambda r: F.when(r["from"] <= r["to"], F.sequence(r["from"], r["to"])).otherwise(_no_places()),
    ))
    return F.when(b["bare"], _no_places()).otherwise(F.flatten(let(at, near)))


def _windows(text: Column, keep: Column, lengths: list[int]) -> Column:
    """The windows of a document that pass ``keep``, the bitmap.

    A window whose template is its words is hashed once for both.  Of the ``lengths`` under
    ``LITERALS`` only a whole document is a window."""

    def of(b: Column) -> Column:
        def both(places: Column) -> Column:
            same = F.filter(places, lambda i: F.slice(b["form"], i + 1, WINDOW) == F.slice(
                b["plain"], i + 1, WINDOW))
            return F.concat(_templates(b, places), _exact(b, same, WINDOW))

        found = [
            let(F.filter(_places(b["form"], WINDOW), lambda i: _held(_hash(b["form"], i), keep)), both),
            _exact(b, F.filter(_changed(b), lambda i: _held(_hash(b["plain"], i), keep)), WINDOW),
        ]
        for n in lengths:
            at = _places(b["plain"], n)
            if n < LITERALS:
                at = F.when(F.size(b["plain"]) == n, at).otherwise(_no_places())
            found.append(_exact(b, F.filter(at, partial(_has, b, n, keep)), n))
        return F.concat(*found)

    return let(_forms(text), of)


def _has(b: Column, n: int, keep: Column, at: Column) -> Column:
    return _held(_hash(b["plain"], at, n), keep)


def _n_words(text: Column) -> Column:
    """Number of words of an item; 0 for one of numbers alone."""
    plain = _plain(_marked(text))
    return F.when(plain.rlike(r"(?<!\S)[^\s\p{Nd}]"), F.size(F.split(plain, " "))).otherwise(0)


def _lengths(benchmark: DataFrame) -> list[int]:
    """The lengths of items of fewer than ``WINDOW`` words."""
    short = benchmark.select(_n_words(F.col("text")).alias("n")).filter(
        (F.col("n") > 0) & (F.col("n") < WINDOW)
    ).distinct()
    return sorted(r.n for r in short.collect())


def _word(h: Column) -> Column:
    low = h.bitwiseAND(F.lit((1 << _BITS) - 1))
    return F.call_function("shiftright", low, F.lit(6)).cast("int")


def _bit(h: Column) -> Column:
    return h.bitwiseAND(F.lit(63)).cast("int")


def _bitmap(items: DataFrame) -> Column:
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("hash")))
    words = items.groupBy(_word(F.col("hash")).alias("word")).agg(F.bit_or(one).alias("bits"))
    known = {r[0]: r[1] for r in words.collect()}  # 2^14 rows at most
    listed = ",".join(str(known.get(i, 0)) for i in range(1 << (_BITS - 6)))
    return F.split(F.lit(listed), ",").cast("array<bigint>")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, n_windows (places), ipos, hash, islots.

    An item stands with its names as placeholders, for documents that write all in one
    case with its names as words, and by its exact words."""
    every = lambda b: _templates(b, _places(b["form"], WINDOW))
    exact = let(_n_words(F.col("text")), lambda n: let(
        _forms(F.col("text")), lambda b: F.when(
            n >= WINDOW, _exact(b, _places(b["plain"], WINDOW), WINDOW)
        ).when(n > 0, _exact(b, _places(b["plain"], n), n))
        .otherwise(F.array().cast("array<struct<pos:int,hash:bigint,slots:array<string>>>"))
    ))
    found = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        let(_forms(F.col("text")), every).alias("named"),
        let(_forms(F.lower("text")), every).alias("plain"),
        exact.alias("exact"),
    )
    return found.select(
        "item_id", F.greatest(F.size("named"), F.size("plain"), F.size("exact")).alias("n_windows"),
        F.inline(F.array_distinct(F.concat("named", "plain", "exact"))),
    ).withColumnsRenamed({"pos": "ipos", "slots": "islots"})


def _key(text: Column) -> Column:
    """16 bytes that tell texts apart; null for null."""
    return F.unhex(F.md5(text))


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, key (of the text), item_id, share of the item's windows found, and whether
    all slots have the item's own values; one row per document and leaked item."""
    items = item_windows(benchmark)
    bits = _bitmap(items)
    hits = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _key(F.col("text")).alias("key"), "text"
    ).select(
        "doc_id", "key", F.explode(_windows(F.col("text"), bits, _lengths(benchmark))).alias("w")
    ).select("doc_id", "key", "w.*")
    pairs = F.filter(
        F.arrays_zip("islots", "slots"), lambda p: p["islots"].isNotNull()
    )
    met = hits.join(items, "hash").select(
        "doc_id", "key", "item_id", "n_windows", "ipos", (F.col("pos") - F.col("ipos")).alias("shift"),
        (F.size("slots") == 0).alias("exact"),
        F.transform(pairs, lambda p: F.struct(p["islots"].alias("own"), p["slots"].alias("other")))
        .alias("pairs"),
    )
    # An alignment has at most the item's windows, so its sets are bounded by it.
    lined = met.groupBy("doc_id", "key", "item_id", "shift", "exact").agg(
        F.max("n_windows").alias("n_windows"), F.collect_set("ipos").alias("places"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    owners = F.size(F.array_distinct(F.transform("pairs", lambda p: p["own"])))
    sound = lined.filter(F.size("pairs") == owners)
    verbatim = F.forall("pairs", lambda p: p["own"] == p["other"])
    found = sound.groupBy("doc_id", "key", "item_id").agg(
        (F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.max("n_windows"))
        .alias("share"),
        F.bool_and(verbatim).alias("verbatim"),
    )
    return found.filter(F.col("share") >= share)


def leak_report(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids, share, verbatim."""
    per = leaks(docs, benchmark, share).groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.max("share").alias("share"), F.bool_or("verbatim").alias("verbatim"),
    )
    ids = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _key(F.col("text")).alias("key")
    )
    same = ids["doc_id"].eqNullSafe(per["doc_id"]) & (ids["key"] == per["key"])
    return ids.join(per, same, "left").select(
        ids["doc_id"], F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
        F.coalesce("verbatim", F.lit(False)).alias("verbatim"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents that leak no item, with their own columns."""
    p = own_prefix(docs.columns, "_d_")
    leaked = leaks(docs, benchmark, share).select(
        F.col("doc_id").alias(f"{p}leaked"), F.col("key").alias(f"{p}key")
    ).distinct()
    marked = docs.withColumn(f"{p}text", _key(F.col("text")))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col(f"{p}leaked"))
        & (F.col(f"{p}text") == F.col(f"{p}key"))
    )
    return marked.join(leaked, same, "left_anti").select(*named(docs.columns))
