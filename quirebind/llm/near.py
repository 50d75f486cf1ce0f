"""Near-duplicates by an inverted join of signature coordinates.

1. Every document gets a MinHash signature of ``COORDINATES`` values and a digest
   of its whole set of shingles.  Equal sets are one representative from here on.
2. Representatives are posted under each (coordinate, value).  A pair is of
   interest if it agrees on at least ``matches(percent)`` coordinates, so values that
   only one has are dropped, and so is who has fewer shared ones than that.  Such
   pairs also meet within the ``shared - matches + 1`` rarest postings of each: only
   this prefix is kept.  Postings that meet make clusters.
3. Inside a cluster, sets that differ too much in size cannot be linked: members
   meet those of their own and the next size class.  Large groups are cut into
   blocks, and blocks meet in pairs, so a task holds two blocks at most.  There, the
   postings of a member's prefix are merged and members it is joined with already are
   skipped; what is left has its collisions counted, and pairs above the threshold
   are confirmed on full sets.  A task returns a spanning forest of its links.
4. Components of the links are found by stars, and copies join their representative.

Texts are read again for the representatives in clusters, and for the rows of which some
go.  A bitmap of 2 ** 23 bits, the same at every size, holds what is asked for: rows that
are not in it stay where they are, and only the rest meets by key.

A set's number is dealt out when sets are stored, so texts of one doc_id, and those of
none, are sets of their own.  The row that stays of a component is that of the least
doc_id (null after all others) and, within it, the least hash of the text.

A link of similarity ``s`` agrees on a coordinate with probability ``s``.  The
agreements asked for follow from the threshold, so that at most ``MISSED`` of the links
right at it have fewer: 41 of 64 at 0.85 (8.8 of a million links have fewer), 36 at
0.80 (4.2 of a million).

Defined cases: a null text, and one without words, has an empty set and is its own
component; with fewer than five words the whole row of words is the one shingle;
repeated rows are links to each other, and the component is the least doc_id; rows of
null doc_id link like others, and a component that has no other doc_id is null.
``near_report`` speaks of ids: ``kept`` holds for every row with the component's id, so
for all of its repetitions.  ``one_of_each`` decides by (doc_id, hash of the text) and
leaves one row of a component, of repeated rows too; rows of an empty set all stay.
An empty table gives an empty result; further columns are dropped by ``near_report`` and
carried along by ``one_of_each``.
"""

import hashlib
import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind.llm.graph import components
from quirebind.llm.ngram_join import BITS, bitmap
from quirebind.llm.words import id_and_text, lower_words, map_rows, named, own_prefix
from quirebind.session import settle, small_batches

SHINGLE = 5
PERCENT = 85
COORDINATES, MISSED = 64, 1e-5
BLOCK_DOCS, BLOCK_SHINGLES = 1500, 1_500_000
_WORDS: dict[str, int] = {}
_REMEMBERED = 200_000

_rng = np.random.default_rng(20240601)
_TIMES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_A = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


def matches(percent: int) -> int:
    """The most coordinates that all but ``MISSED`` of the links at the threshold share."""
    share, below = percent / 100, 0.0
    for k in range(COORDINATES + 1):
        below += math.comb(COORDINATES, k) * share**k * (1 - share) ** (COORDINATES - k)
        if below > MISSED:
            break
    if k == 0:
        raise ValueError(f"{COORDINATES} coordinates are too few for links at {percent} percent")
    return k


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as 64-bit hashes, ascending."""
    words = lower_words(text)
    if not words:
        return np.array([], np.uint64)
    known = list(map(_WORDS.get, words))
    if None in known:
        if len(_WORDS) > _REMEMBERED:
            _WORDS.clear()
        for i, h in enumerate(known):
            if h is None:
                w = words[i]
                known[i] = _WORDS[w] if w in _WORDS else _WORDS.setdefault(w, word_hash(w))
    h = np.array(known, np.uint64)
    n = max(1, len(h) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        if len(h) < SHINGLE:  # of another length, so of another sum
            mixed = np.array([np.sum(h * _TIMES[: len(h)]) + np.uint64(len(h))], np.uint64)
        else:
            mixed = np.zeros(n, np.uint64)
            for k in range(SHINGLE):
                mixed += h[k : k + n] * _TIMES[k]
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(own: np.ndarray) -> np.ndarray:
    """The least value of every coordinate's permutation, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(own), 4096):
            mixed = own[at : at + 4096, None] * _A + _B
            least = np.minimum(least, mixed.min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _key(text: Column) -> Column:
    """16 bytes that tell texts apart; null for null."""
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("key", _key(F.col("text")))


def _place(doc: Column, key: Column) -> Column:
    return F.xxhash64(doc.cast("bigint"), key)


def _among(rows: DataFrame) -> Callable[[Column], Column]:
    """A test of ``_place`` values: true for those in ``rows`` (id), false for most others."""
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(rows))

    @F.pandas_udf("boolean")
    def test(place: pd.Series) -> pd.Series:
        at = place.to_numpy() & BITS - 1
        return pd.Series(bits.value[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1) == 1)

    return test


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n_shingles, digest (of the whole set), coordinates
    (four bytes each; none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            doc, texts, key = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
            for i, text in enumerate(texts):
                own = shingles(text.as_py())
                yield {
                    "doc_id": doc[i], "key": key[i], "n_shingles": len(own), "digest": _digest(own),
                    "coordinates": signature(own).tobytes() if len(own) else b"",
                }

    return map_rows(
        _keyed(docs), run,
        "doc_id bigint, key binary, n_shingles bigint, digest binary, coordinates binary",
        rows=1000,
    )


def _clusters(reps: DataFrame, least: int) -> DataFrame:
    """(id, component) of representatives whose prefixes meet in a posting."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda k: F.xxhash64(
        k, F.substr(F.col("coordinates"), 4 * k + 1, F.lit(4))
    ))
    posted = reps.select("rep", F.explode(tokens).alias("token"))
    # Only the counts of values are wanted first: one row per value and partition.
    shared = posted.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    own = posted.join(shared, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own")  # 64 at most
    ).filter(F.size("own") >= least)
    prefix = settle(own.select(
        "rep", F.explode(F.slice("own", F.lit(1), F.size("own") - (least - 1))).alias("p")
    ).select("rep", F.col("p.token").alias("token")))
    first = prefix.groupBy("token").agg(F.min("rep").alias("b"), F.count("*").alias("n"))
    edges = prefix.join(first.filter("n > 1"), "token").select(F.col("rep").alias("a"), "b")
    return components(edges)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, cluster, n, hashes (bytes) of the representatives in ``wanted``
    (id, head, cluster), read again from the row ``head``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            rep, cluster = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(batch.column(2)):
                own = shingles(text.as_py())
                yield {"id": rep[i], "cluster": cluster[i], "n": len(own), "hashes": own.tobytes()}

    heads = wanted.select("id", "cluster", "head.doc", F.col("head.key").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("text_key"))
    asked = _among(heads.select(_place(F.col("doc"), F.col("text_key")).alias("id")))
    rows = _keyed(docs).filter(asked(_place(F.col("doc_id"), F.col("key"))))
    # Rows move by key, few as they are: the test and the shingles, each in Python, then
    # run in tasks of their own, and a core has one worker.
    texts = rows.join(heads.hint("merge"), same).select("id", "cluster", "text")
    # Repeated rows are one set.
    return map_rows(
        texts, run, "id bigint, cluster bigint, n bigint, hashes binary", rows=256
    ).dropDuplicates(["id"])


def _postings(signs: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The postings one after the other, where each ends, and each member's prefix.

    A posting has the members, ascending, that hold its (coordinate, value) in their prefix:
    their ``prefix`` rarest ones, in one order for all."""
    numbers, offset = np.empty(signs.shape, np.int64), 0
    for k in range(COORDINATES):
        values, numbers[:, k] = np.unique(signs[:, k], return_inverse=True)
        numbers[:, k] += offset
        offset += len(values)
    held = np.bincount(numbers.ravel(), minlength=offset)
    rank = np.empty(offset, np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(offset)
    first = np.sort(rank[numbers], axis=1)[:, :prefix]
    order = np.argsort(first, axis=None, kind="stable")
    ends = np.cumsum(np.bincount(first.ravel(), minlength=offset))
    return order // prefix, ends, first


def _forest(ids, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the given sets, as many as join what is linked.

    Coordinates are posted rare ones first.  A pair that agrees on enough of them meets
    in a posting of both prefixes; there, members that are joined with the one at hand
    are skipped.  Pairs with enough equal coordinates are confirmed by the size of their
    intersection, counted for one member against all others at a time.
    """
    m, least = len(ids), matches(percent)
    root = np.arange(m)
    size = np.array([len(s) for s in sets], np.int64)
    signs = np.stack([signature(s) for s in sets])
    listed, until, first = _postings(signs, COORDINATES - least + 1)
    since = np.concatenate(([0], until[:-1]))
    flat = np.concatenate(sets)
    values, place = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(place, kind="stable")
    posted, ends = owner[order], np.cumsum(np.bincount(place, minlength=len(values)))
    starts = np.concatenate(([0], ends[:-1]))
    begin = np.concatenate(([0], np.cumsum(size)))
    links: list[tuple[int, int]] = []
    for i in range(m):
        met = np.concatenate([listed[since[t] : until[t]] for t in first[i]])
        met = met[(met > i) & (root[met] != root[i])]
        met = np.flatnonzero(np.bincount(met, minlength=m))
        met = met[(signs[met] == signs[i]).sum(axis=1) >= least]
        if not len(met):
            continue
        maybe = np.zeros(m, bool)
        maybe[met] = True
        mine = place[begin[i] : begin[i + 1]]
        both = np.bincount(
            np.concatenate([posted[starts[p] : ends[p]] for p in mine]), minlength=m
        )
        union = size + size[i] - both
        for j in np.flatnonzero(maybe & (100 * both >= percent * union)):
            if root[i] != root[j]:
                links.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return links


def _links(members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) inside clusters: (id, cluster, n, hashes)."""
    classes = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    # A member stands in its own class and in the next: partners are one class away
    # at most.
    spread = members.withColumn("own", classes).withColumn(
        "class", F.explode(F.array(F.col("own"), F.col("own") + 1))
    )
    sizes = spread.groupBy("cluster", "class").agg(
        F.count("*").alias("docs"), F.sum("n").alias("shingles"),
        F.max(F.when(F.col("own") == F.col("class"), 1).otherwise(0)).alias("met"),
    ).filter("docs > 1 and met = 1").select(
        "cluster", "class",
        F.greatest(
            F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks"),
    )
    block = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("block")).alias("left"), F.greatest(o, F.col("block")).alias("right")
    ))
    dealt = spread.join(sizes, ["cluster", "class"]).withColumn("block", block).select(
        "cluster", "class", "id", "hashes", F.inline(others)
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["id"].tolist()
        sets = [np.frombuffer(b, np.uint64) for b in group["hashes"]]
        return pd.DataFrame(_forest(ids, sets, percent), columns=["a", "b"], dtype="int64")

    return dealt.groupBy("cluster", "class", "left", "right").applyInPandas(
        run, "a bigint, b bigint"
    )


def _component_of(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, key, n_shingles of every row, and of its component ``head``, the row
    (nameless, doc, key) that stands for it; null for an empty set."""
    with small_batches(docs.sparkSession):
        known = settle(sketches(docs))
    row = F.struct(
        F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("doc"), "key"
    )
    reps = settle(known.filter("n_shingles > 0").groupBy("digest").agg(
        F.min(row).alias("head"), F.any_value("coordinates").alias("coordinates")
    ).withColumn("rep", F.monotonically_increasing_id()))
    found = _clusters(reps.select("rep", "coordinates"), matches(percent))
    clusters = settle(found.join(reps, found["id"] == reps["rep"]).select(
        "id", "head", F.col("component").alias("cluster")
    ))
    with small_batches(docs.sparkSession):
        sets = settle(_sets(docs, clusters))
    linked = components(_links(sets, percent))
    heads = linked.join(reps.select("rep", "head"), F.col("id") == F.col("rep"))
    first = heads.groupBy("component").agg(F.min("head").alias("first"))
    of_linked = linked.join(first, "component").select("id", "first")
    of_rep = reps.join(of_linked, reps["rep"] == of_linked["id"], "left").select(
        "digest", F.coalesce("first", "head").alias("head")
    )
    return known.join(of_rep, "digest", "left").select("doc_id", "key", "n_shingles", "head")


def near_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _component_of(docs, percent).select(
        "doc_id", "n_shingles",
        F.when(F.col("head").isNotNull(), F.col("head.doc")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component: that of the least id, and of these the least hash.

    Columns of the documents may have any names but that of ``doc_id`` or ``text`` twice.
    """
    p = own_prefix(docs.columns, "_n_")
    doc, text, stays = f"{p}doc", f"{p}text", f"{p}stays"
    own = F.col("doc_id").eqNullSafe(F.col("head.doc")) & (F.col("key") == F.col("head.key"))
    # Rows that go, and rows of which one stays: (doc_id, hash of the text) with their number.
    decided = settle(_component_of(docs, percent).filter("n_shingles > 0").groupBy(
        F.col("doc_id").alias(doc), F.col("key").alias(f"{p}key")
    ).agg(
        F.bool_and(own).alias(stays), F.count("*").alias(f"{p}rows")
    ).filter(~F.col(stays) | (F.col(f"{p}rows") > 1)))
    asked = _among(decided.select(_place(F.col(doc), F.col(f"{p}key")).alias("id")))
    marked = docs.withColumn(text, _key(F.col("text")))
    marked = marked.withColumn(f"{p}asked", asked(_place(F.col("doc_id"), F.col(text))))
    others, some = marked.filter(~F.col(f"{p}asked")), marked.filter(F.col(f"{p}asked"))
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc))
        & (F.col(text) == F.col(f"{p}key"))
    )
    alone = some.join(decided, same, "left_anti")
    repeated = some.join(decided.filter(F.col(stays)), same, "left_semi")
    rows = others.unionByName(alone).unionByName(repeated.dropDuplicates(["doc_id", text]))
    return rows.select(*named(docs.columns))
