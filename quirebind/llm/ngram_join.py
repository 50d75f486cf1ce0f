"""Jaccard join of word n-grams by token-combination prefixes.

A token is a shingle of four words, hashed to 64 bits.  Documents link from a similarity
of ``PERCENT``; the result is the component of every document.

1. Token classes.  How often tokens occur is counted for the whole corpus in a table of
   ``BUCKETS`` counters, whose size does not depend on the corpus.  A token is frequent if
   its counter stands out above what chance puts on a counter.  Tokens are ordered rare
   ones first, by (counter, hash).  Counters only decide how much work there is: any order
   that all tasks share gives the same links.
2. Keys.  Linked sets share at least ``o`` tokens, so the ``n - o + k`` first tokens of
   both have ``k`` in common.  If these are rare, they are keys of their own.  If no shared
   token is, prefixes are extended further: among the first so many frequent tokens of both
   stands a run of ``COMBINED`` shared ones that no other token interrupts (see ``reach``),
   so runs of ``COMBINED`` neighbours are keys.  Their number is linear in the text.
3. Keys that only one set has go, by an aggregate that combines before its shuffle, and so
   do sets whose prefix is of rare tokens and has fewer than ``k`` of them left.  The others
   hang on the least set of each key and size class, and these on that of the class next
   to theirs: linked sets are of one class or of two next to each other, and sets of other
   sizes that share a key are no reason for a cluster.
4. Verification.  The texts of clusters are read again where they lie (a bitmap of fixed
   size tells which) and only their sets move.  In a task, sets meet by the postings of
   their keys; a posting whose sets are all joined with the one at hand is skipped, so a
   group of copies costs one comparison a set.  Links are confirmed on full sets.
5. A cluster beyond a block is cut into blocks.  Then one set per part of a cluster meets
   the others of its kind, and after that only sets that still share a key across parts
   with a set of such a size are left: these meet in pairs of blocks of their size class or
   of one next to it, so a set is copied for these alone.  Whatever the sizes, every pair
   that shares a key and may be linked is either joined already or compared.

Links join their sets, so only the links that join something are written; copies of one
set are one set from the start.  Result: doc_id, n_shingles, component_id.

Defined cases: a null text, and one without words, has an empty set and is its own
component; with fewer than four words the whole row of words is the one shingle; repeated
rows are equal sets; rows of null doc_id link like others, and a component without any
other doc_id is null; an empty table gives an empty result; further columns are dropped.
"""

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind.llm.graph import components
from quirebind.llm.words import id_and_text
from quirebind.session import settle

SHINGLE, PERCENT = 4, 85
COMBINED = 3
#: Linked sets share one token in their prefixes per so many tokens of the smaller one.
PER_MATCH = 20
BUCKETS, SLICES = 1 << 21, 64
#: A counter stands out if it is this far above the mean, and so many deviations more.
FREQUENT, DEVIATIONS = 32, 6
BITS = 1 << 23
BLOCK_SETS, BLOCK_SHINGLES = 1500, 1_500_000
LONG, PIECE = 1024, 1 << 18
_SEEN = 200_000

_rng = np.random.default_rng(20250112)
_TIMES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_JOIN = _rng.integers(1, 1 << 63, COMBINED, dtype=np.uint64) | np.uint64(1)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_WHITE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWER = np.cumprod(np.full(LONG + 1, 0x9E6C63D0876A9A47, np.uint64))


# --- sets -----------------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes in lower case start, and their 64-bit hashes.

    A word of up to ``LONG`` bytes is a sum of random numbers of its bytes times powers of
    their places, a longer one is hashed whole.  Worked out ``PIECE`` bytes at a time.
    """
    edges = np.flatnonzero(np.diff(np.concatenate(([False], ~_WHITE[data], [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    long = np.flatnonzero(sizes > LONG)
    for i in long:
        whole = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(whole, "little")
    low = 0
    for stop in (*long, len(starts)):
        while low < stop:
            high = min(stop, max(low + 1, int(np.searchsorted(ends, starts[low] + PIECE))))
            first, own = starts[low], data[starts[low] : ends[high - 1]]
            at = starts[low:high] - first
            place = np.arange(len(own)) - np.repeat(at, np.diff(np.append(at, len(own))))
            values = _BYTE[own] * _POWER[np.minimum(place, LONG)]  # white space counts nothing
            out[low:high] = np.add.reduceat(values, at)
            low = high
        low = stop + 1
    return starts, _mixed(out + sizes.astype(np.uint64) * _TIMES[0])


def _shingles(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The distinct shingles of a text, ascending, from its words' hashes and the hashes of
    its runs of ``SHINGLE`` words (and more behind, if it has fewer)."""
    if not len(words):
        return words
    if len(words) < SHINGLE:  # of another length, so of another sum
        total = np.sum(words * _TIMES[: len(words)], keepdims=True)
        return _mixed(total + np.array([len(words)], np.uint64))
    total = np.sort(runs[: len(words) - SHINGLE + 1])
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as 64-bit hashes, ascending; none for null."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        # Rows of up to PIECE bytes at once, or a longer one alone; a blank behind each.
        j = min(len(texts), max(i + 1, int(np.searchsorted(ends, ends[i] + PIECE, "right")) - 1))
        spread = np.full(ends[j] - ends[i] + (j - i), 0x20, np.uint8)
        begins = ends[i:j] - ends[i] + np.arange(j - i)
        for k in range(i, j):
            at = begins[k - i]
            spread[at : at + ends[k + 1] - ends[k]] = data[ends[k] : ends[k + 1]]
        starts, hashes = word_hashes(_LOWER[spread])
        cuts = [*np.searchsorted(starts, begins).tolist(), len(starts)]
        n = max(0, len(hashes) - SHINGLE + 1)
        runs = _mixed(sum(hashes[k : k + n] * _TIMES[k] for k in range(SHINGLE)))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield _shingles(hashes[a:b], runs[a:])
        i = j


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _rep(digest: bytes) -> int:
    """The set's number: the first eight bytes of its digest.  It only finds candidates."""
    return int.from_bytes(digest[:8], "little", signed=True)


# --- token classes --------------------------------------------------------------

def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(BUCKETS - 1)).astype(np.int64)


def _added(group: pd.DataFrame) -> np.ndarray:
    total = np.zeros(BUCKETS // SLICES, np.int64)
    for b in group["counts"]:
        total += np.frombuffer(zlib.decompress(b), np.int64)
    return total


def token_counts(docs: DataFrame) -> np.ndarray:
    """How many tokens of the corpus fall on each counter, all documents counted.

    A task hands on its counters in slices; slices are added up in two steps, so no task
    reads more than a share of them.  ``BUCKETS`` numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for own in sets_of(batch.column(0)):
                np.add.at(counts, _bucket(own), 1)
        if counts.any():
            slices = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array(slices, pa.binary())],
                names=["slice", "counts"],
            )

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "slice": group["slice"].iloc[:1].astype("int32"),
            "counts": [zlib.compress(_added(group).tobytes(), 1)],
        })

    kind = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(run, kind).withColumn(
        "deal", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = parts.groupBy("slice", "deal").applyInPandas(added, kind)
    counts = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for row in some.groupBy("slice").applyInPandas(added, kind).collect():  # SLICES rows
        counts[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return counts.ravel()


class Classes:
    """The order of tokens, and which are frequent."""

    def __init__(self, counts: np.ndarray) -> None:
        mean = counts.mean()
        self.cut = mean + DEVIATIONS * mean**0.5 + FREQUENT
        shift = max(0, int(counts.max(initial=0)).bit_length() - 32)
        self.cut = int(self.cut) >> shift
        self.counts = (counts >> shift).astype(np.uint32)

    def ordered(self, tokens: np.ndarray) -> tuple[np.ndarray, int]:
        """Ascending tokens rare first, and how many are rare."""
        of = self.counts[_bucket(tokens)]
        return tokens[np.argsort(of, kind="stable")], int((of <= self.cut).sum())


# --- keys -----------------------------------------------------------------------

def matches(n: int, percent: int = PERCENT) -> int:
    """How many tokens of its prefix a set of ``n`` shares with any set linked to it.

    Taken from the least size that is linked, so that the prefix of the smaller one of a
    linked pair is long enough for the larger one.
    """
    return max(1, -(-percent * n // 100) // PER_MATCH)


@lru_cache(100_000)
def reach(n: int, percent: int = PERCENT) -> tuple[int, int, bool]:
    """For a set of ``n`` tokens: the length of its prefix, how many of its frequent tokens
    hold a run shared with any set linked to it, and whether runs may be missing.

    Let a linked set have ``s`` tokens, ``o`` of them shared.  The k-th shared token stands
    among the first ``n - o + k``.  If all shared tokens are frequent, at most ``n + s - 2 o``
    others stand between them in either set, so the first ``(n + s - 2 o + 1) * (COMBINED -
    1) + 1`` shared ones hold a run of COMBINED, and at most ``n - o`` of the set's own stand
    before its end.  Both fall as ``o`` grows.  Where fewer are shared than that, single
    tokens are keys too, in both sets.
    """
    share = -(-percent * n // 100)
    s = np.arange(share, 100 * n // percent + 1)
    o = np.maximum(-(-percent * (n + s) // (100 + percent)), 1)
    run = (n + s - 2 * o + 1) * (COMBINED - 1) + 1
    prefix = min(n, n - share + max(1, n // PER_MATCH))
    return prefix, int((run + n - o).max()), bool((run > o).any())


def keys_of(
    tokens: np.ndarray, classes: Classes, percent: int = PERCENT
) -> tuple[np.ndarray, int]:
    """The keys of a set, and how many of them any linked set has."""
    n = len(tokens)
    if not n:
        return tokens, 0
    prefix, runs, missing = reach(n, percent)
    ordered, rare = classes.ordered(tokens)
    keys = [ordered[: min(prefix, rare)]]
    if rare < prefix:
        # Each rare token is one that is not shared, so as many fewer interrupt.
        common = ordered[rare : rare + max(0, runs - COMBINED * rare)]
        if missing:
            keys.append(ordered[rare:prefix])
        if len(common) >= COMBINED:
            m = len(common) - COMBINED + 1
            with np.errstate(over="ignore"):
                keys.append(_mixed(sum(common[k : k + m] * _JOIN[k] for k in range(COMBINED))))
    return np.concatenate(keys), 1 if rare < prefix else matches(n, percent)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def keyed(docs: DataFrame, classes, percent: int) -> DataFrame:
    """doc_id, n, digest, rep, keys and need of every document.  Copies inside a task may
    have no keys: one of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            n, digests, keys, needs = [], [], [], []
            for own in sets_of(batch.column(1)):
                n.append(len(own))
                digest = _digest(own)
                digests.append(digest)
                found, need = keys_of(own[:0] if digest in seen else own, classes.value, percent)
                if len(seen) >= _SEEN:  # only spares work: copies meet again below
                    seen.clear()
                seen.add(digest)
                keys.append(_signed(found))
                needs.append(need)
            ends = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                pa.array([_rep(d) for d in digests], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64())),
                pa.array(needs, pa.int32()),
            ], names=["doc_id", "n", "digest", "rep", "keys", "need"])

    return id_and_text(docs).mapInArrow(
        run, "doc_id bigint, n bigint, digest binary, rep bigint, keys array<bigint>, need int"
    )


def size_class(percent: int) -> Column:
    """The class of a set of ``n`` tokens: linked sets are of one, or of two neighbours.

    Classes are wider than the sizes of linked sets are apart, by more than a logarithm
    may be wrong.
    """
    width = max(math.log(100 / percent) * (1 + 1e-9), 1e-3)
    return F.floor(F.log("n") / width).cast("int")


def _neighbours(own: DataFrame, by: list[str], least: str, most: str) -> DataFrame:
    """(by, band, least, most) of the rows of each class and the one above it, where
    these differ."""
    both = own.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"))))
    return both.groupBy(*by, "band").agg(
        F.min(least).alias("least"), F.max(most).alias("most")).filter("least <> most")


def clusters(known: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(id, component) of the sets, by number, that may be linked with another."""

    def shared(posted: DataFrame) -> DataFrame:
        return posted.groupBy("key").agg(
            F.min("rep").alias("least"), F.max("rep").alias("most")
        ).filter("least <> most").select("key", "least")

    # One number for both, so that rows that move are no wider.
    need = F.shiftleft(F.col("need").cast("bigint"), 16) + size_class(percent)
    posted = known.select("rep", need.alias("need"), F.explode("keys").alias("key"))
    left = posted.join(shared(posted).select("key"), "key").dropDuplicates(["key", "rep"])
    enough = left.groupBy("rep").agg(  # no more than a set has keys
        F.collect_list("key").alias("keys"), F.max("need").alias("need")
    ).filter(F.size("keys") >= F.shiftright("need", 16))
    band = F.col("need").bitwiseAND(0xFFFF).cast("int")
    kept = settle(enough.select("rep", band.alias("band"), F.explode("keys").alias("key")))
    heads = kept.groupBy("key", "band").agg(F.min("rep").alias("least"))
    inside = kept.join(heads, ["key", "band"]).filter("rep <> least").select(
        F.col("rep").alias("a"), F.col("least").alias("b"))
    across = _neighbours(heads, ["key"], "least", "least").select(
        F.col("most").alias("a"), F.col("least").alias("b"))
    return components(inside.unionByName(across))


# --- verification ---------------------------------------------------------------

def bitmap(ids: DataFrame) -> np.ndarray:
    """BITS bits, those of the ids set."""
    place = f"pmod(id, {BITS})"  # ids are digests, so as good as random
    words = ids.select(
        F.expr(f"{place} div 64").alias("w"),
        F.expr(f"shiftleft(1L, cast({place} % 64 as int))").alias("b"),
    ).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(BITS // 64, np.int64)
    for row in words.collect():  # BITS / 64 rows at most
        out[row["w"]] = row["b"]
    return out.view(np.uint64)


def _sets(docs: DataFrame, found: DataFrame, classes, percent: int) -> DataFrame:
    """num, cluster, digest, n, hashes, keys of the sets in clusters, from their texts."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(bitmap(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for own in sets_of(batch.column(0)):
                if not len(own):
                    continue
                digest = _digest(own)
                if digest in seen:
                    continue
                if len(seen) >= _SEEN:  # only spares work: copies meet again below
                    seen.clear()
                seen.add(digest)
                rows.append((_rep(digest), digest, own))
            place = np.array([r & BITS - 1 for r, _, _ in rows], np.int64)
            asked = wanted.value[place // 64] >> (place % 64).astype(np.uint64) & np.uint64(1)
            rows = [r for r, a in zip(rows, asked) if a]
            keys = [_signed(keys_of(own, classes.value, percent)[0]).tolist() for _, _, own in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r for r, _, _ in rows], pa.int64()),
                pa.array([d for _, d, _ in rows], pa.binary()),
                pa.array([len(s) for _, _, s in rows], pa.int64()),
                pa.array([s.tobytes() for _, _, s in rows], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ], names=["rep", "digest", "n", "hashes", "keys"])

    kind = "rep bigint, digest binary, n bigint, hashes binary, keys array<bigint>"
    sets = docs.select("text").mapInArrow(run, kind)
    met = sets.join(found.select(F.col("id").alias("rep"), F.col("component").alias("cluster")), "rep")
    return settle(met.dropDuplicates(["rep", "digest"]).drop("rep").withColumn(
        "num", F.monotonically_increasing_id()))


def linked(
    sets: list[np.ndarray], keys: list, parts: list[int], percent: int = PERCENT
) -> list[tuple[int, int]]:
    """Which parts are joined by links between sets that share a key: (part, the least
    part joined with it).

    Sets of one of ``parts`` are joined already.  A posting keeps its sets by what they are
    joined to, and skips those that are joined with the set at hand as one.
    """
    up = list(range(len(sets)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    first: dict[int, int] = {}
    for i, p in enumerate(parts):
        up[i] = first.setdefault(p, i)

    def meet(i: int, mine: int, others: list[int], tried: set[int]) -> None:
        own = sets[i]
        for j in reversed(others):
            if j in tried:
                continue
            tried.add(j)
            other = sets[j]
            if 100 * min(len(own), len(other)) < percent * max(len(own), len(other)):
                continue
            at = np.searchsorted(other, own)
            at[at == len(other)] = 0
            both = int((other[at] == own).sum())
            if 100 * both >= percent * (len(own) + len(other) - both):
                up[root(j)] = mine
                return  # the others are joined with it

    posted: dict[int, dict[int, list[int]]] = {}
    for i in range(len(sets)):
        mine, tried = root(i), set()
        for key in keys[i]:
            groups = posted.get(key)
            if groups is None:
                posted[key] = {mine: [i]}
                continue
            if len(groups) == 1:
                (at, others), = groups.items()
                if root(at) == mine:
                    others.append(i)
                    continue
            now: dict[int, list[int]] = {}
            for at, others in groups.items():
                if root(at) != mine:
                    meet(i, mine, others, tried)
                held = now.setdefault(root(at), others)
                if held is not others:
                    held.extend(others)
            now.setdefault(mine, []).append(i)
            posted[key] = now
    least: dict[int, int] = {}
    for p, i in first.items():
        least[root(i)] = min(p, least.get(root(i), p))
    return [(p, least[root(i)]) for p, i in first.items() if p != least[root(i)]]


def _compared(dealt: DataFrame, by: list[str], percent: int) -> DataFrame:
    """Parts (a) and the least part each is joined with (b), by the groups of part, hashes,
    keys."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(b, np.uint64) for b in group["hashes"]]
        keys = [k.tolist() for k in group["keys"]]
        joined = linked(sets, keys, group["part"].tolist(), percent)
        return pd.DataFrame(joined, columns=["a", "b"], dtype="int64")

    return dealt.groupBy(*by).applyInPandas(run, "a bigint, b bigint")


def _blocks_needed() -> Column:
    return F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
    ).cast("int").alias("blocks")


def _blocks(members: DataFrame) -> DataFrame:
    """cluster and the number of blocks it needs."""
    return members.groupBy("cluster").agg(
        _blocks_needed(), F.count("*").alias("sets"),
    ).filter("sets > 1").drop("sets")


def _block() -> F.Column:
    return F.pmod(F.xxhash64("num"), "blocks").cast("int")


def _parted(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members with the part that theirs is joined to."""
    to = joined.select(F.col("a").alias("part"), F.col("b").alias("to"))
    return members.join(to, "part", "left").withColumn("part", F.coalesce("to", "part")).drop("to")


def _paired(rest: DataFrame) -> DataFrame:
    """Sets (with ``band``) once per pair of blocks they are in: two of a class (step 0), or
    one of a class and one of the class above it (step 1)."""
    own = rest.groupBy("cluster", "band").agg(_blocks_needed())
    told = own.select("cluster", "blocks", F.inline(F.array(*[
        F.struct((F.col("band") + d).alias("band"), F.lit(d).alias("d")) for d in (-1, 0, 1)])))
    around = told.groupBy("cluster", "band").agg(*[
        F.max(F.when(F.col("d") == d, F.col("blocks"))).alias(name)
        for d, name in ((-1, "above"), (0, "blocks"), (1, "below"))
    ])
    dealt = rest.join(around, ["cluster", "band"]).withColumn("block", _block())

    def met(blocks: str, low: int, step: int, left, right) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), lambda o: F.struct(
            (F.col("band") + low).alias("low"), F.lit(step).alias("step"),
            left(o).alias("left"), right(o).alias("right")))

    block, other = (lambda o: F.col("block")), (lambda o: o)
    pairs = F.flatten(F.array_compact(F.array(
        met("blocks", 0, 0, lambda o: F.least(o, "block"), lambda o: F.greatest(o, "block")),
        met("above", 0, 1, block, other),
        met("below", -1, 1, other, block),
    )))
    return dealt.select(*rest.columns, F.inline(pairs))


def links_of(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that join all linked sets of ``members``."""
    whole = members.withColumn("part", F.col("num"))
    sized = whole.join(_blocks(members), "cluster").withColumn("block", _block())
    within = settle(_compared(sized, ["cluster", "block"], percent))
    # One set per part of a large cluster meets the others of its kind, block by block.
    # Every part is in one block, so what it is joined to is known.
    large = settle(_parted(sized.filter("blocks > 1").drop("blocks", "block"), within))
    heads = large.filter("num = part")
    dealt = heads.join(_blocks(heads), "cluster").withColumn("block", _block())
    between = settle(_compared(dealt, ["cluster", "block"], percent))
    # What still shares a key across parts is compared with all of its kind.
    links = within.unionByName(between)
    parted = _parted(large, between)
    sized = parted.withColumn("band", size_class(percent))
    posted = sized.select("num", "cluster", "part", "band", F.explode("keys").alias("key"))
    by = ["cluster", "key"]
    parts = posted.groupBy(*by, "band").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = _neighbours(parts, by, "low", "high").select(
        *by, F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    nums = posted.join(mixed, [*by, "band"], "left_semi").select("num").distinct()
    rest = settle(sized.join(nums, "num"))
    across = _compared(_paired(rest), ["cluster", "low", "step", "left", "right"], percent)
    return settle(links.unionByName(across))


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(Classes(token_counts(docs)))
    known = settle(keyed(docs, classes, percent))
    found = settle(clusters(known.filter("n > 0"), percent))
    members = _sets(docs, found, classes, percent)
    parts = components(links_of(members, percent))
    of_set = members.select("num", "digest").join(parts, F.col("num") == F.col("id")).select(
        "digest", "component"
    )
    heads = known.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"))
    headed = heads.join(of_set, "digest", "left")
    least = headed.filter("component is not null").groupBy("component").agg(
        F.min("first").alias("least"))
    of_digest = headed.join(least, "component", "left").select(
        "digest", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("least")).alias("head"),
        F.lit(True).alias("some"),
    )
    return known.select("doc_id", "n", "digest").join(of_digest, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("some"), F.col("head")).otherwise(F.col("doc_id")).alias("component_id"),
    )
