"""Language-model scores from a hierarchical Pitman-Yor model of word pairs.

Every word seen in training is a context with a restaurant of its own; all of them
share the parent restaurant of single words, whose base is uniform.  Words with at
least ``SHARE`` of the training tokens are hot: their totals are vectors that every
task gets (at most ``1 / SHARE`` long at any size), and their pairs are dealt out.
The totals of all other contexts lie in the bucket of that word.

Seating is sampled by Gibbs.  What counts of a dish in a restaurant is its number
of tables; given its customers, the parent's probability and the restaurant's other
tables, that number has a known distribution (generalised Stirling numbers), which
is sampled exactly up to ``EXACT`` customers; beyond, its mean is worked out and the
tables but the first are taken to be Poisson, which is their limit.  Sweeps are synchronous: the restaurants' totals are those of the
sweep before.  Predictive probabilities are averaged over ``SAMPLES`` seatings.

How it is spread:

* Texts are read once and stored as chunks: a vocabulary of word hashes and the row
  of places in it.  A chunk sends what it has seen, one entry per distinct word and
  pair, to buckets: a word to its home, a pair to the home of its context, or behind a
  hot context to that of its word; two hot words' pairs are dealt out by both, so no
  bucket depends on one word.  A bucket has a bounded share of the entries.
* Buckets merge counts and keep which entry of which chunk is which.  Pairs seen once
  have one table for ever and are counted only; the others are swept.
* A word behind a context that is not hot may have its home elsewhere.  After a sweep
  the tables of such words are written to their homes, and homes write back how
  probable the parent finds them; both are read in the sweep that follows.  Buckets
  are dealt to shards, whose buckets are swept one after the other: a row goes from
  shard to shard, not from bucket to bucket, so rows do not grow with the square of
  the buckets (``SHARDS`` shards, and more once a shard would have over ``SHARD``).
* Last, buckets answer the chunks with counts, the parent's probabilities, tables per
  context and customers seated per pair, and chunks add up their documents.

Defined cases: a null or empty text is the end token alone; a null doc_id is not
held out; repeated rows count each; without training tokens every probability is
uniform; an empty table gives an empty result; further columns are dropped.
"""

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind.llm.language import held_out
from quirebind.llm.near import word_hash
from quirebind.llm.words import lower_words, map_rows
from quirebind.session import drop_one, settle

FOLDS, HELD_OUT = 10, 0
SHARE = 1e-4
CHUNK = 1_000_000
BUCKET = 1_000_000
SHARDS, SHARD = 64, 64  # so many shards, until they have so many buckets each
SWEEPS, SAMPLES = 3, 3
EXACT = 40
STRENGTH = 1.0
END = " end"  # no word holds a blank
STATE, WHOLE, TABLES, SETTLED, PARENT, SUMS, DESK = range(7)  # kinds of rows between shards
_MAIL = "shard int, kind int, src int, body binary, more binary"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def loosened(raw: bytes, kind: Any) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(
        pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8
    )
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def steps(values: np.ndarray) -> bytes:
    """Whole numbers that mostly rise, by their differences."""
    return squeezed(np.diff(values.astype(np.int32), prepend=np.int32(0)))


def climbed(raw: bytes) -> np.ndarray:
    return np.cumsum(loosened(raw, np.int32), dtype=np.int64)


def frozen(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays in one row of bytes."""
    return pickle.dumps({k: (a.dtype.str, squeezed(a)) for k, a in arrays.items()})


def thawed(raw: bytes) -> dict[str, np.ndarray]:
    return {k: loosened(body, kind) for k, (kind, body) in pickle.loads(raw).items()}


def home_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words * _SPREAD >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def chunked(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """chunk, doc_ids, held, lengths, words (hashes), train (counts), tokens."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        from pyspark import TaskContext

        part, seq, fresh = TaskContext.get().partitionId(), 0, True
        for batch in batches:
            for doc, text, held in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                strict=True,
            ):
                if fresh:
                    places: dict[str, int] = {END: 0}
                    ids: list[int | None] = []
                    out: list[bool] = []
                    rows_of: list[np.ndarray] = []
                    total, fresh = 0, False
                words = lower_words(text.as_py())
                own = np.fromiter(
                    (places.setdefault(w, len(places)) for w in words), np.int32, len(words)
                )
                ids.append(doc)
                out.append(held)
                rows_of.append(np.append(own, np.int32(0)))
                total += len(own) + 1
                if total >= size:
                    yield _chunk(part, seq, ids, out, rows_of, places)
                    seq, fresh = seq + 1, True
        if not fresh:
            yield _chunk(part, seq, ids, out, rows_of, places)

    return map_rows(
        rows, run,
        "chunk bigint, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, "
        "words binary, train binary, tokens binary, n_tokens bigint", rows=1,
    )


def _chunk(part, seq, ids, held, rows, places) -> dict[str, Any]:
    lengths = [len(r) for r in rows]
    tokens = np.concatenate(rows)
    learned = np.repeat(~np.array(held, bool), lengths)
    train = np.bincount(tokens[learned], minlength=len(places))
    # Frequent words get small numbers, which the store packs well.
    order = np.argsort(-np.bincount(tokens, minlength=len(places)), kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    words = np.fromiter(map(word_hash, places), np.uint64, len(places))
    return {
        "chunk": part << 24 | seq, "doc_ids": ids, "held": held, "lengths": lengths,
        "words": words[order].tobytes(), "train": squeezed(train[order].astype(np.int64)),
        "tokens": squeezed(rank[tokens]), "n_tokens": len(tokens),
    }


class Requests:
    """What a chunk asks of the buckets, the same whenever it is made anew."""

    def __init__(self, row: dict[str, Any], contexts: np.ndarray, buckets: int):
        words = np.frombuffer(row["words"], np.uint64)
        number = _numbers(contexts, words)
        order = np.lexsort((words, number < 0))  # as buckets have them, so places mostly rise
        label = np.empty(len(order), np.int64)
        label[order] = np.arange(len(order))
        self.words, self.number = words[order], number[order]
        self.train = loosened(row["train"], np.int64)[order]
        self.tokens = label[loosened(row["tokens"], np.int32)]
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.repeat(np.array(row["held"], bool), self.lengths)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        end = int(np.flatnonzero(self.words == np.uint64(word_hash(END)))[0])
        before = np.roll(self.tokens, 1)
        before[self.starts] = end
        wide = len(self.words)
        keys, self.inverse = np.unique(before * wide + self.tokens, return_inverse=True)
        self.pair_context, self.pair_word = keys // wide, keys % wide
        self.pair_train = np.bincount(self.inverse[~self.held], minlength=len(keys))
        self.word_bucket = home_of(self.words, buckets)
        hot_word = self.number[self.pair_word] >= 0
        hot_context = self.number[self.pair_context] >= 0
        dealt = self.word_bucket[self.pair_word] + self.number[self.pair_context] * 7919
        self.pair_bucket = np.where(
            ~hot_context, self.word_bucket[self.pair_context],
            np.where(hot_word, dealt % buckets, self.word_bucket[self.pair_word]),
        )

        self.word_order = np.argsort(self.word_bucket, kind="stable")
        self.pair_order = np.argsort(self.pair_bucket, kind="stable")
        self.word_bucket = self.word_bucket[self.word_order]
        self.pair_bucket = self.pair_bucket[self.pair_order]

    def buckets(self) -> list[int]:
        return np.union1d(self.word_bucket, self.pair_bucket).tolist()

    def bucket(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words and pairs that are sent to bucket ``b``."""
        w = np.searchsorted(self.word_bucket, (b, b + 1))
        p = np.searchsorted(self.pair_bucket, (b, b + 1))
        return self.word_order[slice(*w)], self.pair_order[slice(*p)]


def _asked(chunks: DataFrame, contexts: np.ndarray, buckets: int) -> DataFrame:
    """What chunks ask of buckets.  Places of a pair: below ``wide`` a hot word's number,
    then the words sent along, then ``far``, words whose home is elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        wide = len(contexts)
        for batch in batches:
            for row in batch.to_pylist():
                r = Requests(row, contexts, buckets)
                place = np.zeros(len(r.words), np.int64)
                home = home_of(r.words, buckets)
                for b in r.buckets():
                    ws, ps = r.bucket(b)
                    dish = r.pair_word[ps]
                    far = np.unique(dish[(r.number[dish] < 0) & (home[dish] != b)])
                    place[ws] = wide + np.arange(len(ws))
                    place[far] = wide + len(ws) + np.arange(len(far))
                    at = np.where(r.number >= 0, r.number, place)
                    yield {
                        "bucket": b, "chunk": row["chunk"],
                        "words": r.words[ws].tobytes(), "train": squeezed(r.train[ws]),
                        "far": r.words[far].tobytes(),
                        "pair_word": squeezed(at[dish].astype(np.int32)),
                        "pair_context": steps(at[r.pair_context[ps]]),
                        "pair_train": squeezed(r.pair_train[ps].astype(np.int32)),
                    }

    return map_rows(
        chunks, run,
        "bucket int, chunk bigint, words binary, train binary, far binary, pair_word binary, "
        "pair_context binary, pair_train binary", rows=16,
    )


def _joined(group: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(group[column]), kind)


def _added(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, minlength=size).astype(np.int64)


def _numbers(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The place of each word among the sorted ``known`` ones, or -1."""
    if not len(known):
        return np.full(len(asked), -1)
    at = np.searchsorted(known, asked).clip(max=len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def _mailed(kind: int, sizes: np.ndarray, src: int, values: np.ndarray,
            more: np.ndarray | None = None) -> Iterator[tuple]:
    """A row for each shard that gets some of the values: ``sizes`` has how many."""
    ends = np.cumsum(sizes)
    for to in np.flatnonzero(sizes).tolist():
        start, end = int(ends[to] - sizes[to]), int(ends[to])
        own = b"" if more is None else more[start:end].tobytes()
        yield to, kind, src, squeezed(values[start:end]), own


def _sums(wide: int, totals, sent, *rest: float) -> np.ndarray:
    """Tables by hot context and of hot words, then customers and tables of the other
    words in the parent, pairs seen once and pairs seen twice."""
    return np.concatenate([totals[:wide], sent[:wide], rest]).astype(np.float64)


def _merged(asked: DataFrame, contexts: np.ndarray, buckets: int, shards: int) -> DataFrame:
    """Per bucket its state, which entries of which chunk are which, and the first mail:
    one table for each pair that was seen."""
    wide = len(contexts)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iloc[0])
        words, at = np.unique(_joined(group, "words", np.uint64), return_inverse=True)
        far, far_at = np.unique(_joined(group, "far", np.uint64), return_inverse=True)
        count = _added(
            at, np.concatenate([loosened(x, np.int64) for x in group["train"]]), len(words))
        size = wide + len(words) + len(far)
        word_sizes = group["words"].map(len).to_numpy(np.int64) // 8
        far_sizes = group["far"].map(len).to_numpy(np.int64) // 8
        keys, pair_sizes, w, f = [], [], 0, 0
        for pc, pw, nw, nf in zip(group["pair_context"], group["pair_word"], word_sizes, far_sizes,
                                  strict=True):
            real = np.concatenate([
                np.arange(wide), wide + at[w : w + nw], wide + len(words) + far_at[f : f + nf]])
            keys.append(real[climbed(pc)] * size + real[loosened(pw, np.int32)])
            pair_sizes.append(len(keys[-1]))
            w, f = w + nw, f + nf
        known, pair_at = np.unique(np.concatenate(keys), return_inverse=True)
        seen = _added(
            pair_at, np.concatenate([loosened(x, np.int32) for x in group["pair_train"]]), len(known))
        context, dish = known // size, known % size
        one, many, base = seen == 1, seen > 1, wide + len(words)
        sent = np.bincount(dish[seen > 0], minlength=size)
        # Far words of swept pairs, by their homes; what the others get is settled now.
        to = home_of(far, buckets) % shards
        swept = np.unique(dish[many & (dish >= base)]) - base
        swept = swept[np.argsort(to[swept], kind="stable")]
        live = np.zeros(len(far), bool)
        live[swept] = True
        settled = np.flatnonzero(~live & (sent[base:] > 0))
        settled = settled[np.argsort(to[settled], kind="stable")]
        place = np.arange(size)
        place[base + swept] = base + np.arange(len(swept))
        once_sent = np.bincount(dish[one], minlength=size)
        live_at = np.concatenate([np.arange(base), base + swept])
        homes = lambda x: np.bincount(to[x], minlength=shards)
        far_sizes = homes(swept)
        state = {
            "hot": _numbers(contexts, words).astype(np.int32),
            "context": context[many].astype(np.int32),
            "dish": place[dish[many]].astype(np.int32), "customers": seen[many],
            "tables": np.ones(int(many.sum()), np.int64),
            "once_tables": np.bincount(context[one], minlength=base),
            "once_sent": once_sent[live_at],
        }
        totals = np.bincount(context[seen > 0], minlength=base)
        state["totals"] = totals[wide:]
        whole = {
            "count": count, "seen": np.minimum(seen, 2).astype(np.uint8),
            "chunks": group["chunk"].to_numpy(np.int64), "word_sizes": word_sizes,
            "pair_sizes": np.array(pair_sizes, np.int64),
            "word_steps": np.diff(at.astype(np.int32), prepend=np.int32(0)),
            "pair_steps": np.diff(pair_at.astype(np.int32), prepend=np.int32(0)),
        }
        shard, desk = bucket % shards, {"words": words, "far_sizes": far_sizes}
        sums = _sums(wide, totals, sent, float(sent[wide:].sum()),
                     float(((count > 0) & (state["hot"] < 0)).sum()),
                     float(one.sum()), float((seen == 2).sum()))
        rows = [
            (shard, STATE, bucket, frozen(state), b""),
            (shard, WHOLE, bucket, frozen(whole), b""),
            (shard, DESK, bucket, frozen(desk), b""),
            (shard, SUMS, bucket, squeezed(sums), b""),
            *_mailed(TABLES, far_sizes, bucket, sent[base + swept], far[swept]),
            *_mailed(SETTLED, homes(settled), bucket, sent[base + settled], far[settled]),
        ]
        return pd.DataFrame(rows, columns=_COLUMNS)

    return asked.groupBy("bucket").applyInPandas(run, _MAIL)


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """log of the weight of ``t`` tables among ``c`` customers, for c, t <= most."""
    s = np.full((most + 1, most + 2), -np.inf)
    s[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, most + 1)
        stay = c - discount * t
        old = s[c, 1:-1] + np.log(np.where(stay > 0, stay, 1.0)) + np.where(stay > 0, 0, -np.inf)
        s[c + 1, 1:-1] = np.logaddexp(s[c, :-2], old)
    return s[:, : most + 1]


def sample_tables(
    customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator
) -> np.ndarray:
    """Numbers of tables: ``weight`` is what a new table weighs in each dish."""
    tables = np.minimum(customers, 1)
    table = log_stirling(discount)
    for c in np.unique(customers[(customers > 1) & (customers <= EXACT)]).tolist():
        rows = np.flatnonzero(customers == c)
        for at in range(0, len(rows), 100_000):
            some = rows[at : at + 100_000]
            log = table[c, 1 : c + 1] + np.log(weight[some])[:, None] * np.arange(1, c + 1)
            p = np.exp(log - log.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[some] = 1 + (p < rng.random(len(some))[:, None] * p[:, -1:]).sum(axis=1)
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        c = customers[many]
        more = rng.poisson(np.maximum(mean_tables(c, weight[many], discount) - 1, 0))
        tables[many] = np.minimum(c, 1 + more)
    return tables


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: Stirling's series after eight steps."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3)
    return series - np.log(x[..., None] + np.arange(8)).sum(axis=-1)


def mean_tables(customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Expected number of tables of many customers, if a new one weighs ``weight``.

    In a restaurant of strength ``s`` the ``t``-th new table weighs ``s + d t``, and
    the mean of that weight is ``s G(s, c)`` with a ratio ``G`` of gamma functions.
    The strength at which it is ``weight`` is found by halving; then
    ``t = (weight - s) / d``.
    """
    low = np.full(len(customers), -discount + 1e-12)
    high = np.maximum(weight, 1e-9)
    for _ in range(50):
        s = (low + high) / 2
        log = _log_gamma(s + 1) - _log_gamma(s + discount) + discount * np.log(
            s + customers + (discount - 1) / 2
        )
        over = log > np.log(weight)
        low, high = np.where(over, low, s), np.where(over, s, high)
    return (weight - (low + high) / 2) / discount


class Globals:
    """What all buckets share: totals per hot context, and the hot words."""

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, n: int, v: int, d0: float):
        self.contexts, self.n, self.v, self.d0, self.d1 = contexts, n, v, d0, 0.8
        self.customers = counts  # each token is followed by one, an end by a text's first
        self.tables = np.zeros(len(contexts))
        self.parent_customers = self.parent_tables = 1.0
        self.hot_p = np.full(len(contexts), 1.0 / (v + 1))

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        spare = (STRENGTH + self.d0 * self.parent_tables) / (self.v + 1)
        return (np.maximum(customers - self.d0 * tables, 0) + spare) / (
            STRENGTH + self.parent_customers
        )

    def seat_parent(self, customers: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        w = (STRENGTH + self.d0 * self.parent_tables) / (self.v + 1)
        return sample_tables(customers, np.full(len(customers), w), self.d0, rng)

    def take(self, sums: np.ndarray, rng: np.random.Generator) -> None:
        """The totals of a sweep; seat the hot words in the parent."""
        wide = len(self.contexts)
        self.tables = sums[:wide]
        own = np.round(sums[wide : 2 * wide]).astype(np.int64)
        self.parent_customers = sums[2 * wide] + float(own.sum())
        seated = self.seat_parent(own, rng)
        self.parent_tables = sums[2 * wide + 1] + float(seated.sum())
        self.hot_p = self.parent(own, seated)


class Bucket:
    """The restaurants' dishes of one bucket: its state, what the homes of its far words
    have answered, and how many tables of its own words are elsewhere."""

    def __init__(self, state: bytes, guests: np.ndarray, far_p: np.ndarray, g: Globals,
                 rng: np.random.Generator):
        s = self.state = thawed(state)
        self.g, self.rng, self.guests, self.far_p = g, rng, guests, far_p
        self.wide, self.size = len(g.contexts), len(s["hot"])
        self.known = self.wide + self.size + len(far_p) == len(s["once_sent"])  # not so at first
        self.totals = np.concatenate([g.tables, s["totals"]])
        self.tables = s["tables"]
        self._seat()

    def _seat(self) -> None:
        """Customers and tables in the parent of the words that are not hot."""
        s, g = self.state, self.g
        self.sent = s["once_sent"] + _added(s["dish"], self.tables, len(s["once_sent"]))
        here = self.sent[self.wide : self.wide + self.size]
        self.own = np.where(s["hot"] < 0, here + self.guests, 0)
        self.parent_tables = g.seat_parent(self.own, self.rng)
        self.p = g.parent(self.own, self.parent_tables)
        hot = s["hot"] >= 0
        self.p[hot] = g.hot_p[s["hot"][hot]]

    def sweep(self) -> None:
        s, g = self.state, self.g
        base = np.concatenate([g.hot_p, self.p, self.far_p])
        new = (STRENGTH + g.d1 * self.totals[s["context"]]) * base[s["dish"]]
        self.tables = sample_tables(s["customers"], np.maximum(new, 1e-300), g.d1, self.rng)
        self._seat()

    def all_tables(self) -> np.ndarray:
        """Tables of each context, the hot ones' first."""
        s = self.state
        return s["once_tables"] + _added(s["context"], self.tables, len(s["once_tables"]))

    def seated(self) -> np.ndarray:
        return np.maximum(self.state["customers"] - self.g.d1 * self.tables, 0)

    def frozen(self) -> bytes:
        """The state after a sweep."""
        totals = self.all_tables()[self.wide :]
        return frozen(self.state | {"tables": self.tables, "totals": totals})

    def sums(self) -> np.ndarray:
        return _sums(self.wide, self.all_tables(), self.sent, float(self.own.sum()),
                     float(self.parent_tables.sum()), 0.0, 0.0)


class Shard:
    """The buckets of one shard, their mail, and the desk that deals it out.

    Mail between two shards has its values by the sender's bucket, then as that bucket
    has them; the desk keeps how many of each bucket go to which shard, how many come
    from which, and whose word each one is."""

    def __init__(self, batches: Iterator[pd.DataFrame], g: Globals, shards: int, seed: int):
        group = pd.concat(list(batches), ignore_index=True)
        of = lambda kind: group[group["kind"] == kind].sort_values("src")
        self.shard, self.g, self.seed = int(group["shard"].iloc[0]), g, seed
        self.states = dict(zip(of(STATE)["src"].tolist(), of(STATE)["body"], strict=True))
        self.whole = dict(zip(of(WHOLE)["src"].tolist(), of(WHOLE)["body"], strict=True))
        desks, mail = [thawed(x) for x in of(DESK)["body"]], of(TABLES)
        if "words" in desks[0]:  # the first mail comes from buckets
            mail = mail.iloc[np.lexsort((mail["src"], mail["src"] % shards))]
            desks = [self._opened(desks, mail, of(SETTLED), shards)]
        d = self.desk = desks[0]
        self.far_sizes = d["far_sizes"].reshape(-1, shards)
        got = [loosened(x, np.int64) for x in mail["body"]]
        guests = d["once"] + _added(d["guest_at"], np.concatenate([[], *got]), len(d["once"]))
        self.guests = np.split(guests, np.cumsum(d["sizes"])[:-1])
        self.far_p: list[list[np.ndarray]] = [[np.zeros(0)] for _ in self.states]
        answers = of(PARENT)
        for src, body in zip(answers["src"].tolist(), answers["body"], strict=True):
            ends = np.cumsum(self.far_sizes[:, src])
            for own, part in zip(
                self.far_p, np.split(loosened(body, np.float32), ends[:-1]), strict=True
            ):
                own.append(part)

    @staticmethod
    def _opened(desks: list[dict], mail: pd.DataFrame, once: pd.DataFrame, shards: int) -> dict:
        words = np.concatenate([x["words"] for x in desks])
        order = np.argsort(words)
        at = lambda x: order[np.searchsorted(words, x, sorter=order)]
        sizes = mail["more"].map(len).to_numpy(np.int64) // 8
        settled = np.concatenate([[], *(loosened(x, np.int64) for x in once["body"])])
        return {
            "far_sizes": np.concatenate([x["far_sizes"] for x in desks]),
            "sizes": np.array([len(x["words"]) for x in desks], np.int64),
            "once": _added(at(_joined(once, "more", np.uint64)), settled, len(words)),
            "guest_at": at(_joined(mail, "more", np.uint64)).astype(np.int32),
            "guest_sizes": _added(mail["src"].to_numpy(np.int64) % shards, sizes, shards),
        }

    def buckets(self) -> Iterator[tuple[int, Bucket]]:
        for (b, state), guests, far_p in zip(
            self.states.items(), self.guests, self.far_p, strict=True
        ):
            rng = np.random.default_rng([self.seed, b])
            yield b, Bucket(state, guests, np.concatenate(far_p), self.g, rng)

    def swept(self, rounds: int) -> Iterator[pd.DataFrame]:
        """The states after the sweeps, and the shard's mail."""
        me, wide, desk = self.shard, len(self.g.contexts), self.desk
        sums, single, far = np.zeros(2 * wide + 4), [], []
        for b, bucket in self.buckets():
            for _ in range(rounds if bucket.known else 0):
                bucket.sweep()
            yield pd.DataFrame([(me, STATE, b, bucket.frozen(), b"")], columns=_COLUMNS)
            sums += bucket.sums()
            single.append(bucket.p)
            far.append(bucket.sent[wide + bucket.size :])
        # From by bucket, then shard to by shard, then bucket.
        to = np.tile(np.arange(self.far_sizes.shape[1]), len(far)).repeat(self.far_sizes.ravel())
        far = np.concatenate(far)[np.argsort(to, kind="stable")]
        answers = np.concatenate(single)[desk["guest_at"]].astype(np.float32)
        rows = [
            (me, DESK, me, frozen(desk), b""), (me, SUMS, me, squeezed(sums), b""),
            *_mailed(TABLES, self.far_sizes.sum(axis=0), me, far),
            *_mailed(PARENT, desk["guest_sizes"], me, answers),
        ]
        yield pd.DataFrame(rows, columns=_COLUMNS)


_COLUMNS = ["shard", "kind", "src", "body", "more"]


def _summed(rows: DataFrame, wide: int) -> np.ndarray:
    """The buckets' sums added up: two numbers per hot context and four more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        added = np.zeros(2 * wide + 4)
        for batch in batches:
            for body in batch.column(0):
                added += loosened(body.as_py(), np.float64)
        for i in np.flatnonzero(added).tolist():
            yield {"id": i, "value": float(added[i])}

    parts = map_rows(rows.filter(F.col("kind") == SUMS).select("body"), run, "id int, value double")
    out = np.zeros(2 * wide + 4)
    for i, value in parts.groupBy("id").agg(F.sum("value")).collect():
        out[i] = value
    return out


def _swept(rows: DataFrame, g: Globals, seed: int, rounds: int, shards: int) -> DataFrame:
    """All shards read their mail, sweep and write again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from Shard(batches, g, shards, seed).swept(rounds)

    mail = rows.filter(~F.col("kind").isin(WHOLE, SUMS))
    return mail.groupBy("shard").applyInPandas(run, _MAIL)


def _answers(
    merged: DataFrame, swept: DataFrame, g: Globals, samples: int, shards: int
) -> DataFrame:
    """chunk, bucket, and per asked word its count, the parent's probability and its
    tables as a context, per asked pair the customers that are seated, in the order
    they were asked in."""

    def answered(b: int, bucket: Bucket, whole: dict[str, np.ndarray]) -> pd.DataFrame:
        single, tables = np.zeros(bucket.size), np.zeros(bucket.size)
        seated = np.zeros(len(bucket.tables))
        for _ in range(samples):
            bucket.sweep()
            single += bucket.p / samples
            tables += bucket.all_tables()[bucket.wide :] / samples
            seated += bucket.seated() / samples
        pair = np.where(whole["seen"] == 1, 1 - g.d1, 0.0)
        pair[whole["seen"] > 1] = seated
        single, tables, pair = (x.astype(np.float32) for x in (single, tables, pair))
        word_at, pair_at = np.cumsum(whole["word_steps"]), np.cumsum(whole["pair_steps"])
        out, w, p = [], 0, 0
        for chunk, nw, np_ in zip(whole["chunks"].tolist(), whole["word_sizes"].tolist(),
                                  whole["pair_sizes"].tolist(), strict=True):
            ws, ps = word_at[w : w + nw], pair_at[p : p + np_]
            w, p = w + nw, p + np_
            out.append((chunk, b, squeezed(whole["count"][ws]), squeezed(single[ws]),
                        squeezed(tables[ws]), squeezed(pair[ps])))
        return pd.DataFrame(out, columns=["chunk", "bucket", "count", "single", "tables", "pair"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = Shard(batches, g, shards, 1000)
        for b, bucket in shard.buckets():
            yield answered(b, bucket, thawed(shard.whole[b]))

    mail = swept.filter(F.col("kind") != SUMS)
    return merged.filter(F.col("kind") == WHOLE).union(mail).groupBy("shard").applyInPandas(
        run, "chunk bigint, bucket int, count binary, single binary, tables binary, pair binary"
    )


def scored(
    docs: DataFrame, share: float = SHARE, chunk: int = CHUNK, sweeps: int = SWEEPS,
    samples: int = SAMPLES,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    chunks = settle(chunked(docs, chunk))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, train in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(words.as_py(), np.int64)),
                    pa.array(loosened(train.as_py(), np.int64)),
                ], names=["word", "n"])

    counts = settle(
        chunks.select("words", "train").mapInArrow(explode, "word bigint, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )
    one = lambda k: F.coalesce(F.sum((F.col("n") == k).cast("bigint")), F.lit(0))
    n, v, n1, n2 = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("bigint")), F.lit(0)),
        one(1), one(2),
    ).first()
    frequent = counts.filter((F.col("n") > 0) & (F.col("n") >= share * n)).collect()  # 1 / share
    drop_one(counts)
    order = sorted((np.uint64(r[0] & (1 << 64) - 1), r[1]) for r in frequent)
    contexts = np.array([w for w, _ in order], np.uint64)
    d0 = min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))
    g = Globals(contexts, np.array([c for _, c in order], float), n, v, d0)
    entries = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-entries // BUCKET))

    shards = min(buckets, max(SHARDS, -(-buckets // SHARD)))

    merged = settle(_merged(_asked(chunks, contexts, buckets), contexts, buckets, shards), "kind")
    first = _summed(merged, len(contexts))
    once, twice = first[-2:].tolist()
    g.d1 = min(0.95, max(0.05, once / max(1.0, once + 2 * twice)))
    rng = np.random.default_rng(11)
    g.take(first, rng)
    swept = merged
    for k in range(sweeps + 1):  # in the first, words' homes only learn who asks for them
        last, swept = swept, settle(_swept(swept, g, k + 1, 2, shards))
        g.take(_summed(swept, len(contexts)), rng)
        drop_one(last, f"kind={WHOLE}")  # all but that is superseded

    def add_up(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame([], columns=_RESULT)
        row = left.iloc[0]
        r = Requests(row, contexts, buckets)
        single, tables = np.zeros(len(r.words)), np.zeros(len(r.words))
        seated = np.zeros(len(r.pair_word))
        count = np.zeros(len(r.words), np.int64)
        for b, c, s, t, p in zip(*(right[x] for x in ("bucket", "count", "single", "tables", "pair")),
                                 strict=True):
            ws, ps = r.bucket(b)
            count[ws], single[ws] = loosened(c, np.int64), loosened(s, np.float32)
            tables[ws], seated[ps] = loosened(t, np.float32), loosened(p, np.float32)
        hot = r.number >= 0
        tables[hot] = g.tables[r.number[hot]]
        all_seated = STRENGTH + count
        back = (STRENGTH + g.d1 * tables) / all_seated
        pair = seated / all_seated[r.pair_context] + back[r.pair_context] * single[r.pair_word]
        score = np.log10(pair)[r.inverse]
        base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))[r.tokens]
        return pd.DataFrame({
            "doc_id": pd.array(list(row["doc_ids"]), "Int64"), "held_out": list(row["held"]),
            "n_tokens": r.lengths,
            "n_known": np.add.reduceat((count > 0)[r.tokens].astype(np.int64), r.starts),
            "train_tokens": n, "base_score": np.add.reduceat(base, r.starts),
            "score": np.add.reduceat(score, r.starts),
        })

    answers = _answers(merged, swept, g, samples, shards)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        add_up,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


_RESULT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
