import itertools
import math
import re
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse
from urllib.request import url2pathname

import numpy as np
import pytest

from quirebind.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(900_000, None), (900_001, ""), (None, "the and of"), (900_002, "neverseen1 neverseen2"), (5, "repeated id")]
    return table.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))


def test_base_and_counts_like_brute_force(spark, docs):
    rows = [(r.doc_id, WORD.findall((r.text or "").encode().lower().decode()) + [" end"]) for r in docs.collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count = Counter(w for i, ws in rows if not out(i) for w in ws)
    total, distinct = sum(count.values()), len(count)
    want = sorted(
        (repr(i), out(i), len(ws), sum(count[w] > 0 for w in ws), total,
         round(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), 6))
        for i, ws in rows
    )
    # A small share and small chunks: contexts, salted words and many buckets.
    scored = lm.scored(docs, share=1e-3, chunk=5000).collect()
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored)
    assert got == want
    held = [r for r in scored if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in scored)


def test_chunks_change_little(spark, docs):
    score = lambda **k: {r.doc_id: r.score for r in lm.scored(docs, share=1e-3, **k).collect()}
    one, many = score(), score(chunk=3000)
    assert all(abs(one[i] - many[i]) < 0.02 * abs(one[i]) + 0.5 for i in one)


def test_empty_and_untrained(spark, docs):
    assert lm.scored(docs.limit(0)).collect() == []
    only = spark.createDataFrame([(10, "a b")], "doc_id long, text string")  # id 10 or another is held out
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = lm.scored(only.selectExpr(f"cast({held} as long) doc_id", "text")).first()
    assert row.train_tokens == 0 and row.n_known == 0 and abs(row.score) < 1e-9


def seatings(n):
    """All partitions of n customers, as sizes of tables."""
    if n == 0:
        return [[]]
    out = []
    for s in seatings(n - 1):
        out.append(s + [1])
        out += [s[:i] + [s[i] + 1] + s[i + 1 :] for i in range(len(s))]
    return out


def test_table_numbers_have_the_right_distribution():
    """Exact probabilities, by going through all seatings, and the sampler's."""
    d, w = 0.6, 0.7
    for c in (2, 3, 5, 7):
        mass = Counter()
        for s in seatings(c):
            weight = w ** len(s)
            for size in s:
                for k in range(1, size):
                    weight *= k - d
            mass[len(s)] += weight
        total = sum(mass.values())
        table = lm.log_stirling(d)
        for t in range(1, c + 1):
            assert math.exp(table[c, t]) * w**t == pytest.approx(mass[t], rel=1e-9)
        drawn = lm.sample_tables(np.full(40_000, c), np.full(40_000, w), d, np.random.default_rng(1))
        for t in range(1, c + 1):
            assert (drawn == t).mean() == pytest.approx(mass[t] / total, abs=0.012)


def test_many_customers_join_the_exact_sampler():
    rng = np.random.default_rng(2)
    for d in (0.3, 0.5, 0.8):
        for w in (0.01, 0.5, 3.0, 30.0, 300.0):
            table = lm.log_stirling(d)
            log = table[lm.EXACT, 1:] + np.log(w) * np.arange(1, lm.EXACT + 1)
            p = np.exp(log - log.max())
            exact = (p * np.arange(1, lm.EXACT + 1)).sum() / p.sum()
            mean = lm.mean_tables(np.array([lm.EXACT]), np.array([w]), d)[0]
            assert mean == pytest.approx(exact, rel=0.1)
            drawn = lm.sample_tables(np.full(20_000, lm.EXACT + 1), np.full(20_000, w), d, rng)
            assert drawn.mean() == pytest.approx(exact, rel=0.15)
    assert (lm.sample_tables(np.array([0, 1]), np.array([0.1, 0.1]), 0.5, rng) == [0, 1]).all()


def ids(held):
    return (i for i in range(1_000_000) if (zlib.crc32(str(i).encode()) % 10 == 0) == held)


def test_rare_words_are_contexts(spark):
    """Behind a word below the share, what was seen there is likelier than what was not."""
    rows = [(i, f"w{i} zeta omega u{i}") for i, _ in zip(ids(False), range(40), strict=False)]
    out = ids(True)
    a, b = next(out), next(out)
    rows += [(a, "w zeta omega u"), (b, "w omega zeta u")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for share in (0.9, 0.15, 1e-4):  # no, some and all contexts are hot
        score = {r.doc_id: r.score for r in lm.scored(table, share=share, chunk=50).collect()}
        assert score[a] > score[b] + 0.5  # both were alike where the parent alone predicted


def test_probabilities_of_all_texts_add_up_to_one(spark):
    train = ["a", "b", "a b", "", "a a", "b"] * 100
    probes = [" ".join(t) for k in range(7) for t in itertools.product(["a", "b", "new"], repeat=k)]
    rows = [*zip(ids(False), train), *zip(ids(True), probes)]  # noqa: B905
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (1.1, 0.3, 1e-4):
        scored = lm.scored(table, share=share).collect()
        assert 0.97 < sum(10**r.score for r in scored if r.held_out) < 1.01


def test_mail_grows_with_shards_not_with_the_square_of_buckets(spark, docs, monkeypatch):
    """Rows between buckets stay few, no matter how they are dealt to shards the result is
    the same, and superseded rows do not stay on disk."""
    buckets, real, seen = 40, lm.settle, []

    def watched(df, *by):
        out = real(df, *by)
        if "kind" in out.columns:
            seen.append((out.inputFiles(), out.count()))
        return out

    monkeypatch.setattr(lm, "settle", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets)
    try:
        scores = []
        for shards, most in ((4, 64), (4, 5), (1, 64)):
            seen.clear()
            monkeypatch.setattr(lm, "SHARDS", shards, raising=False)
            monkeypatch.setattr(lm, "SHARD", most, raising=False)
            rows = lm.scored(docs, share=1e-2, chunk=3000).collect()
            scores.append(sorted((repr(r.doc_id), r.n_tokens, r.score) for r in rows))
            dealt = max(shards, -(-buckets // most))
            first, *swept = [n for _, n in seen]
            assert first <= buckets * (2 * dealt + 4)
            assert swept and max(swept) <= buckets + dealt * (2 * dealt + 2)
            there = [[f for f in files if Path(url2pathname(urlparse(f).path)).exists()] for files, _ in seen]
            assert there[0] and all(f"/kind={lm.WHOLE}/" in f for f in there[0])
            assert not any(there[1:-1]) and there[-1] == seen[-1][0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert scores[0] == scores[1] == scores[2]
