import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirebind.llm import ngram_join as join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower().decode())
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute(rows, percent=85):
    """The least id that can be reached, by comparing all pairs."""
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def corpus():
    """Groups of copies with changed words, chains of copies, shared passages, short texts."""
    rnd = random.Random(5)
    make = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    passages = [make(60) for _ in range(4)]
    rows, n = [], 0
    for size in (9, 12, 40, 150, 150, 400):
        base = make(size)
        for k in range(40):
            own = list(base)
            for _ in range(rnd.randrange(0, 1 + max(1, size // 30))):
                own[rnd.randrange(size)] = f"e{rnd.randrange(9999)}"
            rows.append((n, " ".join(own).upper() if k % 3 else "\n".join(own)))
            n += 1
    drift = make(200)
    for _ in range(40):  # each like the one before, the ends unlike each other
        drift[rnd.randrange(200)] = f"d{n}"
        drift[rnd.randrange(200)] = f"e{n}"
        rows.append((n, " ".join(drift)))
        n += 1
    for _ in range(60):  # passages that many share, and little else
        parts = rnd.sample(passages, 3)
        rows.append((n, " ".join(make(rnd.randrange(1, 12)) + parts[0] + parts[1] + parts[2])))
        n += 1
    for k in range(4, 11):
        short = make(k)
        rows += [(n, " ".join(short)), (n + 1, " ".join([*short, "more"])), (n + 2, " ".join(short))]
        n += 3
    rows += [(n, "one two"), (n + 1, "One two"), (n + 2, "one  two three"), (n + 3, ""), (n + 4, None), (n + 5, " \n")]
    rnd.shuffle(rows)
    return rows


def test_sets_like_words_one_by_one(monkeypatch):
    """Whatever is looked at together: same words, same sets, and none across texts."""
    rnd = random.Random(2)
    texts = [None, "", " ", "a", "A b", "a b c", "a b c d", "a b c d e", "éÉ x\u00a0y z w\x0bv", "a" * 5000 + " b c d",
             "A" * 5000 + "\nb\tc  d", "a" * 4999 + " b c d"]
    texts += [" ".join(rnd.choice(["on", "no", "an", "na", "w" * rnd.randrange(1, 9)]) for _ in range(rnd.randrange(60)))
              for _ in range(300)]
    column = join.pa.array(texts)
    want = [frozenset(shingles(t)) for t in texts]
    seen = None
    for piece in (1 << 20, 100, 1):
        monkeypatch.setattr(join, "PIECE", piece)
        got = [tuple(x.tolist()) for x in join.sets_of(column)]
        assert [len(x) for x in got] == [len(x) for x in want]
        assert seen is None or got == seen
        seen = got
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
    assert [tuple(x.tolist()) for x in join.sets_of(column.slice(5, 4))] == got[5:9]


@pytest.mark.parametrize("frequent, sets", [(-100, 1500), (3, 10)])
def test_components_like_brute_force(spark, monkeypatch, frequent, sets):
    """By runs alone, and by both kinds of keys with large clusters cut into blocks."""
    monkeypatch.setattr(join, "FREQUENT", frequent)
    monkeypatch.setattr(join, "BLOCK_SETS", sets)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rep int").repartition(4)
    got = {r.doc_id: r for r in join.joined(docs).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute(rows)
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in rows)


def test_linked_sets_share_a_key():
    """Whatever is rare or frequent, for sets right at the threshold."""
    rng = np.random.default_rng(6)
    for n in [*range(5, 60), 200, 1000]:
        for _ in range(30):
            counts = np.where(rng.random(join.BUCKETS) < rng.choice([0.0, 0.02, 0.5, 1.0]), 10**6, 1)
            classes = join.Classes(counts) if rng.random() < 0.2 or n < 6 else classes  # noqa: F821
            classes.cut = 10
            tokens = np.unique(rng.integers(0, 2**63, 2 * n).astype(np.uint64))
            rng.shuffle(tokens)
            s = int(rng.integers(-(-85 * n // 100), 100 * n // 85 + 1))
            both = -(-85 * (n + s) // 185)
            if both > min(n, s):
                continue
            a, b = tokens[:n], np.concatenate([tokens[:both], tokens[n : n + s - both]])
            (one, x), (two, y) = join.keys_of(np.sort(a), classes), join.keys_of(np.sort(b), classes)
            same = set(one.tolist()) & set(two.tolist())
            assert len(same) >= max(x, y) or n == s == both


def test_a_group_costs_one_comparison_a_set(monkeypatch):
    calls = []
    search = np.searchsorted
    monkeypatch.setattr(join.np, "searchsorted", lambda *a: calls.append(1) or search(*a))
    base = np.arange(1000, dtype=np.uint64)
    sets = [np.concatenate([base, np.array([2000 + i], np.uint64)]) for i in range(300)]
    joined = join.linked(sets, [list(range(50))] * 300, list(range(300)))
    assert joined == [(i, 0) for i in range(1, 300)] and len(calls) == 299


def test_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text), (None, text), (None, "of its own and of nobody else"),
            (3, "another text of that id here"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.joined(docs).collect()), key=repr)
    assert got == sorted([(5, 47, 3), (5, 47, 3), (3, 47, 3), (None, 47, 3), (None, 4, None), (3, 3, 3),
                          (None, 0, None)], key=repr)
    assert join.joined(docs.limit(0)).collect() == []


def test_given_data(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.component_id for r in join.joined(docs).collect()}
    assert got == want and any(i != c for i, c in want.items())


def test_linked_sizes_are_of_classes_next_to_each_other(spark):
    sizes = spark.range(1, 60000).withColumnRenamed("id", "n")
    for percent in (50, 80, 85, 99, 100):
        most = F.expr(f"100 * n div {percent}")
        two = sizes.withColumn("low", join.size_class(percent)).withColumn("n", most).withColumn(
            "high", join.size_class(percent))
        assert two.filter("high - low not between 0 and 1").count() == 0


def test_sets_of_unlike_sizes_are_no_cluster(spark):
    """A key that sets of all sizes have joins those only that may be linked."""
    sizes = {1: 10, 2: 100, 3: 11, 4: 1000, 5: 95, 6: 3, 7: 7000}
    known = spark.createDataFrame(
        [(i, n, 1, [77]) for i, n in sizes.items()], "rep long, n long, need int, keys array<bigint>")
    assert sorted(tuple(r) for r in join.clusters(known).collect()) == [(1, 1), (2, 2), (3, 1), (5, 2)]


def test_sets_meet_blocks_of_their_size_only(spark, monkeypatch):
    """Once in one group at least if they may be linked; a set is not copied to all blocks."""
    monkeypatch.setattr(join, "BLOCK_SETS", 5)
    rnd = random.Random(8)
    n = {i: rnd.randrange(5, 4000) for i in range(150)}
    rest = spark.createDataFrame([(i, 1, k) for i, k in n.items()], "num long, cluster long, n long")
    rows = join._paired(rest.withColumn("band", join.size_class(85))).collect()
    met = {}
    for r in rows:
        met.setdefault((r.low, r.step, r.left, r.right), set()).add(r.num)
    together = {(a, b) for g in met.values() for a in g for b in g}
    assert {(a, b) for a in n for b in n if 100 * min(n[a], n[b]) >= 85 * max(n[a], n[b])} <= together
    assert len(rows) < len(n) * (len(n) // 5) / 2
