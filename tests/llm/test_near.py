import random
import re

import pytest

import corpus_pipeline as pipeline
from quirebind.llm import graph, near

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower().decode())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


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
    rnd = random.Random(5)
    make = lambda n: [f"w{rnd.randrange(4000)}" for _ in range(n)]
    passage = make(60)
    rows, n = [], 0
    for size in (6, 12, 40, 150, 150, 400):
        base = make(size)
        for k in range(25):
            own = list(base)
            for _ in range(rnd.randrange(0, 1 + max(1, size // 30))):
                own[rnd.randrange(size)] = f"e{rnd.randrange(9999)}"
            rows.append((n, " ".join(own).upper() if k % 3 else "\n".join(own)))
            n += 1
    for _ in range(40):  # a passage that many share, and little else
        rows.append((n, " ".join(make(rnd.randrange(1, 40)) + passage)))
        n += 1
    rows += [(n, "one two"), (n + 1, "One two"), (n + 2, "one  two three"), (n + 3, ""), (n + 4, None), (n + 5, " \n")]
    rnd.shuffle(rows)
    return rows


def test_components_like_brute_force(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rep int").repartition(4)
    want = brute(rows)
    for docs_in_block in (near.BLOCK_DOCS, 10):
        monkeypatch.setattr(near, "BLOCK_DOCS", docs_in_block)
        got = {r.doc_id: r for r in near.near_report(docs).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(want.values())


def test_given_data(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.component_id for r in near.near_report(docs).collect()}
    assert got == want and any(i != c for i, c in want.items())


def test_odd_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text), (None, text), (None, "of its own and of nobody else"), (3, "another text of that id here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near.near_report(docs).collect()), key=repr)
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, 3, False), (None, None, True),
                          (3, 3, True)], key=repr)
    assert near.near_report(docs.limit(0)).collect() == []


def test_components_of_long_paths(spark):
    rnd = random.Random(1)
    ids = list(range(60))
    rnd.shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(39)] + [(ids[i], ids[40]) for i in range(41, 60)]
    df = spark.createDataFrame(edges + edges[:5] + [(1, 1)], "a long, b long")
    got = {r.id: r.component for r in graph.components(df).collect()}
    first, second = min(ids[:40]), min(ids[40:])
    assert got == {i: first if i in ids[:40] else second for i in ids}
    assert graph.components(df.limit(0)).collect() == []


def test_matches_follow_the_threshold():
    assert [near.matches(p) for p in (80, 85, 100)] == [36, 41, 64]
    with pytest.raises(ValueError):
        near.matches(10)


def test_stage_links_from_four_fifths(spark):
    rnd = random.Random(8)
    rows = corpus()
    for n in range(1000, 1400, 2):  # pairs around 0.8: one end of a row replaced
        words = [f"v{rnd.randrange(10**6)}" for _ in range(104)]
        k = rnd.choice([9, 10, 11, 12])
        rows += [(n, " ".join(words)), (n + 1, " ".join(words[:-k] + [f"x{n}-{i}" for i in range(k)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = set(brute(rows, 80).values())
    assert want < set(brute(rows).values())
    assert {r.doc_id for r in pipeline.near_dedup(spark, docs, "").collect()} == want


def test_one_row_of_each_stays(spark):
    make = lambda w, n=60: " ".join(f"{w}{i}" for i in range(n))
    rows = [
        (5, make("a"), "x"), (5, make("a"), "x"), (None, make("a"), "x"), (7, make("a").upper(), "x"),
        (None, make("b"), "x"), (None, make("b"), "y"), (None, make("b") + " more", "x"), (None, make("c"), "x"),
        (7, make("d"), "x"), (7, make("e"), "x"), (8, make("e") + " more", "x"), (7, make("f"), "x"), (7, make("f") + " too", "x"),
        (7, None, "x"), (7, None, "x"), (None, "", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string").repartition(3)
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, (r.text or "")[:1].lower()) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted([
        (5, "a"), (None, "b"), (None, "c"), (7, "d"), (7, "e"), (7, "f"), (7, ""), (7, ""), (None, ""),
    ], key=repr)
    assert near.one_of_each(docs.limit(0)).collect() == []
