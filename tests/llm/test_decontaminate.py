import re

import pytest

from quirebind.llm import decontaminate as dc

ITEM = "Yesterday at noon the old baker from Paris sold 7 loaves to John for 9.25 euros and then gave John one more"
DOCS = [
    (1, ITEM), (2, "before it " + ITEM.upper().replace("PARIS", "Paris").replace("JOHN", "John") + " after"),
    (3, "yesterday at noon the old baker from Lyon sold 12 loaves to Mary for 3.50 euros and then gave Mary one more"),
    (4, "yesterday at noon the old baker from Lyon sold 12 loaves to Mary for 3.50 euros and then gave Paul one more"),
    (5, None), (6, ""), (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (None, ITEM), (1, ITEM),
    (9, "short words"), (10, "it has nothing to do with that baker in Paris at all and never had"),
]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in DOCS], "doc_id long, text string, hash string")
    items = spark.createDataFrame(
        [(1, ITEM, 1), (2, None, 1), (3, "too short", 1), (4, "1 2 3 4 5 6 7 8 9", 1), (None, "", 1)],
        "item_id long, text string, share int",
    )
    return docs, items


def test_questions_with_other_values(tables):
    docs, items = tables
    rows = dc.leak_report(docs, items).collect()
    assert len(rows) == len(DOCS)
    leaked = [(r.doc_id, r.verbatim) for r in rows if r.contaminated]
    assert sorted(leaked, key=repr) == sorted([(1, True), (1, True), (2, True), (3, False), (None, True)], key=repr)
    assert all(r.item_ids == ([1] if r.contaminated else []) for r in rows)
    kept = dc.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 7, 9, 10]


def test_empty_tables(tables):
    docs, items = tables
    assert dc.leak_report(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in dc.leak_report(docs, items.limit(0)).collect())
    assert not re.search("Python|Pandas|Arrow", dc.leak_report(docs, items)._jdf.queryExecution().toString())


def test_like_brute_force(spark, sf_small):
    """Documents that share a row of words with an item, by plain search."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = {tuple(w[i : i + 8]) for r in items.collect() for w in [words(r.text)] for i in range(len(w) - 7)}
    want = {r.doc_id for r in docs.collect() for w in [words(r.text)]
            if sum(tuple(w[i : i + 8]) in grams for i in range(len(w) - 7)) > 3}
    got = {r.doc_id for r in dc.leak_report(docs, items).collect() if r.contaminated}
    assert got == want and want


def test_rows_of_one_id_are_judged_each(spark, tables):
    _, items = tables
    words = ITEM.split()
    parts = [" ".join(words[i : i + 10]) for i in (0, 4, 8)]  # three of the windows each
    rows = [(i, t) for i in (None, 7) for t in [ITEM, "nothing of it", None, *parts]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dc.leak_report(docs, items, share=0.5).collect()
    assert sorted(((r.doc_id, r.contaminated) for r in found), key=repr) == sorted(
        [(i, t == ITEM) for i, t in rows], key=repr)
    kept = dc.without_leaks(docs, items, share=0.5)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([r for r in rows if r[1] != ITEM], key=repr)


def test_short_numeric_and_title_case_items(spark):
    texts = ["What is 7 times 8?", "Add 1 2 3 4 5 6 7 8 9 10 11 12 13",
             "the quiet river ran past the old stone mill before dawn"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(0, f"He asked: {texts[0].upper()} Nobody knew."), (1, f"so {texts[1]} and stop"), (2, texts[2].title()),
            (3, "What is 7 times 9?"), (4, "Add 1 3 5 7 9 11 13 2 4 6 8 10"), (5, "The Quiet Town Slept Before Dawn")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.item_ids, r.verbatim) for r in dc.leak_report(docs, items).collect()}
    assert got == {i: ([i], True) if i < 3 else ([], False) for i, _ in rows}


def test_items_of_a_word_or_two_are_leaks_only_alone(spark):
    items = spark.createDataFrame([(1, "Yes"), (2, "so be it")], "item_id long, text string")
    rows = [(1, "Yes."), (2, "Yes, they said."), (3, "so be it!"), (4, "may so be it"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in dc.leak_report(docs, items).collect()}
    assert got == {1: [1], 2: [], 3: [2], 4: [], 5: [], 6: []}
