import random
import re

import pytest
from pyspark.sql import functions as F

from quirebind.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_repeats(tokens, window=8):
    where = {}
    for i in range(len(tokens) - window + 1):
        where.setdefault(tuple(tokens[i : i + window]), []).append(i)
    inside = {k + j for v in where.values() if len(v) > 1 for k in v for j in range(window)}
    return len(inside)


def test_repeated_words_like_brute_force():
    rnd = random.Random(1)
    for _ in range(200):
        tokens = [rnd.choice("ab") for _ in range(rnd.randrange(40))]
        tokens += tokens[: rnd.randrange(20)]
        for window in (1, 2, 3, 5, 8):
            assert quality.repeated_words(tokens, window) == slow_repeats(tokens, window)


def test_votes_and_patterns_round_trip():
    v = [1, 0, -1] * 3
    assert quality.votes_of(quality.pattern_of(v)) == v


def test_odd_rows_and_carried_columns(spark):
    good = "The old house by the river is where we lived for many years. " * 1 + (
        "In the spring the water was high, and the road to the village was closed. "
        "We had to take the boat, which the children liked, and it was a good time for all of us. "
        "The summer was dry and we walked to the village on the long road behind the old mill."
    )
    junk = "\n".join(f"w{i}*** x{i}%%% y{i}### z{i}$$$ v{i}&&&" for i in range(12))
    rows = [(1, good, "k"), (2, junk, "k"), (3, None, "k"), (4, "", None), (None, good, "x"),
            (1, good, "k"), (7, "one two three", "k"), (8, " \n\t ", "k")]
    rows += [(100 + i, good.replace("river", f"river{i}"), "k") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    report = quality.quality_report(docs).collect()
    assert len(report) == len(rows)
    kept = {r.doc_id: r.kept for r in report}
    assert kept[1] and kept[None] and not kept[2]
    assert not (kept[3] or kept[4] or kept[7] or kept[8])
    by = {r.doc_id: r for r in report}
    assert by[3].n_words == 0 and by[3].base_failed and by[7].n_words == 3
    assert by[2].n_symbols == sum(junk.count(c) for c in "#*$%&|<>")
    stay = quality.keep_good(docs)
    assert stay.columns == docs.columns
    assert stay.filter(F.col("doc_id") == 1).count() == 2
    empty = docs.limit(0)
    assert quality.quality_report(empty).collect() == []
    assert quality.keep_good(empty).collect() == []


def test_labels_are_met(spark, sf_small):
    """Rejected without labels, compared with them."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    report = quality.quality_report(docs).drop("quality")
    both = report.join(labels, "doc_id").filter("not base_failed")
    rows = both.select("kept", F.col("quality").alias("label")).collect()
    clean = [r.kept for r in rows if r.label == 1]
    bad = [r.kept for r in rows if r.label == 0]
    assert sum(clean) >= 0.97 * len(clean)
    assert sum(bad) <= 0.2 * len(bad)


@pytest.mark.parametrize("counts", [{}, {quality.pattern_of([1] * 9): 5}])
def test_fit_of_little(counts):
    p = quality.fit(counts)
    assert all(x > 0.5 for x in p.values())
