"""Groups of any size: one plan, one shape."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quirebind.operators import bundle, ledger, ordered, segment


def events(spark):
    """Two thirds of the rows in one group, some without a key."""
    n = F.col("id")
    key = F.when(n % 3 < 2, "hot").when(n % 50 == 2, None).otherwise(
        F.concat(F.lit("k"), (n % 50).cast("string")))
    return spark.range(3000).repartition(5).select(
        key.alias("k"), n.alias("i"), F.when(n % 7 > 0, F.concat(F.lit("v"), n.cast("string"))).alias("v"),
    )


def test_previous_is_what_the_window_gives(spark):
    df = events(spark)
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("i")))
    split = ordered.previous_within(df, ["k"], ["i"], "v", "p", F.floor(F.col("i") / 100))
    assert split.columns == plain.columns
    rows = lambda d: sorted(map(repr, d.collect()))
    assert rows(split) == rows(plain) and split.count() == 3000


def audit(spark, n):
    return spark.range(n).select(
        F.lit("b").alias("job_id"), F.format_string("l%07d", "id").alias("log_id"),
        F.lit("S").alias("step"), F.lit("INFO").alias("status"),
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"),
        F.timestamp_seconds(F.col("id")).alias("created_at"),
    )


@pytest.mark.parametrize("n", [0, 1, 10_001, 1_000_001])
def test_history_has_one_shape_at_every_length(spark, n):
    docs = spark.createDataFrame(
        [("b", "a.txt", "x"), ("c", "c.txt", "y")], "job_id string, filename string, text string"
    )
    log = bundle.bundle_log(segment.with_units(docs), audit(spark, n))
    counts = {(r.job_id, r.section): r["count"] for r in log.groupBy("job_id", "section").count().collect()}
    want = {("b", 0): 1, ("b", 1): n, ("b", 2): 1, ("c", 0): 1, ("c", 2): 1}
    assert counts == {k: v for k, v in want.items() if v}
    if n == 10_001:
        rows = sorted(log.filter("job_id = 'b'").collect(), key=lambda r: (r.section, r.created_at or 0, r.log_id or ""))
        text = "".join(r.content for r in rows)
        assert text.count(" | S | INFO | m") == n
        assert text.index("| m9999 |") < text.index("| m10000 |")


@pytest.mark.parametrize("n", [1, 10_001])
def test_trace_has_a_row_per_audit_row(spark, n):
    jobs = spark.createDataFrame(
        [("b", None, None), ("c", "x", None)],
        "job_id string, bundle_key string, error_message string",
    )
    trace = ledger.job_trace(jobs, audit(spark, n))
    assert trace.filter("job_id = 'b' and log_id is not null").count() == n
    assert trace.filter("job_id = 'c'").select("log_id", "step").collect() == [(None, None)]


def test_transitions_keep_jobs_without_an_id_and_run_nothing_early(spark):
    rows = [(None, 1, "PENDING"), (None, 250_000, "PROCESSING"), ("a", 2, "PENDING"), ("a", 3, "COMPLETED")]
    df = spark.createDataFrame(rows, "job_id string, seq long, status string")
    spark.sparkContext.setJobGroup("plan", "making a plan")
    steps = ledger.status_transitions(df)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    got = {(r.job_id, r.seq): (r.previous, r.legal) for r in steps.collect()}
    assert got == {(None, 1): (None, True), (None, 250_000): ("PENDING", True), ("a", 2): (None, True),
                   ("a", 3): ("PENDING", False)}
