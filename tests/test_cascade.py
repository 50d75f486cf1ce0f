"""Deletion on large tables: what moves."""

from pyspark.sql import functions as F

from quirebind.operators import ledger


def test_deletion_moves_ids_alone_and_sorts_nothing(spark):
    jobs = spark.createDataFrame(
        [("a", "u", "ka", None), ("b", "u", "kb", ""), ("b", "w", "kc", "kd"), (None, "u", "ke", "")],
        "job_id string, user_id string, file_key string, bundle_key string")
    jobs = jobs.withColumn("error_message", F.lit("x" * 100))
    logs = spark.createDataFrame(
        [("a", "1"), ("b", "2"), (None, "3"), ("c", None)], "job_id string, log_id string")
    asked = spark.createDataFrame([("b", "u"), ("a", "w"), (None, "u")], "job_id string, user_id string")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        rows = ledger.cascade_rows(jobs, logs, asked)
        got = sorted((r.kind, r.id) for r in rows.fillna("", ["id"]).collect())
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert got == [("job", ""), ("job", "a"), ("log", ""), ("log", "1"), ("log", "3"),
                   ("removed object", "kb"), ("removed object", "kc"), ("removed object", "kd")]
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
