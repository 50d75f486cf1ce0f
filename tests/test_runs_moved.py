"""Runs of a table stored by key: how often rows move."""

from pyspark.sql import functions as F

from quirebind.sources import keyed


def test_rows_of_a_run_move_once(spark, tmp_path, monkeypatch):
    plans = []
    store = keyed._store

    def kept(dealt, path, buckets):
        plans.append(dealt._jdf.queryExecution().executedPlan().toString())
        store(dealt, path, buckets)

    monkeypatch.setattr(keyed, "_store", kept)
    runs = keyed.KeyedRuns(
        spark, str(tmp_path / "t"), "k long, v string", ["k"], fan=2, rows_per_bucket=10)
    for n in range(2):
        path = str(tmp_path / f"in{n}")
        spark.range(n * 50, n * 50 + 100).select(
            F.col("id").alias("k"), F.lit(f"v{n}").alias("v")).write.parquet(path)
        runs.write(spark.read.parquet(path), n)
    assert len(plans) == 3 and all(p.count("Exchange hashpartitioning") == 1 for p in plans)
    got = {r.k: (r.v, r.batch_id) for r in runs.current().collect()}
    assert got == {k: ("v0", 0) if k < 50 else ("v1", 1) for k in range(150)}
