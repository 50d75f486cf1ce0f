"""What a stream over large tables rests on: passes, and plans that are built once."""

import os
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quirebind.operators import segment
from quirebind.plans.convert import convert_corpus
from quirebind.sources.keyed import KeyedTable
from quirebind.workload import fixtures as fx


def test_message_files_are_made_in_one_pass_and_come_in_order(spark, tmp_path):
    """Files by slice of the arrivals; one without messages is there, too."""
    n = [*range(40), *range(120, 160), None]
    pq.write_table(pa.table({
        "event_id": pa.array(n, pa.int64()), "user_id": pa.array([1] * len(n), pa.int64()),
        "event_type": ["a"] * len(n),
    }), tmp_path / "events.parquet")
    folder = tmp_path / "messages"
    group = "one pass"
    spark.sparkContext.setJobGroup(group, "")
    try:
        assert fx.message_files(spark, str(tmp_path), str(folder)) == 8
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6  # two of them were made for every file
    files = sorted((f for f in folder.iterdir() if f.suffix == ".txt"), key=lambda f: f.stat().st_mtime_ns)
    assert files == sorted(files) and len({f.stat().st_mtime_ns // 10**6 for f in files}) == fx.FILES
    sizes = [len(f.read_text().splitlines()) for f in files]
    assert sizes == [40, 0, 0, 40]
    made = fx.messages(spark, str(tmp_path)).filter("arrival is not null").orderBy("arrival").collect()
    assert [x for f in files for x in f.read_text().splitlines()] == [r.value for r in made]


def test_columns_of_the_conversion_are_built_once(spark, monkeypatch):
    calls = []
    fold = segment._fold_chunks
    monkeypatch.setattr(segment, "_fold_chunks", lambda *a: calls.append(1) or fold(*a))
    asked = spark.createDataFrame(
        [], "job_id string, user_id string, original_filename string, file_key string")
    docs = spark.createDataFrame([], "file_key string, text string")
    at = F.lit(datetime(2024, 6, 1, tzinfo=timezone.utc)).cast("timestamp")
    for _ in range(3):
        assert convert_corpus(asked, docs, at).count() == 0
    assert len(calls) <= 1


def test_rows_by_key_are_stored_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k long, v string", ["k"])
    table.write(spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v")), 4)
    assert os.listdir(tmp_path / "t") == ["rows"]
    asked = spark.range(100).select(F.col("id").alias("k"))
    assert table.known(asked).columns == ["k"] and table.known(asked).count() == 100
    assert table.of(asked.filter("k < 1")).count() < 100
