"""Stored tables read by key: what is read, what a replay leaves."""

import os
import shutil
from datetime import datetime, timezone
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from quirebind.plans.convert import convert_corpus
from quirebind.session import settle
from quirebind.sources import documents, keyed
from quirebind.sources import results as store
from quirebind.streaming.intake import start_intake

NOW = datetime(2024, 6, 1, 12, 30, 45, tzinfo=timezone.utc)


def files(df):
    return [unquote(urlparse(f).path) for f in df.inputFiles()]


def size(df):
    return sum(map(os.path.getsize, files(df)))


def test_runs_hold_every_batch_once(spark, tmp_path):
    runs = keyed.KeyedRuns(spark, str(tmp_path), "k long", ["k"], fan=3)
    for n in range(200):
        spans = [(upto - 3**power + 1, upto) for power, upto in runs.runs_before(n)]
        assert [b for a, z in spans for b in range(a, z + 1)] == list(range(n))
        assert len(spans) <= 2 * 5


def test_a_batch_reads_as_much_after_twenty_as_after_two(spark, tmp_path):
    runs = keyed.KeyedRuns(
        spark, str(tmp_path / "t"), "k long, v string", ["k"], fan=4, rows_per_bucket=10)
    want, read = {}, {}
    for n in range(21):
        new = spark.createDataFrame([(n * 40 + i, f"v{n}") for i in range(40)], "k long, v string")
        asked = new.filter("k % 40 < 3").union(spark.createDataFrame([(n * 7 % 40, "")], "k long, v string"))
        before = runs.before(n, asked)
        if n in (2, 3, 20):
            read[n] = size(before)
            keys = {r.k for r in asked.collect()}
            assert {r.k: r.v for r in before.collect()} == {k: v for k, v in want.items() if k in keys}
        own = [(r.k, r.v) for r in new.collect()] + ([(n * 7 % 40, f"again{n}")] if n else [])
        runs.write(spark.createDataFrame(own, "k long, v string").coalesce(1), n)
        want |= dict(own)
    assert {r.k: r.v for r in runs.current().collect()} == want
    assert read[20] <= 1.1 * read[2]
    # Two levels of runs and what readers of the last marks need; nothing else stays.
    assert len([u for p in os.listdir(tmp_path / "t") if p.startswith("power")
                for u in os.listdir(tmp_path / "t" / p)]) <= 2 * 6


def test_a_batch_done_again_changes_nothing(spark, tmp_path):
    schema = "k long, v string"
    make = lambda n: spark.createDataFrame([(n, f"{n}"), (99, f"last {n}")], schema)
    runs = keyed.KeyedRuns(spark, str(tmp_path / "a"), schema, ["k"], fan=2)
    for n in range(4):
        runs.write(make(n), n)
    want = sorted(runs.current().collect())
    assert len(want) == 5 and [r.v for r in want if r.k == 99] == ["last 3"]
    runs.write(make(3), 3)
    assert sorted(runs.current().collect()) == want
    # The mark is lost: readers see the batch before, and doing it again gives the same.
    os.remove(tmp_path / "a" / "marks" / "batch=3")
    assert [r.v for r in runs.current().collect() if r.k == 99] == ["last 2"]
    shutil.rmtree(tmp_path / "a" / "power=1" / "upto=3")
    runs.write(make(3), 3)
    assert sorted(runs.current().collect()) == want


def test_texts_asked_for_are_read_once_from_their_folders(spark, tmp_path):
    docs = spark.range(400).select(
        F.col("id").cast("string").alias("file_key"), F.concat(F.lit("# A\n\n"), "id").alias("text"))
    table = keyed.KeyedTable(spark, str(tmp_path / "d"), "file_key string, text string", ["file_key"])
    table.write(docs, 64)
    asked = settle(spark.createDataFrame(
        [("j", "u", "a.md", "7"), ("k", "u", "b.md", "none"), ("l", "u", "c.md", "8")],
        "job_id string, user_id string, original_filename string, file_key string"))
    made = convert_corpus(asked, table, F.lit(NOW).cast("timestamp"))
    assert {r.job_id: r.status for r in made.collect()} == {"j": "COMPLETED", "k": "FAILED", "l": "COMPLETED"}
    texts = table.of(asked)
    assert {r.file_key for r in texts.collect()} >= {"7", "8"}
    folders = {os.path.dirname(f) for f in files(texts)}
    assert 1 <= len(folders) <= 3 and all("/rows/" in f for f in folders)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # Found with and without text, and the missing by keys alone.
    assert plan.count("Relation [file_key") <= 3
    scans = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert scans.count("ReadSchema: struct<file_key:string,text:string>") <= 2
    assert "hashpartitioning(file_key" not in scans


def files_read(df):
    """Files that the scans of an executed plan have opened."""
    found = []

    def walk(node):
        if "Scan" in node.nodeName():
            metric = node.metrics().get("numFiles")
            if metric.isDefined():
                found.append(metric.get().value())
        for inner in ("executedPlan", "plan"):
            if ("Adaptive" in node.nodeName() and inner == "executedPlan") or (
                "QueryStage" in node.nodeName() and inner == "plan"):
                walk(getattr(node, inner)())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_only_files_asked_for_are_opened(spark, tmp_path):
    key = F.concat(F.lit("originals/ü x"), F.col("id") % 7, F.lit("/job%41 "), "id", F.lit(".md"))
    docs = spark.range(120).select(key.alias("file_key"), F.concat(F.lit("text "), "id").alias("text"))
    assert documents.store_files(docs, str(tmp_path)) == 120
    asked = docs.filter("text in ('text 3', 'text 77')").select("file_key")
    got = documents.scan_asked(spark, str(tmp_path), asked)
    assert {(r.file_key, r.text) for r in got.collect()} == {
        (r.file_key, r.text) for r in docs.collect() if r.text in ("text 3", "text 77")}
    assert 2 in files_read(got) and max(files_read(got)) == 2
    assert documents.scan_files(spark, str(tmp_path)).count() == 120


def uid(n):
    return f"00000000-0000-4000-8000-{n:012d}"


def test_messages_count_in_the_order_they_arrive(spark, tmp_path):
    """Senders' times run the other way, one is missing: what came first counts."""
    line = lambda job, name, time: (
        f'{{"job_id":"{uid(job)}","user_id":"{uid(9)}","original_filename":"{name}","file_key":"{name}"'
        + (f',"timestamp":"{time}"' if time else "") + "}")
    folder = tmp_path / "messages"
    folder.mkdir()
    content = [
        [line(1, "first.md", "2024-05-02T00:00:00Z"), line(2, "first.md", None)],
        [line(1, "second.md", "2024-05-01T00:00:00Z"), line(2, "second.md", "2024-01-01T00:00:00Z"),
         line(3, "first.md", "2024-05-09T00:00:00Z"), line(3, "second.md", "2024-05-08T00:00:00Z")],
    ]
    for i, lines in enumerate(content):
        path = folder / f"{9 - i}.json"  # names run the other way, too
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    docs = spark.createDataFrame([("first.md", "x"), ("second.md", "y")], "file_key string, text string")
    logs = spark.createDataFrame([], "log_id string, job_id string, step string, status string, "
                                     "message string, created_at timestamp")
    root = str(tmp_path / "ledger")
    start_intake(spark, str(folder), root, docs, logs, now=lambda: NOW).awaitTermination()
    rows = store.read_table(spark, root, store.RESULTS).collect()
    assert {(r.job_id, r.original_filename) for r in rows} == {(uid(n), "first.md") for n in (1, 2, 3)}
    (batch,) = store.read_table(spark, root, store.PROGRESS).collect()
    assert (batch.messages, batch.deliveries, batch.completed, batch.skipped) == (6, 3, 3, 0)
    assert batch.waited_seconds == pytest.approx(NOW.timestamp() - 1_700_000_000)


def test_many_batches_list_a_stored_table_once(spark, tmp_path, monkeypatch):
    """Batches of many keys, of nearly all buckets: one listing, until it is written again."""
    schema = "k long, v string"
    rows = lambda v: spark.range(2000).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), schema, ["k"]).write(rows("a"), 64)
    listed = []
    for name in ("exists", "names"):
        found = getattr(keyed.Folders, name)
        monkeypatch.setattr(
            keyed.Folders, name, lambda self, path, f=found: listed.append(path) or f(self, path))
    indexes = set()
    for n in range(3):
        asked = spark.range(n * 300, n * 300 + 150).select(F.col("id").alias("k"))
        got = table.only(asked)
        assert sorted(map(tuple, got.collect())) == [(k, "a") for k in range(n * 300, n * 300 + 150)]
        index = got._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location()
        indexes.add(spark._jvm.java.lang.System.identityHashCode(index))
    assert len(indexes) == 1 and not [p for p in listed if f"{keyed.BUCKET}=" in p]
    table.write(rows("b"), 64)
    assert {r.v for r in table.only(spark.range(500).select(F.col("id").alias("k"))).collect()} == {"b"}


def test_buckets_of_a_listed_table_are_pruned(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), "k long", ["k"])
    table.write(spark.range(3000).select(F.col("id").alias("k")), 64)
    for n in (12, 100):
        asked = spark.range(n).select(F.col("id").alias("k"))
        buckets = len(keyed._buckets_of(asked, ["k"], 64))
        assert 8 <= buckets < 64
        got = table.of(asked)
        assert {r.k for r in got.collect()} >= set(range(n)) and got.count() < 3000
        assert max(files_read(got)) == buckets


def test_keys_that_are_null_or_come_twice_are_looked_up_like_others(spark, tmp_path):
    schema = "k long, v string"
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), schema, ["k"])
    table.write(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], schema), 1)
    asked = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    got = table.only(asked)
    assert sorted(map(tuple, got.join(asked, "k", "left_semi").collect())) == [(1, "a"), (1, "a")]
    assert {r.k for r in got.collect()} == {1, None}
