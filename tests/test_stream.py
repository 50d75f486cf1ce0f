"""The stream: equals the batch, survives restarts and replays."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quirebind.operators import intake, ledger
from quirebind.plans.convert import audit_rows, convert_corpus, status_events
from quirebind.sources import documents as sources
from quirebind.sources import results as store
from quirebind.streaming.intake import start_intake

NOW = datetime(2024, 6, 1, 12, 30, 45, tzinfo=timezone.utc)
TEXTS = {
    1: ("a.txt", "corto"), 2: ("b.md", "# A\n\nx\n# B\n\ny"), 3: ("c.md", "# A\n# [x](x.md)\n\ny"),
    4: ("d.md", None),
}


def uid(n):
    return f"00000000-0000-4000-8000-{n:012d}"


@pytest.fixture
def world(spark, tmp_path):
    """Stored files, an accepted job per text (4 has no file), message files."""
    uploads = spark.createDataFrame(
        [(str(n), uid(9), name, NOW) for n, (name, _) in TEXTS.items()],
        "upload_id string, user_id string, filename string, created_at timestamp",
    )
    made = intake.accept_jobs(uploads)
    jobs = {r.original_filename: r for r in made["jobs"].collect()}
    root = tmp_path / "store"
    for name, text in TEXTS.values():
        if text is not None:
            path = root / jobs[name].file_key
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(text.encode())
    values = [r.value for r in made["messages"].collect()]
    folder = tmp_path / "messages"
    folder.mkdir()
    for i, lines in enumerate([values[:2], ["{broken"] + values[1:], values]):
        (folder / f"{i}.json").write_text("\n".join(lines))
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    logs = spark.createDataFrame(made["logs"].collect(), made["logs"].schema)
    return {
        "documents": sources.scan_files(spark, str(root)), "logs": logs, "jobs": jobs,
        "messages": str(folder), "root": str(tmp_path / "ledger"),
        "values": values,
    }


def run(spark, world):
    start_intake(
        spark, world["messages"], world["root"], world["documents"], world["logs"],
        files_per_batch=1, now=lambda: NOW,
    ).awaitTermination()


def results(spark, world):
    return store.read_table(spark, world["root"], store.RESULTS)


def states(df):
    latest = ledger.latest_status(status_events(df, F.col("batch_id")))
    return sorted(
        (r.job_id, r.status, r.bundle_key, r.error_message, r.units_count) for r in latest.collect()
    )


def test_stored_files_are_read_whole(spark, world):
    rows = {r.filename: r for r in world["documents"].collect()}
    assert len(rows) == 3
    (two,) = [r for r in rows.values() if r.text == TEXTS[2][1]]
    assert two.file_key == world["jobs"]["b.md"].file_key and two.bytes == len(TEXTS[2][1])


def test_stream_equals_batch_and_replays(spark, world):
    run(spark, world)
    got = results(spark, world)
    parsed = intake.parse_messages(
        spark.createDataFrame([(v,) for v in world["values"]], "value string")
    ).withColumn("arrival", F.col("timestamp"))
    none = spark.createDataFrame([], "job_id string")
    batch = convert_corpus(
        intake.idempotent_intake(parsed, none), world["documents"], F.lit(NOW).cast("timestamp"),
    ).withColumn("batch_id", F.lit(0))
    assert states(got) == states(batch)
    by_name = {j: r.job_id for j, r in world["jobs"].items()}
    status = {(r.job_id, r.batch_id): r.status for r in got.collect()}
    # Completed jobs are skipped later; refused and missing ones are taken up again.
    assert status == {
        (by_name["a.txt"], 0): "COMPLETED", (by_name["b.md"], 0): "COMPLETED",
        (by_name["c.md"], 1): "INVALID", (by_name["d.md"], 1): "FAILED",
        (by_name["c.md"], 2): "INVALID", (by_name["d.md"], 2): "FAILED",
    }
    letters = store.read_table(spark, world["root"], store.LETTERS).collect()
    assert [(r.value, r.problem, r.batch_id) for r in letters] == [("{broken", "json", 1)]

    # Lose the last commit: the batch is done again and changes nothing.
    before = sorted(map(repr, got.collect()))
    os.remove(f"{world['root']}/progress/commits/2")
    crc = f"{world['root']}/progress/commits/.2.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run(spark, world)
    got = results(spark, world)
    assert sorted(map(repr, got.collect())) == before

    # Published entries, with the history as it stood.
    entries = store.read_entries(spark, world["root"]).collect()
    assert {e.bundle_id for e in entries} == {by_name["a.txt"], by_name["b.md"]}
    log = [e for e in entries if e.bundle_id == by_name["a.txt"] and e.path == "log.md"]
    log.sort(key=lambda e: (e.section, str(e.created_at), e.log_id or ""))
    text = "".join(e.content for e in log)
    assert text.count("| 12:30:45 |") == 2
    assert text.index("RECEPCION") < text.index("PROCESAMIENTO")

    audit = audit_rows(got, F.col("batch_id"), F.col("generated_at"))
    steps = {}
    for r in audit.orderBy("job_id", "created_at").collect():
        steps.setdefault(r.job_id, []).append(r.step)
    assert steps[by_name["a.txt"]] == ["PROCESAMIENTO", "PUBLICACION"]
    assert sorted(steps[by_name["c.md"]]) == ["PROCESAMIENTO"] * 2 + ["VALIDACION"] * 2
    assert steps[by_name["d.md"]] == ["PROCESAMIENTO"] * 2
