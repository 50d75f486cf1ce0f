"""Job messages as a stream.

The stream is the batch conversion per micro-batch.  A message counts as
handled once its batch has written its folder; failures of single documents
are rows, so they never stop the stream and are not tried again.

Messages count in the order they arrived, whatever their senders' clocks say.  A batch
looks up the states, audit rows and documents of its own jobs by key, so it does not get
dearer as the ledger grows.
"""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quirebind import fixed
from quirebind.operators.intake import (
    dead_letters, first_deliveries, parse_messages, without_completed,
)
from quirebind.plans.convert import audit_rows, convert_corpus, history_of
from quirebind.sources import messages as arrivals
from quirebind.sources import results as store
from quirebind.sources.keyed import KeyedTable

Step = Callable[[str, int], None]


def _rows_of(table: DataFrame | KeyedTable, asked: DataFrame) -> DataFrame:
    return table.only(asked) if isinstance(table, KeyedTable) else table


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def process_batch(
    batch: DataFrame,
    batch_id: int,
    documents: DataFrame | KeyedTable,
    logs: DataFrame | KeyedTable,
    root: str,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    done: Step = lambda step, batch_id: None,
) -> None:
    """Handle one micro-batch (value, place): dead letters, intake, conversion.

    ``done`` is told of each step that is written.
    """
    spark = batch.sparkSession
    at = F.lit(now()).cast("timestamp")
    runs = store.runs(spark, root)

    def write(rows: DataFrame, name: str) -> DataFrame:
        store.write_batch(rows, root, name, batch_id)
        done(name, batch_id)
        return store.read_batch(spark, root, name, batch_id)

    arrived, seen = Observation(), Observation()
    parsed = parse_messages(arrivals.with_arrival(batch)).persist()  # each is decoded once
    told = parsed.observe(
        arrived, F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("problem").isNotNull()).alias("letters"),
        F.min(F.unix_micros("arrival.file_modification_time")).alias("oldest"),
    )
    write(dead_letters(told).drop("arrival"), store.LETTERS)
    deliveries, delivered = _counted(first_deliveries(parsed).drop("arrival"))
    deliveries = write(deliveries, store.DELIVERIES)
    parsed.unpersist()

    # A replay must not see what this very batch wrote before.
    completed = runs.states.before(batch_id, deliveries).filter(F.col("status") == fixed.COMPLETED)
    messages = write(without_completed(deliveries, completed), store.INTAKE)

    converted = convert_corpus(messages, documents, at).withColumn("generated_at", at)
    staged = write(converted, store.STAGED)
    state = lambda s: F.count_if(F.col("status") == s)
    counted = staged.drop("entries").observe(
        seen, F.count(F.lit(1)).alias("rows"), state(fixed.COMPLETED).alias("completed"),
        state(fixed.INVALID).alias("invalid"), state(fixed.FAILED).alias("failed"),
    )
    results = write(counted, store.RESULTS)
    earlier = runs.audit.before(batch_id, messages).select(*store.AUDIT_COLUMNS)
    base = _rows_of(logs, messages).select(*store.AUDIT_COLUMNS)
    write(history_of(messages, base.unionByName(earlier)), store.LOG_LINES)

    runs.bundles.write(
        staged.filter(F.col("status") == fixed.COMPLETED).select("job_id", "entries"), batch_id)
    done("bundles", batch_id)
    audit = audit_rows(results, F.lit(batch_id), F.col("generated_at"))
    runs.audit.write(audit.select(*store.AUDIT_COLUMNS), batch_id)
    done("audit", batch_id)
    runs.states.write(
        results.select("job_id", "status", "bundle_key", "error_message", "units_count"), batch_id)
    done("states", batch_id)
    got, state_counts = arrived.get, seen.get
    first = delivered.get["rows"]
    waited = now().timestamp() - got["oldest"] / 1e6 if got["oldest"] else None
    progress = (
        got["messages"], got["letters"], first, first - state_counts["rows"],
        state_counts["completed"], state_counts["invalid"], state_counts["failed"], waited,
    )
    fields = store.SCHEMAS[store.PROGRESS].removesuffix(", batch_id bigint")
    write(spark.createDataFrame([progress], fields), store.PROGRESS)
    # What is staged is in the tables now; the last batch's is left for its replay's readers.
    store.drop_batch(spark, root, store.STAGED, batch_id - 1)


def start_intake(
    spark: SparkSession,
    message_folder: str,
    root: str,
    documents: DataFrame | KeyedTable,
    logs: DataFrame | KeyedTable,
    files_per_batch: int = 100,
    interval: str | None = None,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    done: Step = lambda step, batch_id: None,
) -> StreamingQuery:
    """Start reading message files (a JSON message per line).

    ``files_per_batch`` bounds a batch.  Without an ``interval`` the stream
    takes what is there and stops; with one ('3 seconds') it keeps running.
    """
    store.prepare(spark, root)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        arrivals.read_stream(spark, message_folder, files_per_batch)
        .writeStream.foreachBatch(
            lambda batch, batch_id: process_batch(
                batch, batch_id, documents, logs, root, now, done
            )
        )
        .option("checkpointLocation", f"{root}/progress")
        .trigger(**trigger)
        .start()
    )
