"""Written results, one folder per batch, and what grows over the batches by key.

A batch writes its own folder and nothing else, replacing it as a whole.  So a
batch that is done again, after a failure at any point, leaves what one run
would have left, and readers of batch N look at smaller numbers only.  Job states,
audit rows and published bundles are ``KeyedRuns``: a batch looks up its own jobs.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.operators.ledger import without_deleted
from quirebind.sources.keyed import Folders, KeyedRuns

RESULTS, LETTERS, DELIVERIES, INTAKE, STAGED, LOG_LINES, DELETED, PROGRESS = (
    "results", "dead_letters", "deliveries", "intake", "staged", "log_lines", "deleted", "batches",
)
_ENTRIES = "array<struct<path: string, section: int, content: string>>"
_STATE = "status string, bundle_key string, error_message string, units_count int"
_MESSAGE = "job_id string, user_id string, original_filename string, file_key string, timestamp string"
_RESULT = (
    f"job_id string, user_id string, original_filename string, {_STATE}, warnings array<string>, "
    "generated_at timestamp"
)
SCHEMAS = {
    RESULTS: f"{_RESULT}, batch_id bigint",
    STAGED: f"{_RESULT}, entries {_ENTRIES}, batch_id bigint",
    LETTERS: "value string, problem string, batch_id bigint",
    DELIVERIES: f"{_MESSAGE}, batch_id bigint",
    INTAKE: f"{_MESSAGE}, batch_id bigint",
    LOG_LINES: "job_id string, section int, created_at timestamp, log_id string, "
    "content string, batch_id bigint",
    DELETED: "job_id string, batch_id bigint",
    PROGRESS: "messages bigint, dead_letters bigint, deliveries bigint, skipped bigint, "
    "completed bigint, invalid bigint, failed bigint, waited_seconds double, batch_id bigint",
}
AUDIT_COLUMNS = ["log_id", "job_id", "step", "status", "message", "created_at"]


@dataclass
class Runs:
    """What a batch looks up by key: job states, audit rows, published bundles."""

    states: KeyedRuns
    audit: KeyedRuns
    bundles: KeyedRuns


def runs(spark: SparkSession, root: str) -> Runs:
    audit = (
        "log_id string, job_id string, step string, status string, message string, "
        "created_at timestamp"
    )
    return Runs(
        KeyedRuns(spark, f"{root}/states", f"job_id string, {_STATE}", ["job_id"]),
        KeyedRuns(spark, f"{root}/audit", audit, ["job_id"], newest=False),
        KeyedRuns(spark, f"{root}/bundles", f"job_id string, entries {_ENTRIES}", ["job_id"],
                  rows_per_bucket=1000),
    )


def prepare(spark: SparkSession, root: str) -> None:
    """Create the (empty) tables, so that the first batch can read them."""
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.mode("append").partitionBy("batch_id").parquet(
            f"{root}/{name}"
        )


def write_batch(rows: DataFrame, root: str, name: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def read_batch(spark: SparkSession, root: str, name: str, batch_id: int) -> DataFrame:
    """One batch's rows; no other folder is listed."""
    own = SCHEMAS[name].removesuffix(", batch_id bigint")
    return spark.read.schema(own).parquet(f"{root}/{name}/batch_id={batch_id}")


def drop_batch(spark: SparkSession, root: str, name: str, batch_id: int) -> None:
    Folders(spark, root).drop(f"{root}/{name}/batch_id={batch_id}")


def entry_rows(bundles: DataFrame) -> DataFrame:
    """Bundles with their entries (job_id, entries) to a row per entry."""
    return bundles.select(
        F.col("job_id").alias("bundle_id"), F.inline_outer("entries")
    ).filter("path is not null")


def read_entries(spark: SparkSession, root: str) -> DataFrame:
    """Entries of the published bundles: bundle_id, path, section, created_at, log_id,
    content.  Of a bundle published again the last batch's entries count; jobs in the
    table of the deleted have none any more.
    """
    done = without_deleted(
        runs(spark, root).bundles.current(), read_table(spark, root, DELETED)
    )
    own = entry_rows(done).withColumns({
        "created_at": F.lit(None).cast("timestamp"), "log_id": F.lit(None).cast("string"),
    })
    lines = read_table(spark, root, LOG_LINES).join(
        done.select("job_id", "batch_id"), ["job_id", "batch_id"], "left_semi"
    )
    return own.unionByName(lines.select(
        F.col("job_id").alias("bundle_id"), F.lit(fixed.LOG_FILE).alias("path"), "section",
        "created_at", "log_id", "content",
    ))
