"""Messages and documents to validated bundles.

Shuffles: the messages meet the documents on file key.  That join is an inner one
against a table of known size, so Spark broadcasts the messages while they are
below its threshold, which leaves the texts where they are;
beyond it the texts move once, by file key, and AQE splits a hot key.  Of documents
stored by key only the buckets asked for are opened, and each text once.  Messages
without a document are found on keys alone.  Everything after the join stays inside
the row.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names
from quirebind.functions.built import built_once
from quirebind.operators.bundle import entries_column, history_lines, index_text, log_ends
from quirebind.operators.segment import with_units
from quirebind.operators.validate import dead_links, links, verdict_errors
from quirebind.sources.keyed import KeyedTable


def _started_line(at: Column) -> Column:
    """History line of the attempt being made."""
    step, severity = fixed.STARTED_STEP
    line = names.log_row(at, F.lit(step), F.lit(severity), F.lit(fixed.STARTED_MESSAGE))
    return F.concat(line, F.lit("\n"))


NO_TEXT = "Error descargando archivo original: objeto sin contenido"


def convert_corpus(
    messages: DataFrame,
    documents: DataFrame | KeyedTable,
    generated_at: Column,
    keys: Sequence[str] = ("file_key",),
) -> DataFrame:
    """Convert the document of every message.

    ``messages``: job_id, user_id, original_filename, file_key, one row per job
    (see ``idempotent_intake``); they are read several times, so give a stored
    table.  ``documents``: file_key, text, one row per key, as a table or stored by key.
    ``keys`` may add the partition column of a document table, so that only the folders
    asked for are read.

    Gives one row per message with the final state; ``entries`` is null unless the
    bundle is valid, and holds its log without the history, whose lines are those of
    ``history_of``.  A missing document, or one without a text, is a FAILED row,
    never an exception.
    """
    asked = messages.select("job_id", "user_id", "original_filename", *keys)
    texts = documents.of(asked) if isinstance(documents, KeyedTable) else documents
    found = asked.join(texts.select(*keys, "text"), [*keys])
    # Of all keys only those asked for move.
    known = texts.select(*keys).join(asked.select(*keys), [*keys], "left_semi")
    missing = asked.join(known, [*keys], "left_anti")
    return (
        _converted(found.filter("text is not null"), generated_at)
        .unionByName(_failed(found.filter("text is null"), NO_TEXT))
        .unionByName(_failed(missing, fixed.MISSING_DOCUMENT))
    )


def _failed(messages: DataFrame, message: str) -> DataFrame:
    return messages.select(
        "job_id",
        "user_id",
        "original_filename",
        F.lit(fixed.FAILED).alias("status"),
        F.lit("").alias("bundle_key"),
        F.lit(message).alias("error_message"),
        F.lit(0).alias("units_count"),
        F.expr("cast(array() as array<string>)").alias("warnings"),
        F.expr("cast(null as array<struct<path: string, section: int, content: string>>)")
        .alias("entries"),
    )


@built_once
def _conversion() -> tuple[dict[str, Column], Column, Column, list[Column]]:
    """Columns of the conversion: index and log, links, dead ones, the result."""
    job, user, filename = F.col("job_id"), F.col("user_id"), F.col("original_filename")
    texts = {
        "index_md": index_text(job, filename, F.col("units"), F.col("generated_at")),
        "log": log_ends(job, filename, F.col("units"), _started_line(F.col("generated_at"))),
    }
    paths = F.concat(
        F.array(F.lit(fixed.INDEX_FILE), F.lit(fixed.LOG_FILE)),
        F.transform("units", lambda u: u["filename"]),
    )
    errors = verdict_errors(F.lit(True), F.lit(True), F.col("dead"))
    good = F.size("dead") == 0
    result = [
        job,
        user,
        filename,
        F.when(good, fixed.COMPLETED).otherwise(fixed.INVALID).alias("status"),
        F.when(good, names.bundle_key(user, job)).otherwise("").alias("bundle_key"),
        F.when(good, "")
        .otherwise(names.fill(fixed.REFUSED_MESSAGE, F.array_join(errors, " ")))
        .alias("error_message"),
        F.size("units").alias("units_count"),
        F.when(F.size("targets") == 0, F.array(F.lit(fixed.NO_LINKS)))
        .otherwise(F.expr("cast(array() as array<string>)"))
        .alias("warnings"),
        F.when(good, entries_column(F.col("index_md"), F.col("log"), F.col("units")))
        .alias("entries"),
    ]
    return texts, links(F.col("index_md")), dead_links(F.col("targets"), paths), result


def _converted(found: DataFrame, generated_at: Column) -> DataFrame:
    texts, targets, dead, result = _conversion()
    built = with_units(found, "text", "original_filename").withColumn("generated_at", generated_at)
    checked = built.withColumns(texts).withColumn("targets", targets).withColumn("dead", dead)
    return checked.select(*result)


def history_of(messages: DataFrame, logs: DataFrame) -> DataFrame:
    """Lines of history of the jobs asked for, as they stand: job_id, section,
    created_at, log_id, content."""
    return history_lines(logs.join(messages.select("job_id"), "job_id", "left_semi"))


def status_events(results: DataFrame, batch_id: Column) -> DataFrame:
    """State changes of a conversion: PROCESSING, then the final state.

    ``seq`` orders a job's events: batch first, step second.
    """
    blank, zero = F.lit(""), F.lit(0)

    def event(step: int, status: Column, key: Column, error: Column, n: Column) -> Column:
        return F.struct(
            F.struct(batch_id.cast("bigint").alias("batch_id"), F.lit(step).alias("step"))
            .alias("seq"),
            status.alias("status"), key.alias("bundle_key"), error.alias("error_message"),
            n.alias("units_count"),
        )

    steps = F.array(
        event(1, F.lit(fixed.PROCESSING), blank, blank, zero),
        event(2, F.col("status"), F.col("bundle_key"), F.col("error_message"),
              F.col("units_count")),
    )
    return results.select("job_id", F.inline(steps))


def audit_rows(results: DataFrame, batch_id: Column, at: Column) -> DataFrame:
    """Audit rows of a conversion.  A FAILED attempt leaves the first one only."""

    def row(step: tuple[str, str], message: Column) -> Column:
        return F.struct(
            F.lit(step[0]).alias("step"), F.lit(step[1]).alias("status"),
            message.alias("message"),
        )

    started = row(fixed.STARTED_STEP, F.lit(fixed.STARTED_MESSAGE))
    refused = row(fixed.REFUSED_STEP, F.col("error_message"))
    published = row(
        fixed.PUBLISHED_STEP,
        names.fill(fixed.PUBLISHED_MESSAGE, F.col("units_count"), F.col("bundle_key")),
    )
    rows = (
        F.when(F.col("status") == fixed.FAILED, F.array(started))
        .when(F.col("status") == fixed.INVALID, F.array(started, refused))
        .otherwise(F.array(started, published))
    )
    # A microsecond per row keeps the order of one attempt's rows.
    stamped = results.select(
        "job_id", batch_id.alias("batch_id"), at.alias("at"), F.posexplode_outer(rows).alias("pos", "r")
    )
    return stamped.select(
        names.hashed_id(F.col("job_id"), F.col("batch_id"), F.col("r.step")).alias("log_id"),
        "job_id", "r.*",
        F.timestamp_add("MICROSECOND", F.col("pos"), F.col("at")).alias("created_at"),
    )
