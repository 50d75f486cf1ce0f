"""Accepting documents and reading job messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names, text
from quirebind.functions.built import built_once

_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_TIME_PATTERN = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.,]\d+)?(Z|[+-]\d\d:\d\d)\z"


def format_gate(uploads: DataFrame) -> DataFrame:
    """Add ``accepted`` and, for the rejected, a ``reason``."""
    ext = text.extension(F.col("filename"))
    return uploads.withColumn(
        "accepted", F.lower(ext).isin(fixed.ALLOWED_EXTENSIONS)
    ).withColumn(
        "reason",
        F.when(F.col("accepted"), "").otherwise(names.fill(fixed.REJECTED_FORMAT, ext)),
    )


def object_keys(jobs: DataFrame) -> DataFrame:
    """Keys of a job's original file and bundle, and the download name."""
    user, job = F.col("user_id"), F.col("job_id")
    return jobs.select(
        "job_id",
        names.original_key(user, job, F.col("original_filename")).alias("original_key"),
        names.bundle_key(user, job).alias("bundle_key"),
        names.download_name(job).alias("download_name"),
    )


def accepted(uploads: DataFrame) -> DataFrame:
    """Each upload (upload_id, user_id, filename, created_at) with what comes of it:
    ``job``, ``log`` (its first audit row) and ``value`` (its message), or a ``reason``.

    Ids are hashed from the upload, so doing a batch again writes the same rows.  It is
    one narrow pass over the uploads.
    """
    step, severity = fixed.RECEIVED_STEP
    job_id = names.hashed_id(F.col("upload_id"), F.col("user_id"))
    gated = format_gate(uploads).withColumn("job_id", job_id).withColumn(
        "file_key", names.original_key(F.col("user_id"), F.col("job_id"), F.col("filename")))
    job = F.struct(
        "job_id", "user_id", F.col("filename").alias("original_filename"), "file_key",
        F.lit(None).cast("string").alias("bundle_key"), F.lit(fixed.PENDING).alias("status"),
        F.lit(None).cast("string").alias("error_message"), F.lit(0).alias("units_count"),
        "created_at", F.col("created_at").alias("updated_at"),
    )
    log = F.struct(
        names.hashed_id(F.col("job_id"), F.lit(step)).alias("log_id"), "job_id",
        F.lit(step).alias("step"), F.lit(severity).alias("status"),
        names.fill(fixed.RECEIVED_MESSAGE, F.col("filename")).alias("message"), "created_at",
    )
    message = F.struct(
        "job_id", "user_id", F.col("filename").alias("original_filename"), "file_key",
        F.date_format("created_at", _TIME_FORMAT).alias("timestamp"),
    )
    taken = lambda c: F.when(F.col("accepted"), c)
    return gated.select(
        "upload_id", "user_id", "filename", "accepted", "reason", taken(job).alias("job"),
        taken(log).alias("log"), taken(F.to_json(message)).alias("value"),
    )


def accept_jobs(uploads: DataFrame) -> dict[str, DataFrame]:
    """``accepted`` as tables: ``jobs``, ``logs``, ``messages`` (job_id, value) and
    ``rejected``.  Each reads the uploads; to read them once, store ``accepted``."""
    made = accepted(uploads)
    good = made.filter("accepted")
    return {
        "jobs": good.select("job.*"),
        "logs": good.select("log.*"),
        "messages": good.select("job.job_id", "value"),
        "rejected": made.filter("not accepted").select(
            "upload_id", "user_id", "filename", "reason"
        ),
    }


def publish_messages(jobs: DataFrame) -> DataFrame:
    """One JSON message per job: job_id, value."""
    payload = F.struct(
        "job_id", "user_id", "original_filename", "file_key",
        F.date_format("created_at", _TIME_FORMAT).alias("timestamp"),
    )
    return jobs.select("job_id", F.to_json(payload).alias("value"))


_FIELDS = ["job_id", "user_id", "original_filename", "file_key", "timestamp"]
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
#: Letters outside ASCII that are other cases of ASCII letters.
_FOLDED = ("\u017f\u212a", "sk")


def _entries(messages: DataFrame) -> DataFrame:
    """Add ``_entries``: (field, kind, text) of the known fields of each message's object in
    their order, null where the message is not one JSON object and nothing else.

    The message is decoded once: the generator keeps what looks at the entries, filters
    too, above the decoding.
    """
    listed, known = _entry_columns()
    held = messages.select("*", F.explode_outer(F.array(listed)).alias("_listed"))
    return held.select("*", F.explode_outer(F.array(known)).alias("_entries")).drop("_listed")


@built_once
def _entry_columns() -> tuple[Column, Column]:
    # In an array in front of a null: whatever ends the object early or follows it shows.
    listed = F.from_json(
        F.concat(F.lit("["), "value", F.lit(",null]")), "array<map<string, variant>>", _STRICT
    )
    entries = F.transform(
        F.map_entries(F.get("_listed", F.lit(0))),
        lambda e: F.struct(
            F.lower(F.translate(e["key"], *_FOLDED)).alias("field"),
            F.schema_of_variant(e["value"]).alias("kind"),
            F.try_variant_get(e["value"], "$", "string").alias("text"),
        ),
    )
    return listed, F.when(
        F.size("_listed") == 2, F.filter(entries, lambda e: e["field"].isin(_FIELDS))
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Decode JSON messages in ``value`` and say what is wrong with each.

    ``problem`` is null for a sound message: one JSON object and nothing else, all
    fields strings, ids and time well-formed.  Unknown fields are ignored; absent ones and
    JSON's null take their blank value (the nil id for ids).  Names are taken without
    regard to case; of a field given several times the last counts, and all must be sound.
    """
    texts, held = _parsed_columns()
    decoded = _entries(messages).withColumns(texts)
    return decoded.select(*messages.columns, F.inline_outer(F.array(held)))


@built_once
def _parsed_columns() -> tuple[dict[str, Column], Column]:
    ids = ("job_id", "user_id")
    texts = {
        f"_{c}": F.transform(
            F.filter("_entries", lambda e: (e["field"] == c) & (e["kind"] == "STRING")),
            lambda e: names.canonical_id(e["text"]) if c in ids else e["text"],
        ) for c in _FIELDS
    }
    last = lambda c: F.try_element_at(f"_{c}", F.lit(-1))
    no_id = lambda c: F.exists(f"_{c}", lambda x: x.isNull())
    no_time = F.exists("_timestamp", lambda x: ~(x.rlike(_TIME_PATTERN) & F.try_to_timestamp(
        F.replace(x, F.lit(","), F.lit("."))).isNotNull()))
    other_kinds = F.exists("_entries", lambda e: ~e["kind"].isin("STRING", "VOID"))
    problem = (
        F.when(F.col("_entries").isNull() | other_kinds, "json")
        .when(no_id("job_id") | no_id("user_id"), "id")
        .when(no_time, "timestamp")
    )
    nil, blank = F.lit(fixed.NIL_ID), F.lit("")
    held = F.struct(
        *[F.when(F.size(f"_{c}") > 0, last(c)).otherwise(nil).alias(c) for c in ids],
        *[F.coalesce(last(c), blank).alias(c) for c in ("original_filename", "file_key")],
        last("timestamp").alias("timestamp"),
        problem.alias("problem"),
    )
    return texts, held


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that can not be read; they are kept, with the reason."""
    return parsed.filter("problem is not null").drop(
        "job_id", "user_id", "original_filename", "file_key", "timestamp"
    )


def first_deliveries(parsed: DataFrame) -> DataFrame:
    """The sound message of each job that came first: job_id, arrival and the fields.

    An aggregate: a job delivered very often costs one row per task.
    """
    fields = ["user_id", "original_filename", "file_key", "timestamp"]
    return (
        parsed.filter("problem is null")
        .groupBy("job_id")
        .agg(F.min(F.struct("arrival", *fields)).alias("d"))
        .select("job_id", "d.*")
    )


def without_completed(deliveries: DataFrame, completed: DataFrame) -> DataFrame:
    """Deliveries of jobs that are not in ``completed`` (job_id)."""
    return deliveries.join(completed.select("job_id"), "job_id", "left_anti")


def idempotent_intake(parsed: DataFrame, completed: DataFrame) -> DataFrame:
    """First delivery per job, without jobs already completed.

    ``completed`` must come from earlier batches only, so that replaying a
    batch sees what its first run saw.
    """
    return without_completed(first_deliveries(parsed), completed)
