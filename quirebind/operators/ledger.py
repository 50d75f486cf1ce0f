"""The job ledger: lookups, lists, access, deletion, states, reports."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names
from quirebind.operators.ordered import previous_within
from quirebind.session import settle



def read_form(jobs: DataFrame) -> DataFrame:
    """Jobs as readers see them: no null bundle key or error message."""
    return jobs.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in ("bundle_key", "error_message")}
    )


def ledger_append(rows: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill absent values before an append (id, state, counts, times)."""
    return rows.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def job_defaults(now: Column, id_parts: list[Column]) -> dict[str, Column]:
    return {
        "job_id": names.hashed_id(*id_parts),
        "status": F.lit(fixed.PENDING),
        "units_count": F.lit(0),
        "created_at": now,
        "updated_at": now,
    }


# --- lookups and lists ------------------------------------------------------

def lookup(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows for many keys at once; a key without a row stays, with found=false."""
    return keys.select(key).distinct().join(
        table.withColumn("found", F.lit(True)), key, "left"
    ).withColumn("found", F.coalesce("found", F.lit(False)))


def job_lookup(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    return lookup(read_form(jobs), keys, "job_id")


def user_jobs(jobs: DataFrame, users: DataFrame) -> DataFrame:
    """Jobs of the given users, newest first within each user."""
    mine = read_form(jobs).join(users.select("user_id"), "user_id", "left_semi")
    return mine.orderBy("user_id", F.col("created_at").desc(), "job_id")


def job_logs(logs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Audit rows of the given jobs, oldest first within each job."""
    return logs.join(jobs.select("job_id"), "job_id", "left_semi").orderBy(
        "job_id", "created_at", "log_id"
    )


def row_isolation(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """Jobs visible to each request: those its user owns."""
    return requests.select("request_id", "job_id", "user_id").join(
        read_form(jobs), ["job_id", "user_id"]
    )


def jobs_page(
    jobs: DataFrame, users: DataFrame, page: int = 1, size: int = fixed.PAGE_SIZE
) -> DataFrame:
    """One page of every user's list, newest first.

    The page is clamped to what the user has.  Jobs are range-partitioned in the order of
    the lists and stored; a user's totals per part say which parts hold the page, and only
    their rows are numbered, part by part.  So a list of any length spreads over tasks, and
    a deep page costs what the first one does.
    """
    page = max(page, 1)
    mine = jobs.join(users.select("user_id"), "user_id", "left_semi")
    newest = [F.col("created_at").desc(), F.col("job_id")]
    placed = settle(mine.repartitionByRange("user_id", *newest).withColumn(
        "_part", F.spark_partition_id()))
    user = Window.partitionBy("user_id")
    before = user.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pages = F.greatest(F.ceil(F.col("total_jobs") / size), F.lit(1)).cast("int")
    first = (F.col("page") - 1) * size
    parts = (
        placed.groupBy("user_id", "_part").agg(F.count("*").alias("_rows"))
        .withColumns({
            "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "total_jobs": F.sum("_rows").over(user),
        })
        .withColumn("total_pages", pages)
        .withColumn("page", F.least(F.lit(page), F.col("total_pages")))
        .filter((F.col("_before") < first + size) & (F.col("_before") + F.col("_rows") > first))
    )
    inside = Window.partitionBy("user_id", "_part").orderBy(*newest)
    held = placed.join(parts, ["user_id", "_part"])
    numbered = held.withColumn("_n", F.row_number().over(inside)).filter(
        F.col("_n") <= page * size  # so rows that are on no page go before they move
    )
    return (
        numbered.withColumn("position", (F.col("_before") + F.col("_n")).cast("int"))
        .filter((F.col("position") > first) & (F.col("position") <= first + size))
        .drop("_part", "_rows", "_before", "_n")
    )


def jobs_report(jobs: DataFrame) -> DataFrame:
    """List columns as shown to users."""
    return jobs.select(
        F.concat(F.left("job_id", F.lit(8)), F.lit("...")).alias("short_id"),
        "original_filename",
        names.state_label(F.col("status")).alias("state"),
        F.concat(F.coalesce("units_count", F.lit(0)).cast("string"), F.lit(" u.")).alias("units"),
        F.date_format("created_at", fixed.LOG_TIME_FORMAT).alias("clock"),
        (F.col("status") == fixed.COMPLETED).alias("downloadable"),
    )


# --- job with its audit rows ------------------------------------------------

def job_trace(jobs: DataFrame, logs: DataFrame) -> DataFrame:
    """Jobs with their audit rows: one row per audit row, ordered by (logged_at,
    log_id); a job without any has one row with these columns null."""
    rows = logs.select(
        "job_id", "log_id", "step", F.col("status").alias("log_status"), "message",
        F.col("created_at").alias("logged_at"),
    )
    return read_form(jobs).join(rows, "job_id", "left")


# --- access -----------------------------------------------------------------

def download_gate(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Answer to each download request: allowed, reason, key and name.

    The first rule that applies decides.
    """
    job = read_form(jobs).select(
        "job_id", F.col("user_id").alias("owner_id"), "status", "bundle_key"
    )
    ready = F.col("status") == fixed.COMPLETED
    reason = (
        F.when(F.col("owner_id").isNull(), fixed.NOT_FOUND)
        .when(F.col("owner_id") != F.col("user_id"), fixed.NOT_OWNER)
        .when(~ready, names.fill(fixed.NOT_READY, F.col("status")))
        .when(F.col("bundle_key") == "", fixed.NO_BUNDLE)
        .otherwise("")
    )
    allowed = F.col("reason") == ""
    return (
        requests.select("request_id", "job_id", "user_id")
        .join(job, "job_id", "left")
        .withColumn("reason", reason)
        .select(
            "request_id", "job_id", "user_id", allowed.alias("allowed"), "reason",
            F.when(allowed, F.col("bundle_key")).otherwise("").alias("bundle_key"),
            F.when(allowed, names.download_name(F.col("job_id"))).otherwise("")
            .alias("download_name"),
        )
    )


def access_gate(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Answer to each request to see or delete a job: allowed and reason."""
    owner = jobs.select("job_id", F.col("user_id").alias("owner_id"))
    reason = (
        F.when(F.col("owner_id").isNull(), fixed.NOT_FOUND)
        .when(F.col("owner_id") != F.col("user_id"), fixed.NOT_OWNER)
        .otherwise("")
    )
    return (
        requests.select("request_id", "job_id", "user_id")
        .join(owner, "job_id", "left")
        .withColumn("reason", reason)
        .select(
            "request_id", "job_id", "user_id", (F.col("reason") == "").alias("allowed"), "reason"
        )
    )


def trace_gate(requests: DataFrame, jobs: DataFrame, logs: DataFrame) -> DataFrame:
    """The answer to each request to see a job, with the job's audit rows where it is
    allowed: a row per audit row, and one with nulls where there is none to show."""
    answers = access_gate(requests, jobs)
    rows = logs.select(
        F.col("job_id").alias("of"), "log_id", "step", F.col("status").alias("log_status")
    )
    return answers.join(rows, F.col("allowed") & (F.col("job_id") == F.col("of")), "left").drop("of")


# --- deletion and keys ------------------------------------------------------

def deletable_jobs(jobs: DataFrame, requests: DataFrame) -> DataFrame:
    """Jobs whose owner asked for their deletion."""
    return read_form(jobs).join(requests, ["job_id", "user_id"], "left_semi")


def cascade_delete(
    jobs: DataFrame, logs: DataFrame, requests: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Remaining jobs, remaining logs, and the object keys to remove.

    Logs go only with a job that really goes.  A blank key is no object.
    """
    gone = deletable_jobs(jobs, requests)
    ids = gone.select("job_id")
    keys = gone.select(F.explode(F.array("file_key", "bundle_key")).alias("object_key"))
    return (
        jobs.join(ids, "job_id", "left_anti"),
        logs.join(ids, "job_id", "left_anti"),
        keys.filter("object_key != ''"),
    )


def cascade_rows(jobs: DataFrame, logs: DataFrame, requests: DataFrame) -> DataFrame:
    """What ``cascade_delete`` gives as rows: kind ('job', 'log', 'removed object'), id.

    The jobs that go are found first and stored.  Jobs and logs meet them together, with
    nothing but their ids (jobs with their keys), and the many rows are not sorted for it,
    so they move once and nothing spills; many logs of one job are split over tasks.
    """
    gone = settle(deletable_jobs(jobs, requests).select("job_id"))
    row = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id"))
    keys = F.filter(F.array(
        row("removed object", "file_key"), row("removed object", "bundle_key")
    ), lambda k: k["id"] != "")
    nothing = F.lit(None).cast("string")
    both = jobs.select(
        "job_id", "file_key", "bundle_key", nothing.alias("log_id"), F.lit(True).alias("is_job")
    ).unionByName(logs.select(
        "job_id", nothing.alias("file_key"), nothing.alias("bundle_key"), "log_id",
        F.lit(False).alias("is_job")))
    met = both.join(gone.withColumn("gone", F.lit(True)).hint("shuffle_hash"), "job_id", "left")
    stays = F.array(
        F.when(F.col("is_job"), row("job", "job_id")).otherwise(row("log", "log_id")))
    return met.select(F.inline(F.when(F.col("gone"), keys).otherwise(stays)))


def without_deleted(rows: DataFrame, deleted: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows, such as published entries, of jobs that are not in ``deleted`` (job_id)."""
    return rows.join(deleted.select(F.col("job_id").alias(key)), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose parent does not exist."""
    return child.join(parent.select(key), key, "left_anti")


def register_unique(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Registrations that succeed: the first per e-mail not yet taken.

    ``requests`` has email, user_id, arrival.  The earliest is found by an
    aggregate, so an address tried very often costs one row per task.
    """
    order = F.struct("arrival", "user_id")
    first = requests.groupBy("email").agg(F.min(order).alias("first"))
    return first.join(users.select("email"), "email", "left_anti").select(
        "first.user_id", "email", "first.arrival"
    )


# --- states -----------------------------------------------------------------

def latest_status(events: DataFrame) -> DataFrame:
    """Current state per job from appended events (job_id, seq, status,
    bundle_key, error_message, units_count): all columns of the last one."""
    state = F.struct("seq", "status", "bundle_key", "error_message", "units_count")
    return events.groupBy("job_id").agg(F.max_by(state, F.col("seq")).alias("s")).select(
        "job_id", "s.*"
    )


def publish_failures(jobs: DataFrame, seq: Column, at: Column) -> DataFrame:
    """State events of accepted jobs whose message could not be sent."""
    return jobs.select(
        "job_id", seq.alias("seq"), F.lit(fixed.FAILED).alias("status"),
        F.lit("").alias("bundle_key"), F.lit(fixed.PUBLISH_FAILED).alias("error_message"),
        F.lit(0).alias("units_count"), at.alias("at"),
    )


def current_jobs(accepted: DataFrame, events: DataFrame) -> DataFrame:
    """The job table as it stands: accepted jobs with their last state event.

    ``events`` has job_id, seq, status, bundle_key, error_message, units_count, at.
    The last one is found by an aggregate that combines before its shuffle.
    """
    state = F.struct("status", "bundle_key", "error_message", "units_count", "at")
    last = events.groupBy("job_id").agg(F.max_by(state, F.col("seq")).alias("last"))
    now = lambda c: F.coalesce(F.col(f"last.{c}"), F.col(c)).alias(c)
    return accepted.join(last, "job_id", "left").select(
        "job_id", "user_id", "original_filename", "file_key", now("bundle_key"), now("status"),
        now("error_message"), now("units_count"), "created_at",
        F.coalesce("last.at", "updated_at").alias("updated_at"),
    )


def _legal(previous: Column, status: Column) -> Column:
    first = previous.isNull() & (status == fixed.PENDING)
    start = (status == fixed.PROCESSING) & (previous != fixed.COMPLETED)
    unsent = (status == fixed.FAILED) & (previous == fixed.PENDING)
    end = status.isin(fixed.COMPLETED, fixed.FAILED, fixed.INVALID) & (
        previous == fixed.PROCESSING
    )
    return F.coalesce(first | start | unsent | end, F.lit(False))


EVENTS_PER_BUCKET = 100_000


def status_transitions(events: DataFrame) -> DataFrame:
    """Each event with the state before it and whether the step is legal.

    ``seq`` is a number, or (batch_id, step) as ``status_events`` gives it; events
    of a job are looked at per ``EVENTS_PER_BUCKET`` numbers, or per batch.
    """
    plain = events.select("job_id", "seq", "status")
    number = not plain.schema["seq"].dataType.typeName() == "struct"
    bucket = F.floor(F.col("seq") / EVENTS_PER_BUCKET) if number else F.col("seq")["batch_id"]
    stepped = previous_within(plain, ["job_id"], ["seq"], "status", "previous", bucket)
    return stepped.withColumn("legal", _legal(F.col("previous"), F.col("status")))
