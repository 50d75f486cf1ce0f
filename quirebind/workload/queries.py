"""Registered queries: each runs one operator over whole tables.

Results are projected to plain columns (text, integers, booleans, doubles) so
that they compare with DuckDB.
"""

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebind.functions import names, text
from quirebind.operators import bundle, cleaning, intake, ledger, segment, validate
from quirebind.plans import convert
from quirebind.session import settle, shared_folder
from quirebind.sources import documents
from quirebind.sources import results as store
from quirebind.sources.keyed import KeyedRuns, KeyedTable, buckets_for
from quirebind.streaming.intake import start_intake
from quirebind.workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _time(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _long(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


# --- sources and gates ------------------------------------------------------

@query
def scan_documents(spark, sf):
    return documents.scan_table(fx.docs(spark, sf)).select(
        "doc_id", "filename", F.md5("text").alias("digest"), _long("bytes")
    )


@query
def format_gate(spark, sf):
    return intake.format_gate(fx.uploads(spark, sf)).select(
        "upload_id", "filename", "accepted", "reason"
    )


@query
def object_keys(spark, sf):
    return intake.object_keys(fx.jobs(spark, sf))


@query
def filename_parts(spark, sf):
    name = F.col("filename")
    return fx.uploads(spark, sf).select(
        "upload_id", text.extension(name).alias("extension"), text.stem(name).alias("stem")
    )


# --- text functions ---------------------------------------------------------

@query
def go_trim(spark, sf):
    left = fx.docs(spark, sf).select("doc_id", text.trim_white_left(F.col("text")).alias("text"))
    return left.select("doc_id", text.trim_white_right(F.col("text")).alias("text"))


@query
def prepare_text(spark, sf):
    return fx.docs(spark, sf).select(
        "doc_id", text.prepared_text(F.col("text"), F.col("filename")).alias("text")
    )


@query
def heading_kind(spark, sf):
    lines = cleaning.lines(fx.docs(spark, sf)).withColumn("line", text.trim_white(F.col("line")))
    return lines.select(
        "doc_id", _long("line_no"), text.heading_kind(F.col("line")).alias("kind"),
        text.heading_title(F.col("line")).alias("title"),
    ).filter("kind is not null")


@query
def readable_ratio(spark, sf):
    lines = cleaning.readable_lines(cleaning.lines(fx.raw_docs(spark, sf)))
    return lines.select("doc_id", _long("line_no"), "ratio", "kept")


@query
def clean_lines(spark, sf):
    return cleaning.clean_lines(fx.docs(spark, sf))


@query
def printable_only(spark, sf):
    lines = cleaning.printable_lines(cleaning.lines(fx.docs(spark, sf)))
    return lines.select("doc_id", _long("line_no"), "line")


@query
def markup_paragraphs(spark, sf):
    raw = fx.raw_docs(spark, sf).select(
        "doc_id", "filename", fx.markup_of(F.col("text")).alias("markup")
    )
    return cleaning.markup_paragraphs(raw)


# --- segmentation -----------------------------------------------------------

@query
def segment_headings(spark, sf):
    return segment.segment_headings(fx.docs(spark, sf)).select(
        "doc_id", _long("unit_no"), "title", "content"
    )


@query
def subtitle_lookahead(spark, sf):
    return segment.subtitle_lookahead(fx.docs(spark, sf)).withColumn("unit_no", _long("unit_no"))


@query
def segment_long(spark, sf):
    return segment.segment_long(fx.docs(spark, sf)).withColumn("unit_no", _long("unit_no"))


@query
def segment_documents(spark, sf):
    return segment.segment_documents(fx.docs(spark, sf)).withColumn("unit_no", _long("unit_no"))


@query
def unit_counts(spark, sf):
    return segment.unit_counts(fx.docs(spark, sf)).withColumn("units_count", _long("units_count"))


@query
def unit_sizes(spark, sf):
    units = segment.segment_documents(fx.docs(spark, sf))
    return segment.unit_sizes(units).select(
        "doc_id", _long("unit_no"), "filename", _long("content_bytes")
    )


@query
def unit_filenames(spark, sf):
    """A name and a fallback title per line number of every document."""
    n = F.col("line_no")
    return cleaning.lines(fx.docs(spark, sf)).select(
        "doc_id", _long("line_no"), names.unit_filename(n).alias("filename"),
        names.untitled(n).alias("title"),
    )


# --- bundles ----------------------------------------------------------------

def _unit_docs(spark: SparkSession, sf: str) -> DataFrame:
    units = segment.with_units(fx.job_docs(spark, sf))
    return units.withColumn("generated_at", fx.generated_at())


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return bundle.bundle_entries(_unit_docs(spark, sf), fx.logs(spark, sf))


def _mutated(spark: SparkSession, sf: str) -> DataFrame:
    number = F.right("bundle_id", F.lit(12)).cast("bigint")
    entries = fx.mutated_entries(_entries(spark, sf).withColumn("number", number))
    return entries.drop("number")


@query
def bundle_index(spark, sf):
    return bundle.bundle_index(_unit_docs(spark, sf))


@query
def log_rows(spark, sf):
    return bundle.log_rows(fx.logs(spark, sf)).select("log_id", "job_id", "line")


@query
def bundle_log(spark, sf):
    logs = bundle.bundle_log(_unit_docs(spark, sf), fx.logs(spark, sf))
    return logs.select("job_id", _long("section"), _time("created_at"), "log_id", "content")


@query
def bundle_entries(spark, sf):
    return _entries(spark, sf).select(
        "bundle_id", "path", _long("section"), _time("created_at"), "log_id", "content"
    )


@query
def index_links(spark, sf):
    return validate.index_links(_mutated(spark, sf)).select("bundle_id", _long("pos"), "target")


@query
def broken_links(spark, sf):
    return validate.broken_links(_mutated(spark, sf)).select("bundle_id", _long("pos"), "target")


@query
def validate_bundles(spark, sf):
    return validate.validate_bundles(_mutated(spark, sf)).select(
        "bundle_id", "is_valid", "has_warns",
        F.array_join("errors", "; ").alias("errors"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


@query
def entry_dedup(spark, sf):
    """Conversation turns as entries: role is the path, the last turn wins."""
    turns = fx.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("bundle_id"), F.col("role").alias("path"),
        F.col("turn").alias("ordinal"), F.col("text").alias("content"),
    )
    last = validate.entry_dedup(turns, "last").withColumn("keep", F.lit("last"))
    first = validate.entry_dedup(turns, "first").withColumn("keep", F.lit("first"))
    return last.unionByName(first)


# --- ledger -----------------------------------------------------------------

@query
def ledger_append(spark, sf):
    new = fx.uploads(spark, sf).select(
        "upload_id", F.lit(None).cast("string").alias("job_id"), "user_id",
        F.when(F.col("filename").endswith(".md"), "FAILED").alias("status"),
        F.lit(None).cast("int").alias("units_count"),
        F.when(F.col("filename").endswith(".pdf"), F.col("created_at")).alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    defaults = ledger.job_defaults(fx.generated_at(), [F.col("upload_id"), F.col("user_id")])
    return ledger.ledger_append(new, defaults).select(
        "job_id", "user_id", "status", _long("units_count"), _time("created_at"),
        _time("updated_at"),
    )


def _job_columns() -> list:
    return [
        "job_id", "user_id", "original_filename", "file_key", "bundle_key", "status",
        "error_message", _long("units_count"), _time("created_at"), _time("updated_at"),
    ]


@query
def job_lookup(spark, sf):
    keys = fx.requests(spark, sf).select("job_id")
    return ledger.job_lookup(fx.jobs(spark, sf), keys).select("found", *_job_columns())


@query
def user_jobs(spark, sf):
    return ledger.user_jobs(fx.jobs(spark, sf), fx.users(spark, sf)).select(*_job_columns())


@query
def job_logs(spark, sf):
    return ledger.job_logs(fx.logs(spark, sf), fx.jobs(spark, sf)).select(
        "log_id", "job_id", "step", "status", "message", _time("created_at")
    )


@query
def row_isolation(spark, sf):
    return ledger.row_isolation(fx.jobs(spark, sf), fx.requests(spark, sf)).select(
        "request_id", *_job_columns()
    )


@query
def download_gate(spark, sf):
    return ledger.download_gate(fx.requests(spark, sf), fx.jobs(spark, sf))


@query
def jobs_report(spark, sf):
    return ledger.jobs_report(fx.jobs(spark, sf))


def _page(spark: SparkSession, sf: str, page: int) -> DataFrame:
    rows = ledger.jobs_page(fx.jobs(spark, sf), fx.users(spark, sf), page=page, size=5)
    return rows.select(
        "user_id", "job_id", _long("position"), _long("page"), _long("total_pages"),
        _long("total_jobs"),
    )


@query
def jobs_page(spark, sf):
    return _page(spark, sf, 2)


@query
def jobs_last_page(spark, sf):
    """A page beyond every list: its last one."""
    return _page(spark, sf, 1_000_000)


@query
def job_trace(spark, sf):
    trace = ledger.job_trace(fx.jobs(spark, sf), fx.logs(spark, sf))
    return trace.select(
        "job_id", "status", "log_id", "step", "log_status", "message", _time("logged_at")
    )


@query
def register_unique(spark, sf):
    return ledger.register_unique(fx.registrations(spark, sf), fx.users(spark, sf))


@query
def cascade_delete(spark, sf):
    return ledger.cascade_rows(
        fx.jobs(spark, sf), fx.logs(spark, sf), fx.delete_requests(spark, sf)
    )


@query
def delete_gate(spark, sf):
    return ledger.access_gate(fx.requests(spark, sf), fx.jobs(spark, sf))


@query
def trace_gate(spark, sf):
    return ledger.trace_gate(fx.requests(spark, sf), fx.jobs(spark, sf), fx.logs(spark, sf))


@query
def published_entries(spark, sf):
    """Entries of the bundles of jobs that no owner has deleted."""
    gone = ledger.deletable_jobs(fx.jobs(spark, sf), fx.delete_requests(spark, sf))
    entries = ledger.without_deleted(_entries(spark, sf), gone, "bundle_id")
    return entries.select("bundle_id", "path", _long("section"), "log_id", "content")


@query
def current_jobs(spark, sf):
    """Accepted jobs with events of their own and some messages that failed."""
    accepted = fx.accepted_jobs(spark, sf)
    failed = accepted.filter(F.right("job_id", F.lit(12)).cast("bigint") % 17 == 0)
    lost = ledger.publish_failures(failed, F.lit(-1).cast("bigint"), F.col("created_at"))
    events = fx.state_events(spark, sf).withColumn(
        "at", F.timestamp_add("SECOND", F.col("seq").cast("int"), fx.generated_at())
    )
    return ledger.current_jobs(accepted, events.unionByName(lost)).select(*_job_columns())


@query
def fk_orphans(spark, sf):
    """Orphans after every 17th parent is gone."""
    kept = lambda df, c: df.filter(F.right(c, F.lit(12)).cast("bigint") % 17 != 0)
    jobs, logs = fx.jobs(spark, sf), fx.logs(spark, sf)
    lost_jobs = ledger.orphans(jobs, kept(fx.users(spark, sf), "user_id"), "user_id")
    lost_logs = ledger.orphans(logs, kept(jobs, "job_id"), "job_id")
    return lost_jobs.select(F.lit("job").alias("kind"), F.col("job_id").alias("id")).unionByName(
        lost_logs.select(F.lit("log").alias("kind"), F.col("log_id").alias("id"))
    )


@query
def latest_status(spark, sf):
    return ledger.latest_status(fx.state_events(spark, sf)).withColumn(
        "units_count", _long("units_count")
    )


@query
def status_transitions(spark, sf):
    return ledger.status_transitions(fx.state_events(spark, sf))


# --- intake -----------------------------------------------------------------

@query
def accept_jobs(spark, sf):
    row = lambda kind, i, detail: F.struct(
        F.lit(kind).alias("kind"), i.alias("id"), detail.alias("detail"))
    job, log = F.col("job"), F.col("log")
    good = F.array(
        row("job", job["job_id"], F.concat_ws(
            "|", job["user_id"], job["original_filename"], job["file_key"], job["status"])),
        row("log", log["log_id"], F.concat_ws(
            "|", log["job_id"], log["step"], log["status"], log["message"])),
        row("message", job["job_id"], F.col("value")),
    )
    bad = F.array(row("rejected", F.col("upload_id"), F.col("reason")))
    made = intake.accepted(fx.uploads(spark, sf))
    return made.select(F.inline(F.when(F.col("accepted"), good).otherwise(bad)))


@query
def publish_messages(spark, sf):
    return intake.publish_messages(fx.jobs(spark, sf))


@query
def json_roundtrip(spark, sf):
    sent = intake.publish_messages(fx.jobs(spark, sf)).select("value")
    return intake.parse_messages(sent).drop("value")


@query
def dead_letters(spark, sf):
    return intake.dead_letters(intake.parse_messages(fx.messages(spark, sf)))


def _intake(spark: SparkSession, sf: str) -> DataFrame:
    parsed = intake.parse_messages(fx.messages(spark, sf))
    return intake.idempotent_intake(parsed, fx.completed_jobs(spark, sf))


@query
def idempotent_intake(spark, sf):
    return _intake(spark, sf)


def _converted(spark: SparkSession, sf: str) -> DataFrame:
    # The conversion reads its messages several times, so they are stored first.
    return convert.convert_corpus(
        settle(_intake(spark, sf)), fx.stored_docs(spark, sf), fx.generated_at()
    )


@query
def convert_corpus(spark, sf):
    """States of the conversion with a digest of every published entry."""
    digests = F.transform("entries", lambda e: F.concat_ws(" ", e["path"], F.md5(e["content"])))
    return _converted(spark, sf).select(
        "job_id", "user_id", "original_filename", "status", "bundle_key", "error_message",
        _long("units_count"), F.array_join("warnings", "; ").alias("warnings"),
        F.array_join(digests, "\n").alias("digests"),
    )


@query
def audit_rows(spark, sf):
    rows = convert.audit_rows(_converted(spark, sf), F.lit(fx.BATCH_ID), fx.generated_at())
    return rows.select("log_id", "job_id", "step", "status", "message", _time("created_at"))


def _stream(spark: SparkSession, sf: str, stop: tuple[str, int] | None = None) -> str:
    """All messages through the stream in several batches; gives the ledger's folder.

    Documents and audit rows are stored by key first.  With ``stop`` the first run ends
    in an error behind that step of that batch, and a second one goes on.
    """
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4()}"
    fx.message_files(spark, sf, f"{root}/messages")
    docs, logs = fx.stored_docs(spark, sf), fx.logs(spark, sf)
    stored = KeyedTable(spark, f"{root}/documents", "file_key string, text string", ["file_key"])
    audit = KeyedTable(
        spark, f"{root}/logs", "log_id string, job_id string, step string, status string, "
        "message string, created_at timestamp", ["job_id"])
    stored.write(docs, buckets_for(docs.count(), 1000))
    audit.write(logs, buckets_for(logs.count()))

    def fail(step: str, batch_id: int) -> None:
        if stop == (step, batch_id):
            raise RuntimeError(f"stopped behind {step} of batch {batch_id}")

    def run(done) -> None:
        start_intake(
            spark, f"{root}/messages", f"{root}/ledger", stored, audit,
            files_per_batch=fx.FILES_A_BATCH, done=done,
            now=lambda: datetime.fromisoformat(fx.GENERATED_AT).replace(tzinfo=timezone.utc),
        ).awaitTermination()

    if stop:
        try:
            run(fail)
        except StreamingQueryException as e:
            if "stopped behind" not in str(e):
                raise
    run(lambda step, batch_id: None)
    return f"{root}/ledger"


@query
def stream_ingest(spark, sf):
    """All messages through the stream in several batches: the jobs' states."""
    states = store.runs(spark, _stream(spark, sf)).states.current()
    return states.select(
        "job_id", "status", "bundle_key", "error_message", _long("units_count")
    )


@query
def progress_rows(spark, sf):
    """What each batch of the stream has done."""
    rows = store.read_table(spark, _stream(spark, sf), store.PROGRESS)
    return rows.drop("waited_seconds")


@query
def stream_replay(spark, sf):
    """The stream, stopped between two writes of its second batch and started again:
    rows of each batch in each table."""
    root = _stream(spark, sf, stop=(store.RESULTS, 1))
    counts = None
    for name in (store.LETTERS, store.DELIVERIES, store.INTAKE, store.RESULTS, store.PROGRESS):
        rows = store.read_table(spark, root, name).groupBy("batch_id").agg(
            F.count("*").alias("rows")).withColumn("table_name", F.lit(name))
        counts = rows if counts is None else counts.unionByName(rows)
    states = store.runs(spark, root).states.current().groupBy("batch_id").agg(
        F.count("*").alias("rows")).withColumn("table_name", F.lit("states"))
    return counts.unionByName(states).withColumn("batch_id", _long("batch_id"))


@query
def bundle_store(spark, sf):
    """Bundles published in three batches and some of them again in a fourth, merged on the
    way: the entries as they stand."""
    number = F.right("job_id", F.lit(12)).cast("bigint")
    made = settle(_converted(spark, sf).select("job_id", "status", "entries"))
    published = made.filter("status = 'COMPLETED'").select(
        "job_id", number.alias("number"), "entries")
    again = F.transform("entries", lambda e: e.withField(
        "content", F.concat(e["content"], F.lit("again"))))
    runs = KeyedRuns(
        spark, f"{shared_folder(spark)}/bundles-{uuid.uuid4()}",
        "job_id string, entries array<struct<path: string, section: int, content: string>>",
        ["job_id"], fan=2, rows_per_bucket=200)
    for k in range(3):
        runs.write(published.filter(F.col("number") % 3 == k).drop("number"), k)
    runs.write(published.filter("number % 5 = 0").select("job_id", again.alias("entries")), 3)
    return store.entry_rows(runs.current()).select(
        "bundle_id", "path", _long("section"), F.md5("content").alias("digest"))


@query
def scan_files(spark, sf):
    """Originals stored as files, and of them those that messages ask for, whole."""
    root = f"{shared_folder(spark)}/files-{uuid.uuid4()}"
    documents.store_files(fx.stored_docs(spark, sf), root)
    sent = fx.messages(spark, sf, tasks=4 * spark.sparkContext.defaultParallelism)
    asked = intake.parse_messages(sent).filter("problem is null")
    return documents.scan_asked(spark, root, asked).select(
        "file_key", "filename", F.md5("text").alias("digest"), _long("bytes"))
