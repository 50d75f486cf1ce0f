"""Index, trace log and entries of bundles.

A bundle's files are built from the ``units`` array of its document's row, so
assembly needs no shuffle of its own.  Only the job history comes from another
table.  A log is a row for its head, one per line of history, and one for its tail,
at any length: reading them by (section, created_at, log_id) gives the file.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import names

HEAD, LINES, TAIL = range(3)


def index_text(job_id: Column, filename: Column, units: Column, generated_at: Column) -> Column:
    """Text of index.md."""
    links = F.transform(
        units,
        lambda u: F.concat(
            u["unit_no"].cast("string"), F.lit(". ["), u["title"], F.lit("]("), u["filename"],
            F.lit(")\n"),
        ),
    )
    return F.concat(
        F.lit(fixed.INDEX_HEAD),
        names.fill(fixed.INDEX_JOB, job_id),
        names.fill(fixed.INDEX_SOURCE, filename),
        names.fill(
            fixed.INDEX_TIME, F.date_format(generated_at, fixed.INDEX_TIME_FORMAT)
        ),
        names.fill(fixed.INDEX_COUNT, F.size(units)),
        F.lit(fixed.INDEX_CONTENTS),
        F.array_join(links, ""),
    )


def log_head(job_id: Column, filename: Column) -> Column:
    return F.concat(
        F.lit(fixed.LOG_HEAD),
        names.fill(fixed.LOG_JOB, job_id, filename),
        F.lit(fixed.LOG_HISTORY),
    )


def log_tail(units: Column) -> Column:
    lines = F.transform(
        units,
        lambda u: names.fill(
            fixed.LOG_UNIT, u["filename"], u["title"], F.octet_length(u["content"])
        ),
    )
    return F.concat(F.lit(fixed.LOG_UNITS), F.array_join(lines, ""), F.lit(fixed.LOG_CHECKS))


def log_rows(logs: DataFrame) -> DataFrame:
    """Audit rows as table lines."""
    return logs.withColumn(
        "line", names.log_row(F.col("created_at"), F.col("step"), F.col("status"), F.col("message"))
    )


def history_lines(logs: DataFrame) -> DataFrame:
    """Lines of the log of each job: job_id, section, created_at, log_id, content."""
    return log_rows(logs).select(
        "job_id", F.lit(LINES).alias("section"), "created_at", "log_id",
        F.concat("line", F.lit("\n")).alias("content"),
    )


def bundle_index(docs: DataFrame) -> DataFrame:
    """index.md per bundle, from rows job_id, filename, generated_at, units."""
    return docs.select(
        "job_id",
        index_text(
            F.col("job_id"), F.col("filename"), F.col("units"), F.col("generated_at")
        ).alias("content"),
    )


def log_ends(
    job_id: Column, filename: Column, units: Column, last_lines: Column | None = None
) -> Column:
    """array<struct(section, content)>: head and tail of the log.  ``last_lines`` go
    behind the history."""
    piece = lambda n, content: F.struct(
        F.lit(n).alias("section"), content.alias("content"))
    tail = log_tail(units) if last_lines is None else F.concat(last_lines, log_tail(units))
    return F.array(piece(HEAD, log_head(job_id, filename)), piece(TAIL, tail))


def _placed(rows: DataFrame) -> DataFrame:
    """With the columns that order history lines, null for all other rows."""
    return rows.withColumns({
        "created_at": F.lit(None).cast("timestamp"), "log_id": F.lit(None).cast("string"),
    })


def bundle_log(docs: DataFrame, logs: DataFrame) -> DataFrame:
    """log.md per bundle, in rows: job_id, section, created_at, log_id, content.

    ``docs`` has job_id, filename, units; ``logs`` are audit rows, of which those of
    other jobs go before anything is done with them."""
    ends = log_ends(F.col("job_id"), F.col("filename"), F.col("units"))
    own = _placed(docs.select("job_id", F.inline(ends)))
    wanted = logs.join(docs.select("job_id"), "job_id", "left_semi")
    return own.unionByName(history_lines(wanted))


def entries_column(index_md: Column, log: Column, units: Column) -> Column:
    """array<struct(path, section, content)>: index, log without history, units."""

    def entry(path: Column, section: Column, content: Column) -> Column:
        return F.struct(path.alias("path"), section.alias("section"), content.alias("content"))

    head = F.lit(HEAD)
    return F.concat(
        F.array(entry(F.lit(fixed.INDEX_FILE), head, index_md)),
        F.transform(log, lambda x: entry(F.lit(fixed.LOG_FILE), x["section"], x["content"])),
        F.transform(units, lambda u: entry(u["filename"], head, u["content"])),
    )


def bundle_entries(docs: DataFrame, logs: DataFrame) -> DataFrame:
    """All entries of all bundles: bundle_id, path, section, created_at, log_id, content.

    ``docs`` has job_id, filename, generated_at, units.  One pass over the rows gives
    everything but the lines of history.
    """
    job_id, filename, units = F.col("job_id"), F.col("filename"), F.col("units")
    index_md = index_text(job_id, filename, units, F.col("generated_at"))
    own = docs.select(
        job_id.alias("bundle_id"),
        F.inline_outer(entries_column(index_md, log_ends(job_id, filename, units), units)),
    ).filter("path is not null")
    wanted = logs.join(docs.select("job_id"), "job_id", "left_semi")
    lines = history_lines(wanted).select(
        job_id.alias("bundle_id"), F.lit(fixed.LOG_FILE).alias("path"), "section", "created_at",
        "log_id", "content",
    )
    return _placed(own).unionByName(lines)
