"""Inputs of the registered queries, derived from the given tables.

The given documents hold no headings, blank lines or outer white space, so
structure is put in by rule (see FIXTURES.md).  Everything is a projection of
the source tables; ``oracle.py`` states the same rules in DuckDB SQL.
"""

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirebind.sources.keyed import Folders

EXTENSIONS = [".txt", ".TXT", ".md", ".markdown", ".html", ".txt", ".docx", ".pdf"]
UPLOAD_EXTENSIONS = [".md", ".TXT", ".html", ".markdown", ".docx", ".pdf", ".exe", ""]
STEPS = ["RECEPCION", "PROCESAMIENTO", "VALIDACION", "PUBLICACION"]
SEVERITIES = ["INFO", "INFO", "ERROR", "SUCCESS"]
STATES = ["PENDING", "PROCESSING", "COMPLETED", "PROCESSING", "FAILED", "INVALID"]
GENERATED_AT = "2024-06-01 12:30:45"
USERS = 100
BATCH_ID = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def generated_at() -> Column:
    return F.lit(GENERATED_AT).cast("timestamp")


def uid(n: Column) -> Column:
    """An id in UUID layout from a number."""
    return F.concat(
        F.lpad((n % 100000000).cast("string"), 8, "0"), F.lit("-0000-4000-8000-"),
        F.lpad(n.cast("string"), 12, "0"),
    )


def _choose(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(n, F.lit(len(values))) + 1).cast("int"))


def _numbered_lines(text: Column, line) -> Column:
    numbered = F.transform(
        F.split(text, "\n", -1), lambda x, i: line((i + 1).cast("string"), x)
    )
    return F.array_join(numbered, "\n")


def _escaped(text: Column) -> Column:
    for char, name in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")]:
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def markup_of(text: Column) -> Column:
    """Word-processor markup with one paragraph per line, in two runs; in some texts the
    third one's last run is closed by another element's tag."""
    broken = F.length(text) % 5 == 0
    paragraphs = F.transform(
        F.split(_escaped(text), "\n", -1),
        lambda x, i: F.concat(
            F.lit("<w:p><w:pPr/><w:r><w:t xml:space=\"preserve\">- </w:t></w:r><w:r><w:t>"), x,
            F.when(broken & (i == 2), "</w:x></w:r></w:p>").otherwise("</w:t></w:r></w:p>"),
        ),
    )
    return F.concat(
        F.lit("<w:document><w:body>"), F.array_join(paragraphs, ""), F.lit("</w:body></w:document>")
    )


def structured(number: Column, text: Column) -> Column:
    """The text of document ``number`` with structure by ``number % 8``."""
    v = F.pmod(number, F.lit(8))
    see = F.when(F.pmod(number, F.lit(16)) == 10, ", see [notes](notes.md)").otherwise("")
    nbsp = F.lit("\xa0")
    return (
        F.when(v == 1, F.replace(text, F.lit("\n"), F.lit("\n\n")))
        .when(v == 2, _numbered_lines(
            text, lambda i, x: F.concat(F.lit("## Part "), i, see, F.lit("\n\n"), x)))
        .when(v == 3, _numbered_lines(
            text, lambda i, x: F.concat(F.lit("CHAPTER "), i, F.lit("\nPart "), i, F.lit("\n"), x)))
        .when(v == 4, _numbered_lines(
            text, lambda i, x: F.concat(i, F.lit(". Sección "), i, F.lit("\n"), x)))
        .when(v == 5, F.concat(
            nbsp, F.lit("\t\n#tag\n"), text, F.lit("\n\t# Fin \xa0\nfin\n \t"), nbsp))
        .when(v == 6, markup_of(text))
        .otherwise(text)
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, filename, text: structured documents, turns and raw pages."""
    number = F.col("number")
    name = F.concat(F.lit("doc_"), number.cast("string"))
    documents = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "number").select(
        name.alias("doc_id"),
        F.concat(name, _choose(EXTENSIONS, number)).alias("filename"),
        structured(number, F.col("text")).alias("text"),
    )
    turn = F.concat_ws("_", F.lit("turn"), "conv_id", "turn")
    turns = table(spark, sf_dir, "conversations").select(
        turn.alias("doc_id"),
        F.concat(turn, F.lit(".md")).alias("filename"),
        F.concat(
            F.lit("CHAPTER "), (F.col("turn") + 1).cast("string"), F.lit("\n"), "role",
            F.lit("\n"), "text",
        ).alias("text"),
    )
    page = F.concat(F.lit("page_"), F.col("page_id").cast("string"))
    pages = table(spark, sf_dir, "pages").select(
        page.alias("doc_id"), F.concat(page, F.lit(".html")).alias("filename"),
        F.col("html").alias("text"),
    )
    return documents.unionByName(turns).unionByName(pages)


def job_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as jobs: job_id of the ledger fixture, filename, text."""
    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        uid(number).alias("job_id"),
        F.concat(F.lit("doc_"), number.cast("string"), _choose(EXTENSIONS, number))
        .alias("filename"),
        structured(number, F.col("text")).alias("text"),
    )


def stored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the keys that the messages ask for: file_key, text."""
    number = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(
            F.lit("originals/"), uid(number % USERS), F.lit("/"), uid(number),
            _choose(EXTENSIONS, number),
        ).alias("file_key"),
        structured(number, F.col("text")).alias("text"),
    )


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as it is, under string ids."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".docx"))
        .alias("filename"),
        "text",
    )


# --- ledger -----------------------------------------------------------------

def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        uid(F.col("c_custkey")).alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, status = F.col("o_orderkey"), F.col("status")
    ext = _choose(UPLOAD_EXTENSIONS, n)
    state = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .when(n % 7 == 0, "FAILED")
        .when(n % 11 == 0, "INVALID")
        .otherwise("PROCESSING")
    )
    key = F.concat_ws("/", F.lit("bundles"), "user_id", F.concat("job_id", F.lit(".zip")))
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            uid(n).alias("job_id"),
            uid(F.col("o_custkey")).alias("user_id"),
            F.concat(F.lit("file_"), n.cast("string"), ext).alias("original_filename"),
            ext.alias("ext"),
            state.alias("status"),
            (n % 9).cast("int").alias("units_count"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
        )
        .select(
            "job_id", "user_id", "original_filename",
            F.concat(F.lit("originals/"), "user_id", F.lit("/"), "job_id", "ext")
            .alias("file_key"),
            F.when(status == "COMPLETED", F.when(n % 13 == 0, "").otherwise(key))
            .alias("bundle_key"),
            "status",
            F.when(status.isin("FAILED", "INVALID"), F.concat(F.lit("error "), n.cast("string")))
            .alias("error_message"),
            "units_count", "created_at", F.col("created_at").alias("updated_at"),
        )
    )


def accepted_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs as they were when accepted."""
    return jobs(spark, sf_dir).withColumns({
        "status": F.lit("PENDING"), "bundle_key": F.lit(""), "error_message": F.lit(""),
        "units_count": F.lit(0),
    })


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    identity = F.concat_ws(
        "|", *[F.col(c).cast("string") for c in
               ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        cents.cast("string"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.md5(identity).alias("log_id"),
        uid(F.col("l_orderkey")).alias("job_id"),
        _choose(STEPS, line - 1).alias("step"),
        _choose(SEVERITIES, line - 1).alias("status"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" of supplier "),
                 F.col("l_suppkey").cast("string")).alias("message"),
        F.timestamp_add("SECOND", line * 61, F.col("l_shipdate").cast("timestamp"))
        .alias("created_at"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order a request by its owner; some by others, some for no job."""
    n = F.col("o_orderkey")
    name = lambda kind: F.concat(F.lit("r"), n.cast("string"), F.lit(kind))
    request = lambda kind, job, user: F.struct(
        name(kind).alias("request_id"), uid(job).alias("job_id"), uid(user).alias("user_id")
    )
    asked = F.array_compact(F.array(
        request("a", n, F.col("o_custkey")),
        F.when(n % 3 == 0, request("b", n, F.col("o_custkey") + 1)),
        F.when(n % 10 == 0, request("c", n + 50000000000, F.col("o_custkey"))),
    ))
    return table(spark, sf_dir, "orders").select(F.inline(asked))


def delete_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-owners' and unknown requests, and the owners' for finished orders."""
    n = F.col("o_orderkey")
    request = lambda job, user: F.struct(
        uid(job).alias("job_id"), uid(user).alias("user_id")
    )
    asked = F.array_compact(F.array(
        F.when(F.col("o_orderstatus") == "F", request(n, F.col("o_custkey"))),
        F.when(F.col("o_orderstatus") == "O", request(n, F.col("o_custkey") + 1)),
        F.when(n % 10 == 0, request(n + 50000000000, F.col("o_custkey"))),
    ))
    return table(spark, sf_dir, "orders").select(F.inline_outer(asked)).filter("job_id is not null")


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups from events: some for taken addresses, many repeated."""
    n, user = F.col("event_id"), F.col("user_id")
    email = F.when(
        n % 2 == 0, F.concat(
            F.lit("customer#"), F.lpad(user.cast("string"), 9, "0"), F.lit("@example.com"))
    ).otherwise(F.concat(F.lit("new"), (n % 997).cast("string"), F.lit("@example.com")))
    return table(spark, sf_dir, "events").select(
        email.alias("email"), uid(n).alias("user_id"), n.alias("arrival")
    )


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended job states from events: a job per user, in event order."""
    n = F.col("event_id")
    status = _choose(STATES, F.floor(n / 7) + n)
    return table(spark, sf_dir, "events").select(
        uid(F.col("user_id")).alias("job_id"),
        n.alias("seq"),
        status.alias("status"),
        F.when(status == "COMPLETED", F.concat(F.lit("bundles/"), n.cast("string"))).otherwise("")
        .alias("bundle_key"),
        F.when(status == "FAILED", F.concat(F.lit("error "), n.cast("string"))).otherwise("")
        .alias("error_message"),
        (n % 9).cast("int").alias("units_count"),
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload per order."""
    n = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("u"), n.cast("string")).alias("upload_id"),
        uid(F.col("o_custkey")).alias("user_id"),
        F.concat(F.lit("dir.v1/file_"), n.cast("string"), _choose(UPLOAD_EXTENSIONS, n))
        .alias("filename"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def messages(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Job messages from events, each job delivered several times: value, arrival.

    The sender's times run against the order of arrival.  Some are cut off, carry an id
    that is none, lack a field or all, give one in another case, twice, or as a number.  With ``tasks``
    the events, which are short, are dealt to so many first: messages take much longer to
    make and read than events, and a file of them may be in one piece.
    """
    n = F.col("event_id")
    job = F.floor(n / 5)
    user = uid(job % USERS)
    ext = _choose(EXTENSIONS, job)
    job_id = F.when(n % 53 == 0, F.concat(F.lit("job-"), n.cast("string"))).otherwise(uid(job))
    sent = F.timestamp_add("SECOND", (-n).cast("int"), generated_at())
    payload = F.to_json(F.struct(
        job_id.alias("job_id"),
        user.alias("user_id"),
        F.concat(F.lit("doc_"), job.cast("string"), ext).alias("original_filename"),
        F.concat(F.lit("originals/"), user, F.lit("/"), uid(job), ext).alias("file_key"),
        F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("event_type").alias("ignored"),
    ))
    named = F.col("payload")
    upper = named
    for name in ("job_id", "user_id", "original_filename", "file_key", "timestamp"):
        upper = F.replace(upper, F.lit(f'"{name}":'), F.lit(f'"{name.upper()}":'))
    value = (
        F.when(n % 50 == 0, F.substring(named, 1, 60))
        .when(n % 61 == 0, "{}")
        .when(n % 67 == 0, upper)
        .when(n % 71 == 0, F.regexp_replace(
            named, '"original_filename":"[^"]*"', '"original_filename":5'))
        .when(n % 73 == 0, F.replace(
            named, F.lit('"ignored":'), F.lit('"FILE_KEY":"originals/none","ignored":')))
        .when(n % 59 == 0, F.regexp_replace(named, '"file_key":"[^"]*",', ""))
        .when(n % 79 == 0, F.regexp_replace(named, '"timestamp":"[^"]*",', ""))
        .otherwise(named)
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    if tasks:
        events = events.repartition(tasks)
    made = events.select("event_id", payload.alias("payload"))
    return made.select(value.alias("value"), n.alias("arrival"))


MESSAGES_A_FILE, FILES, FILES_A_BATCH = 50_000, 4, 2


def message_files(spark: SparkSession, sf_dir: str, folder: str) -> int:
    """The messages in files that come one after the other, at least ``FILES``, all
    deliveries of a job in one; gives the number of jobs a file has.

    All are written in one pass over the events, and get their times in their order."""
    made = messages(spark, sf_dir)
    size = made.agg(F.count("*").alias("n"), F.max("arrival").alias("last")).first()
    files = max(FILES, -(-size["n"] // MESSAGES_A_FILE))
    jobs = -(-(size["last"] // 5 + 1) // files)
    cut = made.withColumn("file", F.floor(F.col("arrival") / 5 / jobs)).filter(
        F.col("file").between(0, files - 1))
    cut.repartition(files, "file").sortWithinPartitions("file", "arrival").select(
        "file", "value").write.partitionBy("file").text(f"{folder}-made")
    folders, now = Folders(spark, folder), int(time.time() * 1000)
    for k in range(files):
        # Where the store takes no time, moving them one by one gives them their order.
        name, made_as = f"{folder}/{k:09d}.txt", f"{folder}-made/file={k}"
        parts = [n for n in folders.names(made_as) if n.startswith("part-")]
        if parts:
            folders.move(f"{made_as}/{parts[0]}", name)
        else:
            folders.touch(name)
        folders.set_time(name, now - 1000 * (files - k))
    return jobs


def completed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs an earlier batch has completed: those of the finished orders."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        uid(F.col("o_orderkey")).alias("job_id")
    )


def mutated_entries(entries: DataFrame) -> DataFrame:
    """Entries (with ``number``) damaged by ``number % 6``: 1 no index, 2 no
    log, 3 neither, 4 a unit lost, 5 an index without links."""
    v = F.pmod("number", F.lit(6))
    path = F.col("path")
    lost = (
        ((path == "index.md") & v.isin(1, 3))
        | ((path == "log.md") & v.isin(2, 3))
        | ((path == "capitulo-02.md") & (v == 4))
    )
    return entries.filter(~lost).withColumn(
        "content",
        F.when((path == "index.md") & (v == 5), F.replace("content", F.lit("]("), F.lit("] (")))
        .otherwise(F.col("content")),
    )
