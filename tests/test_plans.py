"""What must hold in the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from quirebind.operators import ledger, segment, validate
from quirebind.plans.convert import convert_corpus
from quirebind.session import settle
from quirebind.workload import fixtures as fx
from quirebind.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark):
    return fx.table(spark, SF, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit("f"), "doc_id", F.lit(".md")).alias("filename"), "text",
    )


@pytest.mark.parametrize(
    "operator", [segment.segment_documents, segment.segment_headings, segment.segment_long,
                 segment.unit_counts],
)
def test_segmentation_moves_nothing_and_folds_once(docs, operator):
    p = plan(operator(docs))
    assert "Exchange" not in p
    assert p.count("aggregate(") <= 2  # the fold over blocks and the one inside it
    assert "Python" not in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


@pytest.mark.parametrize("name", ["segment_documents", "prepare_text", "bundle_index", "scan_documents"])
def test_registered_texts_stay_where_they_are(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF))


def test_verdicts_read_entries_once_without_join(spark):
    entries = spark.read.schema("bundle_id string, path string, content string").parquet(
        f"{SF}/documents.parquet"
    )
    p = plan(validate.validate_bundles(entries))
    assert p.count("FileScan") == 1 and "Join" not in p


def test_small_message_side_leaves_the_texts_in_place(spark, docs):
    messages = settle(spark.createDataFrame(
        [("j", "u", "f.md", "1")], "job_id string, user_id string, original_filename string, "
        "file_key string"))
    stored = docs.select(F.col("doc_id").alias("file_key"), "text")
    p = plan(convert_corpus(messages, stored, fx.generated_at()))
    # The messages are the broadcast side; nothing is hashed by file key.
    assert re.search(r"BroadcastHashJoin \[file_key#\d+\], \[file_key#\d+\], Inner, BuildLeft", p)
    assert "hashpartitioning(file_key" not in p


def test_pages_cut_per_task_first(spark):
    p = plan(ledger.jobs_page(fx.jobs(spark, SF), fx.users(spark, SF), 2, 5))
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["latest_status", "register_unique", "idempotent_intake"])
def test_one_row_per_key_is_reduced_before_the_shuffle(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert re.search(r"partial_(max_by|min)\(", p)


def test_no_query_needs_python(spark):
    for name in ("segment_documents", "clean_lines", "download_gate", "json_roundtrip"):
        p = plan(QUERIES[name](spark, SF))
        assert "Python" not in p and "Arrow" not in p and "CartesianProduct" not in p


def scans(df):
    return plan(df).count("FileScan")


def test_accepting_and_deleting_read_each_table_once(spark):
    assert scans(QUERIES["accept_jobs"](spark, SF)) == 1
    # Jobs, logs and the stored ids of what goes; jobs and requests were read to find these.
    assert scans(QUERIES["cascade_delete"](spark, SF)) == 3


def test_a_page_numbers_rows_per_part_only(spark):
    p = plan(ledger.jobs_page(fx.jobs(spark, SF), fx.users(spark, SF), 7, 5))
    numbering = [w for w in p.splitlines() if "row_number()" in w and "Window [" in w]
    assert numbering and all("_part" in w for w in numbering)
