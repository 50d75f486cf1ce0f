import ast
import re
from pathlib import Path

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from quirebind.llm import near, packing, quality
from quirebind.session import BATCH_BYTES, settle, small_batches

ROOT = Path(__file__).resolve().parents[2]


def test_stages_hand_documents_on(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns, name
        left = {r.doc_id for r in rows}
        assert left <= ids and len(left) == len(rows)
        if name == "MinHash near-dedup":
            assert all(r.kept for r in near.near_report(docs).collect())
        assert name == "PII" and left == ids or name != "PII" and len(left) < len(ids)
        ids = left
    assert not any(re.search(r"\w@\w[\w-]*\.\w", r.text) for r in rows)
    pieces = pipeline.STAGES[-1][1](spark, docs, sf_small).collect()
    assert {p.doc_id for p in pieces} == ids


def test_order_of_stages():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "benchmark decontamination", "PII", "packing",
    ]


def test_registered_once_each():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    own = ROOT / "quirebind/llm"
    for file in (ROOT / "quirebind").rglob("*.py"):
        if own in file.parents:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else (
                [node.module or ""] if isinstance(node, ast.ImportFrom) else [])
            assert not any(n.startswith("quirebind.llm") for n in names), file


def test_columns_of_any_name_are_carried_along(spark, sf_small):
    """Names that the stages use inside, and names with dots, come out as they went in."""
    names = ["_q_text", "_q_pattern", "_p_found", "_p_all", "_d_text", "_d_leaked", "_d_key", "_n_text",
             "_n_doc", "_n_stays", "a.b", "key", "rep", "id", "start"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in names), name


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_tasks_get_few_megabytes_at_a_time(spark):
    """A partition of 24 MB comes in batches of 4 MB or a row more; outside it is one."""
    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("abcdefg "), 1000).alias("text"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    sized = lambda: docs.mapInArrow(run, "n long, size long").collect()
    with small_batches(spark):
        rows = sized()
    assert sum(r.n for r in rows) == 3000 and max(r["size"] for r in rows) < 4.2 * 2**20
    assert [r.n for r in sized()] == [3000] and BATCH not in spark.conf.getAll


def test_a_session_keeps_its_own_batch_size(spark):
    spark.conf.set(BATCH, "9m")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH) == "9m"
        assert spark.conf.get(BATCH) == "9m"
    finally:
        spark.conf.unset(BATCH)


def test_stages_read_texts_in_small_batches(spark, sf_small, monkeypatch):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(80)
    for module, stage in ((quality, quality.keep_good), (near, near.one_of_each), (packing, packing.pieces)):
        seen = []

        def spy(df, *by, real=module.settle, seen=seen):
            seen.append(("MapInArrow" in df._jdf.queryExecution().toString(), spark.conf.get(BATCH)))
            return real(df, *by)

        monkeypatch.setattr(module, "settle", spy)
        assert stage(docs).count() > 0
        assert any(python for python, _ in seen), module
        assert {size for python, size in seen if python} == {BATCH_BYTES}, module
        assert BATCH not in spark.conf.getAll


def test_a_carried_text_goes_to_python_once(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, more string")
    for carry, columns in ((docs.columns, 3), (["doc_id"], 2), (["more", "text"], 2), ([], 1)):
        made = quality.measured(docs, carry)
        sent = re.search(r"Project \[(.*)\]", made._jdf.queryExecution().analyzed().toString())[1]
        assert sent.count(" AS c") == columns and sent.count("text#") == 1, sent
        row = made.first().asDict()
        assert all(row[c] == docs.first()[c] for c in carry) and row["_q_n_words"] == 3


def test_a_task_of_near_dedup_runs_one_python_worker(spark, capsys):
    """The bitmap's test and the shingles, both in Python, lie in different stages also
    where what is asked for is small."""
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    heads = settle(near._keyed(docs).select(
        F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("cluster"),
        F.struct(F.col("doc_id").alias("doc"), "key").alias("head"),
    ))
    made = near._sets(docs, heads)
    made.explain()
    plan = capsys.readouterr().out
    assert "ArrowEvalPython" in plan and "MapInArrow" in plan
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.id for r in made.collect()} == {1, 2}
