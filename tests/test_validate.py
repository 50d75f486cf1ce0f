"""Bundle checks on damaged bundles."""

from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.operators import bundle, segment, validate

TEXT = "# Uno\n\na\n# Dos\n\nb\n# Tres\n\nc"


def entries(spark, text=TEXT, filename="a.md"):
    docs = spark.createDataFrame([("b", filename, text)], "job_id string, filename string, text string")
    ready = segment.with_units(docs).withColumn(
        "generated_at", F.lit("2024-06-01 00:00:00").cast("timestamp")
    )
    logs = spark.createDataFrame(
        [], "job_id string, log_id string, step string, status string, message string, "
        "created_at timestamp")
    return bundle.bundle_entries(ready, logs)


def verdict(df):
    (v,) = validate.validate_bundles(df).collect()
    assert v.is_valid == (v.errors == []) and v.has_warns == (v.warnings != [])
    return v


def test_built_bundle_is_valid(spark):
    assert verdict(entries(spark)).errors == []


def test_missing_files(spark):
    e = entries(spark)
    assert verdict(e.filter("path != 'index.md'")).errors == [fixed.NO_INDEX]
    assert verdict(e.filter("path != 'log.md'")).errors == [fixed.NO_LOG]
    both = verdict(e.filter("path not in ('index.md', 'log.md', 'capitulo-01.md')"))
    assert both.errors == [fixed.NO_INDEX, fixed.NO_LOG]


def test_missing_unit_and_dead_links_keep_order_and_repeats(spark):
    e = entries(spark).filter("path != 'capitulo-02.md'").withColumn(
        "content",
        F.when(F.col("path") == "index.md",
               F.concat(F.lit("[z](z.md) [z](z.md)\n"), "content", F.lit("[f](fantasma.md)")))
        .otherwise(F.col("content")),
    )
    broken = ["z.md", "z.md", "capitulo-02.md", "fantasma.md"]
    assert verdict(e).errors == [fixed.BROKEN_LINK % x for x in broken]
    rows = validate.broken_links(e).orderBy("pos").collect()
    assert [r.target for r in rows] == broken


def test_the_last_of_a_repeated_name_counts(spark):
    e = entries(spark).select("bundle_id", "path", "content").withColumn("ordinal", F.lit(2))
    bad = e.filter("path = 'index.md'").withColumns(
        {"content": F.lit("[f](fantasma.md)"), "ordinal": F.lit(1)})
    assert verdict(e.unionByName(bad)).errors == []
    worse = bad.withColumn("ordinal", F.lit(3))
    assert verdict(e.unionByName(worse)).errors == [fixed.BROKEN_LINK % "fantasma.md"]


def test_index_without_links_warns(spark):
    e = entries(spark).withColumn(
        "content", F.when(F.col("path") == "index.md", "nada").otherwise(F.col("content"))
    )
    v = verdict(e)
    assert v.is_valid and v.warnings == [fixed.NO_LINKS]


def test_heading_with_a_link_breaks_its_bundle(spark):
    v = verdict(entries(spark, "# Uno\n\na\n# See [g](g.md)\n\nb"))
    assert v.errors == [fixed.BROKEN_LINK % "g.md"]


def test_row_local_check_agrees(spark):
    rows = [
        (["a.md", "b.md", "a.md", "c.md"], ["b.md"]), ([], ["x"]), (["q.md"], ["q.md"]),
    ]
    df = spark.createDataFrame(rows, "targets array<string>, paths array<string>")
    got = df.select(validate.dead_links(F.col("targets"), F.col("paths")).alias("d")).collect()
    assert [r.d for r in got] == [["a.md", "a.md", "c.md"], [], []]


def test_last_and_first_entry(spark):
    df = spark.createDataFrame(
        [("b", "p", 1, "one"), ("b", "p", 2, "two"), ("b", "q", 1, "only")],
        "bundle_id string, path string, ordinal int, content string",
    )
    pick = lambda keep: {r.path: r.content for r in validate.entry_dedup(df, keep).collect()}
    assert pick("last") == {"p": "two", "q": "only"}
    assert pick("first") == {"p": "one", "q": "only"}
