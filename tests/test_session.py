import os

from quirebind.sources.documents import scan_files

from quirebind.session import drop_one, drop_settled, settle, shared_folder


def test_settled_rows_go_when_they_are_dropped(spark):
    kept = settle(spark.range(5))
    assert kept.count() == 5
    folder = f"{shared_folder(spark)}/settled/{spark.sparkContext.applicationId}".removeprefix("file://")
    assert os.listdir(folder)
    drop_settled(spark)
    assert not os.path.exists(folder)


def test_one_settled_result_goes_alone_or_in_part(spark):
    rows = spark.sql("select id, cast(id % 3 as int) k, id + 1 as more from range(9)")
    whole, parts, gone = settle(rows), settle(rows, "k"), settle(rows)
    drop_one(gone)
    drop_one(parts, "k=1")
    folder = f"{shared_folder(spark)}/settled/{spark.sparkContext.applicationId}".removeprefix("file://")
    left = lambda df: {os.path.basename(os.path.dirname(f)) for f in df.inputFiles() if os.path.exists(f.removeprefix("file://"))}
    assert left(whole) and left(parts) == {"k=1"} and not left(gone) and os.path.exists(folder)
    assert parts.dtypes == rows.dtypes
    assert sorted(map(tuple, parts.filter("k = 1").collect())) == [(1, 1, 2), (4, 1, 5), (7, 1, 8)]
    assert whole.count() == 9


def test_file_keys_below_any_spelling_of_the_root(spark, tmp_path):
    (tmp_path / "s/u").mkdir(parents=True)
    (tmp_path / "s/u/j.md").write_text("x")
    plain = f"{tmp_path}/s"
    for root in (plain, f"file://{plain}", f"{plain}/", f"{tmp_path}/./s/u/.."):
        (row,) = scan_files(spark, root).collect()
        assert (row.file_key, row.text) == ("u/j.md", "x")
