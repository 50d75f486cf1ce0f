import re

import duckdb

from quirebind.llm import chat

ROWS = [
    (1, 0, "system", "rules", 9), (1, 1, "anna", "hi", 9), (1, 2, "bob", "hé😀", 9), (1, 3, "anna", None, 9),
    (2, 0, "user", "", 9), (2, 0, "user", "", 9), (2, None, None, "first", 9), (None, 1, "user", "lost", 9),
    (3, 0, "system", "alone", 9),
]
SCHEMA = "conv_id long, turn long, role string, text string, position int"


def test_rotation_by_hand(spark):
    rows = chat.rotated(spark.createDataFrame(ROWS, SCHEMA)).collect()
    speakers = {(r.conv_id, r.speaker) for r in rows}
    assert speakers == {(1, "anna"), (1, "bob"), (2, "user"), (2, "unknown"), (None, "user")}
    for conv, who in speakers:
        own = sorted((r for r in rows if (r.conv_id, r.speaker) == (conv, who)), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        dialogue = "".join(r.text for r in own)
        for r in own:
            assert dialogue[r.char_start : r.char_end] == r.text
            assert r.trained == (r.role == "assistant")
            if r.trained:
                assert dialogue[r.train_start : r.train_end] == r.text.split("\n", 1)[1]
    bob = [r for r in rows if r.speaker == "bob" and r.trained]
    assert [r.text for r in bob] == ["<|im_start|>assistant\nhé😀<|im_end|>\n"]
    named = next(r for r in rows if r.speaker == "bob" and r.turn == 1)
    assert (named.role, named.name) == ("user", "anna")


def test_like_sql(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/conversations.parquet")
    odd = spark.createDataFrame(ROWS, SCHEMA).drop("position")
    con = duckdb.connect()
    con.register("odd", odd.toPandas())
    con.execute(
        f"CREATE VIEW conversations AS SELECT * FROM '{sf_small}/conversations.parquet' UNION ALL "
        "SELECT CAST(conv_id AS BIGINT) + 100000, CAST(turn AS BIGINT), role, text FROM odd"
    )
    more = table.unionByName(odd.selectExpr("conv_id + 100000 conv_id", "turn", "role", "text"))
    ours = sorted(map(tuple, chat.rotated(more).collect()), key=repr)
    assert ours == sorted(con.execute(chat.ORACLE).fetchall(), key=repr)


def test_native_and_empty(spark):
    made = chat.rotated(spark.createDataFrame([], SCHEMA))
    assert made.collect() == []
    assert not re.search("Python|Pandas|Arrow", made._jdf.queryExecution().toString())


def test_ties_over_many_parts(spark):
    rows = [(None, k % 2, "anna", f"text {k * 7919 % 3000:04}" + "." * (k % 5)) for k in range(3000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    found = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # parts stay as many as asked for
        for parts in ("7", "1"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(sorted(map(tuple, chat.rotated(table).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert found[0] == found[1]
    con = duckdb.connect()
    con.register("conversations", table.toPandas().astype({"conv_id": "Int64"}))
    assert found[0] == sorted(con.execute(chat.ORACLE).fetchall(), key=repr)
