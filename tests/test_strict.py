"""Broken markup and messages: what readers reject is a row, never an exception."""

import json
import time

import pytest
from pyspark.sql import functions as F

from quirebind import fixed
from quirebind.functions import text
from quirebind.operators import intake
from quirebind.plans.convert import NO_TEXT, convert_corpus

T = "<w:p><w:t>%s</w:t></w:p>"


@pytest.mark.parametrize(("xml", "want"), [
    (T % "a" + T % "b&#x110000;c" + T % "d", "a"),
    (T % "a&#9999999999999999999999999999999999999999;" + T % "d", ""),
    (T % "a" + T % "x &broken; y", "a"),
    (T % "a&#xD800;b", "a�b"),
    (T % "a&#x1F600;&#65;&#x0000042;", "a😀AB"),
    (T % "a&#1;b", ""),
    (T % "<![CDATA[kept <text> & more]]>", "kept <text> & more"),
    (T % "<![CDATA[one]]> two <![CDATA[&amp;]]>", "one two &amp;"),
    (T % "a &amp;lt; b", "a &lt; b"),
])
def test_references_and_cdata(spark, xml, want):
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(text.markup_text(F.col("x")).alias("t")).first().t == want


@pytest.mark.parametrize(("xml", "want"), [
    (T % "a" + "<w:p><w:t>b</w:x>" + T % "c", "a\n\nb"),
    (T % "a" + "</w:p>" + T % "c", "a"),
    ("<a><p><t>x</t><b><c></b></c></p><p><t>y</t></p></a>", "x"),
    ("<a><p><t>x<b>y</c>z</t></p></a>", "xy"),
    ("<a><p><t>x</t></p><p><x:t>y</t></p><p><t>z</t></p></a>", "x\n\ny"),
    ("<?xml version='1.0'?><!DOCTYPE a><a><p/><t  q='</x>'>x</t ><br/><t>y</t></a>", "xy"),
    ("<p><t>one</t><t>two", "onetwo"),
    ("<p><t>one</t><t>two <", "onetwo"),
    ("<p><t>one</t></p></p><p><t>two</t></p>", "one"),
    ("no tags", ""),
])
def test_tags_must_match(spark, xml, want):
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(text.markup_text(F.col("x")).alias("t")).first().t == want


def test_matching_is_not_quadratic(spark):
    """A document of 200,000 tags, deep and wide, within seconds."""
    deep = "<d>" * 20_000 + "</d>" * 20_000
    xml = "<a>" + T % "x" * 20_000 + deep + T % "last" + "</b>" + T % "lost"
    df = spark.createDataFrame([(xml,)], "x string")
    start = time.time()
    got = df.select(text.markup_text(F.col("x")).alias("t")).first().t
    assert got.endswith("x\n\nlast") and got.count("x") == 20_000
    assert time.time() - start < 60


ID, USER = "00000000-0000-4000-8000-000000000001", "00000000-0000-4000-8000-000000000002"
GOOD = {"job_id": ID, "user_id": USER, "original_filename": "a.md", "file_key": "k",
        "timestamp": "2024-01-05T09:09:09Z"}


@pytest.mark.parametrize(("value", "problem"), [
    (json.dumps(GOOD), None),
    ("  " + json.dumps(GOOD) + "\n", None),
    (json.dumps(GOOD) + " trailing", "json"),
    (json.dumps(GOOD) + ", {}", "json"),
    ("[" + json.dumps(GOOD) + "]", "json"),
    (json.dumps(GOOD | {"original_filename": 5}), "json"),
    (json.dumps(GOOD | {"file_key": None, "more": [1]}), None),
    (json.dumps(GOOD | {"timestamp": "2024-13-45T99:99:99Z"}), "timestamp"),
    (json.dumps(GOOD | {"timestamp": "2024-02-30T10:00:00Z"}), "timestamp"),
    (json.dumps(GOOD | {"timestamp": "2024-02-29T10:00:00.123456+02:00"}), None),
    (json.dumps({k.upper(): v for k, v in GOOD.items()}), None),
    (json.dumps(GOOD | {"user_id": "x"}), "id"),
    ("{broken", "json"), ("", "json"), (None, "json"), ("null", "json"), ("7", "json"),
])
def test_messages(spark, value, problem):
    row = intake.parse_messages(spark.createDataFrame([(value,)], "value string")).first()
    assert row.problem == problem
    if problem is None:
        assert (row.job_id, row.user_id) == (ID, USER)


def test_document_without_text_fails_with_a_message(spark):
    messages = spark.createDataFrame(
        [("j", "u", "a.md", "1"), ("k", "u", "b.md", "2")],
        "job_id string, user_id string, original_filename string, file_key string",
    )
    docs = spark.createDataFrame([("1", None)], "file_key string, text string")
    rows = convert_corpus(messages, docs, F.lit("2024-01-01").cast("timestamp")).collect()
    assert {(r.job_id, r.status, r.error_message, r.units_count) for r in rows} == {
        ("j", "FAILED", NO_TEXT, 0), ("k", "FAILED", fixed.MISSING_DOCUMENT, 0),
    }
