import hashlib
import re

from quirebind.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(v):
    return re.sub("[^0-9]", "", v)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 12 <= len(only_digits(v)) <= 19 and luhn(only_digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(only_digits(v)) <= 15),
]


def brute(text):
    found = [
        (m.start(), k, m.end(), name)
        for k, (name, pattern, good) in enumerate(BASE)
        for m in re.finditer(pattern, text or "") if good(m.group())
    ]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(found)]


ODD = [
    "a@b.c+d@e.f x a@b@c.d a..b@x-y.z. 1.2.3.4.5 1.2.3.256 0001.2.3.4 é😀 +1 (017) 555-7713 +49-30-12345-",
    "", None, "x" * 2000 + "@", "a@" + "b." * 500 + "c", "1" * 2000, "1-" * 500, "+" + "1 " * 500,
    "a@b.c " * 700, "%%a@b.c@d.e Dr. Paul Smith, token = \"abe29cfcdae4f03e1e339fcaa4c5b\" "
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (826) 555-4081 4929348385146306",
]


def test_base_spans_like_brute_force(spark, sf_small):
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").unionByName(odd)
    rows = {r.doc_id: r for r in pii.pii_report(docs).collect()}
    for r in docs.collect():
        want, got = brute(r.text), rows[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got.spans.split(",")) | {""}
        assert got.n_email == sum(w.startswith("email") for w in want)


def test_masks_and_odd_tables(spark):
    rows = [(1, "mail me: a@b.co or 1.2.3.4, ok", 30, "s"), (2, None, None, None), (None, "", 0, "s"),
            (4, "plain words only", 16, "s"), (4, "plain words only", 16, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    out = pii.masked(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "mail me: [EMAIL] or [IP], ok" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[None].text == "" and got[4].text == "plain words only"
    assert out.count() == 5
    assert pii.pii_report(docs.limit(0)).collect() == []
    plan = pii.pii_report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_labelers_are_weighed():
    """Votes that agree mark a kind of span as personal, votes against as not."""
    names = [*pii.LABELERS, *pii.FEATURES, "n"]
    good = dict(zip(names, [1, 1, 1, 1, 1, 5, 5, 3, 0, 5, 90], strict=True))
    bad = dict(zip(names, [0, -1, -1, -1, -1, 20, 9, 15, 4, 9, 60], strict=True))
    w = pii.fit([good, bad])
    score = lambda r: w["bias"][0] + sum(w[f][r[f]] for f in pii.FEATURES)
    assert score(good) > 0 > score(bad)
    assert pii.fit([])["bias"][0] <= 0


def test_many_spans_in_one_document(spark):
    """More spans than a block and a piece have, of which some overlap."""
    parts = [f"écrire {i}: u{i}@mail.org, call 555 123 {1000 + i} or 4111 1111 1111 1111" for i in range(700)]
    text = "\n".join(parts)
    docs = spark.createDataFrame([(1, text), (2, "x" + text)], "doc_id long, text string")
    for r in pii.pii_report(docs).collect():
        want = brute(("x" if r.doc_id == 2 else "") + text)
        got = r.spans.split(",")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got) and len(got) == len(set(got))
        places = [tuple(map(int, g.split(":")[1:])) for g in got]
        assert places == sorted(places, key=lambda p: p[0])
        own = {tuple(map(int, w.split(":")[1:])) for w in want}
        for a, b in set(places) - own:
            assert not any(x < b and a < y for x, y in own)
    out = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert out[2] == "x" + out[1] and out[1].count("[EMAIL]") == 700 and out[1].count("écrire ") == 700
    assert "@" not in out[1] and "4111" not in out[1]
