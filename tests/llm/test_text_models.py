"""License scans and language identification."""

import random

from quirebind.llm import language, licenses

MIT = licenses.TEMPLATES["MIT"]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], old + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        a = [rnd.choice("abcdefghijk") for _ in range(rnd.randrange(25))]
        b = [x for x in a if rnd.random() > 0.2] + [rnd.choice("abc") for _ in range(3)]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= longest_common(a, b)
    same = list("abcabc")
    assert licenses.align(same, same) == [(i, i) for i in range(6)]


def test_licenses_found_once_each(spark):
    changed = MIT.replace("charge", "cost").replace("sublicense", "lend")
    rows = [(1, f"foo bar {MIT} baz\n{changed}\n{MIT}"), (2, None), (3, ""), (4, "a license to read the text"),
            (5, "Released under the MIT License.\n" * 3), (None, "All rights reserved."), (5, "x"), (6, "x " * 50_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licenses int")
    got = [(r.doc_id, [x.license for x in r.licenses]) for r in licenses.license_report(docs).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, ["MIT"] * 3), (2, []), (3, []), (4, []), (5, ["MIT notice"] * 3), (None, ["Reserved"]), (5, []), (6, []),
    ], key=repr)
    assert licenses.license_report(docs.limit(0)).collect() == []


def test_grams_of_words():
    decode = lambda n: "".join(chr(n >> s & (1 << 21) - 1) for s in (42, 21, 0) if n >> s)
    got = sorted(decode(int(n)) for n in language.grams("Ab, ü"))
    want = ["a", "b", "ü", " a", "ab", "b ", " ü", "ü ", " ab", "ab ", " ü "]
    assert got == sorted(want)
    assert len(language.grams("12, 3")) == 0


def test_languages_of_held_out_documents(spark, sf_small):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(900_001, None, "en", "s", 0), (900_002, "123 !!", "de", "s", 0), (None, "the and of", None, "s", 0)]
    docs = table.unionByName(spark.createDataFrame(rows, table.schema))
    got = {r.doc_id: r for r in language.identified(docs).collect()}
    assert (got[900_001].lang_pred, got[900_001].score) == ("und", 0.0) and got[900_002].lang_pred == "und"
    assert not got[None].held_out
    known = {r.doc_id: r.lang for r in table.collect()}
    out = [r for r in got.values() if r.held_out and r.doc_id in known]
    assert len(out) > 150
    assert sum(r.lang_pred == known[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identified(docs.limit(0)).collect() == []
    unlabelled = docs.filter("doc_id < 20").selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in language.identified(unlabelled).collect()} == {"und"}


def test_every_passage_opens_a_window():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    found = lambda text: [f[0] for f in scanner.scan(text)]
    words = sorted(set(licenses.tokens(MIT)) - licenses.COMMON, key=licenses.tokens(MIT).count)
    changed = MIT
    for w in words[:3]:  # the only words that the text as a whole has once
        changed = changed.replace(w, "xyz")
    assert changed.count("xyz") >= 3
    assert found(f"{MIT} foo {changed}") == ["MIT"] * 2
    assert found(f"{changed} foo {' '.join(words[:3])}") == ["MIT"]
    for k in range(1, 9):
        assert found("All rights reserved. " * k) == ["Reserved"] * k
        assert found("all rights are reserved; " * k) == ["Reserved"] * k
        assert found(f"{MIT} {changed} " * k) == ["MIT"] * (2 * k)


def test_passages_apart_like_all_choices():
    rnd = random.Random(2)
    for _ in range(200):
        spans = {(a := rnd.randrange(12), a + rnd.randrange(1, 6), rnd.choice([0.8, 0.9, 1.0])) for _ in range(7)}
        best = 0.0
        for mask in range(1 << len(spans)):
            own = sorted(s for i, s in enumerate(spans) if mask >> i & 1)
            if all(x[1] <= y[0] for x, y in zip(own, own[1:], strict=False)):
                best = max(best, sum(s[2] for s in own))
        got = licenses._apart(spans)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
        assert abs(sum(s[2] for s in got) - best) < 1e-6
