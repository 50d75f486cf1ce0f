import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from quirebind.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, node int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Every node by a dictionary of prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    turns = {c: [t[2] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    length = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((
        m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
        hashlib.sha256(",".join(str(c) for c in m if length[c] == len(p)).encode()).hexdigest(),
    ) for p, m in members.items())


def corpus():
    rnd = random.Random(3)
    say = [f"text {i} " * (i % 5) for i in range(6)]
    rows = []
    for c in [*range(0, 330, 3), *range(-210, -80, 7), 100, 200, -100, 10**12, 10**12 + 5]:
        n = rnd.choice([1, 2, 3, 7, 9, 20])
        for t in range(n):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(say[:2] if t < 4 else say), 1))
    for c in range(1000, 1040):  # the same for all, and one for all but its last turn
        rows += [(c, t, "user", f"same {t}", 1) for t in range(7)]
        rows += [(c, 7, "bot", "é" * c, 1)] if c % 2 else []
    rows += [(5, 0, None, None, 1), (5, None, "user", "first", 1), (5, 0, "user", "tie", 1), (5, 0, "user", "tie", 1),
             (None, 0, "user", "nobody", 1), (700, 0, "user", "only one turn", 1), (701, 0, "", "", 1)]
    rnd.shuffle(rows)
    return rows


def got(spark, rows, level):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.trie(df, level).collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("level, turns, piece", [(1024, 100_000, 50_000), (1024, 7, 3), (3, 5, 2)])
def test_like_brute_force(spark, monkeypatch, level, turns, piece):
    """In large blocks; in blocks of a few strings; and in several levels."""
    monkeypatch.setattr(trie, "BLOCK_TURNS", turns)
    monkeypatch.setattr(trie, "PIECE", piece)
    rows = corpus()
    want = brute(rows)
    found = got(spark, rows, level)
    assert found == sorted(want, key=lambda r: (r[0], r[1])) and len(found) > 500


def test_blocks_merge_to_one_tree():
    """Whatever the borders, open nodes add up to what one block finds."""
    rnd = random.Random(9)
    record = lambda i: i.to_bytes(16, "big") + (i + 3).to_bytes(4, "big")
    seqs = sorted({b"".join(record(rnd.randrange(3)) for _ in range(rnd.randrange(7))) for _ in range(300)})
    rows = [(bytes(16), s, bytes([i % 250]) * 16, 1 + i % 3, i, True, False, 0, 0, 0) for i, s in enumerate(seqs)]
    whole = {r[0]: r for r in trie.block_nodes(rows, 0, 1024, 0, 0)}
    for _ in range(30):
        cuts = sorted(rnd.sample(range(1, len(rows)), rnd.randrange(1, 9)))
        merged = defaultdict(list)
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            before = trie.shared(rows[a - 1], rows[a]) if a else 0
            after = trie.shared(rows[b - 1], rows[b]) if b < len(rows) else 0
            for r in trie.block_nodes(rows[a:b], 0, 1024, before, after):
                merged[r[0]].append(r)
        assert set(merged) == set(whole)
        for node, parts in merged.items():
            assert len(parts) == 1 or all(r[9] for r in parts)
            for at in (3, 6, 7, 8):
                assert sum(r[at] for r in parts) == whole[node][at]
            assert min(r[4] for r in parts) == whole[node][4]


def test_search_tree_is_balanced():
    """A word of one letter out of 1,000 is found in ten steps."""
    above, code, ends = trie.tree([[i] for i in range(1000)])
    assert above[1:] == [0] * 1000 and [code[e] for e in ends] == list(range(1000))
    assert code[1] == 500


def test_odd_tables(spark):
    assert got(spark, [], 1024) == []
    assert got(spark, [(None, 1, "a", "b", 1)], 1024) == []
    one = [(9, 0, "user", "a", 1)]
    assert got(spark, one, 1024) == sorted(brute(one))


def test_given_data_and_twin(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    found = sorted((tuple(r[c] for c in COLUMNS) for r in trie.trie(df).collect()), key=lambda r: (r[0], r[1]))
    assert found == sorted(want, key=lambda r: (r[0], r[1]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_small}/conversations.parquet'")
    result = con.execute(trie.ORACLE)
    assert [c[0] for c in result.description] == COLUMNS
    assert sorted(result.fetchall(), key=lambda r: (r[0], r[1])) == found
