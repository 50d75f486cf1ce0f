"""The prefix trie of conversations, by ternary search trees per range shard.

Every conversation is rebuilt from the head of another and its own tail (see
``rebuilt``), and every distinct sequence of first turns is a node.

1. A turn is known by the md5 of its role and text, with the length of its text: 20 bytes.
   Texts are read once and never move.  Turns are numbered inside their conversation by
   range partitions and the partitions' totals, and a conversation's turns are strung
   together in strings of ``LEVEL`` turns, so a row is bounded however long a conversation.
   A string hangs on the node it starts from, named by a hash of all turns before it.
2. Equal strings are one row with their number of conversations and least conv_id; that
   combines before its shuffle, so copies cost a row a task.  Strings are range-partitioned.
3. A task reads its strings in order, block by block.  In a block turns are encoded by a
   dictionary, and strings go into a ternary search tree, the median first, then the
   medians of both halves.  A loop from the last node made to the first adds up members,
   children, leaves and savings.  A block knows how many turns its first string shares
   with the string before, and its last with the one behind: nodes on these paths are open,
   and only the first block that has a node counts it as a child and takes its text off.
   So every sum adds up over blocks.  Open nodes, one path or two a block, are merged by
   node; all others are complete.  Levels are done from the deepest up, each handing its
   sums to the nodes that it hangs on; conversations of up to ``LEVEL`` turns are one level.
4. ``ends_sha256``: the conversations that end in a node are sorted in range partitions.  A
   list inside one partition is hashed there; what touches a border hands on pieces of
   ``PIECE`` numbers, which are hashed in order, a piece at a time.

Defined cases: null roles and texts are empty; turns are ordered by turn, null first, those
of one number by the md5 of role and text, and repeated rows are turns of their own; rows
without a conv_id belong to no conversation and are left out; ``%`` takes the sign of the
conv_id; an empty table has no conversation, so no node, the root neither; further columns
are dropped.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebind.session import settle

FAMILY, HEADS = 100, 6
LEVEL = 1024
RANGED = 64
BLOCK_TURNS = 100_000
PIECE = 50_000
SALT = 16
_RECORD, _KEY = 20, 16
NOTHING = hashlib.sha256(b"").hexdigest()


# --- turns ----------------------------------------------------------------------

def _record(role: Column, text: Column) -> Column:
    """16 bytes for role and text, 4 for the code points of the text."""
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.length(text).cast("bigint")), 8, "0")
    return F.unhex(F.concat(F.md5(named), size))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), rec of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"), _record(role, text).alias("rec"),
    )
    dealt = turns.withColumn("deal", F.rand(13))  # splits repeated rows over partitions
    placed = settle(
        dealt.repartitionByRange("conv_id", "turn", "rec", "deal")
        .select("conv_id", "turn", "rec", F.spark_partition_id().alias("part"))
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("conv_id", "part").agg(F.count("*").alias("rows")).select(
        "conv_id", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
    )
    own = Window.partitionBy("conv_id", "part").orderBy("turn", "rec")
    local = placed.withColumn("pos", F.row_number().over(own) - 1)
    return local.join(totals, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("pos")).alias("pos"), "rec"
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, rec: the first h turns of conversation c - c % 100, then the own
    turns of c after its first h, with h = crc32(c) % 6; and one row per conversation
    with pos and rec null."""
    turns = settle(numbered(conversations))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.select("conv_id").distinct().withColumns({
        "h": head.cast("int"), "base": F.col("conv_id") - F.col("conv_id") % FAMILY,
    })
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).groupBy(
        "conv_id"
    ).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "rec"))), lambda s: s["rec"])
          .alias("recs"))
    met = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "h",
        F.coalesce(F.slice("recs", F.lit(1), F.col("h")), F.expr("cast(array() as array<binary>)"))
        .alias("recs"),
    )
    first = met.select("conv_id", F.posexplode_outer("recs").alias("pos", "rec"))
    marks = met.select(
        "conv_id", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("rec"))
    after = turns.join(met.select("conv_id", "h", F.size("recs").alias("got")), "conv_id").filter(
        F.col("pos") >= F.col("h"))
    return (
        first.filter("rec is not null").withColumn("pos", F.col("pos").cast("bigint"))
        .unionByName(after.select("conv_id", (F.col("got") + F.col("pos") - F.col("h")).alias("pos"), "rec"))
        .unionByName(marks)
    )


def _name(a: Column, b: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def strings(turns: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Distinct strings: k, start, ids, end, n, first, ended, goes; and (end, conv_id)."""
    placed = turns.withColumns({
        "k": F.coalesce(F.floor(F.col("pos") / level), F.lit(0)),
        "x": F.when(F.col("rec").isNotNull(), F.xxhash64("rec", "pos")),
        "y": F.when(F.col("rec").isNotNull(), F.xxhash64("pos", "rec", F.lit("second"))),
    })
    row = F.when(F.col("rec").isNotNull(), F.struct("pos", F.hex("rec").alias("hex")))
    chunks = settle(placed.groupBy("conv_id", "k").agg(  # LEVEL turns at most
        F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda s: s["hex"]), ""))
        .alias("ids"),
        F.coalesce(F.bit_xor("x"), F.lit(0)).alias("x"), F.coalesce(F.bit_xor("y"), F.lit(0)).alias("y"),
    ))
    order = Window.partitionBy("conv_id").orderBy("k")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    marks = chunks.select(
        "conv_id", "k", F.bit_xor("x").over(until).alias("ex"), F.bit_xor("y").over(until).alias("ey"),
        F.lead("k").over(order).isNull().alias("last"),
    )
    x, y = F.col("ex").bitwiseXOR(F.col("x")), F.col("ey").bitwiseXOR(F.col("y"))
    strung = chunks.join(marks, ["conv_id", "k"]).select(
        "conv_id", "k", "ids", "last", _name(x, y).alias("start"),
        _name(F.col("ex"), F.col("ey")).alias("end"),
    )
    distinct = strung.groupBy("k", "start", "ids", "end").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"),
        F.bool_or("last").alias("ended"), F.bool_or(~F.col("last")).alias("goes"),
    )
    return settle(distinct), strung.filter("last").select("end", "conv_id")


# --- trees ----------------------------------------------------------------------

def shared(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> int:
    """How many symbols (start, then turns) two strings (start, ids) have in common."""
    if a[0] != b[0]:
        return 0
    most, n = min(len(a[1]), len(b[1])) // _RECORD, 0
    while n < most and a[1][n * _RECORD : (n + 1) * _RECORD] == b[1][n * _RECORD : (n + 1) * _RECORD]:
        n += 1
    return 1 + n


def tree(strings: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """A ternary search tree of sorted distinct strings of numbers.

    Gives per tree node the node above it in the trie and its number, and per string the
    node of its end.  Node 0 is above all.  Medians go in first, so a level of the search
    halves what is left.
    """
    code, above = [-1], [-1]
    less, more, next_ = [0], [0], [0]
    ends = [0] * len(strings)

    def made(symbol: int, parent: int) -> int:
        code.append(symbol)
        above.append(parent)
        for links in (less, more, next_):
            links.append(0)
        return len(code) - 1

    ranges = [(0, len(strings))]
    while ranges:
        low, high = ranges.pop()
        if low >= high:
            continue
        middle = (low + high) // 2
        ranges += [(middle + 1, high), (low, middle)]
        at = 0
        for symbol in strings[middle]:
            parent, now, links = at, next_[at], None
            if not now:
                at = next_[parent] = made(symbol, parent)
                continue
            while symbol != code[now]:
                links = less if symbol < code[now] else more
                if not links[now]:
                    links[now] = made(symbol, parent)
                now = links[now]
            at = now
        ends[middle] = at
    return above, code, ends


KIND = (
    "node binary, parent binary, depth bigint, n bigint, first bigint, above bigint, "
    "children bigint, leaves bigint, saved bigint, open boolean, top boolean, goes boolean, "
    "ended binary"
)
_NAMES = [f.split()[0] for f in KIND.split(", ")]
_TYPES = {"binary": pa.binary(), "bigint": pa.int64(), "boolean": pa.bool_()}
_ARROW = [_TYPES[f.split()[1]] for f in KIND.split(", ")]


def block_nodes(rows: list[tuple], k: int, level: int, before: int, after: int) -> list[tuple]:
    """The nodes of a block of sorted strings, as far as the block knows.

    A row is (start, ids, end, n, first, ended, goes, children, leaves, saved), the last
    three from the level below.  ``before`` and ``after`` are the symbols that the first
    string shares with the string before the block, and the last with the one behind.
    """
    turns = [
        [ids[i : i + _RECORD] for i in range(0, len(ids), _RECORD)] for _, ids, *_ in rows
    ]
    starts = sorted({r[0] for r in rows})
    words = sorted({t for own in turns for t in own})
    start_of = {s: i for i, s in enumerate(starts)}
    code_of = {w: i for i, w in enumerate(words)}
    above, code, ends = tree([
        [start_of[r[0]], *map(code_of.__getitem__, own)] for r, own in zip(rows, turns)
    ])
    size = len(above)
    depth, node = [-1] * size, [b""] * size
    n, first = [0] * size, [1 << 63] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    goes, ended = [False] * size, [None] * size
    owned, open_, inner = [True] * size, [False] * size, [False] * size
    for t in range(1, size):
        p = above[t]
        depth[t] = depth[p] + 1
        inner[p] = True
        node[t] = (
            hashlib.blake2b(node[p] + words[code[t]][:_KEY], digest_size=_KEY).digest()
            if depth[t] else starts[code[t]]
        )

    def path(t: int, symbols: int) -> Iterator[int]:
        while t:
            if depth[t] < symbols:
                yield t
            t = above[t]

    for t in path(ends[0], before):
        owned[t], open_[t] = False, True
    for t in path(ends[-1], after):
        open_[t] = True
    extended = after > depth[ends[-1]]
    for i, row in enumerate(rows):
        t = ends[i]
        n[t], first[t], goes[t] = row[3], row[4], row[6]
        ended[t] = row[2] if row[5] else None
        children[t], leaves[t], saved[t] = row[7:10]
        if row[6]:
            node[t] = row[2]
        if not inner[t] and not row[7] and not (i == len(rows) - 1 and extended):
            leaves[t] = 1
    for t in range(size - 1, 0, -1):
        p = above[t]
        text = int.from_bytes(words[code[t]][_KEY:], "big") if depth[t] else 0
        saved[t] += (n[t] - owned[t]) * text
        n[p] += n[t]
        first[p] = min(first[p], first[t])
        children[p] += owned[t]
        leaves[p] += leaves[t]
        saved[p] += saved[t]
    out = []
    for t in range(1, size):
        p = above[t]
        known = p and not open_[p] and (depth[p] or not k)
        out.append((
            node[t], node[p] if p else None, k * level + depth[t], n[t], first[t],
            first[p] if known else None, children[t], leaves[t], saved[t], open_[t], not depth[t],
            goes[t], ended[t],
        ))
    return out


def _borders(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """Per partition: symbols shared with the string before it, and with the one behind.

    Two numbers per partition reach the driver."""
    string = F.struct("start", "ids")
    order = Window.orderBy("part")  # a row per partition
    ends = placed.groupBy("part").agg(F.min(string).alias("low"), F.max(string).alias("high"))
    around = ends.select(
        "part", "low", "high", F.lag("high").over(order).alias("past"),
        F.lead("low").over(order).alias("coming"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                pair = {c: (r[c]["start"], r[c]["ids"]) for c in ("low", "high", "past", "coming") if r[c]}
                out.append((
                    r["part"],
                    shared(pair["past"], pair["low"]) if "past" in pair else 0,
                    shared(pair["high"], pair["coming"]) if "coming" in pair else 0,
                ))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], names=["part", "before", "after"])

    rows = around.mapInArrow(run, "part bigint, before bigint, after bigint").collect()
    return {r["part"]: (r["before"], r["after"]) for r in rows}


def _level_nodes(strung: DataFrame, k: int, level: int) -> DataFrame:
    """Nodes of the strings of one level, open ones in several rows."""
    placed = settle(
        strung.repartitionByRange("start", F.substring("ids", 1, RANGED * _RECORD))
        .withColumn("part", F.spark_partition_id())
    )
    borders = _borders(placed)
    most = BLOCK_TURNS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes(rows: list[tuple], before: int, after: int) -> pa.RecordBatch:
            columns = zip(*block_nodes(rows, k, level, before, after))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _ARROW)], names=_NAMES)

        held: list[tuple] = []
        turns, part, before = 0, None, 0
        for batch in batches:
            for p, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and p != part:
                    yield nodes(held, before, borders[part][1])
                    held = []
                elif turns >= most:
                    common = shared(held[-1], row)
                    yield nodes(held, before, common)
                    held, before, turns = [], common, 0
                if p != part:
                    part, before, turns = p, borders[p][0], 0
                held.append(tuple(row))
                turns += 1 + len(row[1]) // _RECORD
        if held:
            yield nodes(held, before, borders[part][1])

    dealt = placed.repartition("part").sortWithinPartitions("part", "start", "ids").select(
        "part", "start", "ids", "end", "n", "first", "ended", "goes", "children", "leaves", "saved")
    return settle(dealt.mapInArrow(run, KIND))


# --- lists of conversations that end in a node ----------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (end, conv_id): hashes of lists inside, pieces of those at the borders."""
    out: list[tuple] = []
    now, ids, cut, first = None, [], False, True

    def done(border: bool) -> None:
        if border or cut:
            out.append((now, ids[0], ",".join(map(str, ids)), None))
        else:
            out.append((now, None, None, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["end", "at", "piece", "sha"])

    for batch in batches:
        for end, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if end != now:
                if ids:
                    done(border=first)
                    first = False
                now, ids, cut = end, [], False
            elif len(ids) >= PIECE:
                cut = True
                done(border=True)
                ids = []
            ids.append(conv)
            if len(out) >= 1000 or (out and out[-1][2] and len(out[-1][2]) > 100_000):
                yield batch_of(out)
                out.clear()
    if ids:
        done(border=True)
    if out:
        yield batch_of(out)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (end, at, piece): a hash per end."""
    now, sha = None, None
    names = ["end", "sha"]
    for batch in batches:
        for end, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if end != now:
                if sha:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], names=names)
                now, sha = end, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(piece.encode())
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], names=names)


def ends_hashes(ended: DataFrame) -> DataFrame:
    """end, sha: the hash of the conv_ids that end there, ascending, comma-joined."""
    sorted_ = ended.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    some = settle(sorted_.mapInArrow(_pieces, "end binary, at bigint, piece string, sha string"))
    pieces = some.filter("sha is null").select("end", "at", "piece")
    rest = pieces.repartition("end").sortWithinPartitions("end", "at").mapInArrow(
        _chained, "end binary, sha string")
    return some.filter("sha is not null").select("end", "sha").unionByName(rest)


# --- the trie -------------------------------------------------------------------

def trie(conversations: DataFrame, level: int = LEVEL) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    strung, ended = strings(settle(rebuilt(conversations)), level)
    deepest = strung.agg(F.max("k")).first()[0]
    rows, below = None, None
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("children", "leaves", "saved")]
    for k in range(deepest if deepest is not None else 0, -1, -1):
        own = strung.filter(F.col("k") == k).drop("k")
        if below is None:
            own = own.select("*", *zero)
        else:
            own = own.join(below, "end", "left").na.fill(0, ["children", "leaves", "saved"])
        nodes = _level_nodes(own, k, level)
        below = nodes.filter("top").groupBy(F.col("node").alias("end")).agg(
            *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        shown = nodes if k == 0 else nodes.filter("not top")
        rows = shown if rows is None else rows.unionByName(shown)
    closed = rows.filter("not open")
    merged = rows.filter("open").groupBy("node").agg(
        *[F.max(c).alias(c) for c in ("parent", "depth", "ended")],
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
        F.min("first").alias("first"),
    ).withColumn("above", F.lit(None).cast("bigint"))
    kept = ["node", "parent", "depth", "n", "first", "above", "children", "leaves", "saved", "ended"]
    every = closed.select(*kept).unionByName(merged.select(*kept))
    parents = merged.select("node", "first").unionByName(closed.filter("goes").select("node", "first"))
    # Children of open nodes look their parent up; salted, since one may have most of them.
    salt = F.sequence(F.lit(0), F.lit(SALT - 1))
    known = parents.select(
        F.col("node").alias("parent"), F.col("first").alias("found"), F.explode(salt).alias("salt"))
    asking = "above is null and parent is not null"
    looked = every.filter(asking).withColumn(
        "salt", F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int")
    ).join(known, ["parent", "salt"]).withColumn("above", F.col("found")).select(*kept)
    full = every.filter(f"not ({asking})").unionByName(looked)
    hashed = full.filter("ended is not null").join(
        ends_hashes(ended).withColumnRenamed("end", "ended"), "ended")
    plain = full.filter("ended is null").withColumn("sha", F.lit(NOTHING))
    return hashed.unionByName(plain, allowMissingColumns=True).select(
        F.col("first").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"),
    )


ORACLE = f"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END,
    i::UBIGINT)) AS crc
), turns AS (
  SELECT conv_id AS c, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT c, k, size, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k, size) - 1 AS pos FROM turns
), convs AS (
  SELECT c, c - c % {FAMILY} AS base, CAST(xor(list_reduce(
    list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT),
    lambda s, b: xor(s // 256, crc[CAST(xor(s, b) % 256 AS BIGINT) + 1]), 4294967295::UBIGINT
  ), 4294967295::UBIGINT) % {HEADS} AS BIGINT) AS h
  FROM (SELECT DISTINCT c FROM placed), table_of
), joined AS (
  SELECT v.c, 0 AS half, p.pos, p.k, p.size FROM convs v JOIN placed p ON p.c = v.base AND p.pos < v.h
  UNION ALL
  SELECT v.c, 1, p.pos, p.k, p.size FROM convs v JOIN placed p ON p.c = v.c AND p.pos >= v.h
), strung AS (
  SELECT v.c, coalesce(list(j.k ORDER BY half, pos) FILTER (j.k IS NOT NULL), []) AS keys,
    coalesce(list(j.size ORDER BY half, pos) FILTER (j.k IS NOT NULL), []) AS sizes
  FROM convs v LEFT JOIN joined j ON j.c = v.c GROUP BY v.c
), members AS (
  SELECT c, unnest(range(len(keys) + 1)) AS depth, keys, sizes FROM strung
), nodes AS (
  SELECT depth, keys[1:depth] AS path, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(any_value(sizes[depth]), 0) AS size,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(keys) = depth), '') AS ended
  FROM members GROUP BY 1, 2
), under AS (
  SELECT a.depth, a.path, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS n_leaves,
    sum((b.n_convs - 1) * b.size) AS saved
  FROM nodes a JOIN nodes b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path
  LEFT JOIN (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes
             WHERE depth > 0 GROUP BY 1, 2) k ON k.depth = b.depth AND k.path = b.path
  GROUP BY 1, 2
)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs,
  (SELECT count(*) FROM nodes x WHERE x.depth = a.depth + 1 AND x.path[1:a.depth] = a.path) AS n_children,
  CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens,
  sha256(a.ended) AS ends_sha256
FROM nodes a JOIN under u ON u.depth = a.depth AND u.path = a.path
LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.path = a.path[1:a.depth - 1]
"""
