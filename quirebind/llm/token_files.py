"""Token files: ids in patched frame-of-reference blocks.

A file is the ids of consecutive documents, in ascending doc_id order::

    magic 4 bytes | n_docs, n_ids, n_blocks u32
    lengths u32 [n_docs]                   ids per document
    starts  u32 [n_blocks]                 where each block's bytes begin
    blocks: least u32 | width u8 | n_exceptions u16 | exception places u16[] |
            exception values u32[] | packed bits

A block holds ``BLOCK`` ids.  Its least id is subtracted; the width is the
number of bits that ``SHARE`` of the differences fit in; the low bits of all are
packed, and the ids that do not fit are listed as exceptions with their places.
The index of starts lets a reader decode any block alone.

Files are rows (file_no, first_id, content) of a Parquet table, so any store
that Spark writes to can hold them, a failed task leaves none behind, and a
lost executor's files are written again.  A file takes whole documents until it
has ``FILE_IDS`` ids; a longer document has a file of its own.

Defined cases: a null or empty text has only its end id; null doc_ids come
first; documents of the same doc_id are ordered by their text's hash, equal rows
in any order; an empty table gives no file; further columns are dropped.
"""

import struct
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind.llm import tokens
from quirebind.llm.words import map_rows

MAGIC = b"QBT1"
END = 1
BLOCK = 512
SHARE = 0.9
FILE_IDS = 1 << 19


def _bits(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) + 1, 0)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, share: float = SHARE) -> list[bytes]:
    """The blocks of a row of ids."""
    out: list[bytes] = []
    whole = len(ids) // block
    groups = [ids[: whole * block].reshape(whole, block)] if whole else []
    if len(ids) % block:
        groups.append(ids[whole * block :].reshape(1, -1))
    for rows in groups:
        rows = rows.astype(np.int64)
        least = rows.min(axis=1)
        over = rows - least[:, None]
        n = rows.shape[1]
        at = min(n - 1, max(0, int(np.ceil(share * n)) - 1))
        width = _bits(np.partition(over, at, axis=1)[:, at])
        made: list[bytes] = [b""] * len(rows)
        for w in np.unique(width):
            mine = np.flatnonzero(width == w)
            part = over[mine]
            planes = np.unpackbits(
                part.astype("<u4").view(np.uint8).reshape(len(mine), n, 4), axis=2,
                count=int(w), bitorder="little")
            packed = np.packbits(planes.reshape(len(mine), -1), axis=1)
            for k, i in enumerate(mine):
                far = np.flatnonzero(part[k] >> w)
                made[i] = (
                    struct.pack("<IBH", least[i], w, len(far))
                    + far.astype("<u2").tobytes()
                    + rows[i, far].astype("<u4").tobytes()
                    + packed[k].tobytes()
                )
        out += made
    return out


def decode_block(raw: memoryview, n: int) -> np.ndarray:
    """The ``n`` ids of one block."""
    least, width, far = struct.unpack_from("<IBH", raw)
    at = 7
    places = np.frombuffer(raw, "<u2", far, at)
    values = np.frombuffer(raw, "<u4", far, at + 2 * far)
    at += 6 * far
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, (n * width + 7) // 8, at), count=n * width)
    planes = np.zeros((n, 32), np.uint8)
    planes[:, :width] = bits.reshape(n, width)
    ids = np.packbits(planes, axis=1, bitorder="little").view("<u4")[:, 0].astype(np.int64)
    ids += least
    ids[places] = values
    return ids


def encode_file(documents: list[np.ndarray]) -> bytes:
    lengths = np.array([len(d) for d in documents], "<u4")
    ids = np.concatenate(documents) if documents else np.array([], np.int64)
    blocks = encode_blocks(ids)
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1].astype("<u4")
    head = MAGIC + struct.pack("<III", len(documents), len(ids), len(blocks))
    return head + lengths.tobytes() + starts.tobytes() + b"".join(blocks)


def decode_file(raw: bytes) -> list[np.ndarray]:
    """The documents' ids of one file."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks = struct.unpack_from("<III", raw, 4)
    view = memoryview(raw)
    lengths = np.frombuffer(raw, "<u4", n_docs, 16).astype(np.int64)
    at = 16 + 4 * n_docs
    starts = np.frombuffer(raw, "<u4", n_blocks, at)
    at += 4 * n_blocks
    parts = [
        decode_block(view[at + int(s) :], min(BLOCK, n_ids - k * BLOCK))
        for k, s in enumerate(starts)
    ]
    ids = np.concatenate(parts) if parts else np.array([], np.int64)
    return np.split(ids, np.cumsum(lengths)[:-1]) if n_docs else []


def write_token_files(docs: DataFrame, path: str, end: int = END,
                      tokenizer: str | None = None) -> None:
    """Write the token files of all documents to ``path``."""
    name = tokenizer or tokens.default_tokenizer()
    spread = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.xxhash64("text").alias("tie"), F.rand(11).alias("deal"),
    )
    placed = spread.repartitionByRange("doc_id", "tie", "deal").sortWithinPartitions(
        "doc_id", "tie", "deal"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        from pyspark import TaskContext

        made = tokens.encoder(name)
        part, before, file_no = TaskContext.get().partitionId(), 0, 0
        ids_of: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0

        def done() -> dict[str, Any]:
            return {"part": part, "file_no": file_no, "in_part": before, "n_ids": held,
                    "doc_ids": names, "content": encode_file(ids_of)}

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                for doc, raw in zip(
                    some.column(0).to_pylist(), made.texts(some.column(1).to_pylist(), end),
                    strict=True,
                ):
                    own = np.frombuffer(raw, made.kind)
                    if ids_of and held + len(own) > FILE_IDS:
                        yield done()
                        before, file_no, held, ids_of, names = before + held, file_no + 1, 0, [], []
                    ids_of.append(own)
                    names.append(doc)
                    held += len(own)
        if ids_of:
            yield done()

    map_rows(
        placed.select("doc_id", "text"), run,
        "part int, file_no int, in_part bigint, n_ids bigint, doc_ids array<bigint>, "
        "content binary", rows=4,
    ).write.parquet(path)


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document written."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids")).collect()  # one row per partition
    before = tokens.part_offsets([(r[0], r[1]) for r in totals])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, in_part, names, raw = (c[i].as_py() for c in batch.columns)
                at = before[part] + in_part
                for doc, ids in zip(names, decode_file(raw), strict=True):
                    row = {"doc_id": doc, "start": at, "n_tokens": len(ids),
                           "ids_crc32": tokens.crc32_of(ids)}
                    yield row | {"ids": ids.tolist()} if with_ids else row
                    at += len(ids)

    return map_rows(
        files.select("part", "in_part", "doc_ids", "content"), run,
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
        + ", ids array<int>" * with_ids,
    )
