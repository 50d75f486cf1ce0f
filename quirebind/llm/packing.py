"""Packing: concatenate all documents and cut the row of ids into sequences.

Pass one tokenises and writes the ids, with a running total inside each
partition; the partitions' totals (one number each) are added up on the driver.
Pass two knows every document's global offset and cuts it at the multiples of
the length.  A piece is a boundary record: which ids of which document lie
where in which sequence.  Only the very last sequence is not full.

Defined cases: a null or empty text is one id, the end mark; repeated rows and
equal doc_ids are separate documents, packed one after the other; a null doc_id
is carried along; an empty table gives no piece; further columns are dropped.
The order of documents is the order of the stored rows.
"""

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirebind.llm import tokens
from quirebind.llm.words import map_rows
from quirebind.session import settle, small_batches

LENGTH = 4096
END = 2
_PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pieces(
    docs: DataFrame,
    length: int = LENGTH,
    end: int = END,
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``with_ids`` adds its ids (``tokens.id_kind``)."""
    with small_batches(docs.sparkSession):
        stored = settle(tokens.tokenised(docs, end, tokenizer))
    totals = stored.groupBy("part").agg(F.sum("n_tokens")).collect()  # one row per partition
    before = tokens.part_offsets([(r[0], r[1]) for r in totals])
    kind = tokens.id_kind(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, part, in_part, n, raw = (c[i].as_py() for c in batch.columns)
                ids, at, start = np.frombuffer(raw, kind), before[part] + in_part, 0
                while start < n:
                    offset = (at + start) % length
                    size = min(length - offset, n - start)
                    own = ids[start : start + size]
                    row = {
                        "doc_id": doc, "start": start, "length": size,
                        "ids_crc32": tokens.crc32_of(own), "doc_tokens": n,
                        "sequence_id": (at + start) // length, "offset": offset,
                    }
                    yield row | {"ids": own.tobytes()} if with_ids else row
                    start += size

    return map_rows(stored, run, _PIECE + ", ids binary" * with_ids)


def sequences(cut: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """sequence_id, n_tokens, ids (array), boundaries (where each piece begins
    and whose it is): the training rows of pieces cut ``with_ids``.

    A sequence holds ``length`` ids at most, so no group is large.
    """
    kind = tokens.id_kind(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in row["pieces"]), kind)
                yield {
                    "sequence_id": row["sequence_id"], "n_tokens": len(ids), "ids": ids.tolist(),
                    "boundaries": [
                        {k: p[k] for k in ("offset", "doc_id", "start", "length")}
                        for p in row["pieces"]
                    ],
                }

    whole = cut.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
        .alias("pieces")
    )
    return map_rows(
        whole, run,
        "sequence_id bigint, n_tokens int, ids array<int>, boundaries array<struct<"
        "offset: bigint, doc_id: bigint, start: bigint, length: bigint>>", rows=64,
    )
