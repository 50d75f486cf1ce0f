"""Words of a text, and Arrow tasks over rows of text."""

import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    """Maximal runs without a space, tab or line end; none for null."""
    return WORD.findall(text) if text else []


def lower_ascii(text: str) -> str:
    """A-Z in lower case; all other letters stay."""
    return text.encode().lower().decode()


def lower_words(text: str | None) -> list[str]:
    """Words of the text in lower case (A-Z only)."""
    return WORD.findall(lower_ascii(text)) if text else []


def map_rows(
    df: DataFrame,
    task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, Any]]],
    schema: str,
    rows: int = 2000,
) -> DataFrame:
    """``mapInArrow`` for a task that yields one dict per output row.

    At most ``rows`` output rows are held before they are handed on.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, Any]] = []
        for row in task(batches):
            held.append(row)
            if len(held) >= rows:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return df.mapInArrow(run, fields)


def own_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, with as many underscores in front as no column begins with."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = f"_{prefix}"
    return prefix


def named(columns: list[str]) -> list[Column]:
    """The columns of these very names, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that most operators read; further columns go."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
