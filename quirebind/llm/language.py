"""Language identification by rank-order profiles.

A profile is the ``PROFILE`` most frequent letter n-grams (1 to 3, words padded by
a blank, lower case) in order.  A document is as far from a language as its n-grams
are out of place in the language's profile; one that is not there counts as far as
it can be.  The nearest language is predicted.

Profiles are counted over all training texts.  Every partition counts its own
n-grams first, so the shuffle has one row per partition, language and n-gram.  The
driver gets ``PROFILE`` rows per language.

Defined cases: a null text, or one without letters, is ``und`` with score 0, as is
everything when nothing could be learned; documents of null lang are not learned
from; a null doc_id is not held out; equal counts are ordered by n-gram, equal
distances by language; repeated rows count each; an empty table gives an empty
result; further columns are dropped.
"""

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirebind.llm.words import map_rows

PROFILE = 400
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per process."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text as numbers: 21 bits for each letter."""
    if not text:
        return np.array([], np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(_letters()[codes], codes, 32)
    codes = np.concatenate(([32], codes, [32]))
    blank = codes == 32
    codes = codes[~(blank & np.roll(blank, 1)) | (np.arange(len(codes)) == 0)]
    if len(codes) < 3:
        return np.array([], np.int64)
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] << 21 | codes[2:]
    return np.concatenate((codes[codes != 32], two, three[codes[1:-1] != 32]))


def ranked(numbers: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    values, counts = np.unique(numbers, return_counts=True)
    return values[np.lexsort((values, -counts))[:size]]


def held_out(doc_id: Column, folds: int, which: int) -> Column:
    """Whether a document is in fold ``which``; one without an id is in none."""
    number = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(number % folds == which, F.lit(False))


def learn(texts: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The profile of every language of (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            own: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own.setdefault(lang, []).append(grams(text.as_py()))
                if len(own[lang]) == 500:
                    held[lang] = _added(held.get(lang), own.pop(lang))
            for lang, some in own.items():
                held[lang] = _added(held.get(lang), some)
        for lang, (values, counts) in held.items():
            for v, n in zip(values.tolist(), counts.tolist(), strict=True):
                yield {"lang": lang, "gram": v, "n": n}

    rows = map_rows(
        texts.filter(F.col("lang").isNotNull()).select("text", "lang"), count,
        "lang string, gram bigint, n bigint", rows=10_000,
    ).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = rows.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "gram", "rank")
    profiles: dict[str, list[int]] = {}
    for lang, gram, _ in sorted(map(tuple, best.collect()), key=lambda r: (r[0], r[2])):
        profiles.setdefault(lang, []).append(gram)
    return profiles


def _added(have, some: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(np.concatenate(some), return_counts=True)
    if have is None:
        return values, counts
    both, inverse = np.unique(np.concatenate((have[0], values)), return_inverse=True)
    total = np.bincount(inverse, np.concatenate((have[1], counts))).astype(np.int64)
    return both, total


class Identifier:
    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.size = size
        self.known = []
        for lang in sorted(profiles):
            values = np.array(profiles[lang], np.int64)
            order = np.argsort(values)
            self.known.append((lang, values[order], order))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 less its distance, the farthest being 1."""
        own = ranked(grams(text), self.size)
        if not len(own) or not self.known:
            return UNKNOWN, 0.0
        places = np.arange(len(own))
        best, least = UNKNOWN, None
        for lang, values, order in self.known:
            at = np.searchsorted(values, own).clip(max=len(values) - 1)
            there = values[at] == own
            far = int(np.where(there, np.minimum(np.abs(order[at] - places), self.size),
                               self.size).sum())
            if least is None or far < least:
                best, least = lang, far
        return best, 1 - least / (self.size * len(own))


def identified(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
    )
    profiles = learn(rows.filter(~F.col("held_out")), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        identifier = Identifier(profiles, size)
        for batch in batches:
            for doc, text, out in zip(
                batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                strict=True,
            ):
                lang, score = identifier.predict(text.as_py())
                yield {"doc_id": doc, "held_out": out, "lang_pred": lang, "score": score}

    return map_rows(
        rows.select("doc_id", "text", "held_out"), run,
        "doc_id bigint, held_out boolean, lang_pred string, score double",
    )
