"""Token ids of whole texts, with a memory of the pieces seen before.

The word tokenizer drops white space and never merges across it, nor between a
letter and what is none.  So a text's ids are those of its runs of letters and of
other marks in a row.  A task keeps the ids of the pieces it has met (up to a
fixed number, then it starts anew; that changes no result) and calls the
tokenizer for new pieces only.  Words with an apostrophe or with characters
beyond the Latin letters, where normalisation may move borders, stay whole.
A run of Latin letters is normalised and split letter by letter, so how the
tokenizer spells each letter is asked once and its model gets the spelled run.
"""

import os
import re
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quirebind.llm.words import id_and_text, lower_ascii, map_rows, words

REMEMBERED = 800_000
_PIECE = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+|[^\x20\x09-\x0Da-zA-ZÀ-ÖØ-öø-ÿ]+")
_RUN = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+")
_HARD = re.compile(r"'|[^\x00-\x7FÀ-ÿ]")
_LETTERS = [chr(c) for c in range(256) if _RUN.fullmatch(chr(c))]
_ENCODERS: dict[str, "WordEncoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_of(text: str) -> list[str]:
    """A text cut where the tokenizer cuts it anyway, A-Z in lower case as it
    does itself.  Its special tokens, known in lower case only, stay whole."""
    if "<|" in text:
        return words(text)
    text = lower_ascii(text)
    if "'" not in text and (text.isascii() or not _HARD.search(text)):
        return _PIECE.findall(text)
    return [x for w in words(text) for x in ([w] if _HARD.search(w) else _PIECE.findall(w))]


class WordEncoder:
    """Ids of texts as bytes of little-endian unsigned integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.kind = np.dtype("<u2" if small else "<u4")
        self.known: dict[str, bytes] = {}
        self.spelled = self._spelling()

    def _spelling(self) -> dict[int, str] | None:
        """What the model gets for each Latin letter; none where the tokenizer does not
        take a run of letters as one word, spelled letter by letter."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or cut is None:
            return None
        shown = lambda x: [w for w, _ in cut.pre_tokenize_str(normal.normalize_str(x))]
        made = {ord(c): "".join(shown(c)) for c in _LETTERS}
        run = "".join(_LETTERS)
        return made if shown(run) == [run.translate(made)] else None

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn(self, unknown: list[str]) -> None:
        """New pieces; runs of letters go to the tokenizer's model as they are spelled,
        or else to the tokenizer many at a time, each a word of one text."""
        if len(self.known) + len(unknown) > REMEMBERED:
            self.known.clear()
        runs = [x for x in unknown if _RUN.fullmatch(x)]
        if self.spelled:
            cut, letters = self.tokenizer.model.tokenize, self.spelled
            made = [[t.id for t in cut(x.translate(letters))] for x in runs]
            raw, before = self._bytes([i for ids in made for i in ids]), 0
            for x, ids in zip(runs, made, strict=True):
                end = before + len(ids) * self.kind.itemsize
                self.known[x] = raw[before:end]
                before = end
            runs = []
        for at in range(0, len(runs), 200):
            some = runs[at : at + 200]
            whole = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.searchsorted(np.array(whole.word_ids), np.arange(len(some)), "right")
            raw, before = self._bytes(whole.ids), 0
            for x, end in zip(some, (ends * self.kind.itemsize).tolist(), strict=True):
                self.known[x] = raw[before:end]
                before = end
        for x in unknown:
            if x not in self.known:
                ids = self.tokenizer.encode(x, add_special_tokens=False).ids
                self.known[x] = self._bytes(ids)

    def texts(self, texts: list[str | None], end: int) -> list[bytes]:
        """The ids of each text, followed by the id ``end``."""
        out, last = [], self._bytes([end])
        for text in texts:
            pieces = pieces_of(text) if text else []
            ids = list(map(self.known.get, pieces))
            if None in ids:
                self._learn(list({w for w, x in zip(pieces, ids, strict=True) if x is None}))
                known = self.known
                ids = [known[w] if x is None else x for w, x in zip(pieces, ids, strict=True)]
            ids.append(last)
            out.append(b"".join(ids))
        return out


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(
    docs: DataFrame, end: int, tokenizer: str | None = None, texts: int = 64
) -> DataFrame:
    """doc_id, part, in_part, n_tokens, ids: the ids of each document.

    ``part`` is the partition the row was made in and ``in_part`` the number of
    ids that partition made before: the first of two passes of a prefix sum.
    A null text is an empty one.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        made = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, texts):
                some = batch.slice(at, texts)
                ids = made.texts(some.column(1).to_pylist(), end)
                for doc, b in zip(some.column(0).to_pylist(), ids, strict=True):
                    n = len(b) // made.kind.itemsize
                    yield {"doc_id": doc, "part": part, "in_part": before, "n_tokens": n, "ids": b}
                    before += n

    return map_rows(
        id_and_text(docs), run,
        "doc_id bigint, part int, in_part bigint, n_tokens bigint, ids binary", rows=256,
    )


def part_offsets(totals: list[tuple[int, int]]) -> dict[int, int]:
    """Second pass: how many ids lie before each partition."""
    before, offsets = 0, {}
    for part, n in sorted(totals):
        offsets[part] = before
        before += n
    return offsets


def id_kind(tokenizer: str | None = None) -> str:
    """How ``tokenised`` stores ids: two bytes where the vocabulary allows it."""
    return encoder(tokenizer or default_tokenizer()).kind.str
