import random
import uuid
import zlib

import numpy as np
import pytest

from quirebind.llm import packing, token_files, tokens
from quirebind.session import shared_folder

ODD = [
    "<|endoftext|> a<|endoftext|>b, don't 's!! it's. Σας ΟΔΟΣ, é, x́. a b c \x1c\x1d d\x85e",
    "12,3 ''. (. ).., .. <|ENDOFTEXT|>", "", None, "İ. ß, ﬁ, Ⅷ, ² ². ÀÉ,Þ× ÷a", "word*** x%%% ###",
    "𝔘𝔫𝔦 日本語, текст. ª º µ", "a" * 5000 + " " + "b c " * 3000,
]


def whole(text):
    made = tokens.encoder(tokens.default_tokenizer()).tokenizer
    return made.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_ids_of_the_whole_text():
    made = tokens.WordEncoder(tokens.default_tokenizer())
    for text, got in zip(ODD, made.texts(ODD, 2), strict=True):
        assert np.frombuffer(got, made.kind).tolist() == whole(text) + [2]


def test_memory_that_starts_anew_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    made = tokens.WordEncoder(tokens.default_tokenizer())
    for text, got in zip(ODD, made.texts(ODD, 2), strict=True):
        assert np.frombuffer(got, made.kind).tolist() == whole(text) + [2]


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    rows = [(1000 + i, t, "x") for i, t in enumerate(ODD)] + [(None, "null id", "x"), (5000, "b", "x"),
                                                            (5000, "a", "x"), (5000, "a", "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    table = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("doc_id", "text", "lang ids")
    return table.unionByName(odd).repartition(5)


def test_packing_has_no_gap(spark, docs):
    pieces = sorted(packing.pieces(docs, 512).collect(), key=lambda p: (p.sequence_id, p.offset))
    at = 0
    for p in pieces:
        assert p.sequence_id * 512 + p.offset == at and p.offset + p.length <= 512
        at += p.length
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(whole(r.text) + [2])
    for p in pieces:
        cut = [crc(t[p.start : p.start + p.length]) for t in texts[p.doc_id] if len(t) == p.doc_tokens]
        assert p.ids_crc32 in cut
    assert at == sum(len(t) for v in texts.values() for t in v)
    assert packing.pieces(docs.limit(0)).collect() == []


def test_sequences_are_full(spark, docs):
    made = packing.sequences(packing.pieces(docs, 256, with_ids=True)).collect()
    made.sort(key=lambda r: r.sequence_id)
    assert all(r.n_tokens == 256 == len(r.ids) for r in made[:-1])
    assert all(r.boundaries[0].offset == 0 for r in made)


def test_token_files_round_trip(spark, docs):
    path = f"{shared_folder(spark)}/t-{uuid.uuid4()}"
    token_files.write_token_files(docs, path)
    rows = token_files.read_token_files(spark, path, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(whole(r.text) + [1])
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        assert r.ids in texts[r.doc_id]
        at += r.n_tokens
    assert len(rows) == docs.count()
    empty = f"{shared_folder(spark)}/t-{uuid.uuid4()}"
    token_files.write_token_files(docs.limit(0), empty)
    assert token_files.read_token_files(spark, empty).collect() == []


def test_blocks_of_any_values():
    rnd = random.Random(3)
    for n in (1, 2, 511, 512, 513, 1500):
        for top in (1, 2, 255, 49407, 2**32 - 1):
            own = np.array([rnd.randrange(top) for _ in range(n)], np.int64)
            own[rnd.randrange(n)] = 2**32 - 1  # an outlier
            raw = token_files.encode_file([own[: n // 2], own[n // 2 :]])
            back = token_files.decode_file(raw)
            assert np.concatenate(back).tolist() == own.tolist()
    assert token_files.decode_file(token_files.encode_file([])) == []


def test_one_block_alone():
    own = np.arange(2000) % 700
    blocks = token_files.encode_blocks(own)
    assert token_files.decode_block(memoryview(blocks[2]), 512).tolist() == own[1024:1536].tolist()
