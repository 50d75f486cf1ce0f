"""Blocks of token files: bits are packed as bytes, not as numbers of eight."""

import tracemalloc

import numpy as np

from quirebind.llm import token_files


def test_blocks_are_packed_in_little_memory():
    ids = np.random.default_rng(3).integers(0, 49_000, 1 << 17)
    tracemalloc.start()
    blocks = token_files.encode_blocks(ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(ids)  # was over 256 bytes an id
    back = [token_files.decode_block(memoryview(b), token_files.BLOCK) for b in blocks]
    assert (np.concatenate(back) == ids).all()


def test_blocks_of_all_widths_come_back():
    for top in (0, 1, 255, 65_535, 65_536, (1 << 32) - 1):
        ids = np.linspace(0, top, 300).astype(np.int64)
        (block,) = token_files.encode_blocks(ids)
        assert (token_files.decode_block(memoryview(block), 300) == ids).all()
