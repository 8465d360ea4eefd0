"""What hashing texts leaves behind in a worker that goes on with other tasks, and that pieces hash as the whole does."""

import tracemalloc

import numpy as np
import pyarrow as pa

from webcapture.llm import common, decontaminate
from webcapture.llm.common import OTHER_BASE, Hasher, mix


def test_no_table_as_long_as_the_text_is_kept():
    data = np.random.default_rng(1).integers(0, 256, 5_000_000, dtype=np.uint8)
    tracemalloc.start()
    for base in (common._BASE, OTHER_BASE):
        Hasher(data, base)(np.array([0]), np.array([len(data)]))
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 2e6


def test_hashes_are_those_of_the_polynomial():
    data = np.random.default_rng(2).integers(0, 256, 9000, dtype=np.uint8)
    for base in (common._BASE, OTHER_BASE):
        for start, end in ((0, 0), (0, 1), (4095, 4097), (4096, 8192), (5, 9000), (9000, 9000)):
            raw = sum((int(c) + 1) * pow(base, i, 1 << 64) for i, c in enumerate(data[start:end])) + (end - start) * 0xD6E8FEB86659FD93
            assert Hasher(data, base)(np.array([start]), np.array([end]))[0] == mix(np.array([raw % 2**64], np.uint64))[0]


def test_words_in_pieces_are_those_of_the_whole(monkeypatch):
    texts = pa.array(["one two", None, "", "three  Four-five", "six"], pa.string())
    whole = decontaminate._words(texts)
    monkeypatch.setattr(decontaminate, "pieces", lambda batches: (batch.slice(k, 1) for batch in batches for k in range(len(batch))))
    parted = decontaminate._words(texts)
    assert whole[1].tolist() == parted[1].tolist() == [0, 2, 2, 2, 5, 6]
    assert whole[0].tolist() == parted[0].tolist()
    assert [x.tolist() for x in decontaminate._words(pa.array([], pa.string()))] == [[], [0]]
