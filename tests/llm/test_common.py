"""Words hashed in bulk, and batches by size."""

import random

import numpy as np
import pyarrow as pa
import pytest

from placerank.llm import common
from placerank.llm.common import HashedWords, small_batches


@pytest.mark.parametrize("at_once", [1, 7, 64, 1 << 20])
def test_equal_words_have_equal_hashes_wherever_they_stand(monkeypatch, at_once):
    monkeypatch.setattr(common, "_AT_ONCE", at_once)
    r = random.Random(3)
    parts = [b"a", b"b", b"ab", b"\x00", b"\xc3\xa9", b"longer-word", b"\xc2\xa0", b"z" * 50]
    texts = [b"", b" ", b"one", *(b"".join(r.choice(parts + [b" ", b"\n", b"\t \x0b", b"\r\x0c"]) for _ in range(r.randrange(60))) for _ in range(80))]
    found = HashedWords(texts)
    lists = [t.split() for t in texts]
    assert found.sizes.tolist() == [len(ws) for ws in lists]
    words = [w for ws in lists for w in ws]
    by_word = {}
    for i, (w, h) in enumerate(zip(words, found.hashes.tolist(), strict=True)):
        assert by_word.setdefault(w, h) == h and found.words(i, i + 1) == w
    assert len(set(by_word.values())) == len(by_word)
    assert found.words(0, min(5, len(words))) == b" ".join(words[:5])
    assert len(HashedWords([]).hashes) == 0


def test_batches_are_cut_by_bytes_and_lose_no_row():
    texts = ["x" * n for n in (10, 3, 0, 200, 5, 5)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "text"])
    got = list(small_batches([batch, batch.slice(0, 0)], most_bytes=20))
    assert [i for b in got for i in b.column("i").to_pylist()] == list(range(7))
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column("text").to_pylist()) <= 20 for b in got)
    assert np.all([b.num_rows for b in got])
