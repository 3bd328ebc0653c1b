import random

import awkward
import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm.common import byte_slices, segment_sums, split_words, text_bytes


@pytest.mark.parametrize("limit", [1, 40, 1000, 1 << 20])
@pytest.mark.parametrize("lower", [False, True])
def test_slices_keep_every_word_of_every_row(limit, lower):
    text = [r[1] or "" for r in awkward.rows()] + ["ÀA Z\x0bq\x1c", "", "  "]
    random.Random(1).shuffle(text)
    batch = pa.RecordBatch.from_arrays([pa.array(text), pa.array(range(len(text)))], names=["text", "n"])
    got, sizes = [], []
    for piece in byte_slices(iter([batch.slice(0, 7), batch.slice(7), batch.slice(0, 0)]), limit=limit):
        words, idx, off = split_words(piece.column(0), lower)
        names = words.to_pylist()
        got += [[names[i] for i in idx[a:b]] for a, b in zip(off[:-1], off[1:])]
        raw, at = text_bytes(piece.column(0))
        sizes += [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])]
        assert piece.num_rows == 1 or len(raw) <= limit
    assert sizes == text
    assert got == [[w.decode() for w in (t.encode().lower() if lower else t.encode()).split()] for t in text]


def test_segment_sums_with_empty_segments():
    assert segment_sums(np.array([1, 2, 3]), np.array([0, 0, 2, 2, 3, 3])).tolist() == [0, 3, 0, 3, 0]
