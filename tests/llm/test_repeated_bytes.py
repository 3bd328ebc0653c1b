import hashlib
import random
from collections import Counter

import awkward
import numpy as np
import pytest

from tillroll.llm import repeated_bytes as rb
from tillroll.llm.suffix_array import common_prefixes, suffix_array


def brute(rows):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[k:k + rb.LENGTH] for _, t in raw for k in range(len(t) - rb.LENGTH + 1))
    out = []
    for doc, t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - rb.LENGTH + 1):
            if seen[t[k:k + rb.LENGTH]] > 1:
                gone[k:k + rb.LENGTH] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def passages(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcde é\n") for _ in range(n))
    pool = [text(rng.choice([90, 199, 200, 201, 230, 300, 700])) for _ in range(12)]
    rows = []
    for k in range(45):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += [text(rng.randrange(0, 150)), rng.choice(pool)]
            if rng.random() < 0.3:
                p = list(parts[-1])
                p[rng.randrange(len(p))] = "X"
                parts[-1] = "".join(p)
        rows.append((900 + k, "".join(parts), "en", "a", 0))
    rows += [(990, "ab" * 400, "en", "a", 0), (991, "z" * 199, "en", "a", 0), (992, "z" * 199, "en", "a", 0), (993, "q" * 200, "en", "a", 0),
             (994, "q" * 201, "en", "a", 0), (995, rows[3][1], "en", "a", 0)]
    return rows


@pytest.mark.parametrize("seed,group", [(1, rb.GROUP), (2, 3)])
def test_removal_equals_brute_force(spark, seed, group):
    extra = passages(seed)
    got = awkward.multiset(rb.remove_repeats(awkward.docs(spark, extra), group), *COLUMNS)
    assert got == brute(awkward.rows(extra))


def test_hot_passage_in_many_texts_is_split(spark):
    rng = random.Random(8)
    line = "".join(rng.choice("abcdef ") for _ in range(150))
    rest = lambda n: "".join(rng.choice("ghijkl ") for _ in range(n))
    rows = [(k, rest(200) + line + rest(rng.choice([3, 60, 300])), "en", "a", 0) for k in range(60)]
    rows += [(100 + k, rest(100) + rows[k][1][150:420] + rest(100), "en", "a", 0) for k in range(8)]
    df = spark.createDataFrame(rows, awkward.SCHEMA)
    assert awkward.multiset(rb.remove_repeats(df, 4), *COLUMNS) == brute(rows)


def test_whole_small_table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet").where("doc_id < 120")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert awkward.multiset(rb.remove_repeats(df), *COLUMNS) == brute(rows)


def test_empty_table(spark):
    assert rb.remove_repeats(awkward.empty(spark)).count() == 0


def test_long_texts_are_cut_between_windows(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("ab") for _ in range(3000)).encode()
    monkeypatch.setattr(rb, "BLOCK", 700)
    windows = []
    for raw, begin, end, row, offset in rb._blocks(rb.pa.array([text.decode(), "short", text.decode()])):
        t, start, n, anchor, key = rb.anchors(raw, begin, end)
        for x, s, m, a in zip(t, start, n, anchor):
            for k in range(m):
                windows.append((int(row[x]), int(s - begin[x] + offset[x] + k)))
                assert s + k <= a <= s + k + rb.LENGTH - rb.GRAM
    assert sorted(windows) == [(r, k) for r in (0, 2) for k in range(len(text) - rb.LENGTH + 1)]


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(400):
        size = rng.choice([1, 2, 3, 5, 250])
        x = np.array([rng.randrange(size) for _ in range(rng.randrange(1, 200))], np.uint8)
        if rng.random() < 0.3:
            x = np.concatenate([x, x[:rng.randrange(1, len(x) + 1)], x])
        raw = x.tobytes()
        want = sorted(range(len(raw)), key=lambda k: raw[k:])
        assert suffix_array(x).tolist() == want
        some = suffix_array(x, 6).tolist()
        assert [raw[k:k + 6] for k in some] == [raw[k:k + 6] for k in want]
        before, length = common_prefixes(x, np.array(want), 20)
        for a, b in zip(want, want[1:]):
            n = next((n for n in range(20) if raw[a + n:a + n + 1] != raw[b + n:b + n + 1] or b + n >= len(raw) or a + n >= len(raw)), 20)
            assert before[b] == a and length[b] == n
