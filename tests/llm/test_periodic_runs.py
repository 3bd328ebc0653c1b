import hashlib
import random
import re
import zlib
from fractions import Fraction

import awkward
import numpy as np
import pytest

from tillroll.llm import periodic_runs as P

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_runs(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([numbers[w] for w in words], np.int64)
    out = []
    for q in range(1, len(x) // 4 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            part = x[i:j + q]
            if len(part) >= max(6, 4 * q) and not any((part[r:] == part[:-r]).all() for r in range(1, q)):
                out.append((i, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, planted=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if planted and h is not None and h % 10 == 0 and n:
        g = h // 10
        a, old = g % n, words
        p = 1 + (n - a) // (3 + g % 8)
        words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_transform_gives_exact_sums_of_squared_differences():
    rng = np.random.default_rng(1)
    for block in (1, 2, 8, 64, 512):
        x = rng.integers(0, 3, 6 * block).astype(np.uint64)
        starts = np.arange(0, 4) * block
        begin, apart = P.block_matches(x, starts, np.full(4, len(x)), block)
        want = {(s, d) for s in starts for d in range(block, 2 * block)
                if s + d + block <= len(x) and (x[s:s + block] == x[s + d:s + d + block]).all()}
        assert set(zip(begin.tolist(), apart.tolist())) == want


def test_runs_equal_brute_force_on_repetitive_texts():
    rng = random.Random(3)
    for _ in range(150):
        many = []
        for _ in range(rng.randrange(1, 5)):
            words = []
            while rng.random() < .85:
                base = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(1, 9))]
                words += (base * 9)[:rng.randrange(1, 40)]
            many.append(words)
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in many])]).astype(np.int64)
        runs, ends = P.find_runs(np.array([w for ws in many for w in ws], np.int64), offsets)
        for k, words in enumerate(many):
            assert [tuple(r) for r in runs[ends[k]:ends[k + 1]].tolist()] == brute_runs(words)


def test_sums_that_are_zero_only_modulo_the_prime_make_no_run(monkeypatch):
    monkeypatch.setattr(P, "_P", np.uint64(17))
    monkeypatch.setattr(P, "PRIME", 17)
    monkeypatch.setattr(P, "ROOT", 3)
    monkeypatch.setattr(P, "_made", {})
    rng = np.random.default_rng(5)
    for _ in range(40):  # transforms of up to 16 points: periods below 16
        x = np.concatenate([rng.integers(0, 17, 10), np.tile(rng.integers(0, 17, 3), 4), rng.integers(0, 17, 9)])
        runs, _ = P.find_runs(x, np.array([0, len(x)]))
        assert [tuple(r) for r in runs.tolist()] == brute_runs(x.tolist())


def test_one_word_over_and_over_and_a_long_period():
    n = 40_000
    assert P.find_runs(np.zeros(n, np.int64), np.array([0, n]))[0].tolist() == [[0, n, 1]]
    x = np.concatenate([np.arange(50), np.tile(np.arange(100, 100 + n // 5), 4), [7]])
    assert P.find_runs(x, np.array([0, len(x)]))[0].tolist() == [[50, n // 5 * 4, n // 5]]


@pytest.mark.parametrize("planted", [True, False])
def test_awkward_documents(spark, planted):
    more = [(100 + k, awkward.words(random.Random(k), 300, 2 + k % 5), "en", "a", 1) for k in range(40)]
    more += [(200, "x\x0by\x0cx y x\ty\nx y x y", "en", "a", 1), (201, "a " * 3000, "en", "a", 1)]
    df = awkward.docs(spark, more)
    rows = awkward.rows(more)
    if planted:
        want = sorted((brute(r[0], r[1]) for r in rows), key=repr)
        assert awkward.multiset(P.digest(df), *COLUMNS) == want
        assert sum(r[1] > 0 for r in want) > 8
    else:
        got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in P.periodic_runs(df).collect()}
        assert got == {r[0]: brute_runs(WORD.findall(r[1] or "")) for r in rows}


def test_collapsed_text_keeps_one_period(spark):
    df = spark.createDataFrame([(1, "start one two one two one two one two end")], "doc_id long, text string")
    row = P.periodic_runs(df).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 2)] and row["collapsed"] == "start one two end"


def test_empty_table(spark):
    out = P.digest(awkward.empty(spark))
    assert out.columns == COLUMNS and out.collect() == []
