import math
import re
import zlib
from collections import Counter

import awkward
import numpy as np

from tillroll.llm import lm_score as lm


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    """Base columns, and the smoothed score from exactly known levels."""
    words, pairs = Counter(), Counter()
    for r in rows:
        if not held(r[0]):
            t = tokens(r[1])
            words.update(t)
            pairs.update(zip([None, *t[:-1]], t))
    total, smooth = sum(words.values()), sum(words.values()) + len(words) + 1
    mean = lambda c: 1.5 * 2 ** (c.bit_length() - 1) - 0.5 if c else 0.0
    out = []
    for r in rows:
        t = tokens(r[1])
        base = sum(math.log10((words[w] + 1) / smooth) for w in t)
        score = 0.0
        for h, w in zip([None, *t[:-1]], t):
            joint = mean(pairs[h, w])
            score += math.log10(min(1, (joint + lm.PRIOR * (mean(words[w]) + 1) / smooth) / (max(mean(words[h]), joint) + lm.PRIOR)))
        out.append((r[0], held(r[0]), len(t), sum(words[w] > 0 for w in t), total, base, score))
    return sorted(out, key=repr)


def check(df, tolerance, **options):
    want = brute([tuple(r) for r in df.select("doc_id", "text").collect()])
    got = sorted((tuple(r) for r in lm.score(df, **options).collect()), key=repr)
    got.sort(key=lambda r: repr(r[:4])), want.sort(key=lambda r: repr(r[:4]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    gap = np.array([r[6] for r in got]) - np.array([r[6] for r in want])
    assert np.abs(gap).sum() <= tolerance * sum(r[2] for r in want) and all(r[6] < 0 for r in got)
    return got


def test_equals_exact_counts_but_for_false_positives(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    for df in (awkward.docs(spark), table):
        got = check(df, 0.004, bits_each=40)  # hardly any false positives
        mean = lambda rows, k: sum(r[k] for r in rows) / sum(r[2] for r in rows)
    assert all(mean(part, 6) > mean(part, 5) for part in ([r for r in got if r[1]], [r for r in got if not r[1]]))
    check(table, 0.1)


def test_rare_words_parts_and_rounds_do_not_change_results(spark):
    df = awkward.docs(spark)
    key = lambda r: repr(r[:4])
    want = sorted((tuple(r) for r in lm.score(df, part_bytes=4000, bits_each=40).collect()), key=key)
    got = sorted((tuple(r) for r in lm.score(df, round_bytes=9000, part_bytes=4000, bits_each=40, frequent=20, block_words=500).collect()), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


def test_word_filters_in_rounds_do_not_change_results(spark):
    df = awkward.docs(spark)
    key = lambda r: repr(r[:4])
    built, parts = lm.model(lm.texts(df).where(~lm.held_out(lm.F.col("doc_id"))), 2000, bits_each=40)
    sizes = dict(built.select("part", lm.F.length("word_bits")).collect())
    limit = 2 * max(sizes.values())
    ranges = lm.rounds(built, parts, limit, "word_bits")
    assert parts == len(sizes) and len(ranges) > 1 and [p for a, b in ranges for p in range(a, b)] == list(range(parts))
    assert all(sum(sizes[p] for p in range(a, b)) <= limit for a, b in ranges)  # nothing larger is sent at once
    want, got = (sorted((tuple(r) for r in lm.score(df, part_bytes=2000, bits_each=40, **more).collect()), key=key)
                 for more in ({}, {"round_bytes": limit}))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


def test_filter_reads_no_count_too_low():
    rng = np.random.default_rng(3)
    keys = lm.mix(np.arange(20000, dtype=np.uint64))
    counts = rng.zipf(1.5, 20000).clip(1, 10**9)
    f = lm.Filter([lm.build_filter(keys, counts).tobytes()], 1)
    read = f.levels(keys)
    assert np.all(read >= lm.level(counts)) and np.mean(read > lm.level(counts)) < 0.05
    assert np.mean(f.levels(lm.mix(np.arange(30000, 60000, dtype=np.uint64))) > 0) < 0.05


def test_empty_table(spark):
    assert lm.score(awkward.empty(spark)).count() == 0
