import math
import random

import awkward
import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import near_duplicates as nd
from tillroll.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    """Component (smallest id) of every row, by comparing all pairs of distinct sets."""
    sets = {}
    for r in rows:
        sets.setdefault(frozenset(shingles(r[1])), []).append(r[0])
    keys = [k for k in sets if k]
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for n, a in enumerate(keys):
        for b in keys[:n]:
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    ids = {}
    for k in keys:
        ids.setdefault(find(k), []).extend(i for i in sets[k] if i is not None)
    out = []
    for r in rows:
        s = frozenset(shingles(r[1]))
        out.append((r[0], len(s), r[0] if not s else min(ids[find(s)], default=None)))
    return sorted(out, key=repr)


def families(seed, n_families=12, copies=14):
    rng = random.Random(seed)
    rows, at = [], 1000
    shared = awkward.words(rng, 30, 50)
    for _ in range(n_families):
        base = awkward.words(rng, rng.choice([6, 12, 40, 120, 300]), 5000).split()
        for _ in range(copies):
            new = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                kind, k = rng.random(), rng.randrange(len(new))
                if kind < 0.6:
                    new[k] = f"e{rng.randrange(30)}"
                elif kind < 0.8 and len(new) > 2:
                    del new[k]
                else:
                    new.insert(k, f"i{rng.randrange(30)}")
            text = " ".join(new)
            text = text.upper() if rng.random() < 0.1 else text
            if rng.random() < 0.3:
                text += "\n" + shared
            rows.append((at, text, "en", "a", len(text)))
            at += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark, monkeypatch):
    for seed, long_list in ((1, nd.LONG_LIST), (3, 4)):
        monkeypatch.setattr(nd, "LONG_LIST", long_list)
        extra = families(seed)
        got = awkward.multiset(nd.jaccard_components(awkward.docs(spark, extra)), "doc_id", "n_shingles", "component_id")
        assert got == brute(awkward.rows(extra))


def test_frequent_table_does_not_change_the_links(spark, monkeypatch):
    extra = families(4, 6, 40)
    want = brute(awkward.rows(extra))
    for least in (2, 10**9):
        monkeypatch.setattr(nd, "FREQUENT", least)
        got = awkward.multiset(nd.jaccard_components(awkward.docs(spark, extra)), "doc_id", "n_shingles", "component_id")
        assert got == want


def test_letters_around_one_passage_make_few_pairs(spark, monkeypatch):
    """The passage is taken for rare, so every letter stands in its lists; parities leave next to no pair to verify."""
    rng = random.Random(11)
    form = awkward.words(rng, 60, 5000)
    rows = [(k, f"{awkward.words(rng, 100, 10**6)} {form} {awkward.words(rng, 60 + k % 40, 10**6)}", "en", "a", 1) for k in range(150)]
    rows += [(1000 + k, rows[k][1] + " one more", "en", "a", 1) for k in range(20)]
    seen = []
    whole = nd.verified

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(nd, "verified", counted)
    monkeypatch.setattr(nd, "FREQUENT", 10**9)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert awkward.multiset(nd.jaccard_components(df), "doc_id", "n_shingles", "component_id") == brute([r[:2] for r in rows])
    assert len(seen) == 2 and seen[1] < len(rows)


def test_linked_sets_pass_the_filters():
    """Sizes of linked sets have neighbouring bands; their parities differ in no more bits than they may differ in shingles."""
    rng = np.random.default_rng(2)
    for n in range(1, 3000):
        band = lambda x: math.floor(math.log(x) / math.log(nd.BAND))
        assert band(-(-nd.PERCENT * n // 100)) >= band(n) - 1
    for n in (1, 4, 9, 60, 700):
        key = nd.mix(rng.integers(0, 2**63, 3 * n).astype(np.uint64))
        for shared in range(0, n + 1, max(1, n // 20)):
            a, b = key[:n], np.concatenate([key[:shared], key[n:2 * n - shared]])
            odd = nd.parities(np.repeat([0, 1], n), np.concatenate([a, b]), 2).view(np.uint64)
            differ = sum(int(x ^ y).bit_count() for x, y in zip(*odd.tolist()))
            assert differ <= 2 * (n - shared)


def test_whole_small_table(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert awkward.multiset(nd.jaccard_components(table), "doc_id", "n_shingles", "component_id") == brute(rows)


def test_one_row_of_each_component_stays(spark):
    extra = families(5, 5) + [(None, awkward.rows()[12][1], "en", "a", 1)]
    df = awkward.docs(spark, extra)
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    want = brute(awkward.rows(extra))
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    empties = [r[0] for r in awkward.rows(extra) if not shingles(r[1])]
    assert ids == sorted([c for c in {c for _, n, c in want if n} if c is not None] + empties)
    alone = {c for _, n, c in want if n and c is None}
    assert kept.where("doc_id is null").count() == len(alone)


def test_empty_table(spark):
    assert nd.jaccard_components(awkward.empty(spark)).count() == 0
    assert nd.keep_one(awkward.empty(spark)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(200, 260)] + [(5, k) for k in range(6, 60)] + [(90, 91), (91, 92), (92, 90), (99, 99)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


def test_tables_without_a_reader_are_deleted(spark):
    import glob
    from tillroll.session import scratch_path
    left = lambda name: set(glob.glob(scratch_path(spark, f"{name}/*").removeprefix("file:")))
    names = ["near_groups", "near_classes", "near_sizes", "near_heads", "near_lists", "near_entries", "near_open",
             "near_pairs", "component_edges", "component_minima"]
    before = {n: left(n) for n in names}
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 3:])) for i in range(9)] + [(20, "other words stand here alone now")]
    got = {r.doc_id: r.component_id for r in nd.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: 0 for i in range(9)}, 20: 20}
    assert {n: left(n) - before[n] for n in names} == {n: set() for n in names}
