import random

import awkward
import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontamination as dc


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for k, y in enumerate(b):
            row.append(max(0, above[k] + (dc.MATCH if x == y else dc.OTHER), above[k + 1] - dc.GAP, row[k] - dc.GAP))
        best, above = max(best, max(row)), row
    return best


def plain(text):
    return [w for w in map(dc.normal, (text or "").split()) if w]


def enough(score, words):
    """The rule of the module's docstring, word for word."""
    least = min(2 * 7, 0.8 * 2 * words)
    return score >= min(max(0.4 * 2 * words, least), 2 * 13)


def brute(rows, items):
    out = set()
    for item, text in items:
        words = plain(text)
        if len(words) >= dc.SEED:
            for r in rows:
                score = smith_waterman(words, plain(r[1]))
                if enough(score, len(words)):
                    out.add((r[0], item, round(score / (dc.MATCH * len(words)), 9)))
    return out


def runs(words, n):
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


def pairs(found):
    return {(r.doc_id, r.item_id, round(r.score, 9)) for r in found.collect()}


@pytest.fixture(scope="module")
def case():
    rng = random.Random(2)
    items = [(k, awkward.words(rng, rng.choice([8, 20, 35, 80]), 900).capitalize() + ".") for k in range(14)]
    items += [(90, None), (91, ""), (92, "two words"), (93, "w1x w2x w3x"), (13, items[13][1])]
    rows = []
    for k in range(60):
        words = items[rng.randrange(14)][1].split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            at = rng.randrange(len(words))
            words[at:at + 1] = rng.choice([["edited"], [], ["put", "in"], [words[at].upper() + ","]])
        part = words[:len(words) // rng.choice([1, 1, 2, 4])]
        text = awkward.words(rng, rng.randrange(60), 900) + "\n" + " ".join(part) + " " + awkward.words(rng, 30, 900)
        rows.append((700 + k, text, "en", "a", len(text)))
    return items, rows


def test_pairs_equal_a_full_alignment_of_all_pairs(spark, case):
    items, extra = case
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    found = dc.contaminated(awkward.docs(spark, extra), bench)
    got = {(r.doc_id, r.item_id, round(r.score, 9)) for r in found.collect()}
    want = brute(awkward.rows(extra), items)
    assert got <= want and len(got) > 25
    text = {r[0]: plain(r[1]) for r in awkward.rows(extra)}
    own = {i: plain(t) for i, t in items}
    assert not any(runs(text[doc], 3) & runs(own[item], 3) for doc, item, _ in want - got)
    some = pairs(dc.contaminated(awkward.docs(spark, extra), bench, rare=2))  # most copied passages are frequent now
    assert some <= want
    for doc, item, _ in want - some:
        n = min(dc.LONG, len(own[item]))
        assert not runs(text[doc], n) & runs(own[item], n)
    for r in found.collect():
        words = plain({d[0]: d[1] for d in extra}[r.doc_id])[r.start_word:r.end_word]
        own = plain(dict(items)[r.item_id])
        assert round(smith_waterman(own, words) / (dc.MATCH * len(own)), 9) == round(r.score, 9)
    blocks = dc.contaminated(awkward.docs(spark, extra), bench, block_bytes=600)
    assert {(r.doc_id, r.item_id, round(r.score, 9)) for r in blocks.collect()} == got


def test_stage_drops_exactly_the_reported_documents(spark, case):
    items, extra = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = awkward.docs(spark, extra)
    hit = {r.doc_id for r in dc.contaminated(df, bench).collect()}
    kept = dc.clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r[0]) for r in awkward.rows(extra) if r[0] not in hit)


def test_empty_tables(spark, case):
    bench = spark.createDataFrame(case[0], "item_id long, text string")
    none = bench.where("item_id < 0")
    assert dc.contaminated(awkward.empty(spark), bench).count() == 0
    assert dc.contaminated(awkward.docs(spark), none).count() == 0
    assert dc.clean(awkward.docs(spark), none).count() == len(awkward.rows())


def test_frequent_ngrams_are_seeds_only_with_the_words_after_them():
    index = dc.build_index([(1, " ".join(f"a{k}" for k in range(42))), (2, "b1 b2 b3 b4")])
    counts = dc.np.full(len(index.seeds.grams), 50)
    rare, gone = dc._grams(index.items[0], 47)[[5, 9]]
    counts[dc.np.searchsorted(index.seeds.grams, rare)] = 1
    counts[dc.np.searchsorted(index.seeds.grams, gone)] = 0
    seeds = dc.choose_seeds(index, counts, rare=49)
    assert seeds.seeds.grams[~seeds.frequent].tolist() == [rare] and gone not in seeds.seeds.grams
    assert sorted(seeds.longer) == [4, 6] and seeds.longer[4].where.tolist() == [[1, 0]]
    assert sorted(seeds.longer[6].where[:, 1].tolist()) == sorted(set(range(37)) - {5, 9})
    assert not dc.choose_seeds(index, counts, rare=50).frequent.any()


def test_items_that_begin_alike_are_not_all_candidates():
    items = [(k, f"which of the following is item{k} a{k} b{k} c{k} d{k} e{k} f{k}") for k in range(20_000)]
    index = dc.build_index(items)
    text = dc.pa.array(["so which of the following is new " * 20 + items[7][1]])
    hits = dc._hits(*dc._numbers(text, index), index)[1]
    index = dc.choose_seeds(index, dc.np.bincount(hits, minlength=len(index.seeds.grams)))
    at, item, _ = dc._proposed(*dc._numbers(text, index), index)
    assert set(item.tolist()) == {7} and len(at) < 20
    assert [r[:3] for r in dc.find(text, index)] == [(0, 7, 1.0)]


def test_few_common_words_are_no_report_and_short_items_need_most_of_theirs(spark):
    items = [(0, "What is the capital of France today"), (1, "Which of the following is a vector quantity in physics"),
             (2, "alpha beta gamma delta"), (3, "un\u00a0deux\u00a0trois\u202fquatre\u3000cinq six\u00a0sept huit")]
    texts = ["the capital of the region", "here which of the following is true", "alpha beta gamma only", "Alpha, beta - gamma DELTA!",
             f"x {items[3][1]} y", "un deux trois quatre cinq six sept huit", "what is the capital of france now", "x " + items[1][1]]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    found = dc.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(3, 2), (4, 3), (5, 3), (6, 0), (7, 1)}


def edited_copies():
    """Lone copies of long items with words changed, and the items."""
    rng = random.Random(11)
    items = [(k, awkward.words(rng, rng.choice([24, 46, 59, 90]), 900)) for k in range(30)]
    rows = []
    for k, text in items:
        words = text.split()
        if k % 3 == 0:
            words = [f"new{n}" if n % (4 + k % 4) == 3 else w for n, w in enumerate(words)]
        else:
            words = [f"new{n}" if rng.random() < 0.3 else w for n, w in enumerate(words)]
        rows.append((3000 + k, f"{awkward.words(rng, 25, 900)} {' '.join(words)} {awkward.words(rng, 40, 900)}", "en", "a", 1))
    return items, rows


def test_edited_copies_that_keep_any_ngram_are_found(spark):
    items, extra = edited_copies()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.score, 9)) for r in dc.contaminated(awkward.docs(spark, extra), bench).collect()}
    text, own = {r[0]: plain(r[1]) for r in awkward.rows(extra)}, {i: plain(t) for i, t in items}
    want = {x for x in brute(awkward.rows(extra), items) if runs(text[x[0]], 3) & runs(own[x[1]], 3)}
    assert got == want and len(got) > 20


def test_bound_is_never_below_the_alignment():
    rng = dc.np.random.default_rng(3)
    for words in (4, 12, 40):
        items, passages = rng.integers(1, words, (200, 17)), rng.integers(0, words, (200, 45))
        assert (dc.bound(items, passages) >= dc.align(items, passages)[0]).all()


def test_long_passages_of_longer_items_are_found(spark):
    items = [(k, " ".join(f"i{k}n{n}" for n in range(size))) for k, size in enumerate([200, 59, 90, 400, 90])]
    parts = [(0, 60, 75), (1, 30, 23), (2, 10, 13), (3, 385, 13), (4, 5, 12)]  # item, first word, words; the last is too short
    extra = [(4000 + k, f"before it {' '.join(items[k][1].split()[at:at + n])} and after", "en", "a", 1) for k, at, n in parts]
    bench, df = spark.createDataFrame(items, "item_id long, text string"), awkward.docs(spark, extra)
    got = {(r.doc_id, r.item_id, round(r.score, 9), r.start_word, r.end_word) for r in dc.contaminated(df, bench).collect()}
    assert got == {(4000 + k, k, round(n / len(items[k][1].split()), 9), 2, 2 + n) for k, _, n in parts[:4]}
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in dc.clean(df, bench).collect()} == {4000, 4001, 4002, 4003}


def test_pairs_that_share_only_frequent_ngrams_are_found(spark):
    items, extra = edited_copies()
    for k, text in items[:6]:  # four words in a row at most: neither a rare n-gram (none is) nor a long one
        words = [f"other{n}" if n % 5 == 4 else w for n, w in enumerate(text.split())]
        extra.append((3100 + k, " ".join(words), "en", "a", 1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    text, own = {r[0]: plain(r[1]) for r in awkward.rows(extra)}, {i: plain(t) for i, t in items}
    want = {x for x in brute(awkward.rows(extra), items) if runs(text[x[0]], 3) & runs(own[x[1]], 3)}
    assert any(not runs(text[d], dc.LONG) & runs(own[i], dc.LONG) for d, i, _ in want)
    assert pairs(dc.contaminated(awkward.docs(spark, extra), bench, rare=0)) == want


def test_words_are_numbered_as_one_by_one():
    index = dc.build_index([(1, "Alpha beta's gamma\u00e9 d-e 42 \u0130x stra\u00dfe a\u00a0b"), (2, "x y z")])
    words = dc.pa.array(["Alpha,", "(BETA'S)", "gamma\u00c9!", "--", "d-e", "\u00abd-e\u00bb", "42.", "a\u00a0b", "a\x1cb", "\u0130x", "STRASSE",
                         "STRA\u00dfE", "\u2014", "unknown", "z\x7f", "\x1f", "Z"])
    number, size = dc._word_numbers(words, index.vocabulary)
    parts = [dc.plain(w) for w in words.to_pylist()]
    assert size.tolist() == [len(p) for p in parts]
    assert number.tolist() == [index.vocabulary.get(w, 0) for p in parts for w in p]
    none = dc._word_numbers(words.slice(0, 0), index.vocabulary)
    assert not len(none[0]) and not len(none[1]) and dc._word_numbers(words, {})[0].tolist() == [0] * len(number)
