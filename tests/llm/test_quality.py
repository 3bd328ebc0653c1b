import re
import tracemalloc
from collections import Counter

import awkward
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillroll.llm import quality as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


NOISE = [(100, "a# b* c$ d% e& f| g< h> i j k l", "en", "a", 0), (101, "p q r s t " * 9 + "u", "en", "a", 0),
         (102, "same\n\n  \nsame\nother words here\nsame", "en", "a", 0)]
#: A page of menu lines between its sentences goes; a short text with a licence line said three times stays.
SENTENCES = ["Rain fell on the harbour all night", "Boats came home before the storm broke", "Nobody had counted the nets left outside",
             "Morning brought a pale and quiet sea", "Fishermen mended what the wind had torn", "Children searched the beach for glass"]
NOISE += [(103, "\n".join(x for s in SENTENCES for x in (s, "Read more")), "en", "a", 0),
          (104, "Licence: free\n" + SENTENCES[0] + "\nLicence: free\n" + SENTENCES[1] + "\nLicence: free", "en", "a", 0)]
COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_equal_brute_force(spark):
    got = awkward.multiset(q.quality(awkward.docs(spark, NOISE)), *COLUMNS)
    assert got == sorted(((r[0], *brute(r[1])) for r in awkward.rows(NOISE)), key=repr)


def test_verdicts(spark):
    for r in q.quality(awkward.docs(spark, NOISE)).collect():
        base = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == base and (not base or not r.kept)
    kept = {r.doc_id for r in q.keep_good(awkward.docs(spark, NOISE)).collect()}
    assert kept == {r.doc_id for r in q.quality(awkward.docs(spark, NOISE)).where("kept").collect()}
    assert kept >= {4, 104} and not kept & {0, 1, 2, 3, 100, 101, 103}
    by_version = q.apply_policies(q.rule_ledger(awkward.docs(spark, NOISE)), [q.EVERY, q.LENIENT, q.DEFAULT]).where("doc_id in (103, 104)")
    assert {(r[0], r[1], r[2], r[3]) for r in by_version.select("doc_id", *(f"rejected_default_v{k}" for k in (1, 2, 3))).collect()} == {
        (103, True, False, True), (104, True, False, False)}


def test_stage_keeps_columns_and_empty_tables(spark):
    df = awkward.docs(spark)
    assert q.keep_good(df).columns == df.columns
    assert q.quality(awkward.empty(spark)).count() == 0 and q.keep_good(awkward.empty(spark)).count() == 0


def test_policies_and_ablations_equal_evaluating_each(spark):
    ledger = q.rule_ledger(awkward.docs(spark, NOISE)).cache()
    rows = [r.fail_bits for r in ledger.collect()]
    for policy in (q.BASE, q.EVERY, q.LENIENT, q.DEFAULT):
        verdict = F.col(f"rejected_{policy.name}_v{policy.version}").cast("int")
        flags = q.apply_policies(ledger, [policy]).agg(F.sum(verdict)).first()[0]
        assert flags == sum(b & policy.mask != 0 for b in rows)
        for r in q.ablations(ledger, policy).collect():
            bit = 1 << list(q.RULES).index(r["rule"])
            assert r.failed == sum(b & bit != 0 for b in rows)
            assert r.only_this == sum(b & policy.mask == bit for b in rows)
            assert r.kept_without == sum(b & policy.mask & ~bit == 0 for b in rows)
    s = q.mask_summary(ledger).first()
    assert s.any_failed & 1 and s.all_failed == 0
    ledger.unpersist()


def test_measuring_holds_little_beside_the_batch():
    """A worker keeps the numbers of a small slice only, and none for each byte of the text."""
    few = np.random.default_rng(5).integers(0, 900, (400, 1500))
    text = pa.array([" ".join(f"w{k}#" if k % 9 == 0 else f"word{k}" for k in row) for row in few.tolist()])
    assert text.nbytes > 2 << 20
    batch = pa.RecordBatch.from_arrays([text], names=[q.TEXT])
    tracemalloc.start()
    made = list(q._measure(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = [n for m in made for n in m.column(q.MEASURES.index("n_symbols")).to_pylist()]
    assert found == (few % 9 == 0).sum(axis=1).tolist()
    assert peak < 3 * text.nbytes
