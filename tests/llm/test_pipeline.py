"""Each stage on all that the one before kept, against brute force; then the whole run."""

import pytest
import awkward
import test_near_duplicates
import test_packing
import test_pii

import corpus_pipeline as cp
from tillroll.llm import decontamination, quality
from tillroll.llm.common import materialize, read_table


@pytest.fixture(scope="module")
def kept(spark, sf_small):
    """The stages' results, each cached for the next."""
    out = [read_table(spark, sf_small, "documents").cache()]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], sf_small).cache())
    yield out
    for df in out:
        df.unpersist()


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_stage_return_documents(kept):
    assert [n for n, _ in cp.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "personal data", "packing"]
    assert all(df.columns == kept[0].columns and df.dtypes == kept[0].dtypes for df in kept[1:-1])


def test_quality_stage(kept):
    assert ids(kept[1]) == ids(quality.quality(kept[0]).where("kept"))
    assert 0 < kept[1].count() < kept[0].count()


def test_near_duplicate_stage(kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    assert ids(kept[2]) == sorted({c for _, _, c in test_near_duplicates.brute(rows)})


def test_decontamination_stage(spark, sf_small, kept):
    plain = lambda t: f" {' '.join(w for w in map(decontamination.normal, (t or '').split()) if w)} "
    items = [plain(r.text) for r in read_table(spark, sf_small, "benchmark").collect()]
    whole = {r.doc_id for r in kept[2].collect() if any(i in plain(r.text) for i in items)}
    gone = set(ids(kept[2])) - set(ids(kept[3]))
    assert whole <= gone
    bench = read_table(spark, sf_small, "benchmark")
    assert gone == {r.doc_id for r in decontamination.contaminated(kept[2], bench).collect()}


def test_personal_data_stage(kept):
    before = {r.doc_id: r for r in kept[3].collect()}
    assert ids(kept[4]) == sorted(before)
    for r in kept[4].collect():
        spans = test_pii.base(before[r.doc_id].text or "")
        assert not spans or r.text != before[r.doc_id].text
        assert not [s for s in test_pii.base(r.text or "") if s[0] in ("email", "card", "phone")]
        assert spans or r.text == before[r.doc_id].text or "<" in r.text


def test_packing_stage_and_whole_run(spark, sf_small, kept):
    test_packing.check_round_trip(kept[4], kept[5])
    test_packing.check_round_trip(kept[4], cp.run(spark, sf_small))  # every id of every kept text, once, gapless


def test_empty_table_and_clashing_columns(spark, sf_small):
    for docs in (awkward.empty(spark), awkward.docs(spark)):
        columns, n = docs.columns, docs.count()
        for name, stage in cp.STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_small), "test_stage")
            assert docs.columns == columns and docs.count() <= n, name
        pieces = cp.STAGES[-1][1](spark, docs, sf_small)
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}
        if n:
            assert 0 < docs.count() < n and docs.where("score IS NOT NULL AND score <> 'clash score'").count() == 0
