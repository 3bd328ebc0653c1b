import random

import awkward
import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import nearest_vectors as N

COLUMNS = ["query_id", "rank", "vec_id", "score"]


def fits(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20, every=20):
    rows = [r for r in rows if r[0] is not None and fits(r[1])]
    out = []
    for q, a in rows:
        if q % every:
            continue
        found = []
        for c, b in rows:
            if c != q and len(a) == len(b):
                total = 0.0
                for x, y in zip(a, b):
                    total += x * y
                found.append((-total, c))
        out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


def table(spark, rows, clash=()):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for c in clash:
        df = df.selectExpr("*", f"'clash' AS `{c}`")
    return df


def vectors(rng, n, dim=12):
    return [(k, [rng.gauss(0, 1) for _ in range(dim)]) for k in range(n)]


@pytest.mark.parametrize("sizes", [(1024, 8192, 16), (4, 30, 2)])
def test_equals_brute_force_with_ties_copies_and_bad_vectors(spark, sizes):
    rng = random.Random(4)
    rows = vectors(rng, 300)
    hot = rows[40][1]
    rows = [(k, hot) if 100 <= k < 200 else (k, v) for k, v in rows]  # a third are copies of one
    rows[7] = (7, None)
    rows[20] = (20, [0.0] * 12)
    rows[8], rows[9], rows[10] = (8, [float("nan")] * 12), (9, [None] + [1.0] * 11), (10, [float("inf")] + [0.0] * 11)
    rows += [(400, [1e-30] * 12), (401, [1e30] * 12), (402, [1.0, 2.0]), (420, [3.0, 1.0]), (460, []), (None, [1.0] * 12), (11, hot), (40, hot)]
    df = table(spark, rows, ["row", "list", "block", "score", "code", "dim", "vec", "query_id"])
    got = awkward.multiset(N.nearest(df, queries=sizes[0], stripe=sizes[1], fan=sizes[2]), *COLUMNS)
    assert sorted(got) == brute(rows)


def test_fewer_candidates_than_asked_for(spark):
    rows = vectors(random.Random(1), 6)
    assert sorted(awkward.multiset(N.nearest(table(spark, rows)), *COLUMNS)) == brute(rows)


def test_single_precision_and_integer_components(spark):
    df = spark.createDataFrame([(k, [float(k), -float(k), 3.0]) for k in range(45)], "vec_id int, embedding array<float>")
    assert sorted(awkward.multiset(N.nearest(df), *COLUMNS)) == brute([(k, [k, -k, 3]) for k in range(45)])


def test_bounds_hold_the_true_products():
    rng = np.random.default_rng(2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array(range(80)), pa.array(list(rng.normal(size=(80, 40)) * rng.lognormal(0, 4, (80, 1))))],
                                       names=["row", "vec_id", "vec"])
    coded = pa.Table.from_batches(N._encode(iter([batch])))
    code, vec = N._matrix(coded, "code", 40, np.int8).astype(float), N._matrix(coded, "vec", 40, np.float64)
    step, norm, code_norm, error = (coded.column(c).to_numpy() for c in ("step", "norm", "code_norm", "error"))
    apart = np.abs(vec @ vec.T - (code @ code.T) * step[:, None] * step[None, :])
    bound = norm[:, None] * error[None, :] + error[:, None] * code_norm[None, :]
    assert (apart <= bound).all() and (bound < norm[:, None] * norm[None, :] * .05).all()


def test_a_value_that_k_entries_reach():
    x = np.random.default_rng(0).normal(size=(5, 1003))
    low = N.kth_greatest(x, 20)
    assert ((x >= low[:, None]).sum(axis=1) >= 20).all() and (N.kth_greatest(x[:, :20], 20) == -np.inf).all()


def test_empty_table(spark):
    out = N.nearest(table(spark, []))
    assert out.columns == COLUMNS and out.collect() == []
