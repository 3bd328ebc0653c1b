"""Exact nearest neighbours by inner product: a block matrix join over int8 codes.

Every vector is written as int8 codes with a step, and with the norms of the
vector, its code and the rounding error.  Query vectors are dealt to query
blocks, all vectors to stripes; each (query block, stripe) tile multiplies the
codes (integers below 2**24, exact in single precision), and the Cauchy-Schwarz
bound ``|q||e_c| + |e_q||code_c|`` on what rounding can have moved gives each product
a lower and an upper end.  A pair survives if its upper end reaches the k-th
greatest lower end of its query in the tile; survivors are computed again from the
original vectors in double precision, component after component.  Tiles give
k rows a query, merged by heaps, ``FAN`` stripes at a time, until one list is left.

Nothing is lost: the bounds are proven, so the result is exact (recall 1).  Work is
queries times vectors, as the contract's query set is a share of the table; memory
of a task is one tile, or ``FAN`` lists for each query of a block.

Inputs: a vector that is null, empty, zero or holds a null or non-finite component
takes no part, nor does one without an id; vectors are compared with those of the
same number of components; of rows that repeat an id each is a candidate, but none
of them for a query with that id; a repeated query row has a list of its own (told
apart by nothing but its repetition); ties go to the smaller id; other columns are
ignored whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import find_package, give_back, materialize

#: Queries of a block, vectors of a stripe, lists merged at a time.
QUERIES, STRIPE, FAN = 1024, 8192, 16
#: Products of a tile at a time, and components of pairs computed again at a time.
CELLS, PAIRS = 1 << 22, 1 << 20
#: Pairs per group in the first bound on the k-th greatest value.
GROUP = 16
_CODES = "row bigint, vec_id bigint, dim int, code binary, vec binary, step double, norm double, code_norm double, error double"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(2)
        flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
        ends = np.cumsum(sizes)
        row_of = np.repeat(np.arange(len(sizes)), sizes)
        top = np.maximum.reduceat(np.abs(flat), ends - sizes)
        step = top / 127
        step[step == 0] = np.finfo(float).tiny  # so small that the codes are zero: the error is the norm
        code = np.clip(np.rint(flat / step[row_of]), -127, 127)
        rounded = code * step[row_of]
        size = lambda x: np.sqrt(np.bincount(row_of, (x / top[row_of]) ** 2, len(sizes))) * top * (1 + 1e-9)
        code, raw = code.astype(np.int8).tobytes(), flat.astype(np.float64).tobytes()
        cut = list(zip((ends - sizes).tolist(), ends.tolist()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes.astype(np.int32)), pa.array([code[a:b] for a, b in cut], pa.binary()),
             pa.array([raw[8 * a:8 * b] for a, b in cut], pa.binary()), *map(pa.array, (step, size(flat), size(rounded), size(flat - rounded)))],
            names=["row", "vec_id", "dim", "code", "vec", "step", "norm", "code_norm", "error"])


def coded(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The vectors that take part, with their int8 codes; written, so that ``row`` stays what it is."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec"))
    finite = F.coalesce(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    good = F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0)
    return materialize(rows.where(good).mapInArrow(_encode, _CODES), "vector_codes")


def _matrix(table: pa.Table, name: str, dim: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(-1, dim)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the rows of ``a`` with those of ``b``, component after component."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def kth_greatest(values: np.ndarray, k: int) -> np.ndarray:
    """A value that at least ``k`` entries of each row reach: the k-th greatest of the maxima of groups of entries."""
    rows, n = values.shape
    if n <= k:
        return np.full(rows, -np.inf)
    whole = n // GROUP * GROUP
    if whole // GROUP > 2 * k:
        values = values[:, :whole].reshape(rows, whole // GROUP, GROUP).max(axis=2)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _norms(table: pa.Table) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in ("vec_id", "step", "norm", "code_norm", "error")]


def tile(queries: pa.Table, stripe: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest vectors of the stripe for each query: row and id of the query, id and score, nearest first."""
    dim = queries.column("dim")[0].as_py()
    q_code, c_code = (_matrix(t, "code", dim, np.int8).astype(np.float32) for t in (queries, stripe))
    q_vec, c_vec = (_matrix(t, "vec", dim, np.float64) for t in (queries, stripe))
    (q_id, q_step, q_norm, _, q_error), (c_id, c_step, _, c_code_norm, c_error) = _norms(queries), _norms(stripe)
    q_row, c_order = queries.column("row").to_numpy(), np.argsort(c_id, kind="stable")
    out = [[], [], [], []]
    for at in range(0, len(q_id), max(1, CELLS // len(c_id))):
        part = slice(at, at + max(1, CELLS // len(c_id)))
        product = np.zeros((len(q_id[part]), len(c_id)))
        for low in range(0, dim, 1024):  # sums of so many products of codes stay below 2**24
            product += q_code[part, low:low + 1024] @ c_code[:, low:low + 1024].T
        product *= q_step[part, None] * c_step[None, :]
        wide = q_norm[part, None] * c_error[None, :] + q_error[part, None] * c_code_norm[None, :]
        wide += 1e-9 * (q_norm[part, None] * (c_code_norm + c_error)[None, :])  # rounding of the sums themselves
        own = q_id[part, None] == c_id[None, :]
        product[own] = -np.inf
        least = kth_greatest(product - wide, k)
        row, column = np.nonzero((product + wide >= least[:, None]) & ~own)
        score = np.empty(len(row))
        step = max(1, PAIRS // dim)
        for i in range(0, len(row), step):
            score[i:i + step] = inner_products(q_vec[part][row[i:i + step]], c_vec[column[i:i + step]])
        order = np.lexsort((c_id[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        best = rank < k
        for kept, x in zip(out, (q_row[part][row[best]], q_id[part][row[best]], c_id[column[best]], score[best])):
            kept.append(x)
    return pa.table({name: np.concatenate(x) for name, x in zip(("row", "query_id", "vec_id", "score"), out)})


def _merge(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest of each query's lists, by a heap over them."""
    table = table.sort_by([("row", "ascending"), ("list", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
    rows = zip(*(table.column(c).to_pylist() for c in ("row", "query_id", "list", "score", "vec_id")))
    out = []
    for _, own in groupby(rows, key=lambda r: r[0]):
        lists = [list(g) for _, g in groupby(own, key=lambda r: r[2])]
        out += islice(heapq.merge(*lists, key=lambda r: (-r[3], r[4])), k)
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
    return pa.table({name: pa.array([r[i] for r in out], kind)
                     for name, i, kind in zip(("row", "query_id", "score", "vec_id"), (0, 1, 3, 4), kinds)})


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, queries: int = QUERIES, stripe: int = STRIPE, fan: int = FAN) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` nearest vectors of each vector whose id ``every`` divides."""
    find_package(vectors.sparkSession)
    rows = coded(vectors)
    asks = F.col("vec_id") % every == 0
    n, n_asks = rows.agg(F.count("*"), F.count_if(asks)).first()
    n_blocks, n_stripes = max(1, -(-n_asks // queries)), max(1, -(-n // stripe))
    place = lambda of, count, seed: F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(count)).cast("int")
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.where(asks).withColumn("block", place(["row"], n_blocks, 1)).withColumn("list", numbers(n_stripes))
    again = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # a cogroup needs sides without common column ids
    right = again.withColumn("list", place(["row"], n_stripes, 2)).withColumn("block", numbers(n_blocks))
    shape = "row bigint, query_id bigint, vec_id bigint, score double, block int, list int"

    def work(key, a, b):
        if not a.num_rows or not b.num_rows:
            return pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()),
                              ("block", pa.int32()), ("list", pa.int32())]).empty_table()
        out = tile(a, b, k)
        give_back()
        _, block, number = (x.as_py() for x in key)
        return out.append_column("block", pa.array([block] * out.num_rows, pa.int32())).append_column("list", pa.array([number] * out.num_rows, pa.int32()))

    keys = ("dim", "block", "list")
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, shape)

    def merge(key, table):
        out = _merge(table, k).select(["row", "query_id", "vec_id", "score"])
        block, number = (x.as_py() for x in key)
        return out.append_column("block", pa.array([block] * out.num_rows, pa.int32())).append_column("list", pa.array([number] * out.num_rows, pa.int32()))

    while True:
        lists = lists.groupBy("block", (F.col("list") / fan).cast("int")).applyInArrow(merge, shape)
        n_stripes = -(-n_stripes // fan)
        if n_stripes <= 1:
            break

    def ranked(table: pa.Table) -> pa.Table:
        table = table.sort_by([("row", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
        row = table.column("row").to_numpy()
        rank = np.arange(len(row)) - np.searchsorted(row, row, side="left") + 1
        return pa.table({"query_id": table.column("query_id"), "rank": pa.array(rank.astype(np.int32)),
                         "vec_id": table.column("vec_id"), "score": table.column("score")})

    return lists.groupBy("block").applyInArrow(ranked, "query_id bigint, rank int, vec_id bigint, score double")
