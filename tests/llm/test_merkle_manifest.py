import hashlib
import zlib

import awkward
import pytest

from tillroll.llm import merkle_manifest as M

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row):
    return H(*(encoded(row[c]) for c in FIELDS))


def climb(nodes):
    """The root, and each node's siblings (side, digest) on the way."""
    ways, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(place):
            if at ^ 1 < len(nodes):
                ways[k].append((at & 1, nodes[at ^ 1]))
            else:
                ways[k].append((0, ""))
            place[k] = at >> 1
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], ways


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, out = [], []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    root, above = climb([t[1] for t in trees])
    for (own, subroot, ways), more in zip(trees, above):
        for r, way in zip(own, ways):
            way = way + more
            at = leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                at = leaf({**r, "n_chars": r["n_chars"] + 1})
            for left, node in way:
                at = H(node, at) if left else H(at, node)
            out.append((r["doc_id"], leaf(r), subroot, root, H(*(n for _, n in way)), at, at == root))
    return sorted(out, key=repr)


def as_dicts(rows):
    return [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]


@pytest.mark.parametrize("levels", [1, 2, 11])
def test_equals_brute_force_over_several_tiers(spark, levels):
    more = [(k, f"text {k}", ["en", "EN", "Ä", "z", ""][k % 5] if k % 3 else "en", "a", 2 ** 63 - 1 if k % 2 else None) for k in range(300, 360)]
    rows = awkward.rows(more)
    got = awkward.multiset(M.manifest(awkward.docs(spark, more, clash=False).selectExpr("*", "1 AS tree", "2 AS idx", "3 AS n", "4 AS node", "5 AS leaf"), levels=levels), *COLUMNS)
    assert got == brute(as_dicts(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9])
def test_one_language(spark, n):
    rows = [(k, "t", None, None, k) for k in range(n)]
    got = awkward.multiset(M.manifest(spark.createDataFrame(rows, awkward.SCHEMA), levels=2), *COLUMNS)
    assert got == brute(as_dicts(rows))


def test_many_copies_of_one_row(spark):
    rows = [(5, "same", "en", "a", 4)] * 700 + [(k, "other", "en", "a", 5) for k in range(50)]
    got = awkward.multiset(M.manifest(spark.createDataFrame(rows, awkward.SCHEMA).repartition(4)), *COLUMNS)
    assert got == brute(as_dicts(rows))


def test_places_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("a" if k % 4 else "b", k) for k in range(200)], "t string, k long").repartition(5)
    for parts in (1, 3, 40):
        got = {(r["t"], r["idx"]): (r["k"], r["n"]) for r in M.numbered(df, "t", ["k"], parts).collect()}
        for t, n in (("a", 150), ("b", 50)):
            own = sorted(k for k in range(200) if ("a" if k % 4 else "b") == t)
            assert [got[t, i] for i in range(n)] == [(k, n) for k in own]


def test_proof_and_fold():
    nodes = [H(str(k)) for k in range(5)]
    levels = M._reduce(nodes, 3)
    for k, node in enumerate(nodes):
        path = M._path(levels, k)
        assert M.fold(node, path) == levels[-1][0] and M.fold(H("x"), path) != levels[-1][0]


def test_empty_table(spark):
    out = M.manifest(awkward.empty(spark))
    assert out.columns == COLUMNS and out.collect() == []
