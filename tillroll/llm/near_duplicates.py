"""N-gram Jaccard join by grouped prefixes, and its connected components.

A document's set holds its distinct ``WIDTH``-word shingles (as 64-bit hashes).
Two documents link when ``100 * shared >= PERCENT * all``.

1. *Order*: shingles that repeat inside a task's share of the corpus get their summed
   counts, the most frequent (a bounded table) are sorted last; all others by
   hash.  Any fixed order gives the same links; this one keeps common passages out of the prefixes.
2. *Prefixes*: two linked sets share a shingle among the first
   ``size - ceil(size * PERCENT / 100) + 1`` of each.  Equal sets form a class;
   classes with equal prefix and size form a group, whose prefix is indexed once.
3. *Filter group pairs*: groups meet in the list of a prefix shingle; their sizes
   and the shingle's positions must allow the overlap.
4. *Expand and verify*: within a list, every member is verified against the list's pivot (the
   member with the shingle furthest in front), which links a family of
   copies through one of them.  Then every pair of members that are not yet
   connected, and were not verified, is verified as well.  So no link between
   unconnected documents is lost, and a family of n copies costs about n pairs, not n * n.
   Such pairs meet by shingle and band of sizes, and only where the parities of their sets
   (``PARITIES`` bits, each telling whether an odd number of shingles falls on it) differ in
   no more bits than two linked sets differ in shingles.

If a list that step 1 took for rare turns out longer than ``LONG_LIST``, its
shingle joins the frequent ones (the longest lists first, at most ``TABLE`` each time) and the prefixes
are taken again, at most ``TURNS`` times.  Longer lists that are left only take more time.

Texts are never gathered: verification reads the sets of the classes in
question again from the documents.

Defined results: null or empty texts and texts without words have the empty set
and link with nothing (their component is their own id); with fewer than ``WIDTH`` words the whole sequence is
the one shingle; rows that repeat are equal sets; a component's id is its smallest non-null ``doc_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import WORD_SLICE_BYTES, byte_slices, drop_written, hash_strings, materialize, mix, split_words, texts
from tillroll.llm.components import components

WIDTH, PERCENT = 5, 80
#: Shingles counted at a time in a task; entries of the table of frequent ones; their least count.
COUNTED, TABLE, FREQUENT = 1 << 22, 1 << 20, 16
LONG_LIST, TURNS = 2000, 3
#: Longs that hold the parities of a set, 64 each.
PARITIES = ("odd0", "odd1", "odd2", "odd3")
#: Sizes of linked sets differ by a factor of 100 / PERCENT at most, so their bands are the same or neighbours.
BAND = 100 / PERCENT + 0.01
#: A side of a join up to this size is broadcast, a larger one is shuffled.
BROADCAST_BYTES = 32 << 20
_MULTIPLIERS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of each distinct shingle of each row, sorted."""
    words, idx, off = split_words(text, lower=True)
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    value = hash_strings(words)[idx]
    at = np.flatnonzero(np.arange(len(idx)) + WIDTH <= off[1:][row])
    key = np.zeros(len(at), np.uint64)
    for k in range(WIDTH):
        key += value[at + k] * _MULTIPLIERS[k]
    few = np.flatnonzero((n > 0) & (n < WIDTH))
    whole = np.array([sum((int(value[off[r] + k]) * int(_MULTIPLIERS[k]) for k in range(n[r])), int(n[r])) & (2**64 - 1)
                      for r in few.tolist()], np.uint64)
    row, key = np.concatenate([row[at], few]), mix(np.concatenate([key, whole]))
    joined = row.astype(np.uint64) << np.uint64(44) | key >> np.uint64(20)
    order = np.argsort(joined)
    if len(n) >= 1 << 20 or _ambiguous(joined[order], key[order]):
        order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[new], key[new]


def _ambiguous(joined: np.ndarray, key: np.ndarray) -> bool:
    """Whether different shingles look the same in the abridged sort key."""
    return bool(((joined[1:] == joined[:-1]) & (key[1:] != key[:-1])).any())


def repeated(docs: DataFrame) -> DataFrame:
    """``shingle``, ``n``: counts of the shingles that stand in several texts of a task's share."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(COUNTED, np.uint64), 0

        def done(key: np.ndarray) -> pa.RecordBatch:
            key.sort()  # in place: a task holds one block
            same = np.flatnonzero(key[1:] == key[:-1])
            found = key[same]  # a shingle that stands k times makes k - 1 equal neighbours
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else same
            n = np.diff(np.append(first, len(found))) + 1
            return pa.RecordBatch.from_arrays([pa.array(found[first].view(np.int64)), pa.array(n.astype(np.int64))],
                                              names=["shingle", "n"])

        for batch in byte_slices(batches, limit=WORD_SLICE_BYTES):
            key = shingles(batch.column(0))[1]
            if size + len(key) > len(held):
                yield done(held[:size])
                size = 0
            if len(key) > len(held):  # one huge text: its shingles differ
                continue
            held[size:size + len(key)] = key
            size += len(key)
        if size:
            yield done(held[:size])

    found = docs.select("text").mapInArrow(count, "shingle long, n long")
    return materialize(found.groupBy("shingle").agg(F.sum("n").alias("n")), "near_repeated")


def frequent(counts: DataFrame) -> np.ndarray:
    """At most ``TABLE`` shingles, from the least to the most frequent one."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, -(-total // TABLE))  # no more than TABLE shingles can have so many
    rows = counts.where(F.col("n") >= least).toPandas()
    rows = rows.sort_values(["n", "shingle"])
    return rows["shingle"].to_numpy(np.int64).view(np.uint64)


def parities(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """Of each row, ``64 * len(PARITIES)`` bits as 64-bit numbers: whether an odd number of its shingles falls on the bit."""
    width = 64 * len(PARITIES)
    bit = (key >> np.uint64(32)) % np.uint64(width)
    odd = np.bincount(row * width + bit.astype(np.int64), minlength=rows * width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(rows, len(PARITIES))


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def profiles(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Written once, per document: ``doc_id``, ``text_key``, ``n``, ``PARITIES``, ``class`` and ``grp`` (fingerprints of its
    set, and of prefix and size) and, once in a task for each group, the ``prefix``."""
    spark = docs.sparkSession
    order = np.argsort(table)
    shared = spark.sparkContext.broadcast((table[order], order + 1))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        seen: set[bytes] = set()
        for batch in byte_slices(batches, limit=WORD_SLICE_BYTES):
            row, key = shingles(batch.column(2))
            n = np.bincount(row, minlength=batch.num_rows)
            off = np.concatenate([[0], np.cumsum(n)])
            place = np.zeros(len(key), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                place = np.where(known[at] == key, rank[at], 0)
            ordered, lengths = key.copy(), prefix_length(n)
            common = np.flatnonzero(np.bincount(row, place > 0, batch.num_rows)[row])  # the rows to sort anew
            if len(common):  # stable: by hash where the place is the same
                ordered[common] = key[common[np.argsort(row[common] << 32 | place[common], kind="stable")]]
            raw, odd = key.tobytes(), parities(row, key, batch.num_rows)
            classes, groups, prefixes = [], [], []
            for r, (k, p) in enumerate(zip(n.tolist(), lengths.tolist())):
                if not k:
                    classes.append(None), groups.append(None), prefixes.append(None)
                    continue
                a = int(off[r])
                classes.append(xxhash.xxh3_128_digest(raw[8 * a:8 * (a + k)]))
                prefix = ordered[a:a + p].tobytes()
                group = xxhash.xxh3_128_digest(prefix + k.to_bytes(8, "little"))
                groups.append(group)
                prefixes.append(None if group in seen else prefix)
                seen.add(group)
                if len(seen) > 1 << 17:
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(classes, pa.binary()),
                 pa.array(groups, pa.binary()), pa.array(prefixes, pa.binary()), *map(pa.array, odd.T)],
                names=["doc_id", "text_key", "n", "class", "grp", "prefix", *PARITIES])

    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("text_key"), "text")
    fields = [T.StructField("n", T.LongType()), *(T.StructField(c, T.BinaryType()) for c in ("class", "grp", "prefix")),
              *(T.StructField(c, T.LongType()) for c in PARITIES)]
    return materialize(rows.mapInArrow(profile, T.StructType([*rows.schema.fields[:2], *fields])), "near_profiles")


def postings(groups: DataFrame) -> DataFrame:
    """``shingle``, ``gid``, ``m``, ``pos`` of each prefix entry."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "prefix"):
            raw = batch.column(2).to_pylist()
            size = np.array([len(x) // 8 for x in raw], np.int64)
            row = pa.array(np.repeat(np.arange(len(raw)), size))
            pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(raw), np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(pos.astype(np.int32))], names=["shingle", "gid", "m", "pos"])

    return groups.select("gid", F.col("m").cast("int"), "prefix").mapInArrow(explode, "shingle long, gid long, m int, pos int")


def least_shared(n1: str, n2: str) -> Column:
    """How many shingles linked sets of these sizes share at least."""
    return F.expr(f"({PERCENT} * ({n1} + {n2}) + {99 + PERCENT}) div {100 + PERCENT}")


def alike(n1: str, n2: str, suffix1: str = "1") -> Column:
    """Whether sets of these sizes with these parities can link: a bit differs only where a shingle of one set is not in the other."""
    bits = sum((F.bit_count(F.col(f"{c}{suffix1}").bitwiseXOR(F.col(c))) for c in PARITIES), F.lit(0))
    return bits <= F.expr(f"{n1} + {n2}") - 2 * least_shared(n1, n2)


def possible(n1: str, pos1: str, n2: str, pos2: str) -> Column:
    """Whether sets of these sizes that share a shingle, their first common one, at these positions can link."""
    least = least_shared(n1, n2)
    return (F.expr(f"100 * least({n1}, {n2}) >= {PERCENT} * greatest({n1}, {n2})")
            & (F.expr(f"least({n1} - {pos1}, {n2} - {pos2})") >= least))


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (written already) with a broadcast hint if its rows, counted, stay under ``BROADCAST_BYTES``."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``a``, ``b``, ``linked`` of pairs of class ids, by their whole sets, read again from one text of each class."""
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
                         .join(classes.select("cid", "text_key"), "cid"), "near_wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in byte_slices(batches, limit=WORD_SLICE_BYTES):
            cid = batch.column(0).to_pylist()
            new = [k for k, c in enumerate(cid) if not (c in seen or seen.add(c))]
            if len(seen) > 1 << 18:
                seen.clear()
            if new:
                row, key = shingles(batch.column(1).take(pa.array(new)))
                off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(new)))])
                # six of eight bytes tell the shingles of a pair apart
                part = [np.sort(key[a:b] & np.uint64(2**48 - 1)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                        for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([cid[k] for k in new], pa.int64()),
                                                  pa.array(part, pa.binary())], names=["cid", "members"])

    found = docs.select(F.unhex(F.md5("text")).alias("text_key"), "text").join(small(wanted, 48), "text_key")
    members = materialize(found.select("cid", "text").mapInArrow(sets, "cid long, members binary")
                          .dropDuplicates(["cid"]), "near_sets")

    def whole(raw: pa.Buffer) -> np.ndarray:
        out = np.zeros((raw.size // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        return out.view(np.uint64).ravel()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for k in range(batch.num_rows):  # in place: sets of a batch are not copied at once
                x, y = (whole(batch.column(c)[k].as_buffer()) for c in (2, 3))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)],
                                             names=["a", "b", "linked"])

    left = members.select(F.col("cid").alias("a"), F.col("members").alias("x"))
    right = members.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    compared = materialize(both.mapInArrow(compare, "a long, b long, linked boolean"), "near_verified")
    drop_written(members), drop_written(wanted)
    return compared


def ordered_pairs(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def indexed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profiles, classes, lists), all written: documents; classes with ``cid`` and their group's ``gid`` and ``leader``;
    prefix entries of the shingles that several classes have in front, with the list's ``pivot``."""
    counts = repeated(docs)
    table = frequent(counts)
    drop_written(counts)
    for turn in range(TURNS + 1):
        found = profiles(docs, table)
        full = found.where("n > 0")
        groups = materialize(full.where("prefix is not null").groupBy("grp").agg(
            F.min("n").alias("n"), F.min("prefix").alias("prefix"))
            .withColumn("gid", F.monotonically_increasing_id()), "near_groups")
        classes = materialize(full.groupBy("class").agg(
            F.min("text_key").alias("text_key"), F.min("doc_id").alias("label"), F.min("grp").alias("grp"),
            *(F.min(c).alias(c) for c in PARITIES))
            .withColumn("cid", F.monotonically_increasing_id()), "near_classes")
        sizes = materialize(classes.groupBy("grp").agg(F.count("*").alias("m"), F.min("cid").alias("leader")), "near_sizes")
        entries = postings(groups.join(sizes, "grp"))
        pivot = F.min(F.struct("pos", "gid")).alias("pivot")
        heads = materialize(entries.groupBy("shingle").agg(F.sum("m").alias("size"), pivot).where("size > 1"), "near_heads")
        if turn == TURNS:
            break
        long = heads.where(F.col("size") > LONG_LIST).select("size", "shingle")
        least = -(-(long.agg(F.sum("size")).first()[0] or 0) // TABLE)  # no more than TABLE lists can be so long
        long = long.where(F.col("size") >= least).toPandas().sort_values(["size", "shingle"])
        new = long["shingle"].to_numpy(np.int64).view(np.uint64)
        new = new[~np.isin(new, table)]
        if not len(new):
            break
        table = np.concatenate([table, new])
        for written in (found, groups, classes, sizes, heads):  # the next turn writes them anew
            drop_written(written)
    group_sizes = materialize(groups.select("gid", F.col("n").cast("int").alias("n")), "near_group_sizes")
    n_of = small(group_sizes, 32)
    lists = entries.select("shingle", "gid", "pos").join(heads.select("shingle", "pivot"), "shingle").select(
        "shingle", "gid", "pos", F.col("pivot.gid").alias("pivot_gid"), F.col("pivot.pos").alias("pivot_pos"))
    pivot_n = n_of.select(F.col("gid").alias("pivot_gid"), F.col("n").alias("pivot_n"))
    lists = materialize(lists.join(n_of, "gid").join(pivot_n, "pivot_gid"), "near_lists")
    numbered = materialize(classes.join(groups.select("grp", "gid").join(sizes, "grp"), "grp").select(
        "class", "text_key", "label", "cid", "gid", "leader", *PARITIES), "near_numbered")
    for written in (groups, classes, sizes, heads, group_sizes):
        drop_written(written)
    return found, numbered, lists


def links(docs: DataFrame, classes: DataFrame, lists: DataFrame) -> DataFrame:
    """Verified links (``a``, ``b`` of class ids) that connect exactly the classes which all links connect."""
    meet = lists.where((F.col("gid") != F.col("pivot_gid")) & possible("n", "pos", "pivot_n", "pivot_pos")).select(
        F.col("pivot_gid").alias("other"), "gid").distinct()
    leaders = classes.select(F.col("gid").alias("other"), "leader").distinct()
    members = classes.select("gid", "cid")
    across = meet.join(leaders, "other").join(members, "gid").select(*ordered_pairs("leader", "cid"))
    inside = classes.where("cid <> leader").select(*ordered_pairs("leader", "cid"))
    pairs = materialize(across.unionByName(inside).distinct(), "near_pairs")
    first = verified(pairs, classes, docs)
    found = first.where("linked").select("a", "b")

    roots = components(found)
    entry = lists.select("shingle", "gid", "n", "pos").join(
        classes.select("gid", "cid").join(roots, F.col("cid") == F.col("node"), "left").select(
            "gid", "cid", F.coalesce("root", "cid").alias("root")), "gid")
    entry = materialize(entry, "near_entries")
    drop_written(lists), drop_written(roots)
    shares = entry.groupBy("shingle", "root").agg(F.count("*").alias("k"))
    split = materialize(shares.groupBy("shingle").agg(
        F.count("*").alias("roots"), F.max(F.struct("k", "root")).alias("top")).where("roots > 1")
        .select("shingle", F.col("top.root").alias("main")), "near_split")
    band = F.floor(F.ln("n") / math.log(BAND)).cast("int").alias("band")
    open_ = materialize(entry.join(split, "shingle").join(classes.select("cid", *PARITIES), "cid").select("*", band), "near_open")
    drop_written(entry), drop_written(split)
    one = open_.where("root <> main").select(
        "shingle", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"),
        *(F.col(c).alias(f"{c}1") for c in ("cid", "root", "main", "n", "pos", *PARITIES)))
    # a pair off the main root meets once from each side; the smaller id is taken
    apart = ((F.col("root1") != F.col("root")) & ((F.col("root") == F.col("main1")) | (F.col("cid1") < F.col("cid")))
             & possible("n1", "pos1", "n", "pos") & alike("n1", "n"))
    rest = one.join(open_.select("shingle", "band", "cid", "root", "n", "pos", *PARITIES), ["shingle", "band"]).where(apart)
    rest = rest.select(*ordered_pairs("cid1", "cid")).distinct().join(pairs, ["a", "b"], "left_anti")
    rest = materialize(rest, "near_pairs")
    drop_written(open_), drop_written(pairs)
    second = verified(rest, classes, docs)
    drop_written(rest)
    return found.unionByName(second.where("linked").select("a", "b"))


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profiles, classes with ``root``): documents with their class, and the class ids' connected components."""
    docs = texts(docs)
    found, classes, lists = indexed(docs)
    roots = components(links(docs, classes, lists))
    rooted = classes.join(roots, F.col("cid") == F.col("node"), "left").select(
        "class", "label", F.coalesce("root", "cid").alias("root"))
    written = materialize(rooted, "near_roots")
    drop_written(classes), drop_written(roots)
    return found, written


def jaccard_components(docs: DataFrame) -> DataFrame:
    """The digest of the query: ``doc_id``, ``n_shingles``, ``component_id`` of each row."""
    found, rooted = near_duplicates(docs)
    smallest = materialize(rooted.groupBy("root").agg(F.min("label").alias("component")), "near_smallest")
    named = materialize(rooted.select("class", "root").join(smallest, "root").select("class", "component"), "near_named")
    return found.select("doc_id", F.col("n").alias("n_shingles"), "class").join(named, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component"))
        .alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with one row of each component: its smallest ``doc_id`` (rows without one only where
    no other is there), of equal ids the smallest text.  Rows with the empty set all stay."""
    found, rooted = near_duplicates(docs)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    member = found.where("n > 0").select("class", row.alias("row")).groupBy("class").agg(F.min("row").alias("row"))
    chosen = rooted.select("class", "root").join(member, "class").groupBy("root").agg(F.min("row").alias("row"))
    chosen = chosen.select("row.doc_id", "row.text_key")
    same = found.where("n > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("copies")).where("copies > 1")
    match = lambda a, b: (a["_key"] == b["text_key"]) & a["_id"].eqNullSafe(b["doc_id"])
    key = F.struct("doc_id", "text_key")
    more = same.select(key.alias("k"), "copies")
    chosen = materialize(chosen.select("doc_id", "text_key", key.alias("k")).join(more, "k", "left").select(
        "doc_id", "text_key", F.coalesce("copies", F.lit(1)).alias("copies")), "near_chosen")
    empty = materialize(found.where("n = 0").select("doc_id", "text_key", F.lit(1).alias("copies")).distinct(), "near_empty")
    wanted = small(materialize(chosen.unionByName(empty), "near_kept"), 64)
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").alias("_id"),
                        F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("_key"))
    kept = keyed.join(wanted, match(keyed, wanted))
    once = kept.where("copies = 1").select("_row.*")
    if chosen.where("copies > 1").isEmpty():
        return once
    return once.unionByName(kept.where("copies > 1").dropDuplicates(["_id", "_key"]).select("_row.*"))
