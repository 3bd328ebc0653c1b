"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts anywhere else in
the corpus.  Texts are judged as UTF-8 bytes, on the input.

1. *Shards by content.*  Of the ``GRAM``-byte strings in a window (``LENGTH`` bytes) the one with the smallest
   hash is its anchor.  Equal windows have equal anchors, so they meet under the same
   anchor hash wherever they stand.  Neighbouring windows with the same anchor form a
   *stretch*, so each window of the corpus belongs to exactly one.
2. *What cannot repeat.*  A stretch whose anchor hash stands alone holds no repeated window.  Stretches with
   equal bytes are kept once; each of their windows is repeated.
3. *Suffix arrays.*  Different stretches under one anchor are sent to a shard by the
   anchor's hash.  The shard's bytes get a suffix array by induced sorting and its permuted common prefixes; a window
   with a common prefix of ``LENGTH`` or more bytes with its neighbour in the array is repeated.
4. *Hot anchors.*  If more than ``GROUP`` different stretches share one, their windows are split by the
   anchor's offset, and go by the hash of the longer string that each half's windows have in common; again
   until groups are small, at last to whole windows.  So no shard outgrows a task, and nothing is left out.
5. The repeated windows of each text are united, and the rest of its bytes hashed.

Defined results: a null or empty text is the empty text; texts under ``LENGTH`` bytes stay whole; repeated rows
are other documents (so they remove each other); nulls in other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_slices, materialize, mix, powers, text_bytes, texts
from tillroll.llm.suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 200, 64
#: Offsets that an anchor can have in a window.
OFFSETS = LENGTH - GRAM + 1
#: Different stretches that one anchor may bring to a shard, and bytes of a shard.
GROUP, SHARD_BYTES = 4096, 2 << 20
#: Window starts handled at a time; longer texts are cut between windows.
BLOCK = 1 << 20
BROADCAST_BYTES = 32 << 20
#: Stands between stretches in a shard; no UTF-8 text holds it.
SEPARATOR = 0xFF


def anchors(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of the texts ``raw[begin[k]:end[k]]`` (each of ``LENGTH`` bytes at least): text, first window, number
    of windows, anchor, anchor's hash."""
    n = len(raw)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashed = np.full(n, ~np.uint64(0))
    hashed[:n - GRAM + 1] = mix((total[GRAM:] - total[:n - GRAM + 1]) * down[:n - GRAM + 1])
    low = np.uint64((1 << 24) - 1)
    value = np.full(-(-n // OFFSETS) * OFFSETS + OFFSETS, ~np.uint64(0))
    value[:n] = (hashed & ~low) | np.arange(n, dtype=np.uint64)  # the first of equal ones is the smallest
    rows = value.reshape(-1, OFFSETS)  # smallest of OFFSETS values: the rest of one row and the start of the next
    to_right = np.minimum.accumulate(rows, axis=1).ravel()
    to_left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    size = end - begin - LENGTH + 1
    text = np.repeat(np.arange(len(begin)), size)
    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[text]
    anchor = (np.minimum(to_left[start], to_right[start + OFFSETS - 1]) & low).astype(np.int64)
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    return text[new], start[new], np.diff(np.append(new, len(start))), anchor[new], hashed[anchor[new]]


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, begin, end, row, offset in the row) of the texts long enough, long ones in blocks of windows."""
    raw, off = text_bytes(column)
    held: list[tuple[int, int, int, int]] = []
    size = 0
    for row, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        for at in range(a, b - LENGTH + 1, BLOCK):
            stop = min(b, at + BLOCK + LENGTH - 1)
            held.append((at, stop, row, at - a))
            size += stop - at
            if size >= BLOCK:
                yield _block(raw, held)
                held, size = [], 0
    if held:
        yield _block(raw, held)


def _block(raw, held):
    at, stop, row, offset = (np.array(x, np.int64) for x in zip(*held))
    size = stop - at
    end = np.cumsum(size)
    return np.concatenate([raw[a:b] for a, b, _, _ in held]), end - size, end, row, offset


def stretches(docs: DataFrame) -> DataFrame:
    """Written once, per document: ``rid``, ``text_key``, and its stretches: ``anchor`` and ``content`` hashes, first window
    ``start``, number of windows ``n``, anchor ``at`` from the first window."""
    lists = ("anchor", "content", "start", "n", "at")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, limit=BLOCK):
            parts = [[np.zeros(0, np.int64)] * 6]
            for raw, begin, end, row, offset in _blocks(batch.column(1)):
                text, start, n, anchor, key = anchors(raw, begin, end)
                view = memoryview(raw)
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(
                    start.tolist(), (start + n - 1 + LENGTH).tolist())), np.uint64, len(start))
                parts.append([row[text], key.view(np.int64), content.view(np.int64), start - begin[text] + offset[text],
                              n, anchor - start])
            row, *values = (np.concatenate(x) for x in zip(*parts))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.ListArray.from_arrays(pa.array(ends), pa.array(v if k < 2 else v.astype(np.int32)))
                                    for k, v in enumerate(values))], names=["text_key", *lists])

    rows = docs.select(F.unhex(F.md5("text")).alias("text_key"), "text")
    kinds = [T.LongType(), T.LongType(), T.IntegerType(), T.IntegerType(), T.IntegerType()]
    schema = T.StructType([rows.schema["text_key"], *(T.StructField(c, T.ArrayType(k)) for c, k in zip(lists, kinds))])
    return materialize(rows.mapInArrow(find, schema).withColumn("rid", F.monotonically_increasing_id()), "repeat_stretches")


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (written already) with a broadcast hint if its rows, counted, stay under ``BROADCAST_BYTES``."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def with_bytes(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Written once: a row for each of ``wanted`` (``gid``, ``text_key``, ``start``, ``n``, ``at``) with the stretch's ``bytes``,
    its anchor's place ``at`` in them, and the range of anchor offsets ``low`` to ``high`` (all)."""
    by_text = wanted.groupBy("text_key").agg(F.collect_list(F.struct("gid", "anchor", "start", "n", "at")).alias("s"))
    by_text = materialize(by_text, "repeat_wanted")
    size = by_text.agg(F.sum(F.size("s") * 40 + 40)).first()[0] or 0
    found = docs.select(F.unhex(F.md5("text")).alias("text_key"), "text").join(
        F.broadcast(by_text) if size <= BROADCAST_BYTES else by_text, "text_key").select("text_key", "s", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in byte_slices(batches):
            out = []
            for key, s, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key not in seen:  # copies of the text would give the same rows
                    seen.add(key)
                    raw = text.encode()
                    out += [(x["gid"], x["anchor"], x["at"], raw[x["start"]:x["start"] + x["n"] - 1 + LENGTH]) for x in s]
            if len(seen) > 1 << 18:
                seen.clear()
            if out:
                gid, anchor, at, raw = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gid, pa.int64()), pa.array(anchor, pa.int64()), pa.array(at, pa.int32()), pa.array(raw, pa.binary())],
                    names=["gid", "grp", "at", "bytes"])

    cut_out = found.mapInArrow(cut, "gid long, grp long, at int, bytes binary").dropDuplicates(["gid"])
    return materialize(cut_out.select("*", F.lit(0).alias("low"), F.lit(OFFSETS).alias("high")), "repeat_bytes")


def split(rows: DataFrame) -> DataFrame:
    """Each row's windows in two halves by their anchor offset, grouped by the string that a half's windows share."""
    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for gid, grp, at, raw, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                mid = (low + high) // 2
                for a, b in ((low, mid), (mid, high)):
                    # a window with anchor offset o starts at ``at - o``
                    if a < b and max(0, at - b + 1) <= min(len(raw) - LENGTH, at - a):
                        core = raw[at - a:at - b + 1 + LENGTH]
                        key = xxhash.xxh3_64_intdigest(core + a.to_bytes(2, "little"), seed=grp & (2**64 - 1))
                        out.append((gid, key - (key >> 63 << 64), at, raw, a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()))],
                    names=["gid", "grp", "at", "bytes", "low", "high"])

    return rows.select("gid", "grp", "at", "bytes", "low", "high").mapInArrow(halve, rows.select(
        "gid", "grp", "at", "bytes", "low", "high").schema)


def shard_repeats(pieces: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """(piece, first window, number of windows) of the runs of windows that stand twice or more in the pieces."""
    text = np.frombuffer(bytes([SEPARATOR]).join(pieces), np.uint8)
    order = suffix_array(text, LENGTH)
    before, length = common_prefixes(text, order, LENGTH)
    same = np.flatnonzero(length >= LENGTH)
    again = np.zeros(len(text) + 1, bool)
    again[same] = True
    again[before[same]] = True
    ends = np.cumsum([len(p) + 1 for p in pieces])
    steps = np.zeros(len(text) + 2, np.int64)  # only windows that end inside their piece
    np.add.at(steps, ends - [len(p) + 1 for p in pieces], 1)
    np.add.at(steps, ends - LENGTH, -1)
    again &= np.cumsum(steps)[:len(again)] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], again]).astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        piece = int(np.searchsorted(ends, a, side="right"))
        yield piece, a - int(ends[piece] - len(pieces[piece]) - 1), b - a


def repeats_in_shards(rows: DataFrame) -> DataFrame:
    """``gid``, ``first``, ``n``: runs of windows that stand twice or more among the stretches of their group."""
    total = rows.agg(F.sum(F.length("bytes").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for gid, grp, at, raw, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                first, last = max(0, at - high + 1), min(len(raw) - LENGTH, at - low)
                held.append((grp, gid, first, raw[first:last + LENGTH]))
        held.sort()
        at = 0
        while at < len(held):  # whole groups, up to a shard's size
            stop, size = at, 0
            while stop < len(held) and (size < SHARD_BYTES or held[stop][0] == held[stop - 1][0]):
                size += len(held[stop][3])
                stop += 1
            part = held[at:stop]
            found = [(part[k][1], part[k][2] + first, n) for k, first, n in shard_repeats([p[3] for p in part])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["gid", "first", "n"])
            at = stop

    return materialize(rows.select("gid", "grp", "at", "bytes", "low", "high").repartition(shards, "grp").mapInArrow(
        search, "gid long, first long, n long"), "repeat_found")


def repeated_runs(docs: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(``rid``, ``begin``, ``end`` of repeated byte ranges; ``rid``, ``text_key`` of the texts they refer to)."""
    found = stretches(docs)
    texts_ = materialize(found.groupBy("text_key").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "repeat_texts")
    every = found.join(_small(texts_.select("rid", "copies"), 24), "rid").select(
        "rid", "copies", F.explode(F.arrays_zip("anchor", "content", "start", "n", "at")).alias("s")).select(
        "rid", "copies", "s.*")
    anchors_ = materialize(every.groupBy("anchor").agg(
        F.sum("copies").alias("all"), F.min("content").alias("least"), F.max("content").alias("most")).where(
        "`all` > 1").select("anchor", F.expr("least <> most").alias("mixed")), "repeat_anchors")
    shared = materialize(every.join(anchors_, "anchor"), "repeat_shared")
    mixed = shared.where("mixed")
    contents = materialize(mixed.groupBy("anchor", "content").agg(
        F.sum("copies").alias("all"), F.min(F.struct("rid", "start", "n", "at")).alias("one"))
        .withColumn("gid", F.monotonically_increasing_id()), "repeat_contents")
    wanted = contents.select("gid", "anchor", "one.*").join(texts_.select("rid", "text_key"), "rid")
    open_ = with_bytes(wanted, docs)
    runs = None
    while True:
        size = materialize(open_.groupBy("grp").agg(F.count("*").alias("size")).where("size > 1"), "repeat_groups")
        hot = F.col("size") > group
        known = open_.join(size, "grp")
        whole = known.where(hot & (F.col("high") - F.col("low") == 1)).select(
            "gid", F.greatest(F.lit(0), F.col("at") - F.col("low")).cast("long").alias("first"), F.lit(1).cast("long").alias("n"))
        new = repeats_in_shards(known.where(~hot)).unionByName(whole)
        runs = new if runs is None else runs.unionByName(new)
        rest = known.where(hot & (F.col("high") - F.col("low") > 1))
        if rest.isEmpty():
            break
        open_ = materialize(split(rest), "repeat_split")
    in_shards = mixed.join(contents.select("anchor", "content", "gid", "all"), ["anchor", "content"])
    byte_range = lambda first, n: (F.struct(first.cast("long").alias("begin"), (first + n - 1 + LENGTH).cast("long").alias("end")))
    whole = shared.where("not mixed").select("rid", byte_range(F.col("start"), F.col("n")).alias("r"))
    copied = in_shards.where("`all` > 1").select("rid", byte_range(F.col("start"), F.col("n")).alias("r"))
    single = in_shards.where("`all` = 1").select("rid", "gid", "start").join(
        materialize(runs, "repeat_runs"), "gid").select(
        "rid", byte_range(F.col("start") + F.col("first"), F.col("n")).alias("r"))
    return whole.unionByName(copied).unionByName(single).select("rid", "r.*"), texts_.select("rid", "text_key")


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text`` of each row; ``kept_text`` is null where cutting
    has split a character."""
    docs = texts(docs)
    ranges, keys = repeated_runs(docs, group)
    per_text = ranges.groupBy("rid").agg(F.collect_list(F.col("begin") * (1 << 31) + F.col("end")).alias("ranges"))
    per_text = materialize(per_text.join(keys, "rid").select("text_key", "ranges"), "repeat_ranges")
    rows = docs.withColumn("text_key", F.unhex(F.md5("text"))).join(per_text, "text_key", "left").select(
        "doc_id", "ranges", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            out = []
            for ranges, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode()
                spans: list[list[int]] = []
                for x in sorted(ranges or ()):
                    a, b = x >> 31, x & (1 << 31) - 1
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                kept = b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(raw)]))
                try:
                    whole = kept.decode()
                except UnicodeDecodeError:
                    whole = None
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), whole))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(zip(*out), (
                pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    fields = [*(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
              T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())]
    return rows.mapInArrow(cut, T.StructType([rows.schema["doc_id"], *fields]))
