"""Language-model scores from a log-frequency Bloom filter.

Training documents give word and word-pair counts.  A count ``c`` is quantised to level
``1 + floor(log2 c)``, and an n-gram is entered into the filter once for each level up to its
own.  To read a count back, the levels are probed in turn until one is missing; the last one
found stands for the mean count of its range.  The filter has no false negatives, so a count is
never read too low; each further level that is not there is believed with the false-positive rate only.

``log10 P(w | h)`` is the Dirichlet-smoothed ``(c(h w) + PRIOR * p(w)) / (c(h) + PRIOR)`` with
``p(w) = (c(w) + 1) / (N + V + 1)``, all counts read from the filter; a text's score is the sum over its words and one end.

Steps:

1. One pass counts words and pairs in blocks and sends them, as sorted packed keys, to
   ``parts`` by key range.  Keys are hashes, so no part is hot whatever the words, and the number of parts follows
   the text's bytes.  Each part sums its counts, and builds a filter sized for exactly its entries.
2. The parts' filters are broadcast.  ``ROUND_BYTES`` bounds what is sent at once, word
   filters and pair filters alike.  If the word filters are larger, the levels of each
   text's words are read in several rounds into a written column; if the
   pair filters are, documents are scored in several rounds, each with the
   pairs of some parts.  The sums are the same.
3. The exact add-one score needs exact counts.  Words that have at least one in ``FREQUENT``
   tokens, at most ``FREQUENT`` of them whatever the corpus, are looked up in the same pass; the
   others go to their counts by a join.

Words are lower-cased (A-Z), without other normalisation, and are known by 64-bit hashes.
Defined results: a null or empty text is the single end token; a null id counts as
the empty id; repeated rows are documents of their own, also in training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_slices, hash_strings, materialize, mix, segment_sums, split_words, texts

#: Words counted at a time in a task, and bytes of text to a part.
BLOCK_WORDS, PART_BYTES = 1 << 21, 16 << 20
FREQUENT = 1 << 21
#: Filter: bits for each entry and probes for each test.  False-positive rate about 2 %.
BITS, PROBES = 8, 5
ROUND_BYTES = 128 << 20
PRIOR = 100.0
END = mix(np.array([0x656E64], np.uint64))[0]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def word_keys(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and end of all rows, and each row's offset (one more at the end)."""
    words, idx, off = split_words(text, lower=True)
    return np.insert(hash_strings(words)[idx], off[1:], END), off + np.arange(len(off))


def pair_keys(keys: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of each word, the key of the pair with the one before it; the end stands before a text's first word."""
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[off[:-1]] = END
    return mix(before * np.uint64(3) + keys)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Parts are key ranges: sorted keys have ascending parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def level(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def mean_count(levels: np.ndarray) -> np.ndarray:
    """The mean count of a level's range; 0 for level 0."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


def _probes(keys: np.ndarray, levels: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Bit positions of (key, level) in filters of these sizes, one probe after the other."""
    first = mix(keys + levels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = mix(first) | np.uint64(1)
    for _ in range(PROBES):
        yield (first % size).astype(np.int64)
        first = first + step


def build_filter(keys: np.ndarray, counts: np.ndarray, bits_each: int = BITS) -> np.ndarray:
    """The filter's bytes for keys with these counts."""
    top = level(counts)
    entries = int(top.sum())
    size = max(64, -(-entries * bits_each // 8) * 8)
    keys = np.repeat(keys, top)
    levels = np.arange(entries) - np.repeat(np.cumsum(top) - top, top) + 1
    bits = np.zeros(size, bool)
    for at in _probes(keys, levels, np.full(entries, size, np.uint64)):
        bits[at] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """Filters of consecutive parts, ``first`` being the first part's number."""

    def __init__(self, raw: list[bytes], parts: int, first: int = 0):
        self.parts, self.first = parts, first
        size = np.array([8 * len(x) for x in raw], np.int64)
        self.begin, self.size = np.cumsum(size) - size, size.astype(np.uint64)
        self.bits = np.frombuffer(b"".join(raw), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level read for each key, -1 for a key of a part that is not here."""
        part = part_of(keys, self.parts) - self.first
        here = (part >= 0) & (part < len(self.size))
        found = np.where(here, 0, -1)
        active = np.flatnonzero(here)
        n = 1
        while len(active):
            p = part[active]
            begin, kept = self.begin[p], np.ones(len(active), bool)
            for at in _probes(keys[active], np.full(len(active), n), self.size[p]):
                at = begin + at
                kept &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            active = active[kept]
            found[active] = n
            n += 1
        return found


def _packed(kind: str, keys: np.ndarray, parts: int) -> Iterator[tuple]:
    """(part, kind, keys, counts) rows of a block."""
    keys, n = np.unique(keys, return_counts=True)
    cut = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
    for p, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        if a < b:
            yield p, kind, keys[a:b].tobytes(), n[a:b].astype(np.uint32).tobytes()


def model(training: DataFrame, part_bytes: int = PART_BYTES, block_words: int = BLOCK_WORDS,
          bits_each: int = BITS) -> tuple[DataFrame, int]:
    """(``part``, ``words``, ``counts``, ``word_bits``, ``pair_bits``, ``n``, ``v`` of each part, written once; number of parts)."""
    total = training.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    schema = "part int, kind string, keys binary, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done():
            rows = [*_packed("word", np.concatenate([k for k, _ in held]), parts),
                    *_packed("pair", np.concatenate([p for _, p in held]), parts)]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (
                pa.int32(), pa.string(), pa.binary(), pa.binary()))], names=["part", "kind", "keys", "counts"])

        for batch in byte_slices(batches):
            keys, off = word_keys(batch.column(0))
            held.append((keys, pair_keys(keys, off)))
            size += len(keys)
            if size >= block_words:
                yield done()
                held, size = [], 0
        if held:
            yield done()

    def total_of(rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k, _ in rows] or [np.zeros(0, np.uint64)])
        n = np.concatenate([np.frombuffer(c, np.uint32) for _, c in rows] or [np.zeros(0, np.uint32)]).astype(np.int64)
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[new], np.add.reduceat(n, new) if len(new) else n

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, list]] = {}
        for batch in batches:
            for p, kind, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(p, {"word": [], "pair": []})[kind].append((keys, counts))
        for p in sorted(held):
            one = held.pop(p)
            words, n = total_of(one["word"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                    words.tobytes(), n.tobytes(), build_filter(words, n, bits_each).tobytes(),
                    build_filter(*total_of(one["pair"]), bits_each).tobytes())),
                 pa.array([int(n.sum())], pa.int64()), pa.array([len(words)], pa.int64())],
                names=["part", "words", "counts", "word_bits", "pair_bits", "n", "v"])

    sent = training.select("text").mapInArrow(count, schema).repartitionById(parts, "part")  # a task for each part
    built = sent.mapInArrow(build, "part int, words binary, counts binary, word_bits binary, pair_bits binary, n long, v long")
    return materialize(built, "lm_parts"), parts


def vocabulary(built: DataFrame, least: int = 1) -> DataFrame:
    """``key``, ``c`` of each training word with at least ``least`` tokens."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key, n = np.frombuffer(words, np.int64), np.frombuffer(counts, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key[n >= least]), pa.array(n[n >= least])], names=["key", "c"])

    return built.select("words", "counts").mapInArrow(explode, "key long, c long")


def rounds(built: DataFrame, parts: int, limit: int, column: str = "pair_bits") -> list[tuple[int, int]]:
    """Ranges of parts whose filters stay under ``limit`` bytes together (one part at least)."""
    sizes = dict(built.select("part", F.length(column)).collect())
    out, size = [[0, 0]], 0
    for p in range(parts):
        if size and size + sizes.get(p, 0) > limit:
            out.append([p, p])
            size = 0
        size += sizes.get(p, 0)
        out[-1][1] = p + 1
    return [tuple(x) for x in out]


def _bits(built: DataFrame, column: str, begin: int, end: int) -> list[bytes]:
    chosen = built.where(F.col("part").between(begin, end - 1)).select("part", column)
    rows = {part: bits for part, bits in chosen.toLocalIterator()}  # a few parts at a time pass through the JVM
    return [rows.get(p, b"\0" * 8) for p in range(begin, end)]


def written_levels(rows: DataFrame, built: DataFrame, parts: int, ranges: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``levels``, a byte for each word and end of the text, read from the word filters of one range of parts after the other."""
    out = rows.withColumn("levels", F.lit(None).cast("binary"))
    for begin, end in ranges:
        words = rows.sparkSession.sparkContext.broadcast(Filter(_bits(built, "word_bits", begin, end), parts, begin))

        def read(batches: Iterator[pa.RecordBatch], words=words) -> Iterator[pa.RecordBatch]:
            for batch in byte_slices(batches):
                at = batch.schema.get_field_index("levels")
                keys, off = word_keys(batch.column(batch.schema.get_field_index("text")))
                single, of = np.unique(keys, return_inverse=True)
                levels = np.maximum(words.value.levels(single), 0).astype(np.uint8)[of]
                before = b"".join(x for x in batch.column(at).to_pylist() if x is not None)
                if before:
                    levels = np.maximum(levels, np.frombuffer(before, np.uint8))
                raw = levels.tobytes()
                cut = [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield batch.set_column(at, "levels", pa.array(cut, pa.binary()))

        out = materialize(out.mapInArrow(read, out.schema), "lm_levels")
    return out


def score(docs: DataFrame, round_bytes: int = ROUND_BYTES, prior: float = PRIOR, frequent: int = FREQUENT,
          part_bytes: int = PART_BYTES, block_words: int = BLOCK_WORDS, bits_each: int = BITS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row."""
    spark = docs.sparkSession
    rows = texts(docs).withColumn("held_out", held_out(F.col("doc_id")))
    built, parts = model(rows.where(~F.col("held_out")), part_bytes, block_words, bits_each)
    total, distinct = (x or 0 for x in built.agg(F.sum("n"), F.sum("v")).first())
    smooth = total + distinct + 1
    hot = vocabulary(built, max(1, -(-total // frequent))).toPandas()  # at most ``frequent`` words can have so many tokens
    order = np.argsort(hot["key"].to_numpy(np.int64).view(np.uint64))
    known = spark.sparkContext.broadcast((hot["key"].to_numpy(np.int64).view(np.uint64)[order],
                                          hot["c"].to_numpy(np.int64)[order]))
    word_ranges = rounds(built, parts, round_bytes, "word_bits")
    words = None
    if len(word_ranges) > 1:
        rows = written_levels(rows, built, parts, word_ranges)
    else:
        words = spark.sparkContext.broadcast(Filter(_bits(built, "word_bits", 0, parts), parts))

    def model_score(batch: pa.RecordBatch, keys: np.ndarray, off: np.ndarray, pairs: Filter) -> np.ndarray:
        """Sum of log probabilities of the words whose pair is in these parts, by row."""
        if words is None:
            levels = b"".join(batch.column(batch.schema.get_field_index("levels")).to_pylist())
            count = mean_count(np.frombuffer(levels, np.uint8).astype(np.int64))
        else:
            single, at = np.unique(keys, return_inverse=True)
            count = mean_count(words.value.levels(single))[at]
        both, of = np.unique(pair_keys(keys, off), return_inverse=True)
        levels = pairs.levels(both)
        joint, here = mean_count(levels)[of], (levels >= 0)[of]
        before = np.empty_like(count)
        before[1:] = count[:-1]
        before[off[:-1]] = count[off[1:] - 1]  # the end
        before = np.maximum(before, joint)
        p = (joint + prior * (count + 1) / smooth) / (before + prior)
        logs = np.concatenate([[0.0], np.cumsum(np.where(here, np.log10(np.minimum(p, 1.0)), 0.0))])
        return logs[off[1:]] - logs[off[:-1]]

    ranges = rounds(built, parts, round_bytes)
    for n, (begin, end) in enumerate(ranges):
        pairs = spark.sparkContext.broadcast(Filter(_bits(built, "pair_bits", begin, end), parts, begin))
        if n == 0:
            def first(batches: Iterator[pa.RecordBatch], pairs=pairs) -> Iterator[pa.RecordBatch]:
                table, counts = known.value
                for batch in byte_slices(batches):
                    keys, off = word_keys(batch.column(1))
                    row = np.repeat(np.arange(batch.num_rows), np.diff(off))
                    at = np.minimum(np.searchsorted(table, keys), max(0, len(table) - 1))
                    hit = table[at] == keys if len(table) else np.zeros(len(keys), bool)
                    logs = np.where(hit, np.log10(np.where(hit, counts[at], 0) + 1.0), 0.0) if len(table) else np.zeros(len(keys))
                    logs = np.bincount(row, logs, batch.num_rows)
                    rare_row, rare_key = row[~hit], keys[~hit]
                    order = np.lexsort((rare_key, rare_row))
                    rare_row, rare_key = rare_row[order], rare_key[order]
                    new = np.flatnonzero(np.append(True, (rare_row[1:] != rare_row[:-1]) | (rare_key[1:] != rare_key[:-1]))) \
                        if len(order) else np.zeros(0, np.int64)
                    copies = np.diff(np.append(new, len(order)))
                    ends = np.concatenate([[0], np.cumsum(np.bincount(rare_row[new], minlength=batch.num_rows))]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(np.diff(off)), pa.array(segment_sums(hit, off)), pa.array(logs),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(rare_key[new].view(np.int64))),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(copies.astype(np.int32))),
                         pa.array(model_score(batch, keys, off, pairs.value))],
                        names=[*batch.schema.names, "n_tokens", "hot_known", "hot_logs", "rare", "copies", "score"])

            fields = [T.StructField("n_tokens", T.LongType()), T.StructField("hot_known", T.LongType()),
                      T.StructField("hot_logs", T.DoubleType()), T.StructField("rare", T.ArrayType(T.LongType())),
                      T.StructField("copies", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType())]
            out = rows.mapInArrow(first, T.StructType([*rows.schema.fields, *fields]))
        else:
            def more(batches: Iterator[pa.RecordBatch], pairs=pairs) -> Iterator[pa.RecordBatch]:
                for batch in byte_slices(batches):
                    at = batch.schema.get_field_index("score")
                    keys, off = word_keys(batch.column(batch.schema.get_field_index("text")))
                    new = batch.column(at).to_numpy(zero_copy_only=False) + model_score(batch, keys, off, pairs.value)
                    yield batch.set_column(at, "score", pa.array(new))

            out = out.mapInArrow(more, out.schema)
        if n + 1 < len(ranges):  # the next round's filter is sent when this one's work is done
            out = materialize(out, "lm_scored")
        else:
            out = materialize(out.drop("text", "levels").withColumn("row", F.monotonically_increasing_id()), "lm_scored")
    rare = out.where("size(rare) > 0").select("row", F.explode(F.arrays_zip("rare", "copies")).alias("r")).select(
        "row", F.col("r.rare").alias("key"), F.col("r.copies").alias("copies"))
    looked_up = rare.join(materialize(vocabulary(built), "lm_words"), "key").groupBy("row").agg(
        F.sum("copies").alias("rare_known"), F.sum(F.col("copies") * F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    logs = F.col("hot_logs") + F.coalesce("rare_logs", F.lit(0.0))
    return out.join(looked_up, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(smooth))).alias("base_score"), "score")
