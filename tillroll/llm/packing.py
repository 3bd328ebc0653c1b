"""Mixture-controlled packing by deficit round-robin.

Each source is a queue of documents, taken in turns: a queue gives a whole
document (of a longer one at most ``size`` tokens) and is then passed over until
the others have caught up, so what it gave too much is its deficit, carried over
as many windows as it takes to repay.  The turns are kept in closed form: a
stretch of a document that begins ``p`` tokens into its queue is due when the
queues have given ``p / target`` each, and the output is all stretches in the order of
their due times, cut every ``size`` tokens.  At any point of the output a queue
is thus ahead of the common time by less than one stretch and never behind it;
a stretch's due time follows from its own place, so partitions carry the same
deficits without seeing each other.  A queue that runs dry drops out and the
others go on in their proportions; sources without a target come after all others.

Documents stay whole where they can: a piece ends at its document's end, after
``size`` tokens of a longer document, or at a window's end.

Steps: tokenise once and write ids with each document's place in its (task,
source) queue; add up the queues' lengths, which gives places in whole queues and
due times; range-partition the stretches by due time, without their ids, and
write running positions; add the earlier partitions' totals, join them to the
ids and cut at the windows.  Sources are rows of tables
joined by source, however many there are; the driver sees one total a partition.

All windows are full.  What is left at the end forms sequences of power-of-two
length, so nothing is padded at all.

Defined results: a null or empty text is the single end id; a null source is the
source ''; repeated rows are separate documents; texts of any length are taken
whole; columns other than doc_id, source and text are ignored whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import gc
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import WORD_SLICE_BYTES, byte_slices, materialize, split_words, worker_tables

SIZE = 2048
END_ID = 1
#: Words a worker remembers, and the longest one it does.
TABLE_SIZE, TABLE_CHARS = 150_000, 64
_loaded: dict[str, WordEncoder] = {}
worker_tables.append(_loaded)


class WordEncoder:
    """Ids of words by the tokenizer at ``path``, with a bounded table of those seen.

    Plain words, Latin letters and one punctuation mark at most behind them, fall
    into these two parts, and the lower-cased letters are encoded by the same merges as ranks
    of byte strings, which a rank-based encoder does several times faster: the tokenizer's mark for a
    word's end becomes the byte ``END_MARK``, which no plain word holds.  All other words, and all
    words of a tokenizer of another make, go through the library itself.
    """

    END_MARK = b"\x01"
    PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[.,;:!?]?)$"
    #: The make of tokenizer for which the shortcut holds.
    NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.table: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.fast = self._ranks(json.loads(self.library.to_str()))

    def _ranks(self, made: dict):
        model = made["model"]
        split = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        if ((made["normalizer"] or {}).get("normalizers") != self.NORMALIZER or model["type"] != "BPE"
                or model["end_of_word_suffix"] != "</w>" or split[0].get("pattern") != {"Regex": self.SPLIT}):
            return None
        import tiktoken
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE writes the other bytes from 256 on
        byte = {chr(b): b for b in printed}
        byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printed))}
        ranks, self.ends = {}, np.zeros(max(model["vocab"].values()) + 1, bool)
        for token, i in model["vocab"].items():
            self.ends[i] = token.endswith("</w>") and len(token) > 4
            core = token.removesuffix("</w>") if self.ends[i] else token
            ranks[bytes(byte[c] for c in core) + self.END_MARK * bool(self.ends[i])] = i
        return tiktoken.Encoding("ranks", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})

    def _encode_letters(self, words: list[str]) -> None:
        ids = np.array(self.fast.encode_ordinary(" ".join(w + "\x01" for w in words)), np.uint32)
        raw, cut = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        assert len(cut) == len(words)
        self.letters.update((w, raw[a:b]) for w, a, b in zip(words, [0, *cut], cut))

    def _look_up(self, table: dict[str, bytes], words: list[str], encode) -> list[bytes]:
        if len(table) > TABLE_SIZE:
            table.clear()
        new = [w for w in words if w not in table]
        if new:
            encode(new)
        out = [table[w] for w in words]
        for w in new:
            if len(w) > TABLE_CHARS:
                del table[w]
        return out

    def _encode_others(self, words: list[str]) -> None:
        made = self.library.encode_batch_fast(words, add_special_tokens=False)
        self.table.update((w, np.array(e.ids, np.uint32).tobytes()) for w, e in zip(words, made))

    def encode(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """For distinct words: the ids of their parts, as bytes of unsigned 32-bit numbers, and each word's first and
        second part (-1 for none)."""
        first, second = np.zeros(len(words), np.int64), np.full(len(words), -1)
        coded: list[bytes] = []
        if self.fast is None:
            other = np.arange(len(words))
        else:
            parts = pc.extract_regex(words, self.PLAIN)
            plain = np.flatnonzero(parts.is_valid().to_numpy(zero_copy_only=False))
            other = np.flatnonzero(parts.is_null().to_numpy(zero_copy_only=False))
            parts = parts.take(pa.array(plain))
            letters = pc.utf8_lower(parts.field("letters")).dictionary_encode()
            coded = self._look_up(self.letters, letters.dictionary.to_pylist(), self._encode_letters)
            first[plain] = letters.indices.to_numpy(zero_copy_only=False)
            marks = parts.field("mark").dictionary_encode()
            names = marks.dictionary.to_pylist()
            place = np.array([len(coded) + k if x else -1 for k, x in enumerate(names)], np.int64)
            second[plain] = place[marks.indices.to_numpy(zero_copy_only=False)]
            coded = coded + self._look_up(self.table, names, self._encode_others)
        first[other] = len(coded) + np.arange(len(other))
        coded = coded + self._look_up(self.table, words.take(pa.array(other)).to_pylist(), self._encode_others)
        return coded, first, second


def _tokenizer(path: str) -> WordEncoder:
    if path not in _loaded:
        gc.freeze()  # the tables hold no cycles: searching them again and again is the larger part of the work
        gc.set_threshold(200_000, 50, 1000)
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def id_type(path: str) -> str:
    """The narrowest of two types in which the tokenizer's ids are kept between the steps."""
    return "<u2" if _tokenizer(path).library.get_vocab_size() <= 1 << 16 else "<u4"


def encode_column(text: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end_id``, and each text's offset in them (one more at the end).

    Words between white space are encoded apart: the tokenizer drops white
    space, splits at it, and composes no characters across it, so a text's ids
    are those of its words in order.
    """
    words, idx, off = split_words(text)
    coded, first, second = _tokenizer(path).encode(words)
    parts = np.stack([first[idx], second[idx]], 1)
    end = len(coded)
    coded = [*coded, np.array([end_id], np.uint32).tobytes()]
    parts = np.insert(parts, off[1:], (end, -1), axis=0).ravel()
    there = parts >= 0
    last = np.flatnonzero(parts[there] == end)  # the end of each text
    order = parts[there]
    length = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    flat = np.frombuffer(b"".join(coded), np.uint32)
    begin = np.cumsum(length) - length
    size = length[order]
    done = np.cumsum(size)
    ids = flat[np.repeat(begin[order] - (done - size), size) + np.arange(done[-1] if len(done) else 0)]
    return ids, np.concatenate([[0], done[last]])


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Written once: ``doc_id``, ``source``, ``part``, ``place`` (ids before it in its task's queue), ``n``, ``ids``."""
    width = id_type(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given = TaskContext.get().partitionId(), {}
        for batch in byte_slices(batches, "_text", WORD_SLICE_BYTES, keep_tables=True):
            ids, off = encode_column(batch.column(2), path, end_id)
            n, place = np.diff(off), []
            for source, k in zip(batch.column(1).to_pylist(), n.tolist()):
                place.append(given.get(source, 0))
                given[source] = place[-1] + k
            coded = pa.Array.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer(off * np.dtype(width).itemsize), pa.py_buffer(ids.astype(width))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(place, pa.int64()), pa.array(n), coded.cast(pa.binary())],
                names=["doc_id", "source", "part", "place", "n", "ids"])

    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("part", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("place", "n")),
                           T.StructField("ids", T.BinaryType())])
    return materialize(rows.mapInArrow(encode, schema), "packing_ids")


def tail_cuts(total: int, size: int = SIZE) -> list[int]:
    """Output positions at which the sequences after the last full window begin: power-of-two lengths, largest first."""
    cuts, at = [], total - total % size
    for bit in reversed(range(size.bit_length())):
        if (total % size) >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return cuts


def due_times(coded: DataFrame, targets: dict[str, int] | None) -> DataFrame:
    """``source``, ``part``, ``base`` (tokens of its queue before the part) and ``weight``, ``late`` of the queue: a
    token at place p is due at ``late + p / weight``."""
    by_part = materialize(coded.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing_queues")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    totals = by_part.groupBy("source").agg(F.sum("n").cast("double").alias("weight"))
    if targets is None:  # each queue's own length: they all end together
        queues = totals.withColumn("late", F.lit(0.0))
    else:
        named = coded.sparkSession.createDataFrame([(s, float(t)) for s, t in targets.items() if t > 0] or [("", None)],
                                                   "source string, target double")
        queues = totals.join(named, "source", "left")
        last = queues.agg(F.coalesce(F.max(F.col("weight") / F.col("target")), F.lit(0.0))).scalar()
        queues = queues.select("source", F.coalesce("target", "weight").alias("weight"),
                               F.when(F.col("target").isNull(), last + 1).otherwise(0.0).alias("late"))
    return materialize(by_part.select("source", "part", base).join(queues, "source"), "packing_places")


def stretches(coded: DataFrame, queues: DataFrame, size: int) -> DataFrame:
    """Stretches of at most ``size`` tokens, without their ids: the document's ``source, doc_part, place``, and ``start, n,
    due, queue_place``."""
    rows = coded.select("source", "part", "place", F.col("n").alias("doc_tokens")).join(queues, ["source", "part"])
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(size).cast("long")))
    rows = rows.withColumn("start", starts).withColumn("queue_place", F.col("base") + F.col("place") + F.col("start"))
    return rows.select("source", F.col("part").alias("doc_part"), "place", "start", "queue_place",
                       F.least(F.lit(size).cast("long"), F.col("doc_tokens") - F.col("start")).alias("n"),
                       (F.col("late") + F.col("queue_place") / F.col("weight")).alias("due"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the tokens before each stretch in it."""
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column(batch.schema.get_field_index("n")).to_numpy()
        ends = done + np.cumsum(n)
        yield batch.append_column("part", pa.array(np.full(len(n), part, np.int32))).append_column("at", pa.array(ends - n))
        done = int(ends[-1]) if len(ends) else done


def cut_at_windows(at: int, n: int, total: int, cuts: list[int], size: int) -> Iterator[tuple[int, int, int]]:
    """(sequence, offset, length) of the pieces of ``n`` tokens that stand at ``at`` of ``total``; ``cuts``: ``tail_cuts``."""
    whole = total // size
    while n:
        if at < whole * size:
            sequence, offset, take = at // size, at % size, min(n, size - at % size)
        else:
            c = bisect.bisect_right(cuts, at) - 1
            end = cuts[c + 1] if c + 1 < len(cuts) else total
            sequence, offset, take = whole + c, at - cuts[c], min(n, end - at)
        yield sequence, offset, take
        at, n = at + take, n - take


def pack(docs: DataFrame, path: str, targets: dict[str, int] | None = None, size: int = SIZE,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source``.

    ``targets`` gives whole-numbered weights by source (a source that is not named
    comes after those that are); by default each source has its share of the corpus.
    """
    coded, width = tokenised(docs, path, end_id), id_type(path)
    rows = stretches(coded, due_times(coded, targets), size)
    keys = ["due", "source", "queue_place"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("due", "queue_place")
    schema = T.StructType([*ordered.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
    laid = materialize(ordered.mapInArrow(_running, schema), "packing_order")
    sums = {r[0]: r[1] for r in laid.groupBy("part").agg(F.sum("n")).collect()}  # one row a partition
    before, total = {}, 0
    for part in sorted(sums):
        before[part] = total
        total += sums[part]
    cuts = tail_cuts(total, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "ids"):
            row_of, out = [], [[] for _ in range(5)]
            for row, (ids, own) in enumerate(zip(batch.column(3), batch.column(4).to_pylist())):
                ids = np.frombuffer(ids.as_buffer(), width).astype("<u4").tobytes()
                for s in own:
                    start = s["start"]
                    for sequence, offset, take in cut_at_windows(before[s["part"]] + s["at"], s["n"], total, cuts, size):
                        row_of.append(row)
                        for x, v in zip(out, (start, take, zlib.crc32(ids[4 * start:4 * (start + take)]), sequence, offset)):
                            x.append(v)
                        start += take
            row_of = pa.array(row_of, pa.int64())
            starts, lengths, crcs, sequences, offsets = (pa.array(x, pa.int64()) for x in out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row_of), starts, lengths, crcs, batch.column(2).take(row_of), sequences, offsets,
                 batch.column(1).take(row_of)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    # a document's stretches are as many as its length allows; its ids travel once
    own = laid.groupBy("source", F.col("doc_part").alias("part"), "place").agg(
        F.collect_list(F.struct("start", "n", "part", "at")).alias("own"))
    placed = coded.join(own, ["source", "part", "place"]).select("doc_id", "source", F.col("n").alias("doc_tokens"), "ids", "own")
    schema = T.StructType([placed.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), T.StructField("source", T.StringType())])
    return placed.mapInArrow(cut, schema)
