"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a maximal stretch of words with smallest period q whose length is at
least ``EXPONENT`` times q (and ``LEAST`` words).  At scale B = 1, 2, 4, ... a
text is cut into blocks of B words.  A run with B <= q < 2B holds whole blocks
that occur again q words later, so for every block the sum of squared differences
of word numbers against each of the B offsets in the following 2B words is taken:
a cyclic convolution of length 2B, computed exactly modulo a prime by a number
theoretic transform over all blocks of a slice of texts at once.  Offsets with
sum zero are occurrences; consecutive blocks that recur at the same distance form
chains, and a chain long enough seeds a run, extended word by word at both ends
(by less than a block, or the neighbouring block would belong to the chain).

* A distance that is a multiple of a shorter period found at an earlier scale is
  dropped (the run there explains it), so the chains left at a scale are few:
  a text of one repeated word costs no more than others.
* The sum is zero modulo the prime wherever it is zero; the reverse could fail,
  so the words of each seed are compared.  No result rests on a hash.

Work is O(n log n) a scale with scales up to a quarter of the longest text of the
slice; memory follows the slice (one text at least).

Inputs: null text counts as empty, null ids are kept, repeated rows each have
their own row, other columns are ignored whatever their names; an empty table
gives no rows.  A text without runs has an empty list and its words as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import byte_slices, split_words, texts

#: A run's least length in words, and in periods (the chains rest on four periods at least).
LEAST, EXPONENT = 6, 4
#: 15 * 2**27 + 1, a prime with primitive root 31: transforms of up to 2**27 points.
PRIME, ROOT = 2013265921, 31
#: Points transformed at a time.
POINTS = 1 << 17

_P = np.uint64(PRIME)
_made: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half (tables of 2**16 entries at most are kept)."""
    got = _made.get((half, inverse))
    if got is None:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, PRIME - 2, PRIME) if inverse else root
        got = np.ones(1, np.uint64)
        while len(got) < half:  # the powers so far, times the next power
            got = np.concatenate([got, _reduce(got * np.uint64(pow(root, len(got), PRIME)))])
        if half <= 1 << 16:
            _made[half, inverse] = got
    return got[:, None]


def _reduce(x: np.ndarray) -> np.ndarray:
    return x - x // _P * _P


def _once(x: np.ndarray) -> np.ndarray:
    """x below 2 * PRIME, reduced (the subtraction wraps where x is smaller)."""
    return np.minimum(x, x - _P)


def _spread(x: np.ndarray, inverse: bool) -> np.ndarray:
    """Transform of each column, in place; rows come out in bit-reversed order."""
    points, columns = x.shape
    half = points // 2
    while half:
        v = x.reshape(points // (2 * half), 2, half, columns)
        low, high = v[:, 0], v[:, 1]
        apart = low + (_P - high)
        v[:, 0] = _once(low + high)
        v[:, 1] = _reduce(apart * _twiddles(half, inverse))
        half //= 2
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """Inverse of ``_spread(x, False)`` but for the factor 1 / points, in place; takes rows in bit-reversed order."""
    points, columns = x.shape
    half = 1
    while half < points:
        v = x.reshape(points // (2 * half), 2, half, columns)
        low, high = v[:, 0].copy(), _reduce(v[:, 1] * _twiddles(half, True))
        v[:, 0] = _once(low + high)
        v[:, 1] = _once(low + (_P - high))
        half *= 2
    return x


def block_matches(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the block of ``block`` words at each start has zero squared difference (modulo PRIME) to the words
    ``block`` to 2 * block - 1 further on, and how far on.  ``ends``: end of each start's text."""
    far, found = 2 * block, ([], [])
    other = np.uint64(int(x.max(initial=0)) + 1)  # stands for words past a text's end
    scale = np.uint64(pow(far, PRIME - 2, PRIME) * 2 % PRIME)
    ramp = np.arange(far)[:, None]
    for at in range(0, len(starts), max(1, POINTS // far)):
        begin, end = (a[at:at + max(1, POINTS // far)] for a in (starts, ends))
        place = begin[None, :] + block + ramp
        window = np.where(place < end[None, :], x[np.minimum(place, len(x) - 1)], other)
        own = np.zeros((far, len(begin)), np.uint64)
        own[:block] = x[begin[None, :] + ramp[:block]]
        squares = np.zeros((far + 1, len(begin)), np.uint64)
        np.cumsum(_reduce(window * window), axis=0, out=squares[1:])
        sums = _reduce(squares[block:far] - squares[:block] + _reduce(own * own).sum(axis=0)[None, :])
        both = _gather(_reduce(_spread(window, False) * _spread(own, True)))[:block]
        offset, column = np.nonzero(sums == _reduce(both * scale))
        found[0].append(begin[column])
        found[1].append(offset + block)
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def _uncovered(starts: np.ndarray, apart: np.ndarray, block: int, runs: np.ndarray) -> np.ndarray:
    """Of seeds sorted by start: those that no run with a period dividing their distance holds."""
    kept = np.ones(len(starts), bool)
    for begin, length, period in runs[runs[:, 1] >= 2 * block]:
        low, high = np.searchsorted(starts, [begin, begin + length])
        d = apart[low:high]
        kept[low:high] &= (d % period != 0) | (starts[low:high] + d + block > begin + length)
    return kept


def _same(x: np.ndarray, starts: np.ndarray, apart: np.ndarray, block: int) -> np.ndarray:
    """Whether the block at each start is equal, word by word, to the one at its distance."""
    out, step = np.zeros(len(starts), bool), max(1, POINTS // block)
    for at in range(0, len(starts), step):
        place = starts[at:at + step, None] + np.arange(block)[None, :]
        out[at:at + step] = (x[place] == x[place + apart[at:at + step, None]]).all(axis=1)
    return out


def _reach(x: np.ndarray, at: np.ndarray, apart: np.ndarray, low: np.ndarray, high: np.ndarray, block: int, step: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``apart`` further on, inside the text."""
    out, rows = np.zeros(len(at), np.int64), max(1, POINTS // block)
    for k in range(0, len(at), rows):
        cut = slice(k, k + rows)
        place = at[cut, None] + step * np.arange(block)[None, :]
        inside = (place >= low[cut, None]) & (place + apart[cut, None] < high[cut, None])
        place = np.clip(place, 0, len(x) - 1)
        other = np.minimum(place + apart[cut, None], len(x) - 1)
        equal = np.zeros((place.shape[0], block + 1), bool)
        equal[:, :-1] = inside & (x[place] == x[other])
        out[cut] = np.argmin(equal, axis=1)
    return out


def find_runs(x: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts: rows (start, length, period) by start, then period, and each text's offset in them.

    ``x``: word numbers of the texts one after another, ``offsets``: where each
    begins (one more at the end).  Starts count from the text's first word.
    """
    x = x.astype(np.uint64, copy=False)
    runs = np.zeros((0, 3), np.int64)
    sizes = np.diff(offsets)
    block = 1
    while (use := np.flatnonzero(sizes >= max(LEAST, EXPONENT * block))).size:
        count = sizes[use] // block - 1
        text = np.repeat(use, count)
        first = np.repeat(np.cumsum(count) - count, count)
        starts = offsets[text] + (np.arange(len(text)) - first) * block
        begin, apart = block_matches(x, starts, offsets[text + 1], block)
        order = np.argsort(begin, kind="stable")
        begin, apart = begin[order], apart[order]
        kept = _uncovered(begin, apart, block, runs)
        begin, apart = begin[kept], apart[kept]
        kept = _same(x, begin, apart, block)
        order = np.lexsort((begin[kept], apart[kept]))
        begin, apart = begin[kept][order], apart[kept][order]
        if len(begin):
            text = np.searchsorted(offsets, begin, side="right") - 1
            new = np.ones(len(begin), bool)
            new[1:] = (np.diff(apart) != 0) | (np.diff(begin) != block) | (np.diff(text) != 0)
            head = np.flatnonzero(new)
            links = np.diff(np.append(head, len(begin)))
            begin, apart, text = begin[head], apart[head], text[head]
            enough = links >= np.maximum(1, (np.maximum((EXPONENT - 1) * apart, LEAST - apart) - block + 1) // block)
            begin, apart, text, links = (a[enough] for a in (begin, apart, text, links))
            low, high = offsets[text], offsets[text + 1]
            left = _reach(x, begin - 1, apart, low, high, block, -1)
            right = _reach(x, begin + links * block, apart, low, high, block, 1)
            length = left + links * block + right + apart
            good = length >= np.maximum(LEAST, EXPONENT * apart)
            runs = np.concatenate([runs, np.stack([begin - left, length, apart], axis=1)[good]])
        block *= 2
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = np.searchsorted(offsets, runs[:, 0], side="right") - 1
    ends = np.searchsorted(text, np.arange(len(sizes) + 1), side="left")
    runs[:, 0] -= offsets[text]
    return runs, ends


def repeat_tail(n: int, h: int) -> np.ndarray | None:
    """Where each of a text's ``n`` words is taken from if its tail is to repeat: from word a on, the p words at a
    over and over, with a and p drawn from the unsigned crc32 ``h`` of its id.  None: the text stays as it is."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    source = np.arange(n)
    source[a:] = a + (source[a:] - a) % p
    return source


def _texts(batch: pa.RecordBatch, planted: bool) -> pa.RecordBatch:
    column = batch.column(1)
    _, x, offsets = split_words(column)
    sources: dict[int, np.ndarray] = {}
    if planted:
        for k, key in enumerate(batch.column(0).to_pylist()):
            n = int(offsets[k + 1] - offsets[k])
            source = None if key is None else repeat_tail(n, zlib.crc32(str(key).encode()))
            if source is not None:
                sources[k] = source
                x[offsets[k]:offsets[k + 1]] = x[offsets[k] + source]
    runs, ends = find_runs(x, offsets)
    collapsed = []
    for k, text in enumerate(column):
        words = text.as_py().encode().split()  # the same characters part words here
        if k in sources:
            words = [words[i] for i in sources[k]]
        own = runs[ends[k]:ends[k + 1]]
        if len(own):
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, own[:, 0] + own[:, 2], 1)
            np.add.at(steps, own[:, 0] + own[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
        collapsed.append(b" ".join(words).decode())
    fields = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), fields), pa.array(collapsed, pa.string())],
        names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, planted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period in words; by start, then period) and ``collapsed`` of each row.

    ``collapsed`` is the text's words joined by one space, without those that a
    run holds after its first period.  ``planted`` first makes the tails of a
    tenth of the texts periodic (see ``repeat_tail``): known runs to find.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            yield _texts(batch, planted)

    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: number of runs, the run of greatest length / period (exact; ties: smallest start, then period) and
    SHA-256 of the runs and of the collapsed text; without runs start, length, period and exponent are null."""
    better = lambda a, b: a["length"] * b["period"] < b["length"] * a["period"]
    found = periodic_runs(docs, planted=True).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a)).alias("_best"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
               F.concat(r["period"].cast("string"), F.lit("\n"))))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    one = F.col("_best")
    return found.select("doc_id", "n_runs", one["start"].alias("start"), one["length"].alias("length"), one["period"].alias("period"),
                        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
