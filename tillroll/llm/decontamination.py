"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Every ``SEED``-gram of every benchmark item is counted in the whole corpus.
2. An n-gram is rare if what it can propose in the whole corpus, its count times the places at which items have
   it, is at most ``RARE``.  Rare n-grams are seeds.  A frequent one is a seed only together with the words after
   it, ``LONG`` words in all (or the whole of a shorter item), so phrases that half the benchmark begins with cost
   nothing where a document goes on differently.  What is left, items that share only frequent n-grams with a
   document, is met exactly: each such item is proposed whose words found anywhere in the document could reach the
   score (``_rest``).  So any ``SEED`` words in a row propose every pair that can be reported, and no number of
   places or copies drops one.
3. Seeds found in a document join its passages to items; hits of an item on near
   diagonals form one candidate passage.  A candidate goes on only if its words that the item has
   could reach the score in any order (``bound``): no pair is lost by that.
4. Each candidate is aligned with the item word by word (match +2, mismatch -1, gap -1,
   local).  ``score`` is the best alignment's score as a share of the item's own, 1.0 for a
   whole copy.  A pair is reported from ``THRESHOLD`` on if it scores as much as ``LEAST`` matching words
   (of items too short for that: ``SHORT`` of the item's own score), and from the score of ``WORDS``
   matching words on, whatever share of the item that is.

The benchmark is a stated query set: it is read in blocks of at most about
``BLOCK_BYTES``, and only one block at a time is sent to the workers, whatever its
size in all.  Documents never leave their partition.

Words are split at white space of any alphabet (no-break spaces too), alike in items and documents, lower-cased,
without punctuation at their ends.
Defined results: a null or empty text or item matches nothing, neither does an item of
fewer than ``SEED`` words; repeated documents are judged alone, repeated items
(same id and text) once; other columns are ignored, whatever their names; very long texts are
read whole; of passages with equal scores the first is reported; an empty table, of documents or items, gives no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import WORD_SLICE_BYTES, byte_slices, split_words, texts

SEED, LONG = 3, 6
#: Candidates that a rare n-gram can propose in the whole corpus.
RARE = 10_000
THRESHOLD = 0.4
#: What a passage must score at least, in matching words, and as a share of an item too short for that.
LEAST, SHORT = 7, 0.8
#: A passage that scores as much as so many matching words is reported however long its item is.
WORDS = 13
BLOCK_BYTES = 4 << 20
#: Cells of the alignment matrices that are computed at a time.
CELLS = 1 << 21
MATCH, OTHER, GAP = 2, -1, 1
PUNCTUATION = " \t!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’…–—¿¡"


def normal(word: str) -> str:
    return word.strip(PUNCTUATION).lower()


def plain(text: str) -> list[str]:
    return [w for w in map(normal, text.split()) if w]


def needed(words: int, threshold: float) -> float:
    """The score from which a passage of an item of so many words is reported."""
    least = min(MATCH * LEAST, SHORT * MATCH * words)
    return min(max(threshold * MATCH * words, least), MATCH * WORDS)


class Places(NamedTuple):
    """Sorted n-grams, and for each the places (item, position) at which it stands: ``where[first[k]:first[k + 1]]``."""

    grams: np.ndarray
    first: np.ndarray
    where: np.ndarray


class Index(NamedTuple):
    """One block of the benchmark."""

    ids: list
    #: Word -> number from 1; 0 stands for every word that no item has.
    vocabulary: dict[str, int]
    #: Per item its words' numbers.
    items: list[np.ndarray]
    #: The n-grams of ``SEED`` words.
    seeds: Places
    #: Which of these are frequent, and the longer n-grams that stand for them by their number of words.
    frequent: np.ndarray
    longer: dict[int, Places]


def _grams(numbers: np.ndarray, base: int, size: int = SEED, at: np.ndarray | None = None) -> np.ndarray:
    """Key of the n-gram at each position (or at those of ``at``); 0 where it holds a word that no item has.

    Keys of more than three words may wrap and meet: that proposes a pair more, which the alignment refuses.
    """
    if at is None:
        at = np.arange(max(0, len(numbers) - size + 1))
    key, known = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for k in range(size):
        key = key * base + numbers[at + k]
        known &= numbers[at + k] > 0
    return np.where(known, np.where(key == 0, 1, key), 0)


def build_index(rows: list[tuple]) -> Index:
    """The index of all n-grams of ``rows`` (item id, text), none of them frequent yet."""
    vocabulary: dict[str, int] = {}
    items = []
    for _, text in rows:
        items.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in plain(text or "")], np.int64))
    keys = [_grams(x, len(vocabulary) + 1) for x in items]
    item = np.repeat(np.arange(len(items)), [len(k) for k in keys])
    place = np.concatenate([np.arange(len(k)) for k in keys] or [np.zeros(0, np.int64)])
    seeds = _places(np.concatenate(keys or [np.zeros(0, np.int64)]), item, place)
    return Index([i for i, _ in rows], vocabulary, items, seeds, np.zeros(len(seeds.grams), bool), {})


def _places(keys, item, place) -> Places:
    order = np.argsort(keys, kind="stable")
    grams, first = np.unique(keys[order], return_index=True)
    return Places(grams, np.append(first, len(order)).astype(np.int64), np.stack([item, place], 1)[order].astype(np.int64))


def choose_seeds(index: Index, counts: np.ndarray, rare: int = RARE) -> Index:
    """The index of the seeds, from each n-gram's count in the corpus; what the corpus does not hold goes."""
    places = np.diff(index.seeds.first)
    gram = np.repeat(np.arange(len(places)), places)
    live = counts[gram] > 0
    item, place = index.seeds.where[live].T
    seeds = _places(index.seeds.grams[gram[live]], item, place)
    frequent = (counts * places)[counts > 0] > rare
    item, place = seeds.where[np.repeat(frequent, np.diff(seeds.first))].T
    words = np.array([len(x) for x in index.items], np.int64)[item]
    sizes = np.minimum(words, LONG)
    longer = {}
    for size in np.unique(sizes).tolist():
        own = (sizes == size) & (place + size <= words)
        keys = [index.items[i][p:p + size] for i, p in zip(item[own].tolist(), place[own].tolist())]
        table = np.array(keys, np.int64).reshape(-1, size)
        longer[size] = _places(_grams(table.ravel(), len(index.vocabulary) + 1, size, size * np.arange(len(table))),
                               item[own], place[own])
    return Index(index.ids, index.vocabulary, index.items, seeds, frequent, longer)


def _word_numbers(words: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each word's parts, and how many parts it has: ASCII words all at once, as ``plain`` has them."""
    simple = pc.fill_null(pc.match_substring_regex(words, "^[!-~]+$"), False)
    flags = simple.to_numpy(zero_copy_only=False)
    some = pc.ascii_lower(pc.ascii_trim(words.filter(simple), characters="".join(c for c in PUNCTUATION if c.isascii())))
    known = pa.array(vocabulary, some.type)  # numbered from 1 in this order
    look = pc.fill_null(pc.index_in(some, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    one = pc.binary_length(some).to_numpy(zero_copy_only=False) > 0
    get = vocabulary.get
    parts = [plain(w) for w in words.filter(pc.invert(simple)).to_pylist()]  # more than one at white space beyond ASCII's
    size = np.zeros(len(words), np.int64)
    size[flags] = one
    size[~flags] = np.fromiter(map(len, parts), np.int64, len(parts))
    number, first = np.zeros(int(size.sum()), np.int64), np.cumsum(size) - size
    number[first[flags][one]] = look[one]
    at = _spread(first[~flags], size[~flags])
    number[at] = np.fromiter((get(w, 0) for p in parts for w in p), np.int64, len(at))
    return number, size


def _numbers(text: pa.Array, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """The known words' numbers of all rows in a row, and each row's offset; words of punctuation only are left out."""
    words, idx, off = split_words(text)
    number, size = _word_numbers(words, index.vocabulary)
    numbers = number[_spread((np.cumsum(size) - size)[idx], size[idx])]
    return numbers, np.concatenate([[0], np.cumsum(size[idx])])[off]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[k], first[k] + 1, ...`` (``size[k]`` of them) for each k, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _look_up(at: np.ndarray, keys: np.ndarray, places: Places) -> tuple[np.ndarray, np.ndarray]:
    """Those positions of ``at`` whose key stands in ``places``, and its number there."""
    if not len(at) or not len(places.grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = np.minimum(np.searchsorted(places.grams, keys), len(places.grams) - 1)
    same = places.grams[gram] == keys
    return at[same], gram[same]


def _hits(numbers: np.ndarray, off: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which an n-gram of ``SEED`` words of the index stands, and its number."""
    keys = _grams(numbers, len(index.vocabulary) + 1)
    at = np.flatnonzero(keys)
    at = at[at + SEED <= off[np.searchsorted(off, at, side="right")]] if len(at) else at  # not across rows
    return _look_up(at, keys[at], index.seeds)


def _proposed(numbers: np.ndarray, off: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of seeds, and the item and its position that each proposes."""
    at, gram = _hits(numbers, off, index)
    often = index.frequent[gram]
    begin, ends = at[often], off[np.searchsorted(off, at[often], side="right")]
    tables = [(at[~often], gram[~often], index.seeds)]
    for size, places in index.longer.items():
        here = begin[begin + size <= ends]
        tables.append((*_look_up(here, _grams(numbers, len(index.vocabulary) + 1, size, here), places), places))
    found = []
    for at, gram, places in tables:
        copies = places.first[gram + 1] - places.first[gram]
        found.append((np.repeat(at, copies), *places.where[_spread(places.first[gram], copies)].T))
    return tuple(np.concatenate(x) for x in zip(*found))


def _rest(numbers: np.ndarray, off: np.ndarray, index: Index, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_proposed``, by frequent n-grams alone: all items that have one, but for those too few of whose words stand
    in the row for the score, in whatever order.  A row at a time, so no more than the block's words are held."""
    at, gram = _hits(numbers, off, index)
    often = index.frequent[gram]
    at, gram = at[often], gram[often]
    found = [(np.zeros(0, np.int64),) * 3]
    if not len(at):
        return found[0]
    size = np.array([len(x) for x in index.items], np.int64)
    words, start = np.concatenate(index.items), np.cumsum(size) - size
    least = np.array([needed(n, threshold) for n in size.tolist()])
    row = np.searchsorted(off, at, side="right") - 1
    ends = np.append(np.flatnonzero(np.diff(row)) + 1, len(row)).tolist()
    there, kept = np.zeros(len(index.vocabulary) + 1, bool), np.zeros(len(size), bool)
    for a, b in zip([0, *ends], ends):
        text = numbers[off[row[a]]:off[row[a] + 1]]
        there[text] = True
        there[0] = False
        grams, own = np.unique(gram[a:b], return_inverse=True)
        copies = index.seeds.first[grams + 1] - index.seeds.first[grams]
        item, place = index.seeds.where[_spread(index.seeds.first[grams], copies)].T
        some = np.unique(item)
        count = np.add.reduceat(there[words[_spread(start[some], size[some])]].astype(np.int64),
                                np.cumsum(size[some]) - size[some])
        kept[some[MATCH * count >= least[some]]] = True
        stays = kept[item]
        if stays.any():
            left = np.bincount(np.repeat(np.arange(len(grams)), copies)[stays], minlength=len(grams))
            item, place = item[stays], place[stays]
            each = left[own]
            from_ = _spread((np.cumsum(left) - left)[own], each)
            found.append((np.repeat(at[a:b], each), item[from_], place[from_]))
        there[text], kept[some] = False, False
    return tuple(np.concatenate(x) for x in zip(*found))


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each row of ``items`` with the same row of ``passages``: score, and the last word of
    either side.  Rows are padded: items with -1, passages with -2.

    A row of the matrix needs the gap along the passage as a running maximum,
    so all candidates advance by one word of their item at a time.
    """
    n, width = passages.shape
    slope = GAP * np.arange(width, dtype=np.int32)
    above = np.zeros((n, width + 1), np.int32)
    best, end_item, end_passage = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    rows = np.arange(n)
    for i in range(items.shape[1]):
        word = items[:, i:i + 1]
        step = np.where((passages == word) & (word > 0), MATCH, OTHER).astype(np.int32)
        cell = np.maximum(above[:, :-1] + step, above[:, 1:] - GAP)
        np.maximum(cell, 0, out=cell)
        cell = np.maximum.accumulate(cell + slope, axis=1) - slope
        above[:, 1:] = cell
        at = np.argmax(cell, axis=1)
        top = cell[rows, at]
        better = top > best
        best = np.where(better, top, best)
        end_item, end_passage = np.where(better, i, end_item), np.where(better, at, end_passage)
    return best, end_item, end_passage


def bound(items: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """What the best local alignment of each row of ``items`` with the same row of ``passages`` cannot exceed.

    Within an alignment each word of the passage matches a word of the item or costs one at least.
    """
    base = int(items.max()) + 1
    own = np.unique((np.arange(len(items))[:, None] * base + items)[items > 0])
    step = np.full(passages.shape, max(OTHER, -GAP))
    row, at = np.nonzero((passages > 0) & (passages < base))
    key = row * base + passages[row, at]
    same = own[np.minimum(np.searchsorted(own, key), len(own) - 1)] == key
    step[row[same], at[same]] = MATCH
    total = np.cumsum(step, axis=1)
    before = np.minimum.accumulate(np.minimum(total - step, 0), axis=1)
    return (total - before).max(axis=1)


def _pad(parts: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(parts), max(map(len, parts))), fill, np.int64)
    for k, p in enumerate(parts):
        out[k, :len(p)] = p
    return out


def find(text: pa.Array, index: Index, threshold: float = THRESHOLD) -> list[tuple]:
    """(row, item number, score, first word, word after the last) of the reported pairs, the best passage of each pair."""
    numbers, off = _numbers(text, index)
    proposed, rest = _proposed(numbers, off, index), _rest(numbers, off, index, threshold)
    at, item, place = (np.concatenate(x) for x in zip(proposed, rest))
    if not len(at):
        return []
    row = np.searchsorted(off, at, side="right") - 1
    diagonal = at - place
    size = np.array([len(x) for x in index.items], np.int64)[item]
    slack = size // 2 + SEED
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal, size, slack = (x[order] for x in (row, item, diagonal, size, slack))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(row)) - 1
    low = np.maximum(off[row[begin]], diagonal[begin] - slack[begin])
    high = np.minimum(off[row[begin] + 1], diagonal[last] + size[begin] + slack[begin])
    row, item, size = row[begin], item[begin], size[begin]
    found: dict[tuple[int, int], tuple] = {}
    order = np.lexsort((size, high - low))  # alike sizes together: less padding
    cells, chunk = 0, []
    for n, k in enumerate(order.tolist()):
        chunk.append(k)
        cells = len(chunk) * int(high[k] - low[k])
        if cells < CELLS // 16 and n + 1 < len(order):
            continue
        items, passages = [index.items[item[c]] for c in chunk], [numbers[low[c]:high[c]] for c in chunk]
        most = bound(_pad(items, -1), _pad(passages, -2))
        kept = [j for j in range(len(chunk)) if most[j] >= needed(len(items[j]), threshold)]
        chunk, items, passages = ([x[j] for j in kept] for x in (chunk, items, passages))
        if not chunk:
            continue
        best, end_item, end = align(_pad(items, -1), _pad(passages, -2))
        good = [j for j in range(len(chunk)) if best[j] >= needed(len(items[j]), threshold)]
        if good:  # backwards from the end of the best alignment to its first word
            _, _, back = align(_pad([items[j][end_item[j]::-1] for j in good], -1),
                               _pad([passages[j][end[j]::-1] for j in good], -2))
        for j, b in zip(good, back.tolist() if good else ()):
            c = chunk[j]
            pair = int(row[c]), int(item[c])
            start = int(low[c] - off[row[c]] + end[j] - b)
            this = best[j] / (MATCH * len(items[j])), -start, int(low[c] - off[row[c]] + end[j] + 1)
            found[pair] = max(found.get(pair, this), this)
        chunk = []
    return [(r, i, float(score), -start, end) for (r, i), (score, start, end) in sorted(found.items())]


def blocks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, rare: int = RARE) -> Iterator[Index]:
    """The seeds of one block of items after the other, chosen by their counts in all of ``docs``."""
    items = texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id").where("text <> ''").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n)))
    for k in range(n):
        rows = sorted(((r[0], r[1]) for r in items.where(block == k).collect()), key=lambda r: (str(r[0]), r[1]))
        index = build_index(rows)

        def count(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(index.seeds.grams), np.int64)
            for batch in byte_slices(batches, limit=WORD_SLICE_BYTES):
                total += np.bincount(_hits(*_numbers(batch.column(0), index), index)[1], minlength=len(total))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

        counts = np.zeros(len(index.seeds.grams), np.int64)
        counted = texts(docs).select("text").mapInArrow(count, "gram long, n long")
        for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # at most the block's n-grams
            counts[r["gram"]] = r["n"]
        yield choose_seeds(index, counts, rare)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 block_bytes: int = BLOCK_BYTES, rare: int = RARE) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word`` of every reported pair."""
    rows = texts(docs)
    kind = benchmark.schema["item_id"]
    schema = T.StructType([rows.schema["doc_id"], T.StructField("item_id", kind.dataType),
                           T.StructField("score", T.DoubleType()), T.StructField("start_word", T.LongType()),
                           T.StructField("end_word", T.LongType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for index in blocks(docs, benchmark, block_bytes, rare):
        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in byte_slices(batches, limit=WORD_SLICE_BYTES):
                pairs = find(batch.column(1), index, threshold)
                row, item, score, start, end = zip(*pairs) if pairs else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())),
                     pa.array([index.ids[i] for i in item], pa.int64() if kind.dataType == T.LongType() else None),
                     pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    names=schema.names)

        out = out.unionByName(rows.mapInArrow(search, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (all columns) without the rows that hold a passage of the benchmark."""
    out = docs
    for index in blocks(docs, benchmark, block_bytes):
        @F.arrow_udf("boolean")
        def holds(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for text in parts:
                flags, at = np.zeros(len(text), bool), 0
                for piece in byte_slices(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), limit=WORD_SLICE_BYTES):
                    flags[[at + r for r, *_ in find(piece.column(0), index, threshold)]] = True
                    at += piece.num_rows
                yield pa.array(flags)

        out = out.where(~holds(F.coalesce(F.col("text"), F.lit(""))))
    return out
