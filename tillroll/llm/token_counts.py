"""Token counts of whole texts, huge ones by overlap resynchronisation.

A huge text is encoded in overlapping chunks with offsets, and the chunks are
spliced at *stable boundaries*: positions between a character that is no white
space and one that is.  The tokenizer's pre-split never puts such a pair into
one piece and merges never cross pieces, so the encoding of the whole text
has a boundary there and its two sides are independent.  A chunk's tokens are
trusted from its first stable boundary (or the text's start) to its last one
(or the text's end).  Two neighbours are spliced at the last stable boundary of their overlap at
which both encodings end a token and behind which they agree up to the next
one; where an overlap has none (a long run without white space, or only white
space) it is widened, twice as far each time, up to the text's end.

Shorter texts fall apart at the same boundaries into pieces ("word with the
white space before it"); a bounded per-worker table holds the count of each
piece seen, so a common word is encoded once.

Strings of special tokens hold no white space, so no boundary lies inside one,
and they are handled as the library does by default.  Defined results: a null
or empty text has no tokens; repeated rows are counted alone.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_slices, texts

MODEL_LIMIT = 512
#: Characters of a chunk and of its first overlap; texts above one chunk are spliced.
CHUNK, OVERLAP = 1 << 15, 256
#: Pieces a worker remembers, and the longest one it does.
TABLE_SIZE, TABLE_CHARS = 300_000, 64

_PIECE = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
#: White space by any definition besides the ASCII one: texts with it are encoded by chunks.
_ODD_SPACE = re.compile(r"[^\S\t-\r ]")
_STABLE = re.compile(r"(?<=\S)(?=[\t-\r ])")
_loaded: dict[str, tuple] = {}


def tokenizer(path: str):
    """The tokenizer at ``path`` and the worker's table of piece counts."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        _loaded[path] = model, {}
    return _loaded[path]


def _encode(model, text: str, at: int) -> tuple[list[tuple[int, int, int]], int]:
    """Tokens (start, end, id) with offsets in the whole text, for the chunk ``text`` that begins at ``at``."""
    e = model.encode(text, add_special_tokens=False)
    return [(at + a, at + b, i) for (a, b), i in zip(e.offsets, e.ids)], at + len(text)


def splice_ids(model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of the whole text from overlapping chunks; equal to encoding it at once."""
    ids: list[int] = []
    begin = 0  # everything before it is in ``ids``; the text's start or a stable boundary
    while begin < len(text):
        end = min(len(text), begin + chunk)
        wide = overlap
        while True:
            if end == len(text):
                ids += model.encode(text[begin:], add_special_tokens=False).ids
                return ids
            reach = min(len(text), end + wide)
            left, _ = _encode(model, text[begin:reach], begin)
            right, _ = _encode(model, text[max(begin, end - wide):reach], max(begin, end - wide))
            at = _common_boundary(text, left, right, max(begin, end - wide), reach)
            if at is not None:
                ids += [i for a, b, i in left if b <= at]
                begin = at
                break
            wide *= 2
            if reach == len(text):
                end = reach


def _common_boundary(text: str, left: list, right: list, low: int, high: int) -> int | None:
    """The last stable boundary in (low, high) where both sides end a token and agree up to the next stable one."""
    stable = [m.start() for m in _STABLE.finditer(text, low + 1, high) if low < m.start() < high]
    if len(stable) < 2:
        return None
    starts_left = {a for a, _, _ in left}
    starts_right = {a for a, _, _ in right}
    for here, after in reversed(list(zip(stable, stable[1:]))):
        if here in starts_left and here in starts_right:
            one = [t for t in left if here <= t[0] and t[1] <= after]
            if one and one == [t for t in right if here <= t[0] and t[1] <= after]:
                return here
    return None


def count_texts(rows: list[str], path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Number of tokens of each text."""
    model, table = tokenizer(path)
    if len(table) > TABLE_SIZE:
        table.clear()
    split: list[list[str] | None] = []
    unknown: set[str] = set()
    for text in rows:
        pieces = None
        if len(text) <= chunk and not _ODD_SPACE.search(text):
            pieces = _PIECE.findall(text)
            unknown.update(pieces)
        split.append(pieces)
    unknown.difference_update(table)
    new = list(unknown)
    counts = dict(zip(new, (len(e.ids) for e in model.encode_batch_fast(new, add_special_tokens=False))))
    table.update(counts)
    out = [sum(map(table.__getitem__, pieces)) if pieces is not None else len(splice_ids(model, text, chunk, overlap))
           for text, pieces in zip(rows, split)]
    for piece in new:
        if len(piece) > TABLE_CHARS:
            del table[piece]
    return out


def count_tokens(docs: DataFrame, path: str, limit: int = MODEL_LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` of each row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches):
            rows = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count_texts(rows, path, chunk, overlap), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = texts(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
