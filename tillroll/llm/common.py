"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import materialize

__all__ = ["bound_batches", "byte_slices", "drop_written", "find_package", "hash_strings", "materialize", "mix",
           "powers", "read_table", "segment_sums", "split_words", "text_bytes", "texts"]

#: Bytes of text that one step of a Python task handles at a time; one document is never cut.
SLICE_BYTES = 2 << 20
#: The same where a step keeps numbers of every word or shingle, which take many times the bytes of the text.
WORD_SLICE_BYTES = 1 << 19
#: Bytes of a batch between the JVM and a worker (one row at least).
BATCH_BYTES = 4 << 20
_BATCH_CONF, _BATCH_DEFAULTS = "spark.sql.execution.arrow.maxBytesPerBatch", ("256MB", "268435456", "268435456b")
_COLLECTOR = gc.get_threshold()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def find_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver did.

    On a cluster it is installed on the executors or shipped with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, paths)))


def bound_batches(spark: SparkSession) -> None:
    """Bounds what Spark sends to a worker at a time, unless the session says otherwise: a batch stands in the JVM
    and again in the worker, and the default of 256 MB is large where several tasks share an executor."""
    if spark.conf.get(_BATCH_CONF) in _BATCH_DEFAULTS:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_written(df: DataFrame) -> None:
    """Deletes a table that ``materialize`` wrote, once everything that reads it has been written itself."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` only (other columns cannot clash); a null text is the empty text."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def give_back() -> None:
    """Returns freed memory to the system: workers wait for their next task between stages, and several share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


#: Tables that a worker keeps between the tasks of one operator.
worker_tables: list[dict] = []


def forget() -> None:
    """Empties the tables that operators keep in a worker, and undoes what they set for its garbage collector."""
    for table in worker_tables:
        table.clear()
    if gc.get_threshold() != _COLLECTOR:
        gc.unfreeze()
        gc.set_threshold(*_COLLECTOR)


def byte_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES,
                keep_tables: bool = False) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into slices of at most ``limit`` text bytes (one row at least).

    A task of another operator empties the tables that the worker has kept.
    """
    if not keep_tables:
        forget()
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and each row's offset in them (one more at the end)."""
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def split_words(column: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a string column without nulls.

    Returns the distinct words, each word's index into them in text order, and
    each row's offset in that sequence (one more at the end).  ``lower`` turns
    A-Z, and nothing else, into lower case.
    """
    column = column.cast(pa.large_string())
    if lower:  # by a table: the library's own function loses the text of sliced columns
        raw, offsets = text_bytes(column)
        column = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets), pa.py_buffer(_LOWER[raw]))
    parts = pc.ascii_split_whitespace(column)
    flat, parents = parts.flatten(), pc.list_parent_indices(parts)
    full = pc.greater(pc.binary_length(flat), 0)
    flat, parents = flat.filter(full), parents.filter(full).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    counts = np.bincount(parents, minlength=len(column))
    return (coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets, empty segments included."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


_BASE = 0x9E3779B97F4A7C15
_made: list[np.ndarray] = []
#: 2 ** 21 numbers, twice: 32 MB; a slice of texts needs no more unless one text does.
KEPT_POWERS = 1 << 21


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the rolling hash's base and of its inverse, modulo 2**64; up to ``KEPT_POWERS`` are
    kept for the next call, the powers for a longer text only while it is worked on."""
    if not _made or len(_made[0]) < n:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(max(n, 1 << 16), base, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x, out=x))
        if n > KEPT_POWERS:
            return made[0], made[1]
        _made[:] = made
    return _made[0][:n], _made[1][:n]


def hash_strings(column: pa.Array) -> np.ndarray:
    """64-bit hash of each string of a column without nulls: a polynomial in its bytes, mixed."""
    raw, off = text_bytes(column)
    up, down = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    begin, end = off[:-1], off[1:]
    return mix((total[end] - total[begin]) * down[begin] + mix((end - begin).astype(np.uint64)))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
