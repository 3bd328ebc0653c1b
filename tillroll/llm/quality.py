"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document.  The ledger keeps the measured
quantities and one ``fail_bits`` long in which bit ``k`` says that rule ``k``
failed.  A policy is a named, versioned set of bits: applying it is one bitwise
AND, and the ablation of any policy is an aggregation over the distinct masks,
so neither ever reads a text again.

Defined results: a null or empty text has no words (all measurements 0, the
rule ``few_words`` fails); documents may repeat, each row is judged alone;
other columns of the input are ignored by the ledger and kept by the stage, whatever their names;
very long texts are measured whole; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import WORD_SLICE_BYTES, byte_slices, mix, segment_sums, split_words, text_bytes, texts

#: Symbols whose density marks markup or noise (fixed by the contract of the query).
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
#: The text column inside the measuring task.
TEXT = "_quality_text"
_MULTIPLIERS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words"]

#: Rule name -> condition under which the rule FAILS.  The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbol_density": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "few_letters": "100 * n_alpha_words < 50 * n_words",
    "many_duplicate_lines": "n_dup_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines",
}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document is rejected if any chosen rule fails."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
#: Version 1 also rejected short texts for one or two repeated lines, such as a licence.
EVERY = Policy("default", 1, tuple(r for r in RULES if r != "many_duplicate_lines"))
#: Version 2 left repeated lines out altogether.
LENIENT = Policy("default", 2, tuple(r for r in EVERY.rules if r != "duplicate_lines"))
#: Version 3 rejects them where the text repeats at least five: pages of menu lines go, short texts are spared.
DEFAULT = Policy("default", 3, (*LENIENT.rules, "many_duplicate_lines"))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    for batch in byte_slices(batches, TEXT, WORD_SLICE_BYTES):
        text = batch.column(batch.schema.get_field_index(TEXT))
        words, idx, off = split_words(text)
        n = np.diff(off)
        doc = np.repeat(np.arange(len(text)), n)
        chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        alpha = pc.match_substring_regex(words, r"\pL").to_numpy(zero_copy_only=False)
        raw, at = text_bytes(text)

        lines = pc.split_pattern(text.cast(pa.large_string()), "\n")
        line, owner = lines.flatten(), pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
        full = pc.match_substring_regex(line, r"[^ \t\n\v\f\r]").to_numpy(zero_copy_only=False)
        code = line.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code, owner = code[full], owner[full]
        distinct = np.unique(owner * (len(line) + 1) + code) // (len(line) + 1)
        n_lines = np.bincount(owner, minlength=len(text))

        repeated = np.zeros(len(idx) + 1, np.int64)
        start = np.flatnonzero(np.arange(len(idx)) + WINDOW <= off[1:][doc])
        if len(start):
            value = mix(idx.astype(np.uint64) + np.uint64(1))
            key = mix(doc[start].astype(np.uint64))
            for k in range(WINDOW):
                key += value[start + k] * _MULTIPLIERS[k]
            order = np.argsort(key)
            same = np.flatnonzero(key[order][1:] == key[order][:-1])
            twice = start[order[np.union1d(same, same + 1)]]
            np.add.at(repeated, twice, 1)
            np.add.at(repeated, twice + WINDOW, -1)
        n_symbols = np.diff(np.searchsorted(np.flatnonzero(symbol[raw]), at))
        values = (n, segment_sums(chars[idx], off), n_symbols, n_lines,
                  n_lines - np.bincount(distinct, minlength=len(text)),
                  segment_sums(np.cumsum(repeated[:-1]) > 0, off), segment_sums(alpha[idx], off))
        kept = [k for k, name in enumerate(batch.schema.names) if name != TEXT]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in kept), *(pa.array(x.astype(np.int64)) for x in values)],
            names=[*(batch.schema.names[k] for k in kept), *MEASURES])


def _fail_bits(rows: DataFrame) -> DataFrame:
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())),
               F.lit(0))
    return rows.withColumn("fail_bits", bits.cast("long"))


def _measured(rows: DataFrame) -> DataFrame:
    """``rows`` with the measurements in place of their column ``TEXT``."""
    fields = [f for f in rows.schema.fields if f.name != TEXT]
    fields += [T.StructField(m, T.LongType()) for m in MEASURES]
    return _fail_bits(rows.mapInArrow(_measure, T.StructType(fields)))


def rule_ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements, and ``fail_bits`` for each row of ``docs``."""
    return _measured(texts(docs).withColumnRenamed("text", TEXT))


def rejected(policy: Policy) -> Column:
    """Whether a ledger row fails any rule of ``policy``."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policies(ledger: DataFrame, policies: list[Policy]) -> DataFrame:
    """Adds ``rejected_<name>_v<version>`` for each policy."""
    return ledger.withColumns({f"rejected_{p.name}_v{p.version}": rejected(p) for p in policies})


def ablations(ledger: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of ``policy`` does: documents that fail it, documents that only it
    rejects (kept if it were dropped), and documents kept under the policy without it."""
    masks = (ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits"))
             .agg(F.count("*").alias("docs")))
    rules = [(r, 1 << list(RULES).index(r)) for r in policy.rules]
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(b).cast("long").alias("bit")) for r, b in rules)))
    return (masks.select("bits", "docs", each.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("docs")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("docs")).otherwise(0)).alias("only_this"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.lit(policy.mask) - F.col("r.bit")) == 0, F.col("docs")).otherwise(0))
        .alias("kept_without")))


def mask_summary(ledger: DataFrame) -> DataFrame:
    """One row: the rules that any document fails, that every document fails, and the parity of all masks."""
    return ledger.agg(F.bit_or("fail_bits").alias("any_failed"), F.bit_and("fail_bits").alias("all_failed"),
                      F.bit_xor("fail_bits").alias("parity"))


def quality(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The digest of the query: measurements, base verdict, and the verdict of ``policy``."""
    return rule_ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rejected(BASE).alias("base_failed"), (~(rejected(BASE) | rejected(policy))).alias("kept"), "fail_bits")


def keep_good(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """``docs`` (all columns, as they are) without the rows that the base rules or ``policy`` reject.

    Only the text goes to the workers and only the measurements come back; the
    rows wait for them in Spark, so there is no join, and repeated rows or null
    ids need no care.
    """
    @F.arrow_udf("array<long>")
    def measures(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in parts:
            made = [m for m in _measure(iter([pa.RecordBatch.from_arrays([text], names=[TEXT])]))]
            rows = np.concatenate([np.stack([m.column(c).to_numpy() for c in MEASURES], axis=1) for m in made]
                                  or [np.zeros((0, len(MEASURES)), np.int64)])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(MEASURES)), pa.array(rows.ravel()))

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    with_all = docs.select(row, measures(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_m"))
    ledger = _fail_bits(with_all.select("_row", *(F.col("_m")[k].alias(m) for k, m in enumerate(MEASURES))))
    return ledger.where(~(rejected(BASE) | rejected(policy))).select("_row.*")
