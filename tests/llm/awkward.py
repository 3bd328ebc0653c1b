"""Small inputs with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = ["spans", "n_words", "row", "start", "end", "n", "ids", "part", "queue", "redacted", "key", "h", "fail_bits",
            "text_key", "component_id", "n_tokens", "score", "_1"]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def rows(extra=(), seed=7):
    rng = random.Random(seed)
    long = words(rng, 9000, 3000)
    made = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t ", "en", "a", 4), (3, "one", "en", "a", 3),
            (4, long, "en", "a", len(long)), (5, long, "en", "b", len(long)), (None, "no id " * 30, "en", None, 180),
            (7, "the same line\n" * 12, "de", "b", 168), (8, "a b c d e a b c d e", "fr", "b", 19),
            (9, "ÄÖÜ ß 𝔘𝔫𝔦 é   nbsp em \x1c fs", "de", "c", 30), (10, "x" * 5000, "en", "c", 5000)]
    made += [(20 + k, words(rng, rng.randrange(1, 400)), "en", rng.choice("abbb"), 1) for k in range(25)]
    made += [made[15], made[15], made[0]]
    return made + list(extra)


def docs(spark, extra=(), clash=True):
    df = spark.createDataFrame(rows(extra), SCHEMA).repartition(3)
    if clash:
        df = df.withColumns({c: F.lit(None if k % 2 else f"clash {c}").cast("string") for k, c in enumerate(CLASHING)})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
