"""Secret scan with multipart credential linking, in DataFrame functions only.

A credential has three parts: an *identifier* (who), a *secret* (with what) and
an *endpoint* (where).  Strong candidates (the base kinds ``assign``,
``access``, ``hex``) are always reported.  Weak ones are reported only where
complementary parts stand in the same scope, i.e. begin within ``SCOPE`` code
points of them in the same text:

* ``key40`` (a bare 40-character mixed token): with an identifier;
* ``ident`` (a named user, client or key id): with a secret;
* ``endpoint`` (a URL or named host): with an identifier and a secret.

Plan: one scan takes, per kind, the lengths of the matches and of the text
between them (``regexp_extract_all`` and ``split`` with the same expression), so
offsets are running sums and no text leaves the scan.  Those short rows are
written once; parts are exploded from them, and an interval join on
(row, bucket of ``SCOPE`` code points) with a distance condition links them.
Matches of a kind do not overlap, so a bucket holds a bounded number of parts
and the join is linear in the text even for a document full of keys.

Defined results: a null or empty text has no spans; rows are numbered, so
repeated rows and null ids are judged alone; offsets are code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, texts

SCOPE = 256


@dataclass(frozen=True)
class Kind:
    name: str
    role: str
    pattern: str
    #: Cheap test that holds wherever ``pattern`` can match (``low``: the lower-cased text).
    hint: str
    strong: bool = True
    #: A match counts only if this group has so many characters.
    group: int = 0
    least: int = 0


KINDS = (
    Kind("assign", "secret",
         r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         "contains(low, 'passw') or contains(low, 'secret') or contains(low, 'token')"
         " or contains(low, 'apikey') or contains(low, 'api_key')", group=2, least=12),
    Kind("access", "identifier", r"AKIA[A-Z0-9]+", "contains(text, 'AKIA')", least=18),
    Kind("hex", "secret", r"[0-9a-f]{16,}", "true", least=16),
    Kind("key40", "secret", r"(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])"
         r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", r"text rlike '[A-Za-z0-9+/]{40}'", strong=False),
    Kind("ident", "identifier",
         r"""(?i)(access_?key_?id|client_?id|key_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""",
         "contains(low, 'user') or contains(low, 'login') or contains(low, 'client') or contains(low, 'keyid')"
         " or contains(low, 'key_id')", strong=False, group=2, least=3),
    Kind("endpoint", "endpoint",
         r"""(?i)(https?://|(host|endpoint|server)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9-](:[0-9]+)?""",
         "contains(low, 'http') or contains(low, 'host') or contains(low, 'endpoint') or contains(low, 'server')",
         strong=False),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.strong)
#: role of a weak candidate -> roles that have to stand in its scope
NEEDS = {"secret": ("identifier",), "identifier": ("secret",), "endpoint": ("identifier", "secret")}


def _matches(kind: Kind) -> Column:
    """Per match of ``kind``: characters since the previous match, its length, and whether it counts."""
    pattern = F.lit(kind.pattern)
    between = F.transform(F.split("text", kind.pattern, -1), F.length)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    size = F.transform(whole, F.length)
    counts = F.transform(F.regexp_extract_all("text", pattern, F.lit(kind.group)), lambda s: F.length(s) >= kind.least)
    found = F.arrays_zip(F.slice(between, 1, F.size(size)).alias("gap"), size.alias("size"), counts.alias("counts"))
    return F.when(F.expr(kind.hint), found).alias(kind.name)


def candidates(docs: DataFrame) -> DataFrame:
    """Written once: ``row``, ``doc_id`` and the matches of each kind, without the text."""
    rows = texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text",
                              F.lower("text").alias("low"))
    return materialize(rows.select("row", "doc_id", *(_matches(k) for k in KINDS)), "secret_candidates")


def parts(found: DataFrame) -> DataFrame:
    """One row per candidate: ``row``, ``kind``, ``rank`` (order of kinds), ``role``, ``strong``, ``start``, ``end``."""
    kinds = F.array(*(F.struct(F.lit(k.name).alias("kind"), F.lit(n).alias("rank"), F.lit(k.role).alias("role"),
                               F.lit(k.strong).alias("strong"), F.col(k.name).alias("matches"))
                      for n, k in enumerate(KINDS)))
    each = found.select("row", F.explode(F.filter(kinds, lambda k: F.size(k["matches"]) > 0)).alias("k"))
    each = each.select("row", "k.kind", "k.rank", "k.role", "k.strong", F.posexplode("k.matches").alias("n", "m"))
    before = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    return (each.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.col("m.size"))
            .where("m.counts").select("row", "kind", "rank", "role", "strong", "start", "end"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complementary parts all stand in their scope."""
    bucket = lambda c: F.floor(F.col(c) / scope)
    weak = found.where("not strong").withColumn("bucket", bucket("start"))
    other = found.select("row", F.col("role").alias("other_role"), F.col("start").alias("other_start"),
                         F.explode(F.sequence(bucket("start") - 1, bucket("start") + 1)).alias("bucket"))
    near = weak.join(other, ["row", "bucket"]).where(F.abs(F.col("start") - F.col("other_start")) <= scope)
    needs = F.lit(False)
    for role, roles in NEEDS.items():
        needs = needs | ((F.col("role") == role) & F.col("other_role").isin(*roles))
    keys = ["row", "kind", "rank", "role", "strong", "start", "end"]
    roles = near.where(needs).groupBy(*keys).agg(F.count_distinct("other_role").alias("roles"))
    wanted = F.when(F.col("role") == "endpoint", 2).otherwise(1)
    return roles.where(F.col("roles") >= wanted).select(keys)


def find_secrets(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Reported spans: the strong parts, and the linked weak ones."""
    every = materialize(parts(found), "secret_parts")
    return every.where("strong").unionByName(linked(every, scope))


def digest(docs: DataFrame) -> DataFrame:
    """The digest of the query."""
    found = candidates(docs)
    span = F.struct("start", "rank", "kind", "end")
    spans = find_secrets(found).groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("s"))
    s = F.coalesce("s", F.array().cast(spans.schema["s"].dataType))
    base = F.filter(s, lambda x: x["rank"] < len(BASE_KINDS))
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long")
    return found.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
        joined(s).alias("spans"))
