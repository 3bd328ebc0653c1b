"""DuckDB SQL for the registered queries that SQL can express on whole tables.

The others have none and are held against brute force in ``tests/llm``:
alignment (1), checksums over letters (2), a Bloom filter's own errors (3),
bytes across all documents (4), tokenizers (5, 9), HTML (7) and runs of words (11).
"""

from __future__ import annotations

from tillroll.llm import secrets

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quality_sql() -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, {WORDS.format(text="text")} AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS k FROM w, unnest(range(1, len(ws) - 3)) t(i)),
twice AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, range(0, 5) t(j) GROUP BY rid),
m AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(list_sum(list_transform(ws, lambda x: length(x))) AS BIGINT) AS chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(list_filter(ws, lambda x: regexp_matches(x, '\pL'))) AS BIGINT) AS n_alpha_words
      FROM w LEFT JOIN rep ON rep.rid = w.rid),
v AS (SELECT *, coalesce(chars, 0) AS word_chars,
             CAST((n_words < 10) AS INT) + 2 * CAST((100 * n_repeat_words > 20 * n_words) AS INT)
             + 4 * CAST((100 * n_symbols > 10 * n_words) AS INT) + 8 * CAST((100 * n_dup_lines > 30 * n_lines) AS INT)
             + 16 * CAST((coalesce(chars, 0) < 2 * n_words) AS INT) + 32 * CAST((coalesce(chars, 0) > 20 * n_words) AS INT)
             + 64 * CAST((100 * n_alpha_words < 50 * n_words) AS INT)
             + 128 * CAST((n_dup_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines) AS INT) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, bits & ~8 = 0 AS kept, CAST(bits AS BIGINT) AS fail_bits
FROM v"""


def jaccard_sql() -> str:
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS.format(text=lowered)} AS ws FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(ws[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(ws) - 3)) t(i)
      UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT rid, rid AS other FROM d UNION SELECT r.rid, e.b FROM reach r JOIN e ON e.a = r.other),
c AS (SELECT r.rid, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.rid = r.other GROUP BY r.rid)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d JOIN c ON c.rid = d.rid LEFT JOIN n ON n.rid = d.rid"""


def secrets_sql() -> str:
    text = lambda s: "'" + s.replace("'", "''") + "'"
    matches = []
    for rank, k in enumerate(secrets.KINDS):
        pattern, counts = k.pattern, f"length(parts[i]) >= {k.least}"
        if k.name == "key40":  # no look-around here: whole runs that are 40 long and mixed
            pattern = "[A-Za-z0-9+/=]+"
            counts = "length(runs[i]) = 40 AND runs[i] NOT LIKE '%=%'" + "".join(
                f" AND regexp_matches(runs[i], '{c}')" for c in ("[0-9]", "[A-Z]", "[a-z]"))
        matches.append(
            f"SELECT rid, '{k.name}' AS kind, {rank} AS rank, '{k.role}' AS role, {k.strong} AS strong, i, "
            f"length(gaps[i]) + length(runs[i]) AS step, length(runs[i]) AS size, {counts} AS counts FROM (SELECT rid, "
            f"string_split_regex(t, {text(pattern)}) AS gaps, regexp_extract_all(t, {text(pattern)}) AS runs, "
            f"regexp_extract_all(t, {text(pattern)}, {k.group}) AS parts FROM d), unnest(range(1, len(runs) + 1)) x(i)")
    needs = " OR ".join(f"(w.role = '{role}' AND o.role IN ({', '.join(map(text, roles))}))"
                        for role, roles in secrets.NEEDS.items())
    spans = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in secrets.BASE_KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(matches)}),
e AS (SELECT *, sum(step) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM m),
p AS (SELECT rid, kind, rank, role, strong, stop - size AS start, stop FROM e WHERE counts),
linked AS (SELECT w.rid, w.kind, w.rank, w.start, w.stop FROM p w JOIN p o ON o.rid = w.rid
           AND abs(o.start - w.start) <= {secrets.SCOPE} AND ({needs}) WHERE NOT w.strong
           GROUP BY ALL HAVING count(DISTINCT o.role) >= CASE WHEN any_value(w.role) = 'endpoint' THEN 2 ELSE 1 END),
s AS (SELECT rid, kind, rank, start, stop FROM p WHERE strong UNION ALL SELECT * FROM linked),
g AS (SELECT rid, {counts}, {spans} AS spans,
             {spans} FILTER (rank < {len(secrets.BASE_KINDS)}) AS base FROM s GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE_KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g ON g.rid = d.rid"""


def nearest_sql() -> str:
    fits = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 " \
           "AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND {fits}),
p AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY rid ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda c, _: xor(c >> 1, (c & 1) * 3988292384)"
    step = f"lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, {step}), 4294967295)"


def merkle_sql() -> str:
    encoded = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = lambda n: "sha256(" + " || ".join(map(encoded, ("doc_id", "source", "lang", n, "text"))) + ")"
    up = "sha256(string_agg(node, '' ORDER BY idx))"
    return f"""
WITH RECURSIVE l AS (SELECT coalesce('=' || lang, '') AS tree, doc_id, {leaf("n_chars")} AS leaf,
       CASE WHEN n_chars IS NOT NULL AND doc_id IS NOT NULL AND {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0
            THEN {leaf("n_chars + 1")} END AS bad FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
             row_number() OVER () AS rid, count(*) OVER (PARTITION BY tree) AS n FROM l),
t AS (SELECT tree, 0 AS lev, idx, n, leaf AS node FROM o
      UNION ALL SELECT tree, lev + 1, idx // 2, (any_value(n) + 1) // 2, {up} FROM t WHERE n > 1 GROUP BY tree, lev, idx // 2),
s AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lev, idx, n, subroot AS node FROM s
      UNION ALL SELECT lev + 1, idx // 2, (any_value(n) + 1) // 2, {up} FROM u WHERE n > 1 GROUP BY lev, idx // 2),
steps AS (SELECT o.rid, t.lev AS lev, t.idx AS spot, b.node AS other FROM o JOIN t ON t.tree = o.tree AND t.idx = o.idx >> t.lev AND t.n > 1
          LEFT JOIN t b ON b.tree = t.tree AND b.lev = t.lev AND b.idx = xor(t.idx, 1)
          UNION ALL SELECT o.rid, 100 + u.lev, u.idx, b.node FROM o JOIN s ON s.tree = o.tree JOIN u ON u.idx = s.idx >> u.lev AND u.n > 1
          LEFT JOIN u b ON b.lev = u.lev AND b.idx = xor(u.idx, 1)),
way AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY lev) AS k, spot, other FROM steps),
proof AS (SELECT rid, sha256(coalesce(string_agg(other, '' ORDER BY k), '')) AS proof_sha256, max(k) AS top FROM way GROUP BY rid),
f AS (SELECT rid, 0 AS k, coalesce(bad, leaf) AS node FROM o
      UNION ALL SELECT f.rid, f.k + 1, sha256(CASE WHEN spot % 2 = 1 THEN coalesce(other, '') || node ELSE node || coalesce(other, '') END)
      FROM f JOIN way ON way.rid = f.rid AND way.k = f.k + 1)
SELECT o.doc_id, o.leaf, s.subroot, r.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified
FROM o JOIN s ON s.tree = o.tree JOIN (SELECT node FROM u WHERE n = 1) r ON TRUE
LEFT JOIN proof ON proof.rid = o.rid JOIN f ON f.rid = o.rid AND f.k = coalesce(proof.top, 0)"""


def registry() -> dict[str, str]:
    return {"op6_quality": quality_sql(), "op8_jaccard": jaccard_sql(), "op10_secrets": secrets_sql(),
            "op12_nearest_vectors": nearest_sql(), "op13_merkle_manifest": merkle_sql()}
