"""Driver queries of the numbered operators: each runs its operator over the whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import brown_lm, decontamination, filter_audit, fingerprints, jaccard_join, licenses, packing, pii, pivot_codes, rule_ensemble, sharding, suffix_dedup, toxicity


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def q_op1(spark, sf):
    return decontamination.decontamination_report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def q_op2(spark, sf):
    return fingerprints.fingerprint_table(_table(spark, sf, "documents"))


def q_op3(spark, sf):
    return brown_lm.class_lm_scores(_table(spark, sf, "documents"))


def q_op4(spark, sf):
    return toxicity.toxicity_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def q_op5(spark, sf):
    return suffix_dedup.remove_repeats(_table(spark, sf, "documents"))


def q_op6(spark, sf):
    return packing.pack_documents(_table(spark, sf, "documents"))


def q_op7(spark, sf):
    return licenses.scan_licenses(_table(spark, sf, "documents"))


def q_op8(spark, sf):
    return pii.find_personal_data(_table(spark, sf, "documents"))


def q_op9(spark, sf):
    return jaccard_join.jaccard_report(_table(spark, sf, "documents"))


def q_op10(spark, sf):
    return sharding.sharding_report(_table(spark, sf, "documents"))


def q_op11(spark, sf):
    return pivot_codes.code_report(_table(spark, sf, "embeddings"))


def q_op12(spark, sf):
    return rule_ensemble.quality_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def q_op13(spark, sf):
    return filter_audit.filter_interactions(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


QUERIES = {
    "op1_decontamination": q_op1,
    "op2_document_fingerprints": q_op2,
    "op3_brown_lm": q_op3,
    "op4_toxicity_chain": q_op4,
    "op5_suffix_dedup": q_op5,
    "op6_hierarchical_packing": q_op6,
    "op7_license_scan": q_op7,
    "op8_personal_data": q_op8,
    "op9_jaccard_join": q_op9,
    "op10_vector_sharding": q_op10,
    "op11_pivot_codes": q_op11,
    "op12_rule_quality": q_op12,
    "op13_filter_audit": q_op13,
}


def _words(table: str, key: str, pattern: str) -> str:
    """Words of each row's lower-cased text (A-Z only), as a list."""
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '{pattern}') AS w FROM {table}")


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"


def _codes_sql(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Every distance of every part to every entry, round by round."""
    ctes = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""part AS (SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, unnest(range({parts})) AS t(p))""",
            f"""book0 AS (SELECT p, e, x AS y FROM part JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for r in range(rounds + 1):
        ctes.append(f"""near{r} AS (SELECT vec_id, label, p, any_value(x) AS x, min(d * {entries} + e) % {entries} AS e, min(d * {entries} + e) // {entries} AS d
      FROM (SELECT vec_id, label, p, e, x, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))) AS BIGINT) AS d
            FROM part JOIN book{r} USING (p)) GROUP BY vec_id, label, p)""")
        if r < rounds:
            ctes.append(f"""mean{r} AS (SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS y FROM
      (SELECT p, e, i, CAST(sum(x[i]) AS DOUBLE) AS s, count(*) AS n FROM near{r}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY p, e, i) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(m.y, b.y) AS y FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    return f"""WITH {", ".join(ctes)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""


ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS ({_words("documents", "doc_id", _ALNUM)}),
b AS (SELECT * FROM ({_words("benchmark", "item_id", _ALNUM)}) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
             FROM d JOIN (SELECT DISTINCT n FROM bw) ON len(w) >= n)),
hits AS (SELECT * FROM dw WHERE EXISTS (SELECT 1 FROM bw WHERE bw.n = dw.n AND bw.win = dw.win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits JOIN bw USING (n, win)) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_jaccard_join": f"""
WITH RECURSIVE d AS ({_words("documents", "doc_id", _SPACED)}),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)),
reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.c)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op11_pivot_codes": _codes_sql(),
    "op13_filter_audit": f"""
WITH l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
           FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
             + CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 16 ELSE 0 END AS mask
      FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM m GROUP BY part, mask),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
                  [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
             AND a.bit <> b.bit AND a.bit <> c.bit AND a.bit <> d.bit AND a.bit <> e.bit AND b.bit <> c.bit
             AND b.bit <> d.bit AND b.bit <> e.bit AND c.bit <> d.bit AND c.bit <> e.bit AND d.bit <> e.bit),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS prior
          FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)),
r AS (SELECT part, filter_order, step, own,
             CAST(sum(CASE WHEN mask & (prior | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
             CAST(sum(CASE WHEN mask & prior = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
             CAST(sum(CASE WHEN mask & prior <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
             CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
             CAST(sum(CASE WHEN mask & prior = 0 AND mask & own <> 0 THEN g ELSE 0 END) AS BIGINT) AS good_lost,
             CAST(sum(CASE WHEN mask & prior = 0 AND mask & own <> 0 THEN x ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM c, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r""",
}
