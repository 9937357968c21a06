"""

Every query reads the driver tables under `sf_dir` (the estate is one notebook per
`orders` row, see `assetscan.sources.estate`), so its work grows with the data. Each
oracle is DuckDB SQL over the same tables (`oracle.py` holds the shared CTEs).
Timestamps are compared as 'yyyy-MM-dd HH:mm:ss' strings.
"""
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle as O  # noqa: E402
from oracle import P  # noqa: E402
from assetscan import schemas as S  # noqa: E402
from assetscan.operators import cells as C  # noqa: E402
from assetscan.operators import extract as E  # noqa: E402
from assetscan.operators import manifest as M  # noqa: E402
from assetscan.operators import resolve as R  # noqa: E402
from assetscan.plans import scan  # noqa: E402
from assetscan.plans import stages as ST  # noqa: E402
from assetscan.plans.partitioning import materialize, spread  # noqa: E402
from assetscan.session import ensure_checkpoint_dir, ship_package  # noqa: E402
from assetscan.sources import estate as ES  # noqa: E402
from assetscan.sources import io as IO  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _ts(c: str) -> F.Column:
    return F.date_format(F.col(c), TS_FMT).alias(c)


def _inputs(spark: SparkSession, sf: str):
    return (ES.estate_assets(spark, sf, dashboards=True), ES.estate_mapping(spark, sf), ES.estate_mounts(spark, sf))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    assets, mapping, mounts = _inputs(spark, sf)
    return scan.scan_to_manifest(assets, mapping, mounts, ES.AS_OF)


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    assets, mapping, mounts = _inputs(spark, sf)
    return scan.scan_resolved(assets, mapping, mounts)


RESOLVED_COLS = ["asset_path", "cell_index", "reference_kind", "original_reference", "occurrences",
                 "namespace", "table_name", "proposed_replacement", "confidence", "tier", "reason",
                 "manifest_id"]
MANIFEST_TS = ("reviewed_at", "applied_at", "scanned_at")


def manifest_view(df: DataFrame) -> DataFrame:
    return df.select(*[_ts(f.name) if f.name in MANIFEST_TS else F.col(f.name)
                       for f in S.MANIFEST.fields])


# ---- queries --------------------------------------------------------------- #
def _cells(spark, sf):
    return C.split_cells(spread(ES.estate_assets(spark, sf), "asset_path"))


def q_cells_split(spark, sf):
    return _cells(spark, sf).select(
        "asset_path", "cell_index", "language", "code")


def q_refs_sql(spark, sf):
    cells = _cells(spark, sf)
    return E.sql_refs(cells).select("asset_path", "cell_index", "reference_kind", "original_reference")


def q_refs_py_lexical(spark, sf):
    cells = _cells(spark, sf)
    return E.python_refs_lexical(cells).select("asset_path", "cell_index", "reference_kind",
                                               "original_reference")


def q_refs_ast(spark, sf):
    cells = _cells(spark, sf)
    return E.python_refs_syntax(cells).select("asset_path", "cell_index", "reference_kind",
                                              "original_reference")


def q_refs_dashboard(spark, sf):
    cells = C.split_cells(ES.estate_dashboards(spark, sf))
    return E.sql_refs(cells).select("asset_path", "cell_index", "reference_kind", "original_reference")


def q_tier_counts(spark, sf):
    return (_manifest(spark, sf).groupBy(R.tier(F.col("confidence")).alias("tier"))
            .agg(F.sum("occurrences").cast("long").alias("n_references"),
                 F.count(F.lit(1)).alias("n_rows")))


def q_resolve_tables(spark, sf):
    return _resolved(spark, sf).filter(F.col("reference_kind").isin(*S.TABLE_KINDS)).select(*RESOLVED_COLS)


def q_resolve_mounts(spark, sf):
    return _resolved(spark, sf).filter(F.col("reference_kind") == "mount_path_literal").select(*RESOLVED_COLS)


def q_resolve_dynamic_mount(spark, sf):
    assets, mapping, mounts = _inputs(spark, sf)
    refs = materialize(scan.scan_references(assets).filter(F.col("reference_kind") == "dynamic_mount"), "refs")
    with_reg = R.resolve(refs, mapping, mounts).select(
        "manifest_id", "asset_path", "cell_index", "original_reference", "confidence", "reason")
    no_reg = R.resolve(refs, mapping, mounts.filter(F.lit(False))).select(
        "manifest_id", F.col("confidence").alias("confidence_empty_registry"),
        F.col("reason").alias("reason_empty_registry"))
    return with_reg.join(no_reg, "manifest_id")


def q_manifest_full(spark, sf):
    return manifest_view(_manifest(spark, sf))


def q_mapping_load(spark, sf):
    m = ES.estate_mapping_with_duplicates(spark, sf)
    t = R.table_lookup(m).select(F.lit("table").alias("lookup"), F.concat_ws(".", "_ns", "_tbl").alias("key"),
                                 F.col("t_target").alias("target"), F.col("t_ambiguous").alias("ambiguous"))
    n = R.namespace_lookup(m).select(F.lit("namespace").alias("lookup"), F.col("_lk_ns").alias("key"),
                                     F.concat_ws(".", "ns_catalog", "ns_schema").alias("target"),
                                     F.col("ns_ambiguous").alias("ambiguous"))
    k = R.mount_lookup(ES.estate_mounts(spark, sf)).select(
        F.lit("mount").alias("lookup"), F.col("_mnt").alias("key"), F.col("m_namespace").alias("target"),
        F.col("m_ambiguous").alias("ambiguous"))
    return t.unionByName(n).unionByName(k)


def _documents_as_assets(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        F.lit("document").alias("asset_type"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("asset_path"),
        F.col("text").alias("source"))


def q_refs_negative_documents(spark, sf):
    """Negative control: every document read as a notebook; prose gives no references.
    One row: cells read, references found, of which mount paths."""
    cells = C.split_cells(_documents_as_assets(spark, sf))
    refs = (E.sql_refs(cells).unionByName(E.python_refs_lexical(cells))
            .unionByName(E.other_language_refs(cells)))
    marks = (cells.select(F.lit(1).alias("is_cell"), F.lit(0).alias("is_ref"), F.lit(0).alias("is_mount"))
             .unionByName(refs.select(F.lit(0).alias("is_cell"), F.lit(1).alias("is_ref"),
                                      F.col("original_reference").contains("/mnt/").cast("int")
                                      .alias("is_mount"))))
    return marks.agg(F.sum("is_cell").cast("long").alias("n_cells"),
                     F.sum("is_ref").cast("long").alias("n_references"),
                     F.sum("is_mount").cast("long").alias("n_mount_refs"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "cells_split": q_cells_split,
    "refs_sql": q_refs_sql,
    "refs_py_lexical": q_refs_py_lexical,
    "refs_ast": q_refs_ast,
    "refs_dashboard": q_refs_dashboard,
    "resolve_tables": q_resolve_tables,
    "resolve_mounts": q_resolve_mounts,
    "resolve_dynamic_mount": q_resolve_dynamic_mount,
    "manifest_full": q_manifest_full,
    "tier_counts": q_tier_counts,
    "mapping_load": q_mapping_load,
    "refs_negative_documents": q_refs_negative_documents,
}


# ---- oracles --------------------------------------------------------------- #
_RES_SEL = ("SELECT asset_path, cell_index, reference_kind, original_reference, occurrences, namespace, "
            "table_name, proposed_replacement, confidence, " + O.TIER_SQL + " AS tier, reason, manifest_id "
            "FROM resolved WHERE ")
_TABLE_KINDS = ", ".join(O.lit(k) for k in S.TABLE_KINDS)

O.cte("dm_refs", ["refs"], "SELECT * FROM refs WHERE reference_kind = 'dynamic_mount'")
O.cte("no_mounts", ["mounts"], "SELECT * FROM mounts WHERE false")
O.lookups("mapping", "no_mounts")
O.resolved_cte("dm_with", "dm_refs")
O.resolved_cte("dm_without", "dm_refs", "mapping", "no_mounts")

O.cte("docs", [], "SELECT 'document' AS asset_type, 'doc/' || doc_id AS asset_path, text AS source FROM documents")
O.CTES["doc_chunks"] = (["docs"], O.CTES["chunks"][1].replace("FROM estate", "FROM docs"))
for _n in ("cell_texts", "cell_lang", "cells", "py_cells", "text_refs_sql", "text_refs_py", "text_refs_other"):
    _deps, _body = O.CTES[_n]
    _map = {"chunks": "doc_chunks", "cell_texts": "doc_cell_texts", "cell_lang": "doc_cell_lang",
            "cells": "doc_cells", "py_cells": "doc_py_cells"}
    for _a, _b in _map.items():
        _body = _body.replace(f"FROM {_a}", f"FROM {_b}")
    O.CTES["doc_" + _n.removeprefix("text_")] = ([_map.get(d, d) for d in _deps], _body)

ORACLES: dict[str, str] = {
    "refs_negative_documents": O.with_ctes(["doc_cells", "doc_refs_sql", "doc_refs_py", "doc_refs_other"], """
        SELECT (SELECT count(*) FROM doc_cells) AS n_cells,
               (SELECT count(*) FROM (SELECT * FROM doc_refs_sql UNION ALL SELECT * FROM doc_refs_py
                                      UNION ALL SELECT * FROM doc_refs_other)) AS n_references,
               (SELECT count(*) FROM (SELECT * FROM doc_refs_sql UNION ALL SELECT * FROM doc_refs_py
                                      UNION ALL SELECT * FROM doc_refs_other)
                WHERE contains(original_reference, '/mnt/')) AS n_mount_refs"""),
    "cells_split": O.with_ctes(["cells"], "SELECT asset_path, cell_index, language, code FROM cells"),
    "refs_sql": O.with_ctes(["refs_sql"], "SELECT asset_path, cell_index, reference_kind, original_reference FROM refs_sql"),
    "refs_py_lexical": O.with_ctes(["refs_py_lexical"], "SELECT asset_path, cell_index, reference_kind, original_reference FROM refs_py_lexical"),
    "refs_ast": O.with_ctes(["refs_py"], "SELECT asset_path, cell_index, reference_kind, original_reference FROM refs_py"),
    "refs_dashboard": O.with_ctes(["refs_dash"], "SELECT asset_path, cell_index, reference_kind, original_reference FROM refs_dash"),
    "resolve_tables": O.with_ctes(["resolved"], _RES_SEL + f"reference_kind IN ({_TABLE_KINDS})"),
    "resolve_mounts": O.with_ctes(["resolved"], _RES_SEL + "reference_kind = 'mount_path_literal'"),
    "resolve_dynamic_mount": O.with_ctes(["dm_with", "dm_without"], """
        SELECT a.manifest_id, a.asset_path, a.cell_index, a.original_reference, a.confidence, a.reason,
               b.confidence AS confidence_empty_registry, b.reason AS reason_empty_registry
        FROM dm_with a JOIN dm_without b ON a.manifest_id = b.manifest_id"""),
    "manifest_full": O.with_ctes(["manifest"], f"""
        SELECT manifest_id, asset_type, asset_path, cell_index, original_reference, reference_kind,
               proposed_replacement, confidence, status, final_replacement, reviewer,
               {O.ts_str('reviewed_at')} AS reviewed_at, {O.ts_str('applied_at')} AS applied_at, backup_path,
               {O.ts_str('scanned_at')} AS scanned_at, occurrences, reason, decision
        FROM manifest"""),
    "tier_counts": O.with_ctes(["manifest"], f"""
        SELECT {O.TIER_SQL} AS tier, CAST(sum(occurrences) AS BIGINT) AS n_references, count(*) AS n_rows
        FROM manifest GROUP BY 1"""),
    "mapping_load": O.with_ctes(["tl_mapping_dups_mounts", "nl_mapping_dups_mounts", "ml"], """
        SELECT 'table' AS lookup, concat_ws('.', _ns, _tbl) AS key, t_target AS target, t_ambiguous AS ambiguous
        FROM tl_mapping_dups_mounts
        UNION ALL
        SELECT 'namespace', _lk_ns, concat_ws('.', ns_catalog, ns_schema), ns_ambiguous FROM nl_mapping_dups_mounts
        UNION ALL
        SELECT 'mount', _mnt, m_namespace, m_ambiguous FROM ml"""),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: scan the sf0.001 estate into a manifest and count references by tier."""
    return q_tier_counts(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}


# ==== review (V1-V13) ======================================================== #
from assetscan.operators import review as RV  # noqa: E402
from assetscan.operators import rewrite as RW  # noqa: E402

REVIEW_COLS = ["manifest_id", "reference_kind", "asset_path", "status", "final_replacement", "reviewer",
               "reviewed_at", "decision"]


def _review_view(df: DataFrame) -> DataFrame:
    return df.select(*[_ts(c) if c == "reviewed_at" else F.col(c) for c in REVIEW_COLS])


def _approved(spark, sf):
    return RV.batch_approve(_manifest(spark, sf), ES.BATCH_REVIEWER, ES.REVIEWED_AT)


def _reviewed(spark, sf):
    man = materialize(_manifest(spark, sf))
    approved = RV.batch_approve(man, ES.BATCH_REVIEWER, ES.REVIEWED_AT)
    return RV.apply_decisions(approved, ES.estate_decisions(spark, sf, man))


def q_queue_high(spark, sf):
    return RV.queue_high(_manifest(spark, sf))


def q_queue_medium(spark, sf):
    return RV.queue_medium(_manifest(spark, sf))


def q_queue_low(spark, sf):
    return RV.queue_low(_manifest(spark, sf))


def q_batch_approve(spark, sf):
    return _review_view(_approved(spark, sf))


def q_batch_approve_idempotent(spark, sf):
    """V4 twice equals V4 once; V8 counts of the twice-approved manifest."""
    twice = RV.batch_approve(_approved(spark, sf), "second@estate", "2030-01-01 00:00:00")
    return RV.status_counts(twice)


def q_decisions_apply(spark, sf):
    return _review_view(_reviewed(spark, sf)[0])


def q_decisions_rejected(spark, sf):
    return _reviewed(spark, sf)[1]


def q_status_counts(spark, sf):
    return RV.status_counts(_reviewed(spark, sf)[0])


def _cells_of(spark, sf, manifest):
    """Cells of the assets that the given rows are in; other assets are not split."""
    return C.split_cells(spread(ES.estate_assets(spark, sf).join(manifest.select("asset_path").distinct(), "asset_path", "left_semi"), "asset_path"))


def q_candidates_mount(spark, sf):
    manifest = materialize(_manifest(spark, sf), "manifest")
    cells = _cells_of(spark, sf, manifest.filter(F.col("reference_kind") == "dynamic_mount"))
    return RV.candidates_mount(manifest, cells, ES.estate_mounts(spark, sf))


def q_mount_pattern_matches(spark, sf):
    return RV.mount_pattern_matches(_manifest(spark, sf), ES.estate_mounts(spark, sf))


def q_candidates_table(spark, sf):
    manifest = materialize(_manifest(spark, sf), "manifest")
    cells = _cells_of(spark, sf, manifest.filter(F.col("reference_kind") == "dynamic_table"))
    return RV.candidates_table(manifest, cells, ES.estate_mapping(spark, sf))


def q_cell_context(spark, sf):
    cells = C.split_cells(spread(ES.estate_assets(spark, sf, dashboards=True), "asset_path"))
    return RV.cell_context(_manifest(spark, sf), cells)


# ==== apply (S10, A1-A7) ===================================================== #
STAMP = "20240603T000000Z"
SECOND_STAMP = "20240604T000000Z"
APPLIED_AT = "2024-06-03 00:00:00"
BACKUP_ROOT = "/backups"


def _apply_inputs(spark, sf, method="places"):
    reviewed = materialize(_reviewed(spark, sf)[0])
    ws = RW.work_set(reviewed)
    maps, conflicts = RW.edit_maps(ws)
    rewritten = RW.rewrite_assets(ES.estate_assets(spark, sf), maps, method=method)
    return reviewed, ws, conflicts, rewritten


def q_rewrite_literal(spark, sf):
    _, _, _, rw = _apply_inputs(spark, sf, "literal")
    return rw.select("asset_path", F.col("new_source").alias("source"))


def q_rewrite_tokens(spark, sf):
    _, _, _, rw = _apply_inputs(spark, sf)
    return rw.select("asset_path", F.col("new_source").alias("source"))


def q_apply_outcomes(spark, sf):
    _, ws, conflicts, rw = _apply_inputs(spark, sf)
    return RW.outcomes(ws, rw, conflicts)


def q_applied_stamp(spark, sf):
    reviewed, ws, conflicts, rw = _apply_inputs(spark, sf)
    stamped = RW.stamp_applied(reviewed, RW.outcomes(ws, rw, conflicts), APPLIED_AT, BACKUP_ROOT, STAMP)
    return stamped.select("manifest_id", "reference_kind", "status", _ts("applied_at"), "backup_path", "decision")


def q_apply_totals(spark, sf):
    _, ws, conflicts, rw = _apply_inputs(spark, sf)
    return RW.apply_totals(RW.outcomes(ws, rw, conflicts), rw)


def q_restore(spark, sf):
    """A7 over real rounds in a working directory: Apply, approve what was left over, Apply again, take the second round
    back. Per asset edited in either round: its text, and how many of its rows are applied and waiting."""
    wd = ST.Workdir(f"{ensure_checkpoint_dir(spark).rstrip('/')}/assetscan-restore-{uuid.uuid4().hex}")
    assets = ES.estate_assets(spark, sf)
    M.commit(_reviewed(spark, sf)[0], wd.manifest)
    ST.apply(spark, wd, assets, STAMP, APPLIED_AT)
    left = M.read_latest(spark, wd.manifest).filter((F.col("status") == "proposed") & F.col("reference_kind").isin(*S.TABLE_KINDS)
                                                    & (ES.notebook_key(F.col("asset_path")) % 6 == 5))
    ST.review(spark, wd, ES.BATCH_REVIEWER, ES.REVIEWED_AT, materialize(left.select(
        "manifest_id", "reference_kind", F.lit("overridden").alias("decision"), F.lit("main.second.t").alias("final_replacement"),
        F.lit("second@estate").alias("reviewer"), F.to_timestamp(F.lit(APPLIED_AT)).alias("reviewed_at")), "left-over"))
    ST.apply(spark, wd, assets, SECOND_STAMP, APPLIED_AT)
    ST.restore(spark, wd, since=SECOND_STAMP)
    rows = M.read_latest(spark, wd.manifest).groupBy("asset_path").agg(
        F.count(F.when(F.col("status") == "applied", 1)).alias("applied"),
        F.count(F.when(F.col("status").isin("approved", "overridden"), 1)).alias("waiting"))
    texts = IO.current_assets(assets, IO.read_patched(spark, wd.path("assets_patched"))).select("asset_path", "source")
    return rows.filter("applied + waiting > 0").join(texts, "asset_path")


QUERIES.update({
    "queue_high": q_queue_high,
    "queue_medium": q_queue_medium,
    "queue_low": q_queue_low,
    "batch_approve": q_batch_approve,
    "batch_approve_idempotent": q_batch_approve_idempotent,
    "decisions_apply": q_decisions_apply,
    "decisions_rejected": q_decisions_rejected,
    "status_counts": q_status_counts,
    "candidates_mount": q_candidates_mount,
    "mount_pattern_matches": q_mount_pattern_matches,
    "candidates_table": q_candidates_table,
    "cell_context": q_cell_context,
    "rewrite_literal": q_rewrite_literal,
    "rewrite_tokens": q_rewrite_tokens,
    "apply_outcomes": q_apply_outcomes,
    "applied_stamp": q_applied_stamp,
    "apply_totals": q_apply_totals,
    "restore": q_restore,
})

# ---- oracles: review ---------------------------------------------------------- #
_L = O.lit
_legal = ", ".join(_L(f"{a}>{b}") for a, b in S.LEGAL_MOVES)
_kinds = ", ".join(_L(k) for k in S.TABLE_KINDS)
O.cte("approved", ["manifest"], f"""
  SELECT manifest_id, asset_type, asset_path, cell_index, original_reference, reference_kind, proposed_replacement,
         confidence,
         CASE WHEN hit THEN 'approved' ELSE status END AS status,
         CASE WHEN hit THEN proposed_replacement ELSE final_replacement END AS final_replacement,
         CASE WHEN hit THEN {_L(ES.BATCH_REVIEWER)} ELSE reviewer END AS reviewer,
         CASE WHEN hit THEN TIMESTAMP '{ES.REVIEWED_AT}' ELSE reviewed_at END AS reviewed_at,
         applied_at, backup_path, scanned_at, occurrences, reason,
         CASE WHEN hit THEN 'approved' ELSE decision END AS decision
  FROM (SELECT *, confidence >= {S.TIER_SIMPLE_MIN} AND status = 'proposed'
                  AND trim(coalesce(proposed_replacement, '')) <> '' AS hit FROM manifest)""")
O.cte("decisions", ["manifest"], f"""
  SELECT manifest_id, reference_kind,
         CASE k % 6 WHEN 0 THEN 'approved' WHEN 1 THEN 'overridden' WHEN 3 THEN 'overridden'
                    WHEN 2 THEN 'skipped' ELSE 'applied' END AS decision,
         CASE WHEN k % 6 = 1 THEN
                CASE WHEN reference_kind IN ({_kinds}) THEN 'main.reviewed.t_' || (k % 40)
                     WHEN reference_kind = 'mount_path_literal' THEN '/Volumes/main/reviewed/raw/t_' || (k % 40)
                     ELSE '"main.reviewed.t_' || (k % 40) || '"' END
              WHEN k % 6 = 3 THEN '  ' END AS final_replacement,
         c_name AS reviewer, TIMESTAMP '{ES.REVIEWED_AT}' AS reviewed_at
  FROM (SELECT manifest_id, reference_kind, TRY_CAST(regexp_extract(asset_path, 'nb_(\\d+)$', 1) AS BIGINT) AS k
        FROM manifest) m
  JOIN orders ON o_orderkey = k JOIN customer ON c_custkey = o_custkey
  WHERE k % 6 <> 5""")
O.cte("dj", ["approved", "decisions"], f"""
  SELECT *, CASE WHEN d_decision IS NULL THEN NULL
                 WHEN d_decision NOT IN ('approved', 'overridden', 'skipped') THEN 'unknown decision'
                 WHEN (status || '>' || d_decision) NOT IN ({_legal}) THEN 'illegal move ' || status || ' -> ' || d_decision
                 WHEN d_decision IN ('approved', 'overridden') AND (_final IS NULL OR trim(_final) = '')
                   THEN 'blank final replacement' END AS _reject
  FROM (SELECT a.*, d.decision AS d_decision, d.final_replacement AS d_final, d.reviewer AS d_reviewer,
               d.reviewed_at AS d_reviewed_at,
               CASE WHEN d.decision = 'approved' THEN coalesce(nullif(trim(d.final_replacement), ''), a.proposed_replacement)
                    WHEN d.decision = 'overridden' THEN d.final_replacement END AS _final
        FROM approved a LEFT JOIN decisions d ON a.manifest_id = d.manifest_id AND a.reference_kind = d.reference_kind)""")
O.cte("reviewed", ["dj"], """
  SELECT manifest_id, asset_type, asset_path, cell_index, original_reference, reference_kind, proposed_replacement,
         confidence,
         CASE WHEN ok THEN d_decision ELSE status END AS status,
         CASE WHEN ok THEN _final ELSE final_replacement END AS final_replacement,
         CASE WHEN ok THEN d_reviewer ELSE reviewer END AS reviewer,
         CASE WHEN ok THEN d_reviewed_at ELSE reviewed_at END AS reviewed_at,
         applied_at, backup_path, scanned_at, occurrences, reason,
         CASE WHEN ok THEN d_decision ELSE decision END AS decision
  FROM (SELECT *, d_decision IS NOT NULL AND _reject IS NULL AS ok FROM dj)""")

_REVIEW_SEL = ("SELECT manifest_id, reference_kind, asset_path, status, final_replacement, reviewer, "
               f"{O.ts_str('reviewed_at')} AS reviewed_at, decision FROM ")

O.cte("dyn_pat", ["manifest"], f"""
  SELECT manifest_id, reference_kind, asset_path, cell_index, original_reference,
         regexp_extract({O.rr(O.rr(O.rr('original_reference', P.QUOTES_RE, "''"), r"([\\_%])", "'\\\\\\1'"), P.FSTRING_FIELD_RE, "'%'")},
                        '^(?:dbfs:)?(/mnt/[^/]*)', 1) AS mount_pattern
  FROM manifest WHERE reference_kind = 'dynamic_mount'""")
O.cte("cand_tok", ["manifest", "cells"], f"""
  SELECT manifest_id, reference_kind, asset_path, cell_index, original_reference, suffix, token, lower(token) AS _tok
  FROM (SELECT m.manifest_id, m.reference_kind, m.asset_path, m.cell_index, m.original_reference,
               regexp_extract(m.original_reference, {_L(P.DYNAMIC_SUFFIX_RE)}, 1) AS suffix,
               unnest(list_distinct(regexp_extract_all(c.code, {_L(P.IDENT_RE)}, 0))) AS token
        FROM manifest m JOIN cells c ON m.asset_path = c.asset_path AND m.cell_index = c.cell_index
        WHERE m.reference_kind = 'dynamic_table'
        UNION ALL                                              -- assigned by construction, wherever the cell
        SELECT m.manifest_id, m.reference_kind, m.asset_path, m.cell_index, m.original_reference,
               regexp_extract(m.original_reference, {_L(P.DYNAMIC_SUFFIX_RE)}, 1), 'db_' || (o_custkey % 30)
        FROM manifest m JOIN orders ON m.asset_path = '/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey
        WHERE m.reference_kind = 'dynamic_table')""")

# ---- oracles: apply ------------------------------------------------------------- #
O.cte("ws", ["reviewed"], """
  SELECT * FROM reviewed WHERE status IN ('approved', 'overridden') AND asset_type = 'notebook'
    AND final_replacement IS NOT NULL AND trim(final_replacement) <> ''""")
O.cte("ws_keys", ["ws"], """
  SELECT asset_path, cell_index, original_reference, count(DISTINCT final_replacement) AS n,
         min(final_replacement) AS f
  FROM ws GROUP BY ALL""")
O.cte("maps", ["ws_keys"], """
  SELECT asset_path, map_from_entries(list((CAST(cell_index AS VARCHAR) || chr(1) || original_reference, f))) AS m,
         list_sort(list({'neg_len': -length(original_reference), 'o': original_reference, 'f': f})) AS edit_list
  FROM ws_keys WHERE n = 1 GROUP BY asset_path""")
# The text after Apply, from the generator's forms: finals in the places of references, all other text as it was.
def _put(slot: str, value: str) -> str:
    return f"coalesce(m['1' || chr(1) || {value}], m['2' || chr(1) || {value}], m['3' || chr(1) || {value}], {value})" if slot in ("<a>", "<b>", "<q>", *ES.SLOT_KINDS) else value


O.cte("rw_places", ["maps"], f"""
  SELECT maps.asset_path, {_L(O.HEADER_MD)} || o_orderkey || {_L(S.CELL_SEPARATOR)}
         || {O.cell_sql('o_orderkey', '(o_custkey % 30)', 'o_custkey', _put)} || chr(10) AS source
  FROM maps JOIN orders ON maps.asset_path = '/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey""")
O.cte("outcomes", ["ws", "ws_keys"], """
  SELECT w.manifest_id, w.reference_kind, w.asset_path,
         CASE WHEN k.n > 1 THEN 'conflict' WHEN w.original_reference <> '' THEN 'applied' ELSE 'not_found' END AS outcome
  FROM ws w JOIN ws_keys k ON w.asset_path = k.asset_path AND w.cell_index = k.cell_index
                          AND w.original_reference = k.original_reference""")
_bk = (f"'{BACKUP_ROOT}/' || md5(asset_path) || '/' || replace(regexp_replace(asset_path, '^/+|/+$', '', 'g'), '/', '__')"
       f" || '__{STAMP}.py'")

ORACLES.update({
    "queue_high": O.with_ctes(["manifest"], f"""
        SELECT manifest_id, asset_path, cell_index, original_reference, proposed_replacement, confidence
        FROM manifest WHERE confidence >= {S.TIER_SIMPLE_MIN} AND status = 'proposed'"""),
    "queue_medium": O.with_ctes(["manifest"], f"""
        SELECT manifest_id, asset_path, cell_index, original_reference, proposed_replacement, confidence, reference_kind
        FROM manifest WHERE confidence >= {S.TIER_COMPLEX_MIN} AND confidence < {S.TIER_SIMPLE_MIN}
          AND status = 'proposed'"""),
    "queue_low": O.with_ctes(["manifest"], f"""
        SELECT manifest_id, asset_path, cell_index, original_reference, reference_kind, confidence, reason
        FROM manifest WHERE confidence < {S.TIER_COMPLEX_MIN} AND status = 'proposed'"""),
    "batch_approve": O.with_ctes(["approved"], _REVIEW_SEL + "approved"),
    "batch_approve_idempotent": O.with_ctes(["approved"], "SELECT status, count(*) AS n FROM approved GROUP BY status"),
    "decisions_apply": O.with_ctes(["reviewed"], _REVIEW_SEL + "reviewed"),
    "decisions_rejected": O.with_ctes(["dj"], """
        SELECT manifest_id, reference_kind, status AS current_status, d_decision AS decision,
               d_final AS final_replacement, d_reviewer AS reviewer, _reject AS reject_reason
        FROM dj WHERE _reject IS NOT NULL"""),
    "status_counts": O.with_ctes(["reviewed"], "SELECT status, count(*) AS n FROM reviewed GROUP BY status"),
    # the estate's one dynamic mount is f"/mnt/{m}/daily" behind m = "raw-<n>", in its cell or in the one before it
    "candidates_mount": O.with_ctes(["mounts"], """
        SELECT md5(concat_ws(':', asset_path, CAST(cell AS VARCHAR), 'f"/mnt/{m}/daily"')) AS manifest_id, 'dynamic_mount' AS reference_kind,
               asset_path, cell AS cell_index, 'f"/mnt/{m}/daily"' AS original_reference, '/mnt/%' AS mount_pattern, named_mount,
               r.mount_path AS candidate_mount, r.hms_namespace AS candidate_namespace
        FROM (SELECT '/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey AS asset_path, '/mnt/raw-' || (o_custkey % 30) AS named_mount,
                     CAST(CASE WHEN (o_orderkey // 8) % 2 = 0 THEN 1 ELSE 3 END AS INTEGER) AS cell
              FROM orders WHERE o_orderkey % 8 = 5) o
        LEFT JOIN mounts r ON r.mount_path = o.named_mount"""),
    "mount_pattern_matches": O.with_ctes(["mounts"], """
        SELECT '/mnt/%' AS mount_pattern, mount_path AS candidate_mount, hms_namespace AS candidate_namespace
        FROM mounts WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 8 = 5)"""),
    "candidates_table": O.with_ctes(["cand_tok", "nl", "tl"], """
        SELECT DISTINCT * FROM (
          SELECT t.manifest_id, t.reference_kind, t.asset_path, t.cell_index, t.original_reference,
                 t.token AS candidate_namespace,
                 coalesce(tl.t_target, CASE WHEN t.suffix <> '' THEN concat_ws('.', n.ns_catalog, n.ns_schema, t.suffix) END)
                   AS candidate_target
          FROM cand_tok t JOIN nl n ON t._tok = n._lk_ns AND n.ns_schema IS NOT NULL
          LEFT JOIN (SELECT * FROM tl WHERE t_target IS NOT NULL) tl ON tl._ns = n._lk_ns AND tl._tbl = lower(t.suffix)
          UNION ALL
          SELECT t.manifest_id, t.reference_kind, t.asset_path, t.cell_index, t.original_reference,
                 string_split(t.token, '.')[1], tl.t_target
          FROM cand_tok t JOIN tl ON t._tok = tl._ns || '.' || tl._tbl AND tl.t_target IS NOT NULL)"""),
    "cell_context": O.with_ctes(["manifest", "cells", "dash_cells"], """
        SELECT m.asset_path, m.cell_index, m.manifest_id, m.reference_kind, m.original_reference, m.confidence,
               m.reason, c.language, c.code
        FROM manifest m LEFT JOIN (SELECT asset_path, cell_index, language, code FROM cells
                                   UNION ALL SELECT asset_path, cell_index, language, code FROM dash_cells) c
          ON m.asset_path = c.asset_path AND m.cell_index = c.cell_index"""),
    "rewrite_literal": O.with_ctes(["estate", "maps"], """
        SELECT e.asset_path, list_reduce(m.edit_list, lambda acc, x: replace(acc, x.o, x.f), e.source) AS source
        FROM estate e JOIN maps m ON e.asset_path = m.asset_path"""),
    "rewrite_tokens": O.with_ctes(["rw_places"], "SELECT asset_path, source FROM rw_places"),
    "apply_outcomes": O.with_ctes(["outcomes"], "SELECT manifest_id, reference_kind, asset_path, outcome FROM outcomes"),
    "applied_stamp": O.with_ctes(["reviewed", "outcomes"], f"""
        SELECT r.manifest_id, r.reference_kind,
               CASE WHEN o.outcome = 'applied' THEN 'applied' ELSE r.status END AS status,
               CASE WHEN o.outcome = 'applied' THEN '{APPLIED_AT}' ELSE {O.ts_str('r.applied_at')} END AS applied_at,
               CASE WHEN o.outcome = 'applied' THEN {_bk.replace('asset_path', 'r.asset_path')} ELSE r.backup_path END
                 AS backup_path,
               r.decision
        FROM reviewed r LEFT JOIN outcomes o ON r.manifest_id = o.manifest_id AND r.reference_kind = o.reference_kind"""),
    "apply_totals": O.with_ctes(["outcomes"], """
        SELECT count(*) FILTER (WHERE outcome = 'applied') AS references_applied,
               count(DISTINCT asset_path) FILTER (WHERE outcome = 'applied') AS assets_applied,
               count(*) FILTER (WHERE outcome = 'not_found') AS references_not_found,
               count(*) FILTER (WHERE outcome = 'conflict') AS references_conflicting
        FROM outcomes"""),
})


# ==== validate and audit (S13, Q1-Q7, L1-L3, S14) ============================= #
from assetscan.operators import audit as AU  # noqa: E402
from assetscan.operators import reconcile as RC  # noqa: E402


def _stamped(spark, sf):
    reviewed, ws, conflicts, rw = _apply_inputs(spark, sf)
    return RW.stamp_applied(reviewed, RW.outcomes(ws, rw, conflicts), APPLIED_AT, BACKUP_ROOT, STAMP)


def _reconciled(spark, sf):
    stamped = materialize(_stamped(spark, sf))
    pairs = materialize(RC.pair_by_convention(RC.reconcile_targets(stamped, target_schema=None), ES.SOURCE_BASE), "pairs")
    names = pairs.select(F.explode(F.array("target", "source")).alias("name"))
    stats = RC.table_stats(spark, names, ES.estate_catalog(spark, sf))
    return stamped, materialize(RC.reconcile(pairs, stats), "reconciled")       # the audit reads it twice


def q_reconcile(spark, sf):
    return _reconciled(spark, sf)[1]


def q_reconcile_fail(spark, sf):
    stamped, results = _reconciled(spark, sf)
    return RC.mark_failed(stamped, results).select("manifest_id", "reference_kind", "status", "final_replacement")


def q_reconcile_totals(spark, sf):
    return RC.reconcile_totals(_reconciled(spark, sf)[1])


def q_audit_decisions(spark, sf):
    stamped, results = _reconciled(spark, sf)
    return AU.decision_rows(RC.mark_failed(stamped, results)).withColumn("reviewed_at", _ts("reviewed_at"))


def q_audit_summary(spark, sf):
    stamped, results = _reconciled(spark, sf)
    return AU.summary(AU.decision_rows(RC.mark_failed(stamped, results)), results)


QUERIES.update({
    "reconcile": q_reconcile,
    "reconcile_fail": q_reconcile_fail,
    "reconcile_totals": q_reconcile_totals,
    "audit_decisions": q_audit_decisions,
    "audit_summary": q_audit_summary,
})

O.cte("stamped", ["reviewed", "outcomes"], f"""
  SELECT r.manifest_id, r.asset_type, r.asset_path, r.cell_index, r.original_reference, r.reference_kind,
         r.proposed_replacement, r.confidence,
         CASE WHEN o.outcome = 'applied' THEN 'applied' ELSE r.status END AS status,
         r.final_replacement, r.reviewer, r.reviewed_at,
         CASE WHEN o.outcome = 'applied' THEN TIMESTAMP '{APPLIED_AT}' ELSE r.applied_at END AS applied_at,
         CASE WHEN o.outcome = 'applied' THEN {_bk.replace('asset_path', 'r.asset_path')} ELSE r.backup_path END
           AS backup_path,
         r.scanned_at, r.occurrences, r.reason, r.decision
  FROM reviewed r LEFT JOIN outcomes o ON r.manifest_id = o.manifest_id AND r.reference_kind = o.reference_kind""")
_cols_of = ("(SELECT string_agg(cn, ',' ORDER BY cn) FROM (SELECT CASE WHEN column_name = 'l_tax' AND {ren} "
            "THEN 'l_tax_rate' ELSE column_name END AS cn FROM information_schema.columns "
            "WHERE table_name = '{t}'))")
O.cte("rc_pairs", ["stamped"], f"""
  SELECT target, '{ES.SOURCE_BASE}.src_' || string_split(target, '.')[-1] AS source,
         TRY_CAST(regexp_extract(string_split(target, '.')[-1], '^t_(\\d+)$', 1) AS BIGINT) % 5 AS v
  FROM (SELECT DISTINCT trim(final_replacement, '"') AS target FROM stamped
        WHERE status = 'applied' AND reference_kind IN ({_kinds}, 'dynamic_table')
          AND len(string_split(final_replacement, '.')) = 3)""")
O.cte("rc", ["rc_pairs"], f"""
  SELECT target, source, source_rows, target_rows, source_columns, target_columns,
         CASE WHEN readable THEN source_rows = target_rows END AS counts_match,
         CASE WHEN readable THEN source_columns = target_columns END AS columns_match,
         CASE WHEN readable THEN v <> 2 END AS types_match,
         CASE WHEN NOT readable THEN 'unverifiable'
              WHEN source_rows = target_rows AND source_columns = target_columns THEN 'match'
              ELSE 'mismatch' END AS result
  FROM (SELECT *, source_rows IS NOT NULL AND target_rows IS NOT NULL AS readable FROM (SELECT target, source, v,
          CASE WHEN v IS NULL THEN NULL WHEN v = 3 THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM lineitem) END AS source_rows,
          CASE v WHEN 0 THEN (SELECT count(*) FROM lineitem)
                 WHEN 1 THEN (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R')
                 WHEN 2 THEN (SELECT count(*) FROM lineitem)
                 WHEN 3 THEN (SELECT count(*) FROM orders) END AS target_rows,
          CASE WHEN v IS NULL THEN NULL WHEN v = 3 THEN {_cols_of.format(ren='false', t='orders')}
               ELSE {_cols_of.format(ren='false', t='lineitem')} END AS source_columns,
          CASE v WHEN 0 THEN {_cols_of.format(ren='false', t='lineitem')}
                 WHEN 1 THEN {_cols_of.format(ren='false', t='lineitem')}
                 WHEN 2 THEN {_cols_of.format(ren='true', t='lineitem')}
                 WHEN 3 THEN {_cols_of.format(ren='false', t='orders')} END AS target_columns
        FROM rc_pairs))""")
O.cte("failed", ["stamped", "rc"], """
  SELECT s.* REPLACE (CASE WHEN s.status = 'applied' AND s.reference_kind NOT IN ('mount_path_literal', 'dynamic_mount')
                             AND trim(s.final_replacement, '"') IN
                             (SELECT target FROM rc WHERE result = 'mismatch') THEN 'failed' ELSE s.status END AS status)
  FROM stamped s""")
O.cte("audit", ["failed"], f"""
  SELECT 'decision-' || substring(manifest_id, 1, 8) AS run_name, manifest_id, asset_path, reference_kind, status,
         coalesce(decision, status) AS decision, coalesce(reviewer, 'unknown') AS reviewer,
         CAST(confidence AS DOUBLE) AS confidence, {O.ts_str('reviewed_at')} AS reviewed_at
  FROM failed WHERE status <> 'proposed'""")

ORACLES.update({
    "restore": O.with_ctes(["estate", "rw_places", "stamped"], f"""
        SELECT n.asset_path, applied, waiting, coalesce(r.source, e.source) AS source
        FROM (SELECT asset_path, count(*) FILTER (WHERE status = 'applied') AS applied,
                     count(*) FILTER (WHERE status IN ('approved', 'overridden')
                       OR (status = 'proposed' AND reference_kind IN ({_kinds}) AND TRY_CAST(regexp_extract(asset_path, 'nb_(\\d+)$', 1) AS BIGINT) % 6 = 5)) AS waiting
              FROM stamped GROUP BY asset_path) n
        JOIN estate e ON e.asset_path = n.asset_path LEFT JOIN rw_places r ON r.asset_path = n.asset_path
        WHERE applied + waiting > 0"""),
    "reconcile": O.with_ctes(["rc"], "SELECT * FROM rc"),
    "reconcile_fail": O.with_ctes(["failed"], "SELECT manifest_id, reference_kind, status, final_replacement FROM failed"),
    "reconcile_totals": O.with_ctes(["rc"], """
        SELECT count(*) FILTER (WHERE result = 'match') AS tables_matched,
               count(*) FILTER (WHERE result <> 'unverifiable') AS tables_reconciled,
               count(*) FILTER (WHERE result = 'mismatch') AS tables_failed,
               count(*) FILTER (WHERE result = 'unverifiable') AS tables_unverifiable FROM rc"""),
    "audit_decisions": O.with_ctes(["audit"], "SELECT * FROM audit"),
    "audit_summary": O.with_ctes(["audit", "rc"], """
        SELECT (SELECT count(*) FROM audit) AS decisions_logged,
               (SELECT count(*) FILTER (WHERE result <> 'unverifiable') FROM rc) AS tables_reconciled,
               (SELECT count(*) FILTER (WHERE result = 'match') FROM rc) AS tables_matched,
               (SELECT count(*) FILTER (WHERE result = 'mismatch') FROM rc) AS tables_failed,
               (SELECT count(*) FILTER (WHERE result = 'unverifiable') FROM rc) AS tables_unverifiable"""),
})


# ==== discovery and inventory (S3-S5, G3) ====================================== #
from assetscan.sources import changes as CH  # noqa: E402
from assetscan.sources import demo as DM  # noqa: E402


def q_inventory_backfill(spark, sf):
    out = IO.inventory_backfill(ES.estate_notebooks(spark, sf), ES.estate_inventory_partial(spark, sf), ES.AS_OF)
    return out.withColumn("seeded_at", _ts("seeded_at"))


def q_registry_refresh(spark, sf):
    mounts = IO.discover_mounts(spark, ES.estate_mount_listing(spark, sf))
    return (IO.registry_rows(mounts, ES.AS_OF).withColumn("discovered_at", _ts("discovered_at"))
            .join(mounts.select("mount_path", "provenance"), "mount_path"))


def q_asset_changes(spark, sf):
    """What changed between two states of the estate, by content fingerprints."""
    before, after = ES.estate_states(spark, sf)
    return CH.changes(CH.fingerprints(before), materialize(CH.fingerprints(after), "fingerprints"))


def q_export_decode(spark, sf):
    """Every notebook through the base64 form of an export and back."""
    exported = IO.encode_for_import(ES.estate_notebooks(spark, sf).select("asset_path", "source")).drop("source")
    return IO.decode_exports(exported).select("asset_path", "source")


def q_inventory_seed(spark, sf):
    """Inventory rows of all notebooks and dashboards of the estate."""
    inventory = ES.estate_inventory(spark, sf).withColumnRenamed("path", "asset_path")
    dashboards = ES.estate_dashboards(spark, sf).withColumn("tier", F.lit(S.TIER_SIMPLE))
    return IO.seed_inventory(inventory, dashboards, ES.AS_OF).withColumn("seeded_at", _ts("seeded_at"))


def q_audit_log(spark, sf):
    """The decision log after its entries were appended twice."""
    stamped, results = _reconciled(spark, sf)
    entries = materialize(AU.decision_rows(RC.mark_failed(stamped, results)), "entries")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/assetscan-audit-log-{uuid.uuid4().hex}"
    IO.append_audit(entries, path)
    IO.append_audit(entries, path)
    return spark.read.schema(entries.schema).parquet(path).withColumn("reviewed_at", _ts("reviewed_at"))


def q_expected_vs_found(spark, sf):
    return DM.expected_vs_found(ES.estate_inventory(spark, sf), _manifest(spark, sf))


QUERIES.update({
    "inventory_backfill": q_inventory_backfill,
    "registry_refresh": q_registry_refresh,
    "expected_vs_found": q_expected_vs_found,
    "asset_changes": q_asset_changes,
    "export_decode": q_export_decode,
    "inventory_seed": q_inventory_seed,
    "audit_log": q_audit_log,
})

_nb_path = "'/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey"
ORACLES.update({
    "inventory_backfill": O.with_ctes(["estate"], f"""
        SELECT 'notebook' AS asset_type, path, string_split(path, '/')[-1] AS name, 'unknown' AS tier,
               CAST(NULL AS INTEGER) AS hms_ref_count, '{ES.AS_OF}' AS seeded_at
        FROM (SELECT DISTINCT asset_path AS path FROM estate)
        WHERE path NOT IN (SELECT {_nb_path} FROM orders WHERE o_orderstatus = 'F')"""),
    "registry_refresh": O.with_ctes(["mounts"], f"""
        SELECT mount_path, adls_target, '' AS hms_namespace, '{ES.AS_OF}' AS discovered_at, 'listing' AS provenance FROM mounts"""),
    "export_decode": O.with_ctes(["estate"], "SELECT asset_path, source FROM estate"),
    "audit_log": O.with_ctes(["audit"], "SELECT * FROM audit"),
    "inventory_seed": f"""
        SELECT 'notebook' AS asset_type, {_nb_path} AS path, 'nb_' || o_orderkey AS name,
               CASE WHEN o_orderkey % 8 IN (0, 1, 2, 3) THEN 'simple' WHEN o_orderkey % 8 IN (4, 5) THEN 'complex' ELSE 'very_complex' END AS tier,
               CAST({O.by_form('o_orderkey', lambda v, i: str(sum(kind != S.KIND_UNPARSED for kind, _ in ES.form_references(v, i))))} AS INTEGER) AS hms_ref_count,
               '{ES.AS_OF}' AS seeded_at
        FROM orders
        UNION ALL
        SELECT 'dashboard', '/estate/dashboards/d_' || s_suppkey, 'd_' || s_suppkey, 'simple', CAST(2 AS INTEGER), '{ES.AS_OF}' FROM supplier""",
    "asset_changes": f"""
        SELECT CASE WHEN change = 'renamed' THEN '/estate/moved/nb_' || o_orderkey ELSE path END AS asset_path, change,
               CASE WHEN change = 'renamed' THEN path END AS old_path
        FROM (SELECT o_orderkey, {_nb_path} AS path,
                     CASE WHEN o_orderstatus = 'P' THEN 'added' WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 9 THEN 'deleted'
                          WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 8 THEN 'renamed' WHEN o_orderpriority = '1-URGENT' THEN 'changed' END AS change
              FROM orders) WHERE change IS NOT NULL""",
    "expected_vs_found": O.with_ctes(["manifest"], f"""
        SELECT i.asset_path, i.tier, i.declared, coalesce(f.found, 0) AS found,
               coalesce(f.found, 0) - i.declared AS difference
        FROM (SELECT {_nb_path} AS asset_path,
                     CASE WHEN o_orderkey % 8 IN (0, 1, 2, 3) THEN 'simple' WHEN o_orderkey % 8 IN (4, 5) THEN 'complex'
                          ELSE 'very_complex' END AS tier,
                     CAST({O.by_form('o_orderkey', lambda v, i: str(sum(kind != S.KIND_UNPARSED for kind, _ in ES.form_references(v, i))))} AS BIGINT) AS declared
              FROM orders) i
        LEFT JOIN (SELECT asset_path, CAST(sum(occurrences) AS BIGINT) AS found FROM manifest GROUP BY asset_path) f
          ON i.asset_path = f.asset_path"""),
})

# ==== training-data operators ================================================= #
# Added only where their subpackage is present; anything else that fails to import is an error.
try:
    import corpus_pipeline as PIPELINE  # noqa: E402
    from assetscan.llm import queries as LLM  # noqa: E402
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "assetscan.llm")):
        raise
else:
    QUERIES.update(LLM.QUERIES)
    ORACLES.update(LLM.ORACLE_SQL)
    QUERIES["pipeline"] = PIPELINE.run
    if PIPELINE.ORACLE_SQL is not None:
        ORACLES["pipeline"] = PIPELINE.ORACLE_SQL


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf)
    return run
