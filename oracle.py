"""DuckDB SQL oracles for the driver queries in `__spark_entry__.py`.

Each oracle is one SELECT with CTEs over the pre-registered driver tables. The CTEs
below repeat the Spark operators in SQL, with the same regex constants, so the two
engines can be compared at sf0.01. DuckDB's regexp_replace needs the 'g' option to
replace every match; Spark's always does.
"""
from __future__ import annotations

from assetscan import schemas as S
from types import SimpleNamespace

from assetscan.functions import patterns as _java
from assetscan.sources import estate as ES
from assetscan.sources.estate import AS_OF

P = SimpleNamespace(**{k: _java.re2(v) for k, v in vars(_java).items() if isinstance(v, str)})

def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rr(expr: str, pattern: str, repl: str = "' '") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {repl}, 'g')"


def sql_names(expr: str) -> str:
    """Dotted words after a table keyword; for texts whose names the generator does not state (prose)."""
    return f"regexp_extract_all({expr}, {lit(r'(?i)\b(?:from|join|into|update|table|view)\s+(\w+(?:\.\w+){1,2})')}, 1)"


def keep_name(expr: str) -> str:
    parts = f"string_split(replace({expr}, '`', ''), '.')"
    return f"(len({parts}) = 2 OR (len({parts}) = 3 AND lower({parts}[1]) = {lit(S.LEGACY_CATALOG)}))"


def name_ns(expr: str) -> str:
    parts = f"string_split(replace({expr}, '`', ''), '.')"
    return f"CASE WHEN len({parts}) = 2 THEN {parts}[1] ELSE {parts}[2] END"


def name_tbl(expr: str) -> str:
    parts = f"string_split(replace({expr}, '`', ''), '.')"
    return f"CASE WHEN len({parts}) = 2 THEN {parts}[2] ELSE {parts}[3] END"


def mount_prefix(expr: str) -> str:
    return f"regexp_extract({expr}, {lit(P.MOUNT_PREFIX_RE)}, 1)"


def by_form(k: str, value) -> str:
    """The SQL that `value(v, i)` gives for the form of notebook k."""
    return "CASE " + " ".join(f"WHEN {k} % 8 = {v} AND ({k} // 8) % {len(forms)} = {i} THEN {value(v, i)}"
                              for v, forms in ES.FORMS.items() for i in range(len(forms))) + " END"


def slots(n: str, c: str) -> dict[str, str]:
    """What stands in a form's places."""
    a = f"('db_' || {n} || '.t_' || {c})"
    return {"<a>": a, "<q>": a, "<A>": a, "<b>": f"('db_' || {n} || '.t_1')", "<s>": f"('db_' || {n})", "<n>": f"('raw-' || {n})",
            "<m>": f"('/mnt/raw-' || {n} || '/2024/t_' || {c})", "<g>": f"('dbfs:/mnt/raw-' || {n} || '/gl')",
            "<f>": lit('f"/mnt/{m}/daily"'), "<d>": f"""('f"{{db}}.t_' || {c} || '"')"""}


def cell_sql(k: str, n: str, c: str, put=lambda slot, value: value) -> str:
    """The code cell of notebook k; `put` may replace what stands in a place."""
    text = by_form(k, lambda v, i: lit(ES.form_source(v, i)))
    for slot, value in slots(n, c).items():
        text = f"replace({text}, '{slot}', {put(slot, value)})"
    return text


HEADER_MD = S.NOTEBOOK_HEADER + "\n\n# MAGIC %md\n# MAGIC ## notebook "

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("estate", [], f"""
  SELECT 'notebook' AS asset_type,
         '/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey AS asset_path,
         'nb_' || o_orderkey AS name,
         {lit(HEADER_MD)} || o_orderkey || {lit(S.CELL_SEPARATOR)}
           || {cell_sql('o_orderkey', '(o_custkey % 30)', 'o_custkey')} || {lit(chr(10))} AS source
  FROM orders""")

cte("dashboards", [], f"""
  SELECT 'dashboard' AS asset_type, '/estate/dashboards/d_' || s_suppkey AS asset_path,
         ['SELECT channel, sum(amount) AS total FROM db_' || s_nationkey || '.t_' || s_suppkey
            || ' GROUP BY channel',
          'SELECT d.day, count(*) FROM db_' || s_nationkey || '.t_' || (s_suppkey % 7) || ' d, db_'
            || s_nationkey || '.calendar c WHERE d.day = c.day GROUP BY d.day'] AS queries
  FROM supplier""")

cte("mapping", [], f"""
  SELECT 'db_' || (p_partkey % 30) AS hms_namespace, 't_' || p_partkey AS hms_table,
         'cat_' || n_regionkey AS uc_catalog, 'sch_' || n_nationkey AS uc_schema,
         CASE WHEN n_nationkey IS NOT NULL AND p_partkey % 7 <> 3 THEN 't_' || p_partkey END AS uc_table, '/mnt/raw-' || n_nationkey AS mount_path,
         CAST(NULL AS VARCHAR) AS notes
  FROM part LEFT JOIN nation ON p_partkey % 30 = n_nationkey""")

cte("mapping_dups", ["mapping"], f"""
  SELECT * FROM mapping
  UNION ALL
  SELECT 'db_' || (p_partkey % 30), 't_' || p_partkey, 'cat_' || n_regionkey, 'sch_' || n_nationkey,
         CASE WHEN n_nationkey IS NULL THEN NULL WHEN p_partkey % 4 = 0 THEN 'alt_' || p_partkey ELSE 't_' || p_partkey END,
         CAST(NULL AS VARCHAR), 'duplicate'
  FROM part LEFT JOIN nation ON p_partkey % 30 = n_nationkey""")

cte("mounts", [], f"""
  SELECT '/mnt/raw-' || n_nationkey AS mount_path,
         'abfss://raw-' || n_nationkey || '@acct.dfs.core.windows.net/' AS adls_target,
         CASE n_nationkey % 8 WHEN 7 THEN '' WHEN 6 THEN 'db_' || (n_nationkey + 100)
              ELSE 'db_' || n_nationkey END AS hms_namespace, TIMESTAMP '{AS_OF}' AS discovered_at
  FROM nation
  UNION ALL
  SELECT '/mnt/raw-' || n_nationkey || '/2024', 'abfss://year-' || n_nationkey || '@acct.dfs.core.windows.net/',
         'db_' || ((n_nationkey + 1) % 25), TIMESTAMP '{AS_OF}' FROM nation WHERE n_nationkey % 3 = 0""")

# ---- cells (C1-C5) --------------------------------------------------------- #
_texts = (f"list_filter(list_transform(string_split_regex({rr('source', P.HEADER_RE, "''")}, "
          f"{lit(P.SEPARATOR_RE)}), lambda c: {rr('c', P.EDGE_NEWLINES_RE, "''")}), "
          f"lambda t: NOT regexp_matches(t, {lit(P.BLANK_RE)}))")
cte("chunks", ["estate"], f"""
  SELECT asset_type, asset_path, {_texts} AS texts FROM estate""")
_lang = f"""CASE WHEN regexp_matches(regexp_extract(text, {lit(P.FIRST_TWO_LINES_RE)}, 0), {lit(P.SQL_MAGIC_RE)}) THEN 'sql'
    WHEN lower(regexp_extract(regexp_extract(text, {lit(P.FIRST_LINE_RE)}, 0), {lit(P.FIRST_MAGIC_RE)}, 1)) IN ('', 'python') THEN 'python'
    ELSE lower(regexp_extract(regexp_extract(text, {lit(P.FIRST_LINE_RE)}, 0), {lit(P.FIRST_MAGIC_RE)}, 1)) END"""
_unmagic = rr("text", P.MAGIC_PREFIX_RE, "''")
_code = f"""CASE WHEN language = 'sql' THEN {rr(rr(_unmagic, P.SQL_MARKER_RE, "''"), P.EDGE_SPACE_RE, "''")}
    WHEN regexp_extract(text, {lit(P.FIRST_MAGIC_RE)}, 1) <> '' THEN {rr(rr(_unmagic, P.LANG_MARKER_RE, "''"), P.EDGE_SPACE_RE, "''")}
    ELSE text END"""
cte("cell_texts", ["chunks"], """
  SELECT asset_type, asset_path, CAST(unnest(generate_series(0, len(texts) - 1)) AS INTEGER) AS cell_index,
         unnest(texts) AS text
  FROM chunks""")
cte("cell_lang", ["cell_texts"], f"""
  SELECT asset_type, asset_path, cell_index, text, {_lang} AS language FROM cell_texts""")
cte("cells", ["cell_lang"], f"""
  SELECT asset_type, asset_path, cell_index, language, {_code} AS code FROM cell_lang""")
cte("dash_cells", ["dashboards"], """
  SELECT asset_type, asset_path, CAST(unnest(generate_series(0, len(queries) - 1)) AS INTEGER) AS cell_index,
         'sql' AS language, unnest(queries) AS code
  FROM dashboards""")

# ---- extraction (E1-E10, lexical Python) ----------------------------------- #
# Of the estate: what the generator's forms refer to, by construction; nothing is read from the texts.
_refs_of = by_form("o_orderkey", lambda v, i: "[" + ", ".join(
    f"{{'kind': {lit(kind)}, 'slot': {lit(slot)}, 'cell': {ES.slot_cell(v, i, slot)}, 'lexical': {str((v, i) not in ES.CONCATENATED_FORMS).lower()}}}"
    for kind, slot in ES.form_references(v, i)) + "]" if ES.form_references(v, i) else "[]")
_slot_value = "CASE r.slot " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in slots("(o_custkey % 30)", "o_custkey").items()) + " ELSE '' END"
cte("refs_stated", [], f"""
  SELECT 'notebook' AS asset_type, asset_path, CAST(r.cell AS INTEGER) AS cell_index, o_orderkey % 8 AS v, r.lexical AS lexical,
         r.kind AS reference_kind, {_slot_value} AS original_reference
  FROM (SELECT o_orderkey, o_custkey, '/estate/p' || (o_orderkey % 10) || '/nb_' || o_orderkey AS asset_path,
               unnest({_refs_of}) AS r FROM orders)""")
_REF = "asset_type, asset_path, cell_index, reference_kind, original_reference"
cte("refs_sql", ["refs_stated"], f"SELECT {_REF} FROM refs_stated WHERE v = 1")
cte("refs_py", ["refs_stated"], f"SELECT {_REF} FROM refs_stated WHERE v <> 1")
cte("refs_py_lexical", ["refs_stated"], f"SELECT {_REF} FROM refs_stated WHERE v <> 1 AND lexical")
cte("refs_dash", [], """
  SELECT 'dashboard' AS asset_type, '/estate/dashboards/d_' || s_suppkey AS asset_path, cell_index, 'dashboard_query' AS reference_kind, original_reference
  FROM (SELECT s_suppkey, CAST(0 AS INTEGER) AS cell_index, 'db_' || s_nationkey || '.t_' || s_suppkey AS original_reference FROM supplier
        UNION ALL SELECT s_suppkey, CAST(1 AS INTEGER), 'db_' || s_nationkey || '.t_' || (s_suppkey % 7) FROM supplier
        UNION ALL SELECT s_suppkey, CAST(1 AS INTEGER), 'db_' || s_nationkey || '.calendar' FROM supplier)""")

# Of other texts (prose): patterns, as an approximation of its own.
cte("text_refs_sql", ["cells"], f"""
  SELECT asset_type, asset_path, cell_index, 'sql_table_ref' AS reference_kind, original_reference
  FROM (SELECT asset_type, asset_path, cell_index, unnest({sql_names('code')}) AS original_reference
        FROM cells WHERE language = 'sql')
  WHERE {keep_name('original_reference')}""")
_py_sql_texts = (f"list_concat(list_concat(regexp_extract_all(code, {lit(P.PY_SQL_CALL_DQ_RE)}, 1), "
                 f"regexp_extract_all(code, {lit(P.PY_SQL_CALL_SQ_RE)}, 1)), "
                 f"regexp_extract_all(code, {lit(P.PY_SQL_CALL_TDQ_RE)}, 1))")
_lit_body = rr("l", P.QUOTES_RE, "''")
cte("py_cells", ["cells"], "SELECT * FROM cells WHERE language = 'python'")
cte("text_refs_py", ["py_cells"], f"""
  SELECT asset_type, asset_path, cell_index, 'py_table_ref' AS reference_kind, o AS original_reference
  FROM (SELECT asset_type, asset_path, cell_index,
               unnest(regexp_extract_all(code, {lit(P.PY_TABLE_CALL_RE)}, 1)) AS o FROM py_cells)
  WHERE contains(o, '.') AND {mount_prefix('o')} = '' AND {keep_name('o')}
  UNION ALL
  SELECT asset_type, asset_path, cell_index, 'py_table_ref', o
  FROM (SELECT asset_type, asset_path, cell_index, unnest({sql_names('s')}) AS o
        FROM (SELECT asset_type, asset_path, cell_index, unnest({_py_sql_texts}) AS s FROM py_cells))
  WHERE {keep_name('o')}
  UNION ALL
  SELECT asset_type, asset_path, cell_index, 'dynamic_table', {rr('o', r"\s+\z", "''")}
  FROM (SELECT asset_type, asset_path, cell_index,
               unnest(regexp_extract_all(code, {lit(P.PY_DYNAMIC_CALL_RE)}, 1)) AS o FROM py_cells)
  UNION ALL
  SELECT asset_type, asset_path, cell_index, 'mount_path_literal', {_lit_body}
  FROM (SELECT asset_type, asset_path, cell_index,
               unnest(regexp_extract_all(code, {lit(P.PY_LITERAL_RE)}, 0)) AS l FROM py_cells)
  WHERE NOT starts_with(l, '#') AND regexp_matches(l, {lit(P.PLAIN_STRING_HEAD_RE)})
        AND {mount_prefix(_lit_body)} <> ''
  UNION ALL
  SELECT asset_type, asset_path, cell_index, 'dynamic_mount', l
  FROM (SELECT asset_type, asset_path, cell_index,
               unnest(regexp_extract_all(code, {lit(P.PY_LITERAL_RE)}, 0)) AS l FROM py_cells)
  WHERE NOT starts_with(l, '#') AND regexp_matches(l, {lit(P.FSTRING_HEAD_RE)})
        AND contains({rr(_lit_body, P.FSTRING_FIELD_RE, "''")}, '/mnt/')""")
cte("text_refs_other", ["cells"], f"""
  SELECT asset_type, asset_path, cell_index, '{S.KIND_UNPARSED}' AS reference_kind, '' AS original_reference
  FROM cells WHERE language NOT IN ('python', 'sql', 'md', 'md-sandbox', 'markdown')
    AND regexp_matches(code, {lit(P.PY_PREFILTER_RE)})""")
cte("refs_all", ["refs_stated", "refs_dash"], f"SELECT {_REF} FROM refs_stated UNION ALL SELECT {_REF} FROM refs_dash")
cte("refs", ["refs_all"], """
  SELECT asset_type, asset_path, cell_index, reference_kind, original_reference,
         CAST(count(*) AS INTEGER) AS occurrences
  FROM refs_all GROUP BY ALL""")

# ---- lookups and resolution (R1-R10, V12) ----------------------------------- #
def lookups(mapping: str = "mapping", mounts: str = "mounts") -> None:
    sfx = "" if (mapping, mounts) == ("mapping", "mounts") else f"_{mapping}_{mounts}"
    tgt = "concat_ws('.', uc_catalog, uc_schema, uc_table)"
    cte(f"tl{sfx}", [mapping], f"""
  SELECT lower(hms_namespace) AS _ns, lower(hms_table) AS _tbl,
         CASE WHEN count(DISTINCT {tgt}) = 1 THEN min({tgt}) END AS t_target,
         count(DISTINCT {tgt}) > 1 AS t_ambiguous
  FROM {mapping}
  WHERE coalesce(hms_namespace, '') <> '' AND coalesce(hms_table, '') <> '' AND coalesce(uc_table, '') <> ''
  GROUP BY 1, 2""")
    pair = "coalesce(uc_catalog, '') || chr(1) || uc_schema"
    cte(f"nl{sfx}", [mapping], f"""
  SELECT lower(hms_namespace) AS _lk_ns,
         CASE WHEN count(DISTINCT {pair}) = 1 THEN min(coalesce(uc_catalog, '')) END AS ns_catalog,
         CASE WHEN count(DISTINCT {pair}) = 1 THEN min(uc_schema) END AS ns_schema,
         count(DISTINCT {pair}) > 1 AS ns_ambiguous
  FROM {mapping}
  WHERE coalesce(hms_namespace, '') <> '' AND coalesce(uc_schema, '') <> ''
  GROUP BY 1""")
    cte(f"ml{sfx}", [mounts], f"""
  SELECT mount_path AS _mnt,
         CASE WHEN count(DISTINCT coalesce(hms_namespace, '')) = 1 THEN min(coalesce(hms_namespace, '')) END AS m_namespace,
         count(DISTINCT coalesce(hms_namespace, '')) > 1 AS m_ambiguous
  FROM {mounts} WHERE coalesce(mount_path, '') <> '' GROUP BY 1""")


lookups()
lookups("mapping_dups", "mounts")


def resolved_cte(name: str, refs: str, mapping: str = "mapping", mounts: str = "mounts") -> None:
    sfx = "" if (mapping, mounts) == ("mapping", "mounts") else f"_{mapping}_{mounts}"
    tl, nl, ml = f"tl{sfx}", f"nl{sfx}", f"ml{sfx}"
    kinds = ", ".join(lit(k) for k in S.TABLE_KINDS)
    has_mounts = f"(EXISTS (SELECT 1 FROM {mounts}))"
    vol = (f"'{S.VOLUME_ROOT}/' || ns_catalog || '/' || ns_schema || '/' || "
           f"replace(string_split(_mnt, '/')[-1], '-', '_') || "
           f"substring(regexp_replace(original_reference, '^dbfs:', ''), length(_mnt) + 1)")
    cte(name, [refs, tl, nl, ml, mounts], f"""
  SELECT r.*,
    CASE WHEN is_table AND t_target IS NOT NULL THEN t_target
         WHEN is_table AND NOT coalesce(t_ambiguous, false) AND ns_schema IS NOT NULL
           THEN concat_ws('.', ns_catalog, ns_schema, table_name)
         WHEN is_mount AND ns_schema IS NOT NULL THEN {vol} END AS proposed_replacement,
    CAST(CASE WHEN is_table AND t_target IS NOT NULL THEN {S.SCORE_EXACT_TABLE}
         WHEN is_table AND NOT coalesce(t_ambiguous, false) AND ns_schema IS NOT NULL THEN {S.SCORE_NAMESPACE_ONLY}
         WHEN is_mount AND ns_schema IS NOT NULL THEN {S.SCORE_MOUNT_LITERAL}
         WHEN reference_kind = 'dynamic_mount' THEN CASE WHEN {has_mounts} THEN {S.SCORE_DYNAMIC_MOUNT} ELSE {S.SCORE_UNRESOLVED} END
         WHEN reference_kind = 'dynamic_table' THEN {S.SCORE_DYNAMIC_TABLE}
         ELSE {S.SCORE_UNRESOLVED} END AS DOUBLE) AS confidence,
    CASE WHEN is_table AND t_target IS NOT NULL THEN 'exact mapping hit'
         WHEN is_table AND coalesce(t_ambiguous, false) THEN 'ambiguous: table maps to several targets'
         WHEN is_table AND ns_schema IS NOT NULL THEN 'namespace known, table not mapped'
         WHEN is_table AND coalesce(ns_ambiguous, false) THEN 'ambiguous: namespace maps to several schemas'
         WHEN is_table THEN 'unknown namespace'
         WHEN is_mount AND ns_schema IS NOT NULL THEN 'mount resolved through registry and mapping'
         WHEN is_mount AND coalesce(m_ambiguous, false) THEN 'ambiguous: mount has several namespaces'
         WHEN is_mount AND m_namespace IS NULL THEN 'mount not registered'
         WHEN is_mount AND m_namespace = '' THEN 'mount has no namespace'
         WHEN is_mount AND coalesce(ns_ambiguous, false) THEN 'ambiguous: namespace maps to several schemas'
         WHEN is_mount THEN 'mount namespace not mapped'
         WHEN reference_kind = 'dynamic_mount' THEN CASE WHEN {has_mounts}
              THEN 'mount path built at run time; registry has candidates'
              ELSE 'mount path built at run time; registry empty' END
         WHEN reference_kind = 'dynamic_table' THEN 'table name built at run time'
         WHEN reference_kind = '{S.KIND_UNPARSED}' THEN 'cell could not be parsed'
         ELSE 'no rule matched' END AS reason,
    md5(concat_ws(':', asset_path, CAST(cell_index AS VARCHAR), original_reference)) AS manifest_id
  FROM (
    SELECT x.*, t.t_target, t.t_ambiguous, n.ns_catalog, n.ns_schema, n.ns_ambiguous, m.m_namespace, m.m_ambiguous
    FROM (SELECT *,
            reference_kind IN ({kinds}) AS is_table,
            reference_kind = 'mount_path_literal' AS is_mount,
            CASE WHEN reference_kind IN ({kinds}) THEN {name_ns('original_reference')} END AS namespace,
            CASE WHEN reference_kind IN ({kinds}) THEN {name_tbl('original_reference')} END AS table_name,
            CASE WHEN reference_kind = 'mount_path_literal' THEN coalesce(
              (SELECT max_by(_mnt, length(_mnt)) FROM {ml} w WHERE starts_with(replace(original_reference, 'dbfs:', '') || '/', w._mnt || '/')),
              {mount_prefix('original_reference')}) END AS _mnt
          FROM {refs}) x
    LEFT JOIN {ml} m ON x._mnt = m._mnt
    LEFT JOIN {nl} n ON n._lk_ns = CASE WHEN x.is_table THEN lower(x.namespace)
                                        WHEN x.is_mount THEN lower(nullif(m.m_namespace, '')) END
    LEFT JOIN {tl} t ON x.is_table AND t._ns = lower(x.namespace) AND t._tbl = lower(x.table_name)
  ) r""")


resolved_cte("resolved", "refs")
cte("manifest", ["resolved"], f"""
  SELECT manifest_id, asset_type, asset_path, cell_index, original_reference, reference_kind,
         proposed_replacement, confidence, 'proposed' AS status, CAST(NULL AS VARCHAR) AS final_replacement,
         CAST(NULL AS VARCHAR) AS reviewer, CAST(NULL AS TIMESTAMP) AS reviewed_at,
         CAST(NULL AS TIMESTAMP) AS applied_at, CAST(NULL AS VARCHAR) AS backup_path,
         TIMESTAMP '{AS_OF}' AS scanned_at, occurrences, reason, CAST(NULL AS VARCHAR) AS decision
  FROM resolved""")


def with_ctes(needed: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{select}"


TIER_SQL = (f"CASE WHEN confidence >= {S.TIER_SIMPLE_MIN} THEN 'simple' "
            f"WHEN confidence >= {S.TIER_COMPLEX_MIN} THEN 'complex' ELSE 'very_complex' END")
TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def ts_str(col: str) -> str:
    return f"strftime({col}, {TS_FMT})"
