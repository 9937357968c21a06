"""References found in cells.

SQL cells (and dashboard queries, and the SQL strings of `.sql("...")` calls) are read
natively by a fold over their tokens (`functions.sqltokens`): table names, mount paths given as locations, and
an unparsed_cell row beside them when the text could not be read to its end. Python cells are read by one `mapInArrow` job with the
stdlib `ast` module (`python_refs_syntax`) after a native prefilter; a fully native
lexical reading (`python_refs_lexical`) exists too, and is what SQL engines can repeat.

Every function returns rows of
  (asset_type, asset_path, cell_index INT, reference_kind, original_reference)
with duplicates kept (UNION ALL); `dedupe_references` groups them with `occurrences`.
"""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import patterns as P
from ..functions import sqltokens as Q
from ..functions import text as X
from ..functions.pysyntax import read_cell

REF_COLS = ["asset_type", "asset_path", "cell_index", "reference_kind", "original_reference"]
NON_CODE_LANGUAGES = ("md", "md-sandbox", "markdown")


def _sql_pairs(sql: F.Column, kind) -> F.Column:
    """E1 as (kind, text) pairs of a SQL text: tables of `kind`, mount paths, what could not be read."""
    def pairs(read: F.Column) -> F.Column:
        tables = F.filter(Q.table_names(read), lambda n: X.name_parts(n)[2])
        return F.concat(F.transform(tables, lambda n: _pair(kind, n)),
                        F.transform(Q.path_names(read), lambda p: _pair("mount_path_literal", p)),
                        F.when(read["unread"], F.array(_pair(S.KIND_UNPARSED, F.lit("")))).otherwise(F.array().cast(_PAIRS_TYPE)))
    return Q.bound(Q.read_sql(sql), pairs)


def sql_refs(cells: DataFrame) -> DataFrame:
    """References of SQL cells; tables of dashboard queries get kind dashboard_query."""
    return _refs_from_pairs(cells.filter(F.col("language") == "sql"), _sql_pairs(F.col("code"), _sql_kind(F.col("asset_type"))))


def _sql_kind(asset_type: F.Column) -> F.Column:
    return F.when(asset_type == "dashboard", F.lit("dashboard_query")).otherwise(F.lit("sql_table_ref"))


_SYNTAX_SCHEMA = T.StructType([
    T.StructField("asset_type", T.StringType()),
    T.StructField("asset_path", T.StringType()),
    T.StructField("cell_index", T.IntegerType()),
    T.StructField("node_kind", T.StringType()),
    T.StructField("text", T.StringType()),
])


PARSE_MARKER = "__parse_python__"


def _read_batches(batches):
    """Rows marked PARSE_MARKER carry a Python cell's code: parse it and emit its nodes.
    Every other row is a reference found natively and passes through unchanged."""
    for batch in batches:
        rows, kinds, texts = [], [], []
        for row, (kind, txt) in enumerate(zip(batch["node_kind"].to_pylist(), batch["text"].to_pylist())):
            found = read_cell(txt or "") if kind == PARSE_MARKER else [(kind, txt)]
            for k, t in found:
                rows.append(row)
                kinds.append(k)
                texts.append(t)
        taken = pa.array(rows, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch[c].take(taken) for c in ("asset_type", "asset_path", "cell_index")), pa.array(kinds, pa.string()), pa.array(texts, pa.string())],
            names=[f.name for f in _SYNTAX_SCHEMA])


def python_nodes(cells: DataFrame) -> DataFrame:
    """E-JOB alone: (asset_type, asset_path, cell_index, node_kind, text) of Python cells.

    Catalyst cannot push a filter through mapInArrow, so the native prefilter is written
    above it here: only cells that mention mnt / table / sql reach a Python worker."""
    candidates = (cells.filter((F.col("language") == "python") & F.col("code").rlike(P.PY_PREFILTER_RE))
                  .select("asset_type", "asset_path", "cell_index", F.lit(PARSE_MARKER).alias("node_kind"),
                          F.col("code").alias("text")))
    return candidates.mapInArrow(_read_batches, schema=_SYNTAX_SCHEMA)


def _refs_from_pairs(df: DataFrame, pairs: F.Column) -> DataFrame:
    """Explode an array<struct<kind, text>> column into reference rows in one pass.
    explode_outer + a filter on its output: a plain explode makes Catalyst infer a
    size(pairs) > 0 filter below it, which would evaluate the extraction twice."""
    return (df.select("asset_type", "asset_path", "cell_index", F.explode_outer(pairs).alias("p"))
            .filter(F.col("p").isNotNull())
            .select("asset_type", "asset_path", "cell_index",
                    F.col("p.kind").alias("reference_kind"), F.col("p.text").alias("original_reference")))


def _pair(kind, text: F.Column) -> F.Column:
    k = kind if not isinstance(kind, str) else F.lit(kind)
    return F.struct(k.alias("kind"), text.alias("text"))


def _refs_from_nodes(nodes: DataFrame) -> DataFrame:
    """Syntax-job output -> reference rows: `.sql("...")` strings are read by native E1
    (E4) in the same projection, a `.table("x")` without a 2-part name is dropped."""
    kind, text = F.col("node_kind"), F.col("text")
    pairs = (F.when(kind == "py_sql", _sql_pairs(text, "py_table_ref"))
             .when((kind == "py_table_ref") & ~X.name_parts(text)[2], F.array().cast(_PAIRS_TYPE))
             .otherwise(F.array(_pair(kind, text))))
    return _refs_from_pairs(nodes, pairs)


def python_refs_syntax(cells: DataFrame) -> DataFrame:
    """E3-E8 via the syntax job over the Python cells only."""
    return _refs_from_nodes(python_nodes(cells))


_PAIRS_TYPE = "array<struct<kind:string,text:string>>"


def python_refs_lexical(cells: DataFrame) -> DataFrame:
    """E3, E4, E5-E7 without a parser: regexes over Python cells, one projection and one
    explode. Matches inside comments and strings too; `python_refs_syntax` is exact."""
    return _refs_from_pairs(cells.filter(F.col("language") == "python"), _lexical_pairs(F.col("code")))


def _lexical_pairs(code: F.Column) -> F.Column:

    tables = F.filter(F.regexp_extract_all(code, X.rx(P.PY_TABLE_CALL_RE), F.lit(1)),
                      lambda o: o.contains(".") & (X.mount_prefix(o) == "") & X.name_parts(o)[2])
    sql_texts = F.concat(F.regexp_extract_all(code, X.rx(P.PY_SQL_CALL_DQ_RE), F.lit(1)),
                         F.regexp_extract_all(code, X.rx(P.PY_SQL_CALL_SQ_RE), F.lit(1)),
                         F.regexp_extract_all(code, X.rx(P.PY_SQL_CALL_TDQ_RE), F.lit(1)))
    from_sql = F.flatten(F.transform(sql_texts, lambda t: _sql_pairs(t, "py_table_ref")))
    dyn = F.transform(F.regexp_extract_all(code, X.rx(P.PY_DYNAMIC_CALL_RE), F.lit(1)),
                      lambda o: F.regexp_replace(o, X.rx(r"\s+\z"), F.lit("")))
    lits = X.python_literals(code)
    mounts = F.transform(F.filter(lits, lambda l: l.rlike(P.PLAIN_STRING_HEAD_RE)
                                  & (X.mount_prefix(X.literal_body(l)) != "")), X.literal_body)
    fmounts = F.filter(lits, lambda l: l.rlike(P.FSTRING_HEAD_RE) & F.regexp_replace(
        X.literal_body(l), X.rx(P.FSTRING_FIELD_RE), F.lit("")).contains("/mnt/"))
    return F.concat(F.transform(tables, lambda o: _pair("py_table_ref", o)),
                    from_sql,
                    F.transform(dyn, lambda o: _pair("dynamic_table", o)),
                    F.transform(mounts, lambda o: _pair("mount_path_literal", o)),
                    F.transform(fmounts, lambda o: _pair("dynamic_mount", o)))


def _native_pairs(cells_lang: F.Column, code: F.Column, asset_type: F.Column) -> F.Column:
    return (F.when(cells_lang == "sql", _sql_pairs(code, _sql_kind(asset_type)))
            .when(~cells_lang.isin("python", *NON_CODE_LANGUAGES) & code.rlike(P.PY_PREFILTER_RE),
                  F.array(_pair(S.KIND_UNPARSED, F.lit(""))))
            .otherwise(F.array().cast(_PAIRS_TYPE)))


def other_language_refs(cells: DataFrame) -> DataFrame:
    """Fix 5: a code cell in a language we do not read (scala, r, sh ...) that mentions
    mnt / table / sql gives one unparsed_cell row instead of nothing."""
    return (cells.filter(~F.col("language").isin("python", "sql", *NON_CODE_LANGUAGES)
                         & F.col("code").rlike(P.PY_PREFILTER_RE))
            .select("asset_type", "asset_path", "cell_index",
                    F.lit(S.KIND_UNPARSED).alias("reference_kind"),
                    F.lit("").alias("original_reference")))


def extract_references(cells: DataFrame, python: str = "syntax") -> DataFrame:
    """All kinds across cells, duplicates kept, in one pass over the cells.

    One projection gives each cell its native references (SQL names, unparsed marker,
    or the lexical Python reading) or, for a Python cell that passes the prefilter, one
    row asking the syntax job to parse it; one explode; then the syntax job parses those
    rows and passes the others through. Cells without references produce no rows, so
    they never cross into Python; and with no union over the cells, nothing upstream
    (reading, spreading, splitting) runs twice."""
    lang, code = F.col("language"), F.col("code")
    if python != "syntax":
        pairs = F.when(lang == "python", _lexical_pairs(code)).otherwise(
            _native_pairs(lang, code, F.col("asset_type")))
        return _refs_from_pairs(cells, pairs)
    parse = (lang == "python") & code.rlike(P.PY_PREFILTER_RE)
    pairs = F.when(parse, F.array(_pair(PARSE_MARKER, code))).otherwise(
        _native_pairs(lang, code, F.col("asset_type")))
    rows = _refs_from_pairs(cells, pairs).select(
        "asset_type", "asset_path", "cell_index", F.col("reference_kind").alias("node_kind"),
        F.col("original_reference").alias("text"))
    return _refs_from_nodes(rows.mapInArrow(_read_batches, schema=_SYNTAX_SCHEMA))


def dedupe_references(refs: DataFrame) -> DataFrame:
    """Fix 8: one row per (asset, cell, kind, original) with `occurrences`; the sum of
    occurrences equals the reference's row count. Partial aggregation runs map-side, so
    a hot asset or name is combined before the shuffle."""
    return (refs.groupBy(*REF_COLS)
            .agg(F.count(F.lit(1)).cast("int").alias("occurrences")))
