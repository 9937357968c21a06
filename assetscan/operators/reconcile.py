"""Reconcile migrated tables against their sources.

Tables are inputs by name: a `catalog` maps a table name to a DataFrame (by default
`spark.table`). Every distinct table is counted once, however many names lead to it: names become rows
(name, table number), statistics rows (table number, count, columns), and the two meet in a join. A count without a
filter reads the files' footers only. A name that cannot be read gives NULL statistics and the pair is `unverifiable`
(fix 24): a missing table is reported, not silently left out of the totals.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

Catalog = Callable[[str], DataFrame]
STATS_BATCH = 20_000          # names looked up and written at a time
TABLES_BATCH = 100            # tables counted in one job


# Kinds whose final replacement names a table; a dynamic one may be a quoted literal.
NAMING_KINDS = S.TABLE_KINDS + ("dynamic_table",)


def target_name(final: Column) -> Column:
    """A final replacement without the quotes of a string literal."""
    return F.regexp_replace(F.trim(final), r"^[\"']|[\"']$", "")


def reconcile_targets(manifest: DataFrame, target_schema: str | None = S.TARGET_SCHEMA_DEFAULT) -> DataFrame:
    """Distinct final targets of applied rows; with `target_schema`, only 3-part
    names whose schema part equals it (equality on the split name, so `_` is not a
    LIKE wildcard). None keeps every 3-part name."""
    target = target_name(F.col("final_replacement"))
    parts = F.split(target, r"\.")
    keep = ((F.col("status") == "applied") & F.col("reference_kind").isin(*NAMING_KINDS)
            & target.rlike(r"^[\w`-]+\.[\w`-]+\.[\w`-]+$"))
    if target_schema is not None:
        keep = keep & (F.element_at(parts, 2) == target_schema)
    return manifest.filter(keep).select(target.alias("target")).distinct()


def pair_by_convention(targets: DataFrame, source_base: str) -> DataFrame:
    """Q1: target `cat.sch.t` pairs with `<source_base>.src_<t>` (the reference's demo
    convention; any other pairing is a DataFrame of (target, source))."""
    name = F.element_at(F.split(F.col("target"), r"\."), -1)
    return targets.select("target", F.concat(F.lit(source_base + "." + S.SOURCE_TABLE_PREFIX), name)
                          .alias("source"))


STATS_SCHEMA = "table_name string, row_count bigint, columns array<string>, column_types array<string>"
NAMED = "table_name string, table_number bigint"
COUNTED = "table_number bigint, row_count bigint, columns array<string>, column_types array<string>"


class _Tables:
    """The distinct tables met so far. A DataFrame the catalog returns again, or one with the same plan, is the same table."""

    def __init__(self, read: Catalog):
        self.read = read
        self.by_id: dict[int, tuple[DataFrame, int]] = {}
        self.by_plan: dict[int, list[tuple[DataFrame, int]]] = {}
        self.size = 0

    def number(self, name: str) -> tuple[int | None, DataFrame | None]:
        """(table number or None when unreadable, the DataFrame when it is met for the first time)."""
        try:
            df = self.read(name)
            df.schema
        except (AnalysisException, KeyError):              # no such table -> unverifiable
            return None, None
        if id(df) in self.by_id:
            return self.by_id[id(df)][1], None
        same = self.by_plan.setdefault(df.semanticHash(), [])
        known = next((n for other, n in same if other.schema == df.schema and other.sameSemantics(df)), None)
        if known is None:
            known, self.size = self.size, self.size + 1
            same.append((df, known))
            self.by_id[id(df)] = (df, known)               # kept, so the id stays its own
            return known, df
        return known, None


def _batch_stats(spark: SparkSession, names: list[str], tables: _Tables) -> tuple[list[tuple], list[tuple[int, DataFrame]]]:
    """(name, table number) of a batch of names, and the tables that no batch before it had."""
    rows, new = [], []
    for name in names:
        number, df = tables.number(name)
        rows.append((name, number))
        if df is not None:
            new.append((number, df))
    return rows, new


def _counted(spark: SparkSession, batch: list[tuple[int, DataFrame]]) -> DataFrame:
    """One row per table: its count and its columns by name."""
    out = None
    for number, df in batch:
        fields = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(number).cast("bigint").alias("table_number"), "row_count",
            F.array(*[F.lit(n) for n, _ in fields]).cast("array<string>").alias("columns"),
            F.array(*[F.lit(f"{n}:{t}") for n, t in fields]).cast("array<string>").alias("column_types"))
        out = one if out is None else out.unionByName(one)
    return out


def table_stats(spark: SparkSession, names: Iterable[str] | DataFrame, catalog: Catalog | None = None) -> DataFrame:
    """Q2 + Q3: (table_name, row_count, columns, column_types) for each distinct name; NULL when
    the table does not exist.

    Names come in batches of STATS_BATCH (from a one-column DataFrame partition by partition) and are appended to
    a table of names; new tables are counted STATS_BATCH to a job and appended to a table of statistics. So the driver
    holds a batch of names and the distinct tables' plans, and the plan returned is one join whatever the number of names."""
    from ..session import ensure_checkpoint_dir
    if isinstance(names, DataFrame):
        rows = names.distinct().toLocalIterator()
        names = (r[0] for r in rows)
    else:
        names = iter(sorted(set(names)))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/assetscan-table-stats-{uuid.uuid4().hex}"
    named, counted = f"{root}/names", f"{root}/tables"
    tables = _Tables(catalog or spark.table)
    waiting: list[tuple[int, DataFrame]] = []
    spark.createDataFrame([], NAMED).write.mode("ignore").parquet(named)
    spark.createDataFrame([], COUNTED).write.mode("ignore").parquet(counted)
    while batch := list(islice(names, STATS_BATCH)):
        found, new = _batch_stats(spark, batch, tables)
        spark.createDataFrame(found, NAMED).coalesce(1).write.mode("append").parquet(named)
        waiting += new
        while len(waiting) >= TABLES_BATCH:
            _counted(spark, waiting[:TABLES_BATCH]).write.mode("append").parquet(counted)
            waiting = waiting[TABLES_BATCH:]
    if waiting:
        _counted(spark, waiting).write.mode("append").parquet(counted)
    by_name = spark.read.schema(NAMED).parquet(named)
    return by_name.join(spark.read.schema(COUNTED).parquet(counted), "table_number", "left").select(
        "table_name", "row_count", "columns", "column_types")


def reconcile(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Q4 + Q5: per pair, match = equal counts and equal column-name sets; a pair with an
    unreadable side is `unverifiable`. Types are reported beside the result (Q3 compares
    names only)."""
    s = stats.select(F.col("table_name").alias("source"), F.col("row_count").alias("source_rows"),
                     F.col("columns").alias("source_columns"), F.col("column_types").alias("source_types"))
    t = stats.select(F.col("table_name").alias("target"), F.col("row_count").alias("target_rows"),
                     F.col("columns").alias("target_columns"), F.col("column_types").alias("target_types"))
    j = pairs.join(s, "source", "left").join(t, "target", "left")
    readable = F.col("source_rows").isNotNull() & F.col("target_rows").isNotNull()
    counts_ok = F.col("source_rows") == F.col("target_rows")
    cols_ok = F.col("source_columns") == F.col("target_columns")
    return j.select(
        "target", "source", "source_rows", "target_rows",
        F.array_join("source_columns", ",").alias("source_columns"),
        F.array_join("target_columns", ",").alias("target_columns"),
        F.when(readable, counts_ok).alias("counts_match"),
        F.when(readable, cols_ok).alias("columns_match"),
        F.when(readable, F.col("source_types") == F.col("target_types")).alias("types_match"),
        F.when(~readable, F.lit("unverifiable")).when(counts_ok & cols_ok, F.lit("match"))
        .otherwise(F.lit("mismatch")).alias("result"))


def _mismatched(results: DataFrame) -> DataFrame:
    return results.filter(F.col("result") == "mismatch").select(F.col("target").alias("_t")).distinct()


def failing_rows(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """The applied rows whose final target mismatched."""
    named = manifest.filter((F.col("status") == "applied") & F.col("reference_kind").isin(*NAMING_KINDS))
    return named.join(_mismatched(results), target_name(F.col("final_replacement")) == F.col("_t"), "left_semi")


def mark_failed(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Q6: applied rows whose final target mismatched become 'failed'."""
    bad = _mismatched(results).withColumn("_bad", F.lit(True))
    j = manifest.join(bad, target_name(manifest["final_replacement"]) == bad["_t"], "left")
    hit = (F.col("status") == "applied") & F.col("reference_kind").isin(*NAMING_KINDS) & F.coalesce(F.col("_bad"), F.lit(False))
    return j.select(*[F.when(hit, F.lit("failed")).otherwise(F.col(c)).alias(c) if c == "status"
                      else F.col(c) for c in manifest.columns])


def reconcile_totals(results: DataFrame) -> DataFrame:
    """Q7: matched / reconciled / failed, plus unverifiable (fix 24)."""
    r = F.col("result")
    return results.agg(
        F.count(F.when(r == "match", 1)).alias("tables_matched"),
        F.count(F.when(r != "unverifiable", 1)).alias("tables_reconciled"),
        F.count(F.when(r == "mismatch", 1)).alias("tables_failed"),
        F.count(F.when(r == "unverifiable", 1)).alias("tables_unverifiable"))
