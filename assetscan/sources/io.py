"""Readers and writers: asset files, API exports, mounts, registry, inventory, control
tables, backups, patched snapshots, audit log.

Delta is not in this PySpark install, so control tables are Parquet directories; the
manifest is versioned (`assetscan.operators.manifest.commit`).
"""
from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

# --------------------------------------------------------------------------- #
# FIXED VALUES: the reference's fallback mount set, used when a live mount listing
# is unavailable or has no /mnt/ entries (mount path, storage target, namespace).
# --------------------------------------------------------------------------- #
FALLBACK_MOUNTS = [
    ("/mnt/sales-raw", "abfss://sales-raw@STORAGE_ACCOUNT.dfs.core.windows.net/", "sales_db"),
    ("/mnt/finance-raw", "abfss://finance-raw@STORAGE_ACCOUNT.dfs.core.windows.net/", "finance_db"),
    ("/mnt/risk-raw", "abfss://risk-raw@STORAGE_ACCOUNT.dfs.core.windows.net/", "risk_db"),
    ("/mnt/landing", "abfss://landing@STORAGE_ACCOUNT.dfs.core.windows.net/", "ops_db"),
]
# --------------------------------------------------------------------------- #

_EXT_LANGUAGE = {"py": "python", "sql": "sql", "scala": "scala", "r": "r"}


def read_asset_files(spark: SparkSession, root: str, files: list[str] | None = None) -> DataFrame:
    """S1 + S2: every file under `root` (recursively), or the given ones of them, as one asset row, whole text.

    asset_path = the path under `root` without extension; language from the extension.
    The listing of S1 is `.select("asset_path")` of this; no driver-side walk."""
    root = root.rstrip("/")
    raw = (spark.read.option("recursiveFileLookup", "true").text(literal_path(root), wholetext=True) if files is None
           else spark.read.text([literal_path(f) for f in files], wholetext=True))
    return asset_rows(raw.select(F.col("value").alias("source"), file_of_row().alias("_file")), root)


def literal_path(path: str) -> str:
    """A path for Spark's readers, which take [, {, * and ? as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def file_of_row() -> F.Column:
    """The path of the file a row was read from, as it is named (the metadata column has it URL-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def asset_path_of(file: F.Column, root: str) -> F.Column:
    """The path under `root`, without extension."""
    rel = F.regexp_replace(file, r"^.*?" + _escape(root.rstrip("/").split(":", 1)[-1]), "")
    return F.regexp_replace(rel, r"\.[A-Za-z]+$", "")


def asset_rows(raw: DataFrame, root: str) -> DataFrame:
    """Asset rows of files (source, _file) under `root`: path without extension, language by extension."""
    ext = F.lower(F.regexp_extract("_file", r"\.([A-Za-z]+)$", 1))
    lang_map = F.create_map(*[x for kv in _EXT_LANGUAGE.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    path = asset_path_of(F.col("_file"), root)
    return raw.select(
        F.lit("notebook").alias("asset_type"),
        path.alias("asset_path"),
        F.element_at(F.split(path, "/"), -1).alias("name"),
        F.coalesce(F.try_element_at(lang_map, ext), F.lit("python")).alias("language"),
        "source",
        F.lit(None).cast("array<string>").alias("queries"))


def _escape(s: str) -> str:
    return "".join("\\" + c if c in r".^$*+?()[]{}|\\" else c for c in s)


def decode_exports(df: DataFrame, content_col: str = "content") -> DataFrame:
    """S2 for API exports: base64 content -> UTF-8 `source`."""
    return df.withColumn("source", F.decode(F.unbase64(F.col(content_col)), "UTF-8")).drop(content_col)


def encode_for_import(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Inverse of S2 for systems that import base64 content."""
    return df.withColumn("content", F.base64(F.encode(F.col(source_col), "UTF-8")))


def discover_mounts(spark: SparkSession, listing: DataFrame | None) -> DataFrame:
    """S3: mount points from a listing (mount_point, source), `/mnt/` only, namespace ''
    (a live listing does not know it: fix 12 keeps that visible). Empty or missing
    listing -> the fallback set, with `provenance` saying which was used."""
    if listing is not None:
        live = (listing.filter(F.col("mount_point").startswith("/mnt/"))
                .select(F.col("mount_point").alias("mount_path"), F.col("source").alias("adls_target"),
                        F.lit("").alias("hms_namespace"), F.lit("listing").alias("provenance")))
        if len(live.take(1)) > 0:
            return live
    fb = spark.createDataFrame(FALLBACK_MOUNTS, "mount_path string, adls_target string, hms_namespace string")
    return fb.withColumn("provenance", F.lit("fallback (mount listing unavailable)"))


def registry_rows(mounts: DataFrame, as_of: str) -> DataFrame:
    """Registry rows stamped `discovered_at` (the whole registry is replaced)."""
    return mounts.select("mount_path", "adls_target", "hms_namespace",
                         F.to_timestamp(F.lit(as_of)).alias("discovered_at"))


def write_registry(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def inventory_backfill(found: DataFrame, inventory: DataFrame, as_of: str) -> DataFrame:
    """Found notebook paths missing from the inventory, as inventory rows (tier
    'unknown', count NULL). An anti join: the same rows when the inventory is empty,
    and later arrivals too."""
    return (found.select(F.col("asset_path").alias("path")).distinct()
            .join(inventory.select("path"), "path", "left_anti")
            .select(F.lit("notebook").alias("asset_type"), "path",
                    F.element_at(F.split("path", "/"), -1).alias("name"),
                    F.lit("unknown").alias("tier"), F.lit(None).cast("int").alias("hms_ref_count"),
                    F.to_timestamp(F.lit(as_of)).alias("seeded_at")))


def notebooks_in_scope(assets: DataFrame, inventory: DataFrame) -> DataFrame:
    """Assets whose path the inventory lists as a notebook (semi join; the filter
    on asset_type reaches the Parquet scan)."""
    nb = inventory.filter(F.col("asset_type") == "notebook").select(F.col("path").alias("asset_path"))
    return assets.join(nb, "asset_path", "left_semi")


def seed_inventory(notebooks: DataFrame, dashboards: DataFrame, as_of: str) -> DataFrame:
    """Inventory rows for notebooks (tier, expected count) and dashboards (count of
    queries), in one union."""
    ts = F.to_timestamp(F.lit(as_of))
    nb = notebooks.select(F.lit("notebook").alias("asset_type"), F.col("asset_path").alias("path"), "name",
                          "tier", F.col("hms_ref_count").cast("int"), ts.alias("seeded_at"))
    db = dashboards.select(F.lit("dashboard").alias("asset_type"), F.col("asset_path").alias("path"), "name",
                           "tier", F.size("queries").cast("int").alias("hms_ref_count"), ts.alias("seeded_at"))
    return nb.unionByName(db)


def create_control_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Empty control tables as Parquet directories under `root`; existing ones are
    left alone. Returns name -> path."""
    out = {}
    for name, schema in S.CONTROL_TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        table = f"{path}/version=0" if name == "migration_manifest" else path    # the manifest is versioned
        spark.createDataFrame([], schema).write.mode("ignore").parquet(table)
        out[name] = path
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_control_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(S.CONTROL_TABLES[name]).parquet(path)


def write_backups(backups: DataFrame, root: str) -> None:
    """Backups (asset_path, source, backup_path, stamp), partitioned by stamp and
    written before any patched text. A round's backup of an asset is written once and stays: a re-run of the round,
    which may find the text already patched, adds only the assets that have none."""
    spark = backups.sparkSession
    if path_exists(spark, root):
        kept = read_backups(spark, root).select("asset_path", "stamp")
        backups = backups.join(kept, ["asset_path", "stamp"], "left_anti")
    backups.write.mode("append").partitionBy("stamp").parquet(root)


def read_backups(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("asset_path string, source string, backup_path string, stamp string").parquet(root)


def write_patched(patched: DataFrame, root: str, stamp: str) -> None:
    """The patched texts of one Apply (asset_path, language, source), with each asset's own
    language kept (fix 22), as the snapshot of `stamp`. Every snapshot is a folder of its own,
    so a later run with the same stamp adds to what is committed and never replaces it."""
    snapshot = f"{root.rstrip('/')}/snapshot={stamp}-{uuid.uuid4().hex[:12]}"
    patched.select("asset_path", "language", "source", F.lit(stamp).alias("stamp"),
                   F.current_timestamp().alias("written_at")).write.mode("errorifexists").parquet(snapshot)


def read_patched(spark: SparkSession, root: str) -> DataFrame | None:
    """All patched texts, or None before the first Apply."""
    if not path_exists(spark, root):
        return None
    return spark.read.option("recursiveFileLookup", "true").schema(S.PATCHED).parquet(root)


def current_assets(assets: DataFrame, patched: DataFrame | None) -> DataFrame:
    """The assets as they are now: the base text, or the last patched one. Only stamps are
    aggregated; texts are joined once."""
    if patched is None:
        return assets
    at = F.struct("stamp", "written_at")
    last = patched.groupBy("asset_path").agg(F.max(at).alias("_at"))
    newest = (patched.withColumn("_at", at).join(last, ["asset_path", "_at"])
              .select("asset_path", F.col("source").alias("_source")).dropDuplicates(["asset_path"]))
    return assets.join(newest, "asset_path", "left").select(
        *[F.coalesce("_source", "source").alias("source") if c == "source" else F.col(c) for c in assets.columns])


def append_audit(entries: DataFrame, path: str) -> int:
    """Append only entries not logged before (idempotent re-runs). A log that exists but
    cannot be read is an error, not a first run."""
    from ..operators.audit import new_entries
    from ..plans.partitioning import materialize
    spark = entries.sparkSession
    if path_exists(spark, path):
        entries = new_entries(spark.read.schema(entries.schema).parquet(path), entries)
    fresh = materialize(entries, "audit")
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def write_asset_files(assets: DataFrame, root: str, extension: str = "py") -> None:
    """Each asset's text to `<root><asset_path>.<extension>`, written by the executors and committed as a whole
    (`sources.export`). `read_asset_files` reads it back."""
    from .export import export_assets
    export_assets(assets, root, extension)
