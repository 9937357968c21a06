"""Fixed values, enumerations, StructTypes and the legal status moves."""
from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------- #
# FIXED VALUES: these must equal the reference's for right results.
# Scores, tier thresholds, the notebook header, the cell separator, the mount
# prefix pattern, the legacy catalog name, enumerations and default names.
# --------------------------------------------------------------------------- #
SCORE_EXACT_TABLE = 0.95        # static table ref, exact mapping hit
SCORE_MOUNT_LITERAL = 0.90      # static mount literal resolvable via registry + mapping
SCORE_DYNAMIC_MOUNT = 0.70      # dynamic mount, registry non-empty
SCORE_NAMESPACE_ONLY = 0.60     # namespace known, table not mapped
SCORE_DYNAMIC_TABLE = 0.30      # table name built at run time
SCORE_UNRESOLVED = 0.20         # no mapping hit / unknown namespace / anything else
TIER_SIMPLE_MIN = 0.85
TIER_COMPLEX_MIN = 0.45
TIER_SIMPLE = "simple"
TIER_COMPLEX = "complex"
TIER_VERY_COMPLEX = "very_complex"

NOTEBOOK_HEADER = "# Databricks notebook source"
CELL_SEPARATOR = "\n\n# COMMAND ----------\n\n"     # what the seed writes between cells
LEGACY_CATALOG = "hive_metastore"
VOLUME_ROOT = "/Volumes"
TARGET_SCHEMA_DEFAULT = "uc_migration_target"
SOURCE_TABLE_PREFIX = "src_"

STATUSES = ("proposed", "approved", "overridden", "skipped", "applied", "failed")
# Ours adds one kind: a code cell that could not be read (never skipped silently).
KIND_UNPARSED = "unparsed_cell"

# Status machine. The reference's diagram, plus restore (applied -> the stored decision).
LEGAL_MOVES = (
    ("proposed", "approved"),
    ("proposed", "overridden"),
    ("proposed", "skipped"),
    ("approved", "applied"),
    ("overridden", "applied"),
    ("applied", "failed"),
    ("applied", "approved"),     # restore of an approved row
    ("applied", "overridden"),   # restore of an overridden row
    ("failed", "approved"),
    ("failed", "overridden"),
)
REVIEW_DECISIONS = ("approved", "overridden", "skipped")
# --------------------------------------------------------------------------- #

TABLE_KINDS = ("sql_table_ref", "py_table_ref", "dashboard_query")

MAPPING = T.StructType([
    T.StructField("hms_namespace", T.StringType()),
    T.StructField("hms_table", T.StringType()),
    T.StructField("uc_catalog", T.StringType()),
    T.StructField("uc_schema", T.StringType()),
    T.StructField("uc_table", T.StringType()),
    T.StructField("mount_path", T.StringType()),
    T.StructField("notes", T.StringType()),
])

MOUNTS = T.StructType([
    T.StructField("mount_path", T.StringType()),
    T.StructField("adls_target", T.StringType()),
    T.StructField("hms_namespace", T.StringType()),
    T.StructField("discovered_at", T.TimestampType()),
])

INVENTORY = T.StructType([
    T.StructField("asset_type", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("hms_ref_count", T.IntegerType()),
    T.StructField("seeded_at", T.TimestampType()),
])

ASSETS = T.StructType([
    T.StructField("asset_type", T.StringType()),
    T.StructField("asset_path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("queries", T.ArrayType(T.StringType())),
])

MANIFEST = T.StructType([
    T.StructField("manifest_id", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("asset_path", T.StringType()),
    T.StructField("cell_index", T.IntegerType()),
    T.StructField("original_reference", T.StringType()),
    T.StructField("reference_kind", T.StringType()),
    T.StructField("proposed_replacement", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("final_replacement", T.StringType()),
    T.StructField("reviewer", T.StringType()),
    T.StructField("reviewed_at", T.TimestampType()),
    T.StructField("applied_at", T.TimestampType()),
    T.StructField("backup_path", T.StringType()),
    T.StructField("scanned_at", T.TimestampType()),
    # ours
    T.StructField("occurrences", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("decision", T.StringType()),
])

DECISIONS = T.StructType([
    T.StructField("manifest_id", T.StringType()),
    T.StructField("reference_kind", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("final_replacement", T.StringType()),
    T.StructField("reviewer", T.StringType()),
    T.StructField("reviewed_at", T.TimestampType()),
])

PATCHED = T.StructType([
    T.StructField("asset_path", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("stamp", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])

CONTROL_TABLES = {
    "hms_to_uc_mapping": MAPPING,
    "mount_point_registry": MOUNTS,
    "demo_asset_inventory": INVENTORY,
    "migration_manifest": MANIFEST,
}
