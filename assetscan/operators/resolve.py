"""Resolve references through the lookups, score, tier, identify.

Dict lookups of the reference become left equi-joins on lower-cased keys (fix 10); a key
that maps to several distinct targets gives no proposal and reason `ambiguous` (fix 11).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..functions import text as X


SPREAD_KEYS = 4096


def _nonempty(c: str) -> F.Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def table_lookup(mapping: DataFrame) -> DataFrame:
    """S6 tables: (lower ns, lower table) -> target `cat.sch.tbl`, or ambiguous."""
    target = F.concat_ws(".", "uc_catalog", "uc_schema", "uc_table")
    return (mapping.filter(_nonempty("hms_namespace") & _nonempty("hms_table") & _nonempty("uc_table"))
            .groupBy(F.lower("hms_namespace").alias("_ns"), F.lower("hms_table").alias("_tbl"))
            .agg(F.countDistinct(target).alias("_n"), F.min(target).alias("_t"))
            .select("_ns", "_tbl", F.when(F.col("_n") == 1, F.col("_t")).alias("t_target"),
                    (F.col("_n") > 1).alias("t_ambiguous")))


def namespace_lookup(mapping: DataFrame) -> DataFrame:
    """S6 namespaces: lower ns -> (catalog, schema), or ambiguous."""
    pair = F.struct(F.coalesce(F.col("uc_catalog"), F.lit("")).alias("c"), F.col("uc_schema").alias("s"))
    return (mapping.filter(_nonempty("hms_namespace") & _nonempty("uc_schema"))
            .groupBy(F.lower("hms_namespace").alias("_lk_ns"))
            .agg(F.countDistinct(pair).alias("_n"), F.min(pair).alias("_p"))
            .select("_lk_ns",
                    F.when(F.col("_n") == 1, F.col("_p.c")).alias("ns_catalog"),
                    F.when(F.col("_n") == 1, F.col("_p.s")).alias("ns_schema"),
                    (F.col("_n") > 1).alias("ns_ambiguous")))


def mount_lookup(mounts: DataFrame) -> DataFrame:
    """mount_path -> namespace ('' kept as unknown, fix 12), or ambiguous."""
    ns = F.coalesce(F.col("hms_namespace"), F.lit(""))
    return (mounts.filter(_nonempty("mount_path"))
            .groupBy(F.col("mount_path").alias("_mnt"))
            .agg(F.countDistinct(ns).alias("_n"), F.min(ns).alias("_m"))
            .select("_mnt", F.when(F.col("_n") == 1, F.col("_m")).alias("m_namespace"),
                    (F.col("_n") > 1).alias("m_ambiguous")))


def nearest_mount(refs: DataFrame, mounts: DataFrame, is_mount: F.Column, other_key: F.Column) -> DataFrame:
    """refs + _mnt, m_namespace, m_ambiguous: of the registered mounts that a path lies under, the longest (R4 with nested
    mounts); a path under none keeps its first component. Every folder of a path meets the registry in an equi-join
    and one row per reference is kept with the length of its longest registered folder (each folder has a length of its
    own): a number, so the rows are grouped by hash and never sorted, and rows that come grouped from the dedupe meet
    a broadcast registry without an exchange."""
    first = X.mount_prefix(F.col("original_reference"))
    folders = F.array_distinct(F.concat(F.array(first), X.mount_prefixes(F.col("original_reference"))))
    lookup = mount_lookup(mounts)
    r = refs.select("*", F.explode_outer(F.when(is_mount, folders).otherwise(F.array(other_key))).alias("_mnt"))
    r = r.join(lookup.select("_mnt", F.lit(True).alias("_known")), ["_mnt"], "left")
    best = r.groupBy(*refs.columns).agg(F.max(F.when(F.col("_known"), F.length("_mnt")).otherwise(0)).alias("_n"))
    path = F.regexp_replace(F.regexp_replace("original_reference", P.DBFS_SCHEME_RE, ""), "/+", "/")   # what folders are prefixes of
    mnt = F.when(is_mount, F.when(first != "", F.left(path, F.greatest(F.col("_n"), F.length(first))))).otherwise(other_key)
    return best.withColumn("_mnt", mnt).join(lookup, ["_mnt"], "left").select(*refs.columns, "_mnt", "m_namespace", "m_ambiguous")


def tier(conf: F.Column) -> F.Column:
    """R8."""
    return (F.when(conf >= S.TIER_SIMPLE_MIN, F.lit(S.TIER_SIMPLE))
            .when(conf >= S.TIER_COMPLEX_MIN, F.lit(S.TIER_COMPLEX))
            .otherwise(F.lit(S.TIER_VERY_COMPLEX)))


def manifest_id(path: F.Column, cell: F.Column, original: F.Column) -> F.Column:
    """md5 of `path:cell:original` (the reference's id)."""
    return F.md5(F.concat_ws(":", path, cell.cast("string"), original))


def resolve(refs: DataFrame, mapping: DataFrame, mounts: DataFrame) -> DataFrame:
    """refs(asset_type, asset_path, cell_index, reference_kind, original_reference[,
    occurrences]) -> + namespace, table_name, proposed_replacement, confidence, tier,
    reason, manifest_id.

    Lookups are grouped to one row per key and joined with plain equi-joins: the session's
    broadcast threshold and AQE choose between broadcast and shuffle, and split hot keys."""
    kind = F.col("reference_kind")
    orig = F.col("original_reference")
    is_table = kind.isin(*S.TABLE_KINDS)
    is_mount = kind == "mount_path_literal"
    ns, tbl, _ = X.name_parts(orig)
    # R6's test is a one-row subquery of the plan
    has_mounts = mounts.limit(1).agg(F.count(F.lit(1)) > 0).scalar()

    # Single pass, no branches: a row a lookup does not apply to carries a key that can
    # never match (it starts with \u0000) and is spread over many values, so neither a
    # NULL key nor a constant one piles rows into one partition when the join shuffles.
    spread_key = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("asset_path", "cell_index", orig),
                                                  F.lit(SPREAD_KEYS)).cast("string"))
    r = (nearest_mount(refs, mounts, is_mount, spread_key).withColumn("namespace", F.when(is_table, ns))
         .withColumn("table_name", F.when(is_table, tbl))
         .withColumn("_ns", F.when(is_table, F.lower(ns)).otherwise(spread_key))
         .withColumn("_tbl", F.when(is_table, F.lower(tbl)).otherwise(F.lit(""))))
    r = r.withColumn("_lk_ns", F.when(is_table, F.col("_ns"))
                     .when(is_mount & (F.coalesce(F.col("m_namespace"), F.lit("")) != ""),
                           F.lower(F.col("m_namespace")))
                     .otherwise(spread_key))
    r = r.join(namespace_lookup(mapping), ["_lk_ns"], "left")
    r = r.join(table_lookup(mapping), ["_ns", "_tbl"], "left")

    ns_ok = F.col("ns_schema").isNotNull()
    t_amb = F.coalesce(F.col("t_ambiguous"), F.lit(False))
    # R5 with fix 1: the sub-path is cut from the path without its dbfs: scheme.
    vol_name = F.translate(F.element_at(F.split(F.col("_mnt"), "/"), -1), "-", "_")
    rest = F.expr("substring(regexp_replace(original_reference, '^dbfs:', ''), length(_mnt) + 1)")
    volume = F.concat(F.lit(S.VOLUME_ROOT + "/"), F.col("ns_catalog"), F.lit("/"), F.col("ns_schema"),
                      F.lit("/"), vol_name, rest)

    proposal = (F.when(is_table & F.col("t_target").isNotNull(), F.col("t_target"))
                .when(is_table & ~t_amb & ns_ok,
                      F.concat_ws(".", F.col("ns_catalog"), F.col("ns_schema"), F.col("table_name")))
                .when(is_mount & ns_ok, volume))
    conf = (F.when(is_table & F.col("t_target").isNotNull(), F.lit(S.SCORE_EXACT_TABLE))
            .when(is_table & ~t_amb & ns_ok, F.lit(S.SCORE_NAMESPACE_ONLY))
            .when(is_mount & ns_ok, F.lit(S.SCORE_MOUNT_LITERAL))
            .when(kind == "dynamic_mount",
                  F.when(has_mounts, F.lit(S.SCORE_DYNAMIC_MOUNT)).otherwise(F.lit(S.SCORE_UNRESOLVED)))
            .when(kind == "dynamic_table", F.lit(S.SCORE_DYNAMIC_TABLE))
            .otherwise(F.lit(S.SCORE_UNRESOLVED)))
    reason = (F.when(is_table & F.col("t_target").isNotNull(), F.lit("exact mapping hit"))
              .when(is_table & t_amb, F.lit("ambiguous: table maps to several targets"))
              .when(is_table & ns_ok, F.lit("namespace known, table not mapped"))
              .when(is_table & F.coalesce(F.col("ns_ambiguous"), F.lit(False)),
                    F.lit("ambiguous: namespace maps to several schemas"))
              .when(is_table, F.lit("unknown namespace"))
              .when(is_mount & ns_ok, F.lit("mount resolved through registry and mapping"))
              .when(is_mount & F.coalesce(F.col("m_ambiguous"), F.lit(False)),
                    F.lit("ambiguous: mount has several namespaces"))
              .when(is_mount & F.col("m_namespace").isNull(), F.lit("mount not registered"))
              .when(is_mount & (F.col("m_namespace") == ""), F.lit("mount has no namespace"))
              .when(is_mount & F.coalesce(F.col("ns_ambiguous"), F.lit(False)),
                    F.lit("ambiguous: namespace maps to several schemas"))
              .when(is_mount, F.lit("mount namespace not mapped"))
              .when(kind == "dynamic_mount",
                    F.when(has_mounts, F.lit("mount path built at run time; registry has candidates"))
                    .otherwise(F.lit("mount path built at run time; registry empty")))
              .when(kind == "dynamic_table", F.lit("table name built at run time"))
              .when(kind == S.KIND_UNPARSED, F.lit("cell could not be parsed"))
              .otherwise(F.lit("no rule matched")))
    return r.select(*refs.columns, "namespace", "table_name",
                    proposal.alias("proposed_replacement"),
                    conf.cast("double").alias("confidence"),
                    tier(conf).alias("tier"),
                    reason.alias("reason"),
                    manifest_id(F.col("asset_path"), F.col("cell_index"), orig).alias("manifest_id"))
