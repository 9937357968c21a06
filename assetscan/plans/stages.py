"""The five stages as jobs over a working directory of Parquet tables.

  <root>/mount_point_registry   S4
  <root>/demo_asset_inventory   S5 / S15
  <root>/migration_manifest     layered commits (S9, section 7.3)
  <root>/asset_fingerprints     content hashes at the last rescan (S1, S8)
  <root>/backups                S11, partitioned by stamp
  <root>/assets_patched         S12, one folder per Apply or restore; the last text of a path counts
  <root>/audit_decisions        S14, append-only
  <root>/audit_summary          S14, append-only

Stage 4 commits in a fixed order: backups, then patched text, then the manifest. A
crash between them leaves the manifest unchanged; a re-run works on the current text
(base plus what is patched), adds a snapshot of its own and replaces nothing that is
committed. With nothing left to apply it writes nothing.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as AU
from ..operators import manifest as M
from ..operators import reconcile as RC
from ..operators import review as RV
from ..operators import rewrite as RW
from ..sources import changes as CH
from ..sources import io as IO
from .partitioning import materialize
from .scan import scan_to_manifest


@dataclass
class Workdir:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def manifest(self) -> str:
        return self.path("migration_manifest")


def discover(spark: SparkSession, wd: Workdir, assets: DataFrame, listing: DataFrame | None,
             as_of: str) -> dict:
    """Stage 1: registry replaced from the mount listing (or the fallback), inventory
    backfilled with notebooks it does not list yet."""
    IO.create_control_tables(spark, wd.root)
    mounts = IO.discover_mounts(spark, listing)
    provenance = mounts.select("provenance").first()[0]
    registry = materialize(IO.registry_rows(mounts, as_of), "registry")
    IO.write_registry(registry, wd.path("mount_point_registry"))
    inventory = IO.read_control_table(spark, wd.path("demo_asset_inventory"), "demo_asset_inventory")
    backfill = IO.inventory_backfill(assets.filter(F.col("asset_type") == "notebook"), inventory, as_of)
    backfill.write.mode("append").parquet(wd.path("demo_asset_inventory"))
    return {"mount_provenance": provenance}


def scan(spark: SparkSession, wd: Workdir, assets: DataFrame, mapping: DataFrame, as_of: str) -> int:
    """Stage 2: scan the inventoried assets, upsert into the latest manifest, commit."""
    inventory = IO.read_control_table(spark, wd.path("demo_asset_inventory"), "demo_asset_inventory")
    in_scope = IO.notebooks_in_scope(assets, inventory).unionByName(
        assets.filter(F.col("asset_type") == "dashboard"))
    mounts = IO.read_control_table(spark, wd.path("mount_point_registry"), "mount_point_registry")
    fresh = scan_to_manifest(in_scope, mapping, mounts, as_of)
    fresh = materialize(fresh, "scan")
    return M.update(spark, wd.manifest, lambda current: M.upsert_rescan(current, fresh))


def rescan(spark: SparkSession, wd: Workdir, assets: DataFrame, mapping: DataFrame, as_of: str,
           now: DataFrame | None = None) -> tuple[int | None, DataFrame]:
    """Stage 2 for what is not as it was at the last (re)scan. Only new and changed assets are scanned; of deleted ones
    the proposed rows go and the reviewed ones stay; rows of a renamed asset move with it. `now` gives the
    fingerprints of `assets` when they are known from a listing. Returns (version or None, changes)."""
    root = wd.path("asset_fingerprints")
    now = materialize(CH.fingerprints(assets) if now is None else now, "fingerprints")
    changed = materialize(CH.changes(CH.read_fingerprints(spark, root), now), "changes")
    if changed.isEmpty():
        return None, changed
    mounts = IO.read_control_table(spark, wd.path("mount_point_registry"), "mount_point_registry")
    scanned = assets.join(changed.filter(F.col("change").isin("added", "changed")).select("asset_path"), "asset_path", "left_semi")
    fresh = materialize(scan_to_manifest(scanned, mapping, mounts, as_of), "rescan")
    moved = changed.filter("change = 'renamed'").select(F.col("old_path").alias("_old"), F.col("asset_path").alias("_new"))

    def change(current: DataFrame) -> DataFrame:
        rows = M.moved(current, moved)
        kept = rows.join(changed.filter("change = 'renamed'").select("asset_path"), "asset_path", "left_semi")
        rest = rows.join(changed.filter("change = 'renamed'").select("asset_path"), "asset_path", "left_anti")
        return M.conform(M.upsert_rescan(rest, fresh)).unionByName(M.conform(kept))

    version = M.update(spark, wd.manifest, change, lambda current: changed.select("asset_path").unionByName(
        changed.filter("old_path is not null").select(F.col("old_path").alias("asset_path"))))
    CH.write_fingerprints(now, root)
    return version, changed


def review(spark: SparkSession, wd: Workdir, reviewer: str, as_of: str,
           decisions: DataFrame | None = None) -> tuple[int, DataFrame]:
    """Stage 3: batch approve the high tier, apply reviewer decisions, commit.
    Returns (version, rejected decisions)."""
    rejects = spark.createDataFrame([], "manifest_id string")

    def touched(current: DataFrame) -> DataFrame:
        if decisions is None:
            return RV.batch_approvable(current).select("asset_path")
        given = decisions.select("manifest_id").distinct().withColumn("_given", F.lit(True))
        rows = current.select("manifest_id", "asset_path", RV.approvable().alias("_approvable"))
        return rows.join(given, "manifest_id", "left").filter("_approvable or _given").select("asset_path")

    def change(current: DataFrame) -> DataFrame:
        nonlocal rejects
        if decisions is None:
            return RV.batch_approve(current, reviewer, as_of)
        # written once: the next rows and the rejects both read it
        nxt = RV.batch_approve(materialize(current, "reviewed"), reviewer, as_of)
        nxt, refused = RV.apply_decisions(nxt, decisions)
        rejects = materialize(refused, "rejects")
        return nxt

    return M.update(spark, wd.manifest, change, touched), rejects


def apply(spark: SparkSession, wd: Workdir, assets: DataFrame, stamp: str, applied_at: str,
          backup_root: str | None = None) -> dict:
    """Stage 4: backups, patched snapshot, then the stamped manifest. `assets` are the base
    assets; earlier patches are read over them. A round that was cut off before its manifest was committed starts
    again from its backups, so its edits are found and stamped."""
    backup_root = backup_root or wd.path("backups")
    current = M.read_latest(spark, wd.manifest)
    ws = materialize(RW.work_set(current).select(*RW.EDIT_COLS), "work-set")
    maps, conflicts = RW.edit_maps(ws)
    now, patched = assets, IO.read_patched(spark, wd.path("assets_patched"))
    if patched is not None:                              # of the assets to edit only: no other text is looked up
        edited = maps.select("asset_path")
        now = IO.current_assets(assets.join(edited, "asset_path", "left_semi"), patched.join(edited, "asset_path", "left_semi"))
    kept = IO.read_backups(spark, backup_root) if IO.path_exists(spark, backup_root) else None
    if kept is not None:
        now = RW.before_cut_off_round(now, kept, current, stamp)
    rewritten = materialize(RW.rewrite_assets(now, maps), "rewritten")
    if rewritten.isEmpty():
        return {"version": M.latest_version(spark, wd.manifest), "references_applied": 0, "assets_applied": 0,
                "references_not_found": 0, "references_conflicting": 0}
    backups = RW.backups_of(rewritten, backup_root, stamp)
    IO.write_backups(backups, backup_root)
    IO.write_patched(rewritten.select("asset_path", "language", F.col("new_source").alias("source")),
                     wd.path("assets_patched"), stamp)
    outcome = materialize(RW.outcomes(ws, rewritten, conflicts), "outcomes")
    version = M.update(spark, wd.manifest, lambda rows: RW.stamp_applied(rows, outcome, applied_at, backup_root, stamp),
                       lambda rows: outcome.filter("outcome = 'applied'").select("asset_path"))
    totals = RW.apply_totals(outcome, rewritten).first().asDict()
    return {"version": version, **totals}


def restore(spark: SparkSession, wd: Workdir, backup_root: str | None = None, since: str | None = None) -> tuple[DataFrame, int]:
    """Assets as they were before Apply round `since` (by default before each asset's last round), written as the
    current text. Rows applied or failed in the rounds taken back go to their stored decision; rows of earlier rounds,
    whose edits are still in the text, stay as they are. Returns (restored assets, version)."""
    backup_root = backup_root or wd.path("backups")
    backups = IO.read_backups(spark, backup_root)
    restored = materialize(RW.restore_sources(backups, since), "restored")
    patched = IO.read_patched(spark, wd.path("assets_patched"))
    languages = patched.groupBy("asset_path").agg(F.max("language").alias("language"))
    stamp = patched.agg(F.max("stamp")).first()[0]
    IO.write_patched(restored.join(languages, "asset_path", "left"), wd.path("assets_patched"), stamp)
    rounds = backups if since is None else backups.filter(F.col("stamp") >= since)      # earlier rounds stay: their backups are not read
    version = M.update(spark, wd.manifest, lambda rows: RW.restore_manifest(rows, restored, rounds),
                       lambda rows: restored.select("asset_path"))
    return restored, version


def validate(spark: SparkSession, wd: Workdir, catalog, source_base: str,
             target_schema: str | None = None, as_of: str | None = None) -> dict:
    """Stage 5: reconcile applied targets, mark failures, commit, append the audit log."""
    current = materialize(M.read_latest(spark, wd.manifest), "validate-input")
    pairs = RC.pair_by_convention(RC.reconcile_targets(current, target_schema), source_base)
    names = pairs.select(F.explode(F.array("target", "source")).alias("name"))
    results = materialize(RC.reconcile(pairs, RC.table_stats(spark, names, catalog)), "reconcile")
    version = M.update(spark, wd.manifest, lambda rows: RC.mark_failed(rows, results),
                       lambda rows: RC.failing_rows(rows, results).select("asset_path"))
    latest = M.read_latest(spark, wd.manifest)
    entries = AU.decision_rows(latest)
    logged = IO.append_audit(entries, wd.path("audit_decisions"))
    summary = AU.summary(entries, results)
    summary.write.mode("append").parquet(wd.path("audit_summary"))
    return {"version": version, "newly_logged": logged, **summary.first().asDict(),
            "results": results}
