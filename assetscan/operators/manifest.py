"""S9 and section 7.3: manifest rows, versioned commits of what changed, rescan upsert.

Parquet tables take no UPDATE or MERGE in Spark, so every status change is a pure
function from manifest rows to the next, and `update` commits it:

  <root>/version=N-<id>/      rows a commit wrote: all rows of the asset paths it covers
  <root>/paths=N-<id>/        those paths (a commit of the whole manifest has none)
  <root>/commits/<N>.json     the layers that make up version N, oldest first

A version is its layers laid over one another: a path's rows are those of the last layer that covers it. So a commit
writes the rows of the paths it changes, not the manifest; after `MAX_LAYERS` a commit writes everything anew. The
commit file is created exclusively: of two writers that start from one version one gets the next number, the other
reads what was committed and computes its change again. A crash leaves folders that no commit file names. Nothing
that is being read is ever overwritten, and written tables cut the lineage of the next stage.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

KEY = ["manifest_id", "reference_kind"]
MAX_LAYERS = 8
RETRIES = 20


def ts(value: str) -> F.Column:
    return F.to_timestamp(F.lit(value))


def proposed_rows(resolved: DataFrame, as_of: str) -> DataFrame:
    """Scan rows -> manifest rows, status 'proposed', review columns NULL."""
    occ = F.col("occurrences") if "occurrences" in resolved.columns else F.lit(1)
    return resolved.select(
        "manifest_id", "asset_type", "asset_path", F.col("cell_index").cast("int"),
        "original_reference", "reference_kind", "proposed_replacement",
        F.col("confidence").cast("double"),
        F.lit("proposed").alias("status"),
        F.lit(None).cast("string").alias("final_replacement"),
        F.lit(None).cast("string").alias("reviewer"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
        F.lit(None).cast("timestamp").alias("applied_at"),
        F.lit(None).cast("string").alias("backup_path"),
        ts(as_of).alias("scanned_at"),
        occ.cast("int").alias("occurrences"),
        "reason",
        F.lit(None).cast("string").alias("decision"))


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], S.MANIFEST)


def conform(df: DataFrame) -> DataFrame:
    """Select the manifest columns in order, casting to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.MANIFEST.fields])


class Conflict(RuntimeError):
    """Another writer committed the version first."""


def _fs(spark: SparkSession, location: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return jvm, path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(version, commit file), oldest first. Read errors are raised."""
    _, path, fs = _fs(spark, f"{root.rstrip('/')}/commits")
    if not fs.exists(path):
        return []
    names = [(status.getPath().getName(), status.getPath().toString()) for status in fs.listStatus(path)]
    return sorted((int(n[:-5]), p) for n, p in names if n.endswith(".json") and n[:-5].isdigit())


def _layers(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """(version, its layers' names) of the last commit; (0, []) when nothing is committed."""
    found = _commits(spark, root)
    if not found:
        return 0, []
    version, file = found[-1]
    jvm, path, fs = _fs(spark, file)
    stream = fs.open(path)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return version, json.loads(text)["layers"]


def _create_exclusively(spark: SparkSession, location: str, text: str) -> None:
    """Create the file with its content, or raise Conflict when it exists. On a local file system a finished file is
    linked to the name, which only one writer can; elsewhere the store's own exclusive create is used."""
    jvm, path, fs = _fs(spark, location)
    fs.mkdirs(path.getParent())
    local = fs.getScheme() == "file"
    target = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}") if local else path
    try:
        out = fs.create(target, False)
    except Exception as e:
        if fs.exists(path):
            raise Conflict(location) from e
        raise
    out.write(text.encode())
    out.close()
    if local:
        made, wanted = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, path))
        try:
            jvm.java.nio.file.Files.createLink(wanted, made)
        except Exception as e:
            if fs.exists(path):
                raise Conflict(location) from e
            raise
        finally:
            fs.delete(target, False)


def _versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(version, folder of its last layer) of every commit's number; the folder is the newest one's for the last."""
    version, layers = _layers(spark, root)
    return [(n, f"{root.rstrip('/')}/version={layers[-1]}" if n == version else "") for n, _ in _commits(spark, root)]


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Highest committed version under `root`, or None when nothing is committed."""
    return _layers(spark, root)[0] or None


def _read_layers(spark: SparkSession, root: str, layers: list[str], within: DataFrame | None = None) -> DataFrame:
    """The rows of the layers laid over one another; with `within` (a column _path) those of its paths only. What a later
    layer covers, and what is outside, is dropped layer by layer before the union, so it is not carried on whole."""
    if not layers:
        return empty_manifest(spark)
    root = root.rstrip("/")
    inside = F.col("asset_path").eqNullSafe(F.col("_path"))
    rows = later = None
    for layer in reversed(layers):
        part = spark.read.schema(S.MANIFEST).parquet(f"{root}/version={layer}")
        if later is not None:
            part = part.join(later, inside, "left_anti")
        if within is not None:
            part = part.join(within, inside, "left_semi")
        rows = part if rows is None else rows.unionByName(part)
        if layer != layers[0]:
            paths = spark.read.schema("asset_path string").parquet(f"{root}/paths={layer}").select(F.col("asset_path").alias("_path"))
            later = paths if later is None else later.unionByName(paths)
    return rows


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    return _read_layers(spark, root, _layers(spark, root)[1])


def _write(df: DataFrame, root: str, version: int, layers: list[str], paths: DataFrame | None) -> int:
    """Write a layer and commit it as the version after `version`; Conflict when another writer was first."""
    root, layer = root.rstrip("/"), f"{version + 1}-{uuid.uuid4().hex[:12]}"
    conform(df).write.mode("errorifexists").parquet(f"{root}/version={layer}")
    if paths is None:
        layers = []
    else:
        paths.write.mode("errorifexists").parquet(f"{root}/paths={layer}")
    _create_exclusively(df.sparkSession, f"{root}/commits/{version + 1:012d}.json", json.dumps({"layers": [*layers, layer]}))
    return version + 1


def update(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame],
           scope: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Commit `change(rows)` as the next version; returns its number.

    `scope(current)` gives the asset paths that may change (a column asset_path): `change` then gets the rows of those
    paths only and returns all their next rows, and only they are written. Without it the manifest is replaced. When
    another writer commits in between, both are computed again from what it committed."""
    from ..plans.partitioning import materialize
    for _ in range(RETRIES):
        version, layers = _layers(spark, root)
        current = _read_layers(spark, root, layers)
        try:
            if scope is None or not layers:
                return _write(change(current), root, version, layers, None)
            paths = materialize(scope(current).select("asset_path").distinct(), "scope")
            wanted = paths.select(F.col("asset_path").alias("_path"))
            inside = F.col("asset_path").eqNullSafe(F.col("_path"))
            nxt = conform(change(_read_layers(spark, root, layers, wanted)))
            if len(layers) < MAX_LAYERS:
                return _write(nxt, root, version, layers, paths)
            return _write(nxt.unionByName(conform(current).join(wanted, inside, "left_anti")), root, version, layers, None)
        except Conflict:
            continue
    raise Conflict(f"{root}: no commit in {RETRIES} tries")


def commit(df: DataFrame, root: str) -> int:
    """Replace the whole manifest by `df`, whatever was committed since; returns the version number."""
    return update(df.sparkSession, root, lambda current: df)


def upsert_rescan(current: DataFrame, rescanned: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Fix 21: a rescan keeps reviewed rows, refreshes proposed ones, drops proposed rows
    that vanished and adds new ones. Full outer join on (manifest_id, reference_kind).
    With `scope` (a DataFrame of asset_path), only those assets were rescanned: rows of
    every other asset are kept as they are."""
    if scope is not None:
        paths = scope.select("asset_path").distinct()
        untouched = conform(current).join(paths, "asset_path", "left_anti")
        inside = conform(current).join(paths, "asset_path", "left_semi")
        return conform(upsert_rescan(inside, rescanned)).unionByName(untouched)
    old = conform(current).alias("o")
    new = conform(rescanned).alias("n")
    j = old.join(new, [F.col("o.manifest_id") == F.col("n.manifest_id"),
                       F.col("o.reference_kind") == F.col("n.reference_kind")], "full_outer")
    reviewed = F.col("o.status").isNotNull() & (F.col("o.status") != "proposed")
    keep = reviewed | F.col("n.manifest_id").isNotNull()
    cols = [F.when(reviewed, F.col(f"o.{f.name}")).otherwise(F.col(f"n.{f.name}")).alias(f.name)
            for f in S.MANIFEST.fields]
    return j.filter(keep).select(*cols)


def moved(current: DataFrame, renames: DataFrame) -> DataFrame:
    """The rows with those of renamed assets (_old -> _new) under their new path and the id that goes with it."""
    from .resolve import manifest_id
    j = conform(current).join(renames, F.col("asset_path") == F.col("_old"), "left")
    new = F.col("_new")
    own = {"asset_path": F.coalesce(new, F.col("asset_path")),
           "manifest_id": F.when(new.isNotNull(), manifest_id(new, F.col("cell_index"), F.col("original_reference"))).otherwise(F.col("manifest_id"))}
    return j.select(*[own[f.name].alias(f.name) if f.name in own else F.col(f.name) for f in S.MANIFEST.fields])
