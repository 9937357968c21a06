"""S1 / S8 over time: which assets are new, changed, renamed or gone since the last scan.

Two kinds of fingerprint. A listing (path, length, modification time) reads no contents; a content fingerprint is
the SHA-256 of the text. A file whose listing is unchanged keeps its stored hash, so only files that were touched are read.
Fingerprints old and new meet in a full outer join on the path. A gone and a new path whose content occurs once on
either side are a rename; contents that several of them share (empty notebooks, copies) are not paired but reported
as deleted and added.

<root>/asset_fingerprints/snapshot=N-<id>: written after the manifest commit that it belongs to, so a crash in
between only scans the same assets once more. The highest complete snapshot counts.
"""
from __future__ import annotations

import re
import uuid
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.partitioning import materialize
from .io import asset_path_of, literal_path, path_exists, read_asset_files

READ_BATCH = 20_000
FINGERPRINTS = "asset_path string, content string, length bigint, modified timestamp"
CHANGES = ("added", "changed", "renamed", "deleted")


def fingerprints(assets: DataFrame) -> DataFrame:
    """Content fingerprints of asset rows; a null text is an empty one, a repeated path its largest hash."""
    text = F.coalesce(F.col("source"), F.array_join("queries", "\u0001"), F.lit("")) if "queries" in assets.columns else F.coalesce(F.col("source"), F.lit(""))
    return (assets.select("asset_path", F.sha2(text, 256).alias("content"), F.octet_length(text).cast("bigint").alias("length"))
            .groupBy("asset_path").agg(F.max(F.struct("content", "length")).alias("f"))
            .select("asset_path", "f.content", "f.length", F.lit(None).cast("timestamp").alias("modified")))


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """asset_path, file, length, modified of every file under `root`; contents are not read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal_path(root))
    return raw.select(asset_path_of(F.col("path"), root).alias("asset_path"), F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def file_fingerprints(spark: SparkSession, root: str, known: DataFrame) -> DataFrame:
    """Fingerprints of the files under `root`. Files whose length and modification time are as `known` keep their hash;
    the others are read, READ_BATCH files to a job (their names, not their texts, pass the driver, which lists files anyway)."""
    k = known.select("asset_path", F.col("content").alias("_content"), F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    j = materialize(file_listing(spark, root).join(k, "asset_path", "left"), "listing")
    same = F.coalesce((F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified")), F.lit(False))
    kept = j.filter(same).select("asset_path", F.col("_content").alias("content"), "length", "modified")
    names, read = (r["file"] for r in j.filter(~same).select("file").toLocalIterator()), None
    while batch := list(islice(names, READ_BATCH)):
        part = materialize(fingerprints(read_asset_files(spark, root, batch)).select("asset_path", "content"), "fingerprints")
        read = part if read is None else read.unionByName(part)
    if read is None:
        return kept
    return kept.unionByName(j.filter(~same).select("asset_path", "length", "modified").join(read, "asset_path").select(*kept.columns))


def changes(known: DataFrame, now: DataFrame) -> DataFrame:
    """asset_path, change, old_path of every asset that is not as it was. `old_path` is set for renames."""
    old = known.select(F.col("asset_path").alias("old_path"), F.col("content").alias("old_content"))
    new = now.select("asset_path", "content")
    j = old.join(new, F.col("old_path") == F.col("asset_path"), "full_outer").filter(~F.col("old_content").eqNullSafe(F.col("content")))
    gone = j.filter(F.col("asset_path").isNull()).groupBy(F.col("old_content").alias("c")).agg(F.count(F.lit(1)).alias("n_gone"), F.min("old_path").alias("was"))
    come = j.filter(F.col("old_path").isNull()).groupBy(F.col("content").alias("c")).agg(F.count(F.lit(1)).alias("n_come"), F.min("asset_path").alias("is"))
    moved = gone.join(come, "c").filter("n_gone = 1 and n_come = 1").select("was", "is")
    kind = (F.when(F.col("old_path").isNull(), "added").when(F.col("asset_path").isNull(), "deleted").otherwise("changed"))
    plain = (j.select(F.coalesce("asset_path", "old_path").alias("asset_path"), kind.alias("change"))
             .join(moved.select(F.explode(F.array("was", "is")).alias("asset_path")), "asset_path", "left_anti")
             .withColumn("old_path", F.lit(None).cast("string")))
    return plain.unionByName(moved.select(F.col("is").alias("asset_path"), F.lit("renamed").alias("change"), F.col("was").alias("old_path")))


# ---- stored fingerprints ---------------------------------------------------- #
def _snapshots(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        m = re.fullmatch(r"snapshot=(\d+)-\w+", status.getPath().getName())
        if m and path_exists(spark, f"{status.getPath().toString()}/_SUCCESS"):
            found.append((int(m[1]), status.getPath().toString()))
    return sorted(found)


def read_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    found = _snapshots(spark, root)
    return spark.read.schema(FINGERPRINTS).parquet(found[-1][1]) if found else spark.createDataFrame([], FINGERPRINTS)


def write_fingerprints(now: DataFrame, root: str) -> int:
    found = _snapshots(now.sparkSession, root)
    number = found[-1][0] + 1 if found else 1
    now.select("asset_path", "content", "length", "modified").write.mode("errorifexists").parquet(f"{root.rstrip('/')}/snapshot={number}-{uuid.uuid4().hex[:12]}")
    return number
