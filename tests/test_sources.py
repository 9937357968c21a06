"""Sources and sinks: exports, mount discovery, backfill, control tables, backups."""
import tempfile

from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.sources import io as IO

AS_OF = "2024-01-01 00:00:00"


def test_s2_export_round_trip(spark):
    df = spark.createDataFrame([("/a", "x = 'é'\nspark.table(\"db.t\")")], "asset_path string, source string")
    enc = IO.encode_for_import(df).select("asset_path", "content")
    back = IO.decode_exports(enc).collect()[0]
    assert back.source == "x = 'é'\nspark.table(\"db.t\")"


def test_s3_live_listing_keeps_mnt_only_and_falls_back_when_empty(spark):
    listing = spark.createDataFrame([("/mnt/a", "abfss://a"), ("/Volumes/v", "abfss://v")],
                                    "mount_point string, source string")
    live = IO.discover_mounts(spark, listing).collect()
    assert [(r.mount_path, r.hms_namespace, r.provenance) for r in live] == [("/mnt/a", "", "listing")]
    fb = IO.discover_mounts(spark, listing.filter(F.lit(False))).collect()
    assert len(fb) == len(IO.FALLBACK_MOUNTS) and fb[0].provenance.startswith("fallback")
    reg = IO.registry_rows(IO.discover_mounts(spark, None), AS_OF).collect()
    assert {r.mount_path for r in reg} == {m for m, _, _ in IO.FALLBACK_MOUNTS}


def test_s5_backfill_on_empty_and_partial_inventory(spark):
    found = spark.createDataFrame([("/x/a",), ("/x/b",)], "asset_path string")
    empty = spark.createDataFrame([], S.INVENTORY)
    rows = IO.inventory_backfill(found, empty, AS_OF).collect()
    assert sorted((r.path, r.name, r.tier) for r in rows) == [("/x/a", "a", "unknown"), ("/x/b", "b", "unknown")]
    partial = spark.createDataFrame([("notebook", "/x/a", "a", "simple", 1, None)], S.INVENTORY)
    assert [r.path for r in IO.inventory_backfill(found, partial, AS_OF).collect()] == ["/x/b"]


def test_s17_control_tables_created_once(spark):
    root = tempfile.mkdtemp(prefix="assetscan-ctl-")
    paths = IO.create_control_tables(spark, root)
    spark.createDataFrame([("notebook", "/x", "x", "t", 1, None)], S.INVENTORY) \
        .write.mode("append").parquet(paths["demo_asset_inventory"])
    IO.create_control_tables(spark, root)          # second call leaves existing tables alone
    assert IO.read_control_table(spark, paths["demo_asset_inventory"], "demo_asset_inventory").count() == 1
    assert set(paths) == set(S.CONTROL_TABLES)


def test_s11_backups_repeatable_per_stamp(spark):
    root = tempfile.mkdtemp(prefix="assetscan-bk-")
    b1 = spark.createDataFrame([("/a", "v1", "/bk/a", "S1")], "asset_path string, source string, backup_path string, stamp string")
    b2 = spark.createDataFrame([("/a", "v2", "/bk/a", "S2")], "asset_path string, source string, backup_path string, stamp string")
    IO.write_backups(b1, root)
    IO.write_backups(b2, root)
    IO.write_backups(b2, root)                      # re-run of the same stamp
    rows = sorted((r.stamp, r.source) for r in IO.read_backups(spark, root).collect())
    assert rows == [("S1", "v1"), ("S2", "v2")]
