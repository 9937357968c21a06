"""Apply rounds taken back as of a round, rounds that were cut off, layered manifest commits and two writers."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.operators import manifest as M
from assetscan.operators import rewrite as RW
from assetscan.plans import stages as ST
from assetscan.sources import demo as DM
from assetscan.sources import io as IO
from helpers import NB, SEP, assets_of

AS_OF = "2024-06-01 00:00:00"


def estate(spark, name):
    wd = ST.Workdir(os.path.join(tempfile.mkdtemp(prefix=f"assetscan-{name}-"), "work"))
    assets = assets_of(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")\nspark.table("x_db.y")', "/other": NB + SEP + 'spark.table("risk_db.exposures")'})
    ST.discover(spark, wd, assets, listing=None, as_of=AS_OF)
    ST.scan(spark, wd, assets, DM.demo_mapping(spark), AS_OF)
    ST.review(spark, wd, "me", AS_OF)
    return wd, assets


def override(spark, wd, original, final):
    row = M.read_latest(spark, wd.manifest).filter(F.col("original_reference") == original).first()
    ST.review(spark, wd, "me", AS_OF, spark.createDataFrame([(row.manifest_id, row.reference_kind, "overridden", final, "me", None)], S.DECISIONS))


def texts(spark, wd, assets):
    return {r.asset_path: r.source for r in IO.current_assets(assets, IO.read_patched(spark, wd.path("assets_patched"))).collect()}


def statuses(spark, wd):
    return {(r.asset_path, r.original_reference): r.status for r in M.read_latest(spark, wd.manifest).collect()}


def test_restore_takes_back_the_rounds_it_names_and_no_earlier_ones(spark):
    wd, assets = estate(spark, "rounds")
    before = texts(spark, wd, assets)
    ST.apply(spark, wd, assets, "s1", AS_OF)
    first = texts(spark, wd, assets)
    override(spark, wd, "x_db.y", "main.s.y")
    ST.apply(spark, wd, assets, "s2", AS_OF)
    assert "main.s.y" in texts(spark, wd, assets)["/nb"]
    restored, _ = ST.restore(spark, wd, since="s2")
    assert [r.asset_path for r in restored.collect()] == ["/nb"]
    assert texts(spark, wd, assets) == first
    assert statuses(spark, wd) == {("/nb", "risk_db.exposures"): "applied", ("/nb", "x_db.y"): "overridden", ("/other", "risk_db.exposures"): "applied"}
    # the row taken back can be applied again, and both rounds can be taken back at once
    assert ST.apply(spark, wd, assets, "s3", AS_OF)["references_applied"] == 1
    ST.restore(spark, wd, since="s1")
    assert texts(spark, wd, assets) == before
    assert set(statuses(spark, wd).values()) == {"approved", "overridden"}
    assert M.read_latest(spark, wd.manifest).filter("backup_path is not null or applied_at is not null").count() == 0


def test_a_round_cut_off_before_its_commit_is_finished_by_a_re_run(spark):
    wd, assets = estate(spark, "cut")
    before = texts(spark, wd, assets)
    maps, _ = RW.edit_maps(RW.work_set(M.read_latest(spark, wd.manifest)))
    done = RW.rewrite_assets(assets, maps)
    IO.write_backups(RW.backups_of(done, wd.path("backups"), "s1"), wd.path("backups"))
    IO.write_patched(done.select("asset_path", "language", F.col("new_source").alias("source")), wd.path("assets_patched"), "s1")
    assert set(statuses(spark, wd).values()) == {"approved", "proposed"}              # text patched, manifest not yet
    assert ST.apply(spark, wd, assets, "s1", AS_OF)["references_applied"] == 2
    assert "main.uc_migration_target.exposures" in texts(spark, wd, assets)["/other"]
    ST.restore(spark, wd)
    assert texts(spark, wd, assets) == before                                          # the backup is the text before the round


def rows(spark, paths, status="proposed"):
    names = [f.name for f in S.MANIFEST.fields]
    make = lambda p: tuple({"manifest_id": f"id{p}", "asset_path": p, "status": status, "reference_kind": "k", "reason": p * 40}.get(n) for n in names)
    return spark.createDataFrame([make(p) for p in paths], S.MANIFEST)


def size(root, layer):
    folder = os.path.join(root, f"version={layer}")
    return sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))


def test_a_commit_writes_the_paths_it_changes(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-layers-"), "m")
    paths = [f"/a/{i}" for i in range(20000)]
    M.commit(rows(spark, paths).coalesce(1), root)
    few = spark.createDataFrame([(p,) for p in paths[:200]] + [("/new",)], "asset_path string")

    def change(current):
        assert current.count() == 200
        return current.filter("asset_path <> '/a/7'").withColumn("status", F.lit("approved")).unionByName(rows(spark, ["/new"])).coalesce(1)

    assert M.update(spark, root, change, lambda current: few) == 2
    _, layers = M._layers(spark, root)
    assert len(layers) == 2 and size(root, layers[1]) < 0.03 * size(root, layers[0])
    now = M.read_latest(spark, root)
    assert now.count() == 20000 and now.filter("status = 'approved'").count() == 199 and now.filter("asset_path = '/a/7'").count() == 0
    for i in range(M.MAX_LAYERS + 1):                                                # many small commits are merged at times
        M.update(spark, root, lambda c, i=i: c.withColumn("reviewer", F.lit(f"r{i}")), lambda c: few.limit(3))
    assert len(M._layers(spark, root)[1]) <= M.MAX_LAYERS and M.read_latest(spark, root).count() == 20000
    assert {r.reviewer for r in M.read_latest(spark, root).filter("reviewer is not null").collect()} == {f"r{M.MAX_LAYERS}"}


def test_of_two_writers_one_retries_on_what_the_other_committed(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-two-writers-"), "m")
    M.commit(rows(spark, ["/a", "/b"]), root)
    tries = []

    def slow(current):
        tries.append(1)
        if len(tries) == 1:                                                            # another writer is faster
            M.update(spark, root, lambda c: c.withColumn("status", F.lit("skipped")), lambda c: c.filter("asset_path = '/b'"))
        return current.withColumn("reviewer", F.lit("slow"))

    assert M.update(spark, root, slow) == 3 and len(tries) == 2
    assert sorted((r.asset_path, r.status, r.reviewer) for r in M.read_latest(spark, root).collect()) == [("/a", "proposed", "slow"), ("/b", "skipped", "slow")]
    with pytest.raises(M.Conflict):
        M._create_exclusively(spark, f"{root}/commits/{3:012d}.json", "{}")
    assert [n for n, _ in M._versions(spark, root)] == [1, 2, 3]


def test_null_paths_and_empty_scopes(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-null-"), "m")
    M.commit(rows(spark, ["/a"]).unionByName(rows(spark, ["/x"]).withColumn("asset_path", F.lit(None).cast("string"))), root)
    M.update(spark, root, lambda c: c.withColumn("status", F.lit("failed")), lambda c: c.filter("asset_path is null"))
    M.update(spark, root, lambda c: c, lambda c: c.limit(0))
    assert sorted((str(r.asset_path), r.status) for r in M.read_latest(spark, root).collect()) == [("/a", "proposed"), ("None", "failed")]
