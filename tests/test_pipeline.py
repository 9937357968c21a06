"""End to end over files: a directory of notebooks -> discover -> scan -> review ->
apply -> validate -> restore, in a working directory of Parquet tables."""
import os
import tempfile

from pyspark.sql import functions as F

from assetscan.operators import manifest as M
from assetscan.plans import stages as ST
from assetscan.sources import demo as DM
from assetscan.sources import io as IO

AS_OF = "2024-06-01 00:00:00"


def _write_demo_files(root):
    for name, tier, _, cells in DM.DEMO_NOTEBOOKS:
        d = os.path.join(root, tier)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{name}.py"), "w") as f:
            f.write(DM.notebook_source(cells))


def test_files_to_manifest_to_patched_and_back(spark):
    base = tempfile.mkdtemp(prefix="assetscan-e2e-")
    files = os.path.join(base, "files")
    _write_demo_files(files)
    wd = ST.Workdir(os.path.join(base, "work"))

    assets = IO.read_asset_files(spark, files)
    assert assets.count() == 24
    assert assets.filter(F.col("asset_path") == "/simple/simple_01_read_table").count() == 1

    info = ST.discover(spark, wd, assets, listing=None, as_of=AS_OF)
    assert info["mount_provenance"].startswith("fallback")
    v = ST.scan(spark, wd, assets, DM.demo_mapping(spark), AS_OF)
    man = M.read_latest(spark, wd.manifest)
    assert v == 1 and man.agg(F.sum("occurrences")).first()[0] == 25

    v, rejects = ST.review(spark, wd, "reviewer@x", AS_OF)
    assert v == 2
    approved = M.read_latest(spark, wd.manifest).filter("status = 'approved'").count()
    assert approved == 8

    out = ST.apply(spark, wd, assets, stamp="20240601T000000Z", applied_at=AS_OF)
    assert out["references_applied"] == 8 and out["version"] == 3
    again = ST.apply(spark, wd, assets, stamp="20240601T000000Z", applied_at=AS_OF)
    assert again["references_applied"] == 0 and again["version"] == 3       # nothing left, nothing lost
    patched = IO.read_patched(spark, wd.path("assets_patched"))
    texts = {r.asset_path: r.source for r in patched.collect()}
    assert 'spark.read.table("main.uc_migration_target.transactions")' in texts["/simple/simple_01_read_table"]
    assert "/Volumes/main/uc_migration_target/finance_raw/gl" in texts["/complex/complex_07_dbfs_prefix"]

    # rescanning after review keeps the decisions
    v = ST.scan(spark, wd, assets, DM.demo_mapping(spark), AS_OF)
    assert M.read_latest(spark, wd.manifest).filter("status = 'applied'").count() == 8

    src = spark.range(5).toDF("a")
    res = ST.validate(spark, wd, lambda n: src if n.split(".")[-1] in ("transactions", "src_transactions") else
                      (_ for _ in ()).throw(KeyError(n)), source_base="demo", target_schema="uc_migration_target")
    assert res["tables_matched"] == 1 and res["tables_unverifiable"] >= 1
    assert res["newly_logged"] == 8
    again = ST.validate(spark, wd, lambda n: src, source_base="demo")
    assert again["newly_logged"] == 0
    # a table that now differs fails its rows, and only those are logged again
    other = spark.range(3).toDF("a")
    third = ST.validate(spark, wd, lambda n: other if n.endswith(".transactions") else src, source_base="demo")
    failed = M.read_latest(spark, wd.manifest).filter("status = 'failed'").count()
    assert failed > 0 and third["newly_logged"] == failed

    restored, _ = ST.restore(spark, wd)
    originals = {r.asset_path: r.source for r in assets.collect()}
    assert all(originals[r.asset_path] == r.source for r in restored.collect())
    assert M.read_latest(spark, wd.manifest).filter("status in ('applied', 'failed')").count() == 0
    now = {r.asset_path: r.source for r in IO.current_assets(assets, IO.read_patched(spark, wd.path("assets_patched"))).collect()}
    assert now == originals


def test_write_then_read_asset_files_round_trip(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="assetscan-files-"), "out")
    nbs = DM.demo_notebooks(spark).select("asset_path", "source")
    IO.write_asset_files(nbs, base)
    back = {r.asset_path: r.source for r in IO.read_asset_files(spark, base).collect()}
    assert back == {r.asset_path: r.source for r in nbs.collect()}


def test_export_is_whole_or_not_there(spark):
    import pytest
    base = tempfile.mkdtemp(prefix="assetscan-export-")
    rows = [(f"/d{i % 3}/n {i}", ("python", "sql", "scala", None)[i % 4], f"text {i}\r\né") for i in range(40)] + [("/d0/none", "python", None)]
    assets = spark.createDataFrame(rows, "asset_path string, language string, source string").repartition(4)
    from assetscan.sources.export import export_assets
    export_assets(assets, os.path.join(base, "ok"))
    back = {r.asset_path: (r.language, r.source) for r in IO.read_asset_files(spark, os.path.join(base, "ok")).collect()}
    assert back == {p: (l or "python", t) for p, l, t in rows if t is not None}
    bad = assets.unionByName(spark.createDataFrame([("/d0/../../out", "python", "x")], assets.schema))
    with pytest.raises(Exception, match="inside the export"):
        export_assets(bad, os.path.join(base, "bad"))
    with pytest.raises(Exception, match="ok"):
        export_assets(assets, os.path.join(base, "ok"))                  # never mixed with an older export
    export_assets(assets.limit(0), "file://" + os.path.join(base, "empty"))
    assert sorted(os.listdir(base)) == ["empty", "ok"]                   # no staging folder, nothing of the failed ones
    assert len(back) == sum(len(files) for _, _, files in os.walk(os.path.join(base, "ok")))


def test_two_rounds_of_apply_keep_both_edits(spark):
    base = tempfile.mkdtemp(prefix="assetscan-two-")
    wd = ST.Workdir(os.path.join(base, "work"))
    from helpers import NB, SEP, assets_of
    from assetscan import schemas as S
    assets = assets_of(spark, {"/nb": NB + SEP + 'spark.table("risk_db.exposures")\nspark.table("x_db.y")'})
    ST.discover(spark, wd, assets, listing=None, as_of=AS_OF)
    ST.scan(spark, wd, assets, DM.demo_mapping(spark), AS_OF)
    ST.review(spark, wd, "me", AS_OF)
    assert ST.apply(spark, wd, assets, "s1", AS_OF)["references_applied"] == 1
    row = M.read_latest(spark, wd.manifest).filter("original_reference = 'x_db.y'").first()
    decisions = spark.createDataFrame([(row.manifest_id, row.reference_kind, "overridden", "main.s.y", "me", None)], S.DECISIONS)
    ST.review(spark, wd, "me", AS_OF, decisions)
    assert ST.apply(spark, wd, assets, "s2", AS_OF)["references_applied"] == 1
    now = IO.current_assets(assets, IO.read_patched(spark, wd.path("assets_patched"))).first().source
    assert "main.uc_migration_target.exposures" in now and "main.s.y" in now


def test_a_crashed_commit_is_passed_over_and_read_errors_are_raised(spark):
    import pytest
    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-man-"), "m")
    assert M.latest_version(spark, root) is None
    assert M.commit(M.empty_manifest(spark), root) == 1
    os.makedirs(os.path.join(root, "version=2-crashed"))
    assert M.latest_version(spark, root) == 1
    assert M.commit(M.empty_manifest(spark), root) == 2
    with open(os.path.join(next(p for _, p in [M._versions(spark, root)[-1]]).replace("file:", ""), "part-bad.parquet"), "w") as f:
        f.write("broken")
    with pytest.raises(Exception):
        M.read_latest(spark, root).count()
