"""Changed, renamed and deleted assets; nested mounts; odd file names."""
import os
import tempfile

from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.operators import manifest as M
from assetscan.operators import resolve as R
from assetscan.plans import stages as ST
from assetscan.sources import changes as CH
from assetscan.sources import demo as DM
from assetscan.sources import io as IO
from helpers import NB, SEP, assets_of

AS_OF = "2024-06-01 00:00:00"
REF = NB + SEP + 'spark.table("risk_db.exposures")  # '


def found(rows):
    return sorted((r.asset_path, r.change, r.old_path or "") for r in rows.collect())


def test_added_changed_renamed_deleted(spark):
    old = assets_of(spark, {"/same": "a", "/edit": "b", "/gone": "c", "/move": "d", "/e1": "", "/e2": ""})
    new = assets_of(spark, {"/same": "a", "/edit": "b2", "/new": "n", "/there": "d", "/e3": "", "/e4": ""})
    assert found(CH.changes(CH.fingerprints(old), CH.fingerprints(new))) == [
        ("/e1", "deleted", ""), ("/e2", "deleted", ""), ("/e3", "added", ""), ("/e4", "added", ""),
        ("/edit", "changed", ""), ("/gone", "deleted", ""), ("/new", "added", ""), ("/there", "renamed", "/move")]
    none = CH.read_fingerprints(spark, "/nowhere")
    assert {r.change for r in CH.changes(none, CH.fingerprints(old)).collect()} == {"added"}
    assert CH.changes(CH.fingerprints(old), CH.fingerprints(old)).count() == 0


def test_rescan_scans_what_changed_and_keeps_reviews(spark, monkeypatch):
    wd = ST.Workdir(os.path.join(tempfile.mkdtemp(prefix="assetscan-rescan-"), "work"))
    first = assets_of(spark, {"/a": REF + "a", "/b": REF + "b", "/c": REF + "c", "/d": REF + "d"})
    ST.discover(spark, wd, first, listing=None, as_of=AS_OF)
    version, changed = ST.rescan(spark, wd, first, DM.demo_mapping(spark), AS_OF)
    assert version == 1 and changed.count() == 4 and M.read_latest(spark, wd.manifest).count() == 4
    assert ST.rescan(spark, wd, first, DM.demo_mapping(spark), AS_OF)[0] is None            # nothing changed: no commit
    row = M.read_latest(spark, wd.manifest).filter("asset_path = '/d'").first()
    ST.review(spark, wd, "me", AS_OF, spark.createDataFrame([(row.manifest_id, row.reference_kind, "overridden", "m.s.d", "me", None)], S.DECISIONS))
    seen = []
    plain = ST.scan_to_manifest
    monkeypatch.setattr(ST, "scan_to_manifest", lambda assets, *a: seen.extend(r.asset_path for r in assets.collect()) or plain(assets, *a))
    second = assets_of(spark, {"/a": REF + "a", "/b": NB + SEP + 'spark.table("x_db.y")', "/moved/d": REF + "d", "/e": REF + "e"})
    version, changed = ST.rescan(spark, wd, second, DM.demo_mapping(spark), AS_OF)
    assert found(changed) == [("/b", "changed", ""), ("/c", "deleted", ""), ("/e", "added", ""), ("/moved/d", "renamed", "/d")]
    assert sorted(seen) == ["/b", "/e"]
    rows = {(r.asset_path, r.original_reference): r for r in M.read_latest(spark, wd.manifest).collect()}
    reviewed = {k for k, r in rows.items() if r.status != "proposed"}
    assert ("/b", "x_db.y") in rows and ("/e", "risk_db.exposures") in rows and ("/a", "risk_db.exposures") in rows
    assert ("/moved/d", "risk_db.exposures") in reviewed and not any(p == "/d" for p, _ in rows)
    moved = rows[("/moved/d", "risk_db.exposures")]
    ids = M.read_latest(spark, wd.manifest).filter("asset_path = '/moved/d'").select(R.manifest_id(F.col("asset_path"), F.col("cell_index"), F.col("original_reference")).alias("i")).first().i
    assert moved.manifest_id == ids and ("/b", "risk_db.exposures") in reviewed and ("/c", "risk_db.exposures") in reviewed


def test_listings_read_only_touched_files_with_odd_names(spark, monkeypatch):
    root = os.path.join(tempfile.mkdtemp(prefix="assetscan-odd (x)+[1]-"), "files")
    os.makedirs(os.path.join(root, "s p"))
    names = ["a+b.py", "c (1).sql", "s p/[d].py", "é%20.scala"]
    for n in names:
        with open(os.path.join(root, n), "w") as f:
            f.write(n)
    assets = {r.asset_path: (r.language, r.source) for r in IO.read_asset_files(spark, root).collect()}
    assert assets == {"/a+b": ("python", "a+b.py"), "/c (1)": ("sql", "c (1).sql"), "/s p/[d]": ("python", "s p/[d].py"), "/é%20": ("scala", "é%20.scala")}
    first = CH.file_fingerprints(spark, root, CH.read_fingerprints(spark, root + "/none"))
    by_text = {r.asset_path: r.content for r in CH.fingerprints(IO.read_asset_files(spark, root)).collect()}
    assert {r.asset_path: r.content for r in first.collect()} == by_text
    store = os.path.join(tempfile.mkdtemp(prefix="assetscan-fp-"), "fp")
    assert CH.write_fingerprints(first, store) == 1
    with open(os.path.join(root, "s p/[d].py"), "w") as f:
        f.write("changed text")
    read = []
    plain = CH.read_asset_files
    monkeypatch.setattr(CH, "read_asset_files", lambda s, r, files: read.extend(files) or plain(s, r, files))
    second = CH.file_fingerprints(spark, root, CH.read_fingerprints(spark, store))
    assert found(CH.changes(CH.read_fingerprints(spark, store), second)) == [("/s p/[d]", "changed", "")]
    assert len(read) == 1 and read[0].endswith("[d].py")


def test_nested_mounts_resolve_to_the_longest(spark):
    mounts = spark.createDataFrame([("/mnt/a", "x", "finance_db", None), ("/mnt/a/b", "x", "risk_db", None), ("/mnt/a/b/c", "x", "", None)], S.MOUNTS)
    refs = spark.createDataFrame([("notebook", "/n", 0, "mount_path_literal", p, 1) for p in
                                  ("/mnt/a/z/f", "dbfs:/mnt/a/b/f", "/mnt/a/bb/f", "/mnt/a/b/c/f", "/mnt/q/f", "/mnt/a", "/mnt/a/b/")],
                                 "asset_type string, asset_path string, cell_index int, reference_kind string, original_reference string, occurrences int")
    got = {r.original_reference: (r.proposed_replacement or r.reason) for r in R.resolve(refs, DM.demo_mapping(spark), mounts).collect()}
    assert got == {"/mnt/a/z/f": "/Volumes/main/uc_migration_target/a/z/f", "dbfs:/mnt/a/b/f": "/Volumes/main/uc_migration_target/b/f",
                   "/mnt/a/bb/f": "/Volumes/main/uc_migration_target/a/bb/f", "/mnt/a/b/c/f": "mount has no namespace",
                   "/mnt/q/f": "mount not registered", "/mnt/a": "/Volumes/main/uc_migration_target/a", "/mnt/a/b/": "/Volumes/main/uc_migration_target/b/"}


def test_values_are_carried_from_the_last_cell_that_assigns_them(spark):
    from assetscan.operators import cells as C
    from assetscan.operators import review as RV
    cell = lambda *parts: NB + SEP + SEP.join(parts)
    assets = assets_of(spark, {
        "/far": cell('m = "raw-1"', 'm = "raw-2"\nn = "x"', 'x = 1', 'spark.read.parquet(f"/mnt/{m}/a")', 'm = "raw-9"'),
        "/near": cell('m = "raw-1"', 'if a:\n  m = "raw-3"\nelse:\n  m = "raw-4"\nspark.read.parquet(f"/mnt/{m}/a")'),
        "/none": cell('spark.read.parquet(f"/mnt/{m}/a")', 'm = "raw-5"'),
        "/table": cell('db = "risk_db"', 'spark.table(f"{db}.exposures")')})
    cells = C.split_cells(assets)
    from assetscan.plans import scan as SC
    man = M.proposed_rows(SC.scan_resolved(assets, DM.demo_mapping(spark), DM.demo_mounts(spark)), AS_OF)
    got = sorted((r.asset_path, r.named_mount) for r in RV.candidates_mount(man, cells, DM.demo_mounts(spark)).collect())
    assert got == [("/far", "/mnt/raw-2"), ("/near", "/mnt/raw-3"), ("/near", "/mnt/raw-4"), ("/none", None)]
    tables = [(r.candidate_namespace, r.candidate_target) for r in RV.candidates_table(man, cells, DM.demo_mapping(spark)).collect()]
    assert tables == [("risk_db", "main.uc_migration_target.exposures")]
