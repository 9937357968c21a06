"""Incremental scan: two rounds of arriving files, one manifest version per batch, and
nothing scanned twice."""
import os
import tempfile

from pyspark.sql import functions as F

from assetscan.operators import manifest as M
from assetscan.sources import demo as DM
from assetscan.streaming.incremental import run_incremental_scan

AS_OF = "2024-06-01 00:00:00"


def _write(root, names):
    for name, tier, _, cells in DM.DEMO_NOTEBOOKS:
        if name in names:
            os.makedirs(os.path.join(root, tier), exist_ok=True)
            with open(os.path.join(root, tier, f"{name}.py"), "w") as f:
                f.write(DM.notebook_source(cells))


def test_incremental_scan_commits_new_files_only(spark):
    base = tempfile.mkdtemp(prefix="assetscan-stream-")
    files, man, ckpt = (os.path.join(base, x) for x in ("files (1)+[x]", "manifest", "ckpt"))
    first = [n for n, *_ in DM.DEMO_NOTEBOOKS[:12]]
    _write(files, first)
    run_incremental_scan(spark, files, DM.demo_mapping(spark), DM.demo_mounts(spark), man, ckpt, AS_OF)
    assert M.read_latest(spark, man).agg(F.sum("occurrences")).first()[0] == 13   # simple tier: 13 refs
    v1 = M.latest_version(spark, man)
    _write(files, [n for n, *_ in DM.DEMO_NOTEBOOKS[12:]])
    run_incremental_scan(spark, files, DM.demo_mapping(spark), DM.demo_mounts(spark), man, ckpt, AS_OF)
    assert M.read_latest(spark, man).agg(F.sum("occurrences")).first()[0] == 25
    assert M.latest_version(spark, man) == v1 + 1
    run_incremental_scan(spark, files, DM.demo_mapping(spark), DM.demo_mounts(spark), man, ckpt, AS_OF)
    assert M.latest_version(spark, man) == v1 + 1          # caught up: no new version
