"""What a scan of the estate costs: keys spread before texts are built, nothing worked out twice."""
from __future__ import annotations

import re

from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.operators import cells as C
from assetscan.operators import review as RV
from assetscan.plans.partitioning import spread
from assetscan.sources import estate as ES


def _orders(spark, tmp_path, keys):
    rows = spark.createDataFrame([(k, c) for k, c in keys], "o_orderkey long, o_custkey long")
    rows.coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_texts_are_built_after_the_keys_are_spread(spark, tmp_path):
    sf = _orders(spark, tmp_path, [(k, 3 * k) for k in range(64)])
    notebooks = ES.estate_notebooks(spark, sf)
    assert notebooks.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert notebooks.count() == 64


def test_spread_cells_build_no_text_below_the_exchange(spark, tmp_path):
    sf = _orders(spark, tmp_path, [(k, 3 * k) for k in range(64)])
    cells = C.split_cells(spread(ES.estate_notebooks(spark, sf), "asset_path"))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if re.search(r"^\W*Filter ", line)]
    assert not any("replace(" in line or "concat(" in line for line in filters), filters


def test_assets_without_source_still_give_no_notebook_cells(spark):
    rows = [("notebook", "/a", None, None), ("dashboard", "/d", None, ["SELECT 1 FROM a.b"]), ("notebook", "/n", "x = 1", None)]
    assets = spark.createDataFrame(rows, "asset_type string, asset_path string, source string, queries array<string>")
    got = {(r.asset_path, r.cell_index, r.language) for r in C.split_cells(assets).collect()}
    assert got == {("/d", 0, "sql"), ("/n", 0, "python")}


def test_form_of_every_key(spark):
    """by_form against a plain loop, keys without a form and NULL included."""
    keys = [None, -17, -8, -1, *range(0, 700), 2 ** 40 + 9]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", ES.by_form(F.col("k"), lambda v, i: F.lit(f"{v}:{i}")).alias("f"))

    def form(k):
        if k is None or (k < 0 and k % 8):
            return None
        n = len(ES.FORMS[k % 8])
        i = int(abs(k // 8) % n) * (-1 if k < 0 else 1)
        return f"{k % 8}:{i}" if i >= 0 else None

    assert {r.k: r.f for r in rows.collect()} == {k: form(k) for k in keys}


def test_queues_sort_written_rows(spark):
    """A sort by ranges reads its input twice: it must not be the scan."""
    rows = [("m%d" % i, "/n%d" % (9 - i), 0, "a.b", "x.y.z", c, "proposed", "py_table_ref", "r") for i, c in enumerate((0.95, 0.9, 0.2, 0.1, 0.6))]
    manifest = spark.createDataFrame(rows, "manifest_id string, asset_path string, cell_index int, original_reference string, "
                                     "proposed_replacement string, confidence double, status string, reference_kind string, reason string")
    for queue, ids in ((RV.queue_high, ["m1", "m0"]), (RV.queue_medium, ["m4"]), (RV.queue_low, ["m3", "m2"])):
        got = queue(manifest)
        assert got.inputFiles() and all("assetscan-queue" in f for f in got.inputFiles())
        assert [r.manifest_id for r in got.collect()] == ids
    assert S.TIER_COMPLEX_MIN > 0.2
