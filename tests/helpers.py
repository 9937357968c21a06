"""Small helpers shared by the tests: one-notebook scans and the unit lookups."""
from __future__ import annotations

from pyspark.sql import functions as F

from assetscan import schemas as S
from assetscan.operators import cells as C
from assetscan.operators import extract as E
from assetscan.operators import resolve as R
from assetscan.plans import scan as SC
from assetscan.sources import demo as DM

NB = "# Databricks notebook source"
SEP = "\n\n# COMMAND ----------\n\n"


def assets_of(spark, sources: dict[str, str]):
    rows = [("notebook", p, p.rsplit("/", 1)[-1], "python", src, None) for p, src in sources.items()]
    return spark.createDataFrame(rows, S.ASSETS)


def cells_of(spark, src: str):
    return sorted(C.split_cells(assets_of(spark, {"/nb": src})).collect(), key=lambda r: r.cell_index)


def refs_of(spark, src: str, python: str = "syntax"):
    cells = C.split_cells(assets_of(spark, {"/nb": src}))
    return E.extract_references(cells, python=python).collect()


def scan_of(spark, src: str, mapping=None, mounts=None):
    mapping = mapping if mapping is not None else DM.demo_mapping(spark)
    mounts = mounts if mounts is not None else DM.demo_mounts(spark)
    return SC.scan_resolved(assets_of(spark, {"/nb": src}), mapping, mounts).collect()


def propose(spark, kind: str, original: str, mapping=None, mounts=None):
    """Resolve one reference row directly (the reference's `propose`)."""
    mapping = mapping if mapping is not None else DM.demo_mapping(spark)
    mounts = mounts if mounts is not None else DM.demo_mounts(spark)
    refs = spark.createDataFrame([("notebook", "/nb", 0, kind, original, 1)],
                                 "asset_type string, asset_path string, cell_index int, reference_kind string, "
                                 "original_reference string, occurrences int")
    return R.resolve(refs, mapping, mounts).collect()[0]


def col(rows, name):
    return [getattr(r, name) for r in rows]


__all__ = ["NB", "SEP", "F", "assets_of", "cells_of", "refs_of", "scan_of", "propose", "col"]
