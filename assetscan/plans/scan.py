"""Stage 2, scan and propose: assets -> cells -> references -> resolved manifest rows.

One lazy plan. Exchanges: the dedupe `groupBy` (partial aggregation runs map-side) and
the lookup joins (broadcast or shuffled as the session's threshold and AQE decide).
The only Python-worker step is the syntax job over prefiltered Python cells.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cells as C
from ..operators import extract as E
from ..operators import manifest as M
from ..operators import resolve as R
from .partitioning import spread


def scan_references(assets: DataFrame, python: str = "syntax") -> DataFrame:
    """E9 + fix 8: deduplicated references with occurrences."""
    assets = spread(assets, "asset_path")
    return E.dedupe_references(E.extract_references(C.split_cells(assets), python=python))


def scan_resolved(assets: DataFrame, mapping: DataFrame, mounts: DataFrame,
                  python: str = "syntax") -> DataFrame:
    """Scan rows (reference + proposal)."""
    return R.resolve(scan_references(assets, python=python), mapping, mounts)


def scan_to_manifest(assets: DataFrame, mapping: DataFrame, mounts: DataFrame, as_of: str,
                     python: str = "syntax") -> DataFrame:
    """S8 + S9: manifest rows with status 'proposed' for the notebook and dashboard assets."""
    scoped = assets.filter(F.col("asset_type").isin("notebook", "dashboard"))
    return M.proposed_rows(scan_resolved(scoped, mapping, mounts, python=python), as_of)
