"""Split asset sources into numbered, classified cells.

One source row becomes many cell rows through `posexplode` of a filtered array: the
numbering is dense over non-blank chunks without any window or shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def split_cells(assets: DataFrame) -> DataFrame:
    """assets(asset_type, asset_path, source, ...) -> cells(asset_type, asset_path,
    cell_index INT, language, code).

    Notebooks are split on the COMMAND separator; dashboard rows (`queries` array) give
    one SQL cell per query, numbered by position."""
    cols = assets.columns
    # An asset without a source has no text below. No filter on the source says so here: Catalyst would push it through
    # the exchange to where a computed source is built, and build it twice.
    nb = assets
    texts = F.transform(X.split_chunks(X.strip_header(F.col("source"))), X.chunk_text)
    kept = F.filter(texts, lambda t: ~X.is_blank(t))
    # posexplode_outer + a filter on its output: with a plain posexplode Catalyst infers a
    # size(kept) > 0 filter below it and splits every source twice.
    own = F.lower(F.coalesce(F.col("language"), F.lit("python"))) if "language" in cols else F.lit("python")
    notebook_cells = (nb.select("asset_type", "asset_path", own.alias("_own"), F.posexplode_outer(kept).alias("cell_index", "text"))
                      .filter(F.col("text").isNotNull())
                      .withColumn("language", X.cell_language(F.col("text"), F.col("_own")))
                      .withColumn("code", X.cell_code(F.col("text"), F.col("language")))
                      .select("asset_type", "asset_path", F.col("cell_index").cast("int"),
                              "language", "code"))
    if "queries" not in cols:
        return notebook_cells
    dashboard_cells = (assets.filter(F.col("queries").isNotNull())
                       .select("asset_type", "asset_path",
                               F.posexplode("queries").alias("cell_index", "code"))
                       .select("asset_type", "asset_path", F.col("cell_index").cast("int"),
                               F.lit("sql").alias("language"), "code"))
    return notebook_cells.unionByName(dashboard_cells)
