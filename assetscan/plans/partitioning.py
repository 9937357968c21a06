"""Partitioning helpers for text-heavy stages.

Regex work per cell is CPU-bound, so it must run in many tasks. Asset tables read from a
directory of many files already arrive in many partitions; a table from few large files
(or one generated from a small table) does not. `spread` hash-partitions them on
`asset_path` to the session's shuffle-partition count: every later grouping or join on
`asset_path` (edit maps, the rewrite join, backups) then finds its input already
clustered on that key and adds no exchange of the text.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition on `keys` to the session's shuffle partitions: on a cluster that is the
    owner's sizing. Always done, so planning needs no look at the input's partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage boundary: write `df` as a Parquet table under the session's checkpoint dir
    (read from `spark.checkpoint.dir`; a scratch dir is set only when none is configured)
    and continue from the written copy. A DataFrame used twice is computed once, a lost
    executor does not recompute the stages before it, and readers get column pruning.
    (`Dataset.checkpoint` would compute the plan twice unless it were cached first.)"""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/assetscan-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
