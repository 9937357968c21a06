"""SparkSession helpers.

On a cluster the session already exists and its owner sets `spark.checkpoint.dir` to a
shared folder; we only read it. Tests and local runs get a session with a scratch
checkpoint dir of their own.
"""
from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings our jobs rely on. AQE re-plans joins at runtime and splits skewed join
# partitions (a hot table name or mount can hold a large share of all references).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "assetscan", driver_memory: str = "8g") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a scratch one only when unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # Unset in a single-process session: tests and local runs.
    scratch = tempfile.mkdtemp(prefix="assetscan-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that Python workers
    can import it wherever they were started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="assetscan-src-"), "assetscan_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
