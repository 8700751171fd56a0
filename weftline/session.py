"""Session factory. Everything here only fills settings the caller left open."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app: str = "weftline", cores: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; in local mode the shuffle width follows the cores.

    On a cluster, master, memory and shuffle width come from spark-submit and
    are left alone here.
    """
    builder = SparkSession.builder.appName(app)
    if cores or "SPARK_MASTER" not in os.environ:
        n = cores or min(8, os.cpu_count() or 8)
        builder = builder.master(f"local[{n}]").config("spark.sql.shuffle.partitions", str(n)).config("spark.driver.memory", "8g")
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.ui.enabled": "false",
    } | conf
    return ship(builder.config(map=settings).getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, wherever they run; once per context.

    Workers on this machine get its folder in their path, those of a cluster a
    zip of the package.
    """
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if str(root) in paths:
        return spark
    sc.environment["PYTHONPATH"] = os.pathsep.join([str(root), *filter(None, paths)])
    if not sc.master.startswith("local") and str(root) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        with tempfile.NamedTemporaryFile(prefix="weftline-", suffix=".zip", delete=False) as file, zipfile.ZipFile(file, "w") as z:
            for p in (root / "weftline").rglob("*.py"):
                z.write(p, p.relative_to(root))
        sc.addPyFile(file.name)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors, as named in spark.checkpoint.dir.

    Only where that is unset and all runs on one machine (tests) a temporary
    folder is made; on a cluster the setting is required, as a folder of the
    driver's machine would not be seen by the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-checkpoint-"))
        current = sc.getCheckpointDir()
    return current
