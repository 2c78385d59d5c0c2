"""Session helpers: the shared checkpoint folder and tables written into it."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for tables that cut lineage, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster the folder has to be
    readable from every executor, so an unset value is an error there.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wattlane-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/wattlane/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Columnar, so later readers prune columns; on storage, so a lost executor costs one task.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless their path has it: functions inside tasks import it."""
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    name = f"wattlane-{os.getpid()}-{spark.sparkContext.applicationId}.zip"
    if root in known or any(f.endswith(name) for f in spark.sparkContext.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="wattlane-package-"), name)  # on the driver; Spark serves it
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)


def local_session(app: str = "wattlane", cpus: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster job brings its own."""
    parts = str(cpus) if str(cpus).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.sql.adaptive.enabled", "true")
        # Hash instead of sort-merge joins, but only where every partition is known to be small.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        # Split a hot key of a join even where that costs another shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
