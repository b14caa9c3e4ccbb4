"""Session helpers: a local session for tests/bench, and the shared folder.

On a cluster the session comes from ``spark-submit``; library code never builds
one. Everything that has to be written mid-job (checkpoints, landed files,
materialised tables) goes under ``spark.checkpoint.dir``, a folder shared by
all executors. A session without that setting raises; ``local_session`` (tests,
``bench.py``) sets a folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "cartlens") -> SparkSession:
    """A local session configured the way the tests and ``bench.py`` expect."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    local_shared_dir(spark)
    ensure_shared_dir(spark)
    return spark


def local_shared_dir(spark: SparkSession) -> None:
    """Give a local-mode session without ``spark.checkpoint.dir`` a folder of its
    own. For tests and benchmarks: on a cluster such a folder is not shared."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cartlens-ckpt-"))


def ensure_shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which must be set to a folder all executors share."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session: the server owns the setting
        return current
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return current


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the shared folder: the plan behind
    ``df`` runs once and later readers start from the written files."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh run id."""
    root = ensure_shared_dir(spark).rstrip("/")
    path = "/".join([root, "cartlens", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def remove_shared(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote under the shared folder (and only there)."""
    root = ensure_shared_dir(spark).rstrip("/") + "/cartlens/"
    if not path.startswith(root) or ".." in path:
        raise ValueError(f"{path} is not under {root}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
