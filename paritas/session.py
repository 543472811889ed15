"""Session helpers: configuration reads, checkpoint and output locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

OUTPUT_DIR_CONF = "spark.paritas.outputDir"


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return default if value in (None, "") else int(value)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local["):  # one machine: any folder is shared
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="paritas-ckpt-"))
        return sc.getCheckpointDir()
    return None


def require_checkpoint_dir(spark: SparkSession) -> str:
    folder = checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: the "
                           "plan for hot keys materialises their rows there")
    return folder


def output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for sink output under ``spark.paritas.outputDir``, else
    under the session's warehouse folder (the cluster's shared table storage)."""
    base = spark.conf.get(OUTPUT_DIR_CONF, None) or spark.conf.get("spark.sql.warehouse.dir")
    base = base.rstrip("/")
    return f"{base}/paritas_out/{name}_{uuid.uuid4().hex[:12]}"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "paritas") -> SparkSession:
    """Session used by tests and the bench (local mode, UI off)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", os.environ.get("PARITAS_DRIVER_MEMORY", "16g")))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    require_checkpoint_dir(spark)
    return spark
