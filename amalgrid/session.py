"""Session helpers: one place for Spark settings and for cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "amalgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this engine expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # What was cut goes when nothing refers to it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; only where none is named, fall back to a local one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        # One machine: its own folder is shared by all tasks. It goes with the process.
        place = tempfile.mkdtemp(prefix="amalgrid-checkpoint-")
        atexit.register(shutil.rmtree, place, ignore_errors=True)
        sc.setCheckpointDir(place)
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
