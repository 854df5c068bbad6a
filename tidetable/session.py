"""Session helpers: table loading and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sides up to this many estimated bytes are hinted for broadcast; beyond it Catalyst and AQE choose.
BROADCAST_LIMIT = 8 << 20

#: Fixed value: bytes of the largest method that the JVM's compiler takes.
METHOD_LIMIT = 8000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of ``sf_dir``. All instants in the tables are UTC, so the session's zone is set to UTC.

    Generated methods above :data:`METHOD_LIMIT` bytes are never compiled by the JVM and run interpreted; with the limit told, Spark
    evaluates such a stage in smaller pieces instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_LIMIT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df``; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the optimizer's estimate stays under ``limit``; otherwise leave the choice to the planner."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df



def workspace(spark: SparkSession, name: str) -> str:
    """A new folder for written tables under the shared folder that ``spark.checkpoint.dir`` names; in a local session without one, under the
    machine's temporary folder, which is removed when the process ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        path = os.path.join(tempfile.gettempdir(), f"tidetable-{os.getuid()}", f"{name}-{uuid.uuid4().hex}")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        return path
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
