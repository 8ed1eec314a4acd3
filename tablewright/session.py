"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tablewright", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs are tuned for; a cluster keeps its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one in the warehouse.

    Both are folders that all executors reach. Never a temporary folder: on a cluster the
    executors would each write to their own disk and lose it with the executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to, under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/scratch/{uuid.uuid4().hex}/{name}"


def write_once(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    For rows several branches use: each then reads only the columns it needs, and the size
    of the table is known to the planner.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written rows."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
