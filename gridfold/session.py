"""A session with the settings that the library expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "gridfold", **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew handling; whatever else a caller sets by `settings` (dots as __)."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """df materialised in the folder that spark.checkpoint.dir names, which a cluster's machines share; a temporary one is
    set where that is unset on one machine. For steps that are repeated or read more than once."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one where that is unset, if all runs on one machine, else RuntimeError."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        where = "file://" + tempfile.mkdtemp(prefix="gridfold-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")
