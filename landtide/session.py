"""Session settings that the plans are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with UTC times and adaptive execution; cluster settings are left to spark-submit."""
    conf = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.sources.partitionOverwriteMode": "dynamic"} | more
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _needs_setting(spark: SparkSession) -> None:
    """On a cluster a temporary folder would be one machine's own."""
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and every executor share")


def checkpointed(spark: SparkSession) -> None:
    """See to a checkpoint folder: that of spark.checkpoint.dir, or a temporary one where it is unset in local mode."""
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir") and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        _needs_setting(spark)
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="landtide-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, as a URI; a temporary one where it is unset in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        _needs_setting(spark)
        found = getattr(spark, "_landtide_folder", None) or tempfile.mkdtemp(prefix="landtide-")
        spark._landtide_folder = found
    return found.rstrip("/") if ":" in found.split("/")[0] else f"file://{found.rstrip('/')}"
