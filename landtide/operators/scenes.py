"""Choice of scenes: deduplication, the least cloudy days and the best scene."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup(scenes: DataFrame) -> DataFrame:
    """scenes: grid, day, platform, baseline (text), arrival. One for each grid, day and platform: the greatest baseline, then the first to arrive."""
    order = Window.partitionBy("grid", "day", "platform").orderBy(F.desc("baseline"), "arrival")
    return scenes.withColumn("k", F.row_number().over(order)).filter("k = 1").drop("k")


def search(scenes: DataFrame, first: str, last: str, cloud_below: float = 90.0) -> DataFrame:
    """Scenes of a closed range of dates under a cloud limit, deduplicated; the filters reach the scan."""
    return dedup(scenes.filter(F.col("day").between(first, last) & (F.col("cloud") < cloud_below)))


def least_cloudy(scenes: DataFrame, key: str = "grid", days: int = 16) -> DataFrame:
    """The days of each key with the least cloud, and how many scenes they have. Ranked before anything of a pixel is read."""
    daily = scenes.groupBy(key, "day").agg(F.min("cloud").alias("cloud"), F.count("*").alias("n_scenes"))
    order = Window.partitionBy(key).orderBy("cloud", "day")
    return daily.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= days)


def best(days: DataFrame, key: str = "grid") -> DataFrame:
    """days: key, day, f_in, f_box, ndvi. The clear day of the greatest index; else the one that shows most, if that is enough; else null."""
    clean = (F.col("f_in") >= 0.95) & (F.col("f_box") >= 0.85)
    some = F.max_by(F.struct("day", "f_in", "f_box"), F.struct("f_in", "day"))
    out = days.groupBy(key).agg(F.max(F.when(clean, F.struct("ndvi", "day")))["day"].alias("clear_day"), some.alias("most"))
    fallback = F.when((F.col("most.f_in") >= 0.8) & (F.col("most.f_box") >= 0.6), F.col("most.day"))
    return out.select(key, F.coalesce("clear_day", fallback).alias("day"), F.col("clear_day").isNotNull().alias("clear"))


def mosaic(pixels: DataFrame, bands: list[str], order: str) -> DataFrame:
    """The first value that isn't null of each band, by ``order``, over the scenes of one day."""
    firsts = [F.min_by(b, F.when(F.col(b).isNotNull(), F.col(order))).alias(b) for b in bands]
    return pixels.groupBy("cell", "day").agg(*firsts)
