"""Monthly maximum-value composites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spectral import normalised, quantise, valid


def observations(obs: DataFrame) -> DataFrame:
    """Valid observations with their index: cell, ym, day, ndvi."""
    good = obs.filter(valid(F.col("scl"), F.col("green"), F.col("nir"), F.col("swir16")))
    return good.select("cell", "ym", "day", normalised(F.col("nir"), F.col("red")).alias("ndvi"))


def composite(obs: DataFrame) -> DataFrame:
    """cell, ym, q (the best index, quantised) and n (solar days with a valid observation, at most 254).

    Scenes of one solar day count once. One shuffle by cell carries both steps and, downstream,
    every window over months.
    """
    daily = observations(obs).repartition("cell").groupBy("cell", "ym", "day").agg(F.max("ndvi").alias("ndvi"))
    monthly = daily.groupBy("cell", "ym").agg(F.max("ndvi").alias("best"), F.count("ndvi").alias("n"))
    return monthly.select("cell", "ym", quantise(F.col("best")).alias("q"), F.least("n", F.lit(254)).cast("int").alias("n"))


def merge_partials(parts: DataFrame) -> DataFrame:
    """Composites of disjoint groups of scenes in one: the largest index, counts added."""
    return parts.groupBy("cell", "ym").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def partial(obs: DataFrame, group: str = "grp") -> DataFrame:
    """The composite of each group of scenes."""
    good = obs.filter(valid(F.col("scl"), F.col("green"), F.col("nir"), F.col("swir16")))
    return good.groupBy("cell", "ym", group).agg(F.max(normalised(F.col("nir"), F.col("red"))).alias("best"), F.count("*").alias("n"))


def run_metadata(obs: DataFrame) -> DataFrame:
    """Of each month: scenes, distinct days, cells with data."""
    return obs.groupBy("ym").agg(F.count("*").alias("n_obs"), F.countDistinct("day").alias("n_days"), F.countDistinct("cell").alias("n_cells"))


def in_zone(cells: DataFrame, zone: DataFrame, keys: list[str]) -> DataFrame:
    return cells.join(zone, keys, "left_semi")
