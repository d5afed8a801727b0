"""Months: "YYYY-MM" outside, year * 12 + month - 1 inside, so windows are integer ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ym_of(date: Column) -> Column:
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


def parse(month: Column) -> Column:
    return (F.substring(month, 1, 4).cast("int") * 12 + F.substring(month, 6, 2).cast("int") - 1).cast("int")


def text_of(ym: Column) -> Column:
    return F.format_string("%04d-%02d", ((ym - ym % 12) / 12).cast("int"), (ym % 12 + 1).cast("int"))


def window_of(end: Column, years_back: int = 0, n: int = 3) -> Column:
    """The n months that end at ``end`` shifted by whole years."""
    last = end - 12 * years_back
    return F.sequence(last - (n - 1), last)


def needed(end: Column, years: tuple = (0, 1, 2), n: int = 3) -> Column:
    """All months that a detection reads, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[window_of(end, y, n) for y in years]))))


def water_months(end: Column, n: int = 24, window: int = 3) -> Column:
    """The n months before the window that ends at ``end``."""
    return F.sequence(end - (window - 1) - n, end - window)


def month_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A row for each month from first to last."""
    bounds = spark.range(1).select(parse(F.lit(first)).alias("a"), parse(F.lit(last)).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("ym")).withColumn("month", text_of(F.col("ym")))


def missing(wanted: DataFrame, available: DataFrame, on: str = "ym") -> DataFrame:
    return wanted.join(available.select(on).distinct(), on, "left_anti")


def declaration_year(first: Column) -> Column:
    """The year whose declaration precedes a month: that of its year from June on, else of the year before."""
    year = ((first - first % 12) / 12).cast("int")
    return F.when(first % 12 + 1 >= 6, year).otherwise(year - 1)


def permit_lower_bound(first: Column, months: int) -> Column:
    """First day of the month so many months before a month."""
    back = first - months
    return F.make_date(((back - back % 12) / 12).cast("int"), back % 12 + 1, F.lit(1))
