"""The engine's inputs, bound to the tables of the contract's test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import ym_of


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations from lineitem: four cells for each supplier, line numbers as scene classes."""
    x = read(spark, sf_dir, "lineitem")
    c = F.col
    return x.select(
        (c("l_suppkey") * 4 + c("l_orderkey") % 4).alias("cell"), ym_of(c("l_shipdate")).alias("ym"), F.to_date("l_shipdate").alias("day"), c("l_linenumber").alias("scl"), (c("l_orderkey") % 2).cast("int").alias("grp"),
        (0.02 + c("l_discount")).alias("red"), (0.01 + c("l_quantity") / 100).alias("nir"), (0.02 + c("l_tax")).alias("green"), (0.02 + c("l_discount") / 2 + c("l_tax") / 2).alias("swir16"),
        (0.01 + c("l_tax") / 2).alias("blue"), (0.02 + c("l_discount") / 3).alias("swir22"),
    )


def grid(spark: SparkSession, sf_dir: str, least: float = 0.1) -> DataFrame:
    """Flagged cells of a raster: a row of embeddings is a row of the grid."""
    x = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cy"), F.posexplode("embedding").alias("cx", "v"))
    return x.filter(F.col("v").cast("double") > least).select("cy", F.col("cx").cast("long").alias("cx"))


#: The same inputs as DuckDB CTEs.
SQL_OBS = """obs AS (SELECT l_suppkey*4 + l_orderkey%4 AS cell, (year(l_shipdate)*12+month(l_shipdate)-1)::INT AS ym, l_shipdate::DATE AS day, l_linenumber AS scl, (l_orderkey%2)::INT AS grp,
  0.02::DOUBLE+l_discount AS red, 0.01::DOUBLE+l_quantity/100 AS nir, 0.02::DOUBLE+l_tax AS green, 0.02::DOUBLE+l_discount/2+l_tax/2 AS swir16, 0.01::DOUBLE+l_tax/2 AS blue, 0.02::DOUBLE+l_discount/3 AS swir22 FROM lineitem),
ok AS (SELECT *, (nir-red)/(nir+red) AS ndvi FROM obs WHERE (scl IN (4,5,7) AND NOT ((green-swir16)/(green+swir16) > 0.4 AND nir > 0.11 AND green > 0.10) AND nir >= 0.04) OR scl = 6)"""
SQL_COMP = SQL_OBS + """,
comp AS (SELECT cell, ym, least(greatest(round_even((max(ndvi)+1)*100, 0), 0), 200)::INT AS q, least(count(DISTINCT day), 254)::INT AS n FROM ok GROUP BY cell, ym)"""
SQL_WIN = SQL_COMP + """,
win AS (SELECT cell, ym + k AS we, max(q) AS q, sum(n)::BIGINT AS n FROM comp, (VALUES (0),(1),(2)) AS o(k) GROUP BY cell, ym + k)"""
SQL_EVAL = SQL_WIN + """,
ev AS (SELECT a.cell, a.we, a.q, a.n, least(b.q, c.q) AS r FROM win a JOIN win b ON a.cell=b.cell AND b.we=a.we-12 JOIN win c ON a.cell=c.cell AND c.we=a.we-24 WHERE a.n>=3 AND b.n>=3 AND c.n>=3),
water AS (SELECT DISTINCT e.cell, e.we FROM ev e JOIN comp c ON c.cell=e.cell AND c.ym BETWEEN e.we-26 AND e.we-3 WHERE c.q < 100),
cand AS (SELECT ev.* FROM ev ANTI JOIN water USING (cell, we) WHERE r >= 160 AND q <= 135 AND r - q >= 30)"""
SQL_GRID = """g AS (SELECT vec_id AS cy, unnest(generate_series(0, 63)) AS cx, unnest(embedding)::DOUBLE AS v FROM embeddings), cells AS (SELECT cy, cx::BIGINT AS cx, cy*64+cx AS id FROM g WHERE v > 0.1)"""
