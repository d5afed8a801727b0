"""Change detection over three-month windows.

A composite is partitioned by cell, and so is all that follows: each month is exploded into the
three windows it belongs to, and if it was water into the windows after it that this rules out; each
window into the years it is compared in. Every aggregation finds its rows in place and nothing is
joined, so a detection reads its months once and shuffles them once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import PARAMS, Params


def windows(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """cell, we (the window's last month), q (best of its months) and n (observations in all)."""
    spread = comp.select("cell", F.explode(F.sequence(F.col("ym"), F.col("ym") + p.window_months - 1)).alias("we"), "q", "n")
    return spread.groupBy("cell", "we").agg(F.max("q").alias("q"), F.sum("n").cast("long").alias("n"))


def marked(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Windows with wet: was the cell water in one of the months before? Windows that only water marks have no q."""
    one = lambda we, q, n, wet: F.struct(we.alias("we"), q.cast("int").alias("q"), n.cast("long").alias("n"), F.lit(wet).alias("wet"))
    none, w = F.lit(None), p.window_months
    own = F.transform(F.sequence(F.col("ym"), F.col("ym") + w - 1), lambda m: one(m, F.col("q"), F.col("n"), False))
    after = F.transform(F.sequence(F.col("ym") + w, F.col("ym") + w + p.water_months - 1), lambda m: one(m, none, none, True))
    spread = comp.select("cell", F.inline(F.when(F.col("q") < p.water_q, F.concat(own, after)).otherwise(own)))
    return spread.groupBy("cell", "we").agg(F.max("q").alias("q"), F.sum("n").alias("n"), F.bool_or("wet").alias("wet"))


def compared(win: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Each window beside the same one of the reference years: cell, we, q, n, r (least reference), rn (least count), years; wet if ``win`` has it."""
    shifts = F.array(F.lit(0), *[F.lit(12 * y) for y in p.reference_years])
    roles = win.select("*", F.explode(shifts).alias("shift")).withColumn("at", F.col("we") + F.col("shift"))
    now, then = F.col("shift") == 0, F.col("shift") > 0
    wet = [F.bool_or(now & F.col("wet")).alias("wet")] if "wet" in win.columns else []
    return roles.groupBy("cell", F.col("at").alias("we")).agg(
        F.max(F.when(now, F.col("q"))).alias("q"), F.max(F.when(now, F.col("n"))).alias("n"), F.min(F.when(then, F.col("q"))).alias("r"), F.min(F.when(then, F.col("n"))).alias("rn"), F.count(F.when(then, F.col("q"))).alias("years"), *wet
    )


def _readable(both: DataFrame, p: Params) -> DataFrame:
    return both.filter((F.col("n") >= p.least_obs) & (F.col("years") == len(p.reference_years)) & (F.col("rn") >= p.least_obs)).drop("rn", "years")


def evaluable(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Windows with enough observations now and in every reference year."""
    return _readable(compared(windows(comp, p), p), p).select("cell", "we", "q", "n", "r")


def _lost(p: Params):
    return ~F.col("wet") & (F.col("r") >= p.reference_q) & (F.col("q") <= p.current_q) & (F.col("r") - F.col("q") >= p.drop_q)


def prior_water(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """cell and we of windows before which, within so many months, the cell was water."""
    w = p.window_months
    wet = comp.filter(F.col("q") < p.water_q)
    return wet.select("cell", F.explode(F.sequence(F.col("ym") + w, F.col("ym") + w + p.water_months - 1)).alias("we")).distinct()


def candidates(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Evaluable windows, not water before, that lost their vegetation: cell, we, q, n, r."""
    return _readable(compared(marked(comp, p), p), p).filter(_lost(p)).select("cell", "we", "q", "n", "r")


def run_stats(comp: DataFrame, p: Params = PARAMS) -> DataFrame:
    """Of each window: cells that could be evaluated, water before, candidates, and the share evaluated of all cells."""
    rows = _readable(compared(marked(comp, p), p), p)
    total = comp.agg(F.countDistinct("cell").alias("cells"))
    out = rows.groupBy("we").agg(F.count(F.when(~F.col("wet"), 1)).alias("evaluable"), F.count(F.when(F.col("wet"), 1)).alias("prior_water"), F.count(F.when(_lost(p), 1)).alias("candidates"))
    return out.crossJoin(F.broadcast(total)).select("we", "evaluable", "prior_water", "candidates", F.round(F.col("evaluable") / F.col("cells"), 3).alias("share"))


def last_vegetation(cells: DataFrame, comp: DataFrame, back: int = 15, share: float = 0.5, p: Params = PARAMS) -> DataFrame:
    """cells: alert, cell, first. The latest of the ``back`` months up to ``first`` in which at least ``share`` of an alert's cells have data and their median is vegetated."""
    sizes = cells.groupBy("alert").agg(F.countDistinct("cell").alias("size"))
    near = cells.join(comp, "cell").filter(F.col("ym").between(F.col("first") - (back - 1), F.col("first")))
    monthly = near.groupBy("alert", "ym").agg(F.count("q").alias("k"), F.median("q").alias("mid")).join(sizes, "alert")
    return monthly.filter((F.col("k") >= share * F.col("size")) & (F.col("mid") >= p.reference_q)).groupBy("alert").agg(F.max("ym").alias("last_ym"))


def zonal_mean(cells: DataFrame, win: DataFrame, p: Params = PARAMS) -> DataFrame:
    """cells: alert, cell. The mean current index of an alert in each window; null where under half of its cells can be read."""
    sizes = cells.groupBy("alert").agg(F.count("*").alias("size"))
    good = cells.join(win, "cell").filter((F.col("q") > 0) & (F.col("n") >= p.least_obs))
    got = good.groupBy("alert", "we").agg((F.avg("q") / 100.0 - 1.0).alias("m"), F.count("*").alias("k")).join(sizes, "alert")
    least = F.greatest(F.lit(1), F.floor(F.col("size") / 2))
    return got.select("alert", "we", F.when(F.col("k") >= least, F.round(F.col("m") + 1e-9, 3)).alias("ndvi"))
