"""Registry of the engine's queries and of their oracle SQL.

Each query applies one operator, or a few, to whole tables of the test data through the bindings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy, locale, months, spectral, text
from ..operators import components as comps
from ..operators import composite as cm
from ..operators import detect, geometry, lifecycle, overlay, permits, publish, scenes
from .bindings import SQL_COMP, SQL_EVAL, SQL_GRID, SQL_OBS, SQL_WIN, grid, obs, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WIDTH = 64


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def comp_of(spark: SparkSession, d: str) -> DataFrame:
    return cm.composite(obs(spark, d))


# observation and composite ------------------------------------------------------------------------


@query("obs_validity", f"WITH {SQL_OBS} SELECT o.scl, count(*) AS n, (SELECT count(*) FROM ok WHERE ok.scl = o.scl) AS n_valid FROM obs o GROUP BY o.scl")
def obs_validity(spark, d):
    c = F.col
    return obs(spark, d).groupBy("scl").agg(F.count("*").alias("n"), F.count(F.when(spectral.valid(c("scl"), c("green"), c("nir"), c("swir16")), 1)).alias("n_valid"))


@query(
    "spectral_indices",
    f"""WITH {SQL_OBS} SELECT cell // 4 AS grid, round(median((nir-red)/(nir+red)), 6) AS ndvi, round(median((green-swir16)/(green+swir16)), 6) AS mndwi, round(median((nir-swir22)/(nir+swir22)), 6) AS nbr,
 round(median(((swir16+red)-(nir+blue))/((swir16+red)+(nir+blue))), 6) AS bsi, round(median((blue+green+red)/3), 6) AS brightness FROM obs GROUP BY cell // 4""",
)
def spectral_indices(spark, d):
    c = F.col
    found = spectral.indices(c("blue"), c("green"), c("red"), c("nir"), c("swir16"), c("swir22"))
    return obs(spark, d).groupBy(F.expr("cell div 4").alias("grid")).agg(*[F.round(F.median(v), 6).alias(k) for k, v in found.items()])


@query("monthly_composite", f"WITH {SQL_COMP} SELECT cell, ym, q, n FROM comp")
def monthly_composite(spark, d):
    return comp_of(spark, d)


@query("composite_partial_final", f"WITH {SQL_OBS} SELECT cell, ym, round(max(ndvi), 9) + 0.0 AS best, count(*) AS n FROM ok GROUP BY cell, ym")
def composite_partial_final(spark, d):
    return cm.merge_partials(cm.partial(obs(spark, d))).select("cell", "ym", (F.round("best", 9) + 0.0).alias("best"), "n")


@query("composite_metadata", f"WITH {SQL_OBS} SELECT ym, count(*) AS n_obs, count(DISTINCT day) AS n_days, count(DISTINCT cell) AS n_cells FROM obs GROUP BY ym")
def composite_metadata(spark, d):
    return cm.run_metadata(obs(spark, d))


@query("zone_mask", f"WITH {SQL_OBS} SELECT cell, count(*) AS n FROM obs WHERE cell // 4 IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10) GROUP BY cell")
def zone_mask(spark, d):
    zone = read(spark, d, "supplier").filter("s_nationkey < 10").select(F.explode(F.sequence(F.col("s_suppkey") * 4, F.col("s_suppkey") * 4 + 3)).alias("cell"))
    return cm.in_zone(obs(spark, d), zone, ["cell"]).groupBy("cell").agg(F.count("*").alias("n"))


@query(
    "boa_reflectance",
    """SELECT l_orderkey, l_linenumber, CASE WHEN s THEN CASE WHEN dn > 0 THEN round(dn * 1e-4, 6) END ELSE CASE WHEN dn > 1000 THEN round((dn - 1000) * 1e-4, 6) END END AS refl
 FROM (SELECT *, l_quantity * 100 AS dn, printf('%05.2f', l_tax * 100) < '04.00' AS s FROM lineitem)""",
)
def boa_reflectance(spark, d):
    x = read(spark, d, "lineitem")
    shift = spectral.boa_shift(F.format_string("%05.2f", F.col("l_tax") * 100), F.lit(False), F.lit(None).cast("double"), F.lit(None).cast("double"))
    return x.select("l_orderkey", "l_linenumber", F.round(spectral.reflectance(F.col("l_quantity") * 100, shift), 6).alias("refl"))


# detection ----------------------------------------------------------------------------------------


@query("window3_max", f"WITH {SQL_WIN} SELECT cell, we, q, n FROM win")
def window3_max(spark, d):
    return detect.windows(comp_of(spark, d))


@query("reference_min", f"WITH {SQL_EVAL} SELECT cell, we, q, n, r FROM ev")
def reference_min(spark, d):
    return detect.evaluable(comp_of(spark, d))


@query("prior_water", f"WITH {SQL_COMP} SELECT DISTINCT cell, ym + k AS we FROM comp, generate_series(3, 26) AS g(k) WHERE q < 100")
def prior_water(spark, d):
    return detect.prior_water(comp_of(spark, d)).select("cell", F.col("we").cast("long").alias("we"))


@query("change_candidates", f"WITH {SQL_EVAL} SELECT cell, we, q, n, r FROM cand")
def change_candidates(spark, d):
    return detect.candidates(comp_of(spark, d))


@query(
    "run_stats",
    f"""WITH {SQL_EVAL}, f AS (SELECT e.*, w.cell IS NOT NULL AS wet FROM ev e LEFT JOIN water w USING (cell, we))
SELECT we, count(*) FILTER (NOT wet) AS evaluable, count(*) FILTER (wet) AS prior_water, count(*) FILTER (NOT wet AND r >= 160 AND q <= 135 AND r - q >= 30) AS candidates,
 round(count(*) FILTER (NOT wet) / (SELECT count(DISTINCT cell) FROM comp), 3) AS share FROM f GROUP BY we""",
)
def run_stats(spark, d):
    return detect.run_stats(comp_of(spark, d))


@query(
    "last_vegetation_asof",
    f"""WITH {SQL_COMP}, a AS (SELECT DISTINCT cell // 4 AS alert, cell, 23981 + (cell // 4) % 24 AS first FROM comp), s AS (SELECT alert, count(*) AS size FROM a GROUP BY alert),
m AS (SELECT a.alert, ym, count(q) AS k, median(q) AS mid FROM a JOIN comp USING (cell) WHERE ym BETWEEN first - 14 AND first GROUP BY a.alert, ym)
SELECT alert, max(ym) AS last_ym FROM m JOIN s USING (alert) WHERE k >= 0.5 * size AND mid >= 160 GROUP BY alert""",
)
def last_vegetation_asof(spark, d):
    comp = comp_of(spark, d)
    cells = comp.select(F.expr("cell div 4").alias("alert"), "cell").distinct().withColumn("first", 23981 + F.col("alert") % 24)
    return detect.last_vegetation(cells, comp)


@query(
    "zonal_mean",
    f"""WITH {SQL_WIN}, a AS (SELECT DISTINCT cell // 4 AS alert, cell FROM comp), s AS (SELECT alert, count(*) AS size FROM a GROUP BY alert),
g AS (SELECT a.alert, we, avg(q) / 100.0::DOUBLE - 1.0 AS m, count(*) AS k FROM a JOIN win USING (cell) WHERE q > 0 AND n >= 3 GROUP BY a.alert, we)
SELECT alert, we, CASE WHEN k >= greatest(1, size // 2) THEN round(m + 1e-9, 3) END AS ndvi FROM g JOIN s USING (alert)""",
)
def zonal_mean(spark, d):
    comp = comp_of(spark, d)
    return detect.zonal_mean(comp.select(F.expr("cell div 4").alias("alert"), "cell").distinct(), detect.windows(comp))


# components ---------------------------------------------------------------------------------------

SQL_COMPS = f"""{SQL_GRID}, nb AS (SELECT a.id AS a, b.id AS b FROM cells a, (VALUES (0,1),(1,-1),(1,0),(1,1),(0,-1),(-1,1),(-1,0),(-1,-1)) AS o(dy,dx) JOIN cells b ON b.cy = a.cy + dy AND b.cx = a.cx + dx),
reach(id, label) AS (SELECT id, id FROM cells UNION SELECT nb.b, r.label FROM reach r JOIN nb ON nb.a = r.id WHERE r.label < nb.b), lab AS (SELECT id, min(label) AS comp FROM reach GROUP BY id)"""


@query("components8", f"WITH RECURSIVE {SQL_COMPS} SELECT cy, cx, comp FROM cells JOIN lab USING (id)")
def components8(spark, d):
    return comps.components(grid(spark, d), WIDTH)


@query("min_unit", f"WITH RECURSIVE {SQL_COMPS} SELECT comp, count(*) AS pixels FROM lab GROUP BY comp HAVING count(*) >= 5")
def min_unit(spark, d):
    return components8(spark, d).groupBy("comp").agg(F.count("*").alias("pixels")).filter("pixels >= 5")


@query(
    "component_stats",
    f"WITH RECURSIVE {SQL_COMPS} SELECT comp, count(*) AS pixels, round(avg(v), 3) AS mean_v, trunc(median(cells.cx))::BIGINT AS median_cx, round(count(*) * 100 / 10000, 2) AS ha FROM cells JOIN lab USING (id) JOIN g USING (cy, cx) GROUP BY comp",
)
def component_stats(spark, d):
    values = read(spark, d, "embeddings").select(F.col("vec_id").alias("cy"), F.posexplode("embedding").alias("cx", "v")).select("cy", F.col("cx").cast("long").alias("cx"), F.col("v").cast("double").alias("v"))
    rows = components8(spark, d).join(values, ["cy", "cx"])
    return rows.groupBy("comp").agg(F.count("*").alias("pixels"), F.round(F.avg("v"), 3).alias("mean_v"), F.median("cx").cast("long").alias("median_cx"), F.round(F.count("*") * 100 / 10000, 2).alias("ha"))


@query("contour", f"WITH {SQL_GRID}, k AS (SELECT c.cy, c.cx, count(*) AS k FROM cells c, (VALUES (0,1),(1,0),(0,-1),(-1,0)) AS o(dy,dx) JOIN cells b ON b.cy = c.cy + dy AND b.cx = c.cx + dx GROUP BY c.cy, c.cx) SELECT cy, cx FROM cells ANTI JOIN (SELECT * FROM k WHERE k = 4) USING (cy, cx)")
def contour(spark, d):
    return comps.contour(grid(spark, d))


@query(
    "boundary_edges",
    f"""WITH {SQL_GRID}, e AS (SELECT cy // 100 AS band, 'h' AS o, cy AS y, cx AS x FROM cells UNION ALL SELECT cy // 100, 'h', cy + 1, cx FROM cells UNION ALL SELECT cy // 100, 'v', cy, cx FROM cells UNION ALL SELECT cy // 100, 'v', cy, cx + 1 FROM cells)
SELECT band, o, y, x FROM e GROUP BY ALL HAVING count(*) = 1""",
)
def boundary_edges(spark, d):
    return comps.boundary_edges(grid(spark, d).withColumn("band", F.expr("cy div 100")), "band")


@query("touch_join", f"WITH {SQL_GRID} SELECT DISTINCT a.cy // 8 AS change, b.cy // 8 AS alert FROM cells a JOIN cells b ON abs(a.cy - b.cy) <= 1 AND b.cx BETWEEN a.cx - 1 AND a.cx + 1 WHERE (a.cy // 8) % 2 = 0 AND (b.cy // 8) % 2 = 1")
def touch_join(spark, d):
    cells = grid(spark, d).withColumn("k", F.expr("cy div 8"))
    return lifecycle.touches(cells.filter("k % 2 = 0").withColumnRenamed("k", "change"), cells.filter("k % 2 = 1").withColumnRenamed("k", "alert"))


@query("first_touched", "WITH t AS (" + ORACLES["touch_join"] + ") SELECT change, min(alert) AS alert, count(*) AS n_touched FROM t GROUP BY change")
def first_touched(spark, d):
    return lifecycle.first_touched(touch_join(spark, d))


SQL_FRAGMENTS = f"""{SQL_GRID}, fc AS (SELECT cy // 4 * 8 + cx // 8 AS id, cy, cx FROM cells WHERE (cy % 4 < 3) AND cx % 8 < 7), fa AS (SELECT id, (24000 + id % 7)::INT AS first, 24000 + id % 5 AS detected, count(*) AS pixels, round(avg(cx) / 64, 3) AS ndvi, CASE WHEN id % 3 = 0 THEN 'confirmada' ELSE 'provisional' END AS state FROM fc GROUP BY id),
pr AS (SELECT DISTINCT a.id AS a, b.id AS b FROM fc a JOIN fc b ON b.cy BETWEEN a.cy - 2 AND a.cy + 2 AND b.cx BETWEEN a.cx - 2 AND a.cx + 2 WHERE a.id <> b.id AND abs(a.id % 7 - b.id % 7) < 3),
fr(id, label) AS (SELECT id, id FROM fa UNION SELECT pr.b, r.label FROM fr r JOIN pr ON pr.a = r.id WHERE r.label < pr.b), grp AS (SELECT id, min(label) AS grp FROM fr GROUP BY id)"""


def fragments(spark, d) -> tuple[DataFrame, DataFrame]:
    cells = grid(spark, d).filter("cy % 4 < 3 and cx % 8 < 7").select(F.expr("cy div 4 * 8 + cx div 8").alias("id"), "cy", "cx")
    alerts = cells.groupBy("id").agg(F.count("*").alias("pixels"), F.round(F.avg("cx") / 64, 3).alias("ndvi"))
    alerts = alerts.withColumn("first", (24000 + F.col("id") % 7).cast("int")).withColumn("detected", 24000 + F.col("id") % 5).withColumn("state", F.when(F.col("id") % 3 == 0, "confirmada").otherwise("provisional"))
    return alerts, cells


@query("near_pairs_15m", f"WITH {SQL_GRID}, fc AS (SELECT cy // 4 * 8 + cx // 8 AS id, cy, cx FROM cells WHERE (cy % 4 < 3) AND cx % 8 < 7) SELECT DISTINCT a.id AS a, b.id AS b FROM fc a JOIN fc b ON b.cy BETWEEN a.cy - 2 AND a.cy + 2 AND b.cx BETWEEN a.cx - 2 AND a.cx + 2 WHERE a.id < b.id")
def near_pairs_15m(spark, d):
    cells = fragments(spark, d)[1]
    return comps.near_pairs(cells.withColumnRenamed("id", "a"), cells.withColumnRenamed("id", "b"), 2).filter("a < b")


@query("merge_groups", f"WITH RECURSIVE {SQL_FRAGMENTS} SELECT id, grp FROM grp")
def merge_groups(spark, d):
    return lifecycle.merge_groups(*fragments(spark, d))


@query(
    "merge_survivors",
    f"""WITH RECURSIVE {SQL_FRAGMENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY first, detected, pixels DESC, id) AS k FROM fa JOIN grp USING (id)),
s AS (SELECT grp, max(id) FILTER (k = 1) AS survivor, count(*) AS members, sum(pixels)::BIGINT AS pixels, round(sum(ndvi * pixels) / sum(pixels), 3) AS ndvi, max(state) FILTER (k = 1) AS own, bool_or(state = 'confirmada') AS any_c,
 coalesce(array_to_string(list_sort(list(id) FILTER (k > 1)), ','), '') AS merged FROM r GROUP BY grp)
SELECT grp, survivor, members, pixels, ndvi, CASE WHEN own = 'provisional' AND any_c THEN 'confirmada' ELSE own END AS state, merged FROM s""",
)
def merge_survivors(spark, d):
    alerts, cells = fragments(spark, d)
    return lifecycle.merge(alerts, lifecycle.merge_groups(alerts, cells))


def fragment_registry(spark, d) -> tuple[DataFrame, DataFrame]:
    """The fragments with what a registry keeps of them; each fifth is closed."""
    alerts, cells = fragments(spark, d)
    i = F.col("id")
    state = F.when(i % 5 == 0, "descartada").otherwise(F.col("state"))
    return alerts.withColumn("state", state).withColumn("ndvi_ref", F.round(F.col("ndvi") + 0.25, 3)).withColumn("months", F.array(F.col("first"), F.col("first") + (i % 4).cast("int"))).withColumn("merged", F.when(i % 2 == 0, F.array(i + 100_000)).otherwise(F.array().cast("array<bigint>"))), cells


@query(
    "merge_registry",
    f"""WITH RECURSIVE {SQL_GRID}, fc AS (SELECT cy // 4 * 8 + cx // 8 AS id, cy, cx FROM cells WHERE (cy % 4 < 3) AND cx % 8 < 7), fa AS (SELECT id, (24000 + id % 7)::INT AS first, 24000 + id % 5 AS detected, count(*) AS pixels, round(avg(cx) / 64, 3) AS ndvi, round(round(avg(cx) / 64, 3) + 0.25, 3) AS ndvi_ref,
 CASE WHEN id % 3 = 0 THEN 'confirmada' ELSE 'provisional' END AS state, [(24000 + id % 7)::INT, (24000 + id % 7 + id % 4)::INT] AS months, CASE WHEN id % 2 = 0 THEN [id + 100000] ELSE [] END AS old FROM fc WHERE id % 5 > 0 GROUP BY id),
pr AS (SELECT DISTINCT a.id AS a, b.id AS b FROM fc a JOIN fc b ON b.cy BETWEEN a.cy - 2 AND a.cy + 2 AND b.cx BETWEEN a.cx - 2 AND a.cx + 2 WHERE a.id <> b.id AND abs(a.id % 7 - b.id % 7) < 3 AND a.id % 5 > 0 AND b.id % 5 > 0),
fr(id, label) AS (SELECT id, id FROM fa UNION SELECT pr.b, r.label FROM fr r JOIN pr ON pr.a = r.id WHERE r.label < pr.b), grp AS (SELECT id, min(label) AS grp FROM fr GROUP BY id),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY first, detected, pixels DESC, id) AS k FROM fa JOIN grp USING (id)), u AS (SELECT grp, count(*) AS n FROM (SELECT DISTINCT grp, cy, cx FROM fc JOIN grp USING (id)) GROUP BY grp),
m AS (SELECT grp, list_sort(list(DISTINCT mo)) AS months, max(mo) AS last FROM (SELECT grp, unnest(months) AS mo FROM r) GROUP BY grp), o AS (SELECT grp, list(DISTINCT x) AS ids FROM (SELECT grp, unnest(old) AS x FROM r UNION ALL SELECT grp, id FROM r WHERE k > 1) GROUP BY grp)
SELECT grp, max(id) FILTER (k = 1) AS survivor, count(*) AS members, CASE WHEN max(state) FILTER (k = 1) = 'provisional' AND bool_or(k > 1 AND state = 'confirmada') THEN 'confirmada' ELSE max(state) FILTER (k = 1) END AS state,
 array_to_string(any_value(m.months), ',') AS months, any_value(m.last) AS last, round(sum(ndvi_ref * pixels) / sum(pixels), 3) AS ndvi_ref, round(sum(ndvi * pixels) / sum(pixels), 3) AS ndvi, array_to_string(list_sort(any_value(o.ids)), ',') AS merged, any_value(u.n) AS pixels, round(any_value(u.n) / 100, 2) AS ha
FROM r JOIN u USING (grp) JOIN m USING (grp) JOIN o USING (grp) GROUP BY grp HAVING count(*) > 1""",
)
def merge_registry(spark, d):
    alerts, cells = fragment_registry(spark, d)
    out = lifecycle.merge_registry(alerts, lifecycle.merge_groups(alerts, cells), cells)
    return out.withColumn("months", F.array_join(F.col("months").cast("array<string>"), ",")).withColumn("merged", F.array_join(F.col("merged").cast("array<string>"), ","))


@query(
    "grow_alerts",
    f"""WITH {SQL_GRID}, cc AS (SELECT cy // 4 * 8 + cx // 8 AS change, cy, cx FROM cells WHERE (cy % 4 < 3) AND cx % 8 < 7), ac AS (SELECT cy // 10 * 4 + cx // 16 AS alert, cy, cx FROM cells WHERE cy % 10 < 2 AND cx % 16 < 6),
c AS (SELECT change, count(*) AS grown FROM cc GROUP BY 1), a AS (SELECT alert, count(*) AS pixels FROM ac GROUP BY 1),
t AS (SELECT change, min(alert) AS alert FROM cc JOIN ac ON ac.cy BETWEEN cc.cy - 1 AND cc.cy + 1 AND ac.cx BETWEEN cc.cx - 1 AND cc.cx + 1 GROUP BY change),
b AS (SELECT alert, change, grown AS pixels FROM t JOIN c USING (change) JOIN a USING (alert) WHERE grown > a.pixels QUALIFY row_number() OVER (PARTITION BY alert ORDER BY grown DESC, change) = 1),
u AS (SELECT alert, count(*) AS n FROM (SELECT b.alert, cy, cx FROM b JOIN cc USING (change) UNION SELECT alert, cy, cx FROM ac JOIN b USING (alert)) GROUP BY alert)
SELECT alert, change, b.pixels, u.n AS cells, round(u.n / 100, 2) AS ha FROM b JOIN u USING (alert)""",
)
def grow_alerts(spark, d):
    cells = grid(spark, d)
    change_cells = cells.filter("cy % 4 < 3 and cx % 8 < 7").select(F.expr("cy div 4 * 8 + cx div 8").alias("change"), "cy", "cx")
    alert_cells = cells.filter("cy % 10 < 2 and cx % 16 < 6").select(F.expr("cy div 10 * 4 + cx div 16").alias("alert"), "cy", "cx")
    changes, alerts = change_cells.groupBy("change").agg(F.count("*").alias("pixels")), alert_cells.groupBy("alert").agg(F.count("*").alias("pixels"))
    pairs = lifecycle.touches(change_cells, alert_cells)
    return lifecycle.grow(pairs, changes, alerts, change_cells, alert_cells)


# scenes -------------------------------------------------------------------------------------------


def scene_table(spark, d) -> DataFrame:
    x = read(spark, d, "lineitem")
    return x.select(F.col("l_suppkey").alias("grid"), F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("platform"), F.format_string("%05.2f", F.col("l_tax") * 100).alias("baseline"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"), (F.col("l_discount") * 1000).alias("cloud"))


SQL_SCENES = "sc AS (SELECT l_suppkey AS grid, l_shipdate::DATE AS day, l_returnflag AS platform, printf('%05.2f', l_tax * 100) AS baseline, l_orderkey * 8 + l_linenumber AS arrival, l_discount * 1000 AS cloud FROM lineitem)"


@query("scene_dedup", f"WITH {SQL_SCENES} SELECT grid, day::DATE::VARCHAR AS day, platform, baseline, arrival, cloud FROM sc QUALIFY row_number() OVER (PARTITION BY grid, day, platform ORDER BY baseline DESC, arrival) = 1")
def scene_dedup(spark, d):
    return scenes.dedup(scene_table(spark, d)).withColumn("day", F.col("day").cast("string"))


@query("scene_search", f"WITH {SQL_SCENES} SELECT grid, day::DATE::VARCHAR AS day, platform, baseline, arrival, cloud FROM sc WHERE day BETWEEN '1998-03-01' AND '1998-03-31' AND cloud < 90 QUALIFY row_number() OVER (PARTITION BY grid, day, platform ORDER BY baseline DESC, arrival) = 1")
def scene_search(spark, d):
    return scenes.search(scene_table(spark, d), "1998-03-01", "1998-03-31").withColumn("day", F.col("day").cast("string"))


@query("least_cloudy_topk", f"WITH {SQL_SCENES}, dd AS (SELECT grid, day, min(cloud) AS cloud, count(*) AS n_scenes FROM sc GROUP BY grid, day) SELECT grid, day::DATE::VARCHAR AS day, cloud, n_scenes, row_number() OVER (PARTITION BY grid ORDER BY cloud, day)::INT AS k FROM dd QUALIFY k <= 16")
def least_cloudy_topk(spark, d):
    return scenes.least_cloudy(scene_table(spark, d)).withColumn("day", F.col("day").cast("string"))


@query(
    "best_scene",
    """WITH dd AS (SELECT l_suppkey AS grid, l_shipdate::DATE AS day, round(1 - max(l_discount), 4) AS f_in, round(1 - max(l_tax) * 3, 4) AS f_box, round(max(l_quantity) / 50, 4) AS ndvi FROM lineitem GROUP BY 1, 2),
c AS (SELECT grid, arg_max(day, (ndvi, day)) AS clear_day FROM dd WHERE f_in >= 0.95 AND f_box >= 0.85 GROUP BY grid), m AS (SELECT grid, arg_max((day, f_in, f_box), (f_in, day)) AS most FROM dd GROUP BY grid)
SELECT m.grid, coalesce(clear_day, CASE WHEN most[2] >= 0.8 AND most[3] >= 0.6 THEN most[1] END)::DATE::VARCHAR AS day, clear_day IS NOT NULL AS clear FROM m LEFT JOIN c USING (grid)""",
)
def best_scene(spark, d):
    days = read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("grid"), F.to_date("l_shipdate").alias("day")).agg(F.round(1 - F.max("l_discount"), 4).alias("f_in"), F.round(1 - F.max("l_tax") * 3, 4).alias("f_box"), F.round(F.max("l_quantity") / 50, 4).alias("ndvi"))
    return scenes.best(days).withColumn("day", F.col("day").cast("string"))


SQL_HALF = "median((nir-red)/(nir+red)) FILTER ({h}) AS ndvi{s}, median((green-swir16)/(green+swir16)) FILTER ({h}) AS mndwi{s}, median((nir-swir22)/(nir+swir22)) FILTER ({h}) AS nbr{s}, median(((swir16+red)-(nir+blue))/((swir16+red)+(nir+blue))) FILTER ({h}) AS bsi{s}, median((blue+green+red)/3) FILTER ({h}) AS brightness{s}, median(nir) FILTER ({h}) AS nir{s}"


@query(
    "classify_rules",
    f"""WITH {SQL_OBS}, m AS (SELECT cell, {SQL_HALF.format(h="ym < 23990", s="0")}, {SQL_HALF.format(h="ym >= 23990", s="1")} FROM obs GROUP BY cell)
SELECT cell, CASE WHEN ndvi0 IS NULL OR mndwi0 IS NULL OR nbr0 IS NULL OR bsi0 IS NULL OR brightness0 IS NULL OR nir0 IS NULL OR ndvi1 IS NULL OR mndwi1 IS NULL OR nbr1 IS NULL OR bsi1 IS NULL OR brightness1 IS NULL OR nir1 IS NULL THEN 'vegetacion'
 WHEN mndwi1 > 0 AND ndvi1 < 0.15 THEN 'agua' WHEN nbr0 - nbr1 > 0.27 AND nir1 < 0.8 * nir0 AND brightness1 < 0.10 THEN 'quemado' WHEN bsi1 > 0.05 AND ndvi1 < 0.25 THEN 'suelo' WHEN ndvi1 < 0.2 AND brightness1 < 0.08 AND nir1 < 0.15 THEN 'oscuro' ELSE 'vegetacion' END AS class FROM m""",
)
def classify_rules(spark, d):
    c = F.col
    found = spectral.indices(c("blue"), c("green"), c("red"), c("nir"), c("swir16"), c("swir22")) | {"nir": c("nir")}
    halves = [F.median(F.when(cond, v)).alias(k + s) for s, cond in (("0", c("ym") < 23990), ("1", c("ym") >= 23990)) for k, v in found.items()]
    rows = obs(spark, d).groupBy("cell").agg(*halves)
    return rows.select("cell", spectral.land_class({k: c(k + "0") for k in found}, {k: c(k + "1") for k in found}).alias("class"))


# life cycle ---------------------------------------------------------------------------------------


def window_events(spark, d) -> DataFrame:
    """A window of an alert for each user and day: seen by purchases, vegetation back by large values; each 13th user is a water body."""
    return read(spark, d, "events").groupBy(F.col("user_id").alias("alert"), F.day("ts").alias("t")).agg(F.bool_or(F.col("event_type") == "purchase").alias("seen"), (F.max("value") >= 150).alias("back"), F.bool_or(F.col("user_id") % 13 == 0).alias("level"))


SQL_WINDOWS = "w AS (SELECT user_id AS alert, day(ts)::INT AS t, bool_or(event_type = 'purchase') AS seen, max(value) >= 150 AS back, user_id % 13 = 0 AS level FROM events GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY alert ORDER BY t) AS i FROM w)"
SQL_FOLD = f"""{SQL_WINDOWS}, s(alert, i, state, first, last, n_seen, changes) AS (SELECT DISTINCT alert, 0::BIGINT, NULL::VARCHAR, NULL::INT, NULL::INT, 0, 0 FROM w UNION ALL
SELECT alert, i, nxt, CASE WHEN first IS NULL AND seen THEN t ELSE first END, CASE WHEN seen THEN t ELSE last END, n_seen + seen::INT, changes + (nxt IS DISTINCT FROM state)::INT FROM (SELECT s.alert, o.i, s.state, s.first, s.last, s.n_seen, s.changes, o.seen, o.t,
 CASE WHEN o.seen AND s.state IS NULL THEN 'provisional' WHEN o.seen AND s.n_seen + 1 >= 2 AND o.t > s.first AND NOT o.level THEN 'confirmada' WHEN o.seen THEN s.state
  WHEN s.state = 'provisional' AND o.back THEN 'descartada' WHEN s.state = 'confirmada' AND o.back THEN 'revertida' WHEN s.state = 'provisional' AND o.t - s.last >= 3 THEN 'descartada' ELSE s.state END AS nxt
 FROM s JOIN o ON o.alert = s.alert AND o.i = s.i + 1)), fin AS (SELECT * FROM s WHERE state IS NOT NULL QUALIFY row_number() OVER (PARTITION BY alert ORDER BY i DESC) = 1)"""


@query("lifecycle_batch", f"WITH RECURSIVE {SQL_FOLD} SELECT alert, state, first, last, n_seen, changes FROM fin")
def lifecycle_batch(spark, d):
    return lifecycle.fold(window_events(spark, d), "alert", 3)


@query("lifecycle_stream", f"WITH RECURSIVE {SQL_FOLD} SELECT alert, state, first, last, n_seen FROM fin")
def lifecycle_stream(spark, d):
    """The same fold as keyed state of a stream that is read to its end; the last update of each alert."""
    from ..streaming import alerts as stream

    return stream.run_to_end(spark, window_events(spark, d).select("alert", F.col("t").cast("int").alias("t"), "seen", "back", "level"), 3)


@query("monthly_stream", "SELECT user_id, ((year(ts) * 12 + month(ts) - 1))::INT AS ym, max(value) AS best, count(*) AS n FROM events GROUP BY 1, 2")
def monthly_stream(spark, d):
    from ..streaming import alerts as stream

    return stream.monthly_to_end(spark, f"{d}/events.parquet")


def registry(spark, d) -> DataFrame:
    """Alerts with all that publication needs, from orders."""
    x = read(spark, d, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    state = F.element_at(F.array(*[F.lit(s) for s in lifecycle.STATES]), (k % 5 + 1).cast("int"))
    klass = F.element_at(F.array(*[F.lit(s) for s in ("agua", "quemado", "suelo", "oscuro", "vegetacion")]), (c % 5 + 1).cast("int"))
    status = F.element_at(F.array(*[F.lit(s) for s in ("resolucion", "tramitacion", "sin_expediente", "pendiente")]), (c % 4 + 1).cast("int"))
    return x.select(
        F.format_string("CN-%s-%06d", F.date_format("o_orderdate", "yyyyMM"), k).alias("id"), state.alias("state"), F.to_date("o_orderdate").alias("detected"), F.round(F.col("o_totalprice") / 100000, 2).alias("ha"), (k % 90).cast("double").alias("lat"), (c % 180).cast("double").alias("lon"), klass.alias("class"), status.alias("status"),
        F.when(k % 3 > 0, F.format_string("fotos/%d.jpg", k)).alias("photo"), F.array(F.format_string("ES%07d", c % 7), F.format_string("ES%07d", k % 3)).alias("sites"), F.format_string("CN-%d", k % 11).alias("merged_into"), (k % 97 + 20).alias("pixels"),
    )


SQL_REGISTRY = """reg AS (SELECT printf('CN-%s-%06d', strftime(o_orderdate, '%Y%m'), o_orderkey) AS id, ['provisional','confirmada','descartada','revertida','fusionada'][o_orderkey % 5 + 1] AS state, o_orderdate::DATE AS detected, round(o_totalprice / 100000, 2) AS ha, (o_orderkey % 90)::DOUBLE AS lat, (o_custkey % 180)::DOUBLE AS lon,
 ['agua','quemado','suelo','oscuro','vegetacion'][o_custkey % 5 + 1] AS class, ['resolucion','tramitacion','sin_expediente','pendiente'][o_custkey % 4 + 1] AS status, CASE WHEN o_orderkey % 3 > 0 THEN printf('fotos/%d.jpg', o_orderkey) END AS photo, [printf('ES%07d', o_custkey % 7), printf('ES%07d', o_orderkey % 3)] AS sites, printf('CN-%d', o_orderkey % 11) AS merged_into, o_orderkey % 97 + 20 AS pixels, o_orderkey, o_custkey FROM orders)"""


@query("pending_analysis", f"WITH {SQL_REGISTRY} SELECT id, pixels FROM reg WHERE state IN ('provisional', 'confirmada') AND (CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END IS DISTINCT FROM 2 OR (photo IS NULL AND CASE WHEN o_orderkey % 2 > 0 THEN '2026-09' END IS DISTINCT FROM '2026-09'))")
def pending_analysis(spark, d):
    k = F.substring_index("id", "-", -1).cast("long")
    rows = registry(spark, d).withColumn("version", F.when(k % 4 > 0, k % 4)).withColumn("photo_window", F.when(k % 2 > 0, "2026-09")).withColumn("last", F.lit("2026-09"))
    return lifecycle.pending_analysis(rows, 2).select("id", "pixels")


@query("pending_parcels", f"WITH {SQL_REGISTRY} SELECT id, pixels FROM reg WHERE state NOT IN ('descartada', 'fusionada') AND CASE WHEN o_orderkey % 2 > 0 THEN pixels END IS DISTINCT FROM pixels")
def pending_parcels(spark, d):
    k = F.substring_index("id", "-", -1).cast("long")
    return lifecycle.pending_parcels(registry(spark, d).withColumn("parcel_pixels", F.when(k % 2 > 0, F.col("pixels")))).select("id", "pixels")


@query("alert_ids", f"WITH {SQL_EVAL}, x AS (SELECT cell * 100000 + we AS key, printf('%04d-%02d', we // 12, we % 12 + 1) AS month, r - q AS pixels FROM ev WHERE r - q >= 20) SELECT key, month, printf('CN-%s-%03d', replace(month, '-', ''), row_number() OVER (PARTITION BY month ORDER BY pixels DESC, key) + CASE WHEN month = '1999-05' THEN 2 ELSE 0 END) AS id FROM x")
def alert_ids(spark, d):
    found = detect.evaluable(comp_of(spark, d)).filter("r - q >= 20").select((F.col("cell") * 100000 + F.col("we")).alias("key"), months.text_of(F.col("we")).alias("month"), (F.col("r") - F.col("q")).alias("pixels"))
    return lifecycle.new_ids(found, spark.createDataFrame([("CN-199905-001",), ("CN-199905-002",)], "id string"), "CN")


# overlay ------------------------------------------------------------------------------------------

SQL_PARCELS = "pa AS (SELECT p_partkey AS parcel, (p_partkey * 7 % 480)::DOUBLE + 0.25 AS y0, (p_partkey * 13 % 60)::DOUBLE + 0.5 AS x0, (p_partkey * 7 % 480) + 0.25::DOUBLE + p_size * 0.2::DOUBLE AS y1, (p_partkey * 13 % 60) + 0.5::DOUBLE + p_size * 0.1::DOUBLE AS x1 FROM part)"
SQL_PARTS = f"""{SQL_GRID}, {SQL_PARCELS}, ac AS (SELECT cy // 10 AS alert, cy, cx FROM cells),
ov AS (SELECT alert, parcel, cy, cx, (least(cy + 1.0::DOUBLE, y1) - greatest(cy::DOUBLE, y0)) * (least(cx + 1.0::DOUBLE, x1) - greatest(cx::DOUBLE, x0)) AS area FROM ac JOIN pa ON cy + 1 > y0 AND cy < y1 AND cx + 1 > x0 AND cx < x1),
ke AS (SELECT alert, parcel, sum(area) * 100 AS m2, any_value((y1 - y0) * (x1 - x0) * 100) AS pm2 FROM ov JOIN pa USING (parcel) GROUP BY alert, parcel HAVING NOT (m2 < 200 AND m2 < 0.5 * pm2))"""


def parcel_table(spark, d) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    y, x = (k * 7 % 480).cast("double") + 0.25, (k * 13 % 60).cast("double") + 0.5
    return read(spark, d, "part").select(k.alias("parcel"), y.alias("y0"), x.alias("x0"), (y + s * 0.2).alias("y1"), (x + s * 0.1).alias("x1"))


def alert_cells(spark, d) -> DataFrame:
    return grid(spark, d).select(F.expr("cy div 10").alias("alert"), "cy", "cx")


@query("parcel_overlap", f"WITH {SQL_PARTS} SELECT alert, parcel, round(m2, 6) AS m2 FROM ke")
def parcel_overlap(spark, d):
    p = parcel_table(spark, d)
    return overlay.kept_overlaps(overlay.rectangle_overlap(alert_cells(spark, d), p), p).select("alert", "parcel", F.round("m2", 6).alias("m2"))


@query("top_parcels", f"WITH {SQL_PARTS}, r AS (SELECT alert, parcel, round(round(m2, 6) / 10000 + 1e-9, 4) AS ha FROM ke) SELECT alert, parcel, ha, row_number() OVER (PARTITION BY alert ORDER BY ha DESC, parcel)::INT AS k, count(*) OVER (PARTITION BY alert) AS n_parcels FROM r QUALIFY k <= 40")
def top_parcels(spark, d):
    return overlay.top_parcels(parcel_overlap(spark, d))


@query(
    "covered_fraction",
    f"""WITH {SQL_PARTS}, c AS (SELECT alert, cy, cx, least(sum(area), 1.0) AS area FROM ov SEMI JOIN ke USING (alert, parcel) GROUP BY alert, cy, cx), s AS (SELECT alert, count(*) AS size FROM ac GROUP BY alert)
SELECT s.alert, round(least(coalesce(sum(area) / any_value(size), 0), 1), 3) AS fraction FROM s LEFT JOIN c USING (alert) GROUP BY s.alert""",
)
def covered_fraction(spark, d):
    p, cells = parcel_table(spark, d), alert_cells(spark, d)
    parts = overlay.rectangle_overlap(cells, p)
    return overlay.covered_fraction(parts, overlay.kept_overlaps(parts, p), cells.groupBy("alert").agg(F.count("*").alias("size")))


def zone_table(spark, d) -> DataFrame:
    k = F.col("n_nationkey")
    return read(spark, d, "nation").select(F.col("n_name").alias("zone"), (k % 5 * 100.0).alias("y0"), (F.floor(k / 5) * 13.0).alias("x0"), (k % 5 * 100.0 + 95).alias("y1"), (F.floor(k / 5) * 13.0 + 12).alias("x1"))


SQL_ZONES = "zo AS (SELECT n_name AS zone, n_nationkey % 5 * 100.0::DOUBLE AS y0, n_nationkey // 5 * 13.0::DOUBLE AS x0, n_nationkey % 5 * 100.0::DOUBLE + 95 AS y1, n_nationkey // 5 * 13.0::DOUBLE + 12 AS x1 FROM nation)"


@query(
    "municipality_rank",
    f"""WITH {SQL_GRID}, {SQL_ZONES}, ov AS (SELECT cy // 10 AS alert, zone, (least(cy + 1.0::DOUBLE, y1) - greatest(cy::DOUBLE, y0)) * (least(cx + 1.0::DOUBLE, x1) - greatest(cx::DOUBLE, x0)) AS area FROM cells JOIN zo ON cy + 1 > y0 AND cy < y1 AND cx + 1 > x0 AND cx < x1),
a AS (SELECT alert, zone, round(sum(area), 6) AS area FROM ov GROUP BY alert, zone) SELECT alert, zone, area, row_number() OVER (PARTITION BY alert ORDER BY area DESC, zone DESC)::INT AS k FROM a""",
)
def municipality_rank(spark, d):
    zones = zone_table(spark, d).withColumnRenamed("zone", "parcel")
    return overlay.ranked_zones(overlay.rectangle_overlap(alert_cells(spark, d), zones).withColumnRenamed("parcel", "zone"))


@query("sites_of", "WITH m AS (" + ORACLES["municipality_rank"] + ") SELECT alert, array_to_string(list(zone ORDER BY zone), ',') AS sites FROM m GROUP BY alert")
def sites_of(spark, d):
    return municipality_rank(spark, d).groupBy("alert").agg(F.array_join(F.array_sort(F.collect_set("zone")), ",").alias("sites"))


@query(
    "nearest_municipality",
    f"""WITH {SQL_ZONES}, pt AS (SELECT c_custkey AS id, (c_custkey * 37 % 520)::DOUBLE AS y, (c_custkey * 11 % 70)::DOUBLE AS x FROM customer),
x AS (SELECT id, zone, greatest(y0 - y, 0, y - y1) ** 2 + greatest(x0 - x, 0, x - x1) ** 2 AS d2 FROM pt, zo) SELECT id, zone, round(d2, 6) AS d2 FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY d2, zone) = 1""",
)
def nearest_municipality(spark, d):
    k = F.col("c_custkey")
    return overlay.nearest(read(spark, d, "customer").select(k.alias("id"), (k * 37 % 520).cast("double").alias("y"), (k * 11 % 70).cast("double").alias("x")), zone_table(spark, d))


# text ---------------------------------------------------------------------------------------------


def notice_table(spark, d) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    words = F.concat(F.lit("Ref "), F.format_string("39%03dA%03d%05d", c % 90, c % 40, k % 300), F.lit(" y "), F.format_string("%07dVP%05d", c, k % 500), F.lit(" finca. Polígono "), (c % 40).cast("string"), F.lit(", parcelas "), (k % 300).cast("string"), F.lit(", "), (k % 17).cast("string"), F.lit(" y "), (k % 5 + 1).cast("string"), F.lit(". Parcela 3 del polígono "), (c % 9 + 1).cast("string"), F.lit("."))
    outcome = F.element_at(F.array(*[F.lit(s) for s in ("favorable", "desfavorable", "condicionada")]), (k % 3 + 1).cast("int"))
    return read(spark, d, "orders").select(k.alias("notice"), words.alias("text"), F.to_date("o_orderdate").alias("date"), F.when(k % 2 == 0, "resolucion").otherwise("tramite").alias("kind"), outcome.alias("outcome"), F.array(F.concat(F.lit("la muni "), F.translate((c % 20).cast("string"), "0123456789", "abcdefghij"))).alias("names"))


SQL_NOTICES = """no AS (SELECT o_orderkey AS notice, 'Ref ' || printf('39%03dA%03d%05d', o_custkey % 90, o_custkey % 40, o_orderkey % 300) || ' y ' || printf('%07dVP%05d', o_custkey, o_orderkey % 500) || ' finca. Polígono ' || o_custkey % 40 || ', parcelas ' || o_orderkey % 300 || ', ' || o_orderkey % 17 || ' y ' || (o_orderkey % 5 + 1) || '. Parcela 3 del polígono ' || (o_custkey % 9 + 1) || '.' AS text,
 o_orderdate::DATE AS date, CASE WHEN o_orderkey % 2 = 0 THEN 'resolucion' ELSE 'tramite' END AS kind, ['favorable','desfavorable','condicionada'][o_orderkey % 3 + 1] AS outcome, translate((o_custkey % 20)::VARCHAR, '0123456789', 'abcdefghij') AS mname, o_orderkey, o_custkey FROM orders)"""


@query(
    "extract_refs",
    f"""WITH {SQL_NOTICES}, r AS (SELECT notice, printf('39%03dA%03d%05d', o_custkey % 90, o_custkey % 40, o_orderkey % 300) AS ref FROM no UNION SELECT notice, printf('%07dVP%05d', o_custkey, o_orderkey % 500) FROM no)
SELECT notice, array_to_string(list(ref ORDER BY ref), ',') AS refs FROM r GROUP BY notice""",
)
def extract_refs(spark, d):
    return notice_table(spark, d).select("notice", F.array_join(text.references(F.col("text")), ",").alias("refs"))


@query(
    "extract_capitals",
    f"""WITH {SQL_NOTICES} SELECT DISTINCT notice, pol::INT AS pol, par::INT AS par FROM (SELECT notice, o_custkey % 40 AS pol, unnest([o_orderkey % 300, o_orderkey % 17, o_orderkey % 5 + 1]) AS par FROM no UNION SELECT notice, o_custkey % 9 + 1, 3 FROM no)""",
)
def extract_capitals(spark, d):
    """Notices all in capitals, with full-width digits in each third."""
    loud = F.when(F.col("notice") % 3 == 0, F.translate(F.upper("text"), "0123456789", "０１２３４５６７８９")).otherwise(F.upper("text"))
    return notice_table(spark, d).select("notice", F.inline(text.polygon_parcels(text.compatible(loud))))


@query("extract_rustic", f"WITH {SQL_NOTICES} SELECT notice, printf('39%03d', o_custkey % 90) AS mun, (o_custkey % 40)::INT AS pol, (o_orderkey % 300)::INT AS par FROM no")
def extract_rustic(spark, d):
    return notice_table(spark, d).select("notice", F.inline(text.rustic(F.col("text"))))


@query("extract_polparc", f"WITH {SQL_NOTICES} SELECT DISTINCT notice, pol::INT AS pol, par::INT AS par FROM (SELECT notice, o_custkey % 40 AS pol, unnest([o_orderkey % 300, o_orderkey % 17, o_orderkey % 5 + 1]) AS par FROM no UNION SELECT notice, o_custkey % 9 + 1, 3 FROM no)")
def extract_polparc(spark, d):
    return notice_table(spark, d).select("notice", F.inline(text.polygon_parcels(F.col("text"))))


@query(
    "norm_municipality",
    """SELECT doc_id, md5(regexp_replace(trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(coalesce(text, '')), '[^\\x00-\\x7F]', '', 'g')), '[^a-z ]', ' ', 'g'), ' +', ' ', 'g')), '^(el|la|los|las) ', '')) AS place_md5 FROM documents""",
)
def norm_municipality(spark, d):
    return read(spark, d, "documents").select("doc_id", F.md5(text.place(F.col("text"))).alias("place_md5"))


@query("strip_markup", "SELECT page_id, md5(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS plain_md5, length(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS n FROM pages")
def strip_markup(spark, d):
    plain = text.without_markup(F.col("html"))
    return read(spark, d, "pages").select("page_id", F.md5(plain).alias("plain_md5"), F.length(plain).cast("long").alias("n"))


@query(
    "parse_references",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN printf('39%03dA%03d%05d', o_custkey % 90, o_custkey % 40, o_orderkey % 12000) ELSE printf('%07dVP%05d', o_custkey, o_orderkey % 500) END AS ref FROM orders)
SELECT o_orderkey, CASE WHEN k THEN 'rustica' ELSE 'urbana' END AS kind, CASE WHEN k THEN substr(ref, 7, 3)::INT END AS polygon, CASE WHEN k THEN substr(ref, 10, 5)::INT END AS parcel, coalesce(k AND substr(ref, 10, 5)::INT BETWEEN 9000 AND 9999, false) AS discount FROM (SELECT *, o_orderkey % 2 = 0 AS k FROM r)""",
)
def parse_references(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ref = F.when(k % 2 == 0, F.format_string("39%03dA%03d%05d", c % 90, c % 40, k % 12000)).otherwise(F.format_string("%07dVP%05d", c, k % 500))
    return read(spark, d, "orders").select("o_orderkey", text.spanish_reference(ref).alias("p")).select("o_orderkey", "p.*")


@query("parcel_key", "SELECT p_partkey, CASE WHEN ltrim(upper(substr(p_brand, 7)), '0') <> '' AND p_partkey % 300 > 0 THEN ltrim(upper(substr(p_brand, 7)), '0') || CASE WHEN p_partkey % 300 < 10000 THEN lpad((p_partkey % 300)::VARCHAR, 4, '0') END END AS key FROM part")
def parcel_key(spark, d):
    return read(spark, d, "part").select("p_partkey", text.parcel_key(F.substr(F.col("p_brand"), F.lit(7)), F.col("p_partkey") % 300).alias("key"))


@query("permit_number", "SELECT o_orderkey, 'PC ' || substr(n, 1, 3) || ' ' || substr(n, 4, 3) || ' ' || substr(n, 7, 2) || ' ' || substr(n, 9) AS number FROM (SELECT o_orderkey, printf('064%03d%02dX%04d', o_custkey % 500, o_orderkey % 25, o_orderkey % 10000) AS n FROM orders)")
def permit_number(spark, d):
    n = F.format_string("064%03d%02dX%04d", F.col("o_custkey") % 500, F.col("o_orderkey") % 25, F.col("o_orderkey") % 10000)
    return read(spark, d, "orders").select("o_orderkey", text.permit_number(F.lit("PC"), n).alias("number"))


@query("locale_numbers", "SELECT o_orderkey, translate(format('{:,.1f}', o_totalprice), ',.', '.,') AS es, translate(format('{:,.1f}', o_totalprice), ',.', chr(8239) || ',') AS fr, round_even(o_orderkey % 100 / 99 * 100, 0)::INT || ' %' AS pct FROM orders")
def locale_numbers(spark, d):
    price = F.col("o_totalprice")
    return read(spark, d, "orders").select("o_orderkey", locale.number(price, 1, "es").alias("es"), locale.number(price, 1, "fr").alias("fr"), locale.percent(F.col("o_orderkey") % 100 / 99, "es").alias("pct"))


MES = "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre']"


@query("window_text", f"SELECT o_orderkey, CASE WHEN (ym - 2) // 12 = ym // 12 THEN m[(ym - 2) % 12 + 1] || '–' || m[ym % 12 + 1] || ' de ' || ym // 12 ELSE m[(ym - 2) % 12 + 1] || ' de ' || (ym - 2) // 12 || '–' || m[ym % 12 + 1] || ' de ' || ym // 12 END AS txt, day(o_orderdate) || ' de ' || m[month(o_orderdate)] || ' de ' || year(o_orderdate) AS day_txt FROM (SELECT *, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS ym, {MES} AS m FROM orders)")
def window_text(spark, d):
    ym = months.ym_of(F.col("o_orderdate"))
    return read(spark, d, "orders").select("o_orderkey", locale.window_text(ym - 2, ym, "es").alias("txt"), locale.long_date(F.col("o_orderdate"), "es").alias("day_txt"))


# permits ------------------------------------------------------------------------------------------

SQL_CROSS = f"""{SQL_NOTICES}, pc AS (SELECT p_partkey % 500 AS alert, p_partkey AS parcel, printf('%07dVP%05d', p_partkey % 1500, p_partkey % 500) AS ref, printf('39%03d', p_partkey % 90) AS mun, translate((p_partkey % 20)::VARCHAR, '0123456789', 'abcdefghij') AS mname, (p_partkey % 40)::INT AS pol, (p_partkey % 300)::INT AS par FROM part),
rf AS (SELECT notice, printf('39%03dA%03d%05d', o_custkey % 90, o_custkey % 40, o_orderkey % 300) AS ref FROM no UNION ALL SELECT notice, printf('%07dVP%05d', o_custkey, o_orderkey % 500) FROM no),
pp AS (SELECT DISTINCT notice, mname, pol, par FROM (SELECT notice, mname, o_custkey % 40 AS pol, unnest([o_orderkey % 300, o_orderkey % 17, o_orderkey % 5 + 1]) AS par FROM no UNION SELECT notice, mname, o_custkey % 9 + 1, 3 FROM no)),
hit AS (SELECT alert, notice FROM pc JOIN rf USING (ref) UNION SELECT alert, notice FROM pc JOIN no ON pc.mun = printf('39%03d', o_custkey % 90) AND pc.pol = o_custkey % 40 AND pc.par = o_orderkey % 300 UNION SELECT alert, notice FROM pc JOIN pp ON pc.pol = pp.pol AND pc.par = pp.par AND pc.mname = pp.mname)"""


def cross_inputs(spark, d) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    name = F.concat(F.lit("muni "), F.translate((k % 20).cast("string"), "0123456789", "abcdefghij"))
    parcels = read(spark, d, "part").select((k % 500).alias("alert"), k.alias("parcel"), F.format_string("%07dVP%05d", k % 1500, k % 500).alias("ref"), F.format_string("39%03d", k % 90).alias("mun"), name.alias("muni_name"), (k % 40).cast("int").alias("pol"), (k % 300).cast("int").alias("par"))
    notices = notice_table(spark, d).select("notice", "date", "kind", "outcome", F.inline(F.array(text.cited(F.col("text")))), "names").withColumn("munis", F.transform("names", text.plain_place))
    return parcels, notices


@query("cross_notices", f"WITH {SQL_CROSS} SELECT alert, notice FROM hit")
def cross_notices(spark, d):
    return permits.notice_hits(*cross_inputs(spark, d))


@query(
    "notice_status",
    f"""WITH {SQL_CROSS}, al AS (SELECT alert, alert % 11 > 0 AS has FROM (SELECT DISTINCT alert FROM pc)), h AS (SELECT alert, count(*) AS n, bool_or(kind = 'resolucion' AND outcome IN ('favorable','condicionada','parcial','sin_eia')) AS granted FROM hit JOIN no USING (notice) GROUP BY alert)
SELECT alert, CASE WHEN NOT has THEN 'pendiente' WHEN granted THEN 'resolucion' WHEN n > 0 THEN 'tramitacion' ELSE 'sin_expediente' END AS status, coalesce(n, 0) AS n_hits FROM al LEFT JOIN h USING (alert)""",
)
def notice_status(spark, d):
    parcels, notices = cross_inputs(spark, d)
    alerts = parcels.select("alert").distinct().withColumn("has_parcels", F.col("alert") % 11 > 0)
    return permits.notice_status(alerts, permits.notice_hits(parcels, notices), notices)


@query("first_hits", f"WITH {SQL_CROSS} SELECT alert, notice, row_number() OVER (PARTITION BY alert ORDER BY date DESC NULLS LAST, notice)::INT AS k FROM hit JOIN no USING (notice) QUALIFY k <= 8")
def first_hits(spark, d):
    parcels, notices = cross_inputs(spark, d)
    return permits.first_hits(permits.notice_hits(parcels, notices), notices)


@query("context_count", f"WITH {SQL_CROSS}, al AS (SELECT DISTINCT alert, mname FROM pc) SELECT a.alert, count(DISTINCT no.notice) AS n_context FROM (SELECT DISTINCT alert FROM pc) a LEFT JOIN al USING (alert) LEFT JOIN no ON no.mname = al.mname AND o_orderkey % 4 = 0 GROUP BY a.alert")
def context_count(spark, d):
    parcels, notices = cross_inputs(spark, d)
    bare = notices.withColumn("n_parcels", F.when(F.col("notice") % 4 == 0, 0).otherwise(1))
    return permits.context_counts(parcels.select("alert", F.col("muni_name").alias("muni")).distinct(), bare)


@query("coverage_date", "SELECT min(o_orderdate::DATE)::VARCHAR AS since FROM orders")
def coverage_date(spark, d):
    return permits.coverage_since(notice_table(spark, d)).select(F.col("since").cast("string").alias("since"))


@query("stale_footprints", "SELECT o_orderkey AS notice FROM orders WHERE o_orderkey % 4 <> 3")
def stale_footprints(spark, d):
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("notice"))
    return permits.stale_footprints(rows, rows.select("notice", (F.col("notice") % 4).alias("v")), 3)


def permit_table(spark, d) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    keys = read(spark, d, "lineitem").filter("l_linenumber <= 3").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(text.parcel_key(F.lit("0AB"), F.col("l_partkey") % 200)).alias("parcels"))
    raw = read(spark, d, "orders").join(keys, "o_orderkey")
    since = F.date_add(F.to_date("o_orderdate"), 8000)
    return raw.select(F.format_string("64%03d", c % 100).alias("commune"), F.format_string("PC %d", k).alias("number"), F.lit("PC").alias("kind"), since.alias("date"), F.element_at(F.array(F.lit("2"), F.lit("4"), F.lit("5")), (k % 3 + 1).cast("int")).alias("state"), F.lit("1").alias("dest"), "parcels")


def watched(spark, d) -> DataFrame:
    return spark.range(100).filter("id % 3 > 0").select(F.format_string("64%03d", "id").alias("commune"))


SQL_PERMITS = """pk AS (SELECT l_orderkey, list(DISTINCT 'AB' || lpad((l_partkey % 200)::VARCHAR, 4, '0')) AS parcels FROM lineitem WHERE l_linenumber <= 3 AND l_partkey % 200 > 0 GROUP BY 1),
pe AS (SELECT printf('64%03d', o_custkey % 100) AS commune, 'PC ' || o_orderkey AS number, (o_orderdate::DATE + 8000)::DATE AS date, ['2','4','5'][o_orderkey % 3 + 1] AS state, parcels FROM orders JOIN pk ON l_orderkey = o_orderkey WHERE o_custkey % 100 % 3 > 0 AND (o_orderdate::DATE + 8000) >= DATE '2018-01-01'),
pa AS (SELECT p_partkey % 400 AS alert, printf('64%03d', p_partkey % 100) AS commune, 'AB' || lpad((p_partkey % 200)::VARCHAR, 4, '0') AS parcel, (24260 + p_partkey % 40)::INT AS first FROM part),
ph AS (SELECT DISTINCT alert, number, date, state FROM pa JOIN (SELECT commune, number, date, state, unnest(parcels) AS parcel FROM pe) x USING (commune, parcel) WHERE date >= make_date((first - 36) // 12, (first - 36) % 12 + 1, 1))"""


def permit_inputs(spark, d) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    parcels = read(spark, d, "part").select((k % 400).alias("alert"), F.format_string("64%03d", k % 100).alias("commune"), F.format_string("AB%04d", k % 200).alias("parcel"), (24260 + k % 40).cast("int").alias("first"))
    return parcels, permits.permits(permit_table(spark, d), watched(spark, d))


@query("permit_etl", f"WITH {SQL_PERMITS} SELECT commune, number, date::DATE::VARCHAR AS date, state, array_to_string(list_sort(parcels), ',') AS parcels FROM pe")
def permit_etl(spark, d):
    return permits.permits(permit_table(spark, d), watched(spark, d)).select("commune", "number", F.col("date").cast("string").alias("date"), "state", F.array_join(F.array_sort("parcels"), ",").alias("parcels"))


@query("inverted_index", f"WITH {SQL_PERMITS} SELECT commune, parcel, array_to_string(list(number ORDER BY date, number), ',') AS numbers FROM (SELECT commune, number, date, unnest(parcels) AS parcel FROM pe) GROUP BY commune, parcel")
def inverted_index(spark, d):
    return permits.inverted(permit_inputs(spark, d)[1]).select("commune", "parcel", F.array_join("numbers", ",").alias("numbers"))


@query("cross_permits", f"WITH {SQL_PERMITS} SELECT alert, number, date::DATE::VARCHAR AS date, state FROM ph")
def cross_permits(spark, d):
    return permits.permit_hits(*permit_inputs(spark, d)).withColumn("date", F.col("date").cast("string"))


@query("permit_status", f"WITH {SQL_PERMITS}, al AS (SELECT alert, alert % 7 > 0 AS has FROM (SELECT DISTINCT alert FROM pa)), h AS (SELECT alert, count(*) AS n, bool_or(state <> '4') AS live FROM ph GROUP BY alert) SELECT alert, CASE WHEN NOT has THEN 'pendiente' WHEN live THEN 'resolucion' ELSE 'sin_expediente' END AS status, coalesce(n, 0) AS n_hits FROM al LEFT JOIN h USING (alert)")
def permit_status(spark, d):
    parcels, kept = permit_inputs(spark, d)
    return permits.permit_status(parcels.select("alert").distinct().withColumn("has_parcels", F.col("alert") % 7 > 0), permits.permit_hits(parcels, kept))


@query("first_permits", f"WITH {SQL_PERMITS} SELECT alert, number, row_number() OVER (PARTITION BY alert ORDER BY (state = '4')::INT, date, number)::INT AS k FROM ph QUALIFY k <= 8")
def first_permits(spark, d):
    return permits.first_permits(permits.permit_hits(*permit_inputs(spark, d)))


@query("permit_context", f"WITH {SQL_PERMITS} SELECT a.alert, count(DISTINCT pe.number) AS n_context FROM (SELECT DISTINCT alert, commune, first FROM pa) a LEFT JOIN pe ON pe.commune = a.commune AND pe.date >= make_date((first - 36) // 12, (first - 36) % 12 + 1, 1) GROUP BY a.alert")
def permit_context(spark, d):
    parcels, kept = permit_inputs(spark, d)
    return permits.permit_context(parcels.select("alert", "commune", "first").distinct(), kept)


@query("watched_communes", "WITH c AS (SELECT c_custkey AS commune, (c_custkey * 977 % 60000)::DOUBLE AS y, (c_custkey * 613 % 60000)::DOUBLE AS x FROM customer), z AS (SELECT (s_suppkey * 4001 % 60000)::DOUBLE AS y, (s_suppkey * 1009 % 60000)::DOUBLE AS x FROM supplier) SELECT DISTINCT commune FROM c JOIN z ON (c.y - z.y) ** 2 + (c.x - z.x) ** 2 <= 1000000")
def watched_communes(spark, d):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    places = read(spark, d, "customer").select(k.alias("commune"), (k * 977 % 60000).cast("double").alias("y"), (k * 613 % 60000).cast("double").alias("x"))
    return permits.watched_communes(places, read(spark, d, "supplier").select((s * 4001 % 60000).cast("double").alias("y"), (s * 1009 % 60000).cast("double").alias("x")))


@query(
    "declared_use",
    """WITH p AS (SELECT l_suppkey AS alert, p_type AS code, p_size % 6 + 14 AS grp, sum(l_quantity) AS area FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber <= 2 GROUP BY 1, 2, 3),
s AS (SELECT l_suppkey AS alert, sum(l_quantity) * CASE WHEN l_suppkey % 3 = 0 THEN 1.0 ELSE 0.5 END AS size FROM lineitem GROUP BY l_suppkey), b AS (SELECT *, sum(area) OVER (PARTITION BY alert) AS total FROM p QUALIFY row_number() OVER (PARTITION BY alert ORDER BY area DESC, grp, code DESC) = 1),
f AS (SELECT s.alert, round(least(coalesce(total / size, 0), 1), 3) AS fraction, code, grp FROM s LEFT JOIN b USING (alert))
SELECT alert, fraction, CASE WHEN code IS NULL OR fraction < 0.5 THEN 'sin_declarar' WHEN grp IN (17, 18) THEN 'pradera_permanente' ELSE 'rotacion' END AS use, code, grp::INT AS grp FROM f""",
)
def declared_use(spark, d):
    x = read(spark, d, "lineitem")
    parts = x.filter("l_linenumber <= 2").join(read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("alert"), F.col("p_type").alias("code"), (F.col("p_size") % 6 + 14).alias("grp"), F.col("l_quantity").alias("area"))
    sizes = x.groupBy(F.col("l_suppkey").alias("alert")).agg(F.sum("l_quantity").alias("t")).select("alert", (F.col("t") * F.when(F.col("alert") % 3 == 0, 1.0).otherwise(0.5)).alias("size"))
    return permits.declared_use(parts, sizes)


@query("declaration_year", "SELECT o_orderkey, (CASE WHEN month(o_orderdate) >= 6 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT AS year FROM orders")
def declaration_year(spark, d):
    return read(spark, d, "orders").select("o_orderkey", months.declaration_year(months.ym_of(F.col("o_orderdate"))).alias("year"))


@query("month_range_missing", "SELECT ym::INT AS ym, printf('%04d-%02d', ym // 12, ym % 12 + 1) AS month FROM generate_series(1990 * 12, 2005 * 12 + 11) AS g(ym) WHERE ym NOT IN (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 FROM orders)")
def month_range_missing(spark, d):
    return months.missing(months.month_range(spark, "1990-01", "2005-12"), read(spark, d, "orders").select(months.ym_of(F.col("o_orderdate")).alias("ym")))


@query("months_needed", "WITH e AS (SELECT DISTINCT (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INT AS we FROM orders) SELECT we, unnest([we-26, we-25, we-24, we-14, we-13, we-12, we-2, we-1, we])::INT AS ym FROM e")
def months_needed(spark, d):
    ends = read(spark, d, "orders").select(months.ym_of(F.col("o_orderdate")).alias("we")).distinct()
    return ends.select("we", F.explode(months.needed(F.col("we"))).alias("ym"))


# publication --------------------------------------------------------------------------------------

SQL_SIGNALS = f"""{SQL_REGISTRY}, si AS (SELECT id, detected::VARCHAR AS detected, ha, lon, lat, class AS title, CASE status WHEN 'resolucion' THEN 'Resolución favorable en la parcela' WHEN 'tramitacion' THEN 'Expediente en tramitación en la parcela' WHEN 'sin_expediente' THEN 'Sin expediente conocido' ELSE 'Parcelas por consultar' END AS permit,
 'https://example.org/' || photo AS image, array_to_string(list_sort(list_distinct(sites)), ',') AS sites FROM reg WHERE state IN ('provisional', 'confirmada'))"""


@query("signals", f"WITH {SQL_SIGNALS} SELECT * FROM si")
def signals(spark, d):
    found = publish.signals(registry(spark, d), "https://example.org", "es")
    return found.select("id", "detected", "ha", F.get("point", F.lit(0)).alias("lon"), F.get("point", F.lit(1)).alias("lat"), "title", "permit", "image", F.array_join("sites.code", ",").alias("sites"))


@query("signals_document", f"WITH {SQL_SIGNALS} SELECT 'ES' AS country, '2026-10-13T07:02Z' AS generated, count(*) AS n, md5(array_to_string(list(id ORDER BY detected, id), ',')) AS ids FROM si")
def signals_document(spark, d):
    made = publish.document(publish.current(registry(spark, d), "https://example.org", "es"), "ES", F.lit("2026-10-13 07:02:41").cast("timestamp"))
    return made.filter("head").select("country", "generated", "n").crossJoin(publish.digest(made.filter("not head").orderBy("detected", "id"), "id", "ids"))


@query("signals_combined", f"WITH {SQL_SIGNALS} SELECT 2 AS version, 2 * count(*) AS n, md5(array_to_string(list(id ORDER BY detected, id), ',') || ',' || array_to_string(list(id ORDER BY detected, id), ',')) AS ids FROM si")
def signals_combined(spark, d):
    stamp = F.lit("2026-10-13 07:02:41").cast("timestamp")
    made = publish.combine(publish.document(publish.current(registry(spark, d), "https://example.org", "fr"), "FR", stamp).unionByName(publish.document(publish.current(registry(spark, d), "https://example.org", "es"), "ES", stamp)))
    return made.filter("head").select("version", "n").crossJoin(publish.digest(made.filter("not head"), "id", "ids"))


@query("atom_feed", f"WITH {SQL_REGISTRY} SELECT id, '<entry><id>' || id || '</id><title>' || class || '</title><updated>' || detected || 'T00:00:00Z</updated></entry>' AS entry FROM reg WHERE state IN ('provisional', 'confirmada') ORDER BY detected DESC, id LIMIT 100")
def atom_feed(spark, d):
    return publish.feed(registry(spark, d))


@query("kpis", f"WITH {SQL_REGISTRY} SELECT count(*) FILTER (state IN ('provisional','confirmada')) AS active, count(*) FILTER (state = 'confirmada') AS confirmed, count(*) FILTER (state IN ('provisional','confirmada') AND status = 'resolucion') AS with_permit, round(sum(ha) FILTER (state IN ('provisional','confirmada')), 1) AS ha, count(*) FILTER (state <> 'fusionada') AS visible FROM reg")
def kpis(spark, d):
    return publish.figures(registry(spark, d))


@query("facets", f"WITH {SQL_REGISTRY} SELECT 'state' AS facet, state AS value, count(*) AS n FROM reg WHERE state IN ('provisional','confirmada') GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM reg WHERE state IN ('provisional','confirmada') GROUP BY 2 UNION ALL SELECT 'class', class, count(*) FROM reg WHERE state IN ('provisional','confirmada') GROUP BY 2")
def facets(spark, d):
    return publish.facets(registry(spark, d), ["state", "status", "class"])


@query("list_sorted", f"WITH {SQL_REGISTRY} SELECT id, state, status, ha FROM reg WHERE state NOT IN ('provisional','confirmada','fusionada') AND class = 'suelo'")
def list_sorted(spark, d):
    return publish.listed(registry(spark, d), "cerradas", klass="suelo").select("id", "state", "status", "ha")


@query("redirects", f"WITH {SQL_REGISTRY} SELECT id, merged_into FROM reg WHERE state = 'fusionada'")
def redirects(spark, d):
    return publish.redirects(registry(spark, d))


@query("utm_roundtrip", "SELECT s_suppkey, 0.0::DOUBLE AS error FROM supplier")
def utm_roundtrip(spark, d):
    lon, lat = F.lit(-5.0) + F.col("s_suppkey") % 40 / 10, F.lit(42.0) + F.col("s_suppkey") % 17 / 10
    x, y = geodesy.to_utm(lon, lat)
    back = geodesy.to_geo(x, y)
    return read(spark, d, "supplier").select("s_suppkey", F.abs(F.round(F.abs(back[0] - lon) + F.abs(back[1] - lat), 7)).alias("error"))


@query("photo_box", "SELECT s_suppkey, side, round_even((y0 + y1) / 2 / 10 - side / 2 / 10, 0) * 10 AS low_y, round_even((x0 + x1) / 2 / 10 - side / 2 / 10, 0) * 10 AS low_x FROM (SELECT *, ceil((greatest(y1 - y0, x1 - x0) * 2.2::DOUBLE + 600) / 10) * 10 AS side FROM (SELECT s_suppkey, (s_suppkey * 131)::DOUBLE AS y0, (s_suppkey * 57)::DOUBLE AS x0, (s_suppkey * 131 + s_suppkey % 90)::DOUBLE AS y1, (s_suppkey * 57 + 44)::DOUBLE AS x1 FROM supplier))")
def photo_box(spark, d):
    k = F.col("s_suppkey")
    side, y, x = geodesy.snap_box((k * 131).cast("double"), (k * 57).cast("double"), (k * 131 + k % 90).cast("double"), (k * 57 + 44).cast("double"))
    return read(spark, d, "supplier").select("s_suppkey", side.cast("double").alias("side"), y.alias("low_y"), x.alias("low_x"))


# the rest of geometry, joins and rules -------------------------------------------------------------


@query("grid_bounds", "SELECT x0, y0, x1, y1, ((x1 - x0) / 10)::BIGINT AS width, ((y1 - y0) / 10)::BIGINT AS height FROM (SELECT floor(min(l_extendedprice) / 10) * 10.0::DOUBLE AS x0, floor(min(l_quantity) / 10) * 10.0::DOUBLE AS y0, ceil(max(l_extendedprice) / 10) * 10.0::DOUBLE AS x1, ceil(max(l_quantity) / 10) * 10.0::DOUBLE AS y1 FROM lineitem)")
def grid_bounds(spark, d):
    return geometry.grid_bounds(read(spark, d, "lineitem").select(F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y")))


@query("tiles", f"WITH {SQL_GRID} SELECT DISTINCT cy // 32 AS ty, cx // 32 AS tx FROM cells")
def tiles(spark, d):
    return geometry.tiles(grid(spark, d), 32)


@query(
    "representative_point",
    f"""WITH {SQL_GRID}, a AS (SELECT cy // 10 AS alert, cy, cx FROM cells), m AS (SELECT alert, avg(cy) AS my, avg(cx) AS mx FROM a GROUP BY alert)
SELECT alert, round(my, 5) AS my, round(mx, 5) AS mx, cy, cx FROM a JOIN m USING (alert) QUALIFY row_number() OVER (PARTITION BY alert ORDER BY round((cy - my) ** 2 + (cx - mx) ** 2, 6), cy, cx) = 1""",
)
def representative_point(spark, d):
    return geometry.representative(alert_cells(spark, d), "alert")


@query(
    "land_cover_at_point",
    f"""WITH {SQL_ZONES}, pt AS (SELECT c_custkey AS id, (c_custkey * 37 % 520)::DOUBLE + 0.5 AS y, (c_custkey * 11 % 70)::DOUBLE + 0.5 AS x FROM customer), f AS (SELECT id, min('C' || right(zone, 1)) AS code FROM pt JOIN zo ON y > y0 AND y < y1 AND x > x0 AND x < x1 GROUP BY id)
SELECT id, code, CASE WHEN code IN ('C1', 'C2') THEN 'cover ' || code ELSE code END AS name FROM pt LEFT JOIN f USING (id)""",
)
def land_cover_at_point(spark, d):
    k, zones = F.col("c_custkey"), zone_table(spark, d)
    corner = lambda y, x: F.struct(F.col(y).alias("y"), F.col(x).alias("x"))
    rings = zones.select("zone", F.array(corner("y0", "x0"), corner("y0", "x1"), corner("y1", "x1"), corner("y1", "x0")).alias("points"))
    covers = zones.select("zone", F.concat(F.lit("C"), F.substr(F.col("zone"), F.length("zone"))).alias("code"))
    points = read(spark, d, "customer").select(k.alias("id"), ((k * 37 % 520).cast("double") + 0.5).alias("y"), ((k * 11 % 70).cast("double") + 0.5).alias("x"))
    return geometry.land_cover(points, rings, covers, spark.createDataFrame([("C1", "cover C1"), ("C2", "cover C2")], "code string, name string"), 50.0)


@query("site_totals", "SELECT count(*) AS n, sum(ha)::DOUBLE AS ha FROM (SELECT s_suppkey % 40 AS code, sum(s_suppkey % 9 * 0.5) AS ha FROM supplier GROUP BY 1) WHERE ha >= 1")
def site_totals(spark, d):
    k = F.col("s_suppkey")
    layer = read(spark, d, "supplier").select((k % 40).alias("code"), F.col("s_name").alias("name"), F.lit("ZEC").alias("kind"), F.array(F.array(F.struct(F.lit(0.0).alias("y"), F.lit(0.0).alias("x")))).alias("rings"), (k % 9 * 0.5).alias("ha"), k)
    found = geometry.sites([layer.filter("s_suppkey % 2 = 0").drop("s_suppkey"), layer.filter("s_suppkey % 2 = 1").drop("s_suppkey")])
    return geometry.without_slivers(found).agg(F.count("*").alias("n"), F.sum("ha").alias("ha"))


@query("last_index", "WITH t AS (" + ORACLES["touch_join"] + ") SELECT alert, arg_min((change % 13) / 13::DOUBLE, (change % 5, change)) AS ndvi FROM t GROUP BY alert")
def last_index(spark, d):
    pairs = touch_join(spark, d)
    c = F.col("change")
    return lifecycle.last_index(pairs, pairs.select("change").distinct().select("change", (c % 5).alias("pixels"), (c % 13 / 13).alias("ndvi")))


@query("water_level_discards", f"WITH {SQL_REGISTRY} SELECT id FROM reg WHERE state IN ('provisional', 'confirmada') AND (o_orderkey % 3 = 0 OR (class = 'agua' AND o_orderkey % 3 = 1))")
def water_level_discards(spark, d):
    k = F.substring_index("id", "-", -1).cast("long")
    clc = F.when(k % 3 == 0, "512").when(k % 3 == 1, "421").otherwise("311")
    return lifecycle.water_discards(registry(spark, d).withColumn("clc", clc)).select("id")


@query("photo_windows", "SELECT o_orderkey AS id, (row_number() OVER (PARTITION BY o_orderkey ORDER BY k) - 1)::INT AS k, w::INT AS window FROM (SELECT o_orderkey, 0 AS k, 24000 + o_orderkey % 20 AS w FROM orders WHERE o_orderkey % 3 <> 2 UNION ALL SELECT o_orderkey, 1, 24000 + o_orderkey % 31 FROM orders WHERE o_orderkey % 31 - o_orderkey % 20 < 12 AND NOT (o_orderkey % 3 <> 2 AND o_orderkey % 31 = o_orderkey % 20))")
def photo_windows(spark, d):
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(k.alias("id"), (24000 + k % 20).cast("int").alias("first"), (24000 + k % 31).cast("int").alias("last"), (k % 3).alias("version"))
    return lifecycle.photo_windows(rows, 2)


@query("names_to_codes", "SELECT o_orderkey AS alert, array_to_string(list(code ORDER BY k), ',') AS codes FROM (SELECT o_orderkey, 0 AS k, 'C' || o_custkey % 25 AS code FROM orders UNION ALL SELECT o_orderkey, 1, 'C' || o_orderkey % 30 FROM orders WHERE o_orderkey % 30 < 25) GROUP BY 1")
def names_to_codes(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    alerts = read(spark, d, "orders").select(k.alias("alert"), F.array(F.format_string("NATION_%d", c % 25), F.format_string("NATION_%d", k % 30)).alias("names"))
    n = F.col("n_nationkey")
    table = read(spark, d, "nation").select(F.col("n_name").alias("name"), F.when(n % 2 == 0, F.format_string("C%d", n)).alias("insee"), F.format_string("C%d", n).alias("ine"), n.alias("n"))
    return permits.names_to_codes(alerts, table).select("alert", F.array_join("codes", ",").alias("codes"))


@query("full_text", "SELECT page_id AS notice, md5(CASE WHEN page_id % 3 = 0 THEN 'dump ' || page_id WHEN page_id % 3 = 1 THEN regexp_replace(html, '<[^>]+>', ' ', 'g') END) AS text_md5 FROM pages")
def full_text(spark, d):
    x = read(spark, d, "pages").withColumn("notice", F.col("page_id")).withColumn("day", F.col("page_id") % 5)
    made = permits.full_text(x.select("notice", "day"), x.filter("page_id % 3 = 0").select("day", "notice", F.format_string("dump %d", "page_id").alias("text")), x.filter("page_id % 3 < 2").select("notice", F.col("html").alias("xml")))
    return made.select("notice", F.md5("text").alias("text_md5"))


@query("crop_dictionary", "WITH u AS (" + ORACLES["declared_use"] + ") SELECT alert, CASE WHEN code = 'PROMO' THEN 'Promoción' ELSE code END AS label FROM u")
def crop_dictionary(spark, d):
    return permits.with_crops(declared_use(spark, d), spark.createDataFrame([("PROMO", "Promoción")], "code string, label string")).select("alert", "label")


@query("declaration_layer", "SELECT o_orderkey, CASE WHEN year(o_orderdate) >= 1999 THEN 'LATEST' ELSE year(o_orderdate)::VARCHAR END AS layer FROM orders")
def declaration_layer(spark, d):
    return read(spark, d, "orders").select("o_orderkey", permits.layer_of(F.year("o_orderdate"), F.lit(1999)).alias("layer"))


@query("geojson_features", f"""WITH {SQL_REGISTRY} SELECT id, '{{"type":"Feature","properties":{{"id":"' || id || '","state":"' || state || '","class":"' || class || '"}},"geometry":null}}' AS feature FROM reg""")
def geojson_features(spark, d):
    return publish.features(registry(spark, d).withColumn("geometry", F.lit(None).cast("string")), ["id", "state", "class"], "geometry")


@query("photo_values", "SELECT l_orderkey, l_linenumber, floor(pow(least(greatest((0.02 + l_discount) / 0.22::DOUBLE, 0), 1), 1 / 1.6::DOUBLE) * 255)::INT AS v FROM lineitem")
def photo_values(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", publish.photo_value(0.02 + F.col("l_discount")).alias("v"))
