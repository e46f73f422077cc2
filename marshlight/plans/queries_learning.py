"""Queries of learning, user functions and whole jobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..operators import focal as W
from ..operators import geometry as G
from ..operators import learn as M
from ..operators import stats as T
from ..operators import terrain as E
from ..operators.iterate import settle
from ..operators.superpixels import superpixels
from . import jobs as J
from .queries_attributes import CODE_CHM_SQL, CODE_PARTS_SQL
from .queries_cells import TOUCH
from .queries_terrain import SLOPE, _nine, _template
from .queries_vectors import BOX, EDGES, PAIRS, _cross, cover_sql, rnd
from .registry import query

c = F.col
BANDS = ["dem", "red", "green", "blue", "nir"]


@query("m01_stratified_split", "SELECT pt_id, mod_class, percent_rank() OVER (PARTITION BY mod_class ORDER BY (pt_id * 2654435761) % 1000003, pt_id) < 0.8 AS train FROM fx_points")
def _(fx):
    return M.split(fx.points.select("pt_id", "mod_class"), 0.8, "pt_id", "mod_class")


@query("m02_recipe", """SELECT pt_id, CAST(segment = 'BUILDING' AS INTEGER) AS segment_BUILDING, CAST(segment = 'FURNITURE' AS INTEGER) AS segment_FURNITURE, round((bal - m) / s, 6) AS bal
 FROM fx_points, (SELECT avg(bal) AS m, stddev_samp(bal) AS s FROM fx_points)""")
def _(fx):
    df = fx.points.select("pt_id", "segment", "bal", F.lit(1.0).alias("flat"))
    return rnd(M.normalize(M.dummies(df, "segment", ["AUTOMOBILE", "BUILDING", "FURNITURE"]), ["bal", "flat"]), "bal")


@query("m03_fit_rf")
def _(fx):
    model = M.fit_rf(fx.train, "mod_class", BANDS, trees=10)
    return M.augment(model, fx.train).select("pt_id", "pred_class")


@query("m04_tune_rf")
def _(fx):
    return M.tune_rf(fx.train, "coarse_class", BANDS, [(2, 2), (3, 5)], 10, "pt_id", trees=10)


@query("m05_last_fit")
def _(fx):
    _, scored = M.last_fit(fx.train, "mod_class", BANDS, "pt_id", trees=10)
    return M.accuracy(scored, "mod_class")


@query("m06_perm_importance")
def _(fx):
    train = settle(fx.train.select("pt_id", "mod_class", *BANDS), "train")
    model = M.fit_rf(train, "mod_class", BANDS, trees=10, written=True)
    return M.perm_importance(model, train, "mod_class", BANDS, "pt_id", written=True)


@query("m07_augment")
def _(fx):
    return M.augment(M.fit_rf(fx.train, "coarse_class", BANDS, trees=10), fx.train).select("pt_id", "coarse_class", "pred_class", "pred_UPL", "pred_WET")


_PRED = "(SELECT mod_class AS truth, CASE WHEN pt_id % 3 = 0 THEN 'EMW' WHEN pt_id % 7 = 0 THEN 'UPL' ELSE mod_class END AS pred FROM fx_points)"
CLASSES = ["EMW", "FSW", "OWW", "SSW", "UPL"]


def _pred(fx):
    return fx.points.select(c("mod_class").alias("truth"), F.when(c("pt_id") % 3 == 0, "EMW").when(c("pt_id") % 7 == 0, "UPL").otherwise(c("mod_class")).alias("pred"))


@query("m08_conf_mat", f"SELECT t AS truth, p AS pred, count(x.truth) AS n FROM (SELECT unnest({CLASSES}) AS t) CROSS JOIN (SELECT unnest({CLASSES}) AS p) LEFT JOIN {_PRED} x ON x.truth = t AND x.pred = p GROUP BY t, p")
def _(fx):
    return M.conf_mat(_pred(fx), "truth", "pred", CLASSES)


@query("m08_summary", f"""WITH x AS (SELECT * FROM {_PRED}), t AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM x), k AS (SELECT unnest({CLASSES}) AS k), p AS (SELECT k, CAST(count(*) FILTER (truth = k AND pred = k) AS DOUBLE) AS tp, CAST(count(*) FILTER (truth = k) AS DOUBLE) AS pos, CAST(count(*) FILTER (pred = k) AS DOUBLE) AS cal FROM x, k GROUP BY k),
 q AS (SELECT *, n - pos - cal + tp AS tn, tp / pos AS se, (n - pos - cal + tp) / (n - pos) AS sp FROM p, t), e AS (SELECT sum(tp) / max(n) AS acc, sum(pos * cal) / pow(max(n), 2) AS ch FROM q)
 SELECT round(max(acc), 6) AS accuracy, round(max((acc - ch) / (1 - ch)), 6) AS kappa, round(avg(se), 6) AS sens, round(avg(sp), 6) AS spec, round(avg(tp / nullif(cal, 0)), 6) AS ppv, round(avg(tn / nullif(n - cal, 0)), 6) AS npv, round(avg(2 * tp / (pos + cal)), 6) AS f, round(avg(se + sp - 1), 6) AS j, round(avg((se + sp) / 2), 6) AS bal FROM q, e""")
def _(fx):
    s = M.cm_summary(M.conf_mat(_pred(fx), "truth", "pred", CLASSES))
    return rnd(s, *s.columns)


@query("m09_agreement", f"SELECT truth, count(*) FILTER (truth <> pred) AS disagree, count(*) AS n FROM {_PRED} GROUP BY truth")
def _(fx):
    return M.agreement(_pred(fx), "truth", "pred")


@query("m10_pca")
def _(fx):
    return rnd(M.pca(fx.train, BANDS, 2, "pt_id"), "pc1", "pc2", n=4)


@query("m11_cluster_zones")
def _(fx):
    z = fx.zones.select("zone_id", ((c("xmin") + c("xmax")) / 2).alias("X"), ((c("ymin") + c("ymax")) / 2).alias("Y"))
    return M.kmeans(z, ["X", "Y"], 5)


_N = "count(*) FILTER (mod_class = '{}')"


@query("m12_supplement", f"""SELECT CAST(CASE WHEN low THEN round_even(e / 2, 0) ELSE 0 END AS INTEGER) AS EMW, CAST(CASE WHEN low THEN round_even(s / 2, 0) ELSE 0 END AS INTEGER) AS SSW, CAST(CASE WHEN e + s + f < 0.5 * o THEN ceil(o / 2) ELSE 0 END AS INTEGER) AS other
 FROM (SELECT *, e < 0.5 * f AND s < 0.5 * f AS low FROM (SELECT CAST({_N.format('EMW')} AS DOUBLE) AS e, CAST({_N.format('SSW')} AS DOUBLE) AS s, CAST({_N.format('FSW')} AS DOUBLE) AS f, CAST({_N.format('OWW')} AS DOUBLE) AS o FROM fx_points WHERE NOT (mod_class IN ('EMW', 'SSW') AND pt_id % 3 <> 0)))""")
def _(fx):
    return M.supplement_sizes(fx.points.filter(~(c("mod_class").isin("EMW", "SSW") & (c("pt_id") % 3 != 0))), "mod_class")


@query("e39_raster_kmeans")
def _(fx):
    return M.kmeans(fx.cells.select("h", "r", "c", "dem", "nir"), ["dem", "nir"], 4, scale=True).select("h", "r", "c", "cluster_id")


@query("e40_superpixels")
def _(fx):
    total = c("red") + c("green") + c("nir")
    p = fx.cells.select("h", "r", "c", *[(c(b) / total).alias(b) for b in ("red", "green", "nir")])
    return superpixels(p, ["red", "green", "nir"], step=8, rounds=10)


@query("e41_predict_map")
def _(fx):
    model = M.fit_rf(fx.train, "mod_class", BANDS, trees=10)
    return M.predict_map(model, fx.cells, BANDS).select("h", "r", "c", "pred_class")


# --- user functions
@query("f01_user_statistic", "SELECT 'chm' AS band, round(avg(chm), 6) AS mean, max(chm) AS max, round(stddev_samp(chm), 6) AS sd, count(chm) AS n, round(avg(CAST(chm > 3 AS DOUBLE)), 6) AS over3, round(avg(CAST(chm = 0 AS DOUBLE)), 6) AS zero FROM fx_cells")
def _(fx):
    v = c("value")
    return rnd(T.global_stats(fx.cells, ["chm"], {"over3": M.share_where(v > 3), "zero": M.share_where(v == 0)}), "mean", "sd", "over3", "zero")


@query("f02_struct_metric", "SELECT h, min(dem) AS lo, max(dem) AS hi, max(dem) - min(dem) AS span FROM fx_cells GROUP BY h")
def _(fx):
    m = F.struct(F.min("dem").alias("lo"), F.max("dem").alias("hi"), (F.max("dem") - F.min("dem")).alias("span"))
    return fx.cells.groupBy("h").agg(m.alias("m")).select("h", "m.*")


@query("f03_map_function", "SELECT scene_id, r, c, b8 - b4 AS diff FROM fx_obs WHERE cloud_pct < 10")
def _(fx):
    return fx.obs.transform(lambda d: d.filter("cloud_pct < 10")).transform(lambda d: d.select("scene_id", "r", "c", (c("b8") - c("b4")).alias("diff")))


@query("f04_per_watershed", "SELECT h, count(*) AS n, sum(red) AS red FROM fx_cells GROUP BY h")
def _(fx):
    # a per-tile function keeps a group bounded; tiles are then summed
    tile = fx.cells.select("h", F.floor(c("r") / 64).alias("tr"), F.floor(c("c") / 64).alias("tc"), "red")
    part = tile.groupBy("h", "tr", "tc").applyInPandas(lambda p: pd.DataFrame({"h": [p.h.iloc[0]], "n": [len(p)], "red": [p.red.sum()]}), "h long, n long, red double")
    return part.groupBy("h").agg(F.sum("n").alias("n"), F.sum("red").alias("red"))


@query("f05_user_focal", "SELECT a.h, a.r, a.c, sum(b.dem) AS dem FROM fx_cells a JOIN fx_cells b ON a.h = b.h AND b.r BETWEEN a.r - 3 AND a.r + 3 AND b.c BETWEEN a.c - 3 AND a.c + 3 GROUP BY a.h, a.r, a.c")
def _(fx):
    return W.focal(fx.cells, 7, "sum", "dem")


# --- jobs
_TPL = "(SELECT h, r, c FROM (SELECT DISTINCT h FROM fx_cells), (SELECT unnest(range(64)) AS r), (SELECT unnest(range(64)) AS c))"


@query("p01_dem", f"""WITH {cover_sql()}, m AS (SELECT h, r, c, arg_min(v, tile_ord) AS v FROM fx_tiles GROUP BY h, r, c), f AS (SELECT t.h, t.r, t.c, coalesce(any_value(k.v), round(avg(b.v), 6)) AS v FROM {_TPL} t LEFT JOIN m k ON k.h = t.h AND k.r = t.r AND k.c = t.c LEFT JOIN m b ON b.h = t.h AND b.r BETWEEN t.r - 1 AND t.r + 1 AND b.c BETWEEN t.c - 1 AND t.c + 1 GROUP BY t.h, t.r, t.c)
 SELECT h, r, c, v FROM f WHERE EXISTS (SELECT 1 FROM cov WHERE inside AND cov.h = f.h AND cov.r = f.r AND cov.c = f.c)""")
def _(fx):
    return rnd(J.dem_per_watershed(fx.tiles, _template(fx), fx.vertices), "v")


@query("p02_canopy", f"""WITH {cover_sql()} SELECT k.h, k.r, k.c, k.dem, coalesce(max(t.v), 0) AS chm FROM fx_cells k LEFT JOIN (SELECT * FROM fx_tiles WHERE tile_ord > 2) t ON t.h = k.h AND t.r = k.r AND t.c = k.c WHERE EXISTS (SELECT 1 FROM cov WHERE inside AND cov.h = k.h AND cov.r = k.r AND cov.c = k.c) GROUP BY k.h, k.r, k.c, k.dem""")
def _(fx):
    # without the first two tiles there are gaps to fill
    return J.canopy_per_watershed(fx.tiles.filter("tile_ord > 2"), fx.cells.select("h", "r", "c", "dem"), fx.vertices)


@query("p03_aerial", f"WITH {cover_sql()} SELECT h, r, c, round((nir - red) / nullif(nir + red, 0), 6) AS ndvi, round((green - nir) / nullif(green + nir, 0), 6) AS ndwi FROM fx_cells k WHERE EXISTS (SELECT 1 FROM cov WHERE inside AND cov.h = k.h AND cov.r = k.r AND cov.c = k.c)")
def _(fx):
    return rnd(J.aerial_per_watershed(fx.cells, fx.vertices).select("h", "r", "c", "ndvi", "ndwi"), "ndvi", "ndwi")


@query("p04_satellite")
def _(fx):
    grid = fx.cells.select("h", "r", "c")
    return rnd(J.satellite_composite(fx.obs, grid, 0.25), "NDVI")


@query("p05_terrain")
def _(fx):
    return rnd(J.terrain_metrics(fx.cells, 2), "slope_2", "tpi_2")


@query("p06_hydrology")
def _(fx):
    return rnd(J.hydrology(fx.cells), "twi")


@query("p07_predictor_stack", f"""SELECT k.h, k.r, k.c, k.dem, k.chm, CASE WHEN n.n = 9 THEN round(degrees({SLOPE}), 6) END AS slope, round(ln(k.r * 64 + k.c + 1), 6) AS flowacc, k.red AS n_red, k.green AS n_green, k.blue AS n_blue, k.nir AS n_nir FROM fx_cells k JOIN {_nine()} n ON n.h = k.h AND n.r = k.r AND n.c = k.c""")
def _(fx):
    acc = fx.cells.select("h", "r", "c", (c("r") * 64 + c("c") + 1).alias("acc"))
    return rnd(J.predictor_stack(fx.cells, E.slope_aspect(fx.cells), acc), "slope", "flowacc")


_P08 = f"""WITH {cover_sql()}, z AS (SELECT poly_id, avg(k.chm) AS chm FROM cov JOIN (SELECT h, r, c, chm FROM fx_cells) k USING (h, r, c) WHERE inside AND dist >= 0.5 GROUP BY poly_id)
 SELECT poly_id, h, attribute, round(chm, 6) AS chm, {CODE_CHM_SQL} AS cls FROM (SELECT a.poly_id, a.h, a.attribute, z.chm, {CODE_PARTS_SQL} FROM fx_poly_attr a LEFT JOIN z USING (poly_id) WHERE attribute IS NOT NULL AND NOT regexp_matches(attribute, '^R[1-5]'))"""


@query("p08_wetland_by_canopy", _P08)
def _(fx):
    return rnd(J.wetland_by_canopy(fx.polys, fx.vertices, fx.cells), "chm")


@query("p09_training_points")
def _(fx):
    return J.training_points(fx.polys, fx.vertices, 4, 2.0)


@query("p10_vector_patches")
def _(fx):
    return J.vector_patches(fx.vertices, fx.polys, 4.0)


@query("p11_raster_patches", f"""WITH {cover_sql(1)}, {TOUCH}, cl AS (SELECT poly_id, CASE WHEN attribute LIKE '%PUB%' OR attribute LIKE 'L1%' OR attribute LIKE 'R2%' THEN 'OWW' WHEN attribute LIKE 'PFO%' THEN 'FSW' WHEN attribute = 'PSS1E' THEN 'SSW' WHEN attribute = 'PEM1C' THEN 'EMW' WHEN attribute = 'PSS1/EM1E' THEN 'SSW' ELSE 'Other' END AS m FROM fx_poly_attr),
 lab AS (SELECT t.h, t.r, t.c, arg_max(m, t.poly_id) AS m FROM tch t JOIN cl USING (poly_id) GROUP BY t.h, t.r, t.c), b AS (SELECT pt_id AS box_id, h, floor(x) - 3 AS xmin, floor(y) - 3 AS ymin, floor(x) + 3 AS xmax, floor(y) + 3 AS ymax FROM fx_points)
 SELECT b.box_id, k.h, k.r, k.c, k.red, CAST(CASE coalesce(l.m, 'UPL') WHEN 'EMW' THEN 0 WHEN 'FSW' THEN 1 WHEN 'SSW' THEN 2 WHEN 'UPL' THEN 3 WHEN 'OWW' THEN 3 END AS INTEGER) AS mod_class FROM b JOIN fx_cells k ON b.h = k.h AND k.c + 0.5E0 >= xmin AND k.c + 0.5E0 < xmax AND k.r + 0.5E0 >= ymin AND k.r + 0.5E0 < ymax LEFT JOIN lab l ON l.h = k.h AND l.r = k.r AND l.c = k.c""")
def _(fx):
    p = fx.points.select(c("pt_id").alias("box_id"), "h", F.floor("x").cast("double").alias("x"), F.floor("y").cast("double").alias("y"))
    return J.raster_patches(fx.cells.select("h", "r", "c", "red"), fx.polys, fx.vertices, G.square(p, 3.0)).select("box_id", "h", "r", "c", "red", "mod_class")


@query("p12_point_extraction", f"""WITH {EDGES}, {BOX}, j AS (SELECT poly_id, h, xmin, xmax, unnest(range(CAST(ceil(ymin / 1.25E0) AS BIGINT), CAST(floor(ymax / 1.25E0) AS BIGINT) + 1)) AS j FROM bx), g AS (SELECT poly_id, h, j * 1.25E0 AS py, unnest(range(CAST(ceil(xmin / 1.25E0) AS BIGINT), CAST(floor(xmax / 1.25E0) AS BIGINT) + 1)) * 1.25E0 AS px FROM j),
 p AS (SELECT g.poly_id, g.h, g.px AS x, g.py AS y FROM g JOIN e USING (poly_id) GROUP BY g.poly_id, g.h, g.px, g.py HAVING {_cross('g.px', 'g.py')})
 SELECT p.poly_id, p.x, p.y, k.dem, k.nir, a.cowardin FROM p JOIN fx_cells k ON k.h = p.h AND k.r = floor(p.y) AND k.c = floor(p.x) JOIN fx_poly_attr a ON a.poly_id = p.poly_id WHERE k.dem IS NOT NULL AND k.nir IS NOT NULL""")
def _(fx):
    return J.point_extraction(fx.vertices, fx.polys, fx.cells, 1.25, ["dem", "nir"]).select("poly_id", "x", "y", "dem", "nir", "cowardin")


@query("p13_forest")
def _(fx):
    return J.forest_report(fx.train, BANDS, "coarse_class", trees=10)


@query("p14_prediction_map")
def _(fx):
    return J.prediction_map(fx.train, fx.cells, fx.vertices, BANDS, "mod_class").select("h", "r", "c", "pred_class")


@query("p15_pond_report", f"""WITH {cover_sql(3)}, m AS (SELECT poly_id, 0.0E0 AS ring, h, r, c FROM cov WHERE inside UNION ALL SELECT poly_id, ring, h, r, c FROM cov, (VALUES (1.0E0), (3.0E0)) t(ring) WHERE NOT inside AND dist <= ring), w AS (SELECT poly_id, ring, avg(k.dem) AS dem, avg(k.nir) AS nir FROM m JOIN (SELECT h, r, c, dem, nir FROM fx_cells) k USING (h, r, c) GROUP BY poly_id, ring)
 SELECT poly_id, ring, 'dem' AS band, round(dem, 5) AS value FROM w UNION ALL SELECT poly_id, ring, 'nir', round(nir, 5) FROM w""")
def _(fx):
    return rnd(J.pond_report(fx.vertices, fx.cells, [1.0, 3.0], ["dem", "nir"]), "value", n=5)


@query("p16_inventory_merge", f"""WITH {cover_sql()}, xs AS{PAIRS.split(', xs AS', 1)[1]}, l AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), k AS (SELECT poly_id FROM fx_poly_attr p WHERE rad = 4 OR NOT EXISTS (SELECT 1 FROM l JOIN fx_poly_attr q ON q.poly_id = l.b WHERE l.a = p.poly_id AND q.rad = 4))
 SELECT v.poly_id, z.zone_id, count(*) AS area FROM cov v JOIN k USING (poly_id) JOIN fx_zones z ON z.zone_id % 4 = v.h AND v.c + 0.5E0 >= z.xmin AND v.c + 0.5E0 < z.xmax AND v.r + 0.5E0 >= z.ymin AND v.r + 0.5E0 < z.ymax WHERE inside GROUP BY v.poly_id, z.zone_id""")
def _(fx):
    zones = fx.zones.select("zone_id", (c("zone_id") % 4).alias("h"), "xmin", "ymin", "xmax", "ymax")
    return J.inventory_merge(fx.polys.filter("rad = 4"), fx.polys.filter("rad <> 4"), fx.vertices, zones).select("poly_id", "zone_id", "area")


@query("p17_delineated", f"""WITH {cover_sql()}, near AS (SELECT DISTINCT b.poly_id FROM bx b JOIN fx_zones z ON b.xmin < z.xmax AND b.xmax > z.xmin AND b.ymin < z.ymax AND b.ymax > z.ymin),
 m AS (SELECT poly_id, avg(k.chm) AS chm, avg((green - nir) / nullif(green + nir, 0)) AS w FROM cov JOIN (SELECT h, r, c, chm, green, nir FROM fx_cells) k USING (h, r, c) WHERE inside AND dist >= 0.5 GROUP BY poly_id)
 SELECT poly_id, CASE WHEN chm <= 1 THEN 'OWW' WHEN chm <= 3.5 THEN 'EMW' WHEN chm <= 5 THEN 'SSW' WHEN chm > 5 THEN 'FSW' ELSE 'REVIEW' END AS adk,
  CASE WHEN chm <= 0.5 AND w > 0.2 THEN 'OWW' WHEN chm > 0.5 AND chm <= 3.5 AND w > 0.2 THEN 'EMW' WHEN chm BETWEEN 0.5 AND 5 AND w < 0.2 THEN 'SSW' WHEN chm > 5 THEN 'FSW' WHEN chm <= 3.5 THEN 'EMW' WHEN chm > 3.5 AND chm <= 5 THEN 'SSW' ELSE 'REVIEW' END AS delineated
 FROM near LEFT JOIN m USING (poly_id)""")
def _(fx):
    return J.delineated_by_canopy(fx.polys, fx.vertices, fx.cells, fx.zones)


@query("p18_zone_setup", f"WITH {cover_sql(2)}, d AS (SELECT DISTINCT h, r, c FROM cov WHERE inside OR dist <= 2) SELECT z.zone_id, count(*) AS area FROM d JOIN fx_zones z ON z.zone_id % 4 = d.h AND d.c + 0.5E0 >= z.xmin AND d.c + 0.5E0 < z.xmax AND d.r + 0.5E0 >= z.ymin AND d.r + 0.5E0 < z.ymax GROUP BY z.zone_id")
def _(fx):
    zones = fx.zones.select("zone_id", (c("zone_id") % 4).alias("h"), "xmin", "ymin", "xmax", "ymax")
    return J.zone_setup(fx.vertices, zones, 2.0)


