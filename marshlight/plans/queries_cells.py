"""Queries of raster algebra, composites and point clouds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import indices as I
from ..operators import cells as R
from ..operators import geometry as G
from ..operators import lidar as P
from .queries_vectors import BOX, EDGES, cover_sql, rnd
from .registry import query

c = F.col


@query("e01_mosaic", "SELECT h, r, c, arg_min(v, tile_ord) AS first, max(v) AS max, round(avg(v), 6) AS mean FROM fx_tiles GROUP BY h, r, c")
def _(fx):
    parts = [R.mosaic(fx.tiles, f).withColumnRenamed("v", f) for f in ("first", "max", "mean")]
    return rnd(R.stack(parts), "mean")


@query("e02_merge_crop", "SELECT z.zone_id, t.h, t.r, t.c, arg_min(t.v, t.tile_ord) AS v FROM fx_tiles t JOIN fx_zones z ON z.zone_id % 4 = t.h AND t.c + 0.5E0 >= z.xmin AND t.c + 0.5E0 < z.xmax AND t.r + 0.5E0 >= z.ymin AND t.r + 0.5E0 < z.ymax GROUP BY z.zone_id, t.h, t.r, t.c")
def _(fx):
    zones = fx.zones.select("zone_id", (c("zone_id") % 4).alias("h"), "xmin", "ymin", "xmax", "ymax")
    return R.merge_crop(fx.tiles, zones).select("zone_id", "h", "r", "c", "v")


@query("e03_mask", f"WITH {cover_sql()} SELECT k.h, k.r, k.c, k.dem FROM fx_cells k WHERE EXISTS (SELECT 1 FROM cov WHERE inside AND cov.h = k.h AND cov.r = k.r AND cov.c = k.c)")
def _(fx):
    return R.mask(fx.cells.select("h", "r", "c", "dem"), fx.vertices)


# a cell is touched if its centre is inside or an edge, cut to the cell's closed square, keeps any length
_CLIP = """greatest(0, CASE WHEN x2 > x1 THEN (c - x1) / (x2 - x1) WHEN x2 < x1 THEN (c + 1 - x1) / (x2 - x1) ELSE 0 END, CASE WHEN y2 > y1 THEN (r - y1) / (y2 - y1) WHEN y2 < y1 THEN (r + 1 - y1) / (y2 - y1) ELSE 0 END)
 <= least(1, CASE WHEN x2 > x1 THEN (c + 1 - x1) / (x2 - x1) WHEN x2 < x1 THEN (c - x1) / (x2 - x1) ELSE 1 END, CASE WHEN y2 > y1 THEN (r + 1 - y1) / (y2 - y1) WHEN y2 < y1 THEN (r - y1) / (y2 - y1) ELSE 1 END)
 AND NOT (x1 = x2 AND (x1 < c OR x1 > c + 1)) AND NOT (y1 = y2 AND (y1 < r OR y1 > r + 1))"""
TOUCH = f"tch AS (SELECT DISTINCT poly_id, h, r, c FROM cov WHERE inside UNION SELECT DISTINCT v.poly_id, v.h, v.r, v.c FROM cov v JOIN e USING (poly_id) WHERE {_CLIP.replace('(c ', '(v.c ').replace('(r ', '(v.r ').replace('< c ', '< v.c ').replace('> c ', '> v.c ').replace('< r ', '< v.r ').replace('> r ', '> v.r ')})"


@query("e03_mask_touches", f"WITH {cover_sql(1)}, {TOUCH} SELECT k.h, k.r, k.c, k.dem FROM fx_cells k WHERE EXISTS (SELECT 1 FROM tch WHERE tch.h = k.h AND tch.r = k.r AND tch.c = k.c)")
def _(fx):
    return R.mask(fx.cells.select("h", "r", "c", "dem"), fx.vertices, touches=True)


@query("e04_crop", "SELECT h, r, c, nir FROM fx_cells WHERE r BETWEEN 5 AND 9 AND c BETWEEN 0 AND 31")
def _(fx):
    return R.crop(fx.cells, 5, 9, 0, 31).select("h", "r", "c", "nir")


@query("e05_fill_where", "SELECT h, r, c, dem, coalesce(chm, 0) AS chm FROM fx_cells")
def _(fx):
    return R.fill_where(fx.cells.select("h", "r", "c", "dem"), fx.cells.filter("chm IS NOT NULL"), "chm", 0.0)


@query("e06_fill_in_zone", f"""WITH {cover_sql()}, z AS (SELECT DISTINCT h, r, c FROM cov WHERE inside)
 SELECT h, r, c, CASE WHEN z.h IS NOT NULL THEN coalesce(k.chm, 1.0E0) ELSE k.chm END AS chm FROM z FULL JOIN (SELECT h, r, c, chm FROM fx_cells) k USING (h, r, c)""".replace("CASE WHEN z.h IS NOT NULL THEN coalesce(k.chm, 1.0E0) ELSE k.chm END", "CASE WHEN z.r IS NOT NULL THEN coalesce(k.chm, 1.0E0) ELSE k.chm END"))
def _(fx):
    zone = G.cell_set(fx.vertices).select("h", "r", "c").distinct()
    return R.fill_in_zone(fx.cells.select("h", "r", "c", "chm"), zone, {"chm": 1.0})


def _bilinear_sql(grid: str, band: str = "dem") -> str:
    """Renormalised bilinear value at (sx, sy) of each row of ``grid``."""
    return f"""SELECT h, r, c, round(sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END), 6) AS {band} FROM (
 SELECT g.h, g.r, g.c, (CASE WHEN i = 0 THEN 1 - (sy - 0.5E0 - floor(sy - 0.5E0)) ELSE sy - 0.5E0 - floor(sy - 0.5E0) END) * (CASE WHEN j = 0 THEN 1 - (sx - 0.5E0 - floor(sx - 0.5E0)) ELSE sx - 0.5E0 - floor(sx - 0.5E0) END) AS w, k.{band} AS v
 FROM {grid} g CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(i, j) LEFT JOIN fx_cells k ON k.h = g.h AND k.r = floor(g.sy - 0.5E0) + i AND k.c = floor(g.sx - 0.5E0) + j) GROUP BY h, r, c"""


def _grid_sql(f: float) -> str:
    return f"""(SELECT h, r, c, (r + 0.5E0) * {f}E0 AS sy, (c + 0.5E0) * {f}E0 AS sx FROM (SELECT h, r, unnest(range(CAST(ceil((cm + 1) / {f}E0) AS BIGINT))) AS c FROM (SELECT h, cm, unnest(range(CAST(ceil((rm + 1) / {f}E0) AS BIGINT))) AS r FROM (SELECT h, max(r) AS rm, max(c) AS cm FROM fx_cells GROUP BY h))))"""


@query("e07_warp", _bilinear_sql("(SELECT h, r, c, (c + 0.5E0) * 0.875E0 + 1.25E0 AS sx, (r + 0.5E0) * 0.875E0 + 0.5E0 AS sy FROM fx_cells)"))
def _(fx):
    return rnd(R.warp(fx.cells, fx.cells, lambda x, y: (x * 0.875 + 1.25, y * 0.875 + 0.5), "dem"), "dem")


@query("e08_resample_bilinear", _bilinear_sql(_grid_sql(1.5)))
def _(fx):
    return rnd(R.resample(fx.cells, 1.5, "dem"), "dem")


def _spline(t: str, k: str) -> str:
    return f"(CASE {k} WHEN -1 THEN pow(1 - {t}, 3) / 6 WHEN 0 THEN (3 * pow({t}, 3) - 6 * pow({t}, 2) + 4) / 6 WHEN 1 THEN (-3 * pow({t}, 3) + 3 * pow({t}, 2) + 3 * {t} + 1) / 6 ELSE pow({t}, 3) / 6 END)"


@query("e09_resample_cubicspline", f"""SELECT h, r, c, round(sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END), 6) AS dem FROM (SELECT g.h, g.r, g.c, {_spline('(sy - 0.5E0 - floor(sy - 0.5E0))', 'i')} * {_spline('(sx - 0.5E0 - floor(sx - 0.5E0))', 'j')} AS w, k.dem AS v
 FROM {_grid_sql(1.5)} g CROSS JOIN (SELECT unnest(range(-1, 3)) AS i) CROSS JOIN (SELECT unnest(range(-1, 3)) AS j) LEFT JOIN fx_cells k ON k.h = g.h AND k.r = floor(g.sy - 0.5E0) + i AND k.c = floor(g.sx - 0.5E0) + j) GROUP BY h, r, c""")
def _(fx):
    return rnd(R.resample(fx.cells, 1.5, "dem", "cubicspline"), "dem")


@query("e10_aggregate", "SELECT h, CAST(floor(r / 4) AS BIGINT) AS r, CAST(floor(c / 4) AS BIGINT) AS c, round(avg(dem), 6) AS mean, round(median(dem), 6) AS med FROM fx_cells GROUP BY 1, 2, 3")
def _(fx):
    both = R.stack([R.aggregate(fx.cells, 4, "dem").withColumnRenamed("dem", "mean"), R.aggregate(fx.cells, 4, "dem", "median").withColumnRenamed("dem", "med")])
    return rnd(both, "mean", "med")


@query("e11_align", f"SELECT a.h, a.r, a.c, b.nir, a.dem FROM ({_bilinear_sql(_grid_sql(2.0))}) a JOIN (SELECT h, r, c, nir FROM fx_cells) b USING (h, r, c)")
def _(fx):
    got = R.align({"dem": (fx.cells.select("h", "r", "c", "dem"), 0.5), "nir": (fx.cells.select("h", "r", "c", "nir"), 1.0)}, 1.0)
    return rnd(R.stack([got["nir"], got["dem"]]), "dem")


@query("e12_stack", "SELECT k.h, k.r, k.c, k.dem, max(t.v) AS v FROM fx_cells k JOIN fx_tiles t ON t.h = k.h AND t.r = k.r AND t.c = k.c GROUP BY k.h, k.r, k.c, k.dem")
def _(fx):
    return R.stack([fx.cells.select("h", "r", "c", "dem"), R.mosaic(fx.tiles, "max")])


@query("e13_rasterize", f"WITH {cover_sql(1)}, {TOUCH} SELECT t.h, t.r, t.c, arg_max(a.cowardin, t.poly_id) AS cowardin FROM tch t JOIN fx_poly_attr a USING (poly_id) GROUP BY t.h, t.r, t.c")
def _(fx):
    return R.rasterize(fx.vertices, fx.polys, "cowardin")


@query("e14_reclass", "SELECT pt_id, CAST(CASE mod_class WHEN 'EMW' THEN 0 WHEN 'FSW' THEN 1 WHEN 'OWW' THEN 3 WHEN 'SSW' THEN 2 WHEN 'UPL' THEN 3 END AS INTEGER) AS mod_class FROM fx_points")
def _(fx):
    five = R.reclass(fx.points.select("pt_id", "mod_class"), "mod_class", {"EMW": 0, "FSW": 1, "OWW": 2, "SSW": 3, "UPL": 4})
    return R.reclass(five, "mod_class", {0: 0, 1: 1, 2: 3, 3: 2, 4: 3})  # five classes to four: water to upland


@query("e34_zonal", f"""WITH {cover_sql()}, m AS (SELECT poly_id, k.chm FROM cov LEFT JOIN (SELECT h, r, c, chm FROM fx_cells) k USING (h, r, c) WHERE inside)
 SELECT a.poly_id, a.attribute, m1.strict, m1.mean, m1.med FROM fx_poly_attr a LEFT JOIN (SELECT poly_id, CASE WHEN count(*) = count(chm) THEN round(avg(chm), 6) END AS strict, round(avg(chm), 6) AS mean, round(median(chm), 6) AS med FROM m GROUP BY poly_id) m1 USING (poly_id)""")
def _(fx):
    a = fx.polys.select("poly_id", "attribute")
    one = R.zonal(fx.cells, fx.vertices, a, "chm").withColumnRenamed("chm", "strict")
    two = R.zonal(fx.cells, fx.vertices, a.select("poly_id"), "chm", na_rm=True).withColumnRenamed("chm", "mean")
    three = R.zonal(fx.cells, fx.vertices, a.select("poly_id"), "chm", na_rm=True, fun="median").withColumnRenamed("chm", "med")
    return rnd(one.join(two, "poly_id").join(three, "poly_id"), "strict", "mean", "med")


@query("e35_extract_nearest", "SELECT p.pt_id, k.dem, k.nir FROM fx_points p LEFT JOIN fx_cells k ON k.h = p.h AND k.r = floor(p.y) AND k.c = floor(p.x)")
def _(fx):
    return R.extract(fx.points.select("pt_id", "h", "x", "y"), [(fx.cells, "dem"), (fx.cells, "nir")]).select("pt_id", "dem", "nir")


@query("e36_extract_bilinear", "SELECT r AS pt_id, dem FROM (" + _bilinear_sql("(SELECT h, pt_id AS r, 0 AS c, x AS sx, y AS sy FROM fx_points)") + ")")
def _(fx):
    return rnd(R.extract(fx.points.select("pt_id", "h", "x", "y"), [(fx.cells, "dem")], "bilinear").select("pt_id", "dem"), "dem")


_BX = "(SELECT pt_id AS box_id, h, floor(x) - 3 AS xmin, floor(y) - 3 AS ymin, floor(x) + 3 AS xmax, floor(y) + 3 AS ymax FROM fx_points)"


@query("e37_chips", f"""WITH {cover_sql(1)}, {TOUCH}, lab AS (SELECT t.h, t.r, t.c, arg_max(a.cowardin, t.poly_id) AS cowardin FROM tch t JOIN fx_poly_attr a USING (poly_id) GROUP BY t.h, t.r, t.c)
 SELECT b.box_id, count(*) AS cells, count(l.cowardin) AS labelled, sum(k.red) AS red FROM {_BX} b JOIN fx_cells k ON b.h = k.h AND k.c + 0.5E0 >= xmin AND k.c + 0.5E0 < xmax AND k.r + 0.5E0 >= ymin AND k.r + 0.5E0 < ymax LEFT JOIN lab l ON l.h = k.h AND l.r = k.r AND l.c = k.c GROUP BY b.box_id""")
def _(fx):
    p = fx.points.select(c("pt_id").alias("box_id"), "h", F.floor("x").cast("double").alias("x"), F.floor("y").cast("double").alias("y"))
    cut = R.chips(fx.cells.select("h", "r", "c", "red"), R.rasterize(fx.vertices, fx.polys, "cowardin"), G.square(p, 3.0), "box_id", "cowardin", "none")
    patch = R.dense(cut, "box_id", "red").select("box_id", F.size("red").cast("long").alias("cells"), F.aggregate("red", F.lit(0.0), lambda a, v: a + v).alias("red"))
    return patch.join(cut.groupBy("box_id").agg(F.count_if(c("cowardin") != "none").alias("labelled")), "box_id")


@query("e38_sample_cells", "SELECT h, r, c FROM fx_cells ORDER BY (((h * 4096 + r) * 4096 + c) * 2654435761 + 40503) % 1000003, h, r, c LIMIT 500")
def _(fx):
    return R.sample_cells(fx.cells, 500, seed=1).select("h", "r", "c")


_OPT = "(SELECT r, c, CASE WHEN qa60 & 3072 = 0 THEN b3 END AS b3, CASE WHEN qa60 & 3072 = 0 THEN b4 END AS b4, CASE WHEN qa60 & 3072 = 0 THEN b8 END AS b8, CASE WHEN qa60 & 3072 = 0 THEN b11 END AS b11 FROM fx_obs WHERE scl NOT IN (3, 7, 8, 9, 10) AND cloud_pct < 20)"


@query("e42_median_composite", f"SELECT r, c, round(median((b8 - b4) / nullif(CAST(b8 + b4 AS DOUBLE), 0)), 6) AS NDVI, round(median((b3 - b11) / nullif(CAST(b3 + b11 AS DOUBLE), 0)), 6) AS MNDWI FROM {_OPT} GROUP BY r, c")
def _(fx):
    return rnd(R.median_composite(_optical(fx), ["NDVI", "MNDWI"]), "NDVI", "MNDWI")


def _optical(fx):
    bands = ["b2", "b3", "b4", "b6", "b8", "b11"]
    clear = I.mask_qa60(I.mask_scl(fx.obs.filter("cloud_pct < 20")), bands)
    return I.optical_indices(clear)


@query("e43_combined", f"""SELECT o.r, o.c, round(CAST(CAST(o.NDVI AS FLOAT) AS DOUBLE), 4) AS NDVI, round(CAST(CAST(s.RVI AS FLOAT) AS DOUBLE), 4) AS RVI FROM (SELECT r, c, median((b8 - b4) / nullif(CAST(b8 + b4 AS DOUBLE), 0)) AS NDVI FROM {_OPT} GROUP BY r, c) o
 JOIN (SELECT r, c, median(4.0E0 * vh / nullif(vv + vh, 0)) AS RVI FROM fx_obs WHERE mode = 'IW' AND pols = 'VV,VH' GROUP BY r, c) s USING (r, c)""")
def _(fx):
    radar = I.sar_indices(I.has_pols(fx.obs, ["VV", "VH"], "IW").withColumns({b: c(b).cast("double") for b in ("vv", "vh")}))
    both = R.combined_composite(R.median_composite(_optical(fx), ["NDVI"]), R.median_composite(radar, ["RVI"]))
    return both.select("r", "c", *[F.round(c(b).cast("double"), 4).alias(b) for b in ("NDVI", "RVI")])


@query("e44_mosaic_latest", "SELECT r, c, b8, vv FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY ts DESC, b2 DESC) AS n FROM fx_obs) WHERE n = 1")
def _(fx):
    return R.mosaic_latest(fx.obs, ["b8", "vv"], "b2")


@query("e45_collection_median", "SELECT r, c, median(b8) AS b8 FROM fx_obs WHERE r BETWEEN 2 AND 9 AND c BETWEEN 1 AND 12 GROUP BY r, c")
def _(fx):
    return R.median_composite(R.crop(fx.obs, 2, 9, 1, 12), ["b8"])


_CLEAN = "SELECT * FROM fx_returns WHERE NOT withheld AND cls NOT IN (7, 18)"


@query("l01_clean_returns", f"SELECT h, cls, count(*) AS n, sum(z) AS z FROM ({_CLEAN}) GROUP BY h, cls")
def _(fx):
    return P.clean_returns(fx.returns).groupBy("h", "cls").agg(F.count("*").alias("n"), F.sum("z").alias("z"))


# three ground returns within 4 are the nearest; places with fewer are tried against all of their watershed
@query("l02_normalize_height", """WITH s AS (SELECT DISTINCT h, x, y FROM fx_returns), g AS (SELECT h, x AS gx, y AS gy, min(z) AS gz, CAST(floor(x / 4) AS BIGINT) AS bx, CAST(floor(y / 4) AS BIGINT) AS by FROM fx_returns WHERE cls = 2 GROUP BY h, x, y),
 t AS (SELECT s.h, x, y, CAST(floor(x / 4) AS BIGINT) + i AS bx, CAST(floor(y / 4) AS BIGINT) + j AS by FROM s, (SELECT unnest(range(-1, 2)) AS i), (SELECT unnest(range(-1, 2)) AS j)),
 n AS (SELECT t.h, x, y, gx, gy, gz, pow(x - gx, 2) + pow(y - gy, 2) AS d2 FROM t JOIN g ON g.h = t.h AND g.bx = t.bx AND g.by = t.by WHERE pow(x - gx, 2) + pow(y - gy, 2) <= 16),
 few AS (SELECT s.h, s.x, s.y FROM s LEFT JOIN n ON n.h = s.h AND n.x = s.x AND n.y = s.y GROUP BY s.h, s.x, s.y HAVING count(gz) < 3),
 m AS (SELECT * FROM n ANTI JOIN few USING (h, x, y) UNION ALL SELECT f.h, x, y, gx, gy, gz, pow(x - gx, 2) + pow(y - gy, 2) FROM few f JOIN g ON g.h = f.h),
 k AS (SELECT *, row_number() OVER (PARTITION BY h, x, y ORDER BY d2, gx, gy) AS k FROM m)
 SELECT s.h, s.x, s.y, round(sum(gz / (d2 + 1e-6)) / sum(1 / (d2 + 1e-6)), 4) AS ground FROM s LEFT JOIN k ON k.h = s.h AND k.x = s.x AND k.y = s.y AND k <= 3 GROUP BY s.h, s.x, s.y""")
def _(fx):
    out = P.normalize_height(fx.returns, 3, 2.0)
    return rnd(out.groupBy("h", "x", "y").agg(F.max("ground").alias("ground")), "ground", n=4)


@query("l03_clip_height", "WITH u AS (SELECT * FROM fx_returns WHERE z >= 0), q AS (SELECT quantile_cont(z, 0.98) AS q FROM u) SELECT h, z, count(*) AS n FROM u, q WHERE z < q GROUP BY h, z")
def _(fx):
    return P.clip_height(fx.returns, "z", 0.98).groupBy("h", "z").agg(F.count("*").alias("n"))


_VEG = "SELECT h, CAST(floor(y) AS BIGINT) AS r, CAST(floor(x) AS BIGINT) AS c, round(avg(CASE WHEN z < 1 THEN 1.0E0 ELSE 0 END), 6) AS pct_below_1m, round(avg(CASE WHEN z >= 1 AND z <= 5 THEN 1.0E0 ELSE 0 END), 6) AS pct_1m_to_5m, round(avg(CASE WHEN z > 5 THEN 1.0E0 ELSE 0 END), 6) AS pct_above_5m FROM ({}) GROUP BY 1, 2, 3"
_PCT = ("pct_below_1m", "pct_1m_to_5m", "pct_above_5m")


@query("l04_veg_metrics", _VEG.format(_CLEAN))
def _(fx):
    return rnd(P.veg_metrics(P.clean_returns(fx.returns), "z"), *_PCT)


@query("l05_thin_returns", "SELECT id FROM (SELECT l_orderkey * 8 + l_linenumber AS id, row_number() OVER (PARTITION BY l_suppkey % 4, floor(l_partkey % 64 + l_tax * 8), floor(l_orderkey % 64 + l_discount * 8) ORDER BY ((l_orderkey * 8 + l_linenumber) * 2654435761) % 1000003, l_orderkey * 8 + l_linenumber) AS n FROM lineitem WHERE l_linenumber = 1) WHERE n <= 1")
def _(fx):
    r = fx.sql("SELECT l_suppkey % 4 AS h, l_orderkey % 64 + l_discount * 8 AS x, l_partkey % 64 + l_tax * 8 AS y, l_linenumber AS ret_no, l_orderkey * 8 + l_linenumber AS id FROM lineitem")
    return P.thin_returns(r, 1, "id").select("id")


@query("l06_lidar_zones", f"WITH m AS ({_VEG.format(_CLEAN)}) SELECT z.zone_id, count(*) AS cells, round(avg(pct_below_1m), 5) AS below, round(avg(pct_above_5m), 5) AS above FROM m JOIN fx_zones z ON z.zone_id % 4 = m.h AND m.c + 0.5E0 >= z.xmin AND m.c + 0.5E0 < z.xmax AND m.r + 0.5E0 >= z.ymin AND m.r + 0.5E0 < z.ymax GROUP BY z.zone_id")
def _(fx):
    zones = fx.zones.select("zone_id", (c("zone_id") % 4).alias("h"), "xmin", "ymin", "xmax", "ymax")
    cells = G.box_cells(zones, P.veg_metrics(P.clean_returns(fx.returns), "z"), "zone_id")
    return rnd(cells.groupBy("zone_id").agg(F.count("*").alias("cells"), F.avg("pct_below_1m").alias("below"), F.avg("pct_above_5m").alias("above")), "below", "above", n=5)
