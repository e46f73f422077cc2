"""Queries of aggregates, windows, sets, key joins and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import parse_asset
from ..operators import audit as A
from ..operators import stats as T
from .registry import query

c = F.col
BANDS = ["dem", "chm", "red", "green", "blue", "nir"]


def rnd(df, *cols):
    return df.withColumns({x: F.round(x, 6) for x in cols})


@query("g01_count_by", "SELECT h, mod_class, count(*) AS n FROM fx_points GROUP BY h, mod_class")
def _(fx):
    return T.count_by(fx.points, "h", "mod_class")


@query("g02_mean_by", "SELECT mod_class, round(avg(bal), 6) AS mean, count(*) AS n FROM fx_points GROUP BY mod_class")
def _(fx):
    return rnd(T.mean_by(fx.points, "mod_class", "bal"), "mean")


@query("g03_null_counts", "SELECT h, count(*) - count(r) AS r, count(*) - count(c) AS c, count(*) - count(dem) AS dem, count(*) - count(chm) AS chm FROM fx_cells GROUP BY h")
def _(fx):
    return T.null_counts(fx.cells.select("h", "r", "c", "dem", "chm"), "h")


@query("g04_flag_low", """SELECT pt_id, round(avg(bal) OVER w, 6) AS mean, round(stddev_samp(bal) OVER w, 6) AS sd, CASE WHEN bal < abs(avg(bal) OVER w - stddev_samp(bal) OVER w) THEN 'YesBad' ELSE 'No' END AS flag FROM fx_points WINDOW w AS (PARTITION BY h)""")
def _(fx):
    return rnd(T.flag_low(fx.points, ["h"], "bal").select("pt_id", "mean", "sd", "flag"), "mean", "sd")


@query("g05_distinct_on", "SELECT mod_class, pt_id, bal FROM (SELECT *, row_number() OVER (PARTITION BY mod_class ORDER BY bal, pt_id) AS n FROM fx_points) WHERE n = 1")
def _(fx):
    return T.distinct_on(fx.points.select("mod_class", "pt_id", "bal"), ["mod_class"], ["bal", "pt_id"])


@query("g06_list_by", "SELECT layer, array_to_string(list_sort(list(DISTINCT mb)), ',') AS mbs FROM fx_assets GROUP BY layer")
def _(fx):
    return T.list_by(fx.assets, "layer", "mb").select("layer", F.array_join(c("values").cast("array<string>"), ",").alias("mbs"))


_LONG = "(SELECT 'dem' AS band, dem AS value FROM fx_cells UNION ALL SELECT 'chm', chm FROM fx_cells UNION ALL SELECT 'nir', nir FROM fx_cells)"


@query("g07_global_stats", f"SELECT band, round(avg(value), 6) AS mean, max(value) AS max, round(stddev_samp(value), 6) AS sd, count(value) AS n, round(avg(CASE WHEN value > 3 THEN 1.0E0 WHEN value <= 3 THEN 0 END), 6) AS over3 FROM {_LONG} GROUP BY band")
def _(fx):
    return rnd(T.global_stats(fx.cells, ["dem", "chm", "nir"], {"over3": F.avg((c("value") > 3).cast("double"))}), "mean", "sd", "over3")


@query("g08_band_minmax", f"SELECT band, min(value) AS min, max(value) AS max FROM {_LONG} WHERE band <> 'chm' GROUP BY band")
def _(fx):
    return T.band_minmax(fx.cells, ["dem", "chm", "nir"], skip=("chm",))


@query("g09_corr", "SELECT round(corr(red, nir), 6) AS corr FROM fx_cells")
def _(fx):
    return rnd(T.correlation(fx.cells, "red", "nir"), "corr")


@query("g10_histogram", "SELECT CAST(least(floor((mb - lo) * 10 / CAST(hi - lo AS DOUBLE)), 9) AS BIGINT) AS bin, count(*) AS n FROM fx_assets, (SELECT min(mb) AS lo, max(mb) AS hi FROM fx_assets) GROUP BY 1")
def _(fx):
    return T.histogram(fx.assets, "mb", 10)


@query("g11_to_long", "SELECT h, r, c, 'red' AS band, red AS value FROM fx_cells UNION ALL SELECT h, r, c, 'nir', nir FROM fx_cells")
def _(fx):
    return T.to_long(fx.cells, ["h", "r", "c"], ["red", "nir"])


@query("g12_zscore", """SELECT h, r, c, 'red' AS band, round((red - m) / s, 6) AS value FROM fx_cells, (SELECT avg(red) AS m, stddev_samp(red) AS s FROM fx_cells)
 UNION ALL SELECT h, r, c, 'nir', round((nir - m) / s, 6) FROM fx_cells, (SELECT avg(nir) AS m, stddev_samp(nir) AS s FROM fx_cells)""")
def _(fx):
    return rnd(T.zscore(fx.cells, ["h", "r", "c"], ["red", "nir"]), "value")


@query("g13_quantiles_by", "SELECT mod_class, round(quantile_cont(bal, 0.25), 6) AS q25, round(quantile_cont(bal, 0.5), 6) AS q50, round(quantile_cont(bal, 0.75), 6) AS q75 FROM fx_points GROUP BY mod_class")
def _(fx):
    return rnd(T.quantiles_by(fx.points, "mod_class", "bal", [0.25, 0.5, 0.75]), "q25", "q50", "q75")


@query("w01_row_number", "SELECT pt_id, CAST(row_number() OVER (PARTITION BY h ORDER BY pt_id DESC) AS INTEGER) AS n FROM fx_points")
def _(fx):
    return T.row_number(fx.points, [c("pt_id").desc()], ["h"]).select("pt_id", "n")


@query("w02_first_by", "SELECT layer, arg_min(path, mb * 100000 + length(path)) AS path FROM (SELECT *, row_number() OVER (PARTITION BY layer, mb ORDER BY path) AS n FROM fx_assets) WHERE n = 1 GROUP BY layer")
def _(fx):
    one = T.distinct_on(fx.assets, ["layer", "mb"], ["path"]).withColumn("at", c("mb") * 100000 + F.length("path"))
    return T.first_by(one, "layer", "path", "at")


@query("o01_order", "SELECT path, mb FROM fx_assets ORDER BY mb DESC, path")
def _(fx):
    return fx.assets.select("path", "mb").orderBy(c("mb").desc(), "path")


@query("o02_head", "SELECT zone_id, name FROM fx_zones ORDER BY name LIMIT 3")
def _(fx):
    return fx.zones.select("zone_id", "name").orderBy("name").limit(3)


@query("o03_which_max", "SELECT arg_max(path, mb * 1000 + k) AS largest, arg_min(path, mb * 1000 + k) AS smallest FROM (SELECT path, mb, row_number() OVER (ORDER BY path) AS k FROM fx_assets)")
def _(fx):
    one = T.row_number(fx.assets, ["path"], name="k").withColumn("at", c("mb") * 1000 + c("k"))
    return T.which_max(one, "path", "at")


@query("u01_row_bind", "SELECT n_nationkey AS id, n_name AS name, CAST(NULL AS BIGINT) AS size FROM nation UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier")
def _(fx):
    a = fx.table("nation").select(c("n_nationkey").alias("id"), c("n_name").alias("name"))
    b = fx.table("supplier").select(c("s_suppkey").alias("id"), c("s_nationkey").cast("long").alias("size"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u02_union_basins", "SELECT zone_id, name FROM fx_zones")
def _(fx):
    z = fx.zones.select("zone_id", "name", c("cluster").alias("cluster_old"))
    return T.union_basins([z.filter("cluster < 3"), z.filter("cluster > 1"), z.filter("cluster = 2")], ("_old",), ["zone_id"])


@query("u03_set_operations", """SELECT 'minus' AS op, huc FROM (SELECT DISTINCT regexp_extract(path, 'huc_([0-9]{12})', 1) AS huc FROM fx_assets WHERE layer = 'DEM' EXCEPT SELECT regexp_extract(path, 'huc_([0-9]{12})', 1) FROM fx_assets WHERE layer = 'CHM')
 UNION ALL SELECT 'both', huc FROM (SELECT regexp_extract(path, 'huc_([0-9]{12})', 1) AS huc FROM fx_assets WHERE layer = 'DEM' INTERSECT SELECT regexp_extract(path, 'huc_([0-9]{12})', 1) FROM fx_assets WHERE layer = 'CHM')""")
def _(fx):
    a, b = (parse_asset(fx.assets.filter(c("layer") == x)).select(c("huc12").alias("huc")) for x in ("DEM", "CHM"))
    tag = lambda df, op: df.select(F.lit(op).alias("op"), "huc")
    return tag(a.subtract(b), "minus").union(tag(a.intersect(b), "both"))


@query("u04_unique", "SELECT DISTINCT segment FROM fx_points")
def _(fx):
    return fx.points.select("segment").distinct()


@query("d16_left_join", "SELECT p.pt_id, z.name FROM fx_points p LEFT JOIN fx_zones z ON p.pt_id = z.zone_id * 7")
def _(fx):
    return fx.points.select("pt_id").join(fx.zones.select((c("zone_id") * 7).alias("pt_id"), "name"), "pt_id", "left")


@query("d17_semi_anti", "SELECT 'in' AS side, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) UNION ALL SELECT 'out', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def _(fx):
    poor = fx.table("customer").filter("c_acctbal < 0").select(c("c_custkey").alias("o_custkey"))
    o = fx.table("orders")
    return T.semi(o, poor, "o_custkey").select(F.lit("in").alias("side"), "o_orderkey").union(T.anti(o, poor, "o_custkey").select(F.lit("out").alias("side"), "o_orderkey"))


@query("d18_bind_cols", "SELECT a.pt_id, b.name FROM (SELECT pt_id, row_number() OVER (ORDER BY pt_id) AS n FROM fx_points) a JOIN (SELECT name, row_number() OVER (ORDER BY zone_id) AS n FROM fx_zones) b USING (n)")
def _(fx):
    return T.bind_cols(fx.points.select("pt_id"), fx.zones.select("zone_id", "name"), ["pt_id"], ["zone_id"]).select("pt_id", "name")


@query("d21_fuzzy_best", """SELECT candidate, arg_min(reference, d) AS reference, round(min(d[1]), 6) AS dist, candidate = arg_min(reference, d) AS exact FROM (
  SELECT a.candidate, b.reference, [1 - jaro_similarity(a.candidate, b.reference), b.k] AS d FROM fx_names a, (SELECT reference, CAST(row_number() OVER (ORDER BY reference) AS DOUBLE) AS k FROM (SELECT DISTINCT s_name AS reference FROM supplier)) b) GROUP BY candidate""")
def _(fx):
    return rnd(T.fuzzy_best(fx.names, fx.table("supplier"), "candidate", "s_name"), "dist")


# --- audits
_WANT = "(SELECT z.huc12, z.cluster, l.layer FROM fx_zones z, (VALUES ('DEM'),('NAIP'),('Satellite'),('Hydro'),('Lidar'),('CHM'),('TerrainSlp'),('TerrainCurv'),('TerrainDMV')) l(layer))"
_GAPS = f"SELECT w.layer AS source, w.huc12 AS huc, w.cluster FROM {_WANT} w WHERE NOT EXISTS (SELECT 1 FROM fx_assets a WHERE a.layer = w.layer AND contains(a.path, w.huc12))"
_ODD = " AND (SELECT count(*) FROM fx_assets a WHERE a.layer = w.layer) <> CASE WHEN w.layer = 'DEM' THEN (SELECT count(*) FROM fx_zones) ELSE (SELECT count(*) FROM fx_assets WHERE layer = 'DEM') END"


@query("q01_missing_strict", _GAPS)
def _(fx):
    return A.missing_layers(fx.zones, fx.assets, strict=True)


@query("q01_missing_literal", _GAPS + _ODD)
def _(fx):
    return A.missing_layers(fx.zones, fx.assets)


@query("q02_stackable", f"SELECT zone_id, huc12 FROM fx_zones WHERE huc12 NOT IN (SELECT huc FROM ({_GAPS}))")
def _(fx):
    return A.stackable(fx.zones, A.missing_layers(fx.zones, fx.assets, strict=True)).select("zone_id", "huc12")


@query("q03_missing_summary", f"SELECT source, array_to_string(list_sort(list(DISTINCT cluster)), ',') AS clusters, count(DISTINCT cluster) AS n FROM ({_GAPS}) GROUP BY source")
def _(fx):
    return A.missing_summary(A.missing_layers(fx.zones, fx.assets, strict=True)).withColumn("clusters", F.array_join(c("clusters").cast("array<string>"), ","))


_GRID = "(SELECT path, layer, crs, xoff, res, regexp_extract(path, 'huc_([0-9]{12})', 1) AS huc12 FROM fx_assets)"


@query("q04_grid_checklist", f"""SELECT g.huc12, g.path,
 CASE WHEN g.crs <> d.crs AND g.res <> d.res AND g.xoff = d.xoff THEN 'Something' || g.huc12 WHEN g.crs <> d.crs THEN g.path ELSE 'None' END AS r_list_crs_ext_res,
 CASE WHEN g.crs = d.crs AND g.xoff <> d.xoff THEN g.path ELSE 'None' END AS r_list_ext_res,
 CASE WHEN g.crs = d.crs AND g.xoff = d.xoff AND g.res <> d.res THEN g.path ELSE 'None' END AS r_list_res,
 CASE WHEN g.crs = d.crs AND g.xoff = d.xoff AND g.res = d.res THEN g.path ELSE 'None' END AS r_list
 FROM {_GRID} g JOIN {_GRID} d ON g.huc12 = d.huc12 AND d.layer = 'DEM'""")
def _(fx):
    g = parse_asset(fx.assets)
    return A.grid_checklist(g, g.filter("layer = 'DEM'"))


@query("q05_stack_probe", f"SELECT huc12, CASE WHEN count(DISTINCT crs || '|' || CAST(xoff AS VARCHAR) || '|' || CAST(res AS VARCHAR)) = 1 THEN 'None' ELSE huc12 END AS problem FROM {_GRID} GROUP BY huc12")
def _(fx):
    return A.stack_probe(parse_asset(fx.assets))


@query("q06_band_coverage", """WITH n AS (SELECT h, 'dem' AS band, count(dem) AS n FROM fx_cells GROUP BY h UNION ALL SELECT h, 'chm', count(chm) FROM fx_cells GROUP BY h)
 SELECT h, band, n, round(avg(n) OVER (PARTITION BY band), 6) AS mean, round(stddev_samp(n) OVER (PARTITION BY band), 6) AS sd, CASE WHEN n < abs(avg(n) OVER (PARTITION BY band) - stddev_samp(n) OVER (PARTITION BY band)) THEN 'YesBad' ELSE 'No' END AS flag FROM n""")
def _(fx):
    return rnd(A.band_coverage(fx.cells, "h", ["dem", "chm"]), "mean", "sd")


@query("q07_small_assets", "SELECT path, mb FROM fx_assets WHERE mb < 100")
def _(fx):
    return A.small_assets(fx.assets, 100).select("path", "mb")


@query("q08_counts_match", "SELECT a, b, a = b AS same FROM (SELECT count(*) FILTER (layer = 'DEM') AS a, count(*) FILTER (layer = 'CHM') AS b FROM fx_assets)")
def _(fx):
    return A.counts_match(fx.assets, "DEM", "CHM")


@query("q09_unmatched_and_counts", f"SELECT layer, count(DISTINCT huc12) AS hucs, count(*) AS files FROM {_GRID} GROUP BY layer UNION ALL SELECT 'unmatched', count(*), 0 FROM (SELECT huc12 FROM (SELECT concat('0414', lpad(CAST(s_suppkey AS VARCHAR), 8, '0')) AS huc12 FROM supplier) WHERE huc12 NOT IN (SELECT huc12 FROM fx_zones))")
def _(fx):
    asked = fx.table("supplier").select(F.concat(F.lit("0414"), F.lpad(c("s_suppkey").cast("string"), 8, "0")).alias("huc12"))
    lost = A.unmatched_ids(asked, fx.zones).agg(F.lit("unmatched").alias("layer"), F.count("*").alias("hucs"), F.lit(0).cast("long").alias("files"))
    return A.layer_counts(fx.assets).unionByName(lost)


@query("q11_describe_cells", "SELECT count(*) AS cells, count(*) - count(chm) AS missing, round(100.0E0 * (count(*) - count(chm)) / count(*), 6) AS pct, min(chm) AS lo, max(chm) AS hi FROM fx_cells")
def _(fx):
    return rnd(A.describe_cells(fx.cells, "chm"), "pct")


@query("e46_minmax_scale", "SELECT h, r, c, round((dem - a) / (b - a), 6) AS dem, round((nir - e) / (f - e), 6) AS nir FROM fx_cells, (SELECT min(dem) AS a, max(dem) AS b, min(nir) AS e, max(nir) AS f FROM fx_cells)")
def _(fx):
    stats = T.band_minmax(fx.cells, ["dem", "nir"])
    return rnd(T.minmax_scale(fx.cells.select("h", "r", "c", "dem", "nir"), stats, ["dem", "nir"]), "dem", "nir")
