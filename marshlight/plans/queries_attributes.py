"""Queries of scans, sinks, attribute rules and indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import cleaning as L
from ..functions import indices as I
from ..functions import names as N
from ..operators.iterate import shared_dir
from ..sources import readers as R
from ..sources import sinks as S
from .registry import query

c = F.col


def r6(col, name):
    return F.round(col, 6).alias(name)


# --- scans
@query("a01_read_cells", "SELECT h, r, c, dem AS elevation, chm, red, green, blue, nir FROM fx_cells")
def _(fx):
    return R.pick_bands(fx.cells, rename={"dem": "elevation"})


@query("a02_band_pruning", "SELECT h, r, c, dem, nir FROM fx_cells")
def _(fx):
    return R.pick_bands(fx.cells, ["dem", "nir"])


@query("a03_read_window", "SELECT h, r, c, dem FROM fx_cells WHERE r BETWEEN 10 AND 20 AND c BETWEEN 30 AND 45")
def _(fx):
    return R.read_window(fx.cells, 10, 20, 30, 45).select("h", "r", "c", "dem")


@query("a04_read_polys", """SELECT poly_id, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM fx_vertices WHERE h = 1 GROUP BY poly_id""")
def _(fx):
    rings = fx.vertices.groupBy("h", "poly_id").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("ring")).withColumn("layer", c("h"))
    ring = rings.filter("layer = 1").select("poly_id", F.explode("ring").alias("v"))
    return ring.groupBy("poly_id").agg(F.count("*").alias("n"), F.sum("v.x").alias("sx"), F.sum("v.y").alias("sy"))


@query("a05_zone_pushdown", "SELECT zone_id, name, cluster, huc12 FROM fx_zones WHERE cluster IN (1, 3)")
def _(fx):
    return R.zones(fx.zones, clusters=[1, 3]).select("zone_id", "name", "cluster", "huc12")


@query("a06_in_bbox", "SELECT zone_id FROM fx_zones WHERE xmin <= 30 AND xmax >= 14 AND ymin <= 20 AND ymax >= 5")
def _(fx):
    return R.in_bbox(fx.zones, 14, 5, 30, 20).select("zone_id")


@query("a07_union_layers", """
    SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region, CAST(NULL AS BIGINT) AS size FROM nation
    UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""")
def _(fx):
    a = fx.table("nation").select(c("n_nationkey").alias("id"), c("n_name").alias("name"), c("n_regionkey").alias("region"))
    b = fx.table("part").select(c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_size").cast("long").alias("size"))
    return R.union_layers([a, b])


@query("a08_catalog", "SELECT path, 'CHM' AS layer FROM fx_assets WHERE regexp_matches(path, '_CHM\\.tif$')")
def _(fx):
    return N.catalog(fx.assets.select("path"), r"_CHM\.tif$", "CHM")


@query("a09_parse_asset", """SELECT path, CAST(regexp_extract(path, 'cluster_([0-9]+)_', 1) AS INTEGER) AS cluster,
    regexp_extract(path, 'huc_([0-9]{12})', 1) AS huc12, 'cluster' AS source FROM fx_assets""")
def _(fx):
    return N.parse_asset(fx.assets.select("path"))


@query("a10_select_layer", """SELECT path FROM fx_assets WHERE contains(path, 'cluster_1_') AND regexp_matches(path, '[^/]*Terrain[^/]*$') AND NOT regexp_matches(path, '[^/]*(10m|1000m)[^/]*$')""")
def _(fx):
    return N.select_layer(fx.assets, "Terrain", 1).select("path")


@query("a11_source_tag", """SELECT path, CASE WHEN contains(path,'NAIP') THEN 'Data/NAIP/cluster' ELSE split_part(path, '_', 1) END AS tag FROM fx_assets""")
def _(fx):
    return fx.assets.select("path", N.source_tag(c("path")).alias("tag"))


@query("a12_read_csvs", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0")
def _(fx):
    text = fx.table("orders").select(F.to_csv(F.struct(F.when(c("o_orderkey") % 10 != 0, c("o_orderkey")).alias("k"), "o_orderstatus")).alias("line"))
    row = text.select(F.from_csv("line", "o_orderkey long, o_orderstatus string").alias("v")).select("v.*")
    return row.filter(c("o_orderkey").isNotNull())


@query("a13_read_ids", "SELECT huc12 AS id FROM fx_zones")
def _(fx):
    lines = fx.zones.select(F.explode(F.array(F.concat(F.lit("  "), "huc12", F.lit(" ")), F.lit("   "))).alias("value"))
    return R.ids_of(lines)


@query("a14_footprints", """SELECT h, tile_ord, CAST(min(c) AS DOUBLE) AS xmin, CAST(min(r) AS DOUBLE) AS ymin, CAST(max(c) + 1 AS DOUBLE) AS xmax, CAST(max(r) + 1 AS DOUBLE) AS ymax FROM fx_tiles GROUP BY h, tile_ord""")
def _(fx):
    return R.footprints(fx.tiles, ["h", "tile_ord"]).drop("ring")


@query("a15_clean_index", """SELECT zone_id, coalesce(CASE WHEN zone_id % 2 = 0 THEN name END, huc12) AS collection, (xmax - xmin) * (zone_id + 1) AS area FROM fx_zones WHERE (xmax - xmin) * (zone_id + 1) > 100""")
def _(fx):
    idx = fx.zones.select("zone_id", F.when(c("zone_id") % 2 == 0, c("name")).alias("one"), c("huc12").alias("two"), ((c("xmax") - c("xmin")) * (c("zone_id") + 1)).alias("area"))
    return R.clean_index(idx, 100, ("one", "two")).select("zone_id", "collection", "area")


@query("a16_non_empty_tiles", """SELECT h, r, c, v FROM (SELECT h, r, c, CASE WHEN r % 8 <> 0 AND v > 45 THEN v END AS v FROM fx_tiles WHERE tile_ord = 1) t
    WHERE (h, r) IN (SELECT (h, r) FROM fx_tiles WHERE tile_ord = 1 AND r % 8 <> 0 AND v > 45)""")
def _(fx):
    t = fx.tiles.filter("tile_ord = 1").select("h", "r", "c", F.when((c("r") % 8 != 0) & (c("v") > 45), c("v")).alias("v"))
    return R.non_empty_tiles(t, ["h", "r"], "v")


@query("a17_virtual_mosaic", "SELECT h, tile_ord, r, c, v FROM fx_tiles WHERE tile_ord <= 3")
def _(fx):
    return R.union_layers([fx.tiles.filter(c("tile_ord") == i) for i in (1, 2, 3)])


@query("a18_clean_sites", """SELECT s_name AS Site_name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey + 0.5E0 END AS lat, CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN -s_suppkey - 0.25E0 END AS lon
    FROM supplier WHERE s_suppkey % 3 <> 0""")
def _(fx):
    k = c("s_suppkey")
    text = F.when(k % 3 == 0, F.lit("n/a, none")).when(k % 3 == 1, F.concat((k + 0.5).cast("string"), F.lit(", "), (-k - 0.25).cast("string"))).otherwise(F.concat((k + 0.5).cast("string"), F.lit(", -")))
    return N.clean_sites(fx.table("supplier").select(c("s_name").alias("Site name"), text.alias("lat lon")), "lat lon").drop("lat_lon")


@query("a19_match_files", "SELECT zone_id, huc12 FROM fx_zones z WHERE EXISTS (SELECT 1 FROM fx_assets a WHERE layer = 'CHM' AND contains(a.path, z.huc12))")
def _(fx):
    idx = fx.zones.withColumn("file", F.concat(F.lit("x/cluster_"), c("cluster").cast("string"), F.lit("_huc_"), "huc12", F.lit("_CHM.tif")))
    return N.match_files(idx, "file", fx.assets.filter("layer = 'CHM'")).select("zone_id", "huc12")


# --- sinks
@query("s01_write_cells", "SELECT h, r, c, dem FROM fx_cells")
def _(fx):
    path = _scratch(fx, "cells")
    S.write_cells(fx.cells.select("h", "r", "c", "dem"), path, ("h",))
    return fx.spark.read.parquet(path).select(c("h").cast("long").alias("h"), "r", "c", "dem")


@query("s02_write_polys", "SELECT poly_id, h, attribute, cowardin, rad FROM fx_poly_attr")
def _(fx):
    path = _scratch(fx, "polys")
    S.write_polys(fx.polys, path, ("h",))
    return fx.spark.read.parquet(path).select("poly_id", c("h").cast("long").alias("h"), "attribute", "cowardin", "rad")


def _scratch(fx, tag: str) -> str:
    """A new path in the shared folder that the session names."""
    import uuid

    return f"{shared_dir(fx.spark)}/{tag}-{uuid.uuid4().hex}"


@query("s03_pending", "SELECT zone_id, huc12 FROM fx_zones z WHERE NOT EXISTS (SELECT 1 FROM fx_assets a WHERE a.layer = 'Hydro' AND contains(a.path, z.huc12))")
def _(fx):
    done = N.parse_asset(fx.assets.filter("layer = 'Hydro'")).select("huc12")
    return S.pending(fx.zones, done, ["huc12"]).select("zone_id", "huc12")


@query("s04_write_csv", "SELECT CAST(zone_id AS INTEGER) AS zone_id, name FROM fx_zones")
def _(fx):
    path = _scratch(fx, "csv")
    for part in (0, 1):
        S.write_csv(fx.zones.filter(c("zone_id") % 2 == part).select("zone_id", "name"), path)
    return R.read_csvs(fx.spark, [path], "zone_id int, name string", "zone_id")


@query("s05_append_new", """SELECT path, layer FROM fx_assets WHERE layer IN ('DEM', 'CHM')""")
def _(fx):
    a = fx.assets.select("path", "layer")
    return S.append_new(a.filter("layer = 'DEM'"), a.filter("layer IN ('DEM', 'CHM')"), ["path"])


@query("s06_stats_json", """SELECT 'dem' AS band, '{"band":"dem","min":' || CAST(min(dem) AS VARCHAR) || ',"max":' || CAST(max(dem) AS VARCHAR) || '}' AS json FROM fx_cells""")
def _(fx):
    return S.stats_json(fx.cells.agg(F.lit("dem").alias("band"), F.min("dem").alias("min"), F.max("dem").alias("max")))


@query("s07_write_lines", "SELECT huc12 AS value FROM fx_zones WHERE cluster = 2")
def _(fx):
    path = _scratch(fx, "lines")
    S.write_lines(fx.zones.filter("cluster = 2"), "huc12", path)
    return fx.spark.read.text(path)


@query("s08_replace_partition", "SELECT h, r, c, CASE WHEN h = 2 THEN dem + 1 ELSE dem END AS dem FROM fx_cells")
def _(fx):
    path, aside = _scratch(fx, "fix"), _scratch(fx, "fix-staging")
    S.write_cells(fx.cells.select("h", "r", "c", "dem"), path, ("h",))
    wrong = fx.spark.read.parquet(path).filter("h = 2")
    S.replace_partition(fx.spark, wrong.withColumn("dem", c("dem") + 1), path, ("h",), aside)
    return fx.spark.read.parquet(path).select(c("h").cast("long").alias("h"), "r", "c", "dem")


# --- attribute rules
@query("b01_drop_codes", "SELECT poly_id, attribute FROM fx_poly_attr WHERE attribute IS NOT NULL AND NOT regexp_matches(attribute, '^R[1-5]')")
def _(fx):
    return K.drop_codes(fx.polys, "attribute", "^R[1-5]").select("poly_id", "attribute")


@query("b02_conditional_drop", "SELECT poly_id, attribute FROM fx_poly_attr WHERE attribute IS NOT NULL AND NOT (regexp_matches(attribute, '^L1') AND rad < 3)")
def _(fx):
    return K.drop_codes(fx.polys, "attribute", "^L1", c("rad") < 3).select("poly_id", "attribute")


_WATER = "(contains(attribute,'L1') OR contains(attribute,'L2') OR contains(attribute,'PUB') OR contains(attribute,'PUS') OR contains(attribute,'PAB') OR contains(attribute,'R2') OR contains(attribute,'R3')) AND NOT contains(attribute,'PFO') AND NOT contains(attribute,'PEM') AND NOT contains(attribute,'PSS')"
_NWI = f"""CASE WHEN {_WATER} THEN 'OpenWater'
 WHEN contains(attribute,'PSS') AND NOT contains(attribute,'PFO') AND NOT contains(attribute,'PEM') THEN 'ScrubShrub'
 WHEN contains(attribute,'PEM') AND NOT contains(attribute,'PFO') AND NOT contains(attribute,'PSS') THEN 'Emergent'
 WHEN contains(attribute,'PFO') AND NOT contains(attribute,'PSS') AND NOT contains(attribute,'PEM') THEN 'Forested'
 WHEN contains(attribute,'PSS') AND contains(attribute,'PFO') THEN 'Forested'
 WHEN contains(attribute,'PSS') AND contains(attribute,'PEM') THEN 'Emergent' ELSE attribute END"""
_PLAIN = """WHEN contains(attribute,'PSS') AND NOT contains(attribute,'FO') AND NOT contains(attribute,'EM') THEN 'ScrubShrub'
 WHEN contains(attribute,'PEM') AND NOT contains(attribute,'FO') AND NOT contains(attribute,'SS') THEN 'Emergent'
 WHEN contains(attribute,'PFO') AND NOT contains(attribute,'SS') AND NOT contains(attribute,'EM') THEN 'Forested'"""


@query("b03_classify_nwi", f"SELECT poly_id, {_NWI} AS wet, {_NWI.replace(chr(39) + 'L1' + chr(39), chr(39) + 'L2' + chr(39))} AS wet_old FROM fx_poly_attr")
def _(fx):
    return fx.polys.select("poly_id", K.classify_nwi("attribute").alias("wet"), K.classify_nwi("attribute", "no_lakes").alias("wet_old"))


@query("b04_nwi_ssw_mixed", f"SELECT poly_id, CASE WHEN {_WATER} THEN 'OpenWater' {_PLAIN} WHEN contains(attribute,'PSS') AND contains(attribute,'FO') THEN 'ScrubShrub' WHEN contains(attribute,'PSS') AND contains(attribute,'EM') THEN 'Emergent' ELSE attribute END AS wet FROM fx_poly_attr")
def _(fx):
    return fx.polys.select("poly_id", K.classify_nwi("attribute", "ssw_mixed").alias("wet"))


@query("b05_nwi_mixed", f"SELECT poly_id, CASE WHEN {_WATER} THEN 'OpenWater' {_PLAIN} WHEN contains(attribute,'FO') AND contains(attribute,'SS') THEN 'ForestedScrub' WHEN contains(attribute,'EM') AND contains(attribute,'SS') THEN 'EmergentScrub' ELSE attribute END AS wet FROM fx_poly_attr")
def _(fx):
    return fx.polys.select("poly_id", K.classify_nwi("attribute", "mixed").alias("wet"))


@query("b06_cowardin", """SELECT poly_id, CASE WHEN cowardin LIKE '%Lacustrine%' THEN 'OWW' WHEN cowardin LIKE '%-SS%' THEN 'SSW' WHEN cowardin LIKE '%-EM%' THEN 'EMW' WHEN cowardin LIKE '%-FO%' THEN 'FSW' ELSE 'UPL' END AS a,
 CASE WHEN cowardin LIKE '%Lacustrine%' THEN 'OWW' WHEN cowardin LIKE '%-SS%' THEN 'SSW' WHEN cowardin LIKE '%-EM%' THEN 'EMW' WHEN cowardin LIKE '%-FO%' THEN 'FSW' ELSE 'Other' END AS b,
 CASE WHEN cowardin LIKE '%Lacustrine%' THEN 'OWW' WHEN cowardin LIKE '%-SS%' THEN 'SSW' WHEN cowardin LIKE '%-EM%' THEN 'EMW' WHEN cowardin LIKE '%-FO%' THEN 'FSW' END AS n FROM fx_poly_attr""")
def _(fx):
    return fx.polys.select("poly_id", *[K.classify_cowardin("cowardin", d).alias(n) for d, n in (("UPL", "a"), ("Other", "b"), (None, "n"))])


@query("b07_adk", """SELECT poly_id, CASE WHEN h = 0 THEN 'UPL' WHEN contains(attribute,'UB') THEN 'UPL' WHEN contains(attribute,'SS') THEN 'SSW' WHEN contains(attribute,'EM') THEN 'EMW' WHEN contains(attribute,'FO') THEN 'FSW' ELSE 'REVIEW' END AS cls FROM fx_poly_attr""")
def _(fx):
    return fx.polys.select("poly_id", K.classify_adk(F.when(c("h") == 0, "U").otherwise("P"), "attribute").alias("cls"))


@query("b08_two_types", "SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'Forested|Shrub') THEN 'FSW' ELSE 'EMW' END AS cls FROM part")
def _(fx):
    return fx.table("part").select("p_partkey", K.classify_two("p_name").alias("cls"))


@query("b09_mod_class", f"""SELECT poly_id, m AS mod_class, CASE WHEN m = 'UPL' THEN 'UPL' ELSE 'WET' END AS coarse FROM (
  SELECT poly_id, CASE {_NWI} WHEN 'Emergent' THEN 'EMW' WHEN 'Forested' THEN 'FSW' WHEN 'ScrubShrub' THEN 'SSW' WHEN 'OpenWater' THEN 'OWW' WHEN 'UPL' THEN 'UPL' ELSE 'Other' END AS m FROM fx_poly_attr)""")
def _(fx):
    return fx.polys.select("poly_id", K.to_mod_class(K.classify_nwi("attribute")).alias("mod_class")).withColumn("coarse", K.to_coarse("mod_class"))


@query("b10_chm_adk", "SELECT h, r, c, CASE WHEN chm <= 1 THEN 'OWW' WHEN chm <= 3.5 THEN 'EMW' WHEN chm <= 5 THEN 'SSW' WHEN chm > 5 THEN 'FSW' ELSE 'REVIEW' END AS cls FROM fx_cells")
def _(fx):
    return fx.cells.select("h", "r", "c", K.classify_chm_adk("chm").alias("cls"))


@query("b11_chm_ndwi", """SELECT h, r, c, CASE WHEN chm <= 0.5 AND w > 0.2 THEN 'OWW' WHEN chm > 0.5 AND chm <= 3.5 AND w > 0.2 THEN 'EMW' WHEN chm BETWEEN 0.5 AND 5 AND w < 0.2 THEN 'SSW' WHEN chm > 5 THEN 'FSW' WHEN chm <= 3.5 THEN 'EMW' WHEN chm > 3.5 AND chm <= 5 THEN 'SSW' ELSE 'REVIEW' END AS cls
  FROM (SELECT h, r, c, chm, (green - nir) / nullif(green + nir, 0) AS w FROM fx_cells)""")
def _(fx):
    return I.naip_indices(fx.cells).select("h", "r", "c", K.classify_chm_ndwi("chm", "ndwi").alias("cls"))


CODE_CHM_SQL = """CASE WHEN w AND NOT fo AND NOT ss AND NOT em AND chm <= 1 THEN 'OWW'
 WHEN ss AND NOT fo AND NOT em AND chm BETWEEN 1 AND 5 THEN 'SSW' WHEN ss AND NOT fo AND NOT em AND chm > 5 THEN 'FSW'
 WHEN em AND NOT fo AND NOT ss AND chm <= 3.5 THEN 'EMW' WHEN em AND NOT fo AND NOT ss AND chm BETWEEN 1 AND 5 THEN 'SSW' WHEN em AND NOT fo AND NOT ss AND chm > 5 THEN 'FSW'
 WHEN fo AND NOT ss AND NOT em AND chm BETWEEN 1 AND 5 THEN 'SSW' WHEN fo AND NOT ss AND NOT em AND chm > 5 THEN 'FSW'
 WHEN pfo AND (ss OR em) AND chm <= 3.5 THEN 'EMW' WHEN pfo AND (ss OR em) AND chm BETWEEN 1 AND 5 THEN 'SSW' WHEN pfo AND (ss OR em) AND chm > 5 THEN 'FSW'
 WHEN pss AND fo AND chm BETWEEN 1 AND 5 THEN 'SSW' WHEN pss AND fo AND chm > 5 THEN 'FSW'
 WHEN pss AND em AND chm <= 3.5 THEN 'EMW' WHEN pss AND em AND chm > 3.5 AND chm <= 5 THEN 'SSW'
 WHEN pem AND ss AND chm <= 3.5 THEN 'EMW' WHEN pem AND ss AND chm > 3.5 AND chm <= 5 THEN 'SSW' ELSE 'REVIEW' END"""
CODE_PARTS_SQL = """contains(attribute,'FO') AS fo, contains(attribute,'SS') AS ss, contains(attribute,'EM') AS em, contains(attribute,'PFO') AS pfo, contains(attribute,'PSS') AS pss, contains(attribute,'PEM') AS pem,
 (contains(attribute,'L1') OR contains(attribute,'L2') OR contains(attribute,'PUB') OR contains(attribute,'PUS') OR contains(attribute,'PAB') OR contains(attribute,'R2') OR contains(attribute,'R3')) AS w"""


@query("b12_code_chm", f"""SELECT poly_id, step, {CODE_CHM_SQL} AS cls FROM (SELECT poly_id, step, step * 0.75E0 AS chm, {CODE_PARTS_SQL} FROM fx_poly_attr, (SELECT unnest(range(10)) AS step))""")
def _(fx):
    steps = fx.polys.select("poly_id", "attribute", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("step"))
    return steps.select("poly_id", "step", K.classify_code_chm("attribute", c("step") * 0.75).alias("cls"))


@query("b13_n_points", "SELECT o_orderkey, CAST(greatest(ceil(log10(o_totalprice)), 1) AS BIGINT) AS n FROM orders")
def _(fx):
    return fx.table("orders").select("o_orderkey", K.n_points("o_totalprice").alias("n"))


@query("b14_column_helpers", "SELECT nir, h, r, c, dem, chm FROM fx_cells")
def _(fx):
    return L.reorder(L.drop_like(fx.cells, contains=("gree",), starts=("bl",), ends=("ed",)), ["nir"])


@query("b15_prefix", "SELECT h, r, c, dem AS n_dem, chm AS n_chm, red AS n_red, green AS n_green, blue AS n_blue, nir AS n_nir FROM fx_cells")
def _(fx):
    return L.prefix(fx.cells, "n_", ("h", "r", "c"))


@query("b16_clean_numeric", """SELECT pt_id, a, b FROM (SELECT pt_id, CASE WHEN bal > 0 AND pt_id % 3 <> 0 THEN bal / (pt_id % 3) END AS a, CASE WHEN pt_id % 5 <> 0 THEN bal END AS b FROM fx_points) WHERE a IS NOT NULL AND b IS NOT NULL""")
def _(fx):
    a = F.when(c("bal") > 0, F.when(c("pt_id") % 3 == 0, F.lit(float("inf"))).otherwise(c("bal") / (c("pt_id") % 3)))
    b = F.when(c("pt_id") % 5 == 0, F.lit(float("nan"))).otherwise(c("bal"))
    df = fx.points.select("pt_id", a.alias("a"), b.alias("b"))
    return L.only_finite(L.drop_any_null(L.drop_all_null(L.clean_numeric(df, ["a", "b"]), ["a", "b"]), ["a", "b"]), ["a", "b"])


@query("b17_collapse_class", "SELECT pt_id, CASE WHEN mod_class = 'OWW' THEN 'UPL' ELSE mod_class END AS cls FROM fx_train WHERE NOT (mod_class = 'OWW' AND chm > 1)")
def _(fx):
    kept = fx.train.filter(~F.coalesce((c("mod_class") == "OWW") & (c("chm") > 1), (c("mod_class") == "OWW") & F.lit(None)))
    return kept.select("pt_id", K.collapse_class("mod_class").alias("cls"))


@query("b18_encode_levels", "SELECT pt_id, mod_class, CAST(CASE mod_class WHEN 'EMW' THEN 0 WHEN 'FSW' THEN 1 WHEN 'OWW' THEN 2 WHEN 'SSW' THEN 3 WHEN 'UPL' THEN 4 END AS INTEGER) AS mod_class_code FROM fx_points")
def _(fx):
    return L.encode_levels(fx.points.select("pt_id", "mod_class"), "mod_class", ["EMW", "FSW", "OWW", "SSW", "UPL"])


@query("b19_string_cleaning", """SELECT path, regexp_replace(path, '[^A-Za-z0-9]+', '_', 'g') AS clean, regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]*$', '') AS base,
  'https://x/' || substr(path, 6) AS url FROM fx_assets""")
def _(fx):
    p = c("path")
    return fx.assets.select("path", N.clean_name(p).alias("clean"), N.base_noext(p).alias("base"), N.swap_prefix(p, "Data/", "https://x/").alias("url"))


@query("b20_split_entry", "SELECT CAST(cluster AS INTEGER) AS number, name || ', ' || huc12 AS label FROM fx_zones")
def _(fx):
    line = F.concat(c("cluster").cast("string"), F.lit(", "), "name", F.lit(", "), "huc12")
    return N.split_entry(fx.zones.select(line.alias("line")), "line").select("number", "label")


@query("b21_row_id", "SELECT path, layer || '_' || CAST(row_number() OVER (PARTITION BY layer ORDER BY path) AS VARCHAR) AS row_id FROM fx_assets")
def _(fx):
    return N.with_row_id(fx.assets, "layer", ["path"]).select("path", "row_id")


@query("b22_season", "SELECT scene_id, r, c, cloud_pct FROM fx_obs WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-12-31' AND dayofyear(ts) BETWEEN 5 AND 273 AND cloud_pct < 20")
def _(fx):
    return I.season(fx.obs, "2024-01-01", "2024-12-31", 5, 273, 20).select("scene_id", "r", "c", "cloud_pct")


@query("b23_polarisation", "SELECT scene_id, r, c, vv, vh FROM fx_obs WHERE mode = 'IW' AND pols = 'VV,VH'")
def _(fx):
    return I.has_pols(fx.obs, ["VV", "VH"], "IW").select("scene_id", "r", "c", "vv", "vh")


@query("b24_mask_qa60", "SELECT scene_id, r, c, CASE WHEN qa60 & 3072 = 0 THEN b4 / 10000.0E0 END AS b4 FROM fx_obs")
def _(fx):
    return I.mask_qa60(fx.obs, ["b4"]).select("scene_id", "r", "c", "b4")


@query("b25_mask_scl", "SELECT scene_id, r, c, scl FROM fx_obs WHERE scl NOT IN (3, 7, 8, 9, 10)")
def _(fx):
    return I.mask_scl(fx.obs).select("scene_id", "r", "c", "scl")


@query("b26_optical_indices", """SELECT scene_id, r, c, round((b8 - b4) / nullif(CAST(b8 + b4 AS DOUBLE), 0), 6) AS NDVI, round((b3 - b11) / nullif(CAST(b3 + b11 AS DOUBLE), 0), 6) AS MNDWI,
  round((b4 - b2) / nullif(CAST(b6 AS DOUBLE), 0), 6) AS PSRI, round((b3 - b2) / nullif(CAST(b3 + b2 AS DOUBLE), 0), 6) AS NDYI, round((b8 - b3) / nullif(CAST(b8 + b3 AS DOUBLE), 0), 6) AS GDVI,
  round(2.5E0 * (b8 - b4) / nullif(b8 + 6 * b4 - 7.5E0 * b2 + 1, 0), 6) AS EVI FROM fx_obs""")
def _(fx):
    bands = ["NDVI", "MNDWI", "PSRI", "NDYI", "GDVI", "EVI"]
    df = I.optical_indices(fx.obs.withColumns({b: c(b).cast("double") for b in ("b2", "b3", "b4", "b6", "b8", "b11")}))
    return df.select("scene_id", "r", "c", *[r6(c(b), b) for b in bands])


@query("b27_sar_indices", """SELECT scene_id, r, c, round((vv - vh) / nullif(CAST(vv + vh AS DOUBLE), 0), 6) AS DPSVI, round(4 * vh / nullif(CAST(vv + vh AS DOUBLE), 0), 6) AS RVI, round(vh / nullif(CAST(vv AS DOUBLE), 0), 6) AS VH_VV_ratio FROM fx_obs""")
def _(fx):
    return I.sar_indices(fx.obs.withColumns({b: c(b).cast("double") for b in ("vv", "vh")})).select("scene_id", "r", "c", *[r6(c(b), b) for b in ("DPSVI", "RVI", "VH_VV_ratio")])


@query("b28_naip_indices", "SELECT h, r, c, round((nir - red) / nullif(nir + red, 0), 6) AS ndvi, round((green - nir) / nullif(green + nir, 0), 6) AS ndwi FROM fx_cells")
def _(fx):
    return I.naip_indices(fx.cells).select("h", "r", "c", r6(c("ndvi"), "ndvi"), r6(c("ndwi"), "ndwi"))


@query("b29_scale_bands", "SELECT scene_id, r, c, b2 * 0.5E0 AS b2, b3 * 0.25E0 AS b3 FROM fx_obs")
def _(fx):
    return I.scale_bands(fx.obs, {"b2": 0.5, "b3": 0.25}).select("scene_id", "r", "c", "b2", "b3")


@query("b30_unmask", "SELECT h, r, c, coalesce(chm, -1.0E0) AS chm FROM fx_cells")
def _(fx):
    return I.unmask(fx.cells, -1.0, ["chm"]).select("h", "r", "c", "chm")


@query("b31_log_band", "SELECT h, r, c, CASE WHEN chm > 0 THEN round(ln(chm), 6) END AS chm FROM fx_cells")
def _(fx):
    return I.log_band(fx.cells, "chm").select("h", "r", "c", r6(c("chm"), "chm"))


@query("b32_review_fields", "SELECT '' AS ReviewerName, -999 AS Confidence, '' AS BoundariesAltered, '' AS Comments, mod_class, pt_id FROM fx_points")
def _(fx):
    return L.with_review_fields(fx.points.select("pt_id", "mod_class"), "mod_class")


@query("b33_exclude_zones", "SELECT zone_id, name, huc12 FROM fx_zones WHERE name NOT IN ('BRAZIL', 'CANADA') AND NOT regexp_matches(huc12, '0$')")
def _(fx):
    return L.exclude_zones(fx.zones.select("zone_id", "name", "huc12"), ["BRAZIL", "CANADA"], "0$")


@query("b34_class_table", "SELECT n_name AS name, n_nationkey AS value FROM nation")
def _(fx):
    both = fx.table("nation").groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("x"))
    return L.class_table(both.select(c("x.n_name").alias("n"), c("x.n_nationkey").alias("v")), "n", "v")
