"""User-level jobs: compositions of operators over all watersheds at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as K
from ..functions import indices as I
from ..functions.cleaning import drop_like, only_finite, prefix, with_review_fields
from ..operators import cells as R
from ..operators import focal as W
from ..operators import geometry as G
from ..operators import hydrology as H
from ..operators import learn as M
from ..operators import spatial as S
from ..operators import stats as T
from ..operators import terrain as E
from ..operators.iterate import settle

c = F.col
KEY = R.KEY


def dem_per_watershed(tiles: DataFrame, template: DataFrame, vertices: DataFrame) -> DataFrame:
    """First tile wins, gaps are filled from their neighbours, polygons mask."""
    return R.mask(W.fill_gaps(R.mosaic(tiles, "first"), template, "v"), vertices)


def canopy_per_watershed(tiles: DataFrame, dem: DataFrame, vertices: DataFrame) -> DataFrame:
    """Largest of overlapping tiles inside the polygons, zero where there is ground but no canopy."""
    chm = R.mosaic(tiles, "max").withColumnRenamed("v", "chm")
    return R.fill_where(R.mask(dem, vertices), chm, "chm", 0.0)


def aerial_per_watershed(cells: DataFrame, vertices: DataFrame) -> DataFrame:
    return I.naip_indices(R.mask(cells, vertices))


def satellite_composite(obs: DataFrame, grid: DataFrame, scale: float) -> DataFrame:
    """Seasonal medians of masked optical indices on a finer grid, the same scenes for every watershed of the grid. A place
    (r, c) is therefore worked out once for all watersheds and written, then given to their cells."""
    clear = I.mask_qa60(I.mask_scl(obs.filter(c("cloud_pct") < 20)), ["b2", "b3", "b4", "b6", "b8", "b11"])
    one = F.lit(0).alias("h")
    comp = R.median_composite(I.optical_indices(clear), ["NDVI"]).select(one, "r", "c", "NDVI")
    places = grid.select(one, "r", "c").distinct()
    made = settle(R.warp(comp, places, lambda x, y: (x * scale, y * scale), "NDVI"), "composite", cells=True)
    met = grid.select(*KEY).distinct().join(made.select("r", "c", "NDVI"), ["r", "c"], "left")
    return met.select(*KEY, F.when(c("h").isNotNull(), c("NDVI")).alias("NDVI"))


def terrain_metrics(cells: DataFrame, factor: int) -> DataFrame:
    return R.stack([E.terrain_at_scale(cells, factor, m) for m in ("slope", "tpi")])


def hydrology(cells: DataFrame) -> DataFrame:
    """Depressions filled, directions, accumulation, wetness index."""
    filled = H.fill_depressions(cells)
    acc = H.flow_acc(E.flowdir(filled))
    return R.stack([acc, E.twi(acc, E.slope_aspect(filled))])


def predictor_stack(cells: DataFrame, slope: DataFrame, acc: DataFrame) -> DataFrame:
    """Elevation, slope, log accumulation, canopy and aerial bands under their stack names."""
    aerial = prefix(cells.select(*KEY, "red", "green", "blue", "nir"), "n_", tuple(KEY))
    flow = I.log_band(acc.select(*KEY, c("acc").cast("double").alias("flowacc")), "flowacc")
    return R.stack([drop_like(cells.select(*KEY, "dem", "chm", "red"), contains=("red",)), slope.select(*KEY, "slope"), flow, aerial])


def wetland_by_canopy(polys: DataFrame, vertices: DataFrame, cells: DataFrame, depth: float = 0.5) -> DataFrame:
    """Wetland polygons classed by inventory code and mean canopy height inside their interior."""
    kept = K.drop_codes(polys, "attribute", "^R[1-5]")
    inner = G.interior(vertices.join(kept.select("poly_id"), "poly_id", "left_semi"), depth)
    high = R.zonal_cells(cells, inner, kept.select("poly_id", "h", "attribute"), "chm", na_rm=True)
    return high.withColumn("cls", K.classify_code_chm("attribute", "chm"))


def training_points(polys: DataFrame, vertices: DataFrame, per_poly: int, far: float) -> DataFrame:
    """Wetland points inside polygons with their class, upland points on a grid far from all of them, and extra
    points where classes are short."""
    wet = G.random_points(vertices, per_poly).withColumn("pt_id", c("poly_id") * 64 + c("k"))
    cls = polys.select("poly_id", K.to_mod_class(K.classify_nwi("attribute")).alias("mod_class"))
    wet = wet.join(cls, "poly_id").select("pt_id", "h", "x", "y", "mod_class")
    frame = vertices.groupBy("h").agg(F.max("poly_id").alias("top"), F.max("x").alias("xm"), F.max("y").alias("ym"))
    span = lambda k: F.explode(F.sequence(F.lit(0), F.floor(c(k)).cast("int"), F.lit(4)))
    up = frame.select("h", "top", span("xm").alias("i"), "ym").select("h", "top", "i", span("ym").alias("j"))
    up = up.select((F.lit(10_000_000) + (c("h") * 1000 + c("i")) * 1000 + c("j")).alias("pt_id"), "h", (c("i") + 0.5).alias("x"), (c("j") + 0.5).alias("y"), F.lit("UPL").alias("mod_class"))
    up = S.points_near(up, vertices, far, inverse=True).select("pt_id", "h", "x", "y", "mod_class")
    want = M.supplement_sizes(wet, "mod_class")
    pool = G.random_points(vertices, per_poly * 4, seed=17).withColumn("pt_id", 20_000_000 + c("poly_id") * 64 + c("k")).join(cls, "poly_id")
    kind = F.when(c("mod_class").isin("EMW", "SSW"), c("mod_class")).otherwise(F.when(c("mod_class") != "OWW", "other"))
    extra = T.row_number(pool.withColumn("kind", kind), [G.hash_order(c("pt_id")), "pt_id"], ["kind"]).crossJoin(F.broadcast(want))
    quota = F.when(c("mod_class") == "EMW", c("EMW")).when(c("mod_class") == "SSW", c("SSW")).when(c("mod_class") != "OWW", c("other")).otherwise(0)
    extra = extra.filter(c("n") <= quota).select("pt_id", "h", "x", "y", "mod_class")
    return wet.unionByName(up).unionByName(extra)


def vector_patches(vertices: DataFrame, polys: DataFrame, half: float) -> DataFrame:
    """Square patches about polygon centres that overlap no other patch, with the labelled area of each class and
    the upland remainder."""
    boxes = G.square(G.centroid(vertices), half).select(c("poly_id").alias("box_id"), "h", "xmin", "ymin", "xmax", "ymax")
    alone = S.non_overlapping(boxes, "box_id", ["h"])
    cover = G.clip_box(vertices, alone, "box_id").join(polys.select("poly_id", K.to_mod_class(K.classify_nwi("attribute")).alias("mod_class")), "poly_id")
    first = cover.groupBy("box_id", *KEY).agg(F.min_by("mod_class", "poly_id").alias("mod_class"))
    area = first.groupBy("box_id", "mod_class").agg(F.count("*").alias("area"))
    total = alone.select("box_id", F.lit(int(4 * half * half)).cast("long").alias("all"))
    rest = total.join(area.groupBy("box_id").agg(F.sum("area").alias("wet")), "box_id", "left").select("box_id", F.lit("UPL").alias("mod_class"), (c("all") - F.coalesce("wet", F.lit(0))).alias("area"))
    return with_review_fields(area.unionByName(rest), "mod_class")


def raster_patches(stack: DataFrame, polys: DataFrame, vertices: DataFrame, boxes: DataFrame) -> DataFrame:
    """Cells of the stack in each box with their label code; upland elsewhere."""
    good = vertices.join(G.valid(vertices), "poly_id", "left_semi")
    labels = R.rasterize(good, polys.withColumn("mod_class", K.to_mod_class(K.classify_nwi("attribute"))), "mod_class")
    cut = R.chips(stack, labels, boxes, "box_id", "mod_class", "UPL")
    return R.reclass(cut, "mod_class", {"EMW": 0, "FSW": 1, "SSW": 2, "UPL": 3, "OWW": 3})


def point_extraction(vertices: DataFrame, polys: DataFrame, cells: DataFrame, spacing: float, bands: list[str]) -> DataFrame:
    """Grid points in polygons with the bands beneath them, complete rows only."""
    pts = G.grid_points(vertices, spacing).withColumn("pt_id", F.concat_ws("_", c("poly_id").cast("string"), c("x").cast("string"), c("y").cast("string")))
    got = R.extract(pts, [(cells, b) for b in bands])
    return only_finite(got.join(polys.select("poly_id", "cowardin"), "poly_id"), bands)


def forest_report(train: DataFrame, bands: list[str], target: str, trees: int = 10) -> DataFrame:
    """Train on the split, score the rest: accuracy, kappa and the area under the curve, all from scores written once."""
    model, scored = M.last_fit(train.dropna("any", subset=bands).select("pt_id", target, *bands), target, bands, "pt_id", trees=trees)
    scored = settle(scored.drop("pt_id", *bands), "scored")
    classes = [x for x in M.levels(model) if x != "__unknown"]
    return M.cm_summary(M.conf_mat(scored, target, "pred_class", classes)).crossJoin(F.broadcast(M.auc_hand_till(scored, target, [x for x in classes if f"pred_{x}" in scored.columns])))


def prediction_map(train: DataFrame, cells: DataFrame, vertices: DataFrame, bands: list[str], target: str) -> DataFrame:
    """Class of every cell inside the polygons."""
    model = M.fit_rf(train.dropna("any", subset=bands), target, bands)
    return M.predict_map(model, R.mask(cells.select(*KEY, *bands), vertices), bands)


def pond_report(vertices: DataFrame, cells: DataFrame, distances: list[float], bands: list[str]) -> DataFrame:
    """Means of bands in each polygon and in the rings around it, in long form."""
    inner = G.cell_set(vertices).select("poly_id", F.lit(0.0).alias("ring"), *KEY)
    both = inner.unionByName(G.ring_cells(vertices, distances)).join(cells.select(*KEY, *bands), KEY)
    wide = both.groupBy("poly_id", "ring").agg(*[F.avg(b).alias(b) for b in bands])
    return T.to_long(wide, ["poly_id", "ring"], bands).orderBy("poly_id", "ring", "band")


def inventory_merge(a: DataFrame, b: DataFrame, vertices: DataFrame, zones: DataFrame) -> DataFrame:
    """Polygons of A and those of B that touch none of A, with their area per zone."""
    merged = S.priority_overlay(a, b, vertices)
    area = G.box_cells(zones, G.cell_set(vertices), "zone_id").groupBy("poly_id", "zone_id").agg(F.count("*").alias("area"))
    return merged.join(area, "poly_id")


def delineated_by_canopy(polys: DataFrame, vertices: DataFrame, cells: DataFrame, zones: DataFrame, depth: float = 0.5) -> DataFrame:
    """Polygons that meet a zone, classed by mean canopy height and water index inside their interior."""
    near = S.polys_meet_zones(vertices, zones).select("poly_id").distinct()
    v = vertices.join(near, "poly_id", "left_semi")
    inner = G.interior(v, depth)
    at = polys.join(near, "poly_id", "left_semi").select("poly_id")
    h = R.zonal_cells(cells, inner, at, "chm", na_rm=True)
    w = R.zonal_cells(I.naip_indices(cells), inner, at, "ndwi", na_rm=True)
    met = h.join(w, "poly_id")
    return met.select("poly_id", K.classify_chm_adk("chm").alias("adk"), K.classify_chm_ndwi("chm", "ndwi").alias("delineated"))


def zone_setup(vertices: DataFrame, zones: DataFrame, reach: float) -> DataFrame:
    """Zones with the area within ``reach`` of any polygon, dissolved."""
    near = G.cell_set(vertices).unionByName(G.outline_cells(vertices, reach).drop("dist"))
    region = G.dissolve(near, [])
    return G.box_cells(zones, region, "zone_id").groupBy("zone_id").agg(F.count("*").alias("area"))


