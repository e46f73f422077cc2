"""Raster algebra on cell tables: mosaics, masks, resampling, stacking, zonal statistics, patches, composites."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .focal import on_tiles
from .geometry import box_cells, cell_set, cut_cells, hash_order

KEY = ["h", "r", "c"]


def mosaic(tiles: DataFrame, fun: str, band: str = "v", order: str = "tile_ord", key: list[str] = KEY) -> DataFrame:
    """One value per cell of overlapping tiles: the first non-null in tile order, the largest, or the mean."""
    agg = {"first": F.min_by(band, F.when(F.col(band).isNotNull(), F.col(order))), "max": F.max(band), "mean": F.avg(band)}[fun]
    return tiles.groupBy(*key).agg(agg.alias(band))


def merge_crop(tiles: DataFrame, zones: DataFrame, zone_id: str = "zone_id") -> DataFrame:
    return box_cells(zones, mosaic(tiles, "first"), zone_id)


def touched(vertices: DataFrame) -> DataFrame:
    """Cells that a polygon touches: the centre is inside, or an edge runs through the closed cell."""
    return cell_set(vertices).union(cut_cells(vertices)).distinct()


def mask(cells: DataFrame, vertices: DataFrame, touches: bool = False) -> DataFrame:
    """Cells inside (or touched by) any polygon."""
    hit = touched(vertices) if touches else cell_set(vertices)
    return cells.join(hit.select(*KEY).distinct(), KEY, "left_semi")


def crop(cells: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    return cells.filter(F.col("r").between(r0, r1) & F.col("c").between(c0, c1))


def fill_where(a: DataFrame, b: DataFrame, band: str, value: float) -> DataFrame:
    """On the cells of ``a``: the band of ``b``, or a value where it is missing."""
    return a.join(b.select(*KEY, band), KEY, "left").withColumn(band, F.coalesce(band, F.lit(value)))


def fill_in_zone(cells: DataFrame, zone: DataFrame, values: dict[str, float]) -> DataFrame:
    """Zone cells with missing bands set to constants; cells outside stay as they are."""
    full = zone.select(*KEY).join(cells, KEY, "left")
    full = full.withColumns({b: F.coalesce(b, F.lit(v)) for b, v in values.items()})
    return full.unionByName(cells.join(zone.select(*KEY), KEY, "left_anti"), allowMissingColumns=True)


def _neighbours(target: DataFrame, size: int) -> DataFrame:
    """Source cells around each target's position (sx, sy): the 2 x 2 or 4 x 4 nearest centres, with offsets."""
    r0, c0 = F.floor(F.col("sy") - 0.5), F.floor(F.col("sx") - 0.5)
    low = 1 - size // 2
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(low, low + size) for j in range(low, low + size)])
    t = target.withColumns({"_r0": r0, "_c0": c0, "_ty": F.col("sy") - 0.5 - r0, "_tx": F.col("sx") - 0.5 - c0}).withColumn("_d", F.explode(grid))
    return t.withColumns({"_r": F.col("_r0") + F.col("_d.i"), "_c": F.col("_c0") + F.col("_d.j")})


def _bspline(t: Column, k: Column) -> Column:
    """Cubic B-spline weight of the neighbour at offset k = -1, 0, 1, 2."""
    return (
        F.when(k == -1, (1 - t) ** 3 / 6).when(k == 0, (3 * t**3 - 6 * t**2 + 4) / 6).when(k == 1, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6).otherwise(t**3 / 6)
    )


def sample(target: DataFrame, cells: DataFrame, band: str, method: str, ids: list[str]) -> DataFrame:
    """Value at each target's source position (sx, sy), renormalised over the neighbours that have one."""
    if method == "nearest":
        t = target.withColumns({"_r": F.floor("sy"), "_c": F.floor("sx")})
        src = cells.select(F.col("h"), F.col("r").alias("_r"), F.col("c").alias("_c"), band)
        return t.join(src, ["h", "_r", "_c"], "left").select(*ids, band)
    n = _neighbours(target, 2 if method == "bilinear" else 4)
    i, j = F.col("_d.i"), F.col("_d.j")
    if method == "bilinear":
        w = F.when(i == 0, 1 - F.col("_ty")).otherwise(F.col("_ty")) * F.when(j == 0, 1 - F.col("_tx")).otherwise(F.col("_tx"))
    else:
        w = _bspline(F.col("_ty"), i) * _bspline(F.col("_tx"), j)
    src = cells.select(F.col("h"), F.col("r").alias("_r"), F.col("c").alias("_c"), F.col(band).alias("_v"))
    met = n.withColumn("_w", w).join(src, ["h", "_r", "_c"], "left")
    have = F.sum(F.when(F.col("_v").isNotNull(), F.col("_w")))
    return met.groupBy(*ids).agg(F.try_divide(F.sum(F.col("_w") * F.col("_v")), have).alias(band))


def resample(cells: DataFrame, factor: float, band: str, method: str = "bilinear") -> DataFrame:
    """Onto the grid whose cells are ``factor`` source cells wide, over the source's extent."""
    if factor < 1 and round(1 / factor) * factor == 1 and method == "cubicspline":
        return _finer(cells, round(1 / factor), band)
    ext = cells.groupBy("h").agg(F.max("r").alias("rm"), F.max("c").alias("cm"))
    span = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), (F.ceil((F.col(m) + 1) / factor) - 1)))
    grid = ext.select("h", span("rm").alias("r"), "cm").select("h", "r", span("cm").alias("c"))
    at = grid.withColumns({"sy": (F.col("r") + 0.5) * factor, "sx": (F.col("c") + 0.5) * factor})
    return sample(at, cells, band, method, KEY)


def _finer(cells: DataFrame, f: int, band: str) -> DataFrame:
    """Cubic splines on cells ``f`` times finer. The f x f new cells of an old one have fixed weights, so a tile gives
    them from its own values and halo; no row stands for a new cell and one of its neighbours."""
    spline = lambda t: np.array([(1 - t) ** 3, 3 * t**3 - 6 * t**2 + 4, -3 * t**3 + 3 * t**2 + 3 * t + 1, t**3]) / 6
    at = [(int(np.floor((a + 0.5) / f - 0.5)), spline(((a + 0.5) / f - 0.5) % 1)) for a in range(f)]
    names = {(a, b): f"v{a}_{b}" for a in range(f) for b in range(f)}

    def made(grid: np.ndarray) -> dict[str, np.ndarray]:
        n, there = grid.shape[0] - 4, (~np.isnan(grid)).astype(float)
        v = np.where(there > 0, grid, 0.0)
        out = {}
        for (a, b), name in names.items():
            (i0, wi), (j0, wj) = at[a], at[b]
            total, have = np.zeros((n, n)), np.zeros((n, n))
            for i in range(4):
                for j in range(4):
                    part = (slice(1 + i0 + i, 1 + i0 + i + n), slice(1 + j0 + j, 1 + j0 + j + n))
                    total += wi[i] * wj[j] * v[part]
                    have += wi[i] * wj[j] * there[part]
            out[name] = np.divide(total, have, out=np.full((n, n), np.nan), where=have > 0)
        return out

    span = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.col(m).cast("long")))
    ext = cells.groupBy("h").agg(F.max("r").alias("rm"), F.max("c").alias("cm"))
    old = ext.select("h", span("rm").alias("r"), "cm").select("h", "r", span("cm").alias("c"))
    met = old.join(on_tiles(cells, band, 2, made, dict.fromkeys(names.values(), "double"), every=True), KEY, "left")
    new = F.explode(F.array(*[F.struct((F.col("r") * f + a).alias("r"), (F.col("c") * f + b).alias("c"), F.col(v).alias(band)) for (a, b), v in names.items()]))
    return met.select("h", new.alias("n")).select("h", "n.*")


def warp(cells: DataFrame, template: DataFrame, to_source, band: str) -> DataFrame:
    """Onto a template whose cell centres ``to_source`` maps to source positions."""
    sx, sy = to_source(F.col("c") + 0.5, F.col("r") + 0.5)
    return sample(template.select(*KEY).withColumns({"sx": sx, "sy": sy}), cells, band, "bilinear", KEY)


def aggregate(cells: DataFrame, f: int, band: str, fun: str = "mean") -> DataFrame:
    agg = F.avg(band) if fun == "mean" else F.median(band)
    return cells.groupBy("h", F.floor(F.col("r") / f).alias("r"), F.floor(F.col("c") / f).alias("c")).agg(agg.alias(band))


def align(layers: dict[str, tuple[DataFrame, float]], ref: float) -> dict[str, DataFrame]:
    """Layers by name with their cell size; those whose size differs from the reference are resampled to it."""
    return {n: df if res == ref else resample(df, ref / res, n) for n, (df, res) in layers.items()}


def stack(layers: list[DataFrame], how: str = "inner") -> DataFrame:
    return reduce(lambda a, b: a.join(b, KEY, how), layers)


def rasterize(vertices: DataFrame, attrs: DataFrame, field: str, touches: bool = True) -> DataFrame:
    """A field of the polygons on the cells they touch; the last polygon by id wins."""
    hit = (touched(vertices) if touches else cell_set(vertices)).join(attrs.select("poly_id", field), "poly_id")
    return hit.groupBy(*KEY).agg(F.max_by(field, "poly_id").alias(field))


def reclass(df: DataFrame, band: str, pairs: dict) -> DataFrame:
    """Codes exchanged by a dictionary; others become null."""
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return df.withColumn(band, table[F.col(band)])


def zonal(cells: DataFrame, vertices: DataFrame, attrs: DataFrame, band: str, na_rm: bool = False, fun: str = "mean") -> DataFrame:
    """Mean or median of a band over each polygon's cells with its attributes; null where any covered cell has
    none, unless ``na_rm``."""
    return zonal_cells(cells, cell_set(vertices), attrs, band, na_rm, fun)


def zonal_cells(cells: DataFrame, member: DataFrame, attrs: DataFrame, band: str, na_rm: bool = False, fun: str = "mean") -> DataFrame:
    met = member.join(cells.select(*KEY, band), KEY, "inner" if na_rm else "left")
    agg = F.avg(band) if fun == "mean" else F.median(band)
    value = agg if na_rm else F.when(F.count(band) == F.count("*"), agg)
    return attrs.join(met.groupBy("poly_id").agg(value.alias(band)), "poly_id", "left")


def extract(pts: DataFrame, layers: list[tuple[DataFrame, str]], method: str = "nearest") -> DataFrame:
    """Bands of several layers at points, in one chain."""
    out = pts.withColumns({"sx": F.col("x"), "sy": F.col("y")})
    for cells, band in layers:
        got = sample(out.select("pt_id", "h", "sx", "sy"), cells, band, method, ["pt_id"])
        out = out.join(got, "pt_id", "left")
    return out.drop("sx", "sy")


def chips(stacked: DataFrame, labels: DataFrame, boxes: DataFrame, box_id: str, field: str, fill: str) -> DataFrame:
    """Cells of the stack in each box with their label, and a background label elsewhere."""
    return box_cells(boxes, stacked, box_id).join(labels.select(*KEY, field), KEY, "left").withColumn(field, F.coalesce(field, F.lit(fill)))


def dense(cells: DataFrame, box_id: str, band: str) -> DataFrame:
    """A patch's band as one array in row-major order."""
    both = F.sort_array(F.collect_list(F.struct("r", "c", F.col(band).alias("v"))))
    return cells.groupBy(box_id).agg(F.transform(both, lambda s: s["v"]).alias(band))


def sample_cells(cells: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n cells in hash order."""
    key = (F.col("h") * 4096 + F.col("r")) * 4096 + F.col("c")
    return cells.withColumn("_o", hash_order(key, seed)).orderBy("_o", *KEY).limit(n).drop("_o")


def median_composite(obs: DataFrame, bands: list[str]) -> DataFrame:
    return obs.groupBy("r", "c").agg(*[F.median(b).alias(b) for b in bands])


def combined_composite(optical: DataFrame, radar: DataFrame) -> DataFrame:
    """Optical and radar composites on one row, as single-precision bands."""
    met = optical.join(radar, ["r", "c"])
    return met.select("r", "c", *[F.col(b).cast("float").alias(b) for b in met.columns if b not in ("r", "c")])


def mosaic_latest(obs: DataFrame, bands: list[str], tie: str) -> DataFrame:
    """Each cell's latest observation (ties: largest ``tie``)."""
    last = F.max_by(F.struct(*bands), F.struct("ts", tie))
    return obs.groupBy("r", "c").agg(last.alias("b")).select("r", "c", "b.*")


