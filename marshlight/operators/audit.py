"""Completeness and quality audits of assets, grids and bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import parse_asset
from .stats import flag_low, to_long

LAYERS = ["DEM", "NAIP", "Satellite", "Hydro", "Lidar", "CHM", "TerrainSlp", "TerrainCurv", "TerrainDMV"]  # fixed values


def _layers(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(x,) for x in LAYERS], "layer string")


def missing_layers(zones: DataFrame, assets: DataFrame, strict: bool = False) -> DataFrame:
    """``source, huc, cluster`` of every watershed that lacks a layer.

    The literal rule looks at a layer only where its file count differs from that of the DEM (for the DEM: from
    the zones' count); ``strict`` looks at all.
    """
    have = parse_asset(assets.select("path", "layer")).select("layer", "huc12").distinct()
    want = zones.select("huc12", "cluster").join(F.broadcast(_layers(zones)))
    gaps = want.join(have, ["layer", "huc12"], "left_anti")
    if not strict:
        files = assets.groupBy("layer").agg(F.count("*").alias("files"))
        counts = _layers(zones).join(files, "layer", "left").fillna(0, ["files"])
        totals = counts.agg(F.max(F.when(F.col("layer") == "DEM", F.col("files"))).alias("dem")).crossJoin(zones.agg(F.count("*").alias("zones")))
        odd = counts.crossJoin(totals).filter(F.col("files") != F.when(F.col("layer") == "DEM", F.col("zones")).otherwise(F.col("dem"))).select("layer")
        gaps = gaps.join(F.broadcast(odd), "layer", "left_semi")
    return gaps.select(F.col("layer").alias("source"), F.col("huc12").alias("huc"), "cluster")


def stackable(zones: DataFrame, missing: DataFrame) -> DataFrame:
    return zones.join(missing.select(F.col("huc").alias("huc12")).distinct(), "huc12", "left_anti")


def missing_summary(missing: DataFrame) -> DataFrame:
    """Clusters with gaps per source, as a list."""
    return missing.select("source", "cluster").distinct().groupBy("source").agg(F.array_sort(F.collect_set("cluster")).alias("clusters"), F.count("*").alias("n"))


def grid_checklist(grids: DataFrame, ref: DataFrame, key: str = "huc12") -> DataFrame:
    """Does a file's grid differ from the reference in CRS, extent or resolution? Four columns name the file where
    their case holds, else "None"; what no column covers gives "Something<key>" in the first."""
    r = ref.select(key, *[F.col(x).alias(f"ref_{x}") for x in ("crs", "xoff", "res")])
    df = grids.join(r, key)
    crs, ext, res = (F.col(x) != F.col(f"ref_{x}") for x in ("crs", "xoff", "res"))
    name = F.col("path")
    odd = crs & res & ~ext
    return df.select(
        key, "path",
        F.when(odd, F.concat(F.lit("Something"), key)).when(crs & ~odd, name).otherwise("None").alias("r_list_crs_ext_res"),
        F.when(~crs & ext, name).otherwise("None").alias("r_list_ext_res"),
        F.when(~crs & ~ext & res, name).otherwise("None").alias("r_list_res"),
        F.when(~crs & ~ext & ~res, name).otherwise("None").alias("r_list"),
    )


def stack_probe(grids: DataFrame, key: str = "huc12") -> DataFrame:
    """Watersheds whose layers do not share one grid; "None" where they do."""
    per = grids.groupBy(key).agg(F.countDistinct("crs", "xoff", "res").alias("grids"))
    return per.select(key, F.when(F.col("grids") == 1, "None").otherwise(F.col(key)).alias("problem"))


def band_coverage(cells: DataFrame, group: str, bands: list[str]) -> DataFrame:
    """Values per band and watershed, flagged where they fall under |mean - sd| of the band."""
    counts = to_long(cells, [group], bands).groupBy(group, "band").agg(F.count("value").alias("n"))
    return flag_low(counts, ["band"], "n")


def small_assets(assets: DataFrame, min_mb: float) -> DataFrame:
    return assets.filter(F.col("mb") < min_mb)


def counts_match(assets: DataFrame, a: str, b: str) -> DataFrame:
    """Do two layers have as many files?"""
    n = lambda x: F.count_if(F.col("layer") == x)
    return assets.agg(n(a).alias("a"), n(b).alias("b"), (n(a) == n(b)).alias("same"))


def unmatched_ids(ids: DataFrame, zones: DataFrame) -> DataFrame:
    return ids.join(zones.select("huc12"), "huc12", "left_anti")


def layer_counts(assets: DataFrame) -> DataFrame:
    return parse_asset(assets.select("path", "layer")).groupBy("layer").agg(F.countDistinct("huc12").alias("hucs"), F.count("*").alias("files"))


def describe_cells(cells: DataFrame, band: str) -> DataFrame:
    """Cells, missing values and their share, range."""
    missing = F.count_if(F.col(band).isNull())
    return cells.agg(F.count("*").alias("cells"), missing.alias("missing"), (100.0 * missing / F.count("*")).alias("pct"), F.min(band).alias("lo"), F.max(band).alias("hi"))
