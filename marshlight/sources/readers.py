"""Scans: cell tables, polygons, zones, catalogues, text and CSV, with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("cluster", "huc12", "h", "r", "c", "row", "col")


def read_cells(spark: SparkSession, path: str, bands: list[str] | None = None, rename: dict[str, str] | None = None, schema: str | None = None) -> DataFrame:
    """A raster layer as cells. Only the asked bands and the keys are read."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return pick_bands(df, bands, rename)


def pick_bands(cells: DataFrame, bands: list[str] | None = None, rename: dict[str, str] | None = None) -> DataFrame:
    if bands is not None:
        cells = cells.select(*[k for k in cells.columns if k in KEYS], *bands)
    return cells.withColumnsRenamed(rename or {})


def read_window(cells: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """Cells of a rectangle; the comparisons reach the files' statistics."""
    return cells.filter(F.col("r").between(r0, r1) & F.col("c").between(c0, c1))


def read_polys(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """Features of one named layer; the layer is a partition column."""
    return spark.read.parquet(path).filter(F.col("layer") == layer)


def zones(df: DataFrame, huc: str | None = None, clusters: list[int] | None = None) -> DataFrame:
    if huc is not None:
        df = df.filter(F.col("huc12") == huc)
    return df.filter(F.col("cluster").isin(*clusters)) if clusters is not None else df


def in_bbox(polys: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Features whose box meets a box."""
    return polys.filter((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def union_layers(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_csvs(spark: SparkSession, paths: list[str], schema: str, key: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(paths).filter(F.col(key).isNotNull())


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return ids_of(spark.read.text(path))


def ids_of(lines: DataFrame) -> DataFrame:
    return lines.select(F.trim("value").alias("id")).filter(F.col("id") != "")


def footprints(cells: DataFrame, tile: list[str]) -> DataFrame:
    """Extent of each tile as a closed ring and its box."""
    box = cells.groupBy(*tile).agg(F.min("c").cast("double").alias("xmin"), F.min("r").cast("double").alias("ymin"), (F.max("c") + 1.0).alias("xmax"), (F.max("r") + 1.0).alias("ymax"))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"), corner("xmin", "ymin"))
    return box.withColumn("ring", ring)


def clean_index(idx: DataFrame, min_area: float, names: tuple[str, ...], area: str = "area", keep_equal: bool = False) -> DataFrame:
    """Coalesce renamed collection fields; drop tiles that are small or without shape."""
    big: Column = F.col(area) >= min_area if keep_equal else F.col(area) > min_area
    return idx.withColumn("collection", F.coalesce(*names)).filter(big)


def non_empty_tiles(cells: DataFrame, tile: list[str], band: str) -> DataFrame:
    """Cells of tiles that hold any value."""
    live = cells.groupBy(*tile).agg(F.count(band).alias("_n")).filter("_n > 0").select(*tile)
    return cells.join(live, tile, "left_semi")
