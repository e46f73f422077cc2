"""Sinks: partitioned Parquet, CSV, JSON and text, and what is still to be written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def morton(r: Column, c: Column, bits: int = 31) -> Column:
    """Bits of row and column in turn, so that neighbours in both get near numbers. Rows and columns may be negative."""
    out = F.lit(0).cast("long")
    for k in range(bits):
        for at, v in ((2 * k + 1, r), (2 * k, c)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(v.cast("long") + (1 << (bits - 1)), k).bitwiseAND(F.lit(1).cast("long")), at))
    return out


def write_cells(df: DataFrame, root: str, keys: tuple[str, ...] = ("cluster", "huc12"), mode: str = "overwrite") -> None:
    """One folder per watershed; a rewrite replaces only the folders it writes, and one that fails leaves all as it was.

    Cells are dealt out by ranges of watershed and Morton number: a large watershed becomes several files, each about a
    square, and a window reads the files and row groups whose least and largest row and column it meets."""
    if {"r", "c"} <= set(df.columns):
        dealt = df.withColumn("_m", morton(F.col("r"), F.col("c")))
        dealt = dealt.repartitionByRange(*keys, "_m").sortWithinPartitions(*keys, "_m").drop("_m")
    else:
        dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root)


def write_polys(df: DataFrame, root: str, keys: tuple[str, ...] = ("huc12",)) -> None:
    write_cells(df, root, keys)


def pending(todo: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """What the manifest does not list yet."""
    return todo.join(manifest, keys, "left_anti")


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_new(log: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    return log.unionByName(new.join(log, key, "left_anti"))


def stats_json(df: DataFrame) -> DataFrame:
    """One JSON object per band: ``{"band":..., "min":..., "max":...}``."""
    return df.select("band", F.to_json(F.struct("band", "min", "max")).alias("json"))


def write_stats_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def replace_partition(spark: SparkSession, df: DataFrame, root: str, keys: tuple[str, ...], staging: str) -> None:
    """Rewrite some watersheds of a table that ``df`` itself may read: written aside first, then put in place. If either
    step fails the table stays as it was; the folder aside is deleted once the new folders are in place."""
    df.write.mode("overwrite").parquet(staging)
    write_cells(spark.read.schema(df.schema).parquet(staging), root, keys)
    at = spark._jvm.org.apache.hadoop.fs.Path(staging)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
