"""Column and row clean-up shared by the pipelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_like(df: DataFrame, contains: tuple[str, ...] = (), starts: tuple[str, ...] = (), ends: tuple[str, ...] = ()) -> DataFrame:
    gone = [c for c in df.columns if any(p in c for p in contains) or any(c.startswith(p) for p in starts) or any(c.endswith(p) for p in ends)]
    return df.drop(*gone)


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def prefix(df: DataFrame, p: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: p + c for c in df.columns if c not in keys})


def clean_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Infinite and NaN become null."""
    inf = float("inf")
    return df.withColumns({c: F.when(~F.isnan(c) & (F.abs(c) != inf), F.col(c)) for c in cols})


def drop_any_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna("any", subset=cols)


def drop_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna("all", subset=cols)


def only_finite(df: DataFrame, cols: list[str]) -> DataFrame:
    inf = float("inf")
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != inf) for c in cols]))


def encode_levels(df: DataFrame, col: str, levels: list[str], name: str | None = None) -> DataFrame:
    """Code of a value in a fixed list of levels, from 0; null for other values."""
    table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(levels)], f"{col} string, {name or col + '_code'} int")
    return df.join(F.broadcast(table), col, "left")  # as many rows as levels


def with_review_fields(df: DataFrame, cls: str) -> DataFrame:
    """Constant review columns in their fixed order before the class."""
    fields = {"ReviewerName": F.lit(""), "Confidence": F.lit(-999), "BoundariesAltered": F.lit(""), "Comments": F.lit("")}
    out = df.withColumns(fields)
    return out.select(*fields, cls, *[c for c in df.columns if c != cls])


def exclude_zones(zones: DataFrame, names: list[str], ids: str | None = None, complete: bool = True) -> DataFrame:
    """Zones not on the name list, whose id misses the pattern, with no missing attribute."""
    out = zones.filter(~F.col("name").isin(*names))
    out = out.filter(~F.col("huc12").rlike(ids)) if ids else out
    return out.dropna() if complete else out


def class_table(df: DataFrame, names: str, values: str) -> DataFrame:
    """Parallel arrays of names and values as lookup rows."""
    pair = F.explode(F.arrays_zip(F.col(names).alias("name"), F.col(values).alias("value")))
    return df.select(pair.alias("p")).select(F.col("p.name").alias("name"), F.col("p.value").alias("value"))


