"""Keys and tags in asset names, and string clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import first_match


def base_name(col: Column) -> Column:
    return F.substring_index(col, "/", -1)


def base_noext(col: Column) -> Column:
    return F.regexp_replace(base_name(col), r"\.[^.]*$", "")


def parse_asset(df: DataFrame, path: str = "path") -> DataFrame:
    """Add ``cluster int``, ``huc12`` (twelve digits) and ``source`` (what precedes the first underscore)."""
    p = F.col(path)
    return df.withColumns({
        "cluster": F.expr(f"try_cast(regexp_extract({path}, 'cluster_([0-9]+)_', 1) AS int)"),
        "huc12": F.regexp_extract(p, r"huc_([0-9]{12})", 1),
        "source": F.regexp_extract(base_name(p), r"^([^_]+)_", 1),
    })


def catalog(paths: DataFrame, pattern: str, layer: str) -> DataFrame:
    """Paths that match a pattern, tagged with a layer."""
    return paths.filter(F.col("path").rlike(pattern)).withColumn("layer", F.lit(layer))


# fixed values: which file names make up a layer
LAYER_RULES = {"DEM": (r"DEM", r"hydro|Hydro"), "Terrain": (r"Terrain.*", r"10m|1000m"), "CHM": (r"CHM", None)}


def select_layer(assets: DataFrame, layer: str, cluster: int) -> DataFrame:
    """A layer's files of one cluster: those its pattern keeps and its exclusion does not drop."""
    keep, drop = LAYER_RULES[layer]
    name = base_name(F.col("path"))
    out = assets.filter(F.col("path").contains(f"cluster_{cluster}_") & name.rlike(keep))
    return out.filter(~name.rlike(drop)) if drop else out


def source_tag(col: Column) -> Column:
    """Inventory a file comes from, else what precedes the first underscore."""
    known = ["NWI", "NHP", "Laba", "ADK_WCT", "ADK_regulated"]  # fixed values
    return first_match([(col.contains(k), k) for k in known], F.regexp_extract(col, r"^([^_]+)", 1))


def clean_name(col: Column) -> Column:
    """Letters, digits and underscores only; runs of anything else become one underscore."""
    return F.regexp_replace(F.trim(col), r"[^A-Za-z0-9]+", "_")


def swap_prefix(col: Column, old: str, new: str) -> Column:
    return F.when(col.startswith(old), F.concat(F.lit(new), F.substring(col, F.lit(len(old) + 1), F.length(col)))).otherwise(col)


def split_entry(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """``"3, name"`` as ``number int`` and ``label string``."""
    parts = F.split(F.col(col), sep, 2)
    return df.withColumns({"number": F.try_element_at(parts, F.lit(1)).try_cast("int"), "label": F.trim(F.try_element_at(parts, F.lit(2)))})


def clean_sites(df: DataFrame, latlon: str) -> DataFrame:
    """Spaces in column names become underscores; "lat, lon" is split and cast; rows with neither are dropped."""
    df = df.toDF(*[c.replace(" ", "_") for c in df.columns])
    parts = F.split(F.col(latlon.replace(" ", "_")), ",")
    df = df.withColumns({"lat": F.trim(F.try_element_at(parts, F.lit(1))).try_cast("double"), "lon": F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")})
    return df.filter(F.col("lat").isNotNull() | F.col("lon").isNotNull())


def match_files(index: DataFrame, col: str, assets: DataFrame) -> DataFrame:
    """Index rows whose base name is among the assets' base names."""
    have = assets.select(base_name(F.col("path")).alias("_name")).distinct()
    return index.join(have, base_name(F.col(col)) == F.col("_name"), "left_semi")


def with_row_id(df: DataFrame, prefix: str, order: list[str], name: str = "row_id") -> DataFrame:
    """An id of a column's value and the row's number within that value, in a stated order."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(prefix).orderBy(*order))
    return df.withColumn(name, F.concat(F.col(prefix), F.lit("_"), n.cast("string")))
