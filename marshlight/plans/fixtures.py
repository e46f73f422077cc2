"""Deterministic stand-ins for the rasters, polygons, point clouds and catalogues that the operators work on.

The text of each view runs unchanged in Spark SQL and in the oracle, so both sides read the same rows. Watersheds are
64 x 64 cells; their number grows with the tables (four for 2,000 parts or 1,500 customers), the crowd in each does not.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "fx_cells": """
SELECT l_suppkey % 4 + 4 * CAST(floor(l_partkey / 2000) AS BIGINT) AS h, l_orderkey % 64 AS r, l_partkey % 64 AS c,
       300.0E0 - 2 * (l_orderkey % 64) - 0.5E0 * (l_partkey % 64) + MAX(l_quantity) / 16 AS dem,
       CASE WHEN COUNT(*) >= 2 THEN (SUM(l_linenumber) % 2) / 2.0E0 + (l_orderkey % 64) / 8 END AS chm,
       CAST(SUM(l_partkey) % 200 + 1 AS DOUBLE) AS red,
       CAST(SUM(l_orderkey) % 200 + 1 AS DOUBLE) AS green,
       CAST(SUM(l_suppkey) % 200 + 1 AS DOUBLE) AS blue,
       CAST(SUM(l_linenumber * 7) % 200 + 1 AS DOUBLE) AS nir
FROM lineitem
GROUP BY l_suppkey % 4 + 4 * CAST(floor(l_partkey / 2000) AS BIGINT), l_orderkey % 64, l_partkey % 64
""",
    "fx_tiles": """
SELECT l_suppkey % 4 + 4 * CAST(floor(l_partkey / 2000) AS BIGINT) AS h, l_linenumber AS tile_ord, l_orderkey % 64 AS r, l_partkey % 64 AS c,
       MAX(l_quantity) AS v
FROM lineitem
GROUP BY l_suppkey % 4 + 4 * CAST(floor(l_partkey / 2000) AS BIGINT), l_linenumber, l_orderkey % 64, l_partkey % 64
""",
    "fx_poly_attr": """
SELECT p_partkey AS poly_id, p_partkey % 4 + 4 * CAST(floor(p_partkey / 2000) AS BIGINT) AS h,
       (p_partkey * 37) % 56 + 4.25E0 AS cx, (p_partkey * 53) % 56 + 4.25E0 AS cy,
       CAST(1 + p_size % 4 AS DOUBLE) AS rad,
       CASE p_partkey % 9 WHEN 0 THEN 'PFO1E' WHEN 1 THEN 'PSS1E' WHEN 2 THEN 'PEM1C'
            WHEN 3 THEN 'PFO1/SS1E' WHEN 4 THEN 'PSS1/EM1E' WHEN 5 THEN 'PUBHh'
            WHEN 6 THEN 'L1UBH' WHEN 7 THEN 'R2UBH' END AS attribute,
       CASE p_partkey % 5 WHEN 0 THEN 'Palustrine-FO' WHEN 1 THEN 'Palustrine-SS'
            WHEN 2 THEN 'Palustrine-EM' WHEN 3 THEN 'Lacustrine' ELSE 'Terrestrial' END AS cowardin
FROM part
""",
    "fx_vertices": """
SELECT a.poly_id, a.h, t.seq, a.cx + a.rad * t.dx AS x, a.cy + a.rad * t.dy AS y
FROM fx_poly_attr a CROSS JOIN (VALUES
  (0, 1.0E0, 0.0E0), (1, 0.5E0, 1.0E0), (2, 0.0E0, 0.25E0), (3, -0.5E0, 1.0E0), (4, -1.0E0, 0.0E0),
  (5, -0.5E0, -1.0E0), (6, 0.5E0, -1.0E0), (7, 1.0E0, 0.0E0)) AS t(seq, dx, dy)
""",
    "fx_points": """
SELECT c_custkey AS pt_id, c_custkey % 4 + 4 * CAST(floor(c_custkey / 1500) AS BIGINT) AS h,
       ((c_custkey * 211) % 640) / 10.0E0 + 0.03125E0 AS x, ((c_custkey * 307) % 640) / 10.0E0 + 0.03125E0 AS y,
       CASE c_custkey % 5 WHEN 0 THEN 'EMW' WHEN 1 THEN 'FSW' WHEN 2 THEN 'SSW' WHEN 3 THEN 'OWW' ELSE 'UPL' END AS mod_class,
       c_mktsegment AS segment, c_acctbal AS bal
FROM customer
""",
    "fx_zones": """
SELECT n_nationkey AS zone_id, n_name AS name, n_regionkey AS cluster,
       concat('0414', lpad(CAST(n_nationkey AS STRING), 8, '0')) AS huc12,
       (n_nationkey % 5) * 12.75E0 AS xmin, (n_nationkey % 5) * 12.75E0 + 12.75E0 AS xmax,
       floor(n_nationkey / 5) * 12.75E0 AS ymin, floor(n_nationkey / 5) * 12.75E0 + 12.75E0 AS ymax
FROM nation
""",
    "fx_obs": """
SELECT event_id % 97 AS scene_id, ts, user_id % 16 AS r, event_id % 16 AS c,
       CAST(event_id * 7 % 41 AS DOUBLE) AS cloud_pct,
       CASE WHEN event_type = 'error' THEN 'EW' ELSE 'IW' END AS mode,
       CASE WHEN event_id % 3 = 0 THEN 'VV' ELSE 'VV,VH' END AS pols,
       CASE event_id % 7 WHEN 0 THEN 1024 WHEN 1 THEN 2048 WHEN 2 THEN 1 ELSE 0 END AS qa60,
       event_id % 12 AS scl,
       event_id * 31 % 3000 + 100 AS b2, event_id * 37 % 3000 + 100 AS b3, event_id * 41 % 3000 + 100 AS b4,
       event_id * 43 % 3000 + 100 AS b6, event_id * 47 % 5000 + 100 AS b8, event_id * 53 % 3000 + 100 AS b11,
       -(event_id % 20) - 1 AS vv, -(event_id % 25) - 6 AS vh
FROM events
""",
    "fx_returns": """
SELECT l_suppkey % 4 + 4 * CAST(floor(l_partkey / 2000) AS BIGINT) AS h, l_orderkey % 64 + l_discount * 8 AS x, l_partkey % 64 + l_tax * 8 AS y,
       l_quantity - 4 AS z,
       CASE l_linenumber WHEN 1 THEN 2 WHEN 6 THEN 7 WHEN 7 THEN 18 ELSE 5 END AS cls,
       (l_returnflag = 'R' AND l_linestatus = 'O') AS withheld, l_linenumber AS ret_no
FROM lineitem
""",
    "fx_assets": """
SELECT concat('Data/', layer, '/cluster_', CAST(n_regionkey AS STRING), '_huc_0414',
              lpad(CAST(n_nationkey AS STRING), 8, '0'), '_', layer, '.tif') AS path,
       layer, (n_nationkey * 7 + ord * 13) % 400 AS mb,
       CASE WHEN (n_nationkey + ord) % 11 = 0 THEN 'EPSG:4326' ELSE 'EPSG:6347' END AS crs,
       CASE WHEN (n_nationkey + ord) % 7 = 0 THEN 1 ELSE 0 END AS xoff,
       CASE WHEN (n_nationkey + ord) % 5 = 0 THEN 10 ELSE 1 END AS res
FROM nation CROSS JOIN (VALUES (0,'DEM'),(1,'NAIP'),(2,'Satellite'),(3,'Hydro'),(4,'Lidar'),(5,'CHM'),
  (6,'TerrainSlp'),(7,'TerrainCurv'),(8,'TerrainDMV')) AS t(ord, layer)
WHERE (n_nationkey * 5 + ord * 3) % 17 <> 0
""",
    "fx_names": """
SELECT DISTINCT c_name AS candidate FROM customer
""",
    "fx_train": """
SELECT p.pt_id, p.mod_class, CASE WHEN p.mod_class = 'UPL' THEN 'UPL' ELSE 'WET' END AS coarse_class,
       k.dem, k.chm, k.red, k.green, k.blue, k.nir
FROM fx_points p JOIN fx_cells k
  ON p.h = k.h AND k.r = CAST(floor(p.y) AS BIGINT) AND k.c = CAST(floor(p.x) AS BIGINT)
""",
}


def _needs(sql: str) -> list[str]:
    """The fixture views that a text reads, in an order in which each can be defined."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            for x in [*_needs(VIEWS[name]), name]:
                if x not in found:
                    found.append(x)
    return found


def oracle(sql: str) -> str:
    """The text with the views it reads put before it."""
    heads = [f"{n} AS ({VIEWS[n].strip()})" for n in _needs(sql)]
    if not heads:
        return sql
    body = sql.strip()
    recursive = re.match(r"WITH\s+RECURSIVE\s+", body, re.I)
    if recursive:
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[recursive.end() :]
    if re.match(r"WITH\s+", body, re.I):
        return "WITH " + ",\n".join(heads) + ",\n" + re.sub(r"^WITH\s+", "", body, flags=re.I)
    return "WITH " + ",\n".join(heads) + "\n" + body


class Fixtures:
    """Tables of a folder and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a text that names base tables and views."""
        text = oracle(text)
        used = [n for n in BASE if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", text)]
        for n in used:
            text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **{n: self.table(n) for n in used})

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    cells = cached_property(lambda self: self.view("fx_cells"))
    tiles = cached_property(lambda self: self.view("fx_tiles"))
    polys = cached_property(lambda self: self.view("fx_poly_attr"))
    vertices = cached_property(lambda self: self.view("fx_vertices"))
    points = cached_property(lambda self: self.view("fx_points"))
    zones = cached_property(lambda self: self.view("fx_zones"))
    obs = cached_property(lambda self: self.view("fx_obs"))
    returns = cached_property(lambda self: self.view("fx_returns"))
    assets = cached_property(lambda self: self.view("fx_assets"))
    names = cached_property(lambda self: self.view("fx_names"))
    train = cached_property(lambda self: self.view("fx_train"))
