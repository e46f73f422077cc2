"""Spatial joins: an equi-join on the squares of a grid of levels, then the exact predicate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .geometry import bbox, intersecting, points_beside, points_in
from .grid import BOX, boxes_with_boxes, meet
from .iterate import both_ways, discard, settle


def _placed(pts: DataFrame) -> DataFrame:
    return pts.select("pt_id", "h", F.col("x").alias("px"), F.col("y").alias("py"))


def st_join(pts: DataFrame, vertices: DataFrame, attrs: DataFrame, how: str = "inner") -> DataFrame:
    """Points with the attributes of the polygons they lie in; several polygons give several rows."""
    return pts.join(points_in(_placed(pts), vertices, ["pt_id"]).join(attrs, "poly_id"), "pt_id", how)


def points_inside(pts: DataFrame, vertices: DataFrame, inverse: bool = False) -> DataFrame:
    hits = points_in(_placed(pts), vertices, ["pt_id"]).select("pt_id").distinct()
    return pts.join(hits, "pt_id", "left_anti" if inverse else "left_semi")


def points_near(pts: DataFrame, vertices: DataFrame, d: float, inverse: bool = False) -> DataFrame:
    """Points in or within ``d`` of any polygon, or the others. Only points that no outline is near are looked for
    inside the polygons."""
    at = _placed(pts)
    near = settle(points_beside(at, vertices, d).select("pt_id"), "near")
    hits = near.union(points_in(at.join(near, "pt_id", "left_anti"), vertices, ["pt_id"]).select("pt_id")).distinct()
    return pts.join(hits, "pt_id", "left_anti" if inverse else "left_semi")


def box_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str, on: list[str]) -> DataFrame:
    """Pairs of boxes that overlap in more than an edge."""
    other = b.select(b_id, *on, *[F.col(k).alias(f"b_{k}") for k in BOX])
    return boxes_with_boxes(a.select(a_id, *on, *BOX), other, on).select(a_id, b_id)


def polys_meet_zones(vertices: DataFrame, zones: DataFrame, within: bool = False) -> DataFrame:
    """Pairs of polygon and rectangular zone: boxes overlap and (for ``within``) all vertices lie in the zone."""
    pairs = box_pairs(bbox(vertices), zones, "poly_id", "zone_id", [])
    if not within:
        return pairs
    box = zones.select("zone_id", "xmin", "ymin", "xmax", "ymax")
    inside = F.col("x").between(F.col("xmin"), F.col("xmax")) & F.col("y").between(F.col("ymin"), F.col("ymax"))
    met = pairs.join(box, "zone_id").join(vertices.select("poly_id", "x", "y"), "poly_id")
    return met.groupBy("poly_id", "zone_id").agg(F.every(inside).alias("all_in")).filter("all_in").select("poly_id", "zone_id")


def isolated(pts: DataFrame, d: float) -> DataFrame:
    """Points with no other point of their watershed within ``d``; both of a near pair go. Points of one place are met
    as one node. Two places in one square of side d / 1.5 are near without being compared, so only places that are
    alone in their square are met with the squares around it, of which each has few such neighbours."""
    side = d / 1.5
    placed = pts.filter("h IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    square = {"by": F.floor(F.col("y") / side), "bx": F.floor(F.col("x") / side)}
    places = settle(placed.groupBy("h", "x", "y").agg(F.count("*").alias("n")).withColumns(square), "places")
    alone = settle(places.groupBy("h", "by", "bx").agg(F.count("*").alias("k"), F.max("n").alias("n"), F.min("x").alias("x"), F.min("y").alias("y")).filter("k = 1 AND n = 1"), "alone")
    step = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3) if i or j])
    asked = alone.select("h", F.col("x").alias("x0"), F.col("y").alias("y0"), "by", "bx", F.explode(step).alias("s"))
    asked = asked.select("h", "x0", "y0", (F.col("by") + F.col("s.i")).alias("by"), (F.col("bx") + F.col("s.j")).alias("bx"))
    met = meet(places.select("h", "x", "y", "by", "bx"), asked, ["h", "by", "bx"])
    near = met.filter((F.col("x") - F.col("x0")) ** 2 + (F.col("y") - F.col("y0")) ** 2 <= d * d).select("h", F.col("x0").alias("x"), F.col("y0").alias("y")).distinct()
    stay = alone.select("h", "x", "y").join(near, ["h", "x", "y"], "left_anti")
    return pts.filter("h IS NULL OR x IS NULL OR y IS NULL").unionByName(placed.join(stay, ["h", "x", "y"], "left_semi").select(*pts.columns))


def near_pairs(pts: DataFrame, d: float) -> DataFrame:
    """Ordered pairs ``a, b`` of different points of one watershed within ``d``, met over buckets of side d."""
    p = pts.select("pt_id", "h", "x", "y").withColumns({"by": F.floor(F.col("y") / d), "bx": F.floor(F.col("x") / d)})
    step = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    q = p.select(F.col("pt_id").alias("b"), "h", F.col("x").alias("x2"), F.col("y").alias("y2"), "by", "bx", F.explode(step).alias("s"))
    q = q.select("b", "h", "x2", "y2", (F.col("by") + F.col("s.i")).alias("by"), (F.col("bx") + F.col("s.j")).alias("bx"))
    met = p.withColumnRenamed("pt_id", "a").join(q, ["h", "by", "bx"])
    return met.filter((F.col("a") != F.col("b")) & ((F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2 <= d * d)).select("a", "b")


def thin(pts: DataFrame, d: float, order: str = "pt_id") -> DataFrame:
    """Greedy thinning: in order, a point stays if no earlier kept point is within ``d``.

    Of the points of one place only the first can stay, so places are the nodes. A round takes each square of side
    16 d as one group and decides, in order, every open point whose earlier neighbours are decided or of which one
    is kept; the state is written each round. At least the first open point is decided each round, so it ends, with
    no point left open, after as many rounds as squares that a chain of neighbours crosses."""
    side = 16 * d
    first = F.min(F.struct(F.col(order).alias("o"), "pt_id")).alias("f")
    placed = F.col("h").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    nodes = pts.filter(placed).groupBy("h", "x", "y").agg(first).select("h", "x", "y", "f.o", "f.pt_id")
    nodes = settle(nodes.select("pt_id", "o", "h", "x", "y", F.floor(F.col("x") / side).alias("bx"), F.floor(F.col("y") / side).alias("by")), "nodes")
    ends = [nodes.select(F.col("pt_id").alias(k), F.col("o").alias(f"o{k}"), *(["h", "bx", "by"] if k == "b" else [])) for k in ("a", "b")]
    # an edge from the earlier point to the later one
    arcs = near_pairs(nodes, d).join(ends[0], "a").join(ends[1], "b").filter(F.struct("oa", "a") < F.struct("ob", "b"))
    arcs = settle(arcs.select("a", "b", "ob", "h", "bx", "by"), "arcs")
    met = arcs.select(F.col("b").alias("pt_id")).distinct()
    state = settle(nodes.select("pt_id").join(met.withColumn("later", F.lit(1)), "pt_id", "left").select("pt_id", F.when(F.col("later").isNull(), 1).otherwise(0).alias("kept")), "thin")
    kind = pts.schema["pt_id"].dataType.simpleString()
    while state.filter("kept = 0").limit(1).count():
        open_arcs = arcs.join(state.filter("kept = 0").select(F.col("pt_id").alias("b")), "b", "left_semi")
        told = open_arcs.join(state.select(F.col("pt_id").alias("a"), "kept"), "a")
        now = told.groupBy("h", "bx", "by").applyInPandas(_decide, f"pt_id {kind}, now int")
        new = settle(state.join(now, "pt_id", "left").select("pt_id", F.coalesce("now", "kept").alias("kept")), "thin")
        discard(state)
        state = new
    discard(nodes, arcs)
    stay = state.filter("kept = 1").select("pt_id")
    return pts.filter(~placed).unionByName(pts.filter(placed).join(stay, "pt_id", "left_semi"))


def _decide(arcs):
    """Of one square's open points ``b`` with their earlier neighbours ``a`` and these' state: ``pt_id, now`` (1 kept,
    -1 dropped) for all that can be decided."""
    import pandas as pd

    done = {}
    for (_, b), x in arcs.groupby(["ob", "b"], sort=True, dropna=False):
        states = [done.get(a, k) for a, k in zip(x["a"], x["kept"], strict=True)]
        if 1 in states:
            done[b] = -1
        elif 0 not in states:
            done[b] = 1
    return pd.DataFrame({"pt_id": list(done.keys()), "now": list(done.values())}).astype({"pt_id": arcs["b"].dtype, "now": "int32"})


def non_overlapping(boxes: DataFrame, box_id: str, on: list[str]) -> DataFrame:
    """Boxes that overlap no other; boxes of equal shape do not count as overlapping."""
    twin = boxes.withColumnRenamed(box_id, "_other")
    pairs = box_pairs(boxes, twin, box_id, "_other", on).filter(F.col(box_id) != F.col("_other"))
    shape = F.struct("xmin", "ymin", "xmax", "ymax")
    s = boxes.select(box_id, shape.alias("s1")).join(pairs, box_id).join(twin.select("_other", shape.alias("s2")), "_other").filter("s1 <> s2")
    return boxes.join(s.select(box_id).distinct(), box_id, "left_anti")


def not_crossing(boxes: DataFrame, box_id: str, zones: DataFrame) -> DataFrame:
    """Boxes that no outline of a rectangular zone passes through: a box meets an outline if it overlaps the zone
    and is not inside it."""
    z = zones.select("zone_id", *[F.col(k).alias(f"z_{k}") for k in ("xmin", "ymin", "xmax", "ymax")])
    inside = (F.col("xmin") >= F.col("z_xmin")) & (F.col("xmax") <= F.col("z_xmax")) & (F.col("ymin") >= F.col("z_ymin")) & (F.col("ymax") <= F.col("z_ymax"))
    pairs = box_pairs(boxes, zones, box_id, "zone_id", [])
    crossing = pairs.join(boxes.select(box_id, "xmin", "ymin", "xmax", "ymax"), box_id).join(z, "zone_id").filter(~inside).select(box_id).distinct()
    return boxes.join(crossing, box_id, "left_anti")


def resolve_conflicts(pts: DataFrame, wet: DataFrame, upland: DataFrame, cls: str) -> DataFrame:
    """Wet points outside delineated upland and upland points outside delineated wetland, with new ids."""
    is_up = F.col(cls) == "UPL"
    kept = points_inside(pts.filter(~is_up), upland, inverse=True).unionByName(points_inside(pts.filter(is_up), wet, inverse=True))
    return kept.withColumn("new_id", F.row_number().over(Window.partitionBy(cls).orderBy("pt_id")))


def priority_overlay(a: DataFrame, b: DataFrame, vertices: DataFrame) -> DataFrame:
    """All polygons of A, and those of B that touch none of A."""
    pairs = intersecting(vertices)
    both = both_ways(pairs).select(F.col("a").alias("x"), F.col("b").alias("y"))
    touched = both.join(a.select(F.col("poly_id").alias("y")), "y", "left_semi").select(F.col("x").alias("poly_id")).distinct()
    return a.unionByName(b.join(touched, "poly_id", "left_anti"))


def tiles_for(zones: DataFrame, tiles: DataFrame) -> DataFrame:
    return box_pairs(zones, tiles, "zone_id", "tile_id", [])


def collections_for(zones: DataFrame, tiles: DataFrame) -> DataFrame:
    return tiles_for(zones, tiles).join(tiles.select("tile_id", "collection"), "tile_id").select("zone_id", "collection").distinct()
