"""Set-based geometry over vertex and edge tables; overlay results are sets of cells.

Vertices: ``poly_id, h, seq, x, y`` with closed rings. Cell (r, c) of a watershed h has its centre at (c + .5, r + .5).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grid import base_of, boxes_with_boxes, points_in_boxes
from .iterate import settle
from .rings import pairs_of_rings, small_rings


def edges(vertices: DataFrame, most: int = 50_000) -> DataFrame:
    """Edges of each ring, in partitions of about ``most``: what edges send (crossings, cells, points) is many times
    their bytes, so partitions of vertices must not be merged by their bytes before it is made."""
    parts = -(-vertices.count() // most)
    vertices = vertices.repartition(parts, "poly_id") if parts > 1 else vertices
    line = Window.partitionBy("poly_id").orderBy("seq")
    out = vertices.select("poly_id", "h", "seq", F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(line).alias("x2"), F.lead("y").over(line).alias("y2"))
    return out.filter("x2 IS NOT NULL")


def bbox(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("poly_id", "h").agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))


def area(vertices: DataFrame) -> DataFrame:
    twice = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1"))
    return edges(vertices).groupBy("poly_id").agg((F.abs(twice) / 2).alias("area"))


def centroid(vertices: DataFrame) -> DataFrame:
    """Area-weighted centre of each ring."""
    k = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    out = edges(vertices).groupBy("poly_id", "h").agg(F.sum(k).alias("k"), F.sum((F.col("x1") + F.col("x2")) * k).alias("sx"), F.sum((F.col("y1") + F.col("y2")) * k).alias("sy"))
    return out.select("poly_id", "h", F.try_divide("sx", 3 * F.col("k")).alias("x"), F.try_divide("sy", 3 * F.col("k")).alias("y"))


def _side(ax, ay, bx, by, px, py) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def crossing() -> Column:
    """Do the edges x1..y2 and b_x1..b_y2 cross inside both?"""
    e, f = ({k: F.col(f"{p}{k}") for k in ("x1", "y1", "x2", "y2")} for p in ("", "b_"))
    one = _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x1"], f["y1"]) * _side(e["x1"], e["y1"], e["x2"], e["y2"], f["x2"], f["y2"])
    two = _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x1"], e["y1"]) * _side(f["x1"], f["y1"], f["x2"], f["y2"], e["x2"], e["y2"])
    return (one < 0) & (two < 0)


def _boxed(segs: DataFrame) -> DataFrame:
    low, high = (lambda k: F.least(f"{k}1", f"{k}2")), (lambda k: F.greatest(f"{k}1", f"{k}2"))
    return segs.withColumns({"xmin": low("x"), "ymin": low("y"), "xmax": high("x"), "ymax": high("y")})


def edge_pairs(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of edges with equal ``on`` whose boxes touch; the second edge's columns begin with ``b_``. Edges of about
    one length share a level."""
    other = _boxed(b)
    other = other.select(*on, *[F.col(c).alias(f"b_{c}") for c in other.columns if c not in on])
    return boxes_with_boxes(_boxed(a), other, on, closed=True, base=base_of(_boxed(a)))


def valid(vertices: DataFrame) -> DataFrame:
    """Ids of rings that are closed, have four vertices at least and an area, and do not cross themselves."""
    shape = vertices.groupBy("poly_id").agg(F.count("*").alias("n"), F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b"))
    good = shape.filter((F.col("n") >= 4) & (F.col("a") == F.col("b"))).select("poly_id")
    e = edges(vertices)
    crossed = edge_pairs(e, e, ["poly_id"]).filter((F.col("seq") < F.col("b_seq")) & crossing()).select("poly_id").distinct()
    return good.join(area(vertices).filter("area > 0").select("poly_id"), "poly_id", "left_semi").join(crossed, "poly_id", "left_anti")


def is_empty(polys: DataFrame, vertices: DataFrame) -> DataFrame:
    return polys.join(vertices.select("poly_id").distinct(), "poly_id", "left_anti")


def sample_line(segs: DataFrame, spacing: float) -> DataFrame:
    """Points every ``spacing`` along each ring, from its start."""
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    line = Window.partitionBy("poly_id").orderBy("seq")
    df = segs.withColumn("len", length).withColumn("end", F.sum("len").over(line)).withColumn("begin", F.col("end") - F.col("len"))
    first, last = F.ceil(F.col("begin") / spacing), F.ceil(F.col("end") / spacing) - 1
    df = df.filter((last >= first) & (F.col("len") > 0)).withColumn("k", F.explode(F.sequence(first, last)))
    t = (F.col("k") * spacing - F.col("begin")) / F.col("len")
    return df.select("poly_id", "h", "k", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"))


def square(pts: DataFrame, r: float) -> DataFrame:
    """Box of half-side r around each point."""
    return pts.withColumns({"xmin": F.col("x") - r, "ymin": F.col("y") - r, "xmax": F.col("x") + r, "ymax": F.col("y") + r})


def crosses_ray(px: Column, py: Column) -> Column:
    """Half-open crossing rule of an edge against the ray to the right of a point."""
    at = F.try_divide((F.col("x2") - F.col("x1")) * (py - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")
    return ((F.col("y1") > py) != (F.col("y2") > py)) & (px < at)


def edge_distance(px: Column, py: Column) -> Column:
    """Distance of a point to an edge."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.coalesce(F.try_divide((px - F.col("x1")) * dx + (py - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.sqrt((px - F.col("x1") - t * dx) ** 2 + (py - F.col("y1") - t * dy) ** 2)


def crossings(vertices: DataFrame, step: float = 1.0, at: float = 0.5) -> DataFrame:
    """``poly_id, h, j, x``: where each edge crosses the scan lines y = (j + at) * step, by the half-open rule."""
    e = edges(vertices)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    line = e.withColumn("j", F.explode(F.sequence(F.floor(low / step - at), F.ceil(high / step - at))))
    py = (F.col("j") + at) * step
    met = line.filter((F.col("y1") > py) != (F.col("y2") > py))
    return met.select("poly_id", "h", "j", (F.try_divide((F.col("x2") - F.col("x1")) * (py - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1")).alias("x"))


def spans(vertices: DataFrame, step: float = 1.0, at: float = 0.5) -> DataFrame:
    """``poly_id, h, j, x0, x1``: the parts of each scan line inside each polygon. A line's crossings are paired in
    order, so a point of the line is inside if x0 <= x < x1 for one of its spans."""
    line = Window.partitionBy("poly_id", "h", "j").orderBy("x")
    met = crossings(vertices, step, at).withColumns({"n": F.row_number().over(line), "x1": F.lead("x").over(line)})
    return met.filter("n % 2 = 1 AND x < x1").select("poly_id", "h", "j", F.col("x").alias("x0"), "x1")


def _steps(step: float, at: float) -> Column:
    """The numbers i of the places (i + at) * step from x0 up to x1, some beyond the ends: to be filtered."""
    return F.explode(F.sequence(F.floor(F.col("x0") / step - at), F.ceil(F.col("x1") / step - at)))


def places(vertices: DataFrame, step: float = 1.0, at: float = 0.5) -> DataFrame:
    """``poly_id, h, j, i``: places ((i + at) * step, (j + at) * step) inside each polygon."""
    x = (F.col("i") + at) * step
    return spans(vertices, step, at).withColumn("i", _steps(step, at)).filter((x >= F.col("x0")) & (x < F.col("x1"))).select("poly_id", "h", "j", "i")


def cell_set(vertices: DataFrame) -> DataFrame:
    """Cells whose centre is inside: ``poly_id, h, r, c``, from the spans of the rows' centre lines."""
    return places(vertices).select("poly_id", "h", F.col("j").alias("r"), F.col("i").alias("c"))


def _band(vertices: DataFrame, reach: Column, least: Column, most: Column, side: float = 1.0, spare: int = 1) -> DataFrame:
    """Edges once for each square (row ``r``, column ``c``, of side ``side``) that the edge can come within ``reach`` of;
    the columns of a row follow the part of the edge that lies near it. ``least`` and ``most`` bound a row's own y.
    ``spare`` rows and columns are added on each side."""
    e = edges(vertices).withColumn("_m", reach)
    low, high, m = F.least("y1", "y2"), F.greatest("y1", "y2"), F.col("_m")
    e = e.withColumn("r", F.explode(F.sequence(F.floor((low - m) / side) - spare, F.floor((high + m) / side) + spare)))
    dy = F.col("y2") - F.col("y1")
    at = lambda y: F.coalesce(F.try_divide((F.col("x2") - F.col("x1")) * (F.greatest(low, F.least(high, y)) - F.col("y1")), dy) + F.col("x1"), F.col("x1"))
    a, b = at(least - m), at(most + m)
    flat = dy == 0
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(a, b))
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(a, b))
    return e.withColumn("c", F.explode(F.sequence(F.floor((left - m) / side) - spare, F.floor((right + m) / side) + spare)))


def outline_cells(vertices: DataFrame, reach: Column | float) -> DataFrame:
    """``poly_id, h, r, c, dist``: cells whose centre is within ``reach`` of the outline, and how far it is. Each edge
    sends only the cells near it."""
    reach = F.lit(float(reach)) if not isinstance(reach, Column) else reach
    px, py = F.col("c") + 0.5, F.col("r") + 0.5
    near = _band(vertices, reach, F.col("r") + 0.5, F.col("r") + 0.5).withColumn("dist", edge_distance(px, py)).filter(F.col("dist") <= F.col("_m"))
    return near.groupBy("poly_id", "h", "r", "c").agg(F.min("dist").alias("dist"))


def cut_cells(vertices: DataFrame) -> DataFrame:
    """``poly_id, h, r, c``: cells (closed squares) that an edge runs through or touches."""
    met = _band(vertices, F.lit(0.0), F.col("r"), F.col("r") + 1)
    x, y = F.col("c").cast("double"), F.col("r").cast("double")
    # Liang-Barsky clipping of the edge by the cell
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    lo, hi, ok = F.lit(0.0), F.lit(1.0), F.lit(True)
    for p, q in ((-dx, F.col("x1") - x), (dx, x + 1 - F.col("x1")), (-dy, F.col("y1") - y), (dy, y + 1 - F.col("y1"))):
        t = F.try_divide(q, p)
        ok = ok & ~((p == 0) & (q < 0))
        lo = F.when(p < 0, F.greatest(lo, t)).otherwise(lo)
        hi = F.when(p > 0, F.least(hi, t)).otherwise(hi)
    return met.filter(ok & (lo <= hi)).select("poly_id", "h", "r", "c").distinct()


def points_in(pts: DataFrame, vertices: DataFrame, keys: list[str], e: DataFrame | None = None) -> DataFrame:
    """``keys, poly_id`` for points (``h, px, py``) inside each polygon. A point meets the polygons whose box holds
    it, and of those only the edges that cross its own row of unit height (``e``, if they are at hand)."""
    met = points_in_boxes(pts.select(*keys, "h", "px", "py"), "px", "py", bbox(vertices), ["h"]).select(*keys, "poly_id", "px", "py", F.floor("py").alias("_row"))
    e = (edges(vertices) if e is None else e).select("poly_id", "x1", "y1", "x2", "y2").filter("y1 <> y2")
    slabs = e.withColumn("_row", F.explode(F.sequence(F.floor(F.least("y1", "y2")), F.floor(F.greatest("y1", "y2")))))
    hits = met.join(slabs, ["poly_id", "_row"]).filter(crosses_ray(F.col("px"), F.col("py")))
    return hits.groupBy(*keys, "poly_id").agg(F.count("*").alias("_n")).filter("_n % 2 = 1").select(*keys, "poly_id")


def _near_edges(vertices: DataFrame, reach: float, side: float) -> DataFrame:
    """Edges once for each square of that side that they can come within ``reach`` of."""
    far = reach + side * 1e-3 + 1e-12 * F.greatest(*[F.abs(k) for k in ("x1", "y1", "x2", "y2")])  # more, for rounding
    e = _band(vertices, far, F.col("r") * side, (F.col("r") + 1) * side, side, 0)
    rounded = edge_distance((F.col("c") + 0.5) * side, (F.col("r") + 0.5) * side) <= F.col("_m") + 0.7072 * side
    return e.filter(rounded).select("poly_id", "h", "r", "c", "x1", "y1", "x2", "y2")


def points_close(pts: DataFrame, vertices: DataFrame, reach: float, keys: list[str]) -> DataFrame:
    """``keys, poly_id, dist`` for points (``h, px, py``) within ``reach`` of a polygon's outline, met over squares of
    that side to which each edge sends itself."""
    side = max(float(reach), 2.0**-20)
    at = pts.select(*keys, "h", "px", "py", F.floor(F.col("py") / side).alias("r"), F.floor(F.col("px") / side).alias("c"))
    met = at.join(_near_edges(vertices, reach, side), ["h", "r", "c"]).withColumn("dist", edge_distance(F.col("px"), F.col("py"))).filter(F.col("dist") <= reach)
    return met.groupBy(*keys, "poly_id").agg(F.min("dist").alias("dist"))


def points_beside(pts: DataFrame, vertices: DataFrame, reach: float) -> DataFrame:
    """Points (``h, px, py``) within ``reach`` of any outline. A point has one square of side 4 ``reach`` and is done at
    the first edge there that is near, so no row stands for a pair."""
    side = max(4 * float(reach), 2.0**-20)
    at = pts.withColumns({"r": F.floor(F.col("py") / side), "c": F.floor(F.col("px") / side)})
    met = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("h", "r", "c")]
    near = _near_edges(vertices, reach, side).drop("poly_id")
    return at.alias("a").join(near.alias("b"), [*met, edge_distance(F.col("px"), F.col("py")) <= reach], "left_semi").drop("r", "c")


def ring_cells(vertices: DataFrame, distances: list[float]) -> DataFrame:
    """Cells outside each polygon within each distance of it, one row per (polygon, ring)."""
    near = outline_cells(vertices, max(distances)).join(cell_set(vertices), ["poly_id", "h", "r", "c"], "left_anti")
    return near.select("poly_id", "h", "r", "c", "dist", F.explode(F.array(*[F.lit(float(d)) for d in distances])).alias("ring")).filter("dist <= ring").select("poly_id", "ring", "h", "r", "c")


def interior(vertices: DataFrame, depth: Column | float) -> DataFrame:
    """Cells inside and at least ``depth`` from the outline (a number or a column of ``poly_id`` and ``h``)."""
    depth = F.lit(float(depth)) if not isinstance(depth, Column) else depth
    shallow = outline_cells(vertices, depth).filter(F.col("dist") < depth)
    return cell_set(vertices).join(shallow, ["poly_id", "h", "r", "c"], "left_anti")


def box_cells(boxes: DataFrame, cells: DataFrame, box_id: str, on: list[str] = ("h",)) -> DataFrame:
    """Cells whose centre lies in each half-open box with the same ``on``."""
    at = cells.withColumns({"_x": F.col("c") + 0.5, "_y": F.col("r") + 0.5})
    met = points_in_boxes(at, "_x", "_y", boxes.select(box_id, *on, "xmin", "ymin", "xmax", "ymax"), list(on))
    return met.filter((F.col("_x") < F.col("xmax")) & (F.col("_y") < F.col("ymax"))).drop("_x", "_y", "xmin", "ymin", "xmax", "ymax")


def clip_box(vertices: DataFrame, boxes: DataFrame, box_id: str) -> DataFrame:
    """Labelled cells of each polygon in each box."""
    return box_cells(boxes, cell_set(vertices), box_id)


def overlay(a: DataFrame, b: DataFrame, a_id: str, b_id: str) -> DataFrame:
    """Area, in cells, of each pair of two cell sets' members that share cells."""
    return a.select(a_id, "h", "r", "c").join(b.select(b_id, "h", "r", "c"), ["h", "r", "c"]).groupBy(a_id, b_id).agg(F.count("*").alias("area"))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.select("h", "r", "c").distinct(), ["h", "r", "c"], "left_anti")


def dissolve(cells: DataFrame, by: list[str]) -> DataFrame:
    return cells.select(*by, "h", "r", "c").distinct()


def intersecting(vertices: DataFrame, joining: bool = False) -> DataFrame:
    """Pairs ``a < b`` of polygons of one watershed that intersect: outlines cross, or one holds a vertex of the
    other. Rings of few vertices meet whole; where one has many, edges meet edges whose boxes touch, and vertices the
    polygons whose box holds them. With ``joining`` pairs may be left out that connect what others connect."""
    kinds = settle(small_rings(vertices), "kinds")
    small, large = kinds.filter("small").select("poly_id"), kinds.filter("NOT small OR small IS NULL").select("poly_id")
    if not large.limit(1).count():
        return pairs_of_rings(vertices, joining)
    pairs = pairs_of_rings(vertices.join(small, "poly_id", "left_semi"), joining)
    e = settle(edges(vertices).select("poly_id", "h", "x1", "y1", "x2", "y2"), "edges")
    big, e_big = vertices.join(large, "poly_id", "left_semi"), e.join(large, "poly_id", "left_semi")
    crossed = edge_pairs(e_big, e, ["h"]).filter((F.col("poly_id") != F.col("b_poly_id")) & crossing()).select(F.col("poly_id").alias("a"), F.col("b_poly_id").alias("b"))
    v = lambda x: x.select(F.col("poly_id").alias("v_id"), "seq", "h", F.col("x").alias("px"), F.col("y").alias("py"))
    held = points_in(v(vertices), big, ["v_id", "seq"], e_big).union(points_in(v(big), vertices, ["v_id", "seq"], e)).filter("v_id <> poly_id")
    met = crossed.union(held.select(F.col("v_id").alias("a"), F.col("poly_id").alias("b")))
    return pairs.union(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def hash_order(key: Column, k: int = 0) -> Column:
    """Order that does not depend on partitions: (key * 2654435761 + k * 40503) mod 1000003, with the sign of what is
    divided. The key is reduced first, so no product leaves a long, however large the key (``k`` from 0)."""
    by, p = 2654435761, 1000003
    rest = F.pmod(key % p * F.lit(by) + F.lit(k * 40503), F.lit(p))
    return F.when((key < -(k * 40503 // by)) & (rest > 0), rest - p).otherwise(rest)


def random_points(vertices: DataFrame, n: int, seed: int = 0, lines: int = 64) -> DataFrame:
    """``n`` points in each polygon of positive area, however thin: ``k`` from 0, x and y.

    ``lines`` scan lines cut the polygon into spans; laid end to end they are cut into n equal stretches, of which each
    gives one hash-drawn point. A stretch finds its spans by the spans' running length, so nothing is drawn in vain."""
    own, ordered = Window.partitionBy("poly_id"), Window.partitionBy("poly_id").orderBy("j", "x0")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    e = edges(vertices).withColumns({"_lo": F.min(low).over(own), "_hi": F.max(high).over(own)}).filter("_hi > _lo")
    step = (F.col("_hi") - F.col("_lo")) / lines
    line = e.withColumn("j", F.explode(F.sequence(F.floor((low - F.col("_lo")) / step - 0.5), F.ceil((high - F.col("_lo")) / step - 0.5)))).filter(F.col("j").between(0, lines - 1))
    py = F.col("_lo") + (F.col("j") + 0.5) * step
    met = line.withColumn("y", py).filter((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y")))
    met = met.withColumn("x0", F.try_divide((F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1"))
    pairs = Window.partitionBy("poly_id", "j").orderBy("x0")
    cut = met.select("poly_id", "h", "j", "y", "x0", F.row_number().over(pairs).alias("n"), F.lead("x0").over(pairs).alias("x1")).filter("n % 2 = 1 AND x0 < x1")
    cut = cut.withColumn("len", F.col("x1") - F.col("x0")).withColumns({"end": F.sum("len").over(ordered), "all": F.sum("len").over(own)})
    begin = F.col("end") - F.col("len")
    drawn = cut.withColumn("k", F.explode(F.sequence(F.floor(n * begin / F.col("all")) - 1, F.floor(n * F.col("end") / F.col("all")) + 1))).filter(F.col("k").between(0, n - 1))
    hashed = ((F.col("poly_id") * 7919 + F.col("k") * F.lit(104729) + F.lit(seed)) * F.lit(40503) % F.lit(65521)) / F.lit(65521.0)
    at = (F.col("k") + hashed) / n * F.col("all")
    return drawn.withColumn("u", at).filter((F.col("u") >= begin) & (F.col("u") < F.col("end"))).select("poly_id", "h", "k", (F.col("x0") + F.col("u") - begin).alias("x"), "y")


def grid_points(vertices: DataFrame, s: float) -> DataFrame:
    """Points at multiples of ``s`` inside each polygon, from the spans of the lines at multiples of ``s``."""
    return places(vertices, s, 0.0).select("poly_id", "h", (F.col("i") * s).alias("x"), (F.col("j") * s).alias("y"))


def vertex_sample(vertices: DataFrame, n: int, least: int = 100) -> DataFrame:
    """max(n, ``least``) vertices in hash order."""
    key = F.col("poly_id") * 16 + F.col("seq")
    return vertices.withColumn("_o", hash_order(key)).orderBy("_o", "poly_id", "seq").limit(max(n, least)).drop("_o")


def snap_bbox(vertices: DataFrame, res: float = 1.0) -> DataFrame:
    b = bbox(vertices)
    return b.select("poly_id", *[(F.floor(F.col(k) / res) * res).cast("double").alias(k) for k in ("xmin", "ymin")], *[(F.ceil(F.col(k) / res) * res).cast("double").alias(k) for k in ("xmax", "ymax")])


def fishnet(extent: DataFrame, size: float) -> DataFrame:
    """Tiles of a regular grid over each extent's box."""
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / size), F.ceil(F.col(hi) / size) - 1))
    g = extent.select(span("ymin", "ymax").alias("j"), "xmin", "xmax").select("j", span("xmin", "xmax").alias("i")).distinct()
    return g.select("i", "j", (F.col("i") * size).alias("xmin"), (F.col("j") * size).alias("ymin"), ((F.col("i") + 1) * size).alias("xmax"), ((F.col("j") + 1) * size).alias("ymax"))


def grid_transform(cells: DataFrame, px: float) -> DataFrame:
    """Affine terms of each watershed's grid: pixel width, 0, left, 0, -pixel height, top."""
    return cells.groupBy("h").agg(F.lit(px).alias("a"), (F.min("c") * px).alias("left"), F.lit(-px).alias("e"), ((F.max("r") + 1) * px).alias("top"))


def explode_parts(polys: DataFrame) -> DataFrame:
    return polys.select("id", F.posexplode("parts").alias("part", "ring"))


def collect_parts(parts: DataFrame) -> DataFrame:
    both = F.sort_array(F.collect_list(F.struct("part", "ring")))
    return parts.groupBy("id").agg(F.transform(both, lambda p: p["ring"]).alias("parts"))


def points_from(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.withColumn("geom", F.struct(F.col(x).alias("x"), F.col(y).alias("y")))


def boxes_meet(a: str, b: str) -> Column:
    p = lambda s, k: F.col(f"{s}.{k}")
    return (p(a, "xmin") < p(b, "xmax")) & (p(a, "xmax") > p(b, "xmin")) & (p(a, "ymin") < p(b, "ymax")) & (p(a, "ymax") > p(b, "ymin"))


# fixed values: GRS80 ellipsoid, UTM zone 18 north
_A, _F, _K0, _LON0, _E0 = 6378137.0, 1 / 298.257222101, 0.9996, -75.0, 500000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm18(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing by the Krüger series to third order."""
    s = 2 * math.sqrt(_N) / (1 + _N)
    sin = F.sin(F.radians(lat))
    atanh = lambda v: F.log((1 + v) / (1 - v)) / 2
    t = F.sinh(atanh(sin) - s * atanh(s * sin))
    dl = F.radians(lon - _LON0)
    xi, eta = F.atan2(t, F.cos(dl)), atanh(F.sin(dl) / F.sqrt(1 + t * t))
    e = eta + sum(a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    n = xi + sum(a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return _E0 + _K0 * _RADIUS * e, _K0 * _RADIUS * n


def from_utm18(x: Column, y: Column) -> tuple[Column, Column]:
    xi, eta = y / (_K0 * _RADIUS), (x - _E0) / (_K0 * _RADIUS)
    xp = xi - sum(b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    ep = eta - sum(b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    chi = F.asin(F.sin(xp) / F.cosh(ep))
    lat = chi + sum(d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return _LON0 + F.degrees(F.atan2(F.sinh(ep), F.cos(xp))), F.degrees(lat)
