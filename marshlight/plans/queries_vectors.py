"""Queries of geometry, overlay and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import geometry as G
from ..operators import spatial as S
from ..operators.iterate import connected
from .registry import query

c = F.col
EDGES = "e AS (SELECT a.poly_id, a.h, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM fx_vertices a JOIN fx_vertices b ON a.poly_id = b.poly_id AND b.seq = a.seq + 1)"
BOX = "bx AS (SELECT poly_id, h, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM fx_vertices GROUP BY poly_id, h)"


def _cross(px, py):
    return f"sum(CASE WHEN (y1 > {py}) <> (y2 > {py}) AND {px} < (x2 - x1) * ({py} - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1"


def _dist(px, py):
    t = f"greatest(0.0E0, least(1.0E0, coalesce((({px} - x1) * (x2 - x1) + ({py} - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0)))"
    return f"min(sqrt(pow({px} - x1 - {t} * (x2 - x1), 2) + pow({py} - y1 - {t} * (y2 - y1), 2)))"


def cover_sql(margin: float = 0) -> str:
    """CTEs down to ``cov(poly_id, h, r, c, inside, dist)``."""
    return f"""{EDGES}, {BOX},
 gr AS (SELECT poly_id, h, unnest(range(CAST(floor(ymin - {margin}) AS BIGINT), CAST(floor(ymax + {margin}) AS BIGINT) + 1)) AS r, xmin, xmax FROM bx),
 gc AS (SELECT poly_id, h, r, unnest(range(CAST(floor(xmin - {margin}) AS BIGINT), CAST(floor(xmax + {margin}) AS BIGINT) + 1)) AS c FROM gr),
 cov AS (SELECT g.poly_id, g.h, g.r, g.c, {_cross('(g.c + 0.5E0)', '(g.r + 0.5E0)')} AS inside, {_dist('(g.c + 0.5E0)', '(g.r + 0.5E0)')} AS dist FROM gc g JOIN e USING (poly_id) GROUP BY g.poly_id, g.h, g.r, g.c)"""


PTREL = f"{EDGES}, pr AS (SELECT p.pt_id, e.poly_id, {_cross('p.x', 'p.y')} AS inside, {_dist('p.x', 'p.y')} AS dist FROM fx_points p JOIN e ON e.h = p.h GROUP BY p.pt_id, e.poly_id)"


def _orient(a, b, px, py):
    return f"sign(({a}.x2 - {a}.x1) * ({py} - {a}.y1) - ({a}.y2 - {a}.y1) * ({px} - {a}.x1))"


def _crossing(a, b):
    return f"{_orient(a, b, f'{b}.x1', f'{b}.y1')} * {_orient(a, b, f'{b}.x2', f'{b}.y2')} < 0 AND {_orient(b, a, f'{a}.x1', f'{a}.y1')} * {_orient(b, a, f'{a}.x2', f'{a}.y2')} < 0"


PAIRS = f"""{EDGES}, xs AS (SELECT a.poly_id AS a, b.poly_id AS b FROM e a JOIN e b ON a.h = b.h AND a.poly_id < b.poly_id WHERE {_crossing('a', 'b')}),
 vin AS (SELECT v.poly_id AS v, e.poly_id AS p FROM fx_vertices v JOIN e ON e.h = v.h AND e.poly_id <> v.poly_id GROUP BY v.poly_id, v.seq, e.poly_id HAVING {_cross('min(v.x)', 'min(v.y)').replace('min(v.x)', 'any_value(v.x)').replace('min(v.y)', 'any_value(v.y)')}),
 pairs AS (SELECT a, b FROM xs UNION SELECT least(v, p), greatest(v, p) FROM vin)"""
PAIRS = PAIRS.replace("any_value(v.x)", "v.x").replace("any_value(v.y)", "v.y").replace("GROUP BY v.poly_id, v.seq, e.poly_id", "GROUP BY v.poly_id, v.seq, v.x, v.y, e.poly_id")


def rnd(df, *cols, n=6):
    return df.withColumns({x: F.round(x, n) for x in cols})


_UTM = """SELECT c_custkey, round(x, 3) AS x, round(y, 3) AS y FROM (
 WITH p AS (SELECT c_custkey, -79.0E0 + (c_custkey % 70) / 10.0E0 AS lon, 40.5E0 + (c_custkey % 45) / 10.0E0 AS lat, 1 / 298.257222101E0 / (2 - 1 / 298.257222101E0) AS n FROM customer),
 q AS (SELECT *, 6378137.0E0 / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) AS ra, 2 * sqrt(n) / (1 + n) AS s, sin(radians(lat)) AS sl, radians(lon + 75) AS dl FROM p),
 t AS (SELECT *, sinh(ln((1 + sl) / (1 - sl)) / 2 - s * ln((1 + s * sl) / (1 - s * sl)) / 2) AS tt FROM q),
 u AS (SELECT *, atan2(tt, cos(dl)) AS xi, ln((1 + sin(dl) / sqrt(1 + tt * tt)) / (1 - sin(dl) / sqrt(1 + tt * tt))) / 2 AS eta, n / 2 - 2 * n * n / 3 + 5 * n * n * n / 16 AS a1, 13 * n * n / 48 - 3 * n * n * n / 5 AS a2, 61 * n * n * n / 240 AS a3 FROM t)
 SELECT c_custkey, 500000 + 0.9996E0 * ra * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)) AS x,
  0.9996E0 * ra * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta)) AS y FROM u)"""


def _lonlat(fx):
    k = c("c_custkey")
    return fx.table("customer").select("c_custkey", (-79.0 + (k % 70) / 10.0).alias("lon"), (40.5 + (k % 45) / 10.0).alias("lat"))


@query("c01_to_utm18", _UTM)
def _(fx):
    x, y = G.to_utm18(c("lon"), c("lat"))
    return _lonlat(fx).select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("c01_from_utm18", "SELECT c_custkey, round(-79.0E0 + (c_custkey % 70) / 10.0E0, 6) AS lon, round(40.5E0 + (c_custkey % 45) / 10.0E0, 6) AS lat FROM customer")
def _(fx):
    x, y = G.to_utm18(c("lon"), c("lat"))
    lon, lat = G.from_utm18(c("x"), c("y"))
    return _lonlat(fx).select("c_custkey", x.alias("x"), y.alias("y")).select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("c02_area", f"WITH {EDGES} SELECT poly_id, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM e GROUP BY poly_id")
def _(fx):
    return G.area(fx.vertices)


@query("c03_valid", f"""WITH {EDGES}, vv AS (SELECT poly_id, seq, CASE WHEN poly_id % 10 = 3 AND seq IN (1, 5) THEN 2 * 0 + CASE seq WHEN 1 THEN -1 ELSE 1 END ELSE 0 END AS k FROM fx_vertices)
 SELECT poly_id FROM fx_vertices WHERE poly_id % 10 <> 3 GROUP BY poly_id""")
def _(fx):
    # every tenth polygon gets two vertices exchanged, which makes its outline cross itself
    swap = F.when((c("poly_id") % 10 == 3) & c("seq").isin(1, 5), 6 - c("seq")).otherwise(c("seq"))
    return G.valid(fx.vertices.withColumn("seq", swap))


@query("c04_centroid", f"WITH {EDGES} SELECT poly_id, h, round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS x, round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS y FROM e GROUP BY poly_id, h")
def _(fx):
    return rnd(G.centroid(fx.vertices), "x", "y")


@query("c05_boundary", f"WITH {EDGES} SELECT poly_id, seq, x1, y1, x2, y2 FROM e")
def _(fx):
    return G.edges(fx.vertices).drop("h")


@query("c06_sample_line", f"""WITH {EDGES}, l AS (SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len FROM e), s AS (SELECT *, sum(len) OVER (PARTITION BY poly_id ORDER BY seq) AS fin FROM l),
 k AS (SELECT *, fin - len AS beg, unnest(range(CAST(ceil((fin - len) / 0.7E0) AS BIGINT), CAST(ceil(fin / 0.7E0) AS BIGINT))) AS k FROM s)
 SELECT poly_id, h, k, round(x1 + (k * 0.7E0 - beg) / len * (x2 - x1), 6) AS x, round(y1 + (k * 0.7E0 - beg) / len * (y2 - y1), 6) AS y FROM k""")
def _(fx):
    return rnd(G.sample_line(G.edges(fx.vertices), 0.7), "x", "y")


@query("c07_square", "SELECT pt_id, x - 2.5E0 AS xmin, y - 2.5E0 AS ymin, x + 2.5E0 AS xmax, y + 2.5E0 AS ymax FROM fx_points")
def _(fx):
    return G.square(fx.points, 2.5).select("pt_id", "xmin", "ymin", "xmax", "ymax")


@query("c08_within_dist", f"WITH {PTREL} SELECT DISTINCT pt_id FROM pr WHERE inside OR dist <= 1.5")
def _(fx):
    return S.points_near(fx.points, fx.vertices, 1.5).select("pt_id")


@query("c09_ring_cells", f"WITH {cover_sql(3)} SELECT poly_id, CAST(ring AS DOUBLE) AS ring, h, r, c FROM cov, (VALUES (1.0E0), (3.0E0)) t(ring) WHERE NOT inside AND dist <= ring")
def _(fx):
    return G.ring_cells(fx.vertices, [1.0, 3.0])


@query("c10_interior", f"WITH {cover_sql()} SELECT poly_id, h, r, c FROM cov WHERE inside AND dist >= 0.75")
def _(fx):
    return G.interior(fx.vertices, 0.75)


def boxes_sql(half: int) -> str:
    return f"(SELECT pt_id AS box_id, h, floor(x) - {half} AS xmin, floor(y) - {half} AS ymin, floor(x) + {half} AS xmax, floor(y) + {half} AS ymax FROM fx_points)"


_BOXES, _SMALL = boxes_sql(4), boxes_sql(1)


def _boxes(fx, half: float = 4.0):
    p = fx.points.select(c("pt_id").alias("box_id"), "h", F.floor("x").cast("double").alias("x"), F.floor("y").cast("double").alias("y"))
    return G.square(p, half).select("box_id", "h", "xmin", "ymin", "xmax", "ymax")


@query("c11_clip_box", f"WITH {cover_sql()} SELECT b.box_id, k.poly_id, count(*) AS area FROM cov k JOIN {_BOXES} b ON b.h = k.h AND k.c + 0.5E0 >= b.xmin AND k.c + 0.5E0 < b.xmax AND k.r + 0.5E0 >= b.ymin AND k.r + 0.5E0 < b.ymax WHERE inside GROUP BY b.box_id, k.poly_id")
def _(fx):
    return G.clip_box(fx.vertices, _boxes(fx), "box_id").groupBy("box_id", "poly_id").agg(F.count("*").alias("area"))


@query("c12_overlay", f"WITH {cover_sql()} SELECT k.poly_id, z.zone_id, count(*) AS area FROM cov k JOIN fx_zones z ON k.c + 0.5E0 >= z.xmin AND k.c + 0.5E0 < z.xmax AND k.r + 0.5E0 >= z.ymin AND k.r + 0.5E0 < z.ymax WHERE inside GROUP BY k.poly_id, z.zone_id")
def _(fx):
    return G.box_cells(fx.zones, G.cell_set(fx.vertices), "zone_id", on=[]).groupBy("poly_id", "zone_id").agg(F.count("*").alias("area"))


@query("c13_difference", f"""WITH {cover_sql()}, bc AS (SELECT box_id, h, ymin, ymax, unnest(range(CAST(xmin AS BIGINT), CAST(xmax AS BIGINT))) AS c FROM {_BOXES}), b2 AS (SELECT box_id, h, c, unnest(range(CAST(ymin AS BIGINT), CAST(ymax AS BIGINT))) AS r FROM bc)
 SELECT box_id, count(*) AS area FROM b2 WHERE NOT EXISTS (SELECT 1 FROM cov k WHERE k.inside AND k.h = b2.h AND k.r = b2.r AND k.c = b2.c) GROUP BY box_id""")
def _(fx):
    span = lambda lo, hi: F.explode(F.sequence(c(lo).cast("long"), c(hi).cast("long") - 1))
    cells = _boxes(fx).select("box_id", "h", span("ymin", "ymax").alias("r"), "xmin", "xmax").select("box_id", "h", "r", span("xmin", "xmax").alias("c"))
    return G.difference(cells, G.cell_set(fx.vertices)).groupBy("box_id").agg(F.count("*").alias("area"))


@query("c14_dissolve", f"WITH {cover_sql()} SELECT cowardin, count(*) AS area FROM (SELECT DISTINCT a.cowardin, k.h, k.r, k.c FROM cov k JOIN fx_poly_attr a USING (poly_id) WHERE inside) GROUP BY cowardin")
def _(fx):
    cells = G.cell_set(fx.vertices).join(fx.polys.select("poly_id", "cowardin"), "poly_id")
    return G.dissolve(cells, ["cowardin"]).groupBy("cowardin").agg(F.count("*").alias("area"))


def _rounds(n: int = 48) -> str:
    """Labels fall to the least neighbour's and to their label's label, n times."""
    steps = "".join(f""", n{i} AS (SELECT v.poly_id, least(v.grp, coalesce(min(o.grp), v.grp)) AS grp FROM l{i} v LEFT JOIN link l ON l.a = v.poly_id LEFT JOIN l{i} o ON o.poly_id = l.b GROUP BY v.poly_id, v.grp),
 l{i + 1} AS MATERIALIZED (SELECT v.poly_id, o.grp FROM n{i} v JOIN n{i} o ON o.poly_id = v.grp)""" for i in range(n))
    return f"link AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), l0 AS (SELECT poly_id, poly_id AS grp FROM fx_poly_attr){steps}, g AS (SELECT poly_id, grp FROM l{n})"


_GROUPS = f"WITH {PAIRS}, {_rounds()}"


@query("c15_touch_groups", f"{_GROUPS} SELECT poly_id, grp FROM g")
def _(fx):
    nodes = fx.polys.select(c("poly_id").alias("node"))
    return connected(G.intersecting(fx.vertices, joining=True), nodes).select(c("node").alias("poly_id"), c("root").alias("grp"))


@query("c16_filter_group_area", f"{_GROUPS}, a AS (SELECT poly_id, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area FROM e GROUP BY poly_id) SELECT grp, sum(area) AS area FROM g JOIN a USING (poly_id) GROUP BY grp HAVING sum(area) >= 15.5")
def _(fx):
    groups = connected(G.intersecting(fx.vertices, joining=True), fx.polys.select(c("poly_id").alias("node"))).select(c("node").alias("poly_id"), c("root").alias("grp"))
    return groups.join(G.area(fx.vertices), "poly_id").groupBy("grp").agg(F.sum("area").alias("area")).filter("area >= 15.5")


@query("c17_random_points", f"""WITH {EDGES}, l AS (SELECT *, min(least(y1, y2)) OVER (PARTITION BY poly_id) AS lo, max(greatest(y1, y2)) OVER (PARTITION BY poly_id) AS hi FROM e),
 t AS (SELECT l.*, j, lo + (j + 0.5E0) * ((hi - lo) / 64) AS y FROM l, (SELECT unnest(range(64)) AS j)), m AS (SELECT poly_id, h, j, y, (x2 - x1) * (y - y1) / (y2 - y1) + x1 AS x0 FROM t WHERE (y1 > y) <> (y2 > y)),
 s AS (SELECT *, row_number() OVER w AS n, lead(x0) OVER w AS x1 FROM m WINDOW w AS (PARTITION BY poly_id, j ORDER BY x0)), c AS (SELECT *, sum(x1 - x0) OVER (PARTITION BY poly_id ORDER BY j, x0) AS fin, sum(x1 - x0) OVER (PARTITION BY poly_id) AS total FROM s WHERE n % 2 = 1 AND x0 < x1),
 d AS (SELECT c.*, k, (k + ((poly_id * 7919 + k * 104729) * 40503 % 65521) / 65521.0E0) / 5 * total AS u FROM c, (SELECT unnest(range(5)) AS k))
 SELECT poly_id, h, k, round(x0 + u - (fin - (x1 - x0)), 6) AS x, round(y, 6) AS y FROM d WHERE u >= fin - (x1 - x0) AND u < fin""")
def _(fx):
    return rnd(G.random_points(fx.vertices, 5), "x", "y")


@query("c18_grid_points", f"""WITH {EDGES}, {BOX}, j AS (SELECT poly_id, h, xmin, xmax, unnest(range(CAST(ceil(ymin / 0.75E0) AS BIGINT), CAST(floor(ymax / 0.75E0) AS BIGINT) + 1)) AS j FROM bx), g AS (SELECT poly_id, h, j * 0.75E0 AS py, unnest(range(CAST(ceil(xmin / 0.75E0) AS BIGINT), CAST(floor(xmax / 0.75E0) AS BIGINT) + 1)) * 0.75E0 AS px FROM j)
 SELECT g.poly_id, g.h, g.px AS x, g.py AS y FROM g JOIN e USING (poly_id) GROUP BY g.poly_id, g.h, g.px, g.py HAVING {_cross('g.px', 'g.py')}""")
def _(fx):
    return G.grid_points(fx.vertices, 0.75)


@query("c19_vertex_sample", "SELECT poly_id, seq, x, y FROM fx_vertices ORDER BY ((poly_id * 16 + seq) * 2654435761) % 1000003, poly_id, seq LIMIT 150")
def _(fx):
    return G.vertex_sample(fx.vertices, 150).select("poly_id", "seq", "x", "y")


@query("c20_snap_bbox", "SELECT poly_id, floor(min(x)) AS xmin, floor(min(y)) AS ymin, ceil(max(x)) AS xmax, ceil(max(y)) AS ymax FROM fx_vertices GROUP BY poly_id")
def _(fx):
    return G.snap_bbox(fx.vertices)


_NET = "(SELECT i, j, i * 8.0E0 AS xmin, j * 8.0E0 AS ymin, i * 8.0E0 + 8 AS xmax, j * 8.0E0 + 8 AS ymax FROM (SELECT unnest(range(8)) AS i), (SELECT unnest(range(8)) AS j))"


@query("c21_fishnet", f"WITH {BOX} SELECT i, j FROM {_NET} t WHERE EXISTS (SELECT 1 FROM bx b WHERE b.xmin < t.xmax AND b.xmax > t.xmin AND b.ymin < t.ymax AND b.ymax > t.ymin)")
def _(fx):
    net = G.fishnet(fx.zones.agg(*[F.lit(float(v)).alias(k) for k, v in (("xmin", 0), ("ymin", 0), ("xmax", 64), ("ymax", 64))]), 8.0).withColumn("tile_id", c("i") * 8 + c("j"))
    hit = S.box_pairs(net, G.bbox(fx.vertices), "tile_id", "poly_id", [])
    return net.join(hit, "tile_id", "left_semi").select("i", "j")


@query("c22_grid_transform", "SELECT h, 2.0E0 AS a, min(c) * 2.0E0 AS \"left\", -2.0E0 AS e, (max(r) + 1) * 2.0E0 AS top FROM fx_cells GROUP BY h")
def _(fx):
    return G.grid_transform(fx.cells, 2.0)


@query("c23_parts", "SELECT h, poly_id, count(*) AS n FROM fx_vertices GROUP BY h, poly_id")
def _(fx):
    rings = fx.vertices.groupBy("h", "poly_id").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("ring"))
    multi = rings.groupBy(c("h").alias("id")).agg(F.sort_array(F.collect_list(F.struct("poly_id", "ring"))).alias("parts"))
    again = G.collect_parts(G.explode_parts(multi))
    return again.select(c("id").alias("h"), F.explode("parts").alias("p")).select("h", "p.poly_id", F.size("p.ring").cast("long").alias("n"))


@query("c24_points_from", "SELECT pt_id, x, y FROM fx_points")
def _(fx):
    return G.points_from(fx.points, "x", "y").select("pt_id", "geom.x", "geom.y")


@query("c25_extent_intersects", f"SELECT z.zone_id, t.i, t.j FROM fx_zones z JOIN {_NET} t ON z.xmin < t.xmax AND z.xmax > t.xmin AND z.ymin < t.ymax AND z.ymax > t.ymin")
def _(fx):
    net = G.fishnet(fx.zones.agg(*[F.lit(float(v)).alias(k) for k, v in (("xmin", 0), ("ymin", 0), ("xmax", 64), ("ymax", 64))]), 8.0)
    return fx.zones.alias("z").join(F.broadcast(net.alias("t")), G.boxes_meet("z", "t")).select("z.zone_id", "t.i", "t.j")  # 64 tiles


# --- joins
@query("d01_semi_intersects", f"WITH {PTREL} SELECT DISTINCT pt_id FROM pr WHERE inside")
def _(fx):
    return S.points_inside(fx.points, fx.vertices).select("pt_id")


_WITHIN = "SELECT v.poly_id, z.zone_id FROM fx_vertices v JOIN fx_zones z ON true GROUP BY v.poly_id, z.zone_id HAVING bool_and(v.x BETWEEN z.xmin AND z.xmax AND v.y BETWEEN z.ymin AND z.ymax)"


@query("d02_semi_within", _WITHIN)
def _(fx):
    return S.polys_meet_zones(fx.vertices, fx.zones, within=True)


@query("d03_anti_intersects", f"WITH {PTREL} SELECT pt_id FROM fx_points WHERE pt_id NOT IN (SELECT pt_id FROM pr WHERE inside)")
def _(fx):
    return S.points_inside(fx.points, fx.vertices, inverse=True).select("pt_id")


@query("d04_join_inner", f"WITH {PTREL} SELECT pr.pt_id, pr.poly_id, a.attribute FROM pr JOIN fx_poly_attr a USING (poly_id) WHERE inside")
def _(fx):
    return S.st_join(fx.points, fx.vertices, fx.polys.select("poly_id", "attribute")).select("pt_id", "poly_id", "attribute")


@query("d05_join_left", f"WITH {PTREL} SELECT p.pt_id, q.poly_id, a.cowardin FROM fx_points p LEFT JOIN (SELECT * FROM pr WHERE inside) q ON q.pt_id = p.pt_id LEFT JOIN fx_poly_attr a ON a.poly_id = q.poly_id")
def _(fx):
    return S.st_join(fx.points, fx.vertices, fx.polys.select("poly_id", "cowardin"), "left").select("pt_id", "poly_id", "cowardin")


_PZ = f"WITH {BOX}, pz AS (SELECT b.poly_id, z.zone_id FROM bx b JOIN fx_zones z ON b.xmin < z.xmax AND b.xmax > z.xmin AND b.ymin < z.ymax AND b.ymax > z.ymin)"


@query("d06_zones_over", f"{_PZ} SELECT zone_id, count(*) AS n FROM pz GROUP BY zone_id HAVING count(*) > 10")
def _(fx):
    return S.polys_meet_zones(fx.vertices, fx.zones).groupBy("zone_id").agg(F.count("*").alias("n")).filter("n > 10")


@query("d07_zones_any", f"{_PZ} SELECT DISTINCT zone_id FROM pz JOIN fx_poly_attr USING (poly_id) WHERE attribute = 'L1UBH'")
def _(fx):
    lakes = fx.vertices.join(fx.polys.filter("attribute = 'L1UBH'").select("poly_id"), "poly_id", "left_semi")
    return fx.zones.join(S.polys_meet_zones(lakes, fx.zones), "zone_id", "left_semi").select("zone_id")


@query("d08_isolated", "SELECT pt_id FROM fx_points p WHERE NOT EXISTS (SELECT 1 FROM fx_points q WHERE q.h = p.h AND q.pt_id <> p.pt_id AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 6.25E0)")
def _(fx):
    return S.isolated(fx.points, 2.5).select("pt_id")


@query("d09_thin")
def _(fx):
    return S.thin(fx.points, 4.0).select("pt_id", "h", "x", "y")


@query("d10_non_overlapping", f"SELECT box_id FROM {_SMALL} a WHERE NOT EXISTS (SELECT 1 FROM {_SMALL} b WHERE a.h = b.h AND a.box_id <> b.box_id AND a.xmin < b.xmax AND a.xmax > b.xmin AND a.ymin < b.ymax AND a.ymax > b.ymin AND NOT (a.xmin = b.xmin AND a.ymin = b.ymin))")
def _(fx):
    return S.non_overlapping(_boxes(fx, 1.0), "box_id", ["h"]).select("box_id")


@query("d11_not_crossing", f"SELECT box_id FROM {_BOXES} a WHERE NOT EXISTS (SELECT 1 FROM fx_zones z WHERE a.xmin < z.xmax AND a.xmax > z.xmin AND a.ymin < z.ymax AND a.ymax > z.ymin AND NOT (a.xmin >= z.xmin AND a.xmax <= z.xmax AND a.ymin >= z.ymin AND a.ymax <= z.ymax))")
def _(fx):
    return S.not_crossing(_boxes(fx), "box_id", fx.zones).select("box_id")


@query("d12_outside_dist", f"WITH {PTREL} SELECT pt_id FROM fx_points WHERE pt_id NOT IN (SELECT pt_id FROM pr WHERE inside OR dist <= 2)")
def _(fx):
    return S.points_near(fx.points, fx.vertices, 2.0, inverse=True).select("pt_id")


@query("d13_mask_points", f"WITH {PTREL} SELECT pt_id, pt_id IN (SELECT pt_id FROM pr WHERE inside) AS kept FROM fx_points")
def _(fx):
    tag = lambda inv: S.points_inside(fx.points, fx.vertices, inv).select("pt_id", F.lit(not inv).alias("kept"))
    return tag(False).union(tag(True))


@query("d14_resolve_conflicts", f"""WITH {PTREL}, k AS (SELECT p.pt_id, p.mod_class FROM fx_points p WHERE NOT EXISTS (SELECT 1 FROM pr JOIN fx_poly_attr a USING (poly_id) WHERE pr.pt_id = p.pt_id AND inside AND (a.cowardin = 'Terrestrial') = (p.mod_class <> 'UPL')))
 SELECT pt_id, mod_class, CAST(row_number() OVER (PARTITION BY mod_class ORDER BY pt_id) AS INTEGER) AS new_id FROM k""")
def _(fx):
    part = lambda up: fx.vertices.join(fx.polys.filter((c("cowardin") == "Terrestrial") == F.lit(up)).select("poly_id"), "poly_id", "left_semi")
    return S.resolve_conflicts(fx.points, part(False), part(True), "mod_class").select("pt_id", "mod_class", "new_id")


@query("d15_priority_overlay", f"WITH {PAIRS}, l AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs) SELECT poly_id FROM fx_poly_attr p WHERE rad = 4 OR NOT EXISTS (SELECT 1 FROM l JOIN fx_poly_attr q ON q.poly_id = l.b WHERE l.a = p.poly_id AND q.rad = 4)")
def _(fx):
    return S.priority_overlay(fx.polys.filter("rad = 4"), fx.polys.filter("rad <> 4"), fx.vertices).select("poly_id")


@query("d19_tiles_for", f"SELECT z.zone_id, t.i * 8 + t.j AS tile_id FROM fx_zones z JOIN {_NET} t ON z.xmin < t.xmax AND z.xmax > t.xmin AND z.ymin < t.ymax AND z.ymax > t.ymin")
def _(fx):
    return S.tiles_for(fx.zones, _net(fx)).select("zone_id", "tile_id")


def _net(fx):
    net = G.fishnet(fx.zones.agg(*[F.lit(float(v)).alias(k) for k, v in (("xmin", 0), ("ymin", 0), ("xmax", 64), ("ymax", 64))]), 8.0)
    return net.withColumn("tile_id", c("i") * 8 + c("j")).withColumn("collection", c("i") % 3)


@query("d20_collections_for", f"SELECT DISTINCT z.zone_id, t.i % 3 AS collection FROM fx_zones z JOIN {_NET} t ON z.xmin < t.xmax AND z.xmax > t.xmin AND z.ymin < t.ymax AND z.ymax > t.ymin")
def _(fx):
    return S.collections_for(fx.zones, _net(fx))
