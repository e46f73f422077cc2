"""Queries of moving windows, terrain and hydrology."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import focal as W
from ..operators import hydrology as H
from ..operators import terrain as T
from ..operators.cells import stack
from .queries_vectors import rnd
from .registry import query

c = F.col


def _win(k: int, band: str = "dem") -> str:
    """One row per cell with the aggregates of its (2k + 1)-square window."""
    return f"(SELECT a.h, a.r, a.c, any_value(a.{band}) AS v, count(b.{band}) AS n, sum(b.{band}) AS s, sum(b.{band} * b.{band}) AS q, min(b.{band}) AS lo, max(b.{band}) AS hi, median(b.{band}) AS med FROM fx_cells a JOIN fx_cells b ON a.h = b.h AND b.r BETWEEN a.r - {k} AND a.r + {k} AND b.c BETWEEN a.c - {k} AND a.c + {k} GROUP BY a.h, a.r, a.c)"


def _nine(src: str = "fx_cells", band: str = "dem") -> str:
    parts = ", ".join(f"max(CASE WHEN b.r - a.r = {i} AND b.c - a.c = {j} THEN b.{band} END) AS z{p}" for p, (i, j) in enumerate([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)], 1))
    return f"(SELECT a.h, a.r, a.c, count(b.{band}) AS n, {parts} FROM {src} a JOIN {src} b ON a.h = b.h AND b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY a.h, a.r, a.c)"


ZX = "((z3 + 2 * z6 + z9) - (z1 + 2 * z4 + z7)) / 8"
ZY = "((z1 + 2 * z2 + z3) - (z7 + 2 * z8 + z9)) / 8"
SLOPE = f"atan(sqrt(pow({ZX}, 2) + pow({ZY}, 2)))"


@query("e15_fill_gaps", """WITH t AS (SELECT h, r, c FROM (SELECT DISTINCT h FROM fx_cells), (SELECT unnest(range(64)) AS r), (SELECT unnest(range(64)) AS c))
 SELECT t.h, t.r, t.c, coalesce(any_value(k.dem), round(avg(b.dem), 6)) AS dem FROM t LEFT JOIN (SELECT * FROM fx_cells) k ON k.h = t.h AND k.r = t.r AND k.c = t.c LEFT JOIN (SELECT * FROM fx_cells) b ON b.h = t.h AND b.r BETWEEN t.r - 1 AND t.r + 1 AND b.c BETWEEN t.c - 1 AND t.c + 1 GROUP BY t.h, t.r, t.c""")
def _(fx):
    return rnd(W.fill_gaps(fx.cells, _template(fx), "dem"), "dem")


def _template(fx):
    n = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    return fx.cells.select("h").distinct().select("h", n(64).alias("r")).select("h", "r", n(64).alias("c"))


@query("e16_fill_holes", """WITH s AS (SELECT h, r, c, dem FROM fx_cells WHERE (r * 7 + c * 3) % 5 <> 0), t AS (SELECT h, r, c FROM (SELECT DISTINCT h FROM fx_cells), (SELECT unnest(range(64)) AS r), (SELECT unnest(range(64)) AS c))
 SELECT t.h, t.r, t.c, coalesce(any_value(k.dem), round(avg(b.dem), 6)) AS dem FROM t LEFT JOIN s k ON k.h = t.h AND k.r = t.r AND k.c = t.c LEFT JOIN s b ON b.h = t.h AND b.r BETWEEN t.r - 1 AND t.r + 1 AND b.c BETWEEN t.c - 1 AND t.c + 1 GROUP BY t.h, t.r, t.c HAVING count(b.dem) >= 7""")
def _(fx):
    return rnd(W.fill_holes(fx.cells.filter((c("r") * 7 + c("c") * 3) % 5 != 0), _template(fx), "dem", least=7), "dem")


@query("e17_focal_21", f"SELECT h, r, c, lo AS mn, hi AS mx, round(s / n, 6) AS mean, round(CASE WHEN n > 1 THEN sqrt(greatest(0.0E0, (q - s * s / n) / (n - 1))) END, 5) AS sd FROM {_win(10)}")
def _(fx):
    return rnd(rnd(W.focal_many(fx.cells, 21, {"mn": "min", "mx": "max", "mean": "mean", "sd": "sd"}, "dem"), "mean"), "sd", n=5)


@query("e18_focal_median", f"SELECT h, r, c, med FROM {_win(25)}")
def _(fx):
    return W.focal_tile(fx.cells, 51, "median", "dem").withColumnRenamed("dem", "med")


@query("e18_focal_modal", "SELECT h, r, c, chm FROM (SELECT h, r, c, chm, row_number() OVER (PARTITION BY h, r, c ORDER BY n DESC, chm) AS k FROM (SELECT a.h, a.r, a.c, b.chm, count(*) AS n FROM fx_cells a JOIN fx_cells b ON a.h = b.h AND b.r BETWEEN a.r - 5 AND a.r + 5 AND b.c BETWEEN a.c - 5 AND a.c + 5 WHERE b.chm IS NOT NULL AND a.chm IS NOT NULL GROUP BY a.h, a.r, a.c, b.chm)) WHERE k = 1")
def _(fx):
    return W.focal_tile(fx.cells.filter("chm IS NOT NULL"), 11, "modal", "chm")


# sigma 2 in five passes: two boxes of radius 1, then three of radius 2
_PASS = "SELECT a.h, a.r, a.c, sum(b.dem) / {w}.0E0 AS dem FROM {src} a JOIN {src} b ON a.h = b.h AND b.r BETWEEN a.r - {k} AND a.r + {k} AND b.c BETWEEN a.c - {k} AND a.c + {k} GROUP BY a.h, a.r, a.c"


def _gauss_sql() -> str:
    low, high, m = W.gaussian_plan(2.0, 1.0)
    src, ctes = "fx_cells", []
    for i, k in enumerate([low] * m + [high] * (5 - m)):
        ctes.append(f"p{i} AS ({_PASS.format(w=(2 * k + 1) ** 2, src=src, k=k)})")
        src = f"p{i}"
    return f"WITH {', '.join(ctes)} SELECT h, r, c, round(dem, 4) AS dem FROM {src}"


@query("e19_gaussian", _gauss_sql())
def _(fx):
    return rnd(W.gaussian(fx.cells, 2.0, "dem"), "dem", n=4)


@query("e20_slope_aspect", f"SELECT h, r, c, CASE WHEN n = 9 THEN round({SLOPE}, 6) END AS slope_rad, CASE WHEN n = 9 THEN round(degrees({SLOPE}), 6) END AS slope, CASE WHEN n = 9 THEN round(fmod(degrees(atan2(-({ZX}), -({ZY}))) + 360, 360), 6) END AS aspect FROM {_nine()}")
def _(fx):
    return rnd(T.slope_aspect(fx.cells), "slope_rad", "slope", "aspect")


_OTH = ["z1", "z2", "z3", "z4", "z6", "z7", "z8", "z9"]


@query("e21_relief", f"SELECT h, r, c, CASE WHEN n = 9 THEN round(z5 - ({' + '.join(_OTH)}) / 8, 6) END AS tpi, CASE WHEN n = 9 THEN round(({' + '.join(f'abs(z5 - {z})' for z in _OTH)}) / 8, 6) END AS tri, CASE WHEN n = 9 THEN greatest(z5, {', '.join(_OTH)}) - least(z5, {', '.join(_OTH)}) END AS roughness FROM {_nine()}")
def _(fx):
    return rnd(T.relief(fx.cells), "tpi", "tri")


_DIRS = [(1, "z6", 1), (2, "z9", 0), (4, "z8", 1), (8, "z7", 0), (16, "z4", 1), (32, "z1", 0), (64, "z2", 1), (128, "z3", 0)]


def _flow_sql() -> str:
    # the largest drop wins, the smaller code on ties
    drops = [f"(z5 - {z})" + ("" if straight else " / sqrt(2.0E0)") for _, z, straight in _DIRS]
    best = f"greatest({', '.join(f'coalesce({d}, -1)' for d in drops)})"
    cases = " ".join(f"WHEN coalesce({d}, -1) = b THEN {code}" for (code, _, _), d in zip(_DIRS, drops, strict=True))
    return f"SELECT h, r, c, CAST(CASE WHEN b <= 0 THEN 0 {cases} END AS INTEGER) AS dir FROM (SELECT *, {best} AS b FROM {_nine()})"


@query("e22_flowdir", _flow_sql())
def _(fx):
    return T.flowdir(fx.cells)


@query("e23_slope_window", "SELECT h, r, c, CASE WHEN n = 25 THEN round(degrees(atan(sqrt(a * a + b * b))), 6) END AS slope FROM (SELECT a.h, a.r, a.c, count(b.dem) AS n, sum(b.dem * (b.c - a.c)) / 50.0E0 AS a, sum(b.dem * (b.r - a.r)) / 50.0E0 AS b FROM fx_cells a JOIN fx_cells b ON a.h = b.h AND b.r BETWEEN a.r - 2 AND a.r + 2 AND b.c BETWEEN a.c - 2 AND a.c + 2 GROUP BY a.h, a.r, a.c)")
def _(fx):
    return rnd(T.slope_w(fx.cells, 5), "slope")


@query("e24_dmv", f"SELECT h, r, c, round(v - s / n, 6) AS dmv, round((v - s / n) / nullif(hi - lo, 0), 6) AS scaled FROM {_win(2)}")
def _(fx):
    both = stack([T.dmv(fx.cells, 5), T.dmv(fx.cells, 5, stand="range").withColumnRenamed("dmv", "scaled")])
    return rnd(both, "dmv", "scaled")


_CURV = f"""(SELECT h, r, c, n, (z1 + z3 + z4 + z6 + z7 + z9 - 2 * (z2 + z5 + z8)) / 3 AS xx, (z1 + z2 + z3 + z7 + z8 + z9 - 2 * (z4 + z5 + z6)) / 3 AS yy, (z3 + z7 - z1 - z9) / 4 AS xy, (z3 + z6 + z9 - z1 - z4 - z7) / 6 AS x, (z1 + z2 + z3 - z7 - z8 - z9) / 6 AS y FROM {_nine()})"""


@query("e25_curvature", f"""SELECT h, r, c, round(CASE WHEN p = 0 THEN -(xx + yy) / 2 ELSE (pr + pl) / 2 END, 5) AS meanc, round(pl, 5) AS planc, round(pr, 5) AS profc FROM (SELECT *, x * x + y * y AS p,
 -(xx * x * x + 2 * xy * x * y + yy * y * y) / nullif((x * x + y * y) * pow(1 + x * x + y * y, 1.5), 0) AS pr, -(xx * y * y - 2 * xy * x * y + yy * x * x) / nullif((x * x + y * y) * sqrt(1 + x * x + y * y), 0) AS pl FROM {_CURV} WHERE n = 9)
 UNION ALL SELECT h, r, c, NULL, NULL, NULL FROM {_CURV} WHERE n < 9""")
def _(fx):
    return rnd(T.curvature(fx.cells), "meanc", "planc", "profc", n=5)


def _geo_sql(search: int = 100, skip: int = 10) -> str:
    vals = ", ".join(f"({p}, {i * d}, {j * d}, {d}.0E0 * {'sqrt(2.0E0)' if i and j else '1'})" for p, (_, _, i, j) in enumerate(T.D8) for d in range(skip, search + 1))
    table = "[" + ", ".join("[" + ", ".join(str(T.CODES.index(x) + 1) for x in row.split()) + "]" for row in T.FORMS) + "]"
    return f"""WITH s(p, i, j, d) AS (VALUES {vals}), k AS MATERIALIZED (SELECT h, r, c, dem FROM fx_cells), t AS MATERIALIZED (SELECT h, r, c, p, d, dem, r + i AS br, c + j AS bc FROM k, s WHERE r + i BETWEEN (SELECT min(r) FROM k) AND (SELECT max(r) FROM k) AND c + j BETWEEN (SELECT min(c) FROM k) AND (SELECT max(c) FROM k)),
 m AS (SELECT t.h, t.r, t.c, t.p, round(degrees(atan(max((b.dem - t.dem) / d))) + degrees(atan(min((b.dem - t.dem) / d))), 9) AS a FROM t JOIN k b ON b.h = t.h AND b.r = br AND b.c = bc GROUP BY t.h, t.r, t.c, t.p)
 SELECT h, r, c, CAST({table}[dn + 1][up + 1] AS INTEGER) AS form FROM (SELECT h, r, c, count(*) FILTER (a > 1.5) AS up, count(*) FILTER (a < -1.5) AS dn FROM m GROUP BY h, r, c)"""


@query("e26_geomorphons", _geo_sql())
def _(fx):
    return T.geomorphons(fx.cells, search=100, skip=10, flat=1.5)


@query("e27_terrain_at_scale")
def _(fx):
    return rnd(T.terrain_at_scale(fx.cells, 2, "slope"), "slope_2")


@query("e28_fill_depressions")
def _(fx):
    return H.fill_depressions(fx.cells)


_ACC = f"""WITH RECURSIVE d AS ({_flow_sql()}), s(dir, i, j) AS (VALUES (1, 0, 1), (2, 1, 1), (4, 1, 0), (8, 1, -1), (16, 0, -1), (32, -1, -1), (64, -1, 0), (128, -1, 1)),
 e AS (SELECT d.h, d.r, d.c, d.r + s.i AS tr, d.c + s.j AS tc FROM d JOIN s USING (dir)), w AS (SELECT h, r AS sr, c AS sc, r, c FROM d UNION ALL SELECT w.h, w.sr, w.sc, e.tr, e.tc FROM w JOIN e ON e.h = w.h AND e.r = w.r AND e.c = w.c)"""


@query("e29_flow_acc", f"{_ACC} SELECT h, r, c, count(*) AS acc FROM w GROUP BY h, r, c")
def _(fx):
    return H.flow_acc(T.flowdir(fx.cells))


@query("e30_twi", f"{_ACC}, a AS (SELECT h, r, c, count(*) AS acc FROM w GROUP BY h, r, c), sl AS (SELECT h, r, c, CASE WHEN n = 9 THEN {SLOPE} END AS s FROM {_nine()}) SELECT h, r, c, CASE WHEN tan(s) > 0 THEN round(ln(acc / tan(s)), 6) END AS twi FROM a JOIN sl USING (h, r, c)")
def _(fx):
    return rnd(T.twi(H.flow_acc(T.flowdir(fx.cells)), T.slope_aspect(fx.cells)), "twi")


@query("e31_hillshade", f"SELECT h, r, c, CASE WHEN n = 9 THEN round(cos(radians(45)) * cos({SLOPE}) + sin(radians(45)) * sin({SLOPE}) * cos(-radians(fmod(degrees(atan2(-({ZX}), -({ZY}))) + 360, 360))), 6) END AS shade FROM {_nine()}")
def _(fx):
    return rnd(T.hillshade(T.slope_aspect(fx.cells)), "shade")


@query("e32_scale_space")
def _(fx):
    return rnd(T.scale_space(fx.cells, [0.0, 1.0, 2.0]), "sd", "range", "slope_mean", "slope_sd", "slope_max")


@query("e33_pick_scales", "SELECT h, k, CASE WHEN k = 0 THEN 0.0E0 ELSE round(exp((k - 1) / 5.0E0 * ln(side / 30.0E0)), 6) END AS sigma FROM (SELECT h, least(max(r) - min(r) + 1, max(c) - min(c) + 1) AS side FROM fx_cells GROUP BY h), (SELECT unnest(range(7)) AS k)")
def _(fx):
    return rnd(T.pick_scales(fx.cells, 6), "sigma")


@query("q10_method_compare", f"""WITH k AS (SELECT h, r, c FROM fx_cells ORDER BY (((h * 4096 + r) * 4096 + c) * 2654435761) % 1000003, h, r, c LIMIT 2000), p AS (SELECT h, r, c, CASE WHEN n = 9 THEN degrees({SLOPE}) END AS a, CASE WHEN n = 9 THEN degrees(atan(sqrt(pow((z3 + z6 + z9 - z1 - z4 - z7) / 6, 2) + pow((z7 + z8 + z9 - z1 - z2 - z3) / 6, 2)))) END AS b FROM {_nine()})
 SELECT count(*) AS n, round(corr(a, b), 6) AS corr FROM k JOIN p USING (h, r, c) WHERE a IS NOT NULL""")
def _(fx):
    return rnd(T.method_compare(fx.cells, 2000), "corr")
