"""Exact top-k inner-product search by columnar branch-and-bound."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PACKED = "side int, key int, n int, dim int, ids binary, data binary"
_HITS = "query_id long, vec_id long, score long"


def _packer(side: int, rows: int, groups: int, salts: int):
    """Blocks of ``rows`` vectors in vertical layout (one run of values per dimension), by vector length.

    A query block goes to one group and is copied to every salt; a candidate block goes to one salt of every
    group, so each pair of blocks meets in exactly one (group, salt) cell.
    """

    def pack(batches):
        turn = 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            vals = b.column(1)
            starts = vals.offsets.to_numpy()
            flat = vals.values.to_numpy(zero_copy_only=False)
            size = np.diff(starts)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                for s in range(0, len(at), rows):
                    part = at[s : s + rows]
                    m = flat[starts[part][:, None] + np.arange(dim)[None, :]].T
                    first = int(ids[part[0]])
                    if side == 0:
                        keys = [(first // 100) % groups * salts + x for x in range(salts)]
                    else:
                        keys = [g * salts + (first + turn) % salts for g in range(groups)]
                    turn += 1
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([side] * n, pa.int32()),
                            pa.array(keys, pa.int32()),
                            pa.array([len(part)] * n, pa.int32()),
                            pa.array([int(dim)] * n, pa.int32()),
                            pa.array([ids[part].astype("<i8").tobytes()] * n, pa.binary()),
                            pa.array([np.ascontiguousarray(m).astype("<i8").tobytes()] * n, pa.binary()),
                        ],
                        names=["side", "key", "n", "dim", "ids", "data"],
                    )

    return pack


class _Queries:
    """The query vectors of one cell with their k best so far."""

    def __init__(self, k: int):
        self.k, self.blocks = k, []

    def add(self, ids, m):
        n = len(ids)
        self.blocks.append((ids, m, [np.empty(0, np.int64)] * n, [np.empty(0, np.int64)] * n))

    def scan(self, ids, m, step: int):
        for q_ids, q, scores, found in self.blocks:
            _scan(q_ids, q, scores, found, ids, m, self.k, step)

    def hits(self):
        for q_ids, _, scores, found in self.blocks:
            for i, q in enumerate(q_ids):
                if len(scores[i]):
                    yield np.full(len(scores[i]), q), found[i], scores[i]


def _scan(q_ids, q, scores, found, ids, x, k, step):
    dim = min(len(q), len(x))  # a shorter vector counts as padded with zeros
    top = max(1, int(np.abs(q).max(initial=0))), max(1, int(np.abs(x).max(initial=0)))
    exact = top[0] * top[1] * max(1, dim) < 2**53
    kind = np.float64 if exact else np.int64
    qf, xf = q[:dim].astype(kind), x[:dim].astype(kind)
    cuts = list(range(0, dim, step)) + [dim]
    # remaining mass: the norm of what is left of a vector after each block of dimensions
    rest_q = [np.sqrt((qf[c:].astype(np.float64) ** 2).sum(0)) for c in cuts]
    rest_x = [np.sqrt((xf[c:].astype(np.float64) ** 2).sum(0)) for c in cuts]
    begin = qf[: cuts[1]].T @ xf[: cuts[1]] if dim else np.zeros((len(q_ids), len(ids)), kind)
    for i, own in enumerate(q_ids):
        low = scores[i][-1] if len(scores[i]) >= k else None
        live = np.flatnonzero(ids != own)
        part = begin[i][live]
        for c in range(1, len(cuts)):
            if low is not None and len(live):
                bound = part + rest_q[c][i] * rest_x[c][live] * (1 + 1e-9) + 1e-6
                keep = bound >= low
                live, part = live[keep], part[keep]
            if c + 1 < len(cuts) and len(live):
                part = part + qf[cuts[c] : cuts[c + 1], i] @ xf[cuts[c] : cuts[c + 1]][:, live]
        if not len(live):
            continue
        s = np.concatenate([scores[i], part.astype(np.int64)])
        v = np.concatenate([found[i], ids[live]])
        best = np.lexsort((v, -s))[:k]
        scores[i], found[i] = s[best], v[best]


def _searcher(k: int, step: int):
    def search(batches):
        now, held = None, None

        def flush():
            for q, v, s in held.hits() if held else ():
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])

        for b in batches:
            cols = [b.column(i) for i in range(6)]
            for i in range(b.num_rows):
                side, key, n, dim = (cols[j][i].as_py() for j in range(4))
                if key != now:
                    yield from flush()
                    now, held = key, _Queries(k)
                ids = np.frombuffer(cols[4][i].as_buffer(), "<i8")
                m = np.frombuffer(cols[5][i].as_buffer(), "<i8").reshape(dim, n)
                if side == 0:
                    held.add(ids.copy(), m.copy())
                elif held.blocks:
                    held.scan(ids, m, step)
        yield from flush()

    return search


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(vec_id, ints)``: every component x as floor(scale * x); rows with a null id, a null vector or a null,
    NaN or infinite component are left out."""
    e = F.col(vec_col)
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & e.isNotNull() & F.forall(e, ok)).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("ints"),
    )


def exact_topk(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block: int = 4096,
    step: int = 16,
    group_queries: int = 65536,
) -> DataFrame:
    """The ``k`` highest integer inner products of each query vector against all other vectors.

    Queries and candidates travel as packed blocks in vertical layout; a grid of (query group, salt) cells lets
    every pair of blocks meet once, so no side is broadcast or collected. Inside a cell the products are summed
    ``step`` dimensions at a time, and candidates whose sum plus the Cauchy-Schwarz bound of the remaining mass
    stays under the query's k-th best are compacted away before the next dimensions are read.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``. Vectors that are null or hold
    null or non-finite components take no part; rows with the query's own id never pair with it; a query id that
    repeats is answered once, from its smallest vector; a shorter vector counts as padded with zeros; an empty
    table or no query gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, id_col, vec_col, scale)
    asked = ints.filter(is_query).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    n_queries = vectors.filter(is_query).count()
    groups = max(1, -(-n_queries // group_queries))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    q = asked.mapInArrow(_packer(0, 1024, groups, salts), _PACKED)
    c = ints.mapInArrow(_packer(1, block, groups, salts), _PACKED)
    cells = q.unionByName(c).repartition(groups * salts, "key").sortWithinPartitions("key", "side")
    near = cells.mapInArrow(_searcher(k, step), _HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
