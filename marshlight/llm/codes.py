"""Vector codes: integer k-means on parts of vectors, with products that float64 BLAS keeps exact."""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialize, remove


def limb_bits(width: int) -> int:
    """Bits of a signed limb such that sums of ``width`` products of two limbs stay below 2^53."""
    return (52 - max(0, width - 1).bit_length()) // 2 + 1


def limbs(m: np.ndarray, bits: int) -> list[np.ndarray]:
    """``m`` as float64 limbs: m is the sum of limb i times 2^(i bits), each within 2^(bits - 1) of zero."""
    out, half = [], np.int64(1 << (bits - 1))
    while not out or m.any():
        low = ((m + half) & np.int64((1 << bits) - 1)) - half
        out.append(low.astype(np.float64))
        m = (m - low) >> np.int64(bits)
    return out


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact int64 inner products of the rows of two integer matrices, by float64 products of their limbs."""
    bits = limb_bits(x.shape[1])
    total = np.zeros((len(x), len(y)), np.int64)
    right = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64) << np.int64((i + j) * bits)
    return total


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part (ties to the lower index) and the squared distance summed over parts. ``x`` is
    (vectors, parts, width), ``books`` (parts, entries, width)."""
    code = np.zeros(x.shape[:2], np.int64)
    error = np.zeros(len(x), np.int64)
    for p, book in enumerate(books):
        part = np.ascontiguousarray(x[:, p])
        away = (part * part).sum(1)[:, None] - 2 * products(part, book) + (book * book).sum(1)[None, :]
        code[:, p] = away.argmin(1)
        error += away[np.arange(len(x)), code[:, p]]
    return code, error


def _vectors(column: pa.Array, parts: int, rows: int = 8192):
    """(first row, vectors as (rows, parts, width)) of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = len(column)
    whole = flat.reshape(n, parts, -1) if n else flat.reshape(0, parts, 0)
    for s in range(0, n, rows):
        yield s, whole[s : s + rows]


def _sums(books: np.ndarray):
    """What a task's vectors add to each entry: their number and the sums of their components."""

    def run(batches):
        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for b in batches:
            for _, x in _vectors(b.column(0), len(books)):
                code, _ = assign(x, books)
                for p in range(len(books)):
                    o = np.argsort(code[:, p], kind="stable")
                    c = code[o, p]
                    first = np.flatnonzero(np.diff(c, prepend=-1))
                    total[p, c[first]] += np.add.reduceat(x[o, p], first, axis=0)
                    count[p] += np.bincount(c, minlength=books.shape[1])
        p, e = np.nonzero(count)
        if len(p):
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            cols = (p, e, count[p, e], list(total[p, e]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["part", "entry", "n", "sums"])

    return run


def _coder(books: np.ndarray):
    def run(batches):
        for b in batches:
            said, errors = [], []
            for _, x in _vectors(b.column(b.num_columns - 1), len(books)):
                code, error = assign(x, books)
                said += [bytes(c).hex() for c in code.astype(np.uint8)]
                errors.append(error)
            error = np.concatenate(errors) if errors else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(said, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def whole_vectors(vectors: DataFrame, scale: int, parts: int, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """``vec_id, label, ints`` without vectors that are null or hold null or non-finite components: every component x
    as floor(scale * x), shorter vectors padded with zeros to the longest one's length, a multiple of ``parts``."""
    e = F.col(vec_col)
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    kept = vectors.filter(e.isNotNull() & F.forall(e, ok))
    of = kept.agg(F.max(F.size(e)).alias("dim"), F.max(F.array_max(F.transform(e, lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    dim = -(-(of["dim"] or 0) // parts) * parts
    reach = isqrt((2**63 - 1) // (4 * max(1, dim))) - 1
    if (of["most"] or 0) * scale > reach:
        raise OverflowError(f"components of over {reach / scale:g} could take squared distances beyond a long")
    ints = F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    padded = F.concat(ints, F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size(e)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), padded.alias("ints"))


def vector_codes(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label"
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: product-quantised codes of integer vectors.

    Each part's codebook starts as that part of the ``entries`` vectors with the smallest ids. A round assigns all parts
    in blocks and adds up each entry's parts: tasks send one row per entry that they used, Spark adds these, and only
    the codebooks (parts * entries * width integers) reach the driver. Distances come from products of limbs that
    float64 keeps exact, put together in int64, and the first least one wins.

    Vectors that are null or hold null or non-finite components are left out; shorter ones count as padded with
    zeros; components so large that a squared distance could leave a long raise an error. Rows without an id come last
    among the first entries and are coded like any other; repeated ids and rows are rows of their own (equal ids in
    the order of their vectors); with fewer vectors than entries there are as many entries; null labels are one label;
    an empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    kept, kept_path = materialize(whole_vectors(vectors, scale, parts, id_col, vec_col, label), "vectors")
    first = kept.orderBy(F.col("vec_id").isNull(), "vec_id", "ints").limit(entries).collect()
    books = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy() if first else np.zeros((parts, 0, 0), np.int64)
    for _ in range(rounds if first else 0):
        sent = kept.select("ints").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
        each = sent.select("part", "entry", "n", F.posexplode("sums").alias("pos", "s"))
        added = each.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for r in added.collect():  # at most one row per codebook component
            books[r["part"], r["entry"], r["pos"]] = int(r["s"]) // r["n"]
    said = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kind = kept.schema["label"].dataType.simpleString()
    coded, _ = materialize(kept.mapInArrow(_coder(books), f"vec_id long, label {kind}, code string, error long") if first else kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), "codes")
    remove(spark, kept_path)
    sums = coded.groupBy("label").agg(F.count("*").alias("rows"), F.sum("error").alias("label_error"))
    return join_counted(coded, sums, "label", "rows").select("vec_id", "code", "error", "label_error", F.lit(said).alias("codebooks_sha256"))
