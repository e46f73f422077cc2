"""Language identification with a blended-spectrum string kernel, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

BITS = 16
ORDERS = (1, 2, 3, 4)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def presence(text: str) -> list[np.ndarray]:
    """For each order n, the sorted set of hashed code-point n-grams that the lower-cased text holds."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out, h = [], np.zeros(len(cp), np.uint64)
    for n in ORDERS:
        if len(cp) < n:
            out.append(np.empty(0, np.int64))
            continue
        h = h[: len(cp) - n + 1] * np.uint64(1_000_003) + cp[n - 1 :]
        flags = np.zeros(1 << BITS, bool)
        flags[((h * _MUL) >> np.uint64(64 - BITS)).astype(np.int64)] = True
        out.append(np.flatnonzero(flags))
    return out


class KernelModel:
    """One-versus-rest ridge coefficients, folded into one weight row per n-gram, order and language."""

    def __init__(self, classes: list[str], weights: list[np.ndarray]):
        self.classes, self.weights = classes, weights

    def outputs(self, sets: list[list[np.ndarray]]) -> np.ndarray:
        """Batched product of the presence matrix with the landmark weights."""
        out = np.zeros((len(sets), len(self.classes)), np.float32)
        for o, w in enumerate(self.weights):
            size = np.array([len(s[o]) for s in sets])
            full = np.flatnonzero(size)
            if len(full):
                flat = np.concatenate([sets[i][o] for i in full])
                at = np.concatenate([[0], np.cumsum(size[full])[:-1]])
                out[full] += np.add.reduceat(w[flat], at, axis=0) / np.sqrt(size[full])[:, None]
        return out


def _kernel(a: list[list[np.ndarray]], marks: list[list[np.ndarray]]) -> np.ndarray:
    """Blended normalised presence kernel between texts and landmarks: the mean over orders of shared n-grams
    over the root of both counts."""
    k = np.zeros((len(a), len(marks)))
    for o in range(len(ORDERS)):
        v = np.zeros((1 << BITS, len(marks)), np.uint8)
        for j, m in enumerate(marks):
            v[m[o], j] = 1
        root = np.sqrt(np.maximum(1, v.sum(0, dtype=np.int64)))
        for i, s in enumerate(a):
            if len(s[o]):
                k[i] += v[s[o]].sum(0, dtype=np.int64) / (np.sqrt(len(s[o])) * root)
    return k / len(ORDERS)


def fit(sample: list[tuple[str, list[np.ndarray]]], landmarks: int = 160, ridge: float = 1e-2) -> KernelModel | None:
    """Fit on ``(language, n-gram sets)`` rows; the first rows of each language in turn become landmarks."""
    classes = sorted({lang for lang, _ in sample})
    if not classes:
        return None
    by = {c: [s for lang, s in sample if lang == c] for c in classes}
    marks = [by[c][i] for i in range(max(map(len, by.values()))) for c in classes if i < len(by[c])][:landmarks]
    y = np.array([[1.0 if lang == c else 0.0 for c in classes] for lang, _ in sample])
    y_weight = 1 / np.sqrt(np.maximum(1, y.sum(0)))  # each language weighs the same
    rows = (y * y_weight).sum(1)[:, None]
    kmm = _kernel(marks, marks)
    val, vec = np.linalg.eigh((kmm + kmm.T) / 2)
    keep = val > 1e-8 * max(1e-12, val.max())
    root = vec[:, keep] / np.sqrt(val[keep])
    phi = _kernel([s for _, s in sample], marks) @ root
    a = (phi * rows).T @ (phi * rows) + ridge * np.eye(phi.shape[1])
    alpha = root @ np.linalg.solve(a, (phi * rows).T @ (y * rows))
    weights = []
    for o in range(len(ORDERS)):
        w = np.zeros((1 << BITS, len(classes)), np.float32)
        for j, m in enumerate(marks):
            if len(m[o]):
                w[m[o]] += (alpha[j] / (np.sqrt(len(m[o])) * len(ORDERS))).astype(np.float32)
        weights.append(w)
    return KernelModel(classes, weights)


def train(docs: DataFrame, is_training: Column, per_language: int = 300, most_chars: int = 20_000, languages: int = 200, **kw) -> KernelModel | None:
    """Fit on a bounded sample: for each of at most ``languages`` labels up to ``per_language`` labelled training
    texts of at most ``most_chars`` characters, lowest hash of the id first. Tasks turn texts into n-gram sets."""
    rows = docs.filter(F.coalesce(is_training, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= most_chars))
    rows = rows.withColumn("_h", F.xxhash64("doc_id"))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    # a threshold on the hash that leaves each language somewhat more than its share
    cut = F.lit(None).cast("double")
    for r in counts:
        cut = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 1.2 * per_language / r["count"] + 20 / r["count"]))).otherwise(cut)
    picked = rows.filter((F.pmod(F.col("_h"), F.lit(1 << 30)) / F.lit(float(1 << 30))) < cut).select("lang", "_h", text_bytes(F.col("text")).alias("b"))

    def sets(batches):
        for b in batches:
            got = [presence(x.as_py().decode("utf-8", "replace")) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([g[o].astype("<i4").tobytes() for g in got], pa.binary()) for o in range(len(ORDERS)))], names=["lang", "h", *(f"s{n}" for n in ORDERS)])

    found = picked.mapInArrow(sets, "lang string, h long, " + ", ".join(f"s{n} binary" for n in ORDERS)).collect()
    found.sort(key=lambda r: (r["h"], r["lang"], r["s1"], r["s2"]))
    seen, sample = {}, []
    for r in found:
        seen[r["lang"]] = seen.get(r["lang"], 0) + 1
        if seen[r["lang"]] <= per_language:
            sample.append((r["lang"], [np.frombuffer(r[f"s{n}"], "<i4").astype(np.int64) for n in ORDERS]))
    return fit(sample, **kw)


def predict(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every whole text: the language of the largest output and its share of the
    positive outputs. ``und`` and 0 where the text is null or has no letter, or nothing was learned. Repeated
    rows give repeated rows, an empty table none, other columns are not carried."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                texts = [x.as_py().decode("utf-8", "replace") for x in part.column(1)]
                ok = np.array([m is not None and any(map(str.isalpha, t)) for t in texts], bool)
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
                if ok.any():
                    at = np.flatnonzero(ok)
                    f = np.maximum(m.outputs([presence(texts[i]) for i in at]), 0) + 1e-9
                    best = f.argmax(1)
                    score[at] = f[np.arange(len(at)), best] / f.sum(1)
                    for i, j in zip(at, best, strict=True):
                        lang[i] = m.classes[j]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes(F.col("text")).alias("b")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
