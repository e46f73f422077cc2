"""Quality classification by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, text_bytes

BITS = 14
_SHAPE = bytes(65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c >= 128 else 48 if 48 <= c < 58 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


_known: dict[bytes, int] = {}


def _at(kind: bytes, token: bytes) -> int:
    """Hash bucket of a token; common ones are remembered (the memory restarts when full)."""
    key = kind + token
    at = _known.get(key)
    if at is None:
        if len(_known) >= 400_000:
            _known.clear()
        folded = _RUN.sub(rb"\1", token) if kind == b"s" else token
        at = _known[key] = zlib.crc32(kind + folded) & ((1 << BITS) - 1)
    return at


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text and their weights: words, the shapes of words (letters, digits and
    repeated signs folded) and how much the text repeats itself; each group has norm 1."""
    idx, val = [], []
    words = text.split()
    low = Counter(text.lower().split())
    groups = [
        (b"w", low, 0.5),
        (b"s", Counter(text.translate(_SHAPE).split()), 1.0),
    ]
    lines = text.split(b"\n")
    n = max(1, len(words))
    groups.append((b"r", Counter([b"d%d" % int(10 * len(low) / n), b"l%d" % int(4 * len(set(lines)) / len(lines)), b"n%d" % min(6, int(np.log2(n)) // 2)]), 0.35))
    for kind, counts, weight in groups:
        if counts:
            v = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
            at = np.fromiter((_at(kind, k) for k in counts), np.int64, len(counts))
            if kind == b"s":  # shapes that fold into one
                at, pos = np.unique(at, return_inverse=True)
                v = np.log1p(np.bincount(pos, np.fromiter(counts.values(), np.float64, len(counts))))
            idx.append(at)
            val.append(v / np.sqrt((v**2).sum()) * weight)
    return np.concatenate(idx), np.concatenate(val)


class VoteModel:
    """The projection to latent space, the labelled vectors in it and their labels."""

    def __init__(self, project: np.ndarray, vectors: np.ndarray, labels: np.ndarray, neighbours: int, prior: float):
        self.project, self.vectors, self.labels, self.k, self.prior = project, vectors, labels, neighbours, prior

    def embed(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.stack([v.astype(np.float32) @ self.project[i] for i, v in rows])
        return out / np.maximum(1e-9, np.sqrt((out**2).sum(1, keepdims=True)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Blocked exact cosines to every labelled vector; the nearest vote with their similarity."""
        sim = x @ self.vectors.T
        k = min(self.k, sim.shape[1])
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.maximum(1e-6, np.take_along_axis(sim, near, 1)) ** 8
        return np.clip((w * self.labels[near]).sum(1) / w.sum(1), 0, 1)


def _blocks(rows, width: int = 2048):
    """The rows' features as dense matrices, ``width`` columns at a time: the whole matrix is never held."""
    for lo in range(0, 1 << BITS, width):
        x = np.zeros((len(rows), width), np.float32)
        for r, (i, v) in enumerate(rows):
            here = (i >= lo) & (i < lo + width)
            np.add.at(x[r], i[here] - lo, v[here].astype(np.float32))
        yield lo, x


def fit(rows, labels, rank: int = 64, neighbours: int = 15) -> VoteModel | None:
    """Latent-semantic analysis of the labelled rows: inverse document frequencies, then the leading singular
    directions, by way of the rows' own products."""
    if not len(rows):
        return None
    labels = np.asarray(labels, np.float64)
    idf = np.zeros(1 << BITS, np.float32)
    own = np.zeros((len(rows), len(rows)), np.float32)
    for lo, x in _blocks(rows):
        part = (np.log((1 + len(rows)) / (1 + (x > 0).sum(0))) + 0.3).astype(np.float32)
        idf[lo : lo + x.shape[1]] = part
        x *= part
        own += x @ x.T
    val, vec = np.linalg.eigh(own)
    del own
    top = np.argsort(-val)[:rank]
    top = top[val[top] > 1e-5]
    to = (vec[:, top] / np.sqrt(val[top])).astype(np.float32)
    del vec
    project = np.zeros((1 << BITS, len(top)), np.float32)
    for lo, x in _blocks(rows):
        part = idf[lo : lo + x.shape[1]]
        project[lo : lo + x.shape[1]] = ((x * part).T @ to) * part[:, None]
    m = VoteModel(project, np.empty((0, len(top)), np.float32), labels, neighbours, float(labels.mean()))
    m.vectors = m.embed(rows)
    return m


def train(docs: DataFrame, labels: DataFrame, sample: int = 2400, most_chars: int = 20_000, mod: int = 5, **kw) -> VoteModel | None:
    """Fit on a bounded sample: of the labelled rows outside the held-out fold whose text has at most ``most_chars``
    characters, the ``sample`` with the lowest hash of their id. A document with several labels takes the largest.

    One task fits the model on these rows, and only the model (some megabytes, whatever the input) reaches the driver.
    """
    known = labels.filter(F.col("quality").isNotNull() & (fold(F.col("doc_id"), mod) != 0)).groupBy("doc_id").agg(F.max("quality").cast("double").alias("quality"))
    short = docs.filter(F.length("text") <= most_chars)
    known = short.select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = short.select("doc_id", text_bytes(F.col("text")).alias("b")).join(F.broadcast(known), "doc_id").select("quality", "b", F.col("doc_id").cast("string").alias("id"))

    def run(batches):
        got = []
        for b in batches:
            got += [(i, t, *features(t), q) for q, t, i in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)]
        got.sort(key=lambda r: r[:2])
        m = fit([(i, v.astype(np.float32)) for _, _, i, v, _ in got[:sample]], [q for *_, q in got[:sample]], **kw)  # ids that repeat in the documents
        if m is not None:
            arrays = [m.project, m.vectors, m.labels]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays] + [pa.array([m.k], pa.int32()), pa.array([m.prior])], names=["project", "vectors", "labels", "k", "prior"])

    # one task for the bounded sample
    found = rows.repartition(1).mapInArrow(run, "project binary, vectors binary, labels binary, k int, prior double").first()
    if found is None:
        return None
    project, vectors = (np.frombuffer(found[c], np.float32).reshape(n, -1) for c, n in (("project", 1 << BITS), ("vectors", len(found["labels"]) // 8)))
    return VoteModel(project, vectors, np.frombuffer(found["labels"], np.float64), found["k"], found["prior"])


def score(docs: DataFrame, model: VoteModel | None, threshold: float = 0.3, keep_only: bool = False) -> DataFrame:
    """``doc_id, score, predicted`` for every whole text (null: empty); with ``keep_only`` the rows of ``docs``
    themselves, all columns, whose score reaches the threshold.

    Without a model every score is 0.5. Null ids and repeated rows are scored like any other, very long texts whole;
    an empty table gives none; other columns are carried only with ``keep_only``, whatever their names. Of neighbours
    tied for the last vote any may vote.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            out = np.full(b.num_rows, 0.5)
            texts = b.column(b.num_columns - 1)
            for s in range(0, b.num_rows if m else 0, 256):
                rows = [features(x.as_py()) for x in texts.slice(s, 256)]
                out[s : s + 256] = m.scores(m.embed(rows))
            if keep_only:
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 1)], names=b.schema.names[:-1]).filter(pa.array(out >= threshold))
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out), pa.array((out >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    if keep_only:
        return docs.select("*", text_bytes(F.col("text")).alias("__bytes")).mapInArrow(run, docs.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_bytes(F.col("text")).alias("b")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")
