"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove, text_bytes
from .shingles import LANES, ODD, Groups, Shingles, mix, signatures
from .simhash import components

CHUNK = 4  # numbers of 16 bits in each chunk of a signature
WIDE = 128  # numbers of 8 bits in the signature that tells candidates apart


def patterns(sig: np.ndarray) -> np.ndarray:
    """Index keys of signatures: for every chunk and every one of its lanes that may be wrong, a hash of the chunk's
    other lanes. Two signatures that differ in fewer than two lanes a chunk (so in at most 2 * chunks - 1 altogether, of
    which one chunk must hold one at most) share a key."""
    keys = []
    for c in range(0, LANES, CHUNK):
        for wrong in range(CHUNK):
            h = np.full(len(sig), c + wrong + 1, np.uint64)
            for k in range(CHUNK):
                if k != wrong:
                    h = mix(h * ODD + sig[:, c + k].astype(np.uint64))
            keys.append(h)
    return np.array(keys).T.view(np.int64)


def _prints(words: int):
    def run(batches):
        import xxhash

        shingles = Shingles(words)
        for b in batches:
            sets = [shingles(x.as_buffer().to_pybytes()) for x in b.column(1)]
            node = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            sig = signatures(sets).astype("<u2")
            cols = [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array([x.tobytes() for x in sig], pa.binary()), b.column(2)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "size", "node", "sig", "text_hash"])

    return run


def _sets(words: int):
    def run(batches):
        import xxhash

        shingles = Shingles(words)
        for b in batches:
            sets = [shingles(x.as_buffer().to_pybytes()) for x in b.column(0)]
            raw = [s.astype("<u8").tobytes() for s in sets]
            sig, wide = [x.tobytes() for x in signatures(sets).astype("<u2")], [x.tobytes() for x in signatures(sets, WIDE, 8)]
            node, raw, sig, wide = (pa.array(x, pa.binary()) for x in ([xxhash.xxh3_128_digest(s) for s in raw], raw, sig, wide))
            yield pa.RecordBatch.from_arrays([node, raw, pa.array([len(s) for s in sets], pa.int64()), sig, wide], names=["node", "set", "size", "sig", "wide"])

    return run


def _keys(batches):
    for b in batches:
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, LANES)
        keys = patterns(sig)
        n = keys.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(sig))), b.column(0).take(pa.array(np.repeat(np.arange(len(sig)), n)))], names=["key", "p", "node"])


def _meet(percent: int, far: int, exact: bool, wide: int = 1 << 20):
    """For each (key, cell): pairs of members whose wide signatures differ in at most ``far`` numbers and whose sizes let
    them be alike, each pair in the first key that both share. Gives the members of such pairs (``node``, with their
    ``side``), or, once these have their sets, the pairs that are ``exact`` links and join groups."""

    def candidates(left, right, p, same):
        size, sig, more = left
        step = max(1, wide // max(1, len(right[0])))
        for s in range(0, len(size), step):
            differ = (more[s : s + step, None, :] != right[2][None, :, :]).sum(2)
            x, y = size[s : s + step, None], right[0][None, :]
            ok = (differ <= far) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
            if same:
                ok &= np.arange(s, s + len(differ))[:, None] < np.arange(len(right[0]))[None, :]
            i, j = np.nonzero(ok)
            # the first chunk with one wrong number at most, and in it the first that may be the wrong one
            wrong = (sig[s + i] != right[1][j]).reshape(-1, LANES // CHUNK, CHUNK)
            chunk = (wrong.sum(2) <= 1).argmax(1)
            mine = chunk * CHUNK + wrong[np.arange(len(i)), chunk].argmax(1) == p
            yield s + i[mine], j[mine], differ[i[mine], j[mine]]

    def work(key, held):
        arrays = [(np.array([r[1] for r in h]), np.frombuffer(b"".join(r[2] for r in h), "<u2").reshape(-1, LANES), np.frombuffer(b"".join(r[3] for r in h), np.uint8).reshape(-1, WIDE)) for h in held if h]
        nodes = [r[0] for h in held for r in h]
        shift = len(held[0]) if held[1] else 0
        groups = Groups([np.frombuffer(r[4], "<u8") for h in held for r in h], percent) if exact else None
        asked = np.zeros(len(nodes), bool)
        for i, j, differ in candidates(arrays[0], arrays[-1], key[2], len(arrays) == 1):
            if exact:
                found = list(groups.join(i, j + shift, differ))
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([nodes[x] for x in e], pa.binary()) for e in (a, b)], names=["a", "b"])
            else:
                asked[i] = asked[j + shift] = True
        if asked.any():
            at = np.flatnonzero(asked)
            keys = [pa.array([k] * len(at), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array((at >= shift if shift else np.zeros(len(at))).astype(np.int32)), pa.array([nodes[x] for x in at], pa.binary())], names=["key", "cell", "p", "side", "node"])

    def run(batches):
        now, held = None, ([], [])
        for b in batches:
            for key, cell, p, side, *row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (key, cell, p) != now:
                    if held[0]:
                        yield from work(now, held)
                    now, held = (key, cell, p), ([], [])
                held[side].append(row)
        if held[0]:
            yield from work(now, held)

    return run


class _Scratch:
    """Tables of one run, deleted when no later step reads them."""

    def __init__(self, spark):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        out, path = materialize(df, tag)
        self.paths.append(path)
        return out

    def clear(self) -> None:
        remove(self.spark, *self.paths)


def _cells(members: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Members of keys with more than one, keys being cut into pairs of blocks of about ``block`` members, so that no key
    is collected whole."""
    told = members.withColumn("parts", F.ceil(F.col("n") / block).cast("int")).join(sets.select("node", "size", "sig", "wide"), "node")
    i, j, parts = F.col("i"), F.col("j"), F.col("parts")
    told = told.withColumn("i", F.pmod(F.xxhash64("node"), parts).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), parts - 1)))
    cells = told.select("key", (F.least(i, j) * parts + F.greatest(i, j)).alias("cell"), "p", F.when(i <= j, 0).otherwise(1).alias("side"), "node", "size", "sig", "wide")
    return cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "p", "side")


def link_sets(docs: DataFrame, words: int = 4, percent: int = 80, far: int = 50, block: int = 2048, small: int = 500_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (``doc_id, size, node``; ``node`` is a hash of the row's set of word shingles, null for an empty one), the
    distinct sets (``node, low``: the least id) and ``node, root`` of the sets that are linked to others.

    **Index.** A signature is 32 numbers of 16 bits, cut into 8 chunks. Two sets are candidates if some chunk has one
    wrong number at most: the allowed errors of a chunk are enumerated as keys, one for each number that may be wrong. By
    pigeonhole, all pairs that differ in 15 numbers or fewer are found. Sets alike to 0.8 differ in 6.4 on average; one
    in a million such pairs shares no key. Wide signatures (128 numbers of 8 bits) tell candidates apart: one in a million
    pairs alike to 0.8 differs in more than ``far``.

    **Links.** Members that have a candidate in a key are sent there once more with their full sets. There every candidate
    pair is compared on the full sets, unless confirmed links have joined the two already, and only links that
    join groups leave the task. So no link is lost and no pairs of a group are listed. Keys with many members are cut
    into pairs of blocks, and a pair is looked at in the first key that it shares.
    """
    spark, s = docs.sparkSession, _Scratch(docs.sparkSession)
    rows = docs.select("doc_id", text_bytes(F.col("text")).alias("b")).select("doc_id", "b", F.xxhash64("b").alias("text_hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints, _ = materialize(rows.mapInArrow(_prints(words), f"doc_id {kind}, size long, node binary, sig binary, text_hash long"), "prints")
    one = F.min(F.struct("text_hash", "doc_id")).alias("one")
    nodes, _ = materialize(prints.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"), one, F.first("size").alias("size"), F.first("sig").alias("sig")), "nodes")
    keyed = nodes.select("node", "sig").mapInArrow(_keys, "key long, p int, node binary")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("key", "k")
    members = s.keep(keyed.join(shared, F.col("key") == F.col("k")).select("key", "p", "node", "n"), "members")
    used = members.select("node").distinct().join(nodes, "node").select("one.*").withColumnsRenamed({"text_hash": "h", "doc_id": "i"})
    used = s.keep(used, "used")
    # texts stay where they are while the list of those asked for is small; beyond that both are shuffled
    asked = F.broadcast(used) if used.count() <= small else used
    texts = rows.join(asked, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_semi").select("b")
    sets = s.keep(texts.mapInArrow(_sets(words), "node binary, set binary, size long, sig binary, wide binary").dropDuplicates(["node"]), "sets")
    met = s.keep(_cells(members, sets, block).mapInArrow(_meet(percent, far, False), "key long, cell int, p int, side int, node binary"), "met")
    whole = met.join(sets, "node").select("key", "cell", "p", "side", "node", "size", "sig", "wide", "set")
    whole = whole.repartition("key", "cell").sortWithinPartitions("key", "cell", "p", "side")
    links = s.keep(whole.mapInArrow(_meet(percent, far, True), "a binary, b binary"), "links")
    roots, _ = components(links)
    s.clear()
    return prints.select("doc_id", "size", "node"), nodes.select("node", "low"), roots


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row: the size of the set of word shingles, the smallest id reachable
    over pairs of sets that share at least ``percent`` in a hundred of all their shingles, and whether it is the row's.

    Null texts and texts without words have no shingles and are linked with nothing, not even each other; equal sets
    are one node; rows with a null id take part but name a component only where no other row does (null); repeated rows
    give repeated rows; an empty table gives none; other columns are not carried. Texts of any length are taken whole.
    Shingles are told apart by 64-bit hashes, sets by 128-bit ones.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows, nodes, roots = link_sets(docs, words, percent, **how)
    tied = nodes.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    least = tied.groupBy("root").agg(F.min("low").alias("least"))
    named = tied.join(least, "root").select(F.col("node").alias("_node"), "least")
    filled = rows.filter("node IS NOT NULL").join(named, F.col("node") == F.col("_node")).select("doc_id", F.col("size").alias("n_shingles"), F.col("least").alias("component_id"))
    bare = rows.filter("node IS NULL").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return filled.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
