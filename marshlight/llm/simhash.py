"""SimHash near-duplicates over a Gray-order hierarchical index."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, remove, text_bytes
from .shingles import Groups, Shingles, signatures

SEED = 42
FAN = 16


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of lower-cased (A-Z) word shingles, repeats included: a bit is 1 if more than half of the
    shingles' XXH64 have it; no word gives zero."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for s in range(0, n, 4096):  # long texts in pieces
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[s : s + 4096], ends[s : s + 4096], strict=False)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, confirm: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, fp2, text_hash`` for every row: the bits of the fingerprint, and of a second one over
    ``confirm`` words where asked for (else 0), as signed longs."""

    def run(batches):
        for b in batches:
            raw = [x.as_buffer().to_pybytes() for x in b.column(1)]
            fps = [np.array([fingerprint(x, n) if n else 0 for x in raw], "<u8").view("<i8") for n in (shingle, confirm)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(f, pa.int64()) for f in fps), b.column(2)], names=["doc_id", "fp", "fp2", "text_hash"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("b"))
    return rows.select("doc_id", "b", F.xxhash64("b").alias("h")).mapInArrow(run, f"doc_id {kind}, fp long, fp2 long, text_hash long")


def tables(differences: int, keep: int) -> list[list[tuple[int, int]]]:
    """Choices of ``keep`` runs of bits, as (shift, width), out of ``differences + keep``: fingerprints that differ
    in no more bits agree on all runs of at least one choice."""
    n = differences + keep
    cuts = [64 * i // n for i in range(n + 1)]
    return [list(c) for c in combinations([(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)], keep)]


def _value(fp: Column, runs: list[tuple[int, int]]) -> Column:
    """The bits of the runs, side by side."""
    out, at = F.lit(0).cast("long"), 0
    for a, w in runs:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << w) - 1)), at))
        at += w
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Fingerprints in Gray order under nodes of ``FAN`` children; a node keeps the bits all its members share
    (mask and pattern), so the differences on them accumulate for the whole group at once."""

    def __init__(self, fps: np.ndarray, order: np.ndarray | None = None):
        self.order = np.argsort(gray_rank(fps), kind="stable") if order is None else order
        self.fps = fps[self.order]
        self.levels = [(np.full(len(fps), ~np.uint64(0)), self.fps)]
        while len(self.levels[-1][0]) > 1:
            mask, pat = self.levels[-1]
            at = np.arange(0, len(mask), FAN)
            both = np.bitwise_and.reduceat(mask, at)
            one, zero = np.bitwise_and.reduceat(pat | ~mask, at), np.bitwise_or.reduceat(pat & mask, at)
            both &= ~(one ^ zero)  # bits on which every member agrees
            self.levels.append((both, zero & both))

    def apart(self, la: int, a: np.ndarray, other: GrayIndex, lb: int, b: np.ndarray) -> np.ndarray | None:
        """Which pairs of nodes are not asked for, where any are not."""
        return None

    def links(self, other: GrayIndex, most: int, batch: int = 1 << 18):
        """Pairs of positions (self, other) that differ in at most ``most`` bits, in batches. Pairs of nodes
        whose shared bits already differ in more are dropped with everything below them."""
        top = max(len(self.levels), len(other.levels)) - 1
        same = self is other
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            lv, a, b = stack.pop()
            if len(a) > batch:
                stack += [(lv, a[:batch], b[:batch]), (lv, a[batch:], b[batch:])]
                continue
            la, lb = min(lv, len(self.levels) - 1), min(lv, len(other.levels) - 1)
            (ma, pa_), (mb, pb) = self.levels[la], other.levels[lb]
            keep = np.bitwise_count((pa_[a] ^ pb[b]) & ma[a] & mb[b]) <= most
            if same:
                keep &= (a < b) if lv == 0 else (a <= b)
            a, b = a[keep], b[keep]
            gone = self.apart(la, a, other, lb, b) if len(a) else None
            if gone is not None:
                a, b = a[~gone], b[~gone]
            if not len(a):
                continue
            if lv == 0:
                yield a, b
                continue
            step = max(1, batch // (FAN * FAN))
            if len(a) > step:  # the others wait as pairs of nodes, so that few of what is below is held at once
                stack.append((lv, a[step:], b[step:]))
            x, y = a[:step], b[:step]
            fx, fy = (FAN if la == lv else 1), (FAN if lb == lv else 1)
            cx = (x[:, None] * fx + np.arange(fx)) if la == lv else x[:, None]
            cy = (y[:, None] * fy + np.arange(fy)) if lb == lv else y[:, None]
            i, j = np.repeat(cx, cy.shape[1], axis=1).ravel(), np.tile(cy, (1, cx.shape[1])).ravel()
            ok = (i < len(self.levels[min(lv - 1, len(self.levels) - 1)][0])) & (j < len(other.levels[min(lv - 1, len(other.levels) - 1)][0]))
            stack.append((lv - 1, i[ok], j[ok]))


def values(fps: np.ndarray, runs: list[tuple[int, int]]) -> np.ndarray:
    """The bits of the runs, side by side."""
    out, at = np.zeros(len(fps), np.uint64), 0
    for a, w in runs:
        out |= ((fps >> np.uint64(a)) & np.uint64((1 << w) - 1)) << np.uint64(at)
        at += w
    return out


class TableIndex(GrayIndex):
    """A Gray index in which members with one value of ``runs`` lie side by side: only these are paired. Nodes whose members
    all have one and the same ``label`` are not paired either."""

    def __init__(self, fps: np.ndarray, runs: list[tuple[int, int]], label: np.ndarray):
        v = values(fps, runs)
        super().__init__(fps, np.lexsort((gray_rank(fps), v)))
        label = label[self.order]
        self.ends = [(v[self.order], v[self.order], label, label)]
        for mask, _ in self.levels[:-1]:
            lo, hi, least, most = self.ends[-1]
            at = np.arange(0, len(mask), FAN)
            self.ends.append((lo[at], np.maximum.reduceat(hi, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    def apart(self, la, a, other, lb, b):
        (lo, hi, least, most), (lo2, hi2, least2, most2) = self.ends[la], other.ends[lb]
        one = least[a]
        return (lo[a] > hi2[b]) | (lo2[b] > hi[a]) | ((one == most[a]) & (one == least2[b]) & (one == most2[b]))


def runs_inside(x: np.ndarray, y: np.ndarray | None, most: int) -> list[list[tuple[int, int]]]:
    """Tables by which two sides' fingerprints (or one side's own) are met with about the fewest steps: few runs leave
    large values, many runs make many tables. The sides' own values tell, so a crowd of like ones is met in few tables."""
    found = []
    for keep in range(4):
        runs = tables(most, keep)
        pairs = 0
        for t in {0, len(runs) // 2, len(runs) - 1}:
            v, n = np.unique(values(x, runs[t]), return_counts=True)
            if y is not None:
                w, m = np.unique(values(y, runs[t]), return_counts=True)
                _, i, j = np.intersect1d(v, w, assume_unique=True, return_indices=True)
                pairs += float((n[i] * m[j]).sum())
            else:
                pairs += float((n * n).sum()) / 2
        each = pairs / len({0, len(runs) // 2, len(runs) - 1})
        found.append((len(runs) * (each + 10 * (len(x) + len(x if y is None else y)) + 30_000), keep, runs))
        if len(x) < 1024 and keep or len(runs) * 30_000 > found[0][0]:
            break
    return min(found)[2]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels (the smallest position of each component) after also linking a to b, and which of these pairs were needed."""
    used, pair = [], np.arange(len(a))
    while len(a):
        ra, rb = label[a], label[b]
        live = ra != rb
        a, b, pair = a[live], b[live], pair[live]
        if not len(a):
            break
        low, high = np.minimum(ra, rb)[live], np.maximum(ra, rb)[live]
        # each component takes one pair that leads to the least other one
        o = np.lexsort((low, high))
        first = o[np.flatnonzero(np.diff(high[o], prepend=-1))]
        label[high[first]] = low[first]
        used.append(pair[first])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label, np.concatenate(used) if used else pair[:0]


def _blocks(most: int, most2: int | None):
    """For each (table, value, cell): the block pair's members, linked; of the pairs that differ little only those that
    connect members not connected before, with ``comp`` as what is known to be connected."""

    def run(batches):
        now, held = None, ([], [])

        def flush():
            left, right = ([np.concatenate([p[i] for p in h]).view("<u8") for i in range(4)] if h else None for h in held)
            if left is None:
                return
            x = GrayIndex(left[1])
            y = GrayIndex(right[1]) if right else x
            node, extra, comp = (left[i][x.order] for i in (0, 2, 3))
            shift = len(node) if right else 0
            if right:
                node, extra, comp = (np.concatenate([old, right[i][y.order]]) for old, i in ((node, 0), (extra, 2), (comp, 3)))
            _, first, where = np.unique(comp, return_index=True, return_inverse=True)
            label = first[where]
            for a, b in x.links(y, most):
                b = b + shift
                if most2 is not None:
                    ok = np.bitwise_count(extra[a] ^ extra[b]) <= most2
                    a, b = a[ok], b[ok]
                label, used = join_labels(label, a, b)
                if len(used):
                    yield pa.RecordBatch.from_arrays([pa.array(node[x[used]].view("<i8"), pa.int64()) for x in (a, b)], names=["a", "b"])

        for b in batches:
            p, v, c, side, node, fp, fp2, comp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            edge = np.flatnonzero((p[1:] != p[:-1]) | (v[1:] != v[:-1]) | (c[1:] != c[:-1])) + 1
            for s, e in zip([0, *edge], [*edge, len(p)], strict=True):
                key = (p[s], v[s], c[s])
                if key != now:
                    yield from flush()
                    now, held = key, ([], [])
                for h in (0, 1):
                    mine = side[s:e] == h
                    if mine.any():
                        held[h].append([z[s:e][mine] for z in (node, fp, fp2, comp)])
        yield from flush()

    return run


def runs_to_keep(most: int, n: int, block: int) -> int:
    """As few shared runs of bits as leave values of about ``block`` members at most among ``n`` fingerprints."""
    keep = 1
    while keep < 4 and n > block << (64 * keep // (most + keep)):
        keep += 1
    return keep


def runs_to_send(most: int, n: int, block: int) -> int:
    """Shared runs of bits with which ``n`` members that meet are sent the fewest times: once for each table, and once more
    for each further block of a value."""
    return min(range(1, 5), key=lambda keep: comb(most + keep, keep) * -(-n // (block << (64 * keep // (most + keep)))))


def link_fingerprints(nodes: DataFrame, most: int = 4, keep: int = 1, most2: int | None = None, block: int = 4096) -> DataFrame:
    """Edges ``a, b`` that connect all of ``node, fp, fp2`` (distinct nodes) linked directly or in steps of at most
    ``most`` differing bits of fp (and ``most2`` of fp2 where given). Each edge is such a pair; their number is linear
    in that of the nodes. Nodes may have a ``comp`` (long): those with the same one count as connected.

    The first level of the index are the values of ``keep`` runs of bits, in as many tables as there are choices
    of runs: two linked fingerprints share a value in one of them. A value's members form one shuffle group. A
    group of more than ``block`` members is cut into sub-blocks by hash, and each pair of sub-blocks is a task
    group of its own, so no group is collected whole. Inside, two Gray-order trees are walked against each other.
    """
    nodes = nodes if "comp" in nodes.columns else nodes.withColumn("comp", F.col("node"))
    cells = in_cells(nodes.select("node", "fp", "fp2", "comp"), most, keep, block)
    return cells.mapInArrow(_blocks(most, most2), "a long, b long")


def in_cells(nodes: DataFrame, most: int, keep: int, block: int, few: bool = False) -> DataFrame:
    """``nodes`` once for each (table, value, cell) in which they meet others: ``p, v, c, side`` and their own columns, one
    cell after another. Where values are ``few`` their sizes are broadcast, so members are sent once, to their cells."""
    own_columns = nodes.columns
    values = F.array(*[_value(F.col("fp"), runs) for runs in tables(most, keep)])
    keyed = nodes.select(*own_columns, F.posexplode(values).alias("p", "v"))
    if "bucket" in own_columns:  # only those of one bucket meet
        keyed = keyed.withColumn("v", F.col("v") + F.shiftleft(F.col("bucket").cast("long"), 40)).drop("bucket")
        own_columns = [c for c in own_columns if c != "bucket"]
    sizes = keyed.groupBy("p", "v").agg(F.count("*").alias("n")).filter("n > 1")
    placed = keyed.join(F.broadcast(sizes) if few else sizes, ["p", "v"]).withColumn("parts", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    # sub-block i meets j >= i in cell i * parts + j, as side 0 and as side 1; cell (i, i) holds one side only
    here, there = F.least(F.col("i"), F.col("j")), F.greatest(F.col("i"), F.col("j"))
    cells = placed.withColumn("i", own).select("p", "v", *own_columns, "i", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    cells = cells.select("p", "v", (here * F.col("parts") + there).alias("c"), F.when(F.col("i") <= F.col("j"), 0).otherwise(1).alias("side"), *own_columns)
    return cells.repartition("p", "v", "c").sortWithinPartitions("p", "v", "c")


def components(edges: DataFrame, rounds: int = 60) -> tuple[DataFrame, list[str]]:
    """``node, root`` for every node of ``edges``: the smallest node it reaches. Labels fall to the least of the
    neighbours and then jump to their label's label, so the rounds grow with the logarithm of a path. Each
    round's table is written to the shared folder. Also returns the path still in use."""
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, edge_path = materialize(both, "edges")
    labels, path = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        # the label's own label, and a hook of the old root to the smaller one
        hook = low.filter("old > root").groupBy(F.col("old").alias("node")).agg(F.min("root").alias("h"))
        low = low.join(hook, "node", "left").select("node", "old", F.least("root", F.coalesce("h", "root")).alias("root"))
        low, mid = materialize(low, "labels")
        jump = low.join(low.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
        new, new_path = materialize(jump.select("node", F.least("root", F.coalesce("up", "root")).alias("root"), "old"), "labels")
        moved = new.filter("root <> old").limit(1).count()
        remove(spark, path, mid)
        labels, path = new.select("node", "root"), new_path
        if not moved:
            remove(spark, edge_path)
            return labels, [path]
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, shingle: int = 4, most: int = 4, keep: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash`` per row: 16 hex digits, the smallest id reachable over
    fingerprints that differ in at most ``most`` bits (its own included), and the text's 64-bit hash.

    ``keep`` trades more tables for smaller groups; unless given it follows the number of fingerprints.

    Null and empty texts have fingerprint zero and link like any other; equal texts share a fingerprint and
    cost one row in the index; rows with a null id take part but never name a component unless all ids are
    null. An empty table gives no rows; other columns are not carried.
    """
    rows, _ = materialize(fingerprints(docs, shingle, None, id_col, text_col).withColumn("node", F.col("fp")), "fp")
    firsts, _ = materialize(rows.groupBy("node", "fp", "fp2").agg(F.min("doc_id").alias("low")), "first")
    keep = keep or runs_to_keep(most, firsts.count(), 4096)
    roots, _ = components(link_fingerprints(firsts.select("node", "fp", "fp2"), most, keep))
    tied = firsts.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    least = tied.groupBy("root").agg(F.min("low").alias("component_id"))
    named = tied.join(least, "root").select("node", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(named, "node").select("doc_id", digits.alias("fingerprint"), "component_id", "text_hash")


def _signed(shingle: int, words: int):
    """Fingerprint, size of the set of word shingles and its MinHash signature, of every row; and the signature's lowest 4
    bits of each number."""

    def run(batches):
        shingles = Shingles(words)
        for b in batches:
            raw = [x.as_buffer().to_pybytes() for x in b.column(1)]
            fps = np.array([fingerprint(x, shingle) for x in raw], "<u8").view("<i8")
            sets = [shingles(x) for x in raw]
            sig = signatures(sets).astype("<u2")
            low = (sig[:, ::2] & 15 | (sig[:, 1::2] & 15) << 4).astype(np.uint8)
            cols = [b.column(0), pa.array(fps), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([x.tobytes() for x in k], pa.binary()) for k in (sig, low)), b.column(2)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "fp", "size", "sig", "low_sig", "text_hash"])

    return run


def _word_sets(words: int):
    def run(batches):
        shingles = Shingles(words)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(x.as_buffer().to_pybytes()).astype("<u8").tobytes() for x in b.column(1)], pa.binary())], names=["node", "set"])

    return run


def _differ(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many numbers of the members' signatures differ: of 16 bits, or of 4 bits where eight bytes hold sixteen."""
    if sig.dtype == np.uint16:
        return (sig[i] != sig[j]).sum(1)
    x = sig[i] ^ sig[j]
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(1)


def _alike(most: int, runs: list, far: int, percent: int, exact: bool):
    """For each (table, value, cell): pairs of texts whose fingerprints differ in at most ``most`` bits, whose signatures
    differ in at most ``far`` numbers and whose sizes let them be alike, each pair in the first table where both meet. Gives
    the members of such pairs, by the lowest bits of their signatures, or, once these have their sets and whole signatures,
    the pairs that are ``exact`` links and join groups.

    Inside a cell further tables of shared runs are walked one after another, each as a Gray index of its own. Pairs of
    which both are asked for, or that are in one group by now, are passed over."""
    masks = lambda told: [np.uint64(sum(((1 << w) - 1) << a for a, w in t)) for t in told]
    sent = masks(runs)

    def work(key, held):
        rows, shift = held[0] + held[1], len(held[0]) if held[1] else 0
        node, fp, size, cls = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 3))
        fp, sig = fp.view("<u8"), np.frombuffer(b"".join(r[4] for r in rows), "<u2" if exact else "<u8").reshape(len(rows), -1)
        groups = Groups([np.frombuffer(r[5], "<u8") for r in rows], percent) if exact else None
        asked = np.zeros(len(rows), bool)
        inner = runs_inside(fp[:shift] if shift else fp, fp[shift:] if shift else None, most)
        first = masks(inner)
        for t, own in enumerate(inner):
            label = groups.label if exact else np.where(asked, -1, np.arange(len(rows)))
            x = TableIndex(fp[:shift] if shift else fp, own, label[:shift] if shift else label)
            y = TableIndex(fp[shift:], own, label[shift:]) if shift else x
            for a, b in x.links(y, most):
                a, b = x.order[a], y.order[b] + shift
                ok = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
                ok &= np.minimum(cls[a], cls[b]) == key[1] >> 40
                ok &= (groups.label[a] != groups.label[b]) if exact else ~(asked[a] & asked[b])
                for m in [*sent[: key[0]], *first[:t]]:
                    a, b = a[ok], b[ok]
                    if not len(a):
                        break
                    ok = ((fp[a] ^ fp[b]) & m) != 0
                a, b = (a[ok], b[ok]) if len(a) else (a, b)
                for s in range(0, len(a), 65536):
                    i, j = a[s : s + 65536], b[s : s + 65536]
                    if not exact:
                        new = ~(asked[i] & asked[j])
                        i, j = i[new], j[new]
                    differ = _differ(sig, i, j)
                    near = differ <= far
                    if exact:
                        found = list(groups.join(i[near], j[near], differ[near]))
                        if found:
                            yield pa.RecordBatch.from_arrays([pa.array(node[list(e)]) for e in zip(*found, strict=True)], names=["a", "b"])
                    else:
                        asked[i[near]] = asked[j[near]] = True
        if asked.any():
            at = np.flatnonzero(asked)
            keys = [pa.array([k] * len(at), t) for k, t in zip(key, (pa.int32(), pa.int64(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array((at >= shift if shift else np.zeros(len(at))).astype(np.int32)), pa.array(node[at])], names=["p", "v", "c", "side", "node"])

    def run(batches):
        now, held = None, ([], [])
        for batch in batches:
            for p, v, c, side, *row in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if (p, v, c) != now:
                    if held[0]:
                        yield from work(now, held)
                    now, held = (p, v, c), ([], [])
                held[side].append(row)
        if held[0]:
            yield from work(now, held)

    return run


def similar_texts(docs: DataFrame, shingle: int = 2, most: int = 11, keep: int | None = None, words: int = 5, percent: int = 80, far: int = 17, block: int = 32768, small: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """Texts (``text_hash, low``: the least (has no id, id) of their rows) and ``node, root`` of those that are linked
    to others: by steps between texts whose sets of ``words``-word shingles are alike to ``percent`` in a hundred or more.

    The Gray-order index over fingerprints of ``shingle`` words finds the pairs within ``most`` bits. Nodes carry MinHash
    signatures of 32 numbers, which tell candidates apart where they meet (``far``: one pair in a hundred thousand that are
    alike to 0.8 differs in more); the index is sent only the lowest 4 bits of each. Members that have a candidate in a cell of the index are sent there once more with their
    whole sets; every candidate pair is compared on these, unless confirmed links have joined the two already, and only
    links that join groups leave the task. So no candidate is passed over for another and no pairs of a group are listed.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_bytes(F.col("text")).alias("b")).withColumn("text_hash", F.xxhash64("b"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints, prints_path = materialize(rows.mapInArrow(_signed(shingle, words), f"doc_id {kind}, fp long, size long, sig binary, low_sig binary, text_hash long"), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    texts, _ = materialize(prints.groupBy("text_hash").agg(F.min(order).alias("low"), *[F.first(c).alias(c) for c in ("fp", "size", "sig", "low_sig")]), "first")
    old = [prints_path]

    def kept(df: DataFrame, tag: str) -> DataFrame:
        out, path = materialize(df, tag)
        old.append(path)
        return out

    # texts without words are alike, and equal to nothing else: they take no part in the index
    empty = texts.filter("size = 0").select(F.col("text_hash").alias("b"))
    bare = empty.select(F.lit(empty.agg(F.min("b")).first()[0]).cast("long").alias("a"), "b").filter("a <> b")
    nodes = texts.filter("size > 0").select(F.col("text_hash").alias("node"), "fp", "size", "sig", "low_sig")
    # sets alike to 0.8 have sizes of one class or of two neighbouring ones (classes grow by more than 1 / 0.8)
    classed = nodes.withColumn("cls", F.floor(F.log("size") / F.log(F.lit(104.0 / percent))).cast("int") + 1)
    both = classed.withColumn("bucket", F.explode(F.array(F.col("cls") - 1, F.col("cls"))))
    keep = keep or runs_to_send(most, both.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0, block)
    how = (most, tables(most, keep), far, percent)
    # one run has a few dozen values in each of as many classes
    cells = in_cells(both.select("node", "fp", "size", "cls", "low_sig", "bucket"), most, keep, block, few=keep == 1)
    met = kept(cells.mapInArrow(_alike(*how, False), "p int, v long, c int, side int, node long"), "met")
    used = kept(met.select("node").distinct().join(texts, F.col("node") == F.col("text_hash")).select(F.col("node").alias("h"), F.col("low.id").alias("i")), "used")
    # texts stay where they are while the list of those asked for is small; beyond that both are shuffled
    asked = F.broadcast(used) if used.count() <= small else used
    own = rows.join(asked, (F.col("text_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_semi")
    sets = kept(own.select("text_hash", "b").mapInArrow(_word_sets(words), "node long, set binary").dropDuplicates(["node"]), "sets")
    whole = met.join(classed, "node").join(sets, "node").select("p", "v", "c", "side", "node", "fp", "size", "cls", "sig", "set")
    whole = whole.repartition("p", "v", "c").sortWithinPartitions("p", "v", "c", "side")
    links = kept(whole.mapInArrow(_alike(*how, True), "a long, b long"), "links")
    roots, _ = components(links.union(bare))
    remove(spark, *old)
    return texts.select("text_hash", "low"), roots


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays from each group of ``similar_texts``: that with the smallest
    id (null ids last; then the smallest hash of the text), once where rows repeat.

    Texts without words are alike; null texts count as empty; an empty table gives none.
    """
    texts, roots = similar_texts(docs, **how)
    tied = texts.join(roots, F.col("text_hash") == F.col("node"), "left").select("text_hash", "low", F.coalesce("root", "text_hash").alias("root"))
    stay = tied.groupBy("root").agg(F.min(F.struct("low.none", "low.id", "text_hash")).alias("at")).select(F.col("at.id").alias("i"), F.col("at.text_hash").alias("h"))
    # rows are sent once: the join and the numbering take the same keys, which are plain and not null
    none, key = (lambda k: k.isNull()), (lambda k: F.coalesce(k.cast("string"), F.lit("")))
    full = docs.select(F.struct("*").alias("row"), F.xxhash64(text_bytes(F.col("text"))).alias("h"), none(F.col("doc_id")).alias("none"), key(F.col("doc_id")).alias("i"))
    met = full.join(stay.select("h", none(F.col("i")).alias("none"), key(F.col("i")).alias("i")), ["none", "i", "h"], "left_semi")
    once = Window.partitionBy("none", "i", "h").orderBy("h")
    return met.withColumn("n", F.row_number().over(once)).filter("n = 1").select("row.*")
