"""Removal of long byte strings that occur more than once anywhere in a corpus."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, materialize, remove, text_bytes, tidy
from .packed import COUNTED, add_up, blocks, bucket_bits, by_block, counted, pack, take, unpack



def _splitmix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _splitmix(np.arange(256, dtype=np.uint64))
_BASE = np.uint64(0x5851F42D4C957F2D)
_UNBASE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, 2 * len(_powers[0]), 1 << 14)
        for i, b in enumerate((_BASE, _UNBASE)):
            p = np.full(m, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


class Rolling:
    """Polynomial hashes of any stretch of a byte string in constant time each."""

    def __init__(self, b: np.ndarray):
        self.pow, self.unpow = _grown(len(b) + 1)
        self.sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * self.pow[: len(b)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _splitmix((self.sums[stop] - self.sums[start]) * self.unpow[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _splitmix((self.sums[size:] - self.sums[:n]) * self.unpow[:n])


def _slide(a: np.ndarray, w: int, op) -> np.ndarray:
    """Least or greatest of each ``w`` neighbours."""
    n = len(a)
    pad = np.concatenate([a, np.repeat(a[-1:], -n % w)]).reshape(-1, w)
    ahead = op.accumulate(pad, axis=1).ravel()
    behind = op.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: n - w + 1], ahead[w - 1 : n])


def anchors(b: np.ndarray, length: int, span: int) -> tuple[np.ndarray, np.ndarray, Rolling]:
    """Positions whose gram of ``length - span + 1`` bytes has the least hash of some window of ``length`` bytes,
    and those hashes. Equal windows hold an anchor at the same place."""
    r = Rolling(b)
    h = r.every(length - span + 1)
    low = _slide(h, span, np.minimum)
    # a position is an anchor if it is the least of one of the windows over it
    edge = np.zeros(span - 1, np.uint64)
    best = _slide(np.concatenate([edge, low, edge]), span, np.maximum)
    at = np.flatnonzero(best == h)
    return at, h[at], r


def probe(length: int) -> tuple[int, int]:
    """Size of the strings that the first pass counts and the window of which it takes one. A string of ``length``
    bytes holds several, each with all the windows that may have chosen it."""
    window = max(1, min(64, length // 6))
    return min(192, length - 3 * window + 2), window


def _cut(sizes: np.ndarray, block: int):
    """Ranges of rows that together hold about ``block`` bytes."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // block)) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)], strict=True) if len(sizes) else ()


def _numbers():
    """Block numbers that no other task gives."""
    at = TaskContext.get().partitionId() << 32
    while True:
        yield at
        at += 1


def _strings(gram: int, window: int, digest: bool, size: int):
    """A row per block of texts: their ids and hashes, and the places and hashes of their anchored strings."""

    def run(batches):
        number = _numbers()
        for b in batches:
            for s, e in _cut(pc.binary_length(b.column(1)).to_numpy(), size):
                found, sizes, sha = [], [], []
                for x in b.column(1).slice(s, e - s):
                    raw = x.as_buffer()
                    t = np.frombuffer(raw, np.uint8)
                    sizes.append(len(t))
                    sha.append(hashlib.sha256(raw).hexdigest() if digest else None)
                    found.append(anchors(t, gram + window - 1, window)[:2] if len(t) >= gram + window - 1 else (np.empty(0, np.int64), np.empty(0, np.uint64)))
                at, h = (np.concatenate(x) for x in zip(*found, strict=True))
                lists = [b.column(0).slice(s, e - s), b.column(2).slice(s, e - s), pa.array(sha, pa.string())]
                # anchors have small hashes, which would crowd the first bucket: a one-to-one mix spreads them
                packed = [np.array(sizes, "<i8"), np.array([len(x[0]) for x in found], "<i4"), at.astype("<i4"), _splitmix(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(number)], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, e - s], pa.int32()), a) for a in lists), *(pa.array([pack(x)], pa.binary()) for x in packed)],
                    names=["block", "ids", "texts", "sha", "sizes", "each", "pos", "keys"],
                )

    return run


def _counts(columns: int, bits: int):
    """Rows to be added up of ``columns`` packed key columns; column 0 is the block."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                keys = [unpack(b.column(c)[i].as_buffer(), "<u8") for c in range(1, columns + 1)]
                yield counted(b.column(0)[i].as_py(), [np.unique(k, return_counts=True) for k in keys], bits)

    return run


def regions(size: int, length: int, gram: int, window: int, alone: np.ndarray) -> np.ndarray:
    """``start, stop`` of stretches of a text outside of which no string of ``length`` bytes can occur elsewhere.

    ``alone`` are the places of anchored strings of ``gram`` bytes that occur once. A string of ``length`` bytes that
    holds one of them, with every window that may have chosen it, would have the same anchor elsewhere.
    """
    first = np.maximum(0, np.minimum(size, alone + gram + window - 1) - length)  # of the starts that hold it
    last = np.maximum(0, alone - window + 1)
    first, last = first[first <= last], last[first <= last]
    lo, hi = np.append(0, last + 1), np.append(first - 1, size - length)
    lo, hi = np.maximum.accumulate(lo), np.minimum(hi, size - length)
    lo, hi = lo[lo <= hi], hi[lo <= hi] + length
    if not len(lo):
        return np.empty((0, 2), np.int64)
    apart = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return np.stack([lo[np.append(0, apart)], hi[np.append(apart - 1, len(hi) - 1)]], 1)


def _places(length: int, gram: int, window: int):
    """Per text: how many of its anchored strings other texts hold, and the regions where all of them repeat."""

    def run(batches):
        for _, rows, got in blocks(batches, 9):
            ids, texts, sha, *packed = rows[0]
            sizes, each, pos, keys = (unpack(x.as_buffer(), k) for x, k in zip(packed, ("<i8", "<i4", "<i4", "<u8"), strict=True))
            known, where, n = np.unique(keys, return_inverse=True, return_counts=True)
            total = take(known, n, got.get(1, []))[0][where]
            owner = np.repeat(np.arange(len(each)), each)
            o = np.lexsort((owner, where))
            new = np.flatnonzero((np.diff(where[o], prepend=-1) != 0) | (np.diff(owner[o], prepend=-1) != 0))
            runs = np.diff(np.append(new, len(o)))
            own = np.empty(len(o), np.int64)  # how often the text itself has the string
            own[o] = np.repeat(runs, runs)
            shared = np.bincount(owner[total > own], minlength=len(each))
            spans, ends = [], np.cumsum(each)
            for size, s, e in zip(sizes.tolist(), (ends - each).tolist(), ends.tolist(), strict=True):
                found = regions(size, length, gram, window, pos[s:e][total[s:e] == 1].astype(np.int64)) if size >= length else ()
                spans.append(found.astype("<i4").tobytes() if len(found) else None)
            cols = [ids.values, texts.values, pa.array(sizes, pa.int64()), sha.values, pa.array(shared, pa.int64()), pa.array(spans, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text", "n_bytes", "sha", "n_shared", "spans"])

    return run


def _into_blocks(size: int):
    """Texts with a block number and their place in the block."""

    def run(batches):
        number = _numbers()
        for b in batches:
            for s, e in _cut(pc.binary_length(b.column(0)).to_numpy(), size):
                yield pa.RecordBatch.from_arrays([pa.array([next(number)] * (e - s), pa.int64()), pa.array(np.arange(e - s), pa.int32()), *b.slice(s, e - s).columns], names=["block", "seq", *b.schema.names])

    return run


def _blocked(batches, width: int):
    """(block, its texts by place, its packed rows) of rows ``block, seq, ...`` in order of block; a packed row has no
    place. Both are tuples of the ``width`` columns behind these."""
    now, texts, packed = None, {}, []
    for b in batches:
        block, seq = (b.column(i).to_pylist() for i in (0, 1))
        for i in range(b.num_rows):
            if block[i] != now:
                if texts:
                    yield now, texts, packed
                now, texts, packed = block[i], {}, []
            row = tuple(b.column(c)[i] for c in range(2, 2 + width))
            if seq[i] is None:
                packed.append(row)
            else:
                texts[seq[i]] = row
    if texts:
        yield now, texts, packed


_NODES = "block long, key binary, combo binary, seq binary, pos binary, first binary, start binary, stop binary"


def _nodes(length: int, whole: int, size: int, before: int | None):
    """A row of nodes per block: for an anchor and a range of ``size`` window offsets the hash of the string that all
    its windows share (``key``), and of it with all bytes that they cover (``combo``, from ``start`` to ``stop``).

    Without ``before`` the anchors of the texts' regions are found here; else ranges of ``before`` offsets that are
    still open are cut up.
    """

    def of(t: np.ndarray, at, first):
        if before is None:
            at, _, r = anchors(t, length, whole)
            first = np.zeros(len(at), np.int64)
        else:
            r, step = Rolling(t), np.arange(0, before, size)
            at, first = np.repeat(at, len(step)), (first[:, None] + step).ravel()
        last = first + size - 1
        # the windows that the region has room for
        lo, hi = np.maximum(first, at + length - len(t)), np.minimum(last, at)
        at, first, last, lo, hi = (x[lo <= hi] for x in (at, first, last, lo, hi))
        key = r.of(at - first, at - last + length) + (first * 1009 + size).astype(np.uint64)
        around = r.of(at - hi, at - lo + length) + (lo * 1009 + hi * 1000003).astype(np.uint64)
        return key, _splitmix(key ^ _splitmix(around)), at, first, at - hi, at - lo + length

    def run(batches):
        for block, texts, packed in _blocked(batches, 5):
            out, owners = [], []
            asked = [np.concatenate([unpack(r[c].as_buffer(), "<i4") for r in packed]).astype(np.int64) for c in (2, 3, 4)] if packed else None
            if before is not None and asked is None:
                continue
            if asked:
                o = np.lexsort((asked[1], asked[0]))
                asked = [x[o] for x in asked]
            for seq, (raw, spans, *_) in sorted(texts.items()):
                t = np.frombuffer(raw.as_buffer(), np.uint8)
                for s, e in np.frombuffer(spans.as_buffer(), "<i4").reshape(-1, 2).tolist():
                    at = first = None
                    if before is not None:
                        a, z = np.searchsorted(asked[0], [seq, seq + 1])
                        a, z = a + np.searchsorted(asked[1][a:z], [s, e])
                        if a == z:
                            continue
                        at, first = asked[1][a:z] - s, asked[2][a:z]
                    got = of(t[s:e], at, first)
                    out.append([*got[:2], *(x + d for x, d in zip(got[2:], (s, 0, s, s), strict=True))])
                    owners.append(np.full(len(got[0]), seq))
            if out:
                key, combo, at, first, start, stop = (np.concatenate(x) for x in zip(*out, strict=True))
                ints = [np.concatenate(owners), at, first, start, stop]
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *(pa.array([pack(x)], pa.binary()) for x in (key, combo, *(i.astype("<i4") for i in ints)))], names=[x.split()[0] for x in _NODES.split(", ")])

    return run


_DECIDED = "block long, settled boolean, seq binary, a binary, b binary"


def _decide(batches):
    """A block's settled ranges (``a`` to ``b``) and its open nodes (anchors ``a``, offsets ``b``).

    A node whose shared string occurs once is done: no window of it repeats. One whose surroundings occur twice is
    done too: all its windows repeat; one of each such class stays open as a witness while others share its string.
    """
    for block, rows, got in blocks(batches, 9):
        key, combo = (unpack(x.as_buffer(), "<u8") for x in rows[0][:2])
        seq, pos, first, start, stop = (unpack(x.as_buffer(), "<i4") for x in rows[0][2:])
        known, where, n = np.unique(key, return_inverse=True, return_counts=True)
        in_key = take(known, n, got.get(1, []))[0][where]
        known, at, where, n = np.unique(combo, return_index=True, return_inverse=True, return_counts=True)
        total, owns = take(known, n, got.get(2, []))
        witness = np.zeros(len(combo), bool)
        witness[at[owns]] = True
        same = total[where]
        settled = same > 1
        still = (in_key > 1) & (~settled | (witness & (in_key > same)))
        sides = [(True, settled, start, stop), (False, still, pos, first)]
        rows = [(x, *(pack(v[w]) for v in (seq, a, b))) for x, w, a, b in sides if w.any()]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.int64()), pa.array(cols[0], pa.bool_()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=[x.split()[0] for x in _DECIDED.split(", ")])


def _held(df: DataFrame, keys: str) -> int:
    """How many keys the packed column ``keys`` has in all rows."""
    return int(df.agg(F.sum(F.octet_length(keys).cast("long"))).first()[0] or 0) // 8


def text_key(text: Column) -> Column:
    """What tells texts apart: the MD5 of their bytes."""
    return F.md5(text_bytes(text))


def _with(texts: DataFrame, packed: DataFrame | None) -> DataFrame:
    """Texts (``b``, ``spans``) and packed rows, dealt by block."""
    rows = texts.select("block", "seq", "b", "spans", *[F.lit(None).cast("binary").alias(c) for c in ("w", "x", "y")])
    if packed is not None:
        rows = rows.union(packed.select("block", F.lit(None).cast("int"), F.lit(None).cast("binary"), F.lit(None).cast("binary"), "seq", "a", "b"))
    return rows.repartition("block").sortWithinPartitions("block", "seq")


class Repeats:
    """Byte ranges that together cover every byte of a ``length``-byte string that starts in more than one place.

    First all texts' anchored strings of about half that length are counted. Every window holds several of them, so
    only regions where all of them repeat can hold a window that does. These regions' windows are filed under an
    anchor each, at an offset below ``sizes[0]``; equal windows hold theirs at the same offset. Nodes are ranges of
    offsets at an anchor, cut finer from size to size down to single windows; on each level only nodes go on whose
    windows may or may not repeat. Counts move as packed arrays per block of texts. Equal texts take part once.

    ``places``: ``doc_id, text, n_bytes, sha, n_shared`` of every document (``text``: MD5). ``texts``: ``block, seq,
    text, n, b, spans`` of those texts that have regions (``n``: how many documents have it). ``settled``: the ranges,
    packed by block.
    """

    def __init__(self, docs: DataFrame, length: int, sizes: tuple[int, ...], digest: bool, block: int):
        spark, self.length, self.scratch = docs.sparkSession, length, []
        kind = docs.schema["doc_id"].dataType.simpleString()
        gram, window = probe(length)
        rows = docs.select("doc_id", text_bytes(F.col("text")).alias("b"), text_key(F.col("text")).alias("text"))
        schema = f"block long, ids array<{kind}>, texts array<string>, sha array<string>, sizes binary, each binary, pos binary, keys binary"
        strings = self._keep(rows.mapInArrow(tidy(_strings(gram, window, digest, block)), schema), "strings")
        totals = add_up(strings.select("block", "keys").mapInArrow(tidy(_counts(1, bucket_bits(spark, _held(strings, "keys")))), COUNTED))
        held = strings.select("block", F.lit(0).alias("part"), "ids", "texts", "sha", "sizes", "each", "pos", F.col("keys").alias("own"))
        self.places = self._keep(by_block(totals, held).mapInArrow(tidy(_places(length, gram, window)), f"doc_id {kind}, text string, n_bytes long, sha string, n_shared long, spans binary"), "places")
        order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
        some = self.places.filter("spans IS NOT NULL").groupBy("text").agg(F.count("*").alias("n"), F.min(order).alias("one"), F.first("spans").alias("spans"))
        some = some.select(F.col("text").alias("t"), "n", F.col("one.id").alias("i"), "spans")
        met = rows.join(some, rows["doc_id"].eqNullSafe(some["i"]) & (rows["text"] == some["t"])).select("b", "text", "n", "spans")
        self.texts = self._keep(met.mapInArrow(tidy(_into_blocks(block)), "block long, seq int, b binary, text string, n long, spans binary"), "texts")
        self.settled, left = None, None
        for level, size in enumerate(sizes):
            before = sizes[level - 1] if level else None
            nodes = self._keep(_with(self.texts, left).mapInArrow(tidy(_nodes(length, sizes[0], size, before)), _NODES), "nodes")
            totals = add_up(nodes.select("block", "key", "combo").mapInArrow(tidy(_counts(2, bucket_bits(spark, _held(nodes, "key")))), COUNTED))
            names = [c for c in nodes.columns if c != "block"]
            held = nodes.select("block", F.lit(0).alias("part"), *[F.col(c).alias(f"own_{c}") for c in names])
            decided = self._keep(by_block(totals, held).mapInArrow(tidy(_decide), _DECIDED), "decided")
            left, found = decided.filter("NOT settled"), decided.filter("settled")
            self.settled = found if self.settled is None else self.settled.unionByName(found)

    def _keep(self, df: DataFrame, tag: str) -> DataFrame:
        out, path = materialize(df, tag)
        self.scratch.append(path)
        return out

    def outcome(self, digest: bool) -> DataFrame:
        """Per text that has regions: ``t, n_removed, n_spans, kept`` (the text left, or the SHA-256 of its bytes with ``digest``)."""

        def run(batches):
            for _, texts, packed in _blocked(batches, 7):
                spans = [np.concatenate([unpack(r[c].as_buffer(), "<i4") for r in packed]) if packed else np.empty(0, np.int32) for c in (2, 3, 4)]
                o = np.argsort(spans[0], kind="stable")
                spans = [x[o] for x in spans]
                out = ([], [], [], [])
                for seq, (raw, _, _, _, _, text, n) in texts.items():
                    a, z = np.searchsorted(spans[0], [seq, seq + 1])
                    b = raw.as_buffer().to_pybytes()
                    got = (b"", len(b), 1) if n.as_py() > 1 else _kept(b, spans[1][a:z], spans[2][a:z])
                    for c, v in zip(out, (text.as_py(), got[1], got[2], hashlib.sha256(got[0]).hexdigest() if digest else got[0].decode("utf-8", "ignore")), strict=True):
                        c.append(v)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["t", "n_removed", "n_spans", "kept"])

        rows = self.texts.select("block", "seq", "b", "spans", *[F.lit(None).cast("binary").alias(c) for c in ("w", "x", "y")], "text", "n")
        none = [F.lit(None).cast(k) for k in ("int", "binary", "binary")]
        rows = rows.union(self.settled.select("block", *none, "seq", "a", "b", F.lit(None).cast("string"), F.lit(None).cast("long")))
        done = rows.repartition("block").sortWithinPartitions("block", "seq").mapInArrow(tidy(run), "t string, n_removed long, n_spans long, kept string")
        return materialize(done.dropDuplicates(["t"]), "kept")[0]  # rows that repeat as a whole


def _kept(raw: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many were removed and in how many maximal runs."""
    if not len(start):
        return raw, 0, 0
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, stop, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(docs: DataFrame, length: int = 400, sizes: tuple[int, ...] = (256, 32, 8, 1), report: bool = False, block: int = 1 << 22) -> DataFrame:
    """Remove from every whole text each byte covered by a ``length``-byte string that also starts anywhere else
    in the corpus, in the same text included. All copies go; strings are judged on the input.

    Returns ``docs`` with its columns and ``text`` replaced (a character of which a removed run takes only some
    bytes is dropped whole; ``n_chars`` follows if there is one), or with ``report`` the digest
    ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of the exact bytes left, with ``n_shared``: how many of the
    text's anchored strings (of 192 bytes, for ``length`` 400; one at least in any 255) other documents hold too.

    Null texts are empty in the report and stay null in the table; texts under ``length`` bytes are never
    touched; two rows with the same id and text are two places; rows with a null id take part; an empty table
    gives none. Texts are told apart by MD5, strings by 64-bit hashes. Any column may have any other name.
    """
    spark = docs.sparkSession
    with arrow_batches(spark, block):
        found = Repeats(docs, length, sizes, report, block)
        kept = found.outcome(report)
    if report:
        met = found.places.join(kept, F.col("text") == F.col("t"), "left")
        out = met.select("doc_id", "n_bytes", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")], F.coalesce("kept", "sha").alias("kept_sha256"), "n_shared")
        remove(spark, *[p for p in found.scratch if "/places-" not in p])
        return out
    remove(spark, *found.scratch)
    met = docs.select(F.struct("*").alias("row"), text_key(F.col("text")).alias("key")).join(kept.filter("n_removed > 0"), F.col("key") == F.col("t"), "left")
    text = F.when(F.col("row.text").isNotNull(), F.coalesce("kept", "row.text"))
    new = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return met.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
