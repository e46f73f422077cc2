"""Counts of 64-bit keys over a whole corpus, moved as packed arrays: a row per block and bucket, not one per key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import tidy

COUNTED = "bucket long, block long, keys binary, counts binary"
TOTALS = "block long, part int, bucket int, extra binary, added long, positive long"


def pack(a: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane, so that the shuffle's compression meets runs."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unpack(buf, kind: str) -> np.ndarray:
    raw = np.frombuffer(buf, np.uint8)
    w = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(w, len(raw) // w).T).view(kind).ravel()


def pack_least(a: np.ndarray) -> bytes:
    """Numbers of 0 or more in as few planes as the greatest takes, behind one byte that says how many."""
    wide = a.astype("<u8")
    w = max(1, (int(wide.max(initial=0)).bit_length() + 7) // 8)
    return bytes([w]) + wide.view(np.uint8).reshape(-1, 8)[:, :w].T.tobytes()


def unpack_least(buf) -> np.ndarray:
    raw = np.frombuffer(buf, np.uint8)
    w = int(raw[0])
    out = np.zeros(((len(raw) - 1) // w, 8), np.uint8)
    out[:, :w] = raw[1:].reshape(w, -1).T
    return out.view("<u8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as packed differences."""
    return pack_least(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(buf) -> np.ndarray:
    return np.cumsum(unpack_least(buf), dtype=np.uint64)


def bucket_bits(spark: SparkSession, keys: int = 0, most: int = 1 << 19) -> int:
    """About half as many buckets as the session's partitions (64 at least), and so many that ``keys`` keys in all leave
    about ``most`` to a bucket: a bucket does not grow with the input, and a small block is not cut into more rows than
    it has keys for. Keys must be spread evenly over all 64-bit numbers."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(6, (parts - 1).bit_length() - 1, (keys // most).bit_length())


def counted(block: int, parts: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """Rows of ``COUNTED`` for one block: ``parts`` are kinds of keys (ascending, distinct) with their counts."""
    out = ([], [], [])
    for k, (keys, count) in enumerate(parts, 1):
        cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        for i in np.flatnonzero(np.diff(cuts)):
            s = slice(cuts[i], cuts[i + 1])
            for c, v in zip(out, ((int(i) << 3) + k, pack_keys(keys[s]), pack_least(count[s])), strict=True):
                c.append(v)
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.int64()), pa.array([block] * len(out[0]), pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
        names=["bucket", "block", "keys", "counts"],
    )


def _add(batches):
    """Adds the blocks' counts bucket by bucket. A block gets back a number for each of its keys, in their order, so
    that keys need not be sent: twice what other blocks count, and one more where another block has the key first. A
    row without a block has the sum of the bucket's counts and the number of its keys that count at all."""
    now, held = None, []

    def flush():
        if not held:
            return
        keys = np.concatenate([k for _, k, _ in held])
        count = np.concatenate([c for _, _, c in held]).astype(np.int64)
        block = np.repeat(np.array([b for b, _, _ in held]), [len(k) for _, k, _ in held])
        held.clear()
        o = np.lexsort((block, keys))
        keys, count, block = keys[o], count[o], block[o]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        # rows of one block may come from several batches
        own = np.flatnonzero(new | np.concatenate([[True], block[1:] != block[:-1]]))
        count, block, new = np.add.reduceat(count, own), block[own], new[own]
        total = np.add.reduceat(count, np.flatnonzero(new))
        yield None, now & 7, now >> 3, b"", int(total.sum()), int((total > 0).sum())
        extra = 2 * (total[np.cumsum(new) - 1] - count) + ~new
        at = np.argsort(block, kind="stable")
        edges = np.flatnonzero(np.diff(block[at])) + 1
        for part in np.split(at, edges):
            yield int(block[part[0]]), now & 7, now >> 3, pack_least(extra[part]), 0, 0

    def rows(it):
        got = list(zip(*it, strict=True))
        if got:
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(g, t) for g, t in zip(got, kinds, strict=True)], names=["block", "part", "bucket", "extra", "added", "positive"])

    for b in batches:
        bucket, block = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for i in range(b.num_rows):
            if bucket[i] != now:
                yield from rows(flush())
                now, held = int(bucket[i]), []
            held.append((block[i], unpack_keys(b.column(2)[i].as_buffer()), unpack_least(b.column(3)[i].as_buffer())))
    yield from rows(flush())


def add_up(rows: DataFrame) -> DataFrame:
    """``TOTALS`` of rows of ``COUNTED``: a key met in every document is one number per block."""
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_add), TOTALS)


def take(keys: np.ndarray, count: np.ndarray, got: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Totals of a block's ascending ``keys`` and whether the block is the first to have them. ``got`` are the buckets'
    numbers for these keys; two keys that are equal share one."""
    if not len(keys):
        return count.astype(np.int64), np.ones(0, bool)
    extra = np.concatenate([x for _, x in sorted(got, key=lambda a: a[0])]).astype(np.int64)
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.cumsum(new) - 1
    if len(extra) != at[-1] + 1:
        raise RuntimeError(f"{len(extra)} totals for {at[-1] + 1} keys")
    total = np.add.reduceat(count.astype(np.int64), np.flatnonzero(new)) + (extra >> 1)
    return total[at], (extra & 1 == 0)[at]


def by_block(totals: DataFrame, held: DataFrame) -> DataFrame:
    """``held`` (``block, part`` and more; ``part`` 0) followed by the totals of its block, dealt by block."""
    spare = [F.lit(None).cast(held.schema[c].dataType).alias(c) for c in held.columns if c not in ("block", "part")]
    sent = totals.filter("block IS NOT NULL").select("block", "part", *spare, "bucket", "extra")
    own = held.select("block", "part", *[c for c in held.columns if c not in ("block", "part")], F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("extra"))
    return own.union(sent).repartition("block").sortWithinPartitions("block", "part")


def blocks(batches, width: int):
    """(block, its rows of part 0 as tuples of scalars, its totals by part) for each block of ``by_block``."""
    now, rows, got = None, [], {}
    for b in batches:
        block, part = (b.column(i).to_pylist() for i in (0, 1))
        for i in range(b.num_rows):
            if block[i] != now:
                if rows:
                    yield now, rows, got
                now, rows, got = block[i], [], {}
            if part[i]:
                got.setdefault(part[i], []).append((b.column(width)[i].as_py(), unpack_least(b.column(width + 1)[i].as_buffer())))
            else:
                rows.append(tuple(b.column(c)[i] for c in range(2, width)))
    if rows:
        yield now, rows, got
