"""Alignment of two tokenizers' tokens by merging their ends along cut-up merge paths."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove, text_bytes
from .packed import pack_least, unpack_least
from .pieces import SPACE


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a printable byte is its own character, the others
    are the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or (b >= 161 and b != 173)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Both tokenizers: ids of texts and the bytes of every id."""

    def __init__(self, a_json: str, b_model: bytes, pattern: str):
        import sentencepiece

        spec = json.loads(a_json)
        letters = byte_alphabet()
        vocab = spec["model"]["vocab"]
        special = {t["content"] for t in spec.get("added_tokens", ())}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = t.encode() if t in special else bytes(letters[c] for c in t)
        made = [vocab["".join(m.split(" ", 1) if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        self.encode_a = self._ranked(vocab, special, pattern) if made == sorted(made) else self._listed(a_json)
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        size = self.sp.get_piece_size()
        self.b_bytes = [bytes([int(self.sp.id_to_piece(i)[1:-1], 16)]) if self.sp.is_byte(i) else self.sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.said = [f"{i}{end}".encode() for end in ",|;" for i in range(max(len(self.a_bytes), size))]

    def _ranked(self, vocab, special, pattern):
        """Ids follow the order of the merges, so they are ranks."""
        import tiktoken

        ranks = {self.a_bytes[i]: i for t, i in vocab.items() if t not in special}
        coder = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [coder.encode_ordinary(t) for t in texts]

    @staticmethod
    def _listed(a_json):
        from tokenizers import Tokenizer

        coder = Tokenizer.from_str(a_json)
        coder.encode_special_tokens = True
        return lambda texts: [e.ids for e in coder.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]):
        """(ids of A, ids of B) of each text; none where the tokens' bytes are not those of the text behind a space."""
        for t, a, b in zip(texts, self.encode_a([" " + t for t in texts]), self.sp.encode(texts, num_threads=1), strict=True):
            whole = b" " + t.encode()
            same = bool(t) and all(b"".join(map(x.__getitem__, ids)) == whole for x, ids in ((self.a_bytes, a), (self.b_bytes, b)))
            yield (np.array(x if same else (), np.int32) for x in (a, b))


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two ascending lists of ends crosses every ``work``-th diagonal: how many of each list lie
    before. Found by binary search on the diagonals, all at once. An end of both lists lies on one side."""
    d = np.arange(work, len(a) + len(b), work)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        mid = (low + high) // 2
        ahead = (low < high) & (a[np.minimum(mid, len(a) - 1)] <= b[np.maximum(d - 1 - mid, 0)])
        low, high = np.where(ahead, mid + 1, low), np.where(ahead | (low >= high), high, mid)
    i, j = low, d - low
    j = j + ((i > 0) & (j < len(b)) & (a[np.maximum(i - 1, 0)] == b[np.minimum(j, len(b) - 1)]))
    return np.concatenate([[0], i, [len(a)]]), np.concatenate([[0], j, [len(b)]])


def merge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of each list lie up to each end that both have."""
    common = np.intersect1d(a, b, assume_unique=True)
    return np.searchsorted(a, common, "right"), np.searchsorted(b, common, "right")


def links(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, width: int, large: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (A id * width + B id) that share a group, and how many pairs of occurrences each has. ``ca`` and
    ``cb`` are the tokens up to the end of each group. Groups of over ``large`` pairs count their ids first."""
    na, nb = np.diff(ca, prepend=0), np.diff(cb, prepend=0)
    big = na * nb > large
    ga = np.repeat(np.arange(len(ca)), na)  # group of each token of A
    ga = ga[~big[ga]] if big.any() else ga
    mine = a[: len(ga)] if not big.any() else a[: int(ca[-1])][~np.repeat(big, na)]
    times = nb[ga]
    ends = np.cumsum(times)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times) + np.repeat((cb - nb)[ga], times)
    keys, count = np.unique(np.repeat(mine.astype(np.int64), times) * width + b[at], return_counts=True)
    parts = [(keys, count)]
    for g in np.flatnonzero(big):
        x, nx = np.unique(a[ca[g] - na[g] : ca[g]], return_counts=True)
        y, ny = np.unique(b[cb[g] - nb[g] : cb[g]], return_counts=True)
        parts.append(((x.astype(np.int64)[:, None] * width + y[None, :]).ravel(), (nx[:, None] * ny[None, :]).ravel()))
    return total(parts)


def total(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of ascending distinct keys, added over parts."""
    if len(parts) == 1:
        return parts[0]
    keys, where = np.unique(np.concatenate([k for k, _ in parts]) if parts else np.empty(0, np.int64), return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, where, np.concatenate([c for _, c in parts]) if parts else np.empty(0, np.int64))
    return keys, out


def groups_text(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray, said: list[bytes]) -> bytes:
    """``a1,a2|b1;a3|b2;``: each group's ids of A, then of B, in order."""
    v = len(said) // 3
    a, b = a[: ca[-1]] if len(ca) else a[:0], b[: cb[-1]] if len(cb) else b[:0]
    na, nb = np.diff(ca, prepend=0), np.diff(cb, prepend=0)
    code = np.empty(len(a) + len(b), np.int64)
    ends = np.zeros(len(a), np.int64)
    ends[ca - 1] = v
    code[np.arange(len(a)) + np.repeat(cb - nb, na)] = a + ends
    ends = np.zeros(len(b), np.int64)
    ends[cb - 1] = 2 * v
    code[np.arange(len(b)) + np.repeat(ca, nb)] = b + ends
    return b"".join(map(said.__getitem__, code.tolist()))


#: Kinds of rows: a document (0), a block's distinct pairs (1), a piece of a long document (2).
_ROWS = "block long, kind int, doc_id {}, n_a long, n_b long, n_groups long, n_links long, sha string, at binary, times binary, piece int, a binary, b binary, pairs array<long>, held array<int>"


class _Block:
    """Documents of one block: the block's distinct pairs once, with how many of its documents hold each; a document
    refers to them by place."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.rows, self.keys, self.weight = kind, [], [], 0

    def add(self, doc_id, n_a, n_b, n_groups, sha, keys, times):
        self.rows.append((doc_id, n_a, n_b, n_groups, int(times.sum()), sha, times))
        self.keys.append(keys)
        self.weight += n_a + n_b + 16

    def take(self, block: int):
        """The rows of the block, and an empty block again."""
        rows, keys = self.rows, self.keys
        self.rows, self.keys, self.weight = [], [], 0
        if not rows:
            return
        flat = np.concatenate(keys)
        pairs, where, held = np.unique(flat, return_inverse=True, return_counts=True)
        where = np.split(where, np.cumsum([len(k) for k in keys])[:-1])
        at = [pack_least(np.diff(w, prepend=0)) for w in where]
        out = [(block, 0, *r[:6], p, pack_least(r[6]), None, None, None, None, None) for r, p in zip(rows, at, strict=True)]
        yield _batch([*out, (block, 1, *[None] * 11, pairs, held)], self.kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    long, text, raw, small = pa.int64(), pa.string(), pa.binary(), pa.int32()
    kinds = [long, small, kind, long, long, long, long, text, raw, raw, small, raw, raw, pa.list_(long), pa.list_(small)]
    names = [x.split()[0] for x in _ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _encoder(a_json: str, b_model: bytes, pattern: str, work: int, block: int):
    def run(batches):
        tokens, kind, done = Tokens(a_json, b_model, pattern), None, 0
        first, width = TaskContext.get().partitionId() << 32, len(tokens.b_bytes)
        held = None
        for batch in batches:
            kind = batch.column(0).type
            held = held or _Block(kind)
            ids = batch.column(0)
            size = np.cumsum([len(x.as_buffer()) for x in batch.column(1)])
            for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(size // (1 << 20))) + 1):
                texts = [batch.column(1)[int(i)].as_py().decode("utf-8", "replace") for i in part]
                for i, (a, b) in zip(part, tokens.encode(texts), strict=True):
                    ends = np.cumsum(tokens.a_size[a]), np.cumsum(tokens.b_size[b])
                    ia, ib = diagonals(*ends, work)
                    if len(ia) > 2:  # long: its pieces are dealt out
                        done += 1
                        for p in range(len(ia) - 1):
                            x, y = a[ia[p] : ia[p + 1]], b[ib[p] : ib[p + 1]]
                            start = [int(e[k[p] - 1]) if k[p] else 0 for e, k in zip(ends, (ia, ib), strict=True)]
                            head = (first + done, 2, ids[int(i)].as_py(), start[0], start[1], len(ia) - 1, None, None, None, None, p)
                            yield _batch([(*head, x.astype("<i4").tobytes(), y.astype("<i4").tobytes(), None, None)], kind)
                        continue
                    ca, cb = merge(*ends)
                    keys, times = links(a, b, ca, cb, width)
                    sha = hashlib.sha256(groups_text(a, b, ca, cb, tokens.said)[:-1]).hexdigest() if len(a) else ""
                    held.add(ids[int(i)].as_py(), len(a), len(b), len(ca), sha, keys, times)
                    if held.weight >= block:
                        done += 1
                        yield from held.take(first + done)
        if held:
            yield from held.take(first + done + 1)

    return run


_PIECE = "block long, piece int, n int, doc_id {}, n_a long, n_b long, closed boolean, head_a binary, head_b binary, tail_a binary, tail_b binary, n_groups long, keys array<long>, times array<long>, said binary"


def _merger(a_json: str, b_model: bytes, pattern: str):
    """Of each piece: the groups that begin and end in it, and the tokens before and behind them."""

    def run(batches):
        tokens = Tokens(a_json, b_model, pattern)
        width = len(tokens.b_bytes)
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[k], "<i4") for k in ("a", "b"))
                ca, cb = merge(r["n_a"] + np.cumsum(tokens.a_size[a]), r["n_b"] + np.cumsum(tokens.b_size[b]))
                # the first common end closes a group that may have begun before the piece
                i, j, k, m = (int(ca[0]), int(cb[0]), int(ca[-1]), int(cb[-1])) if len(ca) else (len(a), len(b), len(a), len(b))
                x, y, cx, cy = a[i:k], b[j:m], ca[1:] - i, cb[1:] - j
                keys, times = links(x, y, cx, cy, width)
                ends = [v.astype("<i4").tobytes() for v in (a[:i], b[:j], a[k:], b[m:])]
                row = (r["block"], r["piece"], r["n_groups"], r["doc_id"], len(a), len(b), bool(len(ca)), *ends, len(cx), keys, times, groups_text(x, y, cx, cy, tokens.said))
                yield pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in _PIECE.split(", ")], row, strict=True))], schema=_piece_schema(batch.schema.field("doc_id").type))

    return run


def _piece_schema(kind: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "{}": kind, "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _PIECE.split(", ")])


def _stitcher(a_json: str, b_model: bytes, pattern: str):
    """A long document from its pieces: what lies behind a piece's last group and before the next one's first is a group."""
    tokens = None

    def run(table: pa.Table) -> pa.Table:
        nonlocal tokens
        tokens = tokens or Tokens(a_json, b_model, pattern)
        width = len(tokens.b_bytes)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        if [r["piece"] for r in rows] != list(range(rows[0]["n"])):
            raise RuntimeError(f"pieces {[r['piece'] for r in rows]} of {rows[0]['n']}")
        digest, parts, n, last = hashlib.sha256(), [], 0, b""
        wait: list[list[np.ndarray]] = [[], []]
        for r in rows:
            head = [np.frombuffer(r[k], "<i4") for k in ("head_a", "head_b")]
            for w, h in zip(wait, head, strict=True):
                w.append(h)
            if not r["closed"]:
                continue
            a, b = (np.concatenate(w) for w in wait)
            ends = np.array([len(a)]), np.array([len(b)])
            parts += [links(a, b, *ends, width), (np.array(r["keys"], np.int64), np.array(r["times"], np.int64))]
            for text in (groups_text(a, b, *ends, tokens.said), r["said"]):
                digest.update(last + text[:-1] if text else b"")
                last = b";" if text else last
            n += 1 + r["n_groups"]
            wait = [[np.frombuffer(r[k], "<i4")] for k in ("tail_a", "tail_b")]
        if any(len(x) for w in wait for x in w):
            raise RuntimeError("tokens behind the last common end")
        kind = table.schema.field("doc_id").type
        out = _Block(kind)
        out.add(rows[0]["doc_id"], sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows), n, digest.hexdigest(), *total(parts))
        return pa.Table.from_batches(list(out.take(-1 - rows[0]["block"])))

    return run


def _finish(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Documents of one block with the corpus' counts of their pairs."""
    pairs = pairs.sort_by("at")
    count, best = (pairs.column(k).to_numpy() for k in ("count", "best"))
    n_best, added = [], []
    for at, times in zip(docs.column("at"), docs.column("times"), strict=True):
        at, times = (unpack_least(x.as_buffer()).astype(np.int64) for x in (at, times))
        at = np.cumsum(at)
        n_best.append(int(times[best[at].astype(bool)].sum()))
        added.append(int((times * count[at]).sum()))
    return docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(added, pa.int64())).append_column("groups_sha256", docs.column("sha"))


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, work: int = 1 << 15, block: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every whole text: how a byte-level
    vocabulary (A, over a space and the text) and a SentencePiece model (B) cut the same bytes.

    The ends of A's and B's tokens are merged along their merge path. Binary searches on its diagonals cut a document of
    over ``work`` ends into pieces of equal work, which are dealt out as rows of their own; each gives the groups inside
    it, and what lies between two pieces' groups is stitched. Shorter documents are one piece and stay in their task.

    Pairs of ids that share a group are counted once per document over the corpus. Documents lie in blocks of about
    ``block`` tokens: a block sends each of its distinct pairs once, gets back the corpus' count and whether that is its
    A id's highest, and its documents refer to the pairs by place. The highest counts are one row per id of A.

    Null and empty texts, and texts that a tokenizer changes, have no tokens: zeros and an empty digest. Ids that are
    null or repeat give rows like any other; repeated rows count as documents of their own; ties for the highest count
    all count; an empty table gives none; other columns are not carried. A group with very many tokens needs the
    memory of its distinct pairs.
    """
    spark = docs.sparkSession
    with open(a_path) as f, open(b_path, "rb") as g:
        a_json, b_model = f.read(), g.read()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = _ROWS.format(kind)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("b"))
    shared = spark.sparkContext.broadcast((a_json, b_model))  # two files of a fixed size
    made, made_path = materialize(rows.mapInArrow(_lazily(_encoder, shared, pattern, work, block), schema), "tokens")
    pieces = made.filter("kind = 2").select("block", "doc_id", "n_a", "n_b", "n_groups", "piece", "a", "b").repartition("block", "piece")
    merged = pieces.mapInArrow(_lazily(_merger, shared, pattern), _PIECE.format(kind))
    long_docs, long_path = materialize(merged.groupBy("block").applyInArrow(_lazily(_stitcher, shared, pattern), schema), "stitched")
    both = made.filter("kind < 2").unionByName(long_docs)
    held = both.filter("kind = 1").filter(F.size("pairs") > 0).select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("at", "x")).select("block", "at", F.col("x.pairs").alias("pair"), F.col("x.held").alias("n"))
    counts, counts_path = materialize(held.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    width = F.lit(len_pieces(b_model))
    a_id = F.floor(F.col("pair") / width)
    top = counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("top"))  # at most one row per id of A
    told = counts.join(F.broadcast(top), a_id == F.col("a_id")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    back = held.select("block", "at", "pair").join(told, "pair").select(F.col("block").alias("home"), "at", "count", "best")
    own = both.filter("kind = 0").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "at", "times")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(_finish, out)


def len_pieces(b_model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=b_model).get_piece_size()


def _lazily(make, shared, *how):
    """The function that ``make`` gives for the two models, made where the task runs."""
    made = None

    def run(x):
        nonlocal made
        made = made or make(*shared.value, *how)
        return made(x)

    return run
