"""Offset-preserving subword encoding and decoding with a SentencePiece model."""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

SPACE = "▁"


def _fields(buf: bytes):
    """Fields of a protocol-buffer message: (number, value)."""
    i = 0

    def varint(i):
        out = shift = 0
        while True:
            b = buf[i]
            out |= (b & 127) << shift
            i, shift = i + 1, shift + 7
            if b < 128:
                return out, i

    while i < len(buf):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            v, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            v, i = buf[i : i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            v, i = buf[i : i + n], i + n
        yield tag >> 3, v


class CharMap:
    """The compiled character map of a model: longest-prefix replacements, kept in a double-array trie."""

    def __init__(self, blob: bytes):
        self.units, self.out = (), b""
        if blob:
            (n,) = struct.unpack("<I", blob[:4])
            self.units = struct.unpack(f"<{n // 4}I", blob[4 : 4 + n])
            self.out = blob[4 + n :]
        # bytes that a key begins with
        base = (self.units[0] >> 10) << ((self.units[0] & 512) >> 6) if blob else 0
        self.heads = np.array([base ^ c < len(self.units) and self.units[base ^ c] & ((1 << 31) | 255) == c for c in range(256)])

    def longest(self, b: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at ``at`` and its replacement."""
        u, pos, found = self.units, 0, None
        if not u:
            return None
        unit = u[0]
        pos ^= (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(b)):
            pos ^= b[i]
            unit = u[pos]
            if unit & ((1 << 31) | 255) != b[i]:
                break
            pos ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                start = u[pos] & ((1 << 31) - 1)
                found = (i + 1 - at, self.out[start : self.out.index(b"\0", start)])
        return found


class Encoder:
    """Encodes text exactly as the library does and projects every piece to bytes of the original text.

    Merges never cross the start of a space mark when no piece holds a mark after another character; then words
    are encoded one by one and remembered (``cache`` words at most; the memory restarts when full). Otherwise
    each text is encoded whole.
    """

    def __init__(self, model: bytes, cache: int = 200_000):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = next((v for n, v in _fields(model) if n == 3), b"")
        got = dict(_fields(spec))
        self.map = CharMap(got.get(2, b""))
        self.dummy, self.squeeze, self.escape = bool(got.get(3, 1)), bool(got.get(4, 1)), bool(got.get(5, 1))
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))]
        user = any(v and dict(_fields(v)).get(3) == 4 for n, v in _fields(model) if n == 1)
        self.by_word = not self.map.units and not self.squeeze and self.escape and not user and not any(SPACE in p.lstrip(SPACE) for p in plain)
        self.size = np.array([1 if self.sp.is_byte(i) else len(p.encode()) for i, p in enumerate(pieces)], np.int64)
        self.unknown = self.sp.unk_id()
        self.limit, self.known = cache, {}

    def _mapped(self, b: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The bytes after the character map and, for each of them, where its original character or key begins."""
        raw = np.frombuffer(b, np.uint8)
        begins = raw & 192 != 128
        src = np.maximum.accumulate(np.where(begins, np.arange(len(raw)), 0))
        if not self.map.units:
            return raw, src
        out, back, i = [], [], 0
        # what no key begins with is copied in runs
        for j in np.flatnonzero(begins & self.map.heads[raw]).tolist():
            hit = self.map.longest(b, j) if j >= i else None
            if hit:
                size, new = hit
                out += [raw[i:j], np.frombuffer(new, np.uint8)]
                back += [src[i:j], np.full(len(new), j)]
                i = j + size
        return np.concatenate([*out, raw[i:]]), np.concatenate([*back, src[i:]])

    def normalize(self, b: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and the end, the original byte offset it came from."""
        n = len(b)
        out, src = self._mapped(b)
        if self.squeeze:
            space = out == 32
            keep = ~(space & np.concatenate([[True], space[:-1]])[: len(out)])
            out, src = out[keep], src[keep]
            if len(out) and out[-1] == 32:
                out, src, n = out[:-1], src[:-1], int(src[-1])
        if self.dummy and len(out):
            out, src = np.concatenate([np.array([32], np.uint8), out]), np.concatenate([src[:1], src])
        if self.escape:
            src = np.repeat(src, np.where(out == 32, len(SPACE.encode()), 1))
        done = out.tobytes().replace(b" ", SPACE.encode()) if self.escape else out.tobytes()
        return done, np.append(src, n).astype(np.int64)

    def _word(self, w: bytes):
        """Ids of one word that begins with its space marks (in escaped form), and the ids as text."""
        hit = self.known.get(w)
        if hit is None:
            raw = w.decode().replace(SPACE, " ")
            if self.dummy and raw == " ":
                ids = [self.sp.piece_to_id(SPACE)]
            else:
                ids = self.sp.encode(raw[1:] if self.dummy else raw, num_threads=1)
            hit = (ids, " ".join(map(str, ids)))
            if len(self.known) >= self.limit:
                self.known.clear()
            self.known[w] = hit
        return hit

    def words(self, text: str):
        """The pieces' ids word by word, each with its ids as text; the text must be encodable by word."""
        marked = ((" " if self.dummy and text else "") + text).replace(" ", SPACE)
        runs = marked.encode().split(SPACE.encode())
        # a run of marks stays with the word that follows it
        lead = 0
        for j, w in enumerate(runs):
            lead += j > 0
            if w or j + 1 == len(runs):
                if lead or w:
                    yield self._word(SPACE.encode() * lead + w)
                lead = 0

    def ids(self, text: str) -> list[int]:
        return self.encode(text)[0]

    def encode(self, text: str) -> tuple[list[int], str]:
        """The text's ids and the ids as text."""
        if not self.by_word:
            ids = self.sp.encode(text, num_threads=1)
            return ids, " ".join(map(str, ids))
        ids, said = [], []
        for a, b in self.words(text):
            ids += a
            said.append(b)
        return ids, " ".join(said)

    def spans(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end byte of each piece in the original text. Pieces tile the normalised text in order; a
        piece of unknown characters takes one character, a space mark that was added takes no bytes."""
        if not len(ids):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        norm, src = self.normalize(text.encode())
        if self.unknown not in ids:
            ends = np.cumsum(self.size[ids])
        else:
            ends, p = [], 0
            for i in ids:
                if i == self.unknown:
                    p += 1
                    while p < len(norm) and norm[p] & 192 == 128:
                        p += 1
                else:
                    p += self.size[i]
                ends.append(p)
            ends = np.array(ends)
        starts = np.concatenate([[0], ends[:-1]])
        # what an added space mark covers is empty: it begins where the first original byte begins
        return src[np.minimum(starts, len(norm))], src[np.minimum(ends, len(norm))]

    def whole(self, text: str, end: list[int]) -> tuple[list[int], str, np.ndarray, np.ndarray, str]:
        """Ids, the ids as text, begin and end byte of each, decoded text; the end ids take no bytes."""
        ids, said = self.encode(text)
        last = np.full(len(end), len(text.encode()), np.int64)
        begins, ends = (np.concatenate([x, last]) for x in self.spans(text, ids))
        ids = ids + end
        return ids, " ".join([*([said] if said else []), *map(str, end)]), begins, ends, self.sp.decode(ids)

    def digest(self, text: str, end: list[int]) -> tuple[int, str, str, str]:
        """Number of ids, hash of the ids as text, hash of the decoded text, hash of the spans (all begins, then all
        ends, as 8-byte little-endian integers)."""
        ids, said, begins, ends, back = self.whole(text, end)
        spans = begins.astype("<i8").tobytes() + ends.astype("<i8").tobytes()
        return len(ids), *(hashlib.sha256(x).hexdigest() for x in (said.encode(), back.encode(), spans))


def encode_decode(docs: DataFrame, model_path: str, outputs: str = "full", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text with an end id, then decode the ids.

    ``outputs='full'`` returns ``doc_id, ids array<int>, begins array<int>, ends array<int>, decoded`` where begins
    and ends are byte offsets of each piece in the original text (the end id takes no bytes);
    ``outputs='digest'`` folds them inside the task to ``doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256``.

    Null texts count as empty: one end id, no bytes. Repeated rows give repeated rows; an empty table gives none;
    other columns are not carried.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    full = outputs == "full"

    def run(batches):
        enc = Encoder(model)
        end = [enc.sp.eos_id()]
        for b in batches:
            rows = [x.as_py().decode("utf-8", "replace") for x in b.column(1)]
            if full:
                out = ([], [], [], [])
                for t in rows:
                    ids, _, s, e, back = enc.whole(t, end)
                    for o, v in zip(out, (ids, s, e, back), strict=True):
                        o.append(v)
                kinds = [pa.list_(pa.int32())] * 3 + [pa.string()]
                cols = [pa.array(o, k) for o, k in zip(out, kinds, strict=True)]
                names = ["ids", "begins", "ends", "decoded"]
            else:
                got = list(zip(*(enc.digest(t, end) for t in rows), strict=True)) or [()] * 4
                cols = [pa.array(got[0], pa.int64()), *(pa.array(g, pa.string()) for g in got[1:])]
                names = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, " + ("ids array<int>, begins array<int>, ends array<int>, decoded string" if full else "n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
    return docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("b")).mapInArrow(run, schema)
