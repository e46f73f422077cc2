"""Language-model scoring with a weighted backoff automaton whose n-gram counts stay distributed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, remove, text_bytes
from .packed import COUNTED, add_up, blocks, bucket_bits, by_block, counted, take

END, START = b"\n", b"\r"  # no word can be one of these
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context's hash and the next word's."""
    h = (context * _M1) ^ ((word << np.uint64(31)) | (word >> np.uint64(33))) * _M2
    h ^= h >> np.uint64(29)
    h *= _M2
    return h ^ (h >> np.uint64(32))


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


class Grams:
    """N-grams of a set of texts. ``ids[i]`` is a text's word ids between a start and an end; level k holds the
    distinct k-grams: their hashes, the code of their first k-1 words, of their last k-1 words, the last word,
    and how often training texts hold them."""

    def __init__(self, texts: list[bytes], training: np.ndarray, order: int):
        known: dict[bytes, int] = {START: 0, END: 1}
        self.ids = []
        for t in texts:
            self.ids.append(np.array([0, *[known.setdefault(w, len(known)) for w in t.lower().split()], 1], np.int32))
        self.hash = np.fromiter(map(_hash, known), np.uint64, len(known))
        size = np.array([len(x) for x in self.ids])
        flat = np.concatenate(self.ids) if len(texts) else np.empty(0, np.int32)
        place = np.concatenate([np.arange(n, dtype=np.int32) for n in size]) if len(texts) else flat
        learn = np.repeat(training, size)
        n = len(known)
        codes = flat
        self.levels = [{"keys": self.hash, "count": np.bincount(flat[learn], minlength=n).astype(np.int64), "prefix": np.zeros(n, np.int64), "suffix": np.zeros(n, np.int64), "word": np.arange(n)}]
        for k in range(2, order + 1):
            at = np.flatnonzero(place >= k - 1)
            pair = codes[at - 1].astype(np.int64) * n + flat[at]
            got, first, where = np.unique(pair, return_index=True, return_inverse=True)
            new = np.full(len(flat), -1)
            new[at] = where
            low = self.levels[-1]
            self.levels.append({
                "keys": _join(low["keys"][got // n], self.hash[got % n]), "count": np.bincount(where[learn[at]], minlength=len(got)).astype(np.int64),
                "prefix": got // n, "suffix": codes[at[first]], "word": got % n,
            })
            codes = new


def _counter(order: int, bits: int):
    """Count n-grams per block: one packed row per (bucket of the hash, block, order)."""

    def run(batches):
        for b in batches:
            block = b.column(0).to_numpy(zero_copy_only=False)
            learn = b.column(1).to_numpy(zero_copy_only=False)
            for blk in np.unique(block):
                at = np.flatnonzero(block == blk)
                g = Grams([x.as_buffer().to_pybytes() for x in b.column(2).take(pa.array(at))], learn[at], order)
                parts = []
                for lv in g.levels:
                    o = np.argsort(lv["keys"])
                    parts.append((lv["keys"][o], lv["count"][o]))
                yield counted(int(blk), parts, bits)

    return run


class Automaton:
    """States are the contexts seen in training; arcs carry log10 probabilities; a failure arc carries the weight
    of backing off to the context without its first word.

    The probability of w after context h is (c(hw) + prior * P(w | shorter h)) / (c(h) + prior); single words
    have (c + 1) / (N + V + 1), a word not seen in training c = 0, so the V words and one unseen word add up to one after
    every context. Arcs are arrays in order of state and
    word, so a block's automaton takes a few bytes an arc.
    """

    def __init__(self, g: Grams, totals: list[np.ndarray], tokens: int, types: int, prior: float):
        n = len(g.hash)
        count = totals[0]
        p1 = (count + 1) / (tokens + types + 1)
        self.width, self.order = n, len(totals)
        with np.errstate(divide="ignore"):
            self.root = np.log10(p1)
        # state of each known context, by level and code; 0 is the empty context
        state, fail, back, n_states = [], [np.zeros(1, np.int64)], [np.zeros(1)], 1
        for k in range(self.order - 1):
            known = totals[k] > 0
            ids = np.cumsum(known) - 1 + n_states
            n_states += int(known.sum())
            shorter = np.zeros(len(ids), np.int64) if k == 0 else state[k - 1][g.levels[k]["suffix"]]
            fail.append(shorter[known])
            back.append(np.log10(prior / (totals[k][known] + prior)))
            state.append(np.where(known, ids, shorter))
        self.fail, self.back = np.concatenate(fail), np.concatenate(back)
        self.after = state[0] if state else np.zeros(n, np.int64)  # next state from the root
        keys, logs, nexts, p = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)], p1
        for k in range(1, self.order):
            lv, known = g.levels[k], totals[k] > 0
            p = (totals[k] + prior * p[lv["suffix"]]) / (totals[k - 1][lv["prefix"]] + prior)
            nxt = state[k] if k < self.order - 1 else state[k - 1][lv["suffix"]]
            keys.append(state[k - 1][lv["prefix"]][known] * n + lv["word"][known])
            logs.append(np.log10(p[known]))
            nexts.append(nxt[known])
        keys = np.concatenate(keys)
        o = np.argsort(keys)
        self.arcs, self.logs, self.nexts = keys[o], np.concatenate(logs)[o], np.concatenate(nexts)[o]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states after a word each, and its log probabilities: along an arc, or failure arcs and then one."""
        total, state = np.zeros(len(word)), state.copy()
        todo = np.flatnonzero(state) if len(self.arcs) else np.empty(0, np.int64)
        out = self.after[word]
        told = np.zeros(len(word), bool)
        while len(todo):
            key = state[todo] * self.width + word[todo]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            hit = self.arcs[at] == key
            found = todo[hit]
            total[found] += self.logs[at[hit]]
            out[found], told[found] = self.nexts[at[hit]], True
            todo = todo[~hit]
            total[todo] += self.back[state[todo]]
            state[todo] = self.fail[state[todo]]
            todo = todo[state[todo] > 0]
        total[~told] += self.root[word[~told]]
        return out, total

    def scores(self, ids: list[np.ndarray], width: int = 512) -> np.ndarray:
        """Log probability of each text (word ids that begin with the start). Many lanes go from left to right at once,
        each carrying its state: a lane is a text or ``width`` words of a longer one, which take up their state from
        the words just before them, as many as a state can remember."""
        warm = self.order - 1
        lanes = [(i, s) for i, x in enumerate(ids) for s in range(1, max(2, len(x)), width)]
        lanes.sort(key=lambda a: min(width, len(ids[a[0]]) - a[1]) + min(warm, a[1]), reverse=True)
        size = np.array([min(width, len(ids[i]) - s) + min(warm, s) for i, s in lanes])
        lead = np.array([min(warm, s) for _, s in lanes])
        owner = np.array([i for i, _ in lanes])
        words = np.zeros((len(lanes), int(size.max(initial=0))), np.int32)
        for r, (i, s) in enumerate(lanes):
            words[r, : size[r]] = ids[i][s - lead[r] : s - lead[r] + size[r]]
        state, total = np.zeros(len(lanes), np.int64), np.zeros(len(lanes))
        for j in range(words.shape[1]):
            m = int(np.searchsorted(-size, -j))  # lanes that still have words
            state[:m], got = self.step(state[:m], words[:m, j])
            total[:m] += np.where(j >= lead[:m], got, 0.0)
        return np.bincount(owner, total, minlength=len(ids)) if len(lanes) else np.zeros(len(ids))


def _scorer(order: int, tokens: int, types: int, prior: float):
    def run(batches):
        for _, docs, got in blocks(batches, 5):
            g = Grams([d[2].as_buffer().to_pybytes() for d in docs], np.array([d[1].as_py() for d in docs], bool), order)
            totals = []
            for k, lv in enumerate(g.levels, 1):
                o = np.argsort(lv["keys"])
                t = np.empty(len(o), np.int64)
                t[o] = take(lv["keys"][o], lv["count"][o], got.pop(k, []))[0]
                totals.append(t)
            base, known = np.log10((totals[0] + 1) / (tokens + types + 1)), totals[0] > 0
            automaton, g.levels, totals = Automaton(g, totals, tokens, types, prior), [], []
            scores = automaton.scores(g.ids)
            cols = [pa.array([f(x[1:]) for x in g.ids], t) for f, t in ((len, pa.int64()), (lambda x: int(known[x].sum()), pa.int64()), (lambda x: float(base[x].sum()), pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array([d[0].as_py() for d in docs], docs[0][0].type), *cols, pa.array(scores, pa.float64())], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def deal(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``docs`` with a ``block`` number: neighbouring ids, about ``block_bytes`` of text.

    Ranges of ids are as wide as the mean takes (between the fifth and the last twentieth of all ids, so that a few
    far ids change nothing); a range of more than twice the bytes is dealt out by a hash. Rows without an id are a
    range. The ranges that are split (two numbers each) are broadcast up to half a million of them, joined beyond.
    """
    text = text_bytes(F.col("text"))
    at = F.percentile_approx(F.col("doc_id").cast("double"), F.array(F.lit(0.05), F.lit(0.95)), 1000)
    seen = docs.agg(at.alias("at"), F.count("*").alias("n"), F.sum(F.octet_length(text).cast("double")).alias("bytes")).first()
    low, high = seen["at"] or (0, 0)
    width = max(1.0, (high - low) / max(1, 0.9 * seen["n"]) * block_bytes / max(1.0, (seen["bytes"] or 0) / max(1, seen["n"])))
    span = F.coalesce(F.floor(F.col("doc_id").cast("double") / F.lit(width)).cast("long"), F.lit(-(2**62)))
    ranged = docs.select("*", span.alias("span"))
    large = ranged.groupBy("span").agg(F.sum(F.octet_length(text).cast("double")).alias("b")).filter(F.col("b") > 2 * block_bytes)
    large, _ = materialize(large.select(F.col("span").alias("large"), F.ceil(F.col("b") / block_bytes).cast("long").alias("split")), "large")
    n = large.count()
    split = F.lit(1)
    if n:
        ranged = ranged.join(F.broadcast(large) if n <= 500_000 else large, F.col("span") == F.col("large"), "left")
        split = F.coalesce("split", F.lit(1))
    return ranged.select(*docs.columns, F.xxhash64("span", F.pmod(F.xxhash64("doc_id", text), split)).alias("block"))


def score_texts(docs: DataFrame, is_training: Column, order: int = 2, prior: float = 50.0, block_bytes: int = 4 << 20, bits: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every whole text.

    Texts fall into blocks of neighbouring ids and about ``block_bytes``. Tasks count the n-grams of their blocks and
    shuffle them by hash as packed, sorted arrays; a bucket's task adds the blocks' counts and sends back to each
    block its totals, in the order of its keys. Every block then builds the part of the automaton that its
    texts can reach and scores them. No table of n-grams is ever whole anywhere, none is cut off, and what is
    moved grows with the distinct n-grams of the blocks.

    Null and empty texts have the end token alone; ids that are null or repeat are scored like any other; with
    no training rows all words are unknown; an empty table gives no rows; other columns are not carried. A very
    long text is a block of its own. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    # rows of packed arrays are large: batches of as many rows as usual would fill the executors outside their heap
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    bits = bits or bucket_bits(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = deal(docs.select("doc_id", "text", F.coalesce(is_training, F.lit(False)).alias("learn")), block_bytes)
    rows = rows.select("block", "learn", text_bytes(F.col("text")).alias("b"), "doc_id")
    counts = rows.select("block", "learn", "b").mapInArrow(_counter(order, bits), COUNTED)
    totals, path = materialize(add_up(counts), "ngrams")
    trained = rows.filter("learn").count()  # starts are counted with the words, but are none
    words = totals.filter("block IS NULL AND part = 1").agg(F.sum("added").alias("n"), F.sum("positive").alias("v")).first()
    tokens, types = (words["n"] or 0) - trained, (words["v"] or 0) - (trained > 0)
    met = by_block(totals, rows.select("block", F.lit(0).alias("part"), "doc_id", "learn", "b"))
    out = met.mapInArrow(_scorer(order, tokens, types, prior), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def fold_is_training(mod: int, held: int) -> Column:
    return fold(F.col("doc_id"), mod) != held
