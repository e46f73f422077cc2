"""The alignment, vector code and MinHash operators against brute force, with odd rows."""

import hashlib
import json
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from marshlight.llm import align, codes, minhash
from marshlight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LONG = "aAbB cC, 12345 étude — naïve 中文字符 …" * 400
TEXTS = [
    (1, "The quick brown fox, don't stop!  two  spaces\n\nand lines\t\ttabs"), (2, ""), (3, None), (4, "mark ▁ inside"), (5, " leading and trailing "), (6, "x" * 3000), (7, LONG), (8, "<|endoftext|> </s> <unk> text"),
    (None, "a row without an id"), (9, "same"), (9, "same"), (10, "emoji 👩‍👩‍👧 and \x00 control ​"), (11, "\n"), (12, "=" * 900 + " " * 700 + "-" * 500),
]


def aligned(rows):
    """Alignment by the definition: ends that both have cut the tokens into groups."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_coder = Tokenizer.from_file(A)
    a_coder.encode_special_tokens = True
    letters = align.byte_alphabet()
    b_coder = sentencepiece.SentencePieceProcessor(model_file=B)
    piece = lambda i: bytes([int(b_coder.id_to_piece(i)[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", b_coder.id_to_piece(i)) else b_coder.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for doc_id, text in rows:
        a = a_coder.encode(" " + (text or ""), add_special_tokens=False)
        ab = [(i, bytes(letters[c] for c in t)) for i, t in zip(a.ids, a.tokens, strict=True)]
        bb = [(i, piece(i)) for i in b_coder.encode(text or "")]
        if not text or any(b"".join(x for _, x in s) != (" " + text).encode() for s in (ab, bb)):
            found.append((doc_id, 0, 0, [], Counter()))
            continue
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in (ab, bb)]
        groups, now = [], ([], [])
        both = set(ends[0]) & set(ends[1])
        todo = sorted([(e, k, i) for k, s in enumerate((ab, bb)) for e, (i, _) in zip(ends[k], s, strict=True)])
        for e, k, i in todo:
            now[k].append(i)
            if e in both and k == 1:
                groups.append(now)
                now = ([], [])
        found.append((doc_id, len(ab), len(bb), groups, Counter((x, y) for g in groups for x in g[0] for y in g[1])))
    held = Counter(p for f in found for p in f[4])
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, n_a, n_b, groups, pairs in found:
        said = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in groups)
        best = sum(n for p, n in pairs.items() if held[p] == top[p[0]])
        out.append((doc_id, n_a, n_b, len(groups), sum(pairs.values()), best, sum(n * held[p] for p, n in pairs.items()), hashlib.sha256(said.encode()).hexdigest() if n_a else ""))
    return sorted(map(repr, out))


@pytest.mark.parametrize("work, block", [(1 << 15, 1 << 20), (64, 50), (2, 1)])
def test_alignment_equals_its_definition(spark, work, block):
    df = spark.createDataFrame(TEXTS if work > 2 else TEXTS[:5] + TEXTS[7:], "doc_id long, text string").withColumn("block", F.lit(1))
    got = align.align(df.repartition(3), A, B, P.PATTERN, work=work, block=block)
    assert sorted(repr(tuple(r)) for r in got.collect()) == aligned(TEXTS if work > 2 else TEXTS[:5] + TEXTS[7:])


def test_registered_alignment_equals_its_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(repr(tuple(r)) for r in QUERIES["op11_alignment"](spark, SF).collect()) == aligned(rows)


def test_both_byte_level_coders_agree(spark):
    tokens = align.Tokens(open(A).read(), open(B, "rb").read(), P.PATTERN)
    texts = [" " + t for _, t in TEXTS if t] + [" " + r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert tokens.encode_a(texts) == tokens._listed(open(A).read())(texts)
    assert json.load(open(A))["pre_tokenizer"]["type"] == "ByteLevel"


@pytest.mark.parametrize("work", [2, 3, 7, 50])
def test_merge_path_cuts_into_equal_work(work):
    rng = np.random.default_rng(work)
    for _ in range(50):
        a, b = (np.unique(np.append(rng.integers(1, 300, rng.integers(0, 90)), 300)) for _ in range(2))
        i, j = align.diagonals(a, b, work)
        assert ((np.diff(i + j) <= work + 1) & (np.diff(i + j) >= 0)).all()
        whole = align.merge(a, b)
        parts = [align.merge(a[s:e], b[u:v]) for s, e, u, v in zip(i, i[1:], j, j[1:], strict=False)]
        for k, at in enumerate((i, j)):
            assert np.concatenate([p[k] + s for p, s in zip(parts, at, strict=False)]).tolist() == whole[k].tolist()


def test_large_groups_count_their_ids():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 9, 400).astype(np.int32), rng.integers(0, 7, 300).astype(np.int32)
    ca, cb = np.array([1, 200, 203, 400]), np.array([2, 150, 151, 300])
    for one, two in zip(align.links(a, b, ca, cb, 10, large=1), align.links(a, b, ca, cb, 10, large=1 << 30), strict=True):
        assert one.tolist() == two.tolist()


def test_products_of_limbs_are_exact():
    rng = np.random.default_rng(0)
    for top in (3, 1 << 20, 1 << 27, 1 << 29):
        x, y = rng.integers(-top, top, (40, 8)), rng.integers(-top, top, (16, 8))
        assert codes.products(x, y).tolist() == [[sum(int(p) * int(q) for p, q in zip(u, v, strict=True)) for v in y] for u in x]
        for bits in (4, 25):
            parts = codes.limbs(x, bits)
            assert (sum(p.astype(np.int64) << (i * bits) for i, p in enumerate(parts)) == x).all() and all(abs(p).max() <= 1 << (bits - 1) for p in parts)


def coded(rows, parts, entries, rounds, scale):
    """Codes by the definition, one distance at a time."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    kept = [(i, v + [0] * (dim - len(v)), lab) for i, v, lab in kept]
    w = dim // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w : (p + 1) * w] for _, v, _ in first] for p in range(parts)]
    near = lambda x, book: min((sum((s - t) ** 2 for s, t in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = defaultdict(list)
            for _, v, _ in kept:
                mine[near(v[p * w : (p + 1) * w], book)[1]].append(v[p * w : (p + 1) * w])
            books[p] = [[sum(col) // len(mine[e]) for col in zip(*mine[e], strict=True)] if e in mine else c for e, c in enumerate(book)]
    told = [(i, lab, [near(v[p * w : (p + 1) * w], books[p]) for p in range(parts)]) for i, v, lab in kept]
    by = Counter()
    for _, lab, t in told:
        by[lab] += sum(d for d, _ in t)
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(repr((i, "".join(f"{e:02x}" for _, e in t), sum(d for d, _ in t), by[lab], sha)) for i, lab, t in told)


def test_vector_codes_equal_their_definition(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=12)], "ab"[i % 2]) for i in rng.permutation(60)]
    rows += [(None, [0.5] * 12, None), (3, [0.25] * 12, "a"), (3, [0.25] * 12, "a"), (70, None, "a"), (71, [1.0, None], "b"), (72, [float("nan")] * 12, "b"), (73, [float("inf")] * 12, None), (74, [9000.0, -9000.0], None), (75, [], "b")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").withColumn("code", F.lit(0)).withColumn("error", F.lit(0))
    got = codes.vector_codes(df.repartition(3), parts=4, entries=5, rounds=3, scale=1024)
    assert sorted(repr(tuple(r)) for r in got.collect()) == coded(rows, 4, 5, 3, 1024)
    few = codes.vector_codes(df.filter("vec_id < 3"), parts=4, entries=5, rounds=3, scale=1024)
    assert sorted(repr(tuple(r)) for r in few.collect()) == coded([r for r in rows if r[0] is not None and r[0] < 3], 4, 5, 3, 1024)
    assert codes.vector_codes(df.limit(0)).count() == 0
    with pytest.raises(OverflowError):
        codes.vector_codes(df.limit(1).withColumn("embedding", F.array(*[F.lit(1e9)] * 8)))


def word_sets(rows, words):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append((i, frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()))
    return out


def grouped(rows, words=4, percent=80):
    """Groups by all pairs."""
    sets = word_sets(rows, words)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            s, t = sets[x][1], sets[y][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    low = {}
    for x, (i, _) in enumerate(sets):
        r = find(x)
        low[r] = i if low.get(r) is None else low[r] if i is None else min(low[r], i)
    return sorted(repr((i, len(s), low[find(x)], i == low[find(x)])) for x, (i, s) in enumerate(sets))


def family(n, changes, size=120, seed=0, first=0):
    """Texts made from one by changing some words: alike to all degrees around 0.8."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 5000, size)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.integers(0, size, rng.integers(0, changes + 1)):
            w[k] = f"v{rng.integers(0, 10**6)}"
        out.append((first + i, " ".join(w)))
    return out


@pytest.mark.parametrize("block", [2048, 16])
def test_minhash_links_equal_all_pairs(spark, block):
    rows = family(150, 6, seed=1) + family(150, 14, seed=2, first=1000) + family(60, 3, 9, seed=3, first=2000)
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "one two"), (3004, "ONE\ttwo"), (3005, "one two three"), (None, "one two"), (None, "x y z q"), (3006, "x y z q"), (3006, "x y z q"), (3007, "É é"), (3008, "é é"), (3009, rows[0][1] * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x"))
    got = minhash.near_duplicates(df.repartition(3), block=block)
    assert sorted(repr(tuple(r)) for r in got.collect()) == grouped(rows)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_registered_minhash_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(repr(tuple(r)) for r in QUERIES["op13_minhash"](spark, SF).collect()) == grouped(rows)


def test_index_finds_all_pairs_within_its_distance():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 16, (200, minhash.LANES)).astype(np.uint16)
    other = base.copy()
    for r in other:
        at = rng.choice(minhash.LANES, 15, replace=False)
        r[at] ^= 1
    a, b = minhash.patterns(base), minhash.patterns(other)
    assert (a == b).any(axis=1).all()
