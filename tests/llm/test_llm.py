"""The ten operators on small inputs: against brute force, and on nulls, empties, repeats and clashing columns."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from marshlight.llm import fingerprint, langid, mixing, ngram, quality, repeats, simhash, warc
from marshlight.llm.pieces import Encoder, encode_decode
from marshlight.llm.topk import exact_topk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, target double, b binary"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), 7, "k", 0.5, b"x") for i, t, lang, s in rows], DOCS)


def odd(spark):
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    return frame(spark, [
        (1, "a b c d e. f g", "en", "s1"), (2, None, None, None), (3, "", "en", "s1"), (4, long, "de", "s2"), (5, "a b c d e. f g", "en", "s2"),
        (6, "a b c d e. f g", "en", "s2"), (6, "a b c d e. f g", "en", "s2"), (None, "no id here", "fr", None), (7, "äß \U0001f600 z\n\ty", "de", "s3"), (8, " \n", "en", "s3"),
    ])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


# 1
def check_mix(pdf):
    assert (pdf.taken <= 3 * pdf["size"]).all()
    assert (pdf.taken >= 0).all()


def test_mixing_targets(spark, docs):
    got = mixing.mix(docs).toPandas().merge(docs.select("doc_id", "source", "text").toPandas(), on="doc_id")
    check_mix(got)
    assert [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in got.text] == got["size"].tolist()
    by = got.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), top=("size", "max"))
    total, w = by["size"].sum(), {s: 1 + i % 3 for i, s in enumerate(sorted(by.index))}
    want, free, left = {}, set(by.index), float(total)
    while True:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 3 * by["size"][s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * by["size"][s]
            free.remove(s)
            left -= want[s]
    want |= {s: level * w[s] for s in free}
    for s in by.index:
        assert by.target[s] == pytest.approx(want[s])
        assert abs(by.taken[s] - by.target[s]) <= max(0.05 * by.target[s], by.top[s] / 2)


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd(spark)).toPandas()
    assert len(got) == 10
    check_mix(got)
    assert mixing.mix(odd(spark).limit(0)).count() == 0
    again = mixing.mix(odd(spark).repartition(5)).toPandas()
    key = lambda p: sorted(map(repr, p[["doc_id", "size", "taken"]].fillna(-1).values.tolist()))
    assert key(got) == key(again)


# 2
def brute_print(t, n):
    w = t.encode().lower().split()
    if not w:
        return 0
    import xxhash

    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, most):
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [min(ids[k] for k in range(len(ids)) if find(k) == find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("block", [4096, 8])
def test_links_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = [int(x) for x in base] + [int(x) ^ (0b1011 << int(s)) for x, s in zip(base[:15], rng.integers(0, 59, 15), strict=True)] + [int(base[0]) ^ (1 << k) for k in range(30)]
    fps = sorted(set(fps))
    df = spark.createDataFrame([(i, int(np.uint64(x).astype(np.int64)), 0) for i, x in enumerate(fps)], "node long, fp long, fp2 long")
    for most, keep in ((4, 1), (4, 2)):
        roots, _ = simhash.components(simhash.link_fingerprints(df, most, keep, None, block))
        got = {r.node: r.root for r in roots.collect()}
        want = brute_components(fps, list(range(len(fps))), most)
        assert [got.get(i, i) for i in range(len(fps))] == want


def test_near_duplicates(spark, docs, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(texts)
    prints = [brute_print(texts[i], 4) for i in ids]
    comp = brute_components(prints, ids, 4)
    assert got == {i: (f"{p:016x}", c) for i, p, c in zip(ids, prints, comp, strict=True)}


def test_near_duplicates_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).toPandas()
    assert len(got) == 10
    by = {None if pd.isna(r.doc_id) else int(r.doc_id): (r.fingerprint, r.component_id) for r in got.itertuples()}
    assert by[2] == by[3] == by[8] == ("0" * 16, 2) and by[5][1] == by[6][1] == 1
    assert simhash.near_duplicates(odd(spark).limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(odd(spark)).toPandas()
    assert sorted(kept.doc_id.dropna()) == [1, 2, 4, 7] and kept.doc_id.isna().sum() == 1 and list(kept.columns) == odd(spark).columns


# 3
def test_language_model(spark, docs, texts):
    import zlib

    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    got = {r.doc_id: r for r in ngram.score_texts(docs, ngram.fold_is_training(7, 2), prior=4.0, block_bytes=100_000).collect()}
    toks = {i: [*t.encode().lower().split(), b"\n"] for i, t in texts.items()}
    one, two = Counter(), Counter()
    for i, t in toks.items():
        if i not in held:
            one.update(t)
            two.update(zip([b"\r", *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)
    starts = len(texts) - len(held)
    for i, t in toks.items():
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for h, w in zip([b"\r", *t[:-1]], t, strict=True):
            p = (one[w] + 1) / (n + v + 1)
            score += math.log10((two[h, w] + 4 * p) / ((one[h] if h != b"\r" else starts) + 4))
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(one[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_language_model_probabilities_sum_to_one():
    """The training words, the end and one unseen word, after contexts known and unknown."""
    texts = [b"a b a c", b"a b b", b"c a b"]
    g = ngram.Grams([*texts, b"zz"], np.array([True, True, True, False]), 3)
    n, v = sum(len(t.split()) + 1 for t in texts), 4
    a = ngram.Automaton(g, [lv["count"] for lv in g.levels], n, v, 2.0)
    ids = {w: i for w, i in zip([b"\r", b"\n", b"a", b"b", b"c", b"zz"], range(6), strict=True)}
    assert g.levels[0]["count"][ids[b"zz"]] == 0
    for context in ([], [b"a"], [b"a", b"b"], [b"c", b"c"], [b"zz"], [b"zz", b"a"]):
        score = lambda x: a.scores([np.array([0, *x])])[0]
        at = [ids[w] for w in context]
        assert sum(10 ** (score([*at, w]) - score(at)) for w in range(1, 6)) == pytest.approx(1)


def test_language_model_odd_rows(spark):
    got = ngram.score_texts(odd(spark), F.lit(True)).toPandas()
    assert len(got) == 10 and got.score.notna().all() and (got.n_tokens >= 1).all()
    none = ngram.score_texts(odd(spark), F.lit(False)).toPandas()
    assert (none.n_known == 0).all() and (none.train_tokens == 0).all() and (none.score <= 0).all()
    assert ngram.score_texts(odd(spark).limit(0), F.lit(True)).count() == 0


# 4
def parts(t):
    return {p for p in re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+|\n", t) if p}


def test_fingerprints(spark, docs, texts):
    # tiny sketches first, so that peeling fails and is tried again
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs, factor=1.2, least=2).collect()}
    ids = sorted(texts)
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        t, n = texts[i], texts[j]
        k = len(t) // 2
        e = t[: len(t) - k] + n[:k]
        a, b, x = parts(t), parts(e), parts(n)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.paragraphs, r.apart_edited, r.apart_next) == (len(a), len(a ^ b), len(a ^ x))
        assert r.near_edited == pytest.approx(1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0)
        assert (r.fingerprint == r.edited_fingerprint) or a != b


def test_fingerprints_odd_rows(spark):
    got = fingerprint.fingerprints(odd(spark)).toPandas()
    assert len(got) == 10 and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    same = got[got.doc_id.isin([1, 5, 6])]
    assert same.fingerprint.nunique() == 1
    assert fingerprint.fingerprints(odd(spark).limit(0)).count() == 0
    one = fingerprint.fingerprints(odd(spark).filter("doc_id = 1")).first()
    assert one.near_next == 1.0


def test_next_text_of_odd_ids(spark):
    # one far id, null ids and equal rows
    rows = [(i, f"t{i}") for i in range(500)] + [(10**12, "far")] + [(None, f"n{i}") for i in range(300)] + [(7, "t7")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts, links = fingerprint.with_next_text(df)
    got = [
        Row(**r.asDict() | {"doc_id": None if r.none else r.id} | ({"next_id": r.id, "next_t": r.t} if r.s else {}))
        for r in texts.join(links, fingerprint.KEY).collect()
    ]
    assert sum(r.copies for r in got) == len(rows)
    by_id = {(r.doc_id, r.next_id): r.copies for r in got if r.doc_id is not None}
    assert by_id.pop((7, 7)) == 3
    assert by_id.pop((10**12, None)) == 1 and by_id.pop((499, 10**12)) == 1
    assert by_id == {(i, i + 1): 1 for i in range(499)}
    of = {r.t: r.text for r in got}
    assert all(r["head"] == of[r.next_t][: len(r.text) // 2] for r in got if r.s == 0)
    after = {r.text: of[r.next_t] for r in got if r.doc_id is None}
    assert len(after) == 300 and sorted(after.values())[-1] == "t0" and len(set(after.values())) == 300


# 5
def test_archives(spark, tmp_path):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:marshlight:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/x y\r\nz", "one"), (2, None, "one"), (3, "u", None), (4, "u", ""), (5, "u", "x" + fake + "y"), (6, "u", fake), (7, "u", "WARC/1.1\r\n" * 3), (8, "u", "äß\U0001f600"), (9, "u", "one"), (9, "u", "one"), (10, "u", "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "k", 1) for r in rows], "page_id long, url string, html string, digest string, bytes int").repartition(3)
    for size in (0, 4):
        path = str(tmp_path / f"w{size}")
        warc.write_archives(pages, path, min_bytes=size, records_per_file=4)
        got = sorted((int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in warc.read_archives(spark, path).collect())
        import base64

        want = []
        for i, _, h in rows:
            b = (h or "").encode()
            top = max(k for k, _, x in rows if (x or "") == (h or ""))
            again = len(b) >= size and i != top
            want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top if again else None))
        assert got == sorted(want, key=lambda r: (r[0], r[1]))


def test_archives_of_nothing(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


# 6
def test_topk(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=24)], 1) for i in range(260)]
    rows += [(300, None, 1), (400, [float("nan")] * 24, 1), (500, [None] * 24, 1), (261, rows[7][1], 1), (262, rows[7][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    for k, block in ((10, 4096), (500, 16)):
        got = [(r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk(df, F.col("vec_id") % 100 == 0, k=k, block=block, step=5).collect()]
        ints = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in rows if v and all(x is not None and not math.isnan(x) for x in v)}
        want = []
        for q in ints:
            if q % 100 == 0:
                best = sorted(((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q))[:k]
                want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
        assert sorted(got) == sorted(want)
    assert exact_topk(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# 7
def test_language_id(spark, docs):
    from marshlight.llm.common import fold

    model = langid.train(docs, fold(F.col("doc_id"), 5) != 0)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(fold(F.col("doc_id"), 5) == 0).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.9 and got.score.between(0, 1).all()


def test_language_id_odd_rows(spark):
    model = langid.train(odd(spark), F.lit(True))
    got = langid.predict(odd(spark), model).toPandas()
    assert len(got) == 10
    assert set(got[got.doc_id.isin([2, 3, 8])].lang_pred) == {"und"}
    assert langid.train(odd(spark).limit(0), F.lit(True)) is None
    assert set(langid.predict(odd(spark), None).toPandas().lang_pred) == {"und"}


# 8
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_encoding(spark, docs, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    got = {r.doc_id: r for r in encode_decode(docs.limit(60), model_path(), outputs="digest").collect()}
    for i, r in got.items():
        ids = sp.encode(texts[i]) + [sp.eos_id()]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("text", ["", " ", "  ", "a ", " a", "a  b", "▁", "a▁b ▁", "\n\t x", "\U0001f600́ ok", "\x00", "<s> </s>", "ａ ﬁ", "x" * 300])
def test_encoder_spans(text):
    with open(model_path(), "rb") as f:
        e = Encoder(f.read())
    ids = e.ids(text)
    assert ids == e.sp.encode(text)
    b, z = e.spans(text, ids)
    raw = text.encode()
    assert list(b[1:]) == list(z[:-1]) and (not ids or (b[0] == 0 and z[-1] == len(raw)))
    for i, s, t in zip(ids, b, z, strict=True):
        if not e.sp.is_byte(i):
            assert e.sp.id_to_piece(i).replace("▁", " ").strip() == raw[s:t].decode().replace("▁", " ").strip()


def test_encoding_odd_rows(spark):
    full = encode_decode(odd(spark), model_path()).toPandas()
    assert len(full) == 10 and all(len(a) == len(b) == len(c) for a, b, c in zip(full.ids, full.begins, full.ends, strict=True))
    assert encode_decode(odd(spark).limit(0), model_path()).count() == 0


def test_longest_prefix_map():
    from marshlight.llm.pieces import CharMap

    assert CharMap(b"").longest(b"abc", 0) is None


def compiled_map(pairs):
    """A character map in the library's form: the size of a double-array trie, the trie, and the replacements."""
    import struct

    out, at = b"", {}
    for key, new in pairs.items():
        at[key.encode()] = len(out)
        out += new.encode() + b"\0"
    units, taken, todo = [0] * 4096, {0}, [(0, b"")]
    while todo:
        node, prefix = todo.pop()
        labels = sorted({k[len(prefix)] for k in at if k.startswith(prefix) and len(k) > len(prefix)})
        here = [0, *labels] if prefix in at else labels
        base = next(b for b in range(256, 4096 - 256) if not any(b ^ c in taken for c in here))
        units[node] |= ((node ^ base) << 10) | ((prefix in at) << 8)
        for c in here:
            taken.add(base ^ c)
        if prefix in at:
            units[base] = (1 << 31) | at[prefix]
        for c in labels:
            units[base ^ c] |= c
            todo.append((base ^ c, prefix + bytes([c])))
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + out


def mapped_model():
    """The public model with a character map, dropping repeated spaces."""
    from marshlight.llm.pieces import _fields

    def field(n, v):
        size, out = len(v), bytes([n << 3 | 2])
        while size > 127:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return out + bytes([size]) + v

    blob = compiled_map({"\uff41": "a", "\ufb01": "fi", "\ufb03": "ffi", "\u3000": " ", "\u2460": "1", "\t": " ", "\n": " ", "a\u0308": "\u00e4", "\u00b4": " \u0301"})
    spec = field(1, b"own") + field(2, blob) + bytes([3 << 3, 1, 4 << 3, 1, 5 << 3, 1])
    with open(model_path(), "rb") as f:
        return b"".join(field(n, spec if n == 3 else v) for n, v in _fields(f.read()))


def test_character_map_and_its_spans():
    e = Encoder(mapped_model())
    assert e.map.units and e.squeeze and not e.by_word
    assert e.map.longest("x\ufb01".encode(), 1) == (3, b"fi") and e.map.longest(b"plain", 0) is None
    for text in ["\uff41 \ufb01ne", "  two  spaces  ", "o\ufb03ce\u3000\u2460", "a\u0308b \u00e4", "\u00b4x \U0001f600 y", "tab\tand\nline", "", "   ", "plain text"]:
        norm, src = e.normalize(text.encode())
        assert norm.decode() == e.sp.normalize(text)
        assert len(src) == len(norm) + 1 and (np.diff(src) >= 0).all()
        ids = e.ids(text)
        begins, ends = e.spans(text, ids)
        for i, s, t, p in zip(ids, begins, ends, e.sp.encode(text, return_type="proto").pieces, strict=True):
            if not e.sp.is_byte(i):
                assert (s, t) == (p.begin, p.end), text
    b, z = e.spans("o\ufb03ce", e.ids("o\ufb03ce"))
    assert b[0] == 0 and z[-1] == len("o\ufb03ce".encode())


def test_query_runs_the_projection_to_spans(spark):
    from marshlight.llm.queries import op8_sentencepiece

    q = op8_sentencepiece(spark, SF)
    full = {r.doc_id: r for r in encode_decode(spark.read.parquet(f"{SF}/documents.parquet"), model_path()).collect()}
    for r in q.collect():
        f = full[r.doc_id]
        said = np.array(f.begins, "<i8").tobytes() + np.array(f.ends, "<i8").tobytes()
        assert r.n_tokens == len(f.ids) and r.spans_sha256 == hashlib.sha256(said).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, f.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(f.decoded.encode()).hexdigest()


# 9
def test_quality(spark, docs):
    from marshlight.llm.common import fold

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").filter(fold(F.col("doc_id"), 5) == 0).toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == got.quality).mean() > 0.8


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (7, None), (99, 1)], "doc_id long, quality int")
    model = quality.train(odd(spark), labels)
    got = quality.score(odd(spark), model).toPandas()
    assert len(got) == 10 and got.score.between(0, 1).all()
    assert quality.train(odd(spark), labels.limit(0)) is None
    assert set(quality.score(odd(spark), None).toPandas().score) == {0.5}
    kept = quality.score(odd(spark), None, keep_only=True)
    assert kept.columns == odd(spark).columns and kept.count() == 10


# 10
def test_repeats_buckets_are_even(spark):
    """No bucket of anchored strings holds much more than its share, and buckets follow the number of keys."""
    import numpy as np
    import pyarrow as pa

    from marshlight.llm import packed

    text = np.random.default_rng(3).integers(97, 123, 400_000, dtype=np.uint8).tobytes()
    df = spark.createDataFrame([(1, text, "x")], "doc_id long, b binary, text string")
    gram, window = repeats.probe(400)
    schema = "block long, ids array<bigint>, texts array<string>, sha array<string>, sizes binary, each binary, pos binary, keys binary"
    row = df.mapInArrow(repeats._strings(gram, window, False, 1 << 22), schema).first()
    keys = np.unique(packed.unpack(pa.py_buffer(bytes(row["keys"])), "<u8"))
    share = np.bincount((keys >> np.uint64(60)).astype(np.int64), minlength=16) / len(keys)
    assert len(keys) > 5000 and share.max() < 0.1 and share.min() > 0.03
    least = packed.bucket_bits(spark)
    assert packed.bucket_bits(spark, 1000) == least and packed.bucket_bits(spark, 1 << 40) == 22


def brute_repeats(rows, n):
    seen = Counter(t[k : k + n] for _, t in rows for k in range(len(t) - n + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                gone[k : k + n] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("block", [1 << 23, 500])
def test_repeats(spark, block):
    rng = np.random.default_rng(11)
    passage = "".join(chr(97 + x) for x in rng.integers(0, 26, 150))
    rand = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    rows = [(1, rand(90) + passage + rand(40)), (2, passage[20:110] + rand(80)), (3, rand(30) + passage[60:] + rand(10) + passage[:70]), (4, "ab" * 200), (5, "z" * 60), (6, None), (7, ""), (8, "short"), (9, passage), (9, passage), (None, rand(99) + passage[5:80]), (10, "äß" * 60 + rand(50)), (11, rand(200)), (12, rand(39)), (13, rand(41))]
    rows += [(100 + i, rand(25) + passage[40:95] + rand(25)) for i in range(20)]
    df = frame(spark, [(i, t, "en", "s") for i, t in rows]).repartition(4)
    got = repeats.remove_repeats(df, length=40, sizes=(16, 4, 1), report=True, block=block)
    want = brute_repeats([(i, (t or "").encode()) for i, t in rows], 40)
    assert sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got.collect()) == want
    table = repeats.remove_repeats(df, length=40, sizes=(16, 4, 1)).toPandas()
    assert list(table.columns) == df.columns and len(table) == len(rows)
    assert repeats.remove_repeats(df.limit(0), length=40, sizes=(16, 4, 1), report=True).count() == 0


# registered queries whose result SQL states
def test_topk_query_against_sql(spark):
    import duckdb

    from marshlight.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = QUERIES["op6_exact_topk"](spark, SF).toPandas()[["query_id", "rank", "vec_id", "score"]]
    want = con.execute(ORACLE["op6_exact_topk"]).df()[["query_id", "rank", "vec_id", "score"]]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
