"""Each stage of the pipeline against a brute-force version of what it decides, on its own input."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from marshlight.llm import mixing, quality, simhash
from marshlight.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # one planted passage and near copies of a document
    first = docs.filter("length(text) between 1500 and 4000").orderBy("doc_id").first()
    near = first.text.split(" ")
    near[len(near) // 2] = "changed"
    extra = [(10_000, " ".join(near), first.lang, first.source, 0), (10_001, first.text, first.lang, "src1", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for _, stage in P.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "t")[0])
    return out, first


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_the_five_in_order():
    assert [f.__name__ for _, f in P.STAGES] == ["keep_quality", "drop_near_copies", "drop_repeats", "mix_sources", "to_tokens"]


def test_quality_stage(spark, stages):
    out, _ = stages
    model = quality.train(out[0], spark.read.parquet(f"{SF}/labels.parquet"))
    good = quality.score(out[0], model).filter("predicted = 1")
    assert ids(out[1]) == ids(good) and out[1].columns == out[0].columns


def alike(a, b):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return len(x & y) >= 0.8 * len(x | y)


def test_near_copy_stage(stages):
    out, first = stages
    rows = sorted((r.doc_id, r.text) for r in out[1].select("doc_id", "text").collect())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(rows[i][1], rows[j][1]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert ids(out[2]) == sorted(rows[i][0] for i in range(len(rows)) if find(i) == i)
    assert not {10_000, 10_001} & set(ids(out[2]))


def test_repeat_stage(stages):
    out, _ = stages
    rows = [(r.doc_id, (r.text or "").encode()) for r in out[2].select("doc_id", "text").collect()]
    seen = Counter(t[k : k + 240] for _, t in rows for k in range(len(t) - 239))
    want = {}
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 239):
            if seen[t[k : k + 240]] > 1:
                gone[k : k + 240] = True
        want[i] = np.frombuffer(t, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    assert {r.doc_id: r.text for r in out[3].collect()} == want
    assert all(r.n_chars == len(r.text) for r in out[3].collect())


def test_stages_on_odd_rows(spark, stages):
    """Nulls, empties, a long text, repeated rows, no rows, and columns whose names clash with those inside."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(20_000))
    rows = [(1, "a b c d e f g", "en", "s"), (1, "a b c d e f g", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (None, "no id", "en", "s"), (4, long, "de", "t"), (5, long + " end", "de", "t")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, t string, i double, h binary, n long, kept string, key string, told int, copies int, id string"
    df = spark.createDataFrame([(*r, len(r[1] or ""), 1, "t", 0.5, b"h", 9, "k", "y", 3, 2, "i") for r in rows], schema)
    for name, stage in P.STAGES:
        none = stage(spark, df.limit(0), SF)
        assert none.count() == 0, name
        got = stage(spark, df, SF)
        if name != P.STAGES[-1][0]:
            assert got.columns == df.columns and got.dtypes == df.dtypes, name
        if name == P.STAGES[-1][0]:
            continue
        left = Counter((r.doc_id, r.text) for r in got.select("doc_id", "text").collect())
        given = Counter((r[0], r[1]) for r in rows)
        if name == "source mixing":  # up to three copies of what it takes
            assert all(k in given and n <= 3 * given[k] for k, n in left.items())
        else:  # no stage makes rows; only the repeats stage changes texts
            assert sum(left.values()) <= len(rows) and {k[0] for k in left} <= {r[0] for r in rows}
            assert name == "repeated strings" or all(n <= given[k] for k, n in left.items())
    kept = P.drop_near_copies(spark, df, SF).toPandas()
    assert sorted(kept.doc_id.dropna()) == [1, 2, 4] and len(kept) == 4
    cut = {r.doc_id: r.text for r in P.drop_repeats(spark, df, SF).collect()}
    assert cut[2] is None and cut[3] == "" and cut[1] == "a b c d e f g" and cut[5] in ("", " end", "end")
    assert P.to_tokens(spark, df, SF).count() == 7


def test_mixing_stage(stages):
    out, _ = stages
    size = lambda df: {r.source: r.n for r in df.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+"))).alias("n")).collect()}
    plan = mixing.mix(out[3]).join(out[3].select("doc_id", "source"), "doc_id").toPandas()
    taken = plan.groupby("source").taken.sum()
    target = plan.groupby("source").target.first()
    copies = Counter(ids(out[4]))
    assert max(copies.values()) <= 3
    assert sum(copies.values()) == out[4].count()
    assert size(out[4]).keys() <= set(target.index)
    assert (abs(taken - target) <= np.maximum(0.05 * target, plan["size"].max() / 2)).all()


def test_token_stage(stages):
    import public_tokenizers
    import sentencepiece

    out, _ = stages
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for r in out[4].collect():
        e = sp.encode(r.text or "") + [sp.eos_id()]
        want[r.doc_id, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in out[5].collect()) == want


def pairs_alike(texts):
    """All pairs of texts alike to 0.8 in five-word shingles, by an inverted list."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, held = [], {}
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    for j, s in enumerate(sets):
        both = Counter(i for x in s for i in held.get(x, ()))
        yield from ((i, j) for i, n in both.items() if n >= 0.8 * (len(s) + len(sets[i]) - n))
        for x in s:
            held.setdefault(x, []).append(j)


def root_of(spark, df):
    rows = {r.text or "": r.h for r in df.selectExpr("text", "xxhash64(cast(coalesce(text, '') AS binary)) AS h").collect()}
    _, roots = simhash.similar_texts(df)
    label = {r.node: r.root for r in roots.collect()}
    return {t: label.get(h, h) for t, h in rows.items()}


@pytest.mark.parametrize("sf, least", [("sf0.01", 1.0), ("sf0.1", 0.95)])
def test_near_copies_are_found_in_whole_tables(spark, sf, least):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    label = root_of(spark, df)
    texts = sorted(label)
    pairs = list(pairs_alike(texts))
    assert pairs and sum(label[texts[i]] == label[texts[j]] for i, j in pairs) >= least * len(pairs)


def test_family_of_templated_texts_loses_no_link(spark):
    """200 texts of one template: pairs alike to 0.6 as well as to 0.9, so most candidates are no links."""
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 3000, 300)]
    rows = []
    for i in range(200):
        w = list(base)
        for k in rng.integers(0, 300, rng.integers(0, 16)):
            w[k] = f"v{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(w)))
    label = root_of(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    texts = [t for _, t in rows]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = list(pairs_alike(texts))
    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    found = sum(label[texts[i]] == label[texts[j]] for i, j in pairs) / len(pairs)
    assert found >= 0.95
    # nothing is joined that no link joins
    assert len({(find(i), label[t]) for i, t in enumerate(texts)}) == len({label[t] for t in texts})


def test_a_larger_table_does_not_widen_what_the_index_is_sent(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("length(text) < 3000")
    sent, in_cells = [], simhash.in_cells
    monkeypatch.setattr(simhash, "in_cells", lambda nodes, most, keep, *a, **k: sent.append((keep, nodes.columns)) or in_cells(nodes, most, keep, *a, **k))
    few = {(r.node, r.root) for r in simhash.similar_texts(df, block=4)[1].collect()}  # as with 32768 and a million texts
    assert [k for k, _ in sent] == [1] and "sig" not in sent[0][1]
    assert few == {(r.node, r.root) for r in simhash.similar_texts(df)[1].collect()} and few
    assert [simhash.runs_to_send(11, n, 32768) for n in (0, 50_000, 540_000, 5_000_000, 50_000_000)] == [1, 1, 1, 1, 2]


def test_whole_rows_are_sent_once(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, "q r s t", "y"), (None, "q r s t", "y"), (2, "", None), (3, None, None)], "doc_id long, text string, source string")
    monkeypatch.setattr(simhash, "similar_texts", lambda docs, **how: (docs.select(F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("text_hash"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")).alias("low")).groupBy("text_hash").agg(F.min("low").alias("low")), spark.createDataFrame([], "node long, root long")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = simhash.drop_near_duplicates(df)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[plan.index("Window") : plan.index("Join")] and "Exchange" in plan[plan.index("Join") :]
        assert sorted(map(str, got.collect())) == sorted(map(str, df.filter("doc_id IS NULL OR doc_id < 3").distinct().collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_inside_a_cell_lose_no_pair():
    rng = np.random.default_rng(5)
    crowd = rng.integers(0, 1 << 63, 1, np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, 300, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, np.uint64))
    centres = rng.integers(0, 1 << 63, 400, np.uint64)
    near = centres.copy()
    for _ in range(9):
        near ^= np.uint64(1) << rng.integers(0, 64, 400, np.uint64)
    left, right = np.concatenate([crowd[:150], centres]), np.concatenate([near, crowd[150:]])
    for x, y in ((left, right), (np.concatenate([left, right]), None)):
        other = x if y is None else y
        want = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(x[:, None] ^ other[None]) <= 11), strict=True) if y is not None or i < j}
        for keep in (0, 1, 2):
            got = set()
            for runs in simhash.tables(11, keep):
                a = simhash.TableIndex(x, runs, np.arange(len(x)))
                b = a if y is None else simhash.TableIndex(y, runs, np.arange(len(y)) + len(x))
                for i, j in a.links(b, 11):
                    i, j = a.order[i], b.order[j]
                    assert (simhash.values(x[i], runs) == simhash.values(other[j], runs)).all()
                    got |= {(p, q) if y is not None else (min(p, q), max(p, q)) for p, q in zip(i, j, strict=True)}
            assert got == want
        # pairs of one label are not asked for again; a crowd is met in few tables
        a = simhash.TableIndex(x, [], np.zeros(len(x), int))
        assert not list(a.links(a, 11))
    assert len(simhash.runs_inside(np.repeat(crowd, 10), None, 11)) == 1 and len(simhash.runs_inside(rng.integers(0, 1 << 63, 20_000, np.uint64), None, 11)) > 1


def test_lowest_bits_of_signatures_never_differ_in_more_numbers():
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 1 << 16, (60, 32)).astype(np.uint16)
    sig[30:, ::3] = sig[:30, ::3]
    low = (sig[:, ::2] & 15 | (sig[:, 1::2] & 15) << 4).astype(np.uint8)
    low = np.frombuffer(b"".join(x.tobytes() for x in low), "<u8").reshape(60, -1)
    i, j = np.repeat(np.arange(60), 60), np.tile(np.arange(60), 60)
    assert (simhash._differ(low, i, j) == ((sig[i] & 15) != (sig[j] & 15)).sum(1)).all()
    assert (simhash._differ(low, i, j) <= simhash._differ(sig, i, j)).all()


def test_a_stage_is_deleted_once_the_next_is_written(spark, monkeypatch):
    import os

    from marshlight.llm.common import shared_dir

    there = lambda: {x for x in os.listdir(shared_dir(spark).removeprefix("file://")) if x.startswith("stage-")}
    monkeypatch.setattr(P, "STAGES", [(str(k), lambda s, d, f: d.select("doc_id")) for k in range(4)])
    before = there()
    assert P.run(spark, SF).count() == 200 and len(there() - before) == 1
