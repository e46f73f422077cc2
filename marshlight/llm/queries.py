"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, codes, fingerprint, langid, minhash, mixing, ngram, quality, repeats, warc
from .common import fold, scratch_path, table
from .pieces import encode_decode
from .simhash import near_duplicates
from .topk import exact_topk


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), weights=(1, 2, 3), most=3.0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=4, most=4).select("doc_id", "fingerprint", "component_id")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ngram.score_texts(docs, ngram.fold_is_training(7, 2))
    return scored.select("doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def held_out(mod: int, at: int):
    return F.coalesce(fold(F.col("doc_id"), mod) == at, F.lit(False)).alias("held_out")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_topk(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_archives(pages, path, min_bytes=0)
    read = warc.read_archives(spark, path)
    return read.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, fold(F.col("doc_id"), 5) != 0)
    return langid.predict(docs, model).select("doc_id", held_out(5, 0), "lang_pred", "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs="digest")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, threshold=0.3).select("doc_id", held_out(5, 0), "score", "predicted")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400, report=True)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.align(docs, p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model"), p.PATTERN)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), parts=8, entries=16, rounds=6, scale=4096)


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=80)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_simhash": op2_simhash,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_fingerprints": op4_fingerprints,
    "op5_warc": op5_warc,
    "op7_language_id": op7_language_id,
    "op9_quality": op9_quality,
    "op10_repeats": op10_repeats,
    "op6_exact_topk": op6_exact_topk,
    "op8_sentencepiece": op8_sentencepiece,
    "op11_alignment": op11_alignment,
    "op12_vector_codes": op12_vector_codes,
    "op13_minhash": op13_minhash,
}


def _codes_sql(rounds: int = 6) -> str:
    """Six rounds over the parts of all vectors, one CTE each."""
    near = lambda b: f"SELECT p.vec_id, p.row, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN {b} b USING (part)"
    least = "SELECT row, part, any_value(x) AS x, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d"
    steps = "".join(f""",
 a{i} AS MATERIALIZED ({least} FROM ({near(f'b{i}')}) GROUP BY row, part),
 s{i} AS MATERIALIZED (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS c FROM (SELECT part, entry, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS k) GROUP BY part, entry, k) GROUP BY part, entry),
 b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.c, b.c) AS c FROM b{i} b LEFT JOIN s{i} s USING (part, entry))""" for i in range(rounds))
    return f"""WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 p AS MATERIALIZED (SELECT vec_id, row, part, list_slice(e, CAST(part * len(e) // 8 + 1 AS BIGINT), CAST((part + 1) * len(e) // 8 AS BIGINT)) AS x FROM v, (SELECT unnest(range(8)) AS part)),
 b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x AS c FROM p WHERE row <= 16){steps},
 f AS MATERIALIZED ({least} FROM ({near(f'b{rounds}')}) GROUP BY row, part),
 c AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY row),
 h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
 SELECT v.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.codebooks_sha256 FROM v JOIN c USING (row), h"""

ORACLE = {
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op12_vector_codes": _codes_sql(),
}
