"""The corpus pipeline: five stages from documents to token ids, each over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marshlight.llm import mixing, quality, repeats, simhash
from marshlight.llm.common import materialize, remove, table, text_bytes
from marshlight.llm.pieces import encode_decode


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3 (classifier 9, fitted on the labelled documents).

    Null and empty texts are scored as empty; rows without an id and repeated rows are kept or go by their text; without
    labels all stay; all columns are carried, whatever their names; an empty table gives none.
    """
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), threshold=0.3, keep_only=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash, 2): texts whose sets of five-word shingles are alike to 0.8
    or more, in steps. Two-word fingerprints within 11 bits find the pairs, the whole sets decide each.

    The smallest id stays (rows without an id only where no other is alike), once where rows repeat; texts without words
    are alike, null ones included; all columns are carried, whatever their names; an empty table gives none.
    """
    return simhash.drop_near_duplicates(docs, shingle=2, most=11, words=5, percent=80)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without strings of 240 bytes, about fifty words of five letters, that occur more than once (10).

    Texts that lose everything stay, empty; null and shorter texts stay as they are; rows without an id and repeated
    rows take part; all columns are carried, whatever their names; an empty table gives none.
    """
    return repeats.remove_repeats(docs, length=240, sizes=(128, 32, 8, 1))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it (1), at most three times.

    Documents are told apart by id and text, so rows that repeat as a whole share their number of copies; null and
    empty texts have no words and are not taken; a null source is a source; all columns are carried, whatever their
    names; an empty table gives none.
    """
    told = F.struct("doc_id", F.xxhash64(text_bytes(F.col("text"))).alias("t"))
    plan = mixing.mix(docs.select(told.alias("doc_id"), "text", "source"), weights=(1, 2, 3), most=3.0)
    taken = plan.groupBy("doc_id").agg(F.max("copies").alias("copies")).filter("copies > 0").select(F.col("doc_id.doc_id").alias("id"), F.col("doc_id.t").alias("t"), "copies")
    full = docs.select(F.struct("*").alias("row"), told.alias("told"))
    met = full.join(taken, F.col("told.doc_id").eqNullSafe(F.col("id")) & (F.col("told.t") == F.col("t")))
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids, decoded text and spans (8). Null texts are empty; every row gives one row,
    rows without an id and repeated ones too; other columns are not carried; an empty table gives none."""
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), outputs="digest")


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("repeated strings", drop_repeats),
    ("source mixing", mix_sources),
    ("sentencepiece", to_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written to the shared folder and read again, and deleted once
    the next one is written."""
    docs, old = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs, path = materialize(stage(spark, docs, sf_dir), "stage")
        remove(spark, *old)
        old = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
