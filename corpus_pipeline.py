"""From raw documents to packed training sequences: language ID, toxicity, near duplicates, packing.

STAGES lists the stages in order; run() applies them to the documents table, each on what its predecessor wrote. All but the
last return the columns of documents. A row's decision belongs to its id and text together, so null and repeated ids are
decided by their own texts; a row that a stage has no ground to reject stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm import lang_id, toxicity
from annolith.llm.common import cut, table
from annolith.llm.jaccard_join import jaccard_classes
from annolith.llm.packing import pack, token_pieces

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rejected keys (kept ids) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: No SQL expresses the trained models, the join's scale or the packing; the tests hold the stages against brute force.
ORACLE_SQL = None


def _key():
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _checked(keys: DataFrame) -> DataFrame:
    keys = cut(keys, "keys")
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    return docs.join(_checked(rejected.distinct()), _key() == F.col("reject_key"), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: lang is the declared language and source the host."""
    model = lang_id.fit_text(docs)
    rows = docs.select(_key().alias("key"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))
    verdicts = lang_id.identify(rows, model)
    return _without(docs, verdicts.where(~F.col("known")).select(F.col("key").alias("reject_key")))


def toxic_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under a half; learnt from the labels of the documents that are left."""
    scores = toxicity.score(docs, table(spark, sf_dir, "labels"), _key())
    return _without(docs, scores.where(F.col("score") >= 0.5).select(F.col("key").alias("reject_key")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word shingles, similarity 0.8 or more, hold together: the smallest id.

    Every distinct id and text is a node of its own, with or without id; a row without id stays only where its group has none
    with one. Of rows of equal id and text one stays; a text without shingles links with nothing."""
    classes = jaccard_classes(docs.select(_key().alias("key"), "text"), id_col="key", words=5, num=8, den=10).where("n_shingles > 0")
    linked = cut(classes.where("key <> component_id").select("key", "component_id").distinct(), "linked")
    members = _checked(linked.union(linked.select(F.col("component_id").alias("key"), "component_id")).distinct())
    named = docs.select(_key().alias("key"), "doc_id").join(members, "key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    dropped = members.join(_checked(first.select("component_id", F.col("first.key").alias("first"))), "component_id").where("key <> first")
    kept = _without(docs, dropped.select(F.col("key").alias("reject_key")))
    again = _checked(classes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("again")))
    if again.isEmpty():
        return kept
    once = kept.join(again, _key() == F.col("again"), "left_semi").groupBy(_key().alias("key")).agg(F.min_by(F.struct(*kept.columns), F.xxhash64(*kept.columns)).alias("r"))
    return once.select("r.*").unionByName(kept.join(again, _key() == F.col("again"), "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in training sequences of 4,096 tokens."""
    pieces = cut(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("toxicity", toxic_text), ("near_duplicates", near_duplicates), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
