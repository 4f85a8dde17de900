"""The queries of this folder's operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolith.llm import audio_prints, conv_trie, interval_join, jaccard_join, lang_id, piece_codec, topk_search, toxicity, url_rules, warc
from annolith.llm.common import cut, table
from annolith.llm.jaccard_join import jaccard_classes
from annolith.llm.packing import pack, token_pieces
from annolith.llm.simhash import simhash_classes
from annolith.llm.token_store import read_shards, write_shards
from annolith.llm.warc import page_records, write_archive


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.embedding_top_k(table(spark, sf_dir, "embeddings"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = lang_id.fit_text(table(spark, sf_dir, "documents"))
    rows = lang_id.identify(lang_id.page_rows(table(spark, sf_dir, "pages")), model)
    return rows.select(F.col("key").alias("page_id"), "lang", F.round("probability", 4).alias("probability"), "text_lang", "declared", "suffix", "host", "known")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_shards(*write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.page_labels(pages, table(spark, sf_dir, "labels")))


def op9_audio_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio_prints.identify(audio_prints.vector_prints(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), F.col("id") % 20 == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(spark, write_archive(table(spark, sf_dir, "pages")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval_join.sale_sessions(*(table(spark, sf_dir, t) for t in ("sales", "sale_lines", "clicks")))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {f.__name__: f for f in (op1_topk_search, op2_jaccard_join, op3_best_fit_packing, op4_language_id, op5_piece_codec, op6_toxicity, op7_token_store, op8_url_rules, op9_audio_prints, op10_warc, op11_conversation_trie, op12_interval_join, op13_simhash, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_topk_search": topk_search.ORACLE_SQL, "op2_jaccard_join": jaccard_join.ORACLE_SQL, "op8_url_rules": url_rules.ORACLE_SQL, "op10_warc": warc.ORACLE_SQL, "op11_conversation_trie": conv_trie.ORACLE_SQL, "op12_interval_join": interval_join.ORACLE_SQL}
