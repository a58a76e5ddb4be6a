"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat_format, exact_dedup, hard_negatives, html_extract, license_scan, ngram_join, packing, piece_codec, prefix_trie, source_mix, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = f"{chat_format.END}{chat_format.START}assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_chats(chat_format.as_events(rows.unionByName(more))))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_codec.code(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return rows.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html_extraction, op2_toxicity, op3_chat_formatting, op4_url_filter, op5_ngram_jaccard_join, op6_source_mix, op7_exact_dedup, op8_nearest_neighbours, op9_license_scan, op10_packing, op11_sentencepiece, op12_prefix_trie, op13_hard_negatives)
}
