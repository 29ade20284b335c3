"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, decontam, langid, linedup, quality, search, simhash, toxicity, trie, urlfilter, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixture_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.digest(_table(spark, sf_dir, "documents"))


def op2_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(_table(spark, sf_dir, "conversations"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file, where the package of their files is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_table(spark, sf_dir, "documents"), vocabulary())


def op6_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(_table(spark, sf_dir, "pages"))


def op8_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.digest(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(_table(spark, sf_dir, "documents"))


def op10_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.digest(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.digest(_table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(_table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.digest(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixture_langid": op1_mixture_langid,
    "op2_compression_quality": op2_compression_quality,
    "op3_decontamination": op3_decontamination,
    "op4_tool_calls": op4_tool_calls,
    "op5_forced_boundary_bpe": op5_forced_boundary_bpe,
    "op6_factorization_toxicity": op6_factorization_toxicity,
    "op7_warc_index": op7_warc_index,
    "op8_bm25_search": op8_bm25_search,
    "op9_simhash": op9_simhash,
    "op10_line_spread": op10_line_spread,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_url_filter": op13_url_filter,
}

#: DuckDB SQL where it can express the operator.
ORACLE: dict[str, str] = {
    "op3_decontamination": decontam.ORACLE,
    "op4_tool_calls": chat.ORACLE,
    "op7_warc_index": warc.ORACLE,
    "op8_bm25_search": search.ORACLE,
    "op10_line_spread": linedup.ORACLE,
    "op11_prefix_trie": trie.ORACLE,
    "op13_url_filter": urlfilter.ORACLE,
}
