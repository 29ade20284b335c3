"""Corpus pipeline: quality, line dedup, near-dedup, benchmark decontamination, tokens.

Each stage works on all rows its predecessor kept, and its decisions take
effect.  All stages but the last return the columns of ``documents``; the last
replaces the text by its token ids, their number and the text decoded from them.

In every stage: an empty table gives an empty one; columns beyond those of ``documents`` stay as they are, whatever their names; very long texts are
taken whole; rows with a null id are documents like any other; repeated rows are judged alike.  What else a stage makes of odd rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.llm import bpe, decontam, linedup, quality, simhash
from topiclake.llm.common import fresh, held, shared
from topiclake.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is 0.5 or more; labels of rows whose crc32 leaves 1 of 3 are not learned from.

    Null and empty texts have the share of good labels as score; without labels of both classes every document stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held("doc_id", 3, 1))
    out = quality.scored(docs, quality.fit(docs, labels))
    return out.where(F.col(out.columns[-1]) >= 0.5).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate; n_chars follows the text.

    Every row stays: a null text stays null, one all of whose lines go becomes empty.  Of a boilerplate line the occurrence in the smallest id stays.
    """
    out = linedup.without_boilerplate(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that of the smallest id (null ids last, then the first in file order).

    Null, empty and blank texts have fingerprint zero and are one group.
    """
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule does not name; null and empty texts have no words and stay, an empty benchmark names none."""
    out = decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where(~decontam.contaminated(out.columns[-1])).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text, their number, and the text that they decode to; null and empty texts have none, and decode to the empty text."""
    out = bpe.encoded(docs, vocabulary())
    ids = out.columns[-1]
    return bpe.decoded(out.withColumn(fresh(out, "n_tokens"), F.size(ids).cast("long")), vocabulary(), ids)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", tokens),
]

# SQL has no zstandard, SimHash or BPE: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = shared(spark, "stage-" + name.lower().replace(" ", "-"))
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
