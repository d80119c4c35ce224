"""A corpus pipeline of five stages over documents: toxicity, line dedup, near dedup, decontamination, tokens."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, decontamination, lines, simhash, toxicity
from pagemill.llm.shared import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the classifier learns from the labels of the folder."""
    return toxicity.ordinary_only(docs, _table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without boilerplate lines; n_chars, where there is one, counts what is left."""
    own = docs.select(*[F.col(f"`{c}`").alias(f"own{i}") for i, c in enumerate(docs.columns)])
    doc_id, text, site = (f"own{docs.columns.index(c)}" for c in ("doc_id", "text", "source"))
    cleaned = lines.remove_boilerplate(own, doc_id, text, site)
    return cleaned.select(*[
        (F.length(text).cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"own{i}")).alias(c)
        for i, c in enumerate(docs.columns)])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontamination.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: Each stage takes (spark, docs, sf_dir) and works on what the one before kept.
STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", token_stage),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents; each stage's rows are written and read again by the next.

    Nulls, empty and long texts, repeated rows, empty tables and further columns are treated as each stage's operator
    states; no stage but the last changes the columns.
    """
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
