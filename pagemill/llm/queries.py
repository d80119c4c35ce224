"""Registered queries of this subpackage: each applies one operator to its whole table."""

import public_tokenizers

from pagemill.llm import (
    bpe, decontamination, graphs, language_model, licenses, lines, quality, quality_rules, runs, simhash, substring, toxicity, whitening)

QUERIES, SQL = {}, {}


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op2_byte_bpe")
def byte_bpe(spark, folder):
    return bpe.digests(_table(spark, folder, "documents"),
                       public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op3_simhash_near_dedup")
def simhash_near_dedup(spark, folder):
    return simhash.report(_table(spark, folder, "documents"))


@query("op7_substring_dedup", substring.SQL)
def substring_dedup(spark, folder):
    return substring.report(_table(spark, folder, "documents"))


@query("op9_license_scan", licenses.SQL)
def license_scan(spark, folder):
    return licenses.license_matches(_table(spark, folder, "documents"))


@query("op10_decontamination", decontamination.SQL)
def benchmark_decontamination(spark, folder):
    return decontamination.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query("op6_line_dedup", lines.SQL)
def line_dedup(spark, folder):
    return lines.report(_table(spark, folder, "documents"))


@query("op4_toxicity")
def toxicity_scores(spark, folder):
    return toxicity.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op1_quality")
def quality_scores(spark, folder):
    return quality.classify(_table(spark, folder, "documents"))


@query("op5_lm_scoring")
def lm_scoring(spark, folder):
    return language_model.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op8_embedding_near_dedup")
def embedding_near_dedup(spark, folder):
    return graphs.near_duplicates(_table(spark, folder, "embeddings"))


@query("op11_whitening")
def embedding_whitening(spark, folder):
    return whitening.report(_table(spark, folder, "embeddings"))


@query("op12_quality_rules", quality_rules.SQL)
def rules(spark, folder):
    return quality_rules.report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op13_periodic_runs")
def periodic_runs(spark, folder):
    return runs.report(_table(spark, folder, "documents"))
