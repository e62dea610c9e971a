"""The corpus pipeline: documents to a training mix, in five stages, each one operator of ``marketframe.llm``.

1. language_id: learns from the labelled documents that are not held out; documents without a learned language go.
2. line_dedup: lines on over 5 % of a source's documents (five at least) are taken out of them.
3. ngram_jaccard: of documents whose word 5-grams are alike by 0.8 or more, directly or in a chain, one stays.
4. decontaminate: documents of which benchmark windows cover a twentieth or more go.
5. mix: sources are mixed to target weights; documents outside the mix go, ``taken`` counts the others' words, repeats included.

Each stage works on all documents that its predecessor kept. All but the last return the columns of ``documents``;
``n_chars`` follows the text. The stages' results are held against brute force in tests/llm/.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm.components import small_batches, written
from marketframe.llm.decontaminate import decontaminate
from marketframe.llm.jaccard import keep_one
from marketframe.llm.langid import held_out, keep_known, sample
from marketframe.llm.lines import line_dedup
from marketframe.llm.mix import mix

#: SQL can't express cross-parsing, so neither the whole.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_known(docs, sample(docs.where(~held_out() & F.col("doc_id").isNotNull())))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup(docs)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = mix(docs, keep=tuple(docs.columns)).where(F.col("taken") > 0)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns], "size", "source_size", F.round("target", 6).alias("target"), "taken")


STAGES = [("language_id", language_id), ("line_dedup", lines), ("ngram_jaccard", ngram_jaccard), ("decontaminate", benchmark), ("mix", source_mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
