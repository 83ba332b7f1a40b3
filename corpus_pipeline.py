"""Corpus pipeline: from raw documents to sampled token ids, one operator of ``leadlens.llm`` a stage.

1. Quality rules: documents that the rules reject go.
2. Near duplicates (5-word shingles, similarity 0.8): one document of each group stays.
3. Secrets are replaced by a mark.
4. Sources are mixed to weights 3, 1, 2, ...: 150 % of the words, in op9's blocks of 16 words, no source beyond twice its size.
5. SentencePiece: two sampled segmentations of each text.

Edge cases, as the operators define them: a null or empty text has no words, fails the base rule of stage 1 and goes; long
texts are handled whole; a row that repeats id and text is one document in stage 2; a null source is a source of its own;
a null id is an id; an empty table gives an empty result; extra columns are carried to stage 4, whatever their names.

All stages but the last return the columns of ``documents``. ``run`` writes each stage as Parquet into the
shared checkpoint folder and reads it again, so a lost executor costs part of one stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import mixing, near_dup, piece_sampler, quality, secret_scan
from leadlens.llm.common import stored, table

MIX = mixing.Mix()


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the weakly supervised rules keep."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return near_dup.keep_one(docs, near_dup.NearDup(shingle=5, threshold=(80, 100)))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"])))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often, and as much of it, as its source's share takes."""
    return mixing.mixed(docs, MIX, length_col="n_chars")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each text as piece ids."""
    return piece_sampler.encode(docs, keep=("lang", "source"))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secrets", secrets),
          ("source mix", source_mix), ("pieces", pieces)]

#: No stage but the base counts of the first can be stated in SQL; tests hold parts of them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
