"""The corpus pipeline: documents in, clean tokenised documents out.

Five stages, each ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its
predecessor kept.  Each result is written as Parquet in the shared folder and
read back as the next one's input.  All stages but the last return the columns
of ``documents``; the last adds the token ids.

No stage drops a row for its id, length or source; ``n_chars``, where present,
follows the text.  Empty tables pass through; other columns of any name pass
through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, line_dedup, simhash, sp_codec
from strata.llm.common import aside, cut, table
from strata.llm.queries import vocabulary

#: A document goes when its best language is no further above chance than this share of the way to certainty.
LEAST_LANGUAGE = 0.05


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go, and those whose best language is no better than a guess.

    Without any labelled row there is no classifier, and only the letter counts.
    """
    net = langid.learn(docs, F.lit(True))
    inner, columns = aside(docs, ("lang_pred", "score", "lang_share"))
    if not net.labels:
        return inner.filter(F.rlike("text", F.lit(r"\p{L}"))).select(columns)
    out = langid.identify(inner, net)
    chance = 1 / len(net.labels)
    least = chance + LEAST_LANGUAGE * (1 - chance) if len(net.labels) > 1 else 0.0
    return out.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of lines that stand elsewhere; documents of which nothing is left go."""
    inner, columns = aside(docs, line_dedup.MADE)
    out = line_dedup.dedup_passages(inner)
    out = out.filter((F.col("removed_lines") == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    inner, columns = aside(docs, ("matches",))
    return decontam.overlaps(inner, table(spark, sf_dir, "benchmark")).filter(F.size("matches") == 0).select(columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; existing columns of the added names give way."""
    return sp_codec.encode_column(docs, vocabulary(spark))


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot train or run the network of the first stage; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
