"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing
of sources and packing, each stage on all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's rows as Parquet to
the shared folder and reads them back for the next.

Null and empty texts fail the quality rules; null ids are documents like others,
and so are repeated rows until near-duplicate removal leaves one of them. Other
columns are carried along whatever their names. An empty table passes through
all stages as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodframe.llm import lines, mixing, neardup, packing, quality
from moodframe.llm.common import stored, table, unused


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The forest is fitted on the labelled ones of ``docs``."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go, and documents that lose all
    their text. ``n_chars`` follows the text."""
    total, gone = unused(docs, "lines"), unused(docs, "lines_removed")
    done = lines.dedup_lines(docs, counts=(total, gone)).filter(~((F.col(gone) > 0) & F.col("text").rlike(r"\A[\x20\x09-\x0D]*\z")))
    size = F.when(F.col(gone) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", size).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources say."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("near-duplicate removal", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: The forest, the alignment and the tokenizer have no SQL; the tests hold every
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
