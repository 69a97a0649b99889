"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, per_line: int = 12) -> str:
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    out = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(out[i:i + per_line]) for i in range(0, words, per_line))


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and blank texts, a very long text, repeated
    rows, equal texts under different ids, equal ids under different texts, and
    extra columns named like the operators' own."""
    long_text = prose(1, 20_000)
    rows = [
        (1, prose(2, 200), "en", "a", 5), (1, prose(2, 200), "en", "a", 5), (2, prose(2, 200), "en", "b", 5),
        (2, prose(3, 100), None, "b", None), (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \n\t\n", "en", None, 4),
        (None, prose(4, 80), "en", None, 1), (None, prose(4, 80), "en", None, 1), (None, None, None, None, None),
        (6, long_text, "en", "c", 1), (7, "word", "fr", "c", 4), (8, "Été \U0001f600 中文 x\x00y", "fr", "c", 9),
    ]
    extra = ("key long, id string, node string, row string, size double, part long, name string, words int, "
             "lines int, spans string, kept string, source_size int, copies int, begin int, text_hashes string, next int")
    n = len(extra.split(", "))
    return spark.createDataFrame([r + (None,) * n for r in rows], f"{DOCS}, {extra}")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)
