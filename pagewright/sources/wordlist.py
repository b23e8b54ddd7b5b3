"""Word lists for the token filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as (word)."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def without_words(terms: DataFrame, words: DataFrame) -> DataFrame:
    """Drop the rows whose term is in a word table of any length."""
    return terms.join(words.withColumnRenamed("word", "term"), "term", "left_anti")
