"""Documents to training data: five stages, each one operator of ``pagewright.llm``.

A stage's input is a stored table, so a stage begins by removing what the stage before it had written
for itself, and nothing else.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import mixing, ngram_join, quality_rules, sentencepiece, suffix_dedup
from pagewright.session import recorded, remove_tables, scratch_path, tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _tidy(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_tables(spark, _left)
        with recorded(_left):
            return stage(spark, docs, sf_dir)

    return tidied


@_tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality_rules.keep_good(docs, COLUMNS)


@_tidy
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five words at 0.8: of documents that hang together the first stays."""
    return ngram_join.one_of_each(docs, ngram_join.FIVE_WORDS_80, COLUMNS)


@_tidy
def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: passages of 50 words or more that stand anywhere else are cut out.

    Every document stays, with what is left of its text, which may be nothing.
    """
    cut = suffix_dedup.remove_repeats(docs, suffix_dedup.WORDS_50, tuple(COLUMNS))
    text = F.col("kept").cast("string")
    changed = F.col("n_removed") > 0
    return cut.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


@_tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: whole documents, a row for each time one is taken."""
    return mixing.mixed_documents(docs, COLUMNS)


@_tidy
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: the token ids of each text, and whether they decode to it."""
    return sentencepiece.encode_documents(docs, sentencepiece.load(MODEL_PATH), ("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("ngram_join", near_duplicate_stage),
    ("suffix_dedup", repeat_stage),
    ("source_mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

# shingle joins, suffix sorting and tokenizing have no SQL form; the stages are tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        remove_tables(spark, before)
        docs = spark.read.parquet(path)
        before.append(path)
    remove_tables(spark, _left)
    return docs
