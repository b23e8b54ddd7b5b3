"""TF-IDF inverted index: per-document term frequencies, document frequencies, weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.counts import exploded_counts
from pagewright.functions.text import STOP_WORDS, index_terms, legacy_index_terms
from pagewright.operators.scale import HOT_SHARE, spread
from pagewright.session import stage

SMOOTHING = 0.5
FIELD_SMOOTHING = 0.4
# occurrences in a heading or title count on top of the one in the page text
FIELD_BOOSTS = {"text": 1, "headers": 4, "title": 10}


def term_counts(
    docs: DataFrame,
    text: str = "text",
    tokenizer: Callable[[Column], Column] = index_terms,
    stem: bool = True,
) -> DataFrame:
    """Term counts and the largest count per document, without a shuffle; ``id`` is unique."""
    rows = spread(docs.select("id", text))
    return exploded_counts(rows, "id", [tokenizer(F.col(text))], (1,), stem)


def term_frequency(n: Column, max_n: Column, a: float) -> Column:
    return F.lit(a) + (1 - a) * n / max_n


def document_frequencies(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def inverse_document_frequency(n_docs: int | Column, df: Column) -> Column:
    """ln(N / (df + 1)); zero or negative for terms found almost everywhere."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return F.log(n.cast("double") / (df + 1))


def postings_with_idf(counts: DataFrame, n_docs: int, a: float) -> tuple[DataFrame, DataFrame]:
    """(id, term, tf, idf) postings and (term, idf) from term counts.

    The postings are written once and read by both outputs. Terms that hold at least ``1/HOT_SHARE`` of
    them, at most ``HOT_SHARE`` terms, meet their idf where they are; only the other postings are shuffled.
    """
    postings = stage(
        counts.select("id", "term", term_frequency(F.col("n"), F.col("max_n"), a).alias("tf")),
        "postings",
    )
    frequencies = stage(document_frequencies(postings), "document-frequencies")

    def idf_of(some: DataFrame) -> DataFrame:
        return some.select("term", inverse_document_frequency(n_docs, F.col("df")).alias("idf"))

    idfs = idf_of(frequencies)
    total = frequencies.agg(F.sum("df")).scalar()
    hot = idf_of(frequencies.where(F.col("df") * HOT_SHARE >= total))
    frequent = postings.join(F.broadcast(hot), "term")
    others = postings.join(F.broadcast(hot.select("term")), "term", "left_anti").join(idfs, "term")
    return frequent.unionByName(others), idfs


def weighted_postings(counts: DataFrame, n_docs: int, a: float) -> tuple[DataFrame, DataFrame]:
    """(inverted index, idfs) from term counts."""
    postings, idfs = postings_with_idf(counts, n_docs, a)
    return postings.select("id", "term", (F.col("tf") * F.col("idf")).alias("weight")), idfs


def build_index(
    docs: DataFrame,
    text: str = "text",
    a: float = SMOOTHING,
    stem: bool = True,
    stop_words: list[str] | None = STOP_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """Inverted index (id, term, weight) and idfs (term, idf) of (id, text) documents.

    The corpus size counts every row, whether or not it yields a term.
    """
    counts = term_counts(docs, text, lambda c: index_terms(c, stop_words), stem)
    return weighted_postings(counts, docs.count(), a)


def field_counts(
    content: DataFrame,
    boosts: dict[str, int] = FIELD_BOOSTS,
    stem: bool = True,
    stop_words: list[str] | None = STOP_WORDS,
) -> DataFrame:
    """Boosted term counts over several text columns of one row."""
    tokens = [legacy_index_terms(F.col(field), stop_words) for field in boosts]
    rows = spread(content.select("id", *boosts))
    return exploded_counts(rows, "id", tokens, tuple(boosts.values()), stem)


def build_field_index(
    content: DataFrame,
    boosts: dict[str, int] = FIELD_BOOSTS,
    a: float = FIELD_SMOOTHING,
    stem: bool = True,
    stop_words: list[str] | None = STOP_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """Index in which heading and title words weigh more."""
    counts = field_counts(content, boosts, stem, stop_words)
    return weighted_postings(counts, content.count(), a)
