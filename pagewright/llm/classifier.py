"""A quality classifier: gradient-boosted trees on histograms of document statistics.

The statistics are worked out by Spark for all documents. The trees are fitted on a bounded sample of
labelled rows and flattened into arrays, which every task walks for a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.quality_rules import base_statistics
from pagewright.session import stage

MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 32
LEARNING_RATE, L2, MIN_ROWS = 0.15, 1.0, 5
HELD_OUT = 2
FOLDS = 4


def _per(part: str, of: str) -> Column:
    return F.col(part) / F.greatest(F.col(of), F.lit(1))


def features() -> dict[str, Column]:
    """Inputs of a score, all from the text."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": _per("word_chars", "n_words"),
        "symbols": _per("n_symbols", "n_words"),
        "dup_lines": _per("n_dup_lines", "n_lines"),
        "repeats": _per("n_repeat_words", "n_words"),
        "odd_ends": _per("n_odd_ends", "n_lines"),
        "capitals": _per("n_upper", "word_chars"),
        "exclaims": _per("n_exclaims", "n_words"),
        "echoes": _per("n_echoes", "n_words"),
        "words_per_line": _per("n_words", "n_lines"),
    }


@dataclass
class Forest:
    """Complete trees as arrays: node i of a tree has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # trees x inner nodes: at most this goes left
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _log_odds(y: np.ndarray) -> float:
    share = (y.sum() + 0.5) / (len(y) + 1)
    return float(np.log(share / (1 - share)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Trees for log loss; a split is the best cut between histogram bins by second-order gain.

    With no rows, or labels of one kind, the forest has no trees and gives the share of label 1.
    """
    inner = 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        trees = 0
    base = _log_odds(y)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1) if len(x) else x
    feature = np.zeros((trees, inner), dtype=np.int64)
    limit = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for i in range(inner):
            here = np.flatnonzero(node == i)
            cut = _best_cut(bins[here], gradient[here], weight[here], cuts) if len(here) else None
            if cut is None:
                node[here] = 2 * i + 1
                continue
            feature[t, i], b = cut
            limit[t, i] = cuts[feature[t, i]][b]
            node[here] = 2 * i + 1 + (bins[here, feature[t, i]] > b)
        for i in range(inner + 1):
            here = node == inner + i
            leaf[t, i] = -LEARNING_RATE * gradient[here].sum() / (weight[here].sum() + L2)
        total += leaf[t, node - inner]
    return Forest(base, feature, limit, leaf)


def _best_cut(bins, gradient, weight, cuts) -> tuple[int, int] | None:
    best, found = 1e-6, None
    whole = gradient.sum() ** 2 / (weight.sum() + L2)
    for f, limits in enumerate(cuts):
        if not len(limits):
            continue
        size = len(limits) + 1
        g = np.cumsum(np.bincount(bins[:, f], gradient, size))[:-1]
        h = np.cumsum(np.bincount(bins[:, f], weight, size))[:-1]
        n = np.cumsum(np.bincount(bins[:, f], minlength=size))[:-1]
        gain = g**2 / (h + L2) + (gradient.sum() - g) ** 2 / (weight.sum() - h + L2) - whole
        gain[(n < MIN_ROWS) | (len(bins) - n < MIN_ROWS)] = -1
        if gain.max() > best:
            best, found = gain.max(), (f, int(gain.argmax()))
    return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def training_rows(labelled: DataFrame, names: list[str], n: int) -> DataFrame:
    """``names`` and quality of the first ``n`` rows of ``labelled`` by hash of doc_id, then by value.

    Rows are counted by the leading 16 bits of the hash first, so that of a table of any size only
    the ranges that hold the first ``n`` are sorted; what is returned is stored, ``n`` rows at most.
    """
    hashed = stage(labelled.select("doc_id", *names, "quality", F.xxhash64("doc_id").alias("_hash")), "labelled")
    lead = F.shiftright("_hash", 48)
    sizes = hashed.groupBy(lead.alias("lead")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("lead")) - F.col("rows")
    last = sizes.withColumn("before", before).where(F.col("before") < n).agg(F.max("lead").alias("last"))
    near = hashed.join(F.broadcast(last), lead <= F.col("last"))
    first = near.orderBy("_hash", "doc_id", *names, "quality").limit(n)
    return stage(first.select(*names, "quality"), "training")


def score_quality(
    docs: DataFrame, labels: DataFrame, max_training_rows: int = MAX_TRAINING_ROWS, threshold: float = 0.7
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``.

    ``labels(doc_id, quality)`` of held-out documents are not looked at; of the others, at most
    ``max_training_rows`` labelled rows, the first in an order by hash, fit the trees. Only
    statistics of the text are inputs. All rows are scored.

    Null labels are left out; a doc_id with both labels counts as 0. A null doc_id is not held out
    and never labelled. Null and empty texts are scored like any text, by their zero statistics.
    Without labels every score is 0.5. No documents give no rows; further columns are ignored.
    """
    names = list(features())
    table = stage(base_statistics(docs).select("doc_id", *[c.alias(n) for n, c in features().items()]), "statistics")
    known = (
        labels.select("doc_id", "quality")
        .where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("quality"))
    )
    sample = training_rows(table.join(known, "doc_id"), names, max_training_rows).toPandas()
    forest = fit(sample[names].to_numpy(dtype=np.float64), sample["quality"].to_numpy(dtype=np.float64))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = forest.score(batch[names].to_numpy(dtype=np.float64))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": score,
                    "predicted": (score >= threshold).astype(np.int32),
                }
            )

    return table.withColumn("held_out", held_out(F.col("doc_id"))).mapInPandas(
        walk, f"doc_id {dict(table.dtypes)['doc_id']}, held_out boolean, score double, predicted int"
    )
