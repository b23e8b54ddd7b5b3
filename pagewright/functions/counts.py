"""Term counts of one document, as an array of (term, n).

A document is one row, so counting its terms needs no shuffle: only the exploded (id, term, n) rows
ever travel. Tokenizing is native; the counting itself, together with stemming, is one Arrow batch
call, as an array has no native way to group its elements in linear time. Words stay in Arrow memory;
only the distinct ones of a few rows become Python objects, and only to be stemmed.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from pagewright.functions.exprs import once
from pagewright.functions.stem import stem_word

# rows counted in one go: what bounds a worker's memory, however many rows a batch has
ROWS_AT_ONCE = 1024

TERM_COUNTS = StructType(
    [
        StructField("max_n", LongType()),
        StructField(
            "terms",
            ArrayType(StructType([StructField("term", StringType()), StructField("n", LongType())])),
        ),
    ]
)


def _row_counts(fields: tuple[pa.Array, ...], weights: tuple[int, ...], stem: bool) -> pa.Array:
    """The counts of some rows: a key is a row and the code of a word, and equal keys are counted."""
    size = len(fields[0])
    rows = [np.repeat(np.arange(size), pc.fill_null(pc.list_value_length(field), 0)) for field in fields]
    tokens = pa.concat_arrays([field.flatten() for field in fields]).dictionary_encode("encode")
    codes, words = tokens.indices.to_numpy(), tokens.dictionary
    if stem:
        stems = pa.array(map(stem_word, words.to_pylist()), pa.string()).dictionary_encode("encode")
        codes, words = stems.indices.to_numpy()[codes], stems.dictionary
    kinds = max(len(words), 1)
    keys = np.concatenate(rows) * kinds + codes
    if set(weights) == {1}:
        keys, numbers = np.unique(keys, return_counts=True)
    else:
        keys, places = np.unique(keys, return_inverse=True)
        each = np.repeat(weights, [len(row) for row in rows])
        numbers = np.bincount(places, each, len(keys)).astype(np.int64)
    owners = keys // kinds
    largest = np.zeros(size, np.int64)
    np.maximum.at(largest, owners, numbers)
    ends = np.searchsorted(owners, np.arange(size + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([words.take(pa.array(keys % kinds)), pa.array(numbers)], ["term", "n"])
    lists = pa.ListArray.from_arrays(pa.array(ends), pairs)
    return pa.StructArray.from_arrays([pa.array(largest), lists], TERM_COUNTS.fieldNames())


@cache
def _counter(weights: tuple[int, ...], stem: bool):
    @F.arrow_udf(TERM_COUNTS)
    def count(*fields: pa.Array) -> pa.Array:
        starts = range(0, max(len(fields[0]), 1), ROWS_AT_ONCE)
        return pa.concat_arrays(
            [_row_counts(tuple(field.slice(at, ROWS_AT_ONCE) for field in fields), weights, stem) for at in starts]
        )

    return once(count)


def weighted_counts(token_arrays: list[Column], weights: tuple[int, ...], stem: bool) -> Column:
    """Counts over several token arrays; an occurrence in the i-th counts ``weights[i]`` times."""
    return _counter(weights, stem)(*token_arrays)


def exploded_counts(
    rows: DataFrame, key: str, token_arrays: list[Column], weights: tuple[int, ...], stem: bool
) -> DataFrame:
    """(key, term, n, max_n): the counts of each row and the largest of them."""
    counted = rows.select(key, weighted_counts(token_arrays, weights, stem).alias("c"))
    return counted.select(key, F.col("c.max_n").alias("max_n"), F.explode("c.terms").alias("t")).select(
        key, F.col("t.term").alias("term"), F.col("t.n").alias("n"), "max_n"
    )
