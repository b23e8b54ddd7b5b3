"""Term counts equal a plain count, and words are objects only for the stems of a few rows."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.functions import counts
from pagewright.functions.stem import stem_word

rng = random.Random(3)
WORDS = ["run", "running", "runs", "öl", "x", "cat", "cats", "1e5"]
ROWS = [None, [], *[[rng.choice(WORDS) for _ in range(rng.randint(0, 30))] for _ in range(40)]]


@pytest.mark.parametrize("stem", [False, True])
@pytest.mark.parametrize("weights", [(1,), (3,), (1, 4, 10), (1, 1)])
def test_counts(spark, monkeypatch, weights, stem):
    monkeypatch.setattr(counts, "ROWS_AT_ONCE", 7)
    fields = [ROWS[i:] + ROWS[:i] for i in range(len(weights))]
    expected = []
    for row in zip(*fields):
        total = Counter()
        for weight, words in zip(weights, row):
            for word in words or ():
                total[stem_word(word) if stem else word] += weight
        expected.append((max(total.values(), default=0), dict(total)))
    names = [f"f{i}" for i in range(len(weights))]
    kinds = ", ".join(f"{name} array<string>" for name in names)
    table = spark.createDataFrame([(i, *row) for i, row in enumerate(zip(*fields))], f"id int, {kinds}")
    found = table.select("id", counts.weighted_counts([F.col(n) for n in names], weights, stem).alias("c")).orderBy("id")
    assert [(r.c.max_n, {t.term: t.n for t in r.c.terms}) for r in found.collect()] == expected
    assert all(len({t.term for t in r.c.terms}) == len(r.c.terms) for r in found.collect())


def test_words_stay_in_arrow_memory(monkeypatch):
    asked = []
    monkeypatch.setattr(counts, "stem_word", lambda word: asked.append(word) or word)
    rows = pa.array([["a", "b", "a"] * 1000] * 50)
    counts._row_counts((rows,), (1,), True)
    assert sorted(asked) == ["a", "b"]
    asked.clear()
    found = counts._row_counts((rows.slice(10, 3),), (1,), False)
    assert asked == [] and found.to_pylist() == [
        {"max_n": 2000, "terms": [{"term": "a", "n": 2000}, {"term": "b", "n": 1000}]}
    ] * 3


def test_remembered_stems_are_bounded():
    assert stem_word.cache_info().maxsize <= 1 << 17
