"""PageRank steps run on numbers that stand for names."""

import pytest
from pyspark.sql import functions as F

from pagewright.plans import pagerank

EDGES = [("a", "b"), ("a", "c"), ("b", "a"), ("c", "a"), ("c", "b"), ("", "a"), ("a", ""), (None, "b"), ("b", None)]


def ranks(df):
    return sorted((r[0], round(r.rank, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "source string, dest string")


def test_edges_are_sorted_numbers(spark, edges):
    keyed, names = pagerank.with_keys(edges)
    assert [kind for _, kind in keyed.dtypes] == ["bigint", "bigint"]
    assert sorted(r.name for r in names.collect()) == ["", "a", "b", "c"]
    many = spark.range(5000).select((F.col("id") * 7919 % 500).alias("source"), (F.col("id") % 97).alias("dest"))
    links = pagerank.sliced_edges(many, many.groupBy("source").agg(F.count("*").alias("degree")))
    rows = links.select(F.spark_partition_id().alias("part"), "source", "slice").collect()
    assert len(rows) == 5000
    for part in {r.part for r in rows}:
        keys = [(r.source, r.slice) for r in rows if r.part == part]
        assert keys == sorted(keys)


@pytest.mark.parametrize("seeds", [2, 1])
def test_names_that_share_a_hash_stay_apart(edges, monkeypatch, seeds):
    expected = ranks(pagerank.iterate_ranks(edges))
    hashed = pagerank._name_key
    # with the first seed all names have one hash
    monkeypatch.setattr(pagerank, "_name_key", lambda name, seed: hashed(name, seed) if seed else F.lit(1))
    monkeypatch.setattr(pagerank, "HASH_SEEDS", seeds)
    assert ranks(pagerank.iterate_ranks(edges)) == expected
    assert {name for name, _ in expected} == {"", "a", "b", "c"}
