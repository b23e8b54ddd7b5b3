"""Block-max retrieval gives the rows of the plain index and reads fewer postings."""

import random

import pytest
from pyspark.sql import functions as F

from pagewright.plans import blocks, index, search
from pagewright.session import stage

QUERIES = [(1, "common topic3"), (2, "common shared"), (3, "topic1 topic9 common common"), (4, "unknown"), (5, ""), (6, None)]


def corpus(spark, n=600):
    """Every document holds ``common``, most hold ``shared``; neighbouring ids share a topic; some are empty."""
    rng = random.Random(5)
    rows = []
    for id in range(n):
        words = ["common"] * rng.randint(1, 3) + ["shared"] * (rng.random() < 0.7)
        words += [f"topic{id // 40}"] * rng.randint(0, 4) + [f"word{rng.randint(0, 300)}" for _ in range(6)]
        rows.append((id - 100, " ".join(words)))
    return spark.createDataFrame([*rows, (5000, ""), (5001, None)], "id long, text string")


@pytest.fixture(scope="module")
def built(spark):
    docs = corpus(spark)
    inverted, idfs = index.build_index(docs, stem=False, stop_words=None)
    table, block_idfs = blocks.build_block_index(docs, stem=False, stop_words=None, block_ids=16)
    asked = spark.createDataFrame(QUERIES, "qid int, query string")
    weights = search.query_weights(search.query_counts(asked, stem=False), idfs)
    return docs, inverted, idfs, table, block_idfs, weights


def scores(df):
    return [(r.qid, r["rank"], r.id, None if r.score is None else round(r.score, 9)) for r in df.orderBy("qid", "rank").collect()]


def test_same_idfs(built):
    _, _, idfs, _, block_idfs, _ = built
    assert {r.term: r.idf for r in idfs.collect()} == {r.term: r.idf for r in block_idfs.collect()}


@pytest.mark.parametrize("scorer", ["cosine", "dot"])
@pytest.mark.parametrize("k", [1, 10, 1000])
def test_same_rows(built, scorer, k):
    _, inverted, _, table, _, weights = built
    plain = scores(search.retrieve(inverted, weights, k, scorer))
    assert plain
    assert scores(search.retrieve(table, weights, k, scorer)) == plain


@pytest.mark.parametrize("scorer", ["cosine", "dot"])
def test_same_rows_with_ranks(built, scorer):
    docs, inverted, _, table, _, weights = built
    ranks = docs.where("id % 3 <> 0").select("id", (F.col("id") % 7 / 10).alias("rank"))
    plain = scores(search.retrieve(inverted, weights, 10, scorer, ranks))
    assert scores(search.retrieve(table, weights, 10, scorer, ranks)) == plain


@pytest.mark.parametrize("scorer", ["cosine", "dot"])
def test_no_score_exceeds_its_bound(built, scorer):
    _, inverted, _, table, _, weights = built
    found = search.SCORERS[scorer](search.matching_postings(inverted, weights), weights)
    bounds = blocks.block_bounds(table, weights, scorer)
    placed = found.withColumn("block", blocks.block_of(F.col("id"), 16)).join(bounds, ["qid", "block"])
    assert placed.count() == found.count()
    assert placed.where("score > bound + 1e-9").count() == 0


def test_a_frequent_term_is_read_in_few_blocks(built):
    """Query 1 asks for a term of every document and one of 40 of them."""
    _, inverted, _, table, _, weights = built
    one = weights.where("qid = 1")
    bounds = blocks.block_bounds(table, one, "dot")
    leading = blocks.leading_blocks(bounds, 10)
    first = search.top_scores(search.dot_of(blocks.matches_in(table, one, leading), one), 10)
    floors = first.where("rank = 10").select("qid", F.col("score").alias("floor"))
    others = blocks.reaching_blocks(bounds, leading, floors)
    opened = blocks.matches_in(table, one, leading.unionByName(others)).count()
    assert opened * 5 < search.matching_postings(inverted, one).count()


def test_empty_tables(spark, built):
    *_, table, _, weights = built
    nothing = blocks.BlockIndex(table.postings.limit(0), table.bounds.limit(0), 16)
    assert search.retrieve(nothing, weights, 10).count() == 0
    assert search.retrieve(table, weights.limit(0), 10).count() == 0


def test_postings_are_not_shuffled_by_term(spark, built):
    """While the query's terms and the chosen blocks are small, nothing but scores travels."""
    _, _, _, table, _, weights = built
    chosen = stage(blocks.leading_blocks(blocks.block_bounds(table, weights, "dot"), 10), "chosen")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "24KB")
    try:
        met = blocks.matches_in(table, weights, chosen)
        assert "hashpartitioning(term" not in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wanted = chosen.join(weights, "qid").join(table.postings, ["term", "block"])
    assert met.count() == wanted.count() > 0
