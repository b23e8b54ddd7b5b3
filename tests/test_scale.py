"""Operators that split hot keys give the same rows as their plain forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagewright.operators import frontier, scale, tables
from pagewright.plans import index, pagerank, search


def skewed(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 101)
    return spark.range(n).select("id", key.alias("k"), (F.col("id") * 37 % 1009).alias("v"))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_keys_found(spark):
    slices = dict(rows(scale.hot_keys(skewed(spark), "k")["k"]))
    # a third of the rows, eight slices for each of eight partitions
    assert 21 <= slices[7] <= 23


def test_a_hot_key_is_shared_out(spark):
    """A key with a third of the rows, and as many nulls: no partition holds twice the mean."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 5003 + 10)
    facts = spark.range(60_000).select("id", key.alias("k"))
    lookup = spark.range(6000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    saved = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for name, value in zip(saved, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        joined = scale.salted_lookup(facts, lookup, "k", "left", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in saved.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 60_000
    assert max(sizes) < 2 * 60_000 / 8


def test_salted_lookup(spark):
    facts = skewed(spark)
    lookup = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left"):
        salted = scale.salted_lookup(facts, lookup, "k", how, ["id"]).select("id", "k", "v", "w")
        assert rows(salted.fillna(-1)) == rows(facts.join(lookup, "k", how).select("id", "k", "v", "w").fillna(-1))


def test_salted_lookup_keeps_null_keys_on_the_left(spark):
    facts = spark.createDataFrame([(1, None), (2, "a")], "id long, k string")
    lookup = spark.createDataFrame([("a", 5)], "k string, w int")
    joined = scale.salted_lookup(facts, lookup, "k", "left", ["id"])
    assert {r.id: r.w for r in joined.collect()} == {1: None, 2: 5}


def test_positions(spark):
    df = skewed(spark)
    whole = Window.orderBy("v", "id")
    assert rows(scale.positions(df, ["v", "id"])) == rows(df.withColumn("position", F.row_number().over(whole).cast("long")))
    grouped = Window.partitionBy("k").orderBy("v", "id")
    expected = df.withColumn("position", F.row_number().over(grouped).cast("long"))
    assert rows(scale.positions(df, ["v", "id"], group="k")) == rows(expected)


def test_top_k_per_group(spark):
    df = skewed(spark)
    order = [F.col("v").desc(), F.col("id")]
    expected = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order))).where("rank <= 5")
    assert rows(scale.top_k_per_group(df, ["k"], order, 5, "id")) == rows(expected)


def test_top_k_cuts_before_the_shuffle(spark):
    df = skewed(spark)
    plan = scale.top_k_per_group(df, ["k"], [F.col("v").desc(), F.col("id")], 2000, "id")
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_top_k_slices_are_tasks(spark):
    """A task sends at most k rows of a group; beyond Spark's limit for that rows are dealt by their key."""
    df = skewed(spark)
    order = [F.col("v").desc(), F.col("id")]

    def plan(k):
        return scale.top_k_per_group(df, ["k"], order, k, "id")._jdf.queryExecution().optimizedPlan().toString()

    assert "SPARK_PARTITION_ID" in plan(5) and "xxhash64" not in plan(5)
    assert "xxhash64" in plan(5000)


def test_pagerank_with_a_hub(spark):
    """One source holds a third of the edges: same ranks as plain steps."""
    hub = spark.range(1, 400).select(F.lit(0).cast("long").alias("source"), F.col("id").alias("dest"))
    rest = spark.range(800).select((F.col("id") % 400).alias("source"), (F.col("id") * 7 % 400).alias("dest"))
    edges = pagerank.repair_sinks(hub.union(rest).distinct())
    expected = pagerank.initial_ranks(edges)
    for _ in range(3):
        expected = pagerank.rank_step(edges, pagerank.out_weights(edges), expected)
    ranks = pagerank.iterate_ranks(edges, tolerance=None, last_step=2)
    found = {r.node: round(r.rank, 9) for r in ranks.collect()}
    assert found == {r.node: round(r.rank, 9) for r in expected.collect()}


def test_edges_are_not_shuffled_again(spark):
    edges = spark.range(100).select(F.col("id").alias("source"), (F.col("id") * 3 % 100).alias("dest"))
    degrees = edges.groupBy("source").agg(F.count("*").alias("degree"))
    links = pagerank.sliced_edges(edges, degrees).persist()
    links.count()
    shares = pagerank.starting_state(degrees).select(
        F.col("node").alias("source"), F.explode("slices").alias("slice"), F.col("rank").alias("share")
    )
    plan = links.join(shares.hint("merge"), ["source", "slice"])._jdf.queryExecution().executedPlan().toString()
    above_cache = plan.split("InMemoryTableScan")[0]
    links.unpersist()
    assert "Exchange" not in above_cache


def test_first_per_content_is_stable(spark):
    docs = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, "x")], "id long, text string")
    kept = tables.first_per_content(docs, "text", ["id"], "id")
    assert rows(kept) == [(1, "x"), (2, "y")]
    assert rows(tables.first_per_content(kept, "text", ["id"], "id")) == [(1, "x"), (2, "y")]


def test_url_ids_stay(spark):
    first = tables.upsert_urls(spark.createDataFrame([], "id long, url string"), spark.createDataFrame([("b",), ("a",), ("b",)], "url string"))
    assert rows(first) == [(1, "a"), (2, "b")]
    second = tables.upsert_urls(first, spark.createDataFrame([("a",), ("0",), (None,)], "url string"))
    assert rows(second) == [(1, "a"), (2, "b"), (3, "0")]


def test_a_hub_step_is_joined_in_slices(spark):
    """One node holds half of all edges: a step equals the plain join and never meets the hub whole."""
    hub = spark.range(3000).select(F.lit(0).cast("long").alias("source"), (F.col("id") + 1).alias("dest"))
    edges = hub.union(spark.range(1, 3001).select(F.col("id").alias("source"), (F.col("id") % 7).alias("dest")))
    weights, ranks = pagerank.out_weights(edges), pagerank.initial_ranks(edges)
    sent = edges.join(weights, "source").withColumnRenamed("out_weight", "share")
    expected = {r.node: round(r.rank, 9) for r in pagerank.received(sent).collect()}
    step = pagerank.rank_step(edges, weights, ranks)
    assert {r.node: round(r.rank, 9) for r in step.collect()} == expected
    assert "_salt" in step._jdf.queryExecution().optimizedPlan().toString()


def test_edge_partitions_follow_their_number(spark, monkeypatch):
    edges = spark.range(2000).select(F.col("id").alias("source"), (F.col("id") + 1).alias("dest"))
    degrees = edges.groupBy("source").agg(F.count("*").alias("degree"))
    monkeypatch.setattr(pagerank, "EDGES_PER_PARTITION", 100)
    assert pagerank.sliced_edges(edges, degrees).rdd.getNumPartitions() == 20


def test_domain_cap(spark):
    arrivals = spark.createDataFrame(
        [("http://a.com/1", 1), ("http://b.com/1", 2), ("http://a.com/2", 3), ("http://c.com/1", 4), ("http://a.com/3", 5)],
        "url string, arrived_at int",
    )
    kept = frontier.domain_cap(arrivals, 2)
    assert sorted(r.arrived_at for r in kept.collect()) == [1, 2]
    assert frontier.domain_cap(arrivals, 9).count() == 5


def test_crawl_progress(spark):
    polls = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 90)], "polled_at int, docs long")
    assert [r.stop for r in frontier.crawl_progress(polls, 50).orderBy("polled_at").collect()] == [False, False, True, True]


def test_latest_by_key_breaks_ties_alike(spark):
    updates = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "x"), ("b", 1, "x"), (None, 3, "n")]
    schema = "k string, seq int, text string"
    found = rows(tables.latest_by_key(spark.createDataFrame(updates, schema), "k", "seq").fillna("-"))
    again = rows(tables.latest_by_key(spark.createDataFrame(updates[::-1], schema), "k", "seq").fillna("-"))
    assert found == again
    assert [r[:2] for r in found] == [("-", 3), ("a", 2), ("b", 1)]


def test_full_search_on_a_small_corpus(spark):
    """The whole plan against the steps written out by hand."""
    from test_goldens import brute_bonus

    from pagewright.plans import index

    docs = [(1, "graph engine graph"), (2, "engine rank"), (3, "graph rank rank"), (4, "other words"), (5, "more other words")]
    inverted, idfs = index.build_index(spark.createDataFrame(docs, "id long, text string"))
    urls = spark.createDataFrame([(i, f"http://h{i}.com:80/p") for i, _ in docs], "id long, url string")
    pages = [(1, "Graph Engines", "about graphs", "engine", ""), (2, "Engine", "rank it", "", ""), (4, "x", "y", "z", "")]
    content = spark.createDataFrame(pages, "id long, title string, content string, headers string, body string")
    ranks = spark.createDataFrame([("h1.com:80", 0.5), ("h2.com:80", 1.0)], "domain string, rank double")
    queries = spark.createDataFrame([(1, "Graph engine"), (2, "nothing here")], "qid long, query string")
    found = search.search(queries, inverted, idfs, urls, content, ranks).orderBy("rank").collect()

    import math

    idf = {r.term: r.idf for r in idfs.collect()}
    weight = {(r.id, r.term): r.weight for r in inverted.collect()}
    asked = {"graph": 0.5 + 0.5 * idf["graph"], "engin": 0.5 + 0.5 * idf["engin"]}
    expected = {}
    for i, _ in docs:
        doc = {t: weight.get((i, t), 0.0) for t in asked}
        if not any((i, t) in weight for t in asked):
            continue
        dot = sum(asked[t] * doc[t] for t in asked)
        norms = math.sqrt(sum(v * v for v in asked.values())) * math.sqrt(sum(v * v for v in doc.values()))
        pr = {1: 0.5, 2: 1.0}.get(i, 0.00001)
        score = 0.013 * math.log(max(pr, 0.1)) + 0.987 * dot / norms
        page = next((p for p in pages if p[0] == i), None)
        if page:
            score += brute_bonus(page[1], page[3], page[2], "Graph engine", {t: idf[t] for t in asked})
        expected[i] = score
    assert {r.qid for r in found} == {1}
    assert [r.id for r in found] == sorted(expected, key=lambda i: -expected[i])
    assert {r.id: round(r.score, 9) for r in found} == {i: round(s, 9) for i, s in expected.items()}
    assert {r.id: r.title for r in found}[3] == "http://h3.com:80/p"


def test_full_search_finds_plain_documents(spark):
    from pagewright.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    found = QUERIES["X15_full_search"](spark, folder).where("id >= 1000000")
    index = QUERIES["X1_stemmed_page_index"](spark, folder)
    titles = spark.read.parquet(f"{folder}/pages.parquet").selectExpr(
        "regexp_extract(url, '//([^/]+)', 1) AS host", "page_id", "regexp_extract(html, '<title>([^<]*)', 1) AS query"
    )
    asked = titles.groupBy("host").agg(F.min("page_id").alias("qid"), F.min("query").alias("query"))
    terms = search.query_counts(asked.select("qid", "query"), True).select("qid", "term")
    expected = index.where("id >= 1000000").join(terms, "term").select("qid", "id").distinct()
    assert expected.count() > 0
    assert rows(found.select("qid", "id")) == rows(expected)
    assert found.where("title <> url OR preview <> '' OR url IS NULL").count() == 0


def test_frequent_terms_meet_their_idf_unshuffled(spark):
    counts = spark.range(3000).selectExpr("id", "CAST(id % 4 AS STRING) AS term", "1L AS n", "1L AS max_n")
    rare = spark.createDataFrame([(1, "once", 1, 1), (2, None, 1, 1)], "id long, term string, n long, max_n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        postings, idfs = index.postings_with_idf(counts.unionByName(rare), 3000, 0.5)
        plan = postings._jdf.queryExecution().executedPlan().toString()
        frequent = plan[plan.index("Union") :].split("SortMergeJoin")[0]
        assert "BroadcastHashJoin" in frequent and "hashpartitioning" not in frequent
        rows = postings.groupBy("term", "idf").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    idf_of = {r.term: r.idf for r in idfs.collect()}
    assert {(r.term, r.idf, r["count"]) for r in rows} == {(str(i), idf_of[str(i)], 750) for i in range(4)} | {("once", idf_of["once"], 1)}
