"""Link-graph jobs and PageRank."""

from pyspark.sql import functions as F

from pagewright.catalog import inputs as I
from pagewright.catalog.registry import query
from pagewright.catalog.relational_queries import REPAIRED
from pagewright.plans import pagerank
from pagewright.session import stage

CRAWLED = f"""
links AS ({I.LINKS}), urls AS ({I.URLS}), crawled AS (
  SELECT source, dest FROM links
  WHERE source IN (SELECT url FROM urls) AND dest IN (SELECT url FROM urls) AND source <> dest)"""


@query("G1_cleaned_url_links", f"WITH {CRAWLED} SELECT source, dest FROM crawled")
def _(t):
    return pagerank.crawled_links(t.sql(I.LINKS), t.sql(I.URLS))


@query("G2_domain_graph", f"""
WITH {CRAWLED}
SELECT DISTINCT regexp_extract(source, '//([^/]+)', 1) AS source, regexp_extract(dest, '//([^/]+)', 1) AS dest FROM crawled""")
def _(t):
    return pagerank.domain_graph(pagerank.crawled_links(t.sql(I.LINKS), t.sql(I.URLS)))


@query("G3_sink_repair", f"""
WITH e AS ({I.BIPARTITE})
SELECT dest AS source, source AS dest FROM e WHERE dest NOT IN (SELECT source FROM e) UNION SELECT source, dest FROM e""")
def _(t):
    return pagerank.repair_sinks(stage(t.sql(I.BIPARTITE), "edges"))


# all links; those to a URL that ends in 7 lead to a file without links
FILE_LINKS = f"SELECT source, CASE WHEN dest LIKE '%7' THEN concat(dest, '.pdf') ELSE dest END AS dest FROM ({I.LINKS}) l"


@query("G4_url_level_cleaning", f"""
WITH links AS ({FILE_LINKS}), e AS (SELECT source, dest FROM links WHERE source <> dest)
SELECT dest AS source, source AS dest FROM e WHERE dest NOT IN (SELECT source FROM e) UNION SELECT source, dest FROM e""")
def _(t):
    return pagerank.clean_url_graph(t.sql(FILE_LINKS))


def repaired(t):
    """The sink-repaired links, stored: several steps read them."""
    return stage(pagerank.repair_sinks(stage(t.sql(I.EDGES), "edges")), "repaired")


@query("G5_out_weights", f"WITH {REPAIRED} SELECT source, round(1.0 / count(*), 8) AS out_weight FROM repaired GROUP BY source")
def _(t):
    weights = pagerank.out_weights(repaired(t))
    return weights.select("source", F.round("out_weight", 8).alias("out_weight"))


@query("G6_initial_ranks", f"WITH {REPAIRED} SELECT DISTINCT source AS node, CAST(1.0 AS DOUBLE) AS rank FROM repaired")
def _(t):
    return pagerank.initial_ranks(repaired(t))


def steps_sql(edges: str, last: int) -> str:
    return f"""
WITH RECURSIVE e AS ({edges}),
repaired AS (SELECT dest AS source, source AS dest FROM e WHERE dest NOT IN (SELECT source FROM e) UNION SELECT source, dest FROM e),
w AS (SELECT source, CAST(1.0 AS DOUBLE) / count(*) AS out_weight FROM repaired GROUP BY source),
ranks(step, node, rank) AS (
  SELECT -1 AS step, source AS node, CAST(1.0 AS DOUBLE) AS rank FROM w
  UNION ALL
  SELECT step + 1, l.dest, sum(w.out_weight * p.rank) * 0.85 + 0.15
  FROM repaired l JOIN w ON l.source = w.source JOIN ranks p ON l.source = p.node
  WHERE step < {last} GROUP BY step, l.dest),
diffs AS (SELECT c.step, max(abs(p.rank - c.rank)) AS diff FROM ranks p JOIN ranks c ON p.node = c.node AND c.step = p.step + 1 GROUP BY c.step),
final AS (SELECT node, rank FROM ranks WHERE step = (SELECT coalesce(min(step), {last}) FROM diffs WHERE diff < 0.1)),
standard AS (SELECT node, (rank - (SELECT avg(rank) FROM final)) / (SELECT stddev_samp(rank) FROM final) AS rank FROM final),
normal AS (SELECT node AS domain, (rank - (SELECT min(rank) FROM standard)) / (SELECT max(rank) - min(rank) FROM standard) AS rank FROM standard)"""


@query("G7_rank_step", steps_sql(I.EDGES, 0) + " SELECT node, round(rank, 8) AS rank FROM ranks WHERE step = 0")
def _(t):
    edges = repaired(t)
    step = pagerank.rank_step(edges, pagerank.out_weights(edges), pagerank.initial_ranks(edges))
    return step.select("node", F.round("rank", 8).alias("rank"))


@query("G8_iterate_to_convergence", steps_sql(I.EDGES, 100) + " SELECT node, round(rank, 6) AS rank FROM final")
def _(t):
    ranks = pagerank.iterate_ranks(repaired(t))
    return ranks.select("node", F.round("rank", 6).alias("rank"))


@query("G9_normalise_ranks", """
WITH z AS (SELECT p_partkey AS domain, (p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_samp(p_retailprice) FROM part) AS rank FROM part)
SELECT domain, round((rank - (SELECT min(rank) FROM z)) / (SELECT max(rank) - min(rank) FROM z), 8) AS rank FROM z""")
def _(t):
    ranks = t.part.select(F.col("p_partkey").alias("node"), F.col("p_retailprice").alias("rank"))
    return pagerank.normalise_ranks(ranks).select("domain", F.round("rank", 8).alias("rank"))


@query("G10_pagerank", steps_sql(I.EDGES, 100) + " SELECT domain, round(rank, 6) AS rank FROM normal")
def _(t):
    return pagerank.pagerank(t.sql(I.EDGES)).select("domain", F.round("rank", 6).alias("rank"))


@query("G10_pagerank_bipartite", steps_sql(I.BIPARTITE, 100) + " SELECT domain, round(rank, 6) AS rank FROM normal")
def _(t):
    return pagerank.pagerank(t.sql(I.BIPARTITE)).select("domain", F.round("rank", 6).alias("rank"))
