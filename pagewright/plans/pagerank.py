"""Link-graph cleaning and PageRank with sink repair."""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType
from pyspark.storagelevel import StorageLevel

from pagewright.functions.url import authority
from pagewright.operators.gates import without_self_links
from pagewright.operators.scale import HOT_SHARE, hot_keys, salted_lookup, slices_of
from pagewright.plans.rank_blocks import iterate_blocks
from pagewright.session import checkpointed, stage

DAMPING = 0.85
TOLERANCE = 0.1
LAST_STEP = 100
EDGES_PER_PARTITION = 2_000_000
LEAST_EDGES_PER_BLOCK = 250_000
HASH_SEEDS = 4


def crawled_links(links: DataFrame, urls: DataFrame) -> DataFrame:
    """Links between two crawled URLs, self links removed."""
    known = urls.select("url").distinct()
    links = without_self_links(links)
    # one page may be the source or the target of a third of all links
    hot = hot_keys(links, "source", "dest")
    for end, other in (("source", "dest"), ("dest", "source")):
        found = known.withColumnRenamed("url", end)
        links = salted_lookup(links, found, end, "inner", [other], hot=hot[end])
    return links.select("source", "dest")


def domain_graph(links: DataFrame) -> DataFrame:
    """Distinct pairs of authorities; links inside a domain remain as self loops."""
    return links.select(
        authority(F.col("source")).alias("source"), authority(F.col("dest")).alias("dest")
    ).distinct()


def sinks(edges: DataFrame) -> DataFrame:
    """Destinations that are never a source."""
    return (
        edges.select(F.col("dest").alias("sink"))
        .distinct()
        .join(edges.select(F.col("source").alias("sink")).distinct(), "sink", "left_anti")
    )


def back_edges(edges: DataFrame, dead_ends: DataFrame) -> DataFrame:
    """The reverse of every edge into a sink."""
    into = salted_lookup(
        edges, dead_ends.withColumnRenamed("sink", "dest"), "dest", "inner", ["source"]
    )
    return into.select(F.col("dest").alias("source"), F.col("source").alias("dest"))


def repair_sinks(edges: DataFrame, repeats: bool = True) -> DataFrame:
    """Edges plus back edges out of sinks, distinct; ``repeats=False`` when no edge comes twice.

    A back edge begins at a sink, where no edge begins, so only the edges themselves may repeat.
    """
    edges = edges.select("source", "dest")
    edges = stage(edges.distinct() if repeats else edges, "distinct-edges")
    return back_edges(edges, sinks(edges)).unionByName(edges)


def clean_url_graph(links: DataFrame) -> DataFrame:
    """Sink-repaired graph on URLs instead of domains."""
    return repair_sinks(stage(without_self_links(links).select("source", "dest"), "links"))


def out_weights(edges: DataFrame) -> DataFrame:
    """1 / out-degree per source, as a double (a decimal would lose digits at every step)."""
    return edges.groupBy("source").agg((F.lit(1.0) / F.count("*")).alias("out_weight"))


def initial_ranks(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source").alias("node")).distinct().withColumn("rank", F.lit(1.0))


def rank_step(
    edges: DataFrame, weights: DataFrame, ranks: DataFrame, damping: float = DAMPING
) -> DataFrame:
    """One step: every node sends rank * weight along each of its edges.

    Rank and weight meet on the node table, so the edges are joined once; the edges of a hub are joined
    in slices.
    """
    shares = weights.join(ranks.withColumnRenamed("node", "source"), "source").select(
        "source", (F.col("out_weight") * F.col("rank")).alias("share")
    )
    degree = F.round(1 / F.col("out_weight"))
    total = weights.agg(F.sum(degree)).scalar()
    hubs = weights.where(degree * HOT_SHARE >= total).select("source", slices_of(degree, total).alias("slices"))
    return received(salted_lookup(edges, shares, "source", "inner", ["dest"], hot=hubs), damping)


def received(sent: DataFrame, damping: float = DAMPING) -> DataFrame:
    return sent.groupBy(F.col("dest").alias("node")).agg(
        (F.sum("share") * damping + (1 - damping)).alias("rank")
    )


def rank_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Largest absolute change over nodes present in both steps."""
    both = before.alias("p").join(after.alias("c"), "node")
    return both.agg(F.max(F.abs(F.col("p.rank") - F.col("c.rank"))).alias("max_diff"))


def _hot_sources(degrees: DataFrame) -> DataFrame:
    """Sources with at least ``1/HOT_SHARE`` of all edges, hence at most ``HOT_SHARE`` rows."""
    total = degrees.agg(F.sum("degree")).scalar()
    hot = degrees.where(F.col("degree") * HOT_SHARE >= total)
    return F.broadcast(hot.select("source", slices_of(F.col("degree"), total).alias("parts")))


def with_keys(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Stored edges between 64-bit hashes of the nodes' names, and the (node, name) of all nodes.

    Numbers are cheaper to sort and to move than names. No two names share a key: after a shared hash
    another seed is tried, and after a few the names stay. Edges between other types are their own keys.
    A null name stays null, so it still meets nothing.
    """
    ends = ["source", "dest"]
    if any(edges.schema[end].dataType != StringType() for end in ends):
        return edges, None
    found = edges.select(F.col("source").alias("name")).union(edges.select("dest"))
    names = stage(found.where("name IS NOT NULL").distinct(), "names")
    for seed in range(HASH_SEEDS):
        key = partial(_name_key, seed=seed)
        keyed = names.select(key(F.col("name")).alias("node"), "name")
        if keyed.groupBy("node").agg(F.count("*").alias("sharing")).where("sharing > 1").isEmpty():
            return edges.select(*[key(F.col(end)).alias(end) for end in ends]), keyed
    return edges, None


def _name_key(name: Column, seed: int) -> Column:
    return F.when(name.isNotNull(), F.xxhash64(name, F.lit(seed)))


def with_names(ranks: DataFrame, names: DataFrame | None) -> DataFrame:
    """(node, rank) by name again."""
    if names is None:
        return ranks
    return ranks.join(names, "node").select(F.col("name").alias("node"), "rank")


def dealt_edges(edges: DataFrame, degrees: DataFrame, parts: int) -> DataFrame:
    """Edges in ``parts`` partitions by (source, slice); only hot sources have more than one slice."""
    slice_of = F.pmod(F.xxhash64("dest"), F.coalesce("parts", F.lit(1))).cast("int")
    return (
        edges.join(_hot_sources(degrees), "source", "left")
        .select("source", "dest", slice_of.alias("slice"))
        .repartition(parts, "source", "slice")
    )


def sliced_edges(edges: DataFrame, degrees: DataFrame) -> DataFrame:
    """Dealt edges in the order of the join, so that, once they are persisted, no step sorts them.

    There are as many partitions as the number of edges asks for.
    """
    least = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, math.ceil(edges.count() / EDGES_PER_PARTITION))
    return dealt_edges(edges, degrees, parts).sortWithinPartitions("source", "slice")


def edge_blocks(edges: DataFrame) -> int:
    """Into how many blocks edges go: as many as there are shuffle partitions, if they are large enough, or more."""
    rows, usual = edges.count(), int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, math.ceil(rows / LEAST_EDGES_PER_BLOCK))
    return max(min(usual, most), math.ceil(rows / EDGES_PER_PARTITION))


def starting_state(degrees: DataFrame) -> DataFrame:
    """(node, rank = 1, out_weight, slices): what a node needs to send its rank along its edges."""
    slices = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    return degrees.join(_hot_sources(degrees), "source", "left").select(
        F.col("source").alias("node"),
        F.lit(1.0).alias("rank"),
        (F.lit(1.0) / F.col("degree")).alias("out_weight"),
        slices.alias("slices"),
    )


def iterate_ranks(
    edges: DataFrame,
    tolerance: float | None = TOLERANCE,
    last_step: int = LAST_STEP,
    damping: float = DAMPING,
) -> DataFrame:
    """Ranks of a sink-repaired graph after the first step that changes no node by ``tolerance`` or
    more, or after ``last_step``. ``tolerance=None`` runs all steps.

    A node that receives nothing drops out; as every receiver is a source, the state only ever shrinks.
    Without any node left to compare, the iteration ends. Between 64-bit keys the steps run on blocks of
    edges, between others row by row.
    """
    edges, names = with_keys(stage(edges.select("source", "dest"), "edges"))
    degrees = stage(edges.groupBy("source").agg(F.count("*").alias("degree")), "degrees")
    if all(edges.schema[end].dataType == LongType() for end in ("source", "dest")):
        parts, hot = edge_blocks(edges), degrees.join(_hot_sources(degrees), "source")
        ranks = iterate_blocks(dealt_edges(edges, degrees, parts), hot, parts, tolerance, last_step, damping)
    else:
        ranks = iterate_rows(sliced_edges(edges, degrees), degrees, tolerance, last_step, damping)
    return with_names(ranks, names)


def iterate_rows(
    links: DataFrame, degrees: DataFrame, tolerance: float | None, last_step: int, damping: float
) -> DataFrame:
    """(node, rank) after the steps over sliced edges between nodes of any type.

    The edges are persisted once; a step moves one row per node and the partial sums, never the edges.
    One job per step computes, checkpoints and measures the change: as the state only ever shrinks, an
    inner join with the sums is the next state.
    """
    links = links.persist(StorageLevel.MEMORY_AND_DISK)
    # fill the cache first: its partitioning is known to the planner only afterwards
    links.count()
    state = checkpointed(starting_state(degrees))
    try:
        for step in range(last_step + 1):
            shares = state.select(
                F.col("node").alias("source"),
                F.explode("slices").alias("slice"),
                (F.col("out_weight") * F.col("rank")).alias("share"),
            )
            sums = received(links.join(shares, ["source", "slice"]), damping)
            before = state.withColumnRenamed("rank", "before")
            change = Observation(f"rank-change-{step}")
            following = sums.join(before, "node").observe(
                change, F.max(F.abs(F.col("rank") - F.col("before"))).alias("max_diff")
            )
            state = checkpointed(following.select("node", "rank", "out_weight", "slices"))
            largest = change.get["max_diff"]
            if tolerance is not None and (largest is None or largest < tolerance):
                break
    finally:
        links.unpersist()
    return state.select("node", "rank")


def normalise_ranks(ranks: DataFrame) -> DataFrame:
    """Scaled to [0, 1]; NULL when all ranks are equal.

    Standardising first, as is usual, gives the same: a linear map does not change min-max scaling.
    """
    span = ranks.agg(F.min("rank").alias("low"), F.max("rank").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    return ranks.select(
        F.col("node").alias("domain"), F.try_divide(F.col("rank") - low, high - low).alias("rank")
    )


def pagerank(
    edges: DataFrame,
    tolerance: float | None = TOLERANCE,
    last_step: int = LAST_STEP,
    damping: float = DAMPING,
) -> DataFrame:
    """Normalised PageRank (domain, rank) of a raw edge table."""
    # distinct here costs nothing where a query has just made it so, and names are distinct as keys
    keyed, names = with_keys(stage(edges.select("source", "dest").distinct(), "raw-edges"))
    repaired = repair_sinks(keyed, repeats=False)
    return normalise_ranks(with_names(iterate_ranks(repaired, tolerance, last_step, damping), names))
