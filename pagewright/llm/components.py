"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators.scale import salted_lookup
from pagewright.session import stage

# links that a task holds at a time
HELD = 200_000


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _joined(links: list[pa.RecordBatch]) -> pa.RecordBatch:
    """What hangs together by the links, as links of its first node to each other one.

    A node that only has a link to itself keeps that.
    """
    ends = pa.chunked_array([batch.column(end) for end in ("a", "b") for batch in links]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(ends.dictionary).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    a, b = np.split(place[ends.indices.to_numpy()], 2)
    parent = list(range(len(order)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    first = np.array([find(x) for x in range(len(parent))])
    alone = np.bincount(first, minlength=len(first))[first] == 1
    kept = np.flatnonzero((first != np.arange(len(first))) | alone)
    return pa.RecordBatch.from_arrays([ends.dictionary.take(pa.array(order[some])) for some in (first[kept], kept)], names=["a", "b"])


def _stars(at_once: int):
    """Joins each ``at_once`` links of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                piece = batch.slice(at, at_once)
                if size + piece.num_rows > at_once:
                    yield _joined(held)
                    held, size = [], 0
                held.append(piece)
                size += piece.num_rows
        if size:
            yield _joined(held)

    return run


def _joined_in_tasks(links: DataFrame) -> DataFrame:
    """Links with the same components as ``links(a, b)``: in each task, stars around the smallest node."""
    known = links.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    return known.mapInArrow(_stars(HELD), known.schema)


def contractions(links: DataFrame) -> list[DataFrame]:
    """(node, to) of every round: what the nodes that still had links were contracted to.

    Links that a task holds together become stars first. In each round a node points to the first of its
    neighbours and itself in an order, and follows four such steps, which mostly end at a node that is
    first of its own neighbours. Links then join what their ends point to; loops and doubles go, and with
    them all nodes of finished components. Every other round, the first too, goes by the nodes
    themselves, which finishes stars around a smallest node; the rest by an order that is random and new
    each time, so that such a round leaves a third of the nodes or so whatever the graph's shape: long
    paths take at most two rounds for one of other graphs of their size.
    """
    rounds: list[DataFrame] = []
    links = stage(_joined_in_tasks(links).where("a <> b").select(*_ordered("a", "b")).distinct(), "links")
    while not links.isEmpty():
        turn = F.lit(len(rounds))
        both = links.union(links.select("b", "a"))
        at = [F.xxhash64(node, turn) if len(rounds) % 2 else F.col(node) for node in ("b", "node")]
        place = F.struct(at[0].alias("at"), F.col("b").alias("node"))
        own = F.struct(at[1].alias("at"), F.col("node"))
        step = stage(
            both.groupBy(F.col("a").alias("node")).agg(F.min(place).alias("near")).select(
                "node", F.least("near", own)["node"].alias("to")
            ),
            "steps",
        )
        for _ in range(2):
            further = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
            step = step.join(further, "to").select("node", F.col("further").alias("to"))
        step = stage(step, "contracted")
        rounds.append(step)
        ends = [step.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to")) for end in ("a", "b")]
        links = links.join(ends[0], "a").join(ends[1], "b").where("a_to <> b_to")
        links = stage(links.select(*_ordered("a_to", "b_to")).distinct(), "links")
    return rounds


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``, the component named by its smallest node.

    Links may repeat and may be loops; no links give no rows. Rows of all rounds together are a small
    multiple of the links, since finished components take no further part.
    """
    links = stage(_joined_in_tasks(links), "links")
    alone = links.where("a = b").select(F.col("a").alias("node")).distinct()
    rounds = contractions(links)
    if not rounds:
        return alone.select("node", F.col("node").alias("component"))
    found = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        last = found.select(F.col("node").alias("to"), F.col("to").alias("last"))
        found = earlier.join(last, "to", "left").select("node", F.coalesce("last", "to").alias("to"))
    found = stage(found, "found")
    least = found.groupBy("to").agg(F.min("node").alias("component"))
    named = salted_lookup(found, least, "to", "inner", ["node"]).select("node", "component")
    lone = alone.join(named, "node", "left_anti").select("node", F.col("node").alias("component"))
    return named.unionByName(lone)
