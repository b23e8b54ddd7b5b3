"""PageRank steps on blocks of edges give what steps row by row give."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.plans import pagerank, rank_blocks


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(pagerank, "LEAST_EDGES_PER_BLOCK", 50)


def ranks(df):
    return {r.node: round(r.rank, 9) for r in df.collect()}


def by_rows(edges, tolerance, last_step):
    degrees = edges.groupBy("source").agg(F.count("*").alias("degree"))
    links = pagerank.sliced_edges(edges, degrees)
    return ranks(pagerank.iterate_rows(links, degrees, tolerance, last_step, pagerank.DAMPING))


@pytest.fixture(scope="module")
def odd_edges(spark):
    """A hub both ways, a chain whose head is never a destination, a node that is never a source, null ends, repeats."""
    hub = [(0, i) for i in range(1, 300)] + [(i, 0) for i in range(1, 300, 2)]
    rest = [(i, i * 7 % 300) for i in range(300)] + [(5000 + i, 5001 + i) for i in range(9)] + [(1, -(2**62))]
    odd = [(None, 3), (4, None), (None, None), (9, 9), (9, 9), (2**63 - 1, -(2**63)), (-(2**63), 0)]
    return spark.createDataFrame(hub + rest + odd, "source long, dest long")


@pytest.mark.parametrize("last_step", [0, 3])
def test_blocks_equal_rows(odd_edges, last_step):
    found = ranks(pagerank.iterate_ranks(odd_edges, tolerance=None, last_step=last_step))
    assert found == by_rows(odd_edges, None, last_step)
    # the chain loses its head in each step
    assert min(node for node in found if node >= 5000) == 5001 + last_step


def test_blocks_follow_the_number_of_edges(spark, monkeypatch):
    assert [pagerank.edge_blocks(spark.range(rows)) for rows in (0, 60, 10_000)] == [1, 2, 8]
    monkeypatch.setattr(pagerank, "EDGES_PER_PARTITION", 100)
    assert pagerank.edge_blocks(spark.range(10_000)) == 100


def test_blocks_stop_where_rows_stop(odd_edges):
    assert ranks(pagerank.iterate_ranks(odd_edges)) == by_rows(odd_edges, pagerank.TOLERANCE, pagerank.LAST_STEP)


def test_steps_between_keys_move_no_rows(odd_edges, monkeypatch):
    def moved(*_):
        raise AssertionError("a row per edge")

    monkeypatch.setattr(pagerank, "received", moved)
    assert ranks(pagerank.iterate_ranks(odd_edges, last_step=1))


def test_no_edges(spark):
    assert ranks(pagerank.iterate_ranks(spark.createDataFrame([], "source long, dest long"))) == {}


def test_a_block_hands_on_one_sum_per_destination():
    """1,000 edges from 10 sources to 5 nodes of two other blocks leave as five sums."""
    edges = {"source": np.arange(1000) % 10, "dest": np.arange(1000) % 5, "part": np.zeros(1000, np.int32)}
    edges["home"] = (edges["dest"] % 2 + 1).astype(np.int32)

    class NoneHot:
        def among(self, _):
            return iter(())

        homes_of = among

    built = pa.Table.from_batches(rank_blocks._build(NoneHot(), 3)(iter([pa.record_batch(edges)])))
    assert built["peer"].to_pylist() == [-1, 0, 0]
    keys = [np.frombuffer(keys, np.int64).tolist() for keys in built["nodes"].to_pylist()[1:]]
    assert keys == [[0, 2, 4], [1, 3]]
    state = pa.table({"part": [0], "ranks": [np.ones(10).tobytes()]})
    sent = rank_blocks._send(built.slice(0, 1), state).to_pylist()
    sums = {row["part"]: np.frombuffer(row["sums"]).tolist() for row in sent}
    assert [(row["part"], row["peer"]) for row in sent] == [(0, -1), (1, 0), (2, 0)]
    assert sums[1] == pytest.approx([2.0] * 3) and sums[2] == pytest.approx([2.0] * 2)


def test_repair_keeps_edges_distinct(spark):
    edges = [("a", "b"), ("a", "b"), ("b", "a"), ("a", "c"), ("a", "c"), ("b", "c"), (None, "c"), ("a", None), ("a", None)]
    repaired = pagerank.repair_sinks(spark.createDataFrame(edges, "source string, dest string")).collect()
    expected = {*edges, ("c", "a"), ("c", "b"), ("c", None)}
    assert len(repaired) == len(expected) and {tuple(r) for r in repaired} == expected
