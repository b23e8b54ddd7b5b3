"""PageRank steps on blocks of edges: arrays instead of a row per edge.

A block is the edges of one partition of ``pagerank.dealt_edges``, by destination. In a step it adds up what
its sources send to each destination it knows and hands these sums, one array per block, to the blocks
that hold the destinations as sources. What goes where is agreed once, so later neither keys nor edges move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pagewright.session import batches_by_rows, checkpointed

# what a block needs in each step: weights of its sources; of each edge, by destination, the place of its
# source; how many edges a destination has; which sums to hand on, if not all in turn; how many to which block
ARRAYS = ("weights", "sources", "counts", "sent", "shares")
BUILT = f"part int, peer int, nodes binary, {', '.join(f'{name} binary' for name in ARRAYS)}"
RECEIVERS = "part int, peer int, places binary"
MESSAGES = "part int, peer int, sums binary"
STATE = "part int, ranks binary, change double"
RANKS = "node long, rank double"


def _values(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy() if column.num_chunks else np.empty(0, np.int64)


def _array(table: pa.Table, column: str, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(table[column][row].as_buffer(), kind)


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest asks for, which the first byte tells."""
    kind = np.min_scalar_type(int(numbers.max()) if len(numbers) else 0)
    return bytes([kind.itemsize] * 8) + numbers.astype(kind).tobytes()


def _unpacked(table: pa.Table, column: str, row: int) -> np.ndarray:
    held = table[column][row].as_buffer()
    return np.frombuffer(held, f"u{np.frombuffer(held, np.uint8, 1)[0]}", offset=8)


def _dealt(values: np.ndarray, shares: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, values) of the blocks that get some."""
    ends = np.cumsum(shares, dtype=np.int64)
    for peer in np.flatnonzero(shares):
        yield int(peer), values[ends[peer] - shares[peer] : ends[peer]]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts, dtype=np.int64) - counts


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    columns = [column.split() for column in schema.split(", ")]
    values = zip(*rows) if rows else [()] * len(columns)
    return pa.table({name: pa.array(v, kinds[kind]) for (name, kind), v in zip(columns, values)})


def home(node: Column | str, piece: Column | str, parts: int) -> Column:
    """The partition that ``repartition(parts, node, piece)`` puts a row in."""
    return F.pmod(F.hash(node, piece), F.lit(parts))


class Hot:
    """The few sources that are cut into slices: their degrees, and the blocks each may be in."""

    def __init__(self, hot: DataFrame, parts: int):
        pieces = hot.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        homes = F.sort_array(F.collect_set(home("source", "slice", parts)))
        rows = pieces.where("source IS NOT NULL").groupBy("source", "degree").agg(homes.alias("homes")).collect()
        self.homes = {row.source: (row.degree, row.homes) for row in rows}

    def among(self, nodes: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """(place, degree, blocks) of those in the sorted ``nodes``."""
        for node, (degree, homes) in self.homes.items():
            place = int(np.searchsorted(nodes, node))
            if place < len(nodes) and nodes[place] == node:
                yield place, degree, homes

    def homes_of(self, known: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """(place, blocks) of those among the ``known``, in any order."""
        if self.homes:
            order = np.argsort(known)
            for place, _, homes in self.among(known[order]):
                yield int(order[place]), homes


def _build(hot: Hot, parts: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        edges = pa.Table.from_batches(batches)
        del batches
        part = int(edges["part"][0].as_py())
        if not (_values(edges["part"]) == part).all():
            raise ValueError("edges of one partition belong to several blocks")
        nodes, places, degrees = np.unique(_values(edges["source"]), return_inverse=True, return_counts=True)
        for place, degree, _ in hot.among(nodes):
            degrees[place] = degree
        # an edge to no node counts for the degree and leads nowhere
        met = edges["dest"].is_valid().to_numpy()
        dest, to = _values(edges["dest"].drop_null()), _values(edges["home"].filter(pa.array(met)))
        places = places[met]
        del edges
        order = np.argsort(dest)
        dest, places, to = dest[order], places[order], to[order]
        starts = np.flatnonzero(np.append(True, dest[1:] != dest[:-1])) if len(dest) else np.empty(0, np.int64)
        known, to, counts = dest[starts], to[starts], np.diff(np.append(starts, len(dest)))
        # destinations by the block they are in
        order = np.argsort(to, kind="stable")
        known, to, counts, starts = known[order], to[order], counts[order], starts[order]
        places = places[np.repeat(starts - _starts(counts), counts) + np.arange(len(places))]
        sent = np.empty(0, np.int64)
        if cut := list(hot.homes_of(known)):
            whole = np.ones(len(known), bool)
            whole[[place for place, _ in cut]] = False
            sent = np.concatenate([np.flatnonzero(whole), *[np.full(len(homes), place) for place, homes in cut]])
            to = np.concatenate([to[whole], *[np.array(homes) for _, homes in cut]])
            order = np.argsort(to, kind="stable")
            to, sent = to[order], sent[order]
        shares = np.bincount(to, minlength=parts)
        arrays = [_packed(numbers) for numbers in (places, counts, sent, shares)]
        rows = [(part, -1, nodes.tobytes(), (1.0 / degrees).tobytes(), *arrays)]
        for peer, wanted in _dealt(known[sent] if cut else known, shares):
            rows.append((peer, part, wanted.tobytes(), *[None] * len(ARRAYS)))
        yield from _rows(BUILT, rows).to_batches(max_chunksize=64)

    return build


def _ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ones = [np.ones(len(nodes.as_buffer()) // 8).tobytes() for nodes in batch["nodes"]]
        yield pa.record_batch({"part": batch["part"], "ranks": pa.array(ones, pa.binary())})


def _meet(nodes: pa.Table, keys: pa.Table) -> pa.Table:
    """The places, among a block's nodes, of the keys that each peer will send sums for; one beyond for others."""
    mine = _array(nodes, "nodes", 0, np.int64) if nodes.num_rows else np.empty(0, np.int64)
    rows = []
    for row in range(keys.num_rows if len(mine) else 0):
        wanted = _array(keys, "nodes", row, np.int64)
        places = np.minimum(np.searchsorted(mine, wanted), len(mine) - 1)
        places = np.where(mine[places] == wanted, places, len(mine))
        rows.append((keys["part"][row].as_py(), keys["peer"][row].as_py(), _packed(places)))
    return _rows(RECEIVERS, rows)


def _send(block: pa.Table, state: pa.Table) -> pa.Table:
    """What a block adds up for each other; its own ranks go to itself. A rank that is not a number is none."""
    if not block.num_rows or not state.num_rows:
        return _rows(MESSAGES, [])
    sources, counts, sent, shares = (_unpacked(block, name, 0) for name in ARRAYS[1:])
    weights, ranks = _array(block, "weights", 0, np.float64), _array(state, "ranks", 0, np.float64)
    part = block["part"][0].as_py()
    rows = [(part, -1, ranks.tobytes())]
    if len(counts):
        gone, starts = np.isnan(ranks), _starts(counts)
        sums = np.add.reduceat(np.where(gone, 0.0, ranks * weights)[sources], starts)
        if gone.any():
            sums[np.logical_and.reduceat(gone[sources], starts)] = np.nan
        for peer, part_of_them in _dealt(sums[sent] if len(sent) else sums, shares):
            rows.append((peer, part, part_of_them.tobytes()))
    return _rows(MESSAGES, rows)


def _receive(damping: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def receive(receivers: pa.Table, messages: pa.Table) -> pa.Table:
        sums = {peer: row for row, peer in enumerate(messages["peer"].to_pylist())}
        if -1 not in sums:
            return _rows(STATE, [])
        before = _array(messages, "sums", sums[-1], np.float64)
        # the last place is for nodes that are no source
        received, ranks = np.zeros(len(before) + 1, bool), np.zeros(len(before) + 1)
        # by peer, so that all blocks of a sliced source get the same sum
        for peer, row in sorted((peer, row) for row, peer in enumerate(receivers["peer"].to_pylist())):
            if peer not in sums:
                continue
            places, values = _unpacked(receivers, "places", row), _array(messages, "sums", sums[peer], np.float64)
            there = ~np.isnan(values)
            if not there.all():
                places, values = places[there], values[there]
            ranks[places] += values
            received[places] = True
        received, ranks = received[:-1], ranks[:-1]
        received &= ~np.isnan(before)
        ranks = np.where(received, ranks * damping + (1 - damping), np.nan)
        change = float(np.abs(ranks - before)[received].max()) if received.any() else None
        return _rows(STATE, [(messages["part"][0].as_py(), ranks.tobytes(), change)])

    return receive


def _found(hot: Hot) -> Callable:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nodes in zip(batch["part"].to_pylist(), batch["nodes"]):
                nodes = np.frombuffer(nodes.as_buffer(), np.int64)
                places = [place for place, _, _ in hot.among(nodes)]
                yield pa.record_batch({"node": nodes[places], "part": np.full(len(places), part, np.int32)})

    return found


def _unfold(hot: Hot, first: dict[int, int]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ranks by node; a sliced source is in several blocks and comes from the ``first`` only."""

    def unfold(block: pa.Table, state: pa.Table) -> pa.Table:
        if not block.num_rows or not state.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "rank": pa.array([], pa.float64())})
        nodes, ranks = _array(block, "nodes", 0, np.int64), _array(state, "ranks", 0, np.float64)
        kept = ~np.isnan(ranks)
        for place, _, _ in hot.among(nodes):
            kept[place] &= first[int(nodes[place])] == block["part"][0].as_py()
        return pa.table({"node": nodes[kept], "rank": ranks[kept]})

    return unfold


def iterate_blocks(
    links: DataFrame, hot: DataFrame, parts: int, tolerance: float | None, last_step: int, damping: float
) -> DataFrame:
    """(node, rank) after the steps over ``links``, edges between 64-bit keys in ``parts`` partitions by (source, slice).

    ``hot`` is (source, degree, parts) of the sources with more than one slice. The steps and their
    end are those of ``iterate_ranks``.
    """

    # with fewer than the usual number of partitions a step would deal the blocks out again
    spread = max(parts, int(links.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(spread, "part").sortWithinPartitions("part").persist(StorageLevel.MEMORY_AND_DISK)

    def both(left: DataFrame, right: DataFrame, run: Callable, schema: str) -> DataFrame:
        return left.groupBy("part").cogroup(right.groupBy("part")).applyInArrow(run, schema)

    known = Hot(hot, parts)
    edges = links.where("source IS NOT NULL").select(
        "source", "dest", home("source", "slice", parts).alias("part"), home("dest", F.lit(0), parts).alias("home")
    )
    held = []
    try:
        with batches_by_rows(links.sparkSession):
            held.append(built := edges.mapInArrow(_build(known, parts), BUILT).persist(StorageLevel.MEMORY_AND_DISK))
            held.append(blocks := dealt(built.where("peer < 0").select("part", *ARRAYS)))
            # fill a cache first: its partitioning is known to the planner only afterwards
            blocks.count()
        nodes = checkpointed(built.where("peer < 0").select("part", "nodes"))
        receivers = dealt(both(nodes, built.where("peer >= 0").select("part", "peer", "nodes"), _meet, RECEIVERS))
        held.append(receivers)
        receivers.count()
        # the blocks and the receivers hold all of it
        held.pop(0).unpersist()
        state = nodes.mapInArrow(_ones, "part int, ranks binary")
        for step in range(last_step + 1):
            messages = both(blocks, state, _send, MESSAGES)
            change = Observation(f"rank-change-{step}")
            following = both(receivers, messages, _receive(damping), STATE)
            state = checkpointed(following.observe(change, F.max("change").alias("max_diff")).select("part", "ranks"))
            largest = change.get["max_diff"]
            if tolerance is not None and (largest is None or largest < tolerance):
                break
    finally:
        for table in held:
            table.unpersist()
    copies = nodes.mapInArrow(_found(known), "node long, part int").groupBy("node").agg(F.min("part").alias("part"))
    return both(nodes, state, _unfold(known, dict(copies.collect())), RANKS)
