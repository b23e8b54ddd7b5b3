"""Prefix trie of conversations, with totals over the subtree of every node.

A node is a distinct sequence of first turns, named by its depth and a 128-bit fingerprint: the
exclusive or of one value per (place, turn), so it is a running total that may go on across the
partitions of a long conversation.

Subtree totals come by time-forward processing. Conversations are dealt to shards by their first
turns; a shard holds all prefixes of its conversations, so every node's ancestors are beside it. A
shard's nodes are sorted by Spark in reverse level order and read once: a node takes what its children
sent from a priority queue, which spills when it grows, and sends its own total to its parent. A node
counts in one shard only, that of its smallest member. What shards hold in common, the nodes above the
shard roots and those of hot first turns, are then added up across shards.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators.scale import HOT_SHARE, salted_lookup, slices_of
from pagewright.session import stage

# a node: its depth and the two halves of its fingerprint
NODE = ["depth", "fp1", "fp2"]
PARENT = ["up1", "up2"]
# turns that decide a conversation's shard
SHARD_TURNS = 2
ROWS_PER_SHARD = 200_000
# messages a shard's queue holds in memory, and how many of a spilled run are read at a time
QUEUE_LIMIT = 200_000
RUN_BUFFER = 1_000
# conversation ids in one piece of a node's list of ends
IDS_PER_PIECE = 4_096

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def said(role: Column, text: Column) -> Column:
    """One value for what a turn says; its role cannot run into its text."""
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


class SpillingQueue:
    """A priority queue, smallest key first, that holds about ``limit`` entries in memory.

    Beyond that the later half is written as a sorted run to a file of the task's own, which is gone
    with the task; of each run one buffer is held.
    """

    def __init__(self, limit: int = QUEUE_LIMIT):
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.held = 0

    def push(self, key: tuple, amounts: tuple[int, int]) -> None:
        heapq.heappush(self.heap, (key, amounts, -1))
        self.held += 1
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        entries = sorted(entry for entry in self.heap if entry[2] < 0)
        later = entries[len(entries) // 2 :]
        self.heap = entries[: len(entries) // 2] + [entry for entry in self.heap if entry[2] >= 0]
        heapq.heapify(self.heap)
        self.held -= len(later)
        file = tempfile.TemporaryFile()
        for i in range(0, len(later), RUN_BUFFER):
            pickle.dump([entry[:2] for entry in later[i : i + RUN_BUFFER]], file)
        file.seek(0)
        self.runs.append(self._entries(file))
        self._next_of(len(self.runs) - 1)

    @staticmethod
    def _entries(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    buffer = pickle.load(file)
                except EOFError:
                    return
                yield from buffer

    def _next_of(self, run: int) -> None:
        entry = next(self.runs[run], None)
        if entry is not None:
            heapq.heappush(self.heap, (*entry, run))

    def take(self, key: tuple) -> tuple[int, int]:
        """The sum of all amounts sent to ``key``; the queue's smallest key is never below it."""
        first = second = 0
        while self.heap and self.heap[0][0] == key:
            _, amounts, run = heapq.heappop(self.heap)
            first, second = first + amounts[0], second + amounts[1]
            if run < 0:
                self.held -= 1
            else:
                self._next_of(run)
        return first, second


def _long_table(**columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(values, pa.int64()) for values in columns.values()], list(columns))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the prefixes within a partition sorted by conversation and depth."""
    part = TaskContext.get().partitionId()
    last, carried = None, (0, 0)
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        conv = batch["conv_id"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        sizes = np.diff(np.append(starts, n))
        out, carry = [], []
        for name, before in zip(("fp1", "fp2"), carried, strict=True):
            values = batch[name].to_numpy()
            sums = np.bitwise_xor.accumulate(values)
            base = np.where(starts > 0, sums[starts - 1], 0)
            if conv[0] == last:
                base[0] ^= before
            after = sums ^ np.repeat(base, sizes)
            out += [after, after ^ values]
            carry.append(int(after[-1]))
        last, carried = conv[-1], tuple(carry)
        yield _long_table(
            part=np.full(n, part), conv_id=conv, depth=batch["depth"].to_numpy(),
            fp1=out[0], fp2=out[2], up1=out[1], up2=out[3], chars=batch["chars"].to_numpy(),
        )


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, node, parent, chars) of every prefix that ``turns(conv_id, depth, said, chars)`` makes.

    Rows are range partitioned by conversation and depth; a conversation that spans partitions is
    continued from the totals of the partitions before, one row per partition at most.
    """
    values = turns.select(
        "conv_id",
        "depth",
        F.xxhash64(F.lit(1), "depth", "said").alias("fp1"),
        F.xxhash64(F.lit(2), "depth", "said").alias("fp2"),
        "chars",
    )
    within = stage(
        values.repartitionByRange("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth")
        .mapInArrow(_running, "part long, conv_id long, depth long, fp1 long, fp2 long, up1 long, up2 long, chars long"),
        "prefixes",
    )
    # the conversation a partition begins with may come from the partitions before, which it ends
    last = within.groupBy("part").agg(F.max(F.struct("conv_id", "depth", "fp1", "fp2")).alias("last"))
    first = within.groupBy("part").agg(F.min("conv_id").alias("conv_id"))
    nothing = F.lit(0).cast("long")
    marks = first.select("part", "conv_id", F.lit(0).alias("ends"), nothing.alias("fp1"), nothing.alias("fp2")).union(
        last.select("part", "last.conv_id", F.lit(1), "last.fp1", "last.fp2")
    )
    before = Window.partitionBy("conv_id").orderBy("part", "ends").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.expr(f"bit_xor({name})").over(before).alias(to) for name, to in (("fp1", "c1"), ("fp2", "c2"))]
    carried = F.broadcast(marks.select("part", "conv_id", "ends", *sums).where("ends = 0 AND c1 IS NOT NULL").drop("ends"))

    def moved(name: str, by: str) -> Column:
        return F.col(name).bitwiseXOR(F.coalesce(by, F.lit(0).cast("long"))).alias(name)

    return within.join(carried, ["part", "conv_id"], "left").select(
        "conv_id", "depth", moved("fp1", "c1"), moved("fp2", "c2"), moved("up1", "c1"), moved("up2", "c2"), "chars"
    )


def _name(depth: Column, first: str, second: str) -> Column:
    return F.concat_ws(":", depth.cast("string"), F.hex(first), F.hex(second))


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of the nodes of each shard, which come in reverse level order."""
    shard, queue = None, SpillingQueue()
    for batch in batches:
        totals = []
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            of, depth, fp1, fp2, up1, up2, leaves, saved = row
            if of != shard:
                shard, queue = of, SpillingQueue()
            below = queue.take((-depth, fp1, fp2))
            total = leaves + below[0], saved + below[1]
            totals.append((depth, fp1, fp2, *total))
            if depth > 0:
                queue.push((1 - depth, up1, up2), total)
        if totals:
            names = ("depth", "fp1", "fp2", "leaves", "saved")
            yield _long_table(**dict(zip(names, zip(*totals, strict=True), strict=True)))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow each other, joined to pieces of a list."""
    for batch in batches:
        rows = []
        for *node, conv_id in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if not rows or rows[-1][0] != node or len(rows[-1][1]) == IDS_PER_PIECE:
                rows.append((node, []))
            rows[-1][1].append(conv_id)
        yield pa.record_batch(
            [pa.array([node[i] for node, _ in rows], pa.int64()) for i in range(3)]
            + [pa.array([ids[0] for _, ids in rows], pa.int64()), pa.array([",".join(map(str, ids)) for _, ids in rows], pa.string())],
            [*NODE, "first", "ids"],
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's whole list, whose pieces come in order; no list is held."""
    current, state = None, None

    def table(rows):
        return pa.record_batch(
            [pa.array([node[i] for node, _ in rows], pa.int64()) for i in range(3)]
            + [pa.array([made for _, made in rows], pa.string())],
            [*NODE, "ends_sha256"],
        )

    for batch in batches:
        done = []
        for *node, _, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if node != current:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield table(done)
    if state is not None:
        yield table([(current, state.hexdigest())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes some conversation of ``ends(node, conv_id)`` ends at.

    A digest reads its list in order, so a node that very many conversations end at is read by one
    task; what reaches it are pieces of 4,096 ids, one at a time.
    """
    order = [*NODE, "conv_id"]
    pieces = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_pieces, "depth long, fp1 long, fp2 long, first long, ids string")
    )
    return (
        pieces.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(_digests, "depth long, fp1 long, fp2 long, ends_sha256 string")
    )


def _nodes(paths: DataFrame) -> DataFrame:
    """Every node with its members, parent and children; ``node`` and ``parent`` name them."""
    made = stage(
        paths.groupBy(*NODE)
        .agg(
            F.count("*").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            *[F.min(name).alias(name) for name in (*PARENT, "chars")],
        )
        .withColumn("node", _name(F.col("depth"), "fp1", "fp2"))
        .withColumn("parent", F.when(F.col("depth") > 0, _name(F.col("depth") - 1, "up1", "up2"))),
        "nodes",
    )
    children = stage(made.where("depth > 0").groupBy("parent").agg(F.count("*").alias("n_children")), "children")
    total = made.count()
    hot = children.where(F.col("n_children") * HOT_SHARE >= total).select(
        "parent", slices_of(F.col("n_children"), F.lit(total)).alias("slices")
    )
    counted = made.join(children.withColumnRenamed("parent", "node"), "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    above = made.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return stage(salted_lookup(counted, above, "parent", "left", ["node"], hot), "nodes")


def _shards(paths: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(conv_id, shard): conversations with the same first turns together, unless those are hot."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = members.count()
    shards = max(parts, -(-paths.count() // ROWS_PER_SHARD))
    # at most HOT_SHARE nodes of each of the first levels
    hot = nodes.where((F.col("depth") <= SHARD_TURNS) & (F.col("n_convs") * HOT_SHARE >= total)).select(
        F.col("node").alias("anchor"), slices_of(F.col("n_convs"), F.lit(total)).alias("slices")
    )
    anchored = members.select("conv_id", _name(F.col("anchor.depth"), "anchor.fp1", "anchor.fp2").alias("anchor"))
    part = F.pmod(F.xxhash64("conv_id"), F.coalesce("slices", F.lit(1)))
    return anchored.join(F.broadcast(hot), "anchor", "left").select(
        "conv_id", F.pmod(F.xxhash64("anchor", part), F.lit(shards)).alias("shard")
    )


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``conversations(conv_id)``, the textless root included.

    ``turns`` is (conv_id, depth from 1 without gaps, said, chars), ``said`` being equal for equal turns. A
    conversation without turns is a member of the root. Columns: node and parent (names), depth,
    conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the
    subtree, each node's members but one times its chars) and ends_sha256, of the ids of the
    conversations that end there. Conversations are distinct and not null; without any there are no
    nodes. A conversation is one path, so a very long one is read by one task of its shard, row by row.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
    none = F.lit(0).cast("long")
    roots = ids.select("conv_id", *[none.alias(name) for name in (*NODE, *PARENT, "chars")])
    paths = stage(prefixes(turns).unionByName(roots), "paths")
    node = F.struct(*NODE)
    members = stage(
        paths.groupBy("conv_id").agg(
            F.max(F.when(F.col("depth") <= SHARD_TURNS, node)).alias("anchor"), F.max(node).alias("end")
        ),
        "members",
    )
    nodes = _nodes(paths)
    held = salted_lookup(paths, _shards(paths, members, nodes), "conv_id", "inner", ["depth"])
    local = held.groupBy("shard", *NODE).agg(F.min("conv_id").alias("smallest"))
    own = F.col("smallest") == F.col("conv_id")
    sent = local.join(nodes, NODE).select(
        "shard",
        *NODE,
        *PARENT,
        F.when(own & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaves"),
        F.when(own, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).cast("long").alias("saved"),
    )
    totals = (
        sent.repartition("shard")
        .sortWithinPartitions("shard", F.col("depth").desc(), "fp1", "fp2")
        .mapInArrow(_forward, "depth long, fp1 long, fp2 long, leaves long, saved long")
        .groupBy(*NODE)
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    ends = ends_digests(members.select("end.*", "conv_id"))
    return (
        nodes.join(totals, NODE)
        .join(ends, NODE, "left")
        .select(
            "node",
            "parent",
            "depth",
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
