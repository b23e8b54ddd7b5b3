"""Exact nearest vectors by inner product from an impact-ordered index.

The index is a table of posting segments. A block holds some thousand vectors; a segment holds the
block's postings (dimension, row, value) of one quantised impact, the bit length of |value|.
A search adds up segments by descending impact, bounds what the remaining ones can still add, and
stops only when the bounds prove which rows can be among the best; those are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.session import stage

SCALE = 1024
BLOCK_ROWS = 8192
# as many as a block holds, so that copies of the index weigh no more than copies of the queries
QUERY_ROWS = BLOCK_ROWS
# pairs worked on at once, so that one task's score tables stay under some 100 MB
PAIRS = 1 << 20
VECTORS = -1
EXACT = 2.0**52
SEGMENTS = "block string, impact int, n_rows int, n_dims int, rows binary, dims binary, data binary, rest binary"


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null for vectors that take no part."""
    vector = vector.cast("array<double>")
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x * scale)))


def _segments(block: str, keys: list[tuple], vectors: list[np.ndarray]) -> Iterator[tuple]:
    width = max(len(v) for v in vectors)
    table = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        table[i, : len(v)] = v
    numbers, ids, no_id = (np.array(part) for part in zip(*keys, strict=True))
    yield (
        block, VECTORS, len(keys), width, numbers.astype(np.int64).tobytes(),
        ids.astype(np.int64).tobytes(), no_id.astype(bool).tobytes(), b"",
    )
    size = np.abs(table.astype(np.float64))
    impacts = np.where(size > 0, np.floor(np.log2(np.maximum(size, 1))).astype(np.int32) + 1, 0)
    left = (size**2).sum(axis=1)
    for impact in sorted(set(np.unique(impacts)) - {0}, reverse=True):
        rows, dims = np.nonzero(impacts == impact)
        data = table[rows, dims]
        left = left - np.bincount(rows, weights=data.astype(np.float64) ** 2, minlength=len(keys))
        rest = np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6
        yield (
            block, int(impact), len(keys), width, rows.astype(np.int32).tobytes(),
            dims.astype(np.int32).tobytes(), data.tobytes(), rest.tobytes(),
        )


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [part.split()[0] for part in SEGMENTS.split(", ")]
    keys: list[tuple] = []
    vectors: list[np.ndarray] = []
    part, made = None, 0

    def flush() -> pd.DataFrame:
        nonlocal made
        made += 1
        out = pd.DataFrame(list(_segments(f"{part}-{made}", keys, vectors)), columns=columns)
        keys.clear()
        vectors.clear()
        return out

    for batch in batches:
        for part, number, vec_id, no_id, vector in batch.itertuples(index=False, name=None):
            keys.append((number, vec_id, no_id))
            vectors.append(np.asarray(vector, dtype=np.int64))
            if len(keys) == BLOCK_ROWS:
                yield flush()
    if keys:
        yield flush()


def build_index(vectors: DataFrame) -> DataFrame:
    """Segments of ``vectors(number, vec_id, no_id, vector)``, written once; every row is in exactly one block."""
    placed = vectors.select(F.spark_partition_id().alias("part"), "number", "vec_id", "no_id", "vector")
    return stage(placed.mapInPandas(_build, SEGMENTS), "impact-index")


def _best(keys, scores, own: int, k: int) -> list[tuple]:
    """(vec_id, no_id, score) of the best rows but the query's own; ties to the smaller vec_id, none last."""
    numbers, ids, no_id = keys
    order = np.lexsort((numbers, ids, no_id, -scores))
    order = order[numbers[order] != own][:k]
    return [(int(ids[i]), bool(no_id[i]), int(scores[i])) for i in order]


def search_block(queries: list[tuple[int, np.ndarray]], segments: list[tuple], k: int) -> list[tuple]:
    """(query number, vec_id, no_id, score) of the ``k`` best rows of one block for each query, exact.

    ``segments`` are (impact, n_rows, n_dims, rows, dims, data, rest) in any order.
    """
    segments = sorted(segments, key=lambda s: -s[0])
    head = next(s for s in segments if s[0] == VECTORS)
    n, width = head[1], max([head[2], *(len(v) for _, v in queries)])
    keys = np.frombuffer(head[3], np.int64), np.frombuffer(head[4], np.int64), np.frombuffer(head[5], bool)
    table = np.zeros((n, width), dtype=np.int64)
    layers = []
    for impact, _, _, rows, dims, data, rest in segments:
        if impact != VECTORS:
            r, d = np.frombuffer(rows, np.int32), np.frombuffer(dims, np.int32)
            table[r, d] = np.frombuffer(data, np.int64)
            layers.append((r, d, np.frombuffer(rest, np.float64)))
    found: list[tuple] = []
    step = max(1, PAIRS // max(n, 1))
    for at in range(0, len(queries), step):
        some = queries[at : at + step]
        q = np.zeros((len(some), width), dtype=np.int64)
        for i, (_, v) in enumerate(some):
            q[i, : len(v)] = v
        own = np.array([number for number, _ in some], dtype=np.int64)
        reach = np.abs(q).astype(np.float64).sum(axis=1).max(initial=0) * np.abs(table.astype(np.float64)).max(initial=0)
        if reach >= EXACT:  # beyond exact doubles: python integers, held within 64 bits
            for number, v in zip(own, q, strict=True):
                scores = [max(-(2**63), min(2**63 - 1, sum(map(int.__mul__, map(int, v), map(int, row))))) for row in table]
                found += [(int(number), *row) for row in _best(keys, np.array(scores, dtype=object), number, k)]
            continue
        found += _score_at_a_time(own, q.astype(np.float64), keys, table, layers, k)
    return found


def _score_at_a_time(own, q, keys, table, layers, k) -> list[tuple]:
    n = len(table)
    norms = np.sqrt((q**2).sum(axis=1)) * (1 + 1e-9)
    # rows that can still be among the best of some query; postings of others are passed over
    live = np.arange(n)
    score = np.zeros((len(own), n))
    score[own[:, None] == keys[0][None, :]] = -np.inf
    possible = np.ones(score.shape, dtype=bool)
    for r, d, rest in layers:
        place = np.full(n, -1)
        place[live] = np.arange(len(live))
        here = place[r] >= 0
        layer = np.zeros((len(live), table.shape[1]))
        layer[place[r[here]], d[here]] = table[r[here], d[here]]
        score += q @ layer.T
        if len(live) <= k:
            continue
        slack = norms[:, None] * rest[live][None, :]
        proven = np.partition(score - slack, len(live) - k, axis=1)[:, len(live) - k]
        possible = score + slack >= proven[:, None]
        if possible.sum(axis=1).max() <= 2 * k:
            break
        kept = possible.any(axis=0)
        live, score, possible = live[kept], score[:, kept], possible[:, kept]
    found = []
    for i, number in enumerate(own):
        rows = live[possible[i]]
        exact = table[rows] @ q[i].astype(np.int64)
        found += [(int(number), *row) for row in _best([part[rows] for part in keys], exact, number, k)]
    return found


def top_k(vectors: DataFrame, asked: Column, k: int = 10) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each of its rows that ``asked`` holds for.

    ``vectors`` has (vec_id, vector of long), see ``scaled``; the result is (query_id, rank, vec_id,
    score), ties to the smaller vec_id, all rows if there are fewer than ``k``. Every block of
    queries meets every block of the index once; a pair of blocks gives at most ``k`` rows a query.

    A query is no candidate of its own; every other row is, also one with the same vec_id or none
    (after all others in a tie). A repeated row is asked each time. Null vectors take no part, and
    rows without vec_id are not asked. Shorter vectors count as padded with zeros, an empty one scores
    0. Scores beyond 64 bits are held at the ends. Empty tables give no rows; further columns are ignored.
    """
    id_of = F.col("vec_id").cast("long")
    numbered = stage(
        vectors.withColumn("_asked", F.coalesce(asked, F.lit(False)) & id_of.isNotNull())
        .where(F.col("vector").isNotNull())
        .select(
            F.monotonically_increasing_id().alias("number"), F.coalesce(id_of, F.lit(0)).alias("vec_id"),
            id_of.isNull().alias("no_id"), "vector", "_asked",
        ),
        "vectors",
    )
    index = build_index(numbered)
    questions = numbered.where("_asked").select("number", F.col("vec_id").alias("query_id"), "vector")
    parts = max(1, -(-questions.count() // QUERY_ROWS))
    blocks = index.where(F.col("impact") == VECTORS).select("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("query_block")
    pairs = blocks.select(F.col("block").alias("at_block"), every.alias("at_query_block"))
    postings = index.select(*index.columns, every)
    dealt = F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")
    met = questions.withColumn("at_query_block", dealt).join(pairs, "at_query_block")
    k_best = int(k)

    def search(questions: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        names = {"number": "int64", "query_id": "int64", "vec_id": "int64", "no_id": "bool", "score": "int64"}
        if questions.empty or postings.empty:
            return pd.DataFrame({c: pd.Series(dtype=kind) for c, kind in names.items()})
        rows = search_block(
            [(a, np.asarray(v, dtype=np.int64)) for a, v in zip(questions["number"], questions["vector"], strict=True)],
            list(postings[["impact", "n_rows", "n_dims", "rows", "dims", "data", "rest"]].itertuples(index=False, name=None)),
            k_best,
        )
        query_ids = dict(zip(questions["number"], questions["query_id"], strict=True))
        return pd.DataFrame([(row[0], query_ids[row[0]], *row[1:]) for row in rows], columns=list(names)).astype(names)

    near = (
        met.groupBy("at_block", "at_query_block")
        .cogroup(postings.groupBy("block", "query_block"))
        .applyInPandas(search, "number long, query_id long, vec_id long, no_id boolean, score long")
    )
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "no_id", "vec_id"))
    best = near.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score")
