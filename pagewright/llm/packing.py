"""Packing of tokenized documents into sequences of fixed length, by linear grouping and best fit.

Large lengths are sorted and cut into groups of equally many pieces, each rounded up to its largest.
Sequences over so few sizes are optimised as a cutting problem: the configurations of a linear program
by column generation. Actual pieces then take the rounded places, piece by piece in their group's
order, and the small ones go by best fit into what the actual lengths leave free.

Plans are made from counts of lengths, at most one per possible length, so the driver's work does not
grow with the table. Pieces find their place by their rank in the order of lengths: ranges of ranks
become ranges of sequences, and nothing but ranks and lengths is shuffled.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.columns import only, whole
from pagewright.operators.scale import positions
from pagewright.session import stage

CAPACITY = 2048
END_ID = 0
# Pieces longer than this part of a sequence count as large. What rounding wastes, half a group's width a
# piece, is too narrow for most small pieces, so groups are many; a program of sizes above a third
# still takes seconds.
LARGE = 1 / 3
GROUPS = 256
# a configuration that is better by less than this share is not looked for
TOLERANCE = 0.001
# distinct units of text whose ids a worker remembers, in each of two generations, and their longest
MAX_UNITS = 1 << 19
UNIT_CHARS = 64
# where a text may be cut: before a space between two characters that are none a new token starts
CUT = re.compile(r"(?<=\S)(?= \S)")
BESIDE = re.compile(r"\s\s")


class _Encoder:
    """Ids of texts as little-endian bytes. Most units come again, so the ids of short ones are remembered.

    A unit goes from one cut to the next: a space, under which it is not named, and what follows it up to
    the next space. Units seen for the first time go to the tokenizer as one text, which is cut again by the
    number of bytes each id stands for.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        # the fast form keeps no offsets
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        ids = self._encoded(" " + " ".join(units))
        sizes = np.fromiter(map(len, map(str.encode, units)), np.int64, len(units)) + 1
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(sizes)) + 1
        raw, start, made = ids.tobytes(), 0, {}
        for unit, end in zip(units, (4 * ends).tolist(), strict=True):
            made[unit] = raw[start:end]
            start = end
        return made

    def ids(self, text: str) -> bytes:
        known, older = self.known, self.older
        first, *units = text.split(" ")
        new = list(set(units).difference(known))
        # what is known stands between cuts; a space beside other white space is no cut
        if (units and (not first or first[-1].isspace())) or BESIDE.search(f" {' '.join(new)} " if new else ""):
            first, *units = CUT.split(text)
            last = units.pop() if units and units[-1][-1].isspace() else ""
            units = [unit[1:] for unit in units]
            new = list(set(units).difference(known))
        else:
            last = ""
        for unit in [unit for unit in new if unit in older]:
            known[unit] = older[unit]
        new = [unit for unit in new if unit not in known]
        made = self._learn(new) if new else {}
        known.update(made)
        ids = b"".join([self._encoded(first).tobytes(), *map(known.__getitem__, units), self._encoded(last).tobytes()])
        for unit in [unit for unit in made if len(unit) >= UNIT_CHARS]:
            del known[unit]
        if len(known) > MAX_UNITS:
            self.known, self.older = {}, known
        return ids


_encoders: dict[str, _Encoder] = {}


def _encoder(model: str) -> _Encoder:
    """The worker's encoder, which its next tasks use again."""
    if model not in _encoders:
        _encoders.clear()
        _encoders[model] = _Encoder(model)
    return _encoders[model]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids.

    A document is its text's ids (null: an empty text) and the end id. One longer than ``capacity`` is
    cut into pieces of that length, of which the first may be shorter. Repeated rows are documents of
    their own. Other columns are ignored. A very long text is tokenized in units that give the same ids.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows = {name: [] for name in ("row", "piece", "start", "length", "ids_crc32")}
            for row, text in enumerate(batch["text"].to_pylist()):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                first = n % capacity
                edges = [*([0] if first else []), *range(first, n + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:], strict=False)):
                    values = row, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])
                    for name, value in zip(rows, values, strict=True):
                        rows[name].append(value)
            ids_of = batch["doc_id"].take(pa.array(rows.pop("row"), pa.int64()))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [ids_of, *[pa.array(v, kind) for v, kind in zip(rows.values(), kinds, strict=True)]], ["doc_id", *rows]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    return only(docs, "doc_id", "text").withColumn("text", whole(F.col("text"))).mapInArrow(cut, schema)


# --- plans over counts -----------------------------------------------------------------------


def groups_of(counts: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, demands) of equally large groups of the pieces counted by length, longest first.

    A group's size is its longest piece. Groups of one size become one.
    """
    lengths = np.flatnonzero(counts)[::-1]
    ends = np.cumsum(counts[lengths])
    starts = np.unique(np.arange(n_groups) * int(ends[-1]) // n_groups)
    sizes = lengths[np.searchsorted(ends, starts, side="right")]
    first = np.flatnonzero(np.concatenate(([True], sizes[1:] != sizes[:-1])))
    return sizes[first], np.diff(np.append(starts[first], ends[-1]))


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, as numbers of each, by one more piece at a time."""
    best, picks = np.zeros(capacity + 1), []
    while True:
        more, pick = best.copy(), np.full(capacity + 1, -1)
        for i in np.flatnonzero(values > 0):
            with_it = best[: capacity + 1 - sizes[i]] + values[i]
            better = with_it > more[sizes[i] :] + 1e-12
            more[sizes[i] :][better] = with_it[better]
            pick[sizes[i] :][better] = i
        if (pick < 0).all():
            break
        picks.append(pick)
        best = more
    numbers, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            numbers[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), numbers


def configurations(sizes: np.ndarray, demands: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(numbers of each size, how many sequences are filled so), with places for all demands.

    The linear program starts from sequences of one size; a configuration worth more than a sequence
    by the program's prices enters, until none is better by ``TOLERANCE``. What whole numbers of its
    sequences leave, less than one for each size, goes by best fit.
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    filled = demands / np.diag(basis)
    for _ in range(50 * k):  # each step's solution is valid, so a long tail may be left
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, column = best_configuration(sizes, prices, capacity)
        if value <= 1 + TOLERANCE:
            break
        change = np.linalg.solve(basis, column)
        ratio = np.full(k, np.inf)
        np.divide(filled, change, out=ratio, where=change > 1e-9)
        leaving = int(np.argmin(ratio))
        step = ratio[leaving]
        filled = np.maximum(filled - step * change, 0)
        filled[leaving] = step
        basis[:, leaving] = column
    times = np.floor(filled + 1e-6).astype(np.int64)
    chosen = [(basis[:, i].astype(np.int64), int(times[i])) for i in range(k) if times[i]]
    left = demands - sum((numbers * n for numbers, n in chosen), np.zeros(k, dtype=np.int64))
    rooms: list[list] = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(max(int(left[i]), 0)):
            fitting = [room for room in rooms if room[0] >= sizes[i]]
            if not fitting:
                fitting = [[capacity, np.zeros(k, dtype=np.int64)]]
                rooms.append(fitting[0])
            room = min(fitting, key=lambda r: r[0])
            room[0] -= int(sizes[i])
            room[1][i] += 1
    return chosen + [(numbers, 1) for _, numbers in rooms]


def ranges_of_places(demands: np.ndarray, chosen: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Rows (first rank, first sequence, places per sequence) that deal all ranks to sequences."""
    ranges, base = [], 0
    at = np.concatenate(([0], np.cumsum(demands)))
    next_rank = at[:-1].copy()
    for numbers, times in chosen:
        for i in np.flatnonzero(numbers):
            if next_rank[i] < at[i + 1]:
                ranges.append((next_rank[i], base, numbers[i]))
                next_rank[i] += numbers[i] * times
        base += times
    return np.array(sorted(ranges), dtype=np.int64).reshape(-1, 3)


def best_fit(counts: np.ndarray, gaps: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Rows (first rank, first sequence, 1) for the pieces counted by length, longest first.

    ``gaps`` counts sequences by free room; they are numbered by ascending room. Each length in turn
    takes the narrowest gaps it fits, as many at once as there are; with none left new sequences open.
    Also returns the number of sequences then.
    """
    first = np.cumsum(gaps) - gaps
    free: list[list[tuple[int, int]]] = [[(int(first[g]), int(gaps[g]))] if gaps[g] else [] for g in range(capacity + 1)]
    held = gaps > 0
    opened = int(gaps.sum())
    ranges, rank = [], 0
    for length in np.flatnonzero(counts)[::-1]:
        left = int(counts[length])
        while left:
            wide = int(length) + int(np.argmax(held[length:]))
            if not held[wide]:
                n = -(-left // (capacity // int(length)))
                free[capacity].append((opened, n))
                held[capacity] = True
                opened += n
                wide = capacity
            start, n = free[wide].pop()
            taken = min(n, left)
            if taken < n:
                free[wide].append((start + taken, n - taken))
            held[wide] = bool(free[wide])
            free[wide - length].append((start, taken))
            held[wide - length] = True
            ranges.append((rank, start, 1))
            rank, left = rank + taken, left - taken
    return np.array(ranges, dtype=np.int64).reshape(-1, 3), opened


def sequence_of(rank: Column, ranges: np.ndarray) -> Column:
    """The sequence that ``ranges`` deals a rank to."""
    first, base, each = ranges.T

    @F.pandas_udf("long")
    def dealt(ranks: pd.Series) -> pd.Series:
        at = np.searchsorted(first, ranks.to_numpy(), side="right") - 1
        return pd.Series(base[at] + (ranks.to_numpy() - first[at]) // each[at])

    return dealt(rank)


def _counted(df: DataFrame, column: str, capacity: int) -> np.ndarray:
    """Rows by a value from 0 to ``capacity``; that many numbers at most come to the driver."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for value, n in df.groupBy(column).agg(F.count("*").alias("n")).collect():
        counts[value] = n
    return counts


def pack(pieces: DataFrame, capacity: int = CAPACITY, n_groups: int = GROUPS, large: float = LARGE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: as few sequences of ``capacity`` as the plan finds.

    ``pieces`` has a ``length`` from 1 to ``capacity`` and columns that can be ordered, by which equal
    lengths are ranked; equal rows are interchangeable. Pieces of one sequence lie one behind the other
    from 0, longest first. Sequences are numbered from 0 without gaps: those of large pieces, those that
    small ones opened, then full ones. No rows give no rows.
    """
    columns = pieces.columns
    others = [name for name in columns if name != "length"]
    turned = pieces.select((-F.col("length")).alias("_down"), *others)
    ranked = stage(
        positions(turned, ["_down", *others]).select(
            *[(-F.col("_down")).alias("length") if name == "length" else name for name in columns],
            (F.col("position") - 1).alias("_rank"),
        ),
        "ranked",
    )
    counts = _counted(ranked, "length", capacity)
    n_full = int(counts[capacity])
    counts[capacity] = 0
    bound = int(capacity * large)
    small, middle, lone = counts.copy(), counts.copy(), counts.copy()
    small[bound + 1 :] = 0
    middle[: bound + 1] = middle[capacity - bound :] = 0
    lone[: max(capacity - bound, bound + 1)] = 0
    n_lone, n_middle, n_small = int(lone.sum()), int(middle.sum()), int(small.sum())
    rank, made, chosen, gaps = F.col("_rank"), [], [], np.zeros(capacity + 1, dtype=np.int64)
    first = n_full + n_lone
    ranges = np.zeros((0, 3), dtype=np.int64)
    if n_middle:
        sizes, demands = groups_of(middle, n_groups)
        chosen = configurations(sizes, demands, capacity)
        ranges = ranges_of_places(demands, chosen)
    if n_lone or n_middle:
        alone = ranked.where((rank >= n_full) & (rank < first))
        placed = alone.withColumn("_slot", rank - n_full + sum(times for _, times in chosen))
        if n_middle:
            others = ranked.where((rank >= first) & (rank < first + n_middle))
            placed = placed.unionByName(others.withColumn("_slot", sequence_of(rank - first, ranges)))
        rooms = placed.groupBy("_slot").agg((capacity - F.sum("length")).alias("_gap"))
        by_room = stage(positions(stage(rooms, "rooms"), ["_gap", "_slot"]), "by-room")
        gaps = _counted(by_room, "_gap", capacity)
        numbered = by_room.select("_slot", (F.col("position") - 1).alias("sequence_id"))
        made.append(placed.join(numbered, "_slot").drop("_slot"))
    ranges, opened = best_fit(small, gaps, capacity)
    if n_small:
        first += n_middle
        made.append(ranked.where(rank >= first).withColumn("sequence_id", sequence_of(rank - first, ranges)))
    made.append(ranked.where(rank < n_full).withColumn("sequence_id", rank + opened))
    packed = made[0]
    for more in made[1:]:
        packed = packed.unionByName(more)
    within = Window.partitionBy("sequence_id").orderBy("_rank")
    offset = F.sum("length").over(within) - F.col("length")
    return packed.select(*columns, "sequence_id", offset.alias("offset"))
