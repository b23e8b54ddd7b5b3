"""Repeated token windows of a corpus, found by a depth-limited radix sort of its suffixes.

Suffixes are ordered only as deep as the threshold, ``width`` tokens, by passes over ever finer
digits; a suffix that is alone in its group drops out, and the groups left after the last pass are
exactly the repeated windows.

The first digit is what makes the sort fit a cluster. It is no fixed slice of the window but the
fingerprint of its smallest ``gram``-token run (by hash, leftmost on ties), its anchor. Equal windows
have equal anchors, and neighbouring windows share one, so a pass over the anchors of the corpus moves
two values per 170 bytes. Only the surroundings of anchors that occur twice take part in the passes
over the content, a quarter of the window each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from pagewright.llm.columns import whole
from pagewright.llm.tokens import Runs, byte_values, chunks, mixed, words
from pagewright.session import stage

# anchors a task gathers before it sends each of them once
GATHERED = 300_000
# bytes of surroundings compared at once, unless one anchor has more
COMPARED = 4 << 20
DIGITS = 4


@dataclass(frozen=True)
class Unit:
    """What a token is, how many make a window and how many an anchor."""

    name: str
    width: int
    gram: int


BYTES_400 = Unit("bytes", 400, 64)
WORDS_50 = Unit("words", 50, 8)


def row_key(doc_id: Column, text: Column) -> Column:
    """A key of the row's id and text: rows alike in both are copies, whatever their number."""
    return F.unhex(F.md5(F.concat_ws("|", doc_id.cast("string"), F.length(text).cast("string"), text)))


class Stream:
    """Tokens of some texts in one array."""

    def __init__(self, texts: list[bytes], unit: Unit):
        self.unit = unit
        if unit.name == "bytes":
            self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
            self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
            self.runs = Runs(byte_values(self.data))
        else:
            self.data, _, _, self.offsets = words(texts)
            self.runs = Runs(self.data)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, first window, last window, fingerprint) of each anchor; windows by start in the array."""
        width, gram = self.unit.width, self.unit.gram
        n = len(self.data) - width + 1
        nothing = np.zeros(0, dtype=np.int64)
        if n <= 0:
            return nothing, nothing, nothing, nothing
        prints = self.runs.every(gram)
        place = np.arange(len(prints), dtype=np.uint64)
        least = (prints & np.uint64(0xFFFFFFFF00000000)) | place
        span, reach = 1, width - gram + 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: n], least[reach - span :][: n])
        at = (least[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))[:n]
        inside = np.flatnonzero(np.arange(n) + width <= self.offsets[text + 1])
        if not len(inside):
            return nothing, nothing, nothing, nothing
        fresh = np.ones(len(inside), dtype=bool)
        fresh[1:] = (at[inside[1:]] != at[inside[:-1]]) | (inside[1:] != inside[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.concatenate((first[1:] - 1, [len(inside) - 1]))
        return text[inside[first]], inside[first], inside[last], prints[at[inside[first]]].view(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


ANCHORS = "bucket long, anchor long, key binary, weight int, known boolean"


def _anchor_rows(unit: Unit):
    """Each anchor of a task once, with weight 2 when the task has it twice; who has a known repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            anchor, doc = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            head = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            counts = np.diff(np.concatenate((head, [len(anchor)])))
            repeated = np.repeat(counts > 1, counts)
            apart = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])))
            known = np.flatnonzero(repeated & apart)
            pick = np.concatenate((head, known))
            spread = mixed(doc[known].astype(np.uint64) + anchor[known].view(np.uint64)).view(np.int64)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((anchor[head], spread))),
                    pa.array(anchor[pick]),
                    pa.array(keys, pa.binary()).take(pa.array(doc[pick])),
                    pa.array(np.concatenate((np.minimum(counts, 2), np.zeros(len(known)))).astype(np.int32)),
                    pa.array(np.arange(len(pick)) >= len(head)),
                ],
                names=["bucket", "anchor", "key", "weight", "known"],
            )
            keys.clear()
            held.clear()
            return out

        for batch in batches:
            names, texts = batch.column("key").to_pylist(), _texts(batch.column("text"))
            for a, b in chunks(texts):
                doc, _, _, anchor = Stream(texts[a:b], unit).anchors()
                if len(anchor):
                    held.append((anchor, doc + len(keys)))
                    size += len(anchor)
                keys.extend(names[a:b])
                if size >= GATHERED:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


PASSAGES = "anchor long, span binary, starts binary, counts binary, keys array<binary>, bases array<long>"


def _passage_rows(unit: Unit):
    """Surroundings of the anchors in ``anchors``, equal ones of a batch as one row with all their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column("key").to_pylist(), _texts(batch.column("text"))
            wanted = batch.column("anchors")
            for a, b in chunks(texts):
                stream = Stream(texts[a:b], unit)
                doc, first, last, anchor = stream.anchors()
                listed = [np.asarray(wanted[a + i].values, dtype=np.int64) for i in range(b - a)]
                keep = np.zeros(len(doc), dtype=bool)
                edges = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    keep[edges[i] : edges[i + 1]] = np.isin(anchor[edges[i] : edges[i + 1]], listed[i])
                doc, first, last, anchor = doc[keep], first[keep], last[keep], anchor[keep]
                order = np.lexsort((first, anchor, doc))
                doc, first, last, anchor = doc[order], first[order], last[order], anchor[order]
                found: dict[tuple, tuple[list[bytes], list[int]]] = {}
                if len(doc):
                    # anchors of one kind whose surroundings overlap, as in periodic text, go together
                    apart = np.ones(len(doc), dtype=bool)
                    apart[1:] = (
                        (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (first[1:] > last[:-1] + unit.width)
                    )
                    heads = np.flatnonzero(apart)
                    tails = np.concatenate((heads[1:], [len(doc)]))
                    for h, t in zip(heads.tolist(), tails.tolist(), strict=True):
                        base = int(first[h])
                        span = stream.data[base : int(last[t - 1]) + unit.width].tobytes()
                        starts = (first[h:t] - base).astype(np.int32).tobytes()
                        counts = (last[h:t] - first[h:t] + 1).astype(np.int32).tobytes()
                        places = found.setdefault((int(anchor[h]), span, starts, counts), ([], []))
                        places[0].append(names[a + int(doc[h])])
                        places[1].append(base - int(stream.offsets[doc[h]]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f[0] for f in found], pa.int64()),
                            *[pa.array([f[i] for f in found], pa.binary()) for i in (1, 2, 3)],
                            pa.array([p[0] for p in found.values()], pa.list_(pa.binary())),
                            pa.array([p[1] for p in found.values()], pa.list_(pa.int64())),
                        ],
                        names=["anchor", "span", "starts", "counts", "keys", "bases"],
                    )

    return run


def repeated_windows(data: np.ndarray, starts: np.ndarray, copies: np.ndarray, unit: Unit) -> np.ndarray:
    """Which windows, by index into ``starts``, equal another one or stand for several ``copies``.

    Most-significant-digit passes: windows are sorted by group and digit, mixed into one number,
    groups are cut where it changes, and groups of one leave.
    """
    runs = Runs(byte_values(data) if data.dtype == np.uint8 else data)
    cuts = np.linspace(0, unit.width, DIGITS + 1).astype(np.int64)
    alive = np.arange(len(starts))
    group = np.zeros(len(starts), dtype=np.uint64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        digit = mixed(runs.fingerprints(starts[alive] + a, starts[alive] + b) + group)
        order = np.argsort(digit)
        alive, digit = alive[order], digit[order]
        same = digit[1:] == digit[:-1]
        stays = np.concatenate((same, [False])) | np.concatenate(([False], same))
        alive, group = alive[stays], digit[stays]
        if not len(alive):
            break
    return np.union1d(alive, np.flatnonzero(copies > 1))


def _merged(starts: np.ndarray, width: int) -> np.ndarray:
    """Sorted window starts as (from, to) runs that they cover."""
    gap = np.flatnonzero(starts[1:] > starts[:-1] + width)
    return np.stack((starts[np.concatenate(([0], gap + 1))], starts[np.concatenate((gap, [len(starts) - 1]))] + width), axis=1)


def _compare(rows: list[tuple], unit: Unit) -> Iterator[tuple[bytes, bytes]]:
    """(key, covered runs) for the places of repeated windows among whole anchor groups."""
    kind = np.uint8 if unit.name == "bytes" else np.uint64
    spans = [np.frombuffer(r[1], dtype=kind) for r in rows]
    at = np.concatenate(([0], np.cumsum([len(s) for s in spans])))
    starts, owner = [], []
    for i, (_, _, firsts, counts, _, _) in enumerate(rows):
        f, c = np.frombuffer(firsts, np.int32).astype(np.int64), np.frombuffer(counts, np.int32)
        own = np.repeat(f - np.concatenate(([0], np.cumsum(c)[:-1])), c) + np.arange(c.sum())
        starts.append(own + at[i])
        owner.append(np.full(len(own), i))
    starts, owner = np.concatenate(starts), np.concatenate(owner)
    copies = np.array([len(r[4]) for r in rows])
    hit = repeated_windows(np.concatenate(spans), starts, copies[owner], unit)
    edges = np.searchsorted(owner[hit], np.arange(len(rows) + 1))
    for i, row in enumerate(rows):
        if edges[i] < edges[i + 1]:
            covered = _merged(starts[hit[edges[i] : edges[i + 1]]] - at[i], unit.width)
            for key, base in zip(row[4], row[5], strict=True):
                yield key, (covered + base).astype(np.int64).tobytes()


def _covered_rows(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None

        def out() -> pa.RecordBatch:
            pairs = list(_compare(rows, unit))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], names=["key", "covered"]
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "span", "starts", "counts", "keys", "bases")]
            for row in zip(*columns, strict=True):
                if row[0] != last and size >= COMPARED:
                    yield out()
                    size = 0
                rows.append(row)
                size, last = size + len(row[1]), row[0]
        if rows:
            yield out()

    return run


def _union(parts: list[bytes]) -> np.ndarray:
    """Runs of all parts, those that touch as one."""
    runs = np.concatenate([np.frombuffer(p, dtype=np.int64) for p in parts]).reshape(-1, 2)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    until = np.maximum.accumulate(runs[:, 1])
    first = np.concatenate(([True], runs[1:, 0] > until[:-1]))
    head = np.flatnonzero(first)
    return np.stack((runs[head, 0], until[np.concatenate((head[1:] - 1, [len(runs) - 1]))]), axis=1)


RESULTS = [
    StructField("n_bytes", LongType()),
    StructField("n_removed", LongType()),
    StructField("n_spans", LongType()),
    StructField("kept_sha256", StringType()),
    StructField("kept", BinaryType()),
]


def _cut(unit: Unit, columns: tuple[str, ...]):
    """``columns`` of the rows, and their texts with the covered runs taken out, if any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column("_text"))
            out: list[tuple] = []
            for text, parts in zip(texts, batch.column("covered").to_pylist(), strict=True):
                runs = _union(parts) if parts else np.zeros((0, 2), dtype=np.int64)
                if unit.name == "words":  # up to the next word that stays
                    _, starts, _, _ = words([text])
                    edges = np.concatenate((starts, [len(text)]))
                    runs = edges[runs]
                kept, at = [], 0
                for a, b in runs.tolist():
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                left = b"".join(kept)
                out.append((len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array([o[i] for o in out], t) for i, t in enumerate(types))],
                names=[*columns, *(f.name for f in RESULTS)],
            )

    return run


def remove_repeats(
    docs: DataFrame, unit: Unit = BYTES_400, columns: tuple[str, ...] = ("doc_id",), texts_too: bool = True
) -> DataFrame:
    """``columns`` of each row with (n_bytes, n_removed, n_spans, kept_sha256, kept) of its ``text``.

    Without ``texts_too`` there is no ``kept``.

    Every token covered by a ``unit.width``-token window that also starts anywhere else, in this text
    or another, is removed; windows are judged on the input. ``kept`` holds the remaining bytes,
    which may break a character in ``bytes``. Windows of words are compared by the words alone;
    with the last word of a removed run goes the white space behind it.

    Null texts are empty, texts shorter than a window stay whole, equal texts of a window's length
    lose everything. Repeated rows, with and without the same doc_id, and null doc_ids are rows of
    their own. An empty table gives no rows; columns not named are ignored.
    """
    keyed = docs.select(*columns, whole(F.col("text")).alias("_text")).withColumn(
        "_key", row_key(F.col("doc_id") if "doc_id" in columns else F.lit(""), F.col("_text"))
    )
    anchors = keyed.select(F.col("_key").alias("key"), F.col("_text").alias("text")).mapInArrow(
        _anchor_rows(unit), ANCHORS
    )
    total = F.sum("weight").over(Window.partitionBy("bucket"))
    repeated = (
        anchors.withColumn("total", total)
        .where(F.col("known") | (F.col("total") > 1))
        .groupBy(F.col("key").alias("_key"))
        .agg(F.collect_set("anchor").alias("_anchors"))
    )
    # all rows, so that texts without a repeated anchor are not dealt out a second time
    rows = stage(keyed.join(repeated, "_key", "left"), "repeat-suspects", "zstd")
    suspects = rows.where(F.col("_anchors").isNotNull())
    covered = (
        suspects.select(F.col("_key").alias("key"), F.col("_text").alias("text"), F.col("_anchors").alias("anchors"))
        .mapInArrow(_passage_rows(unit), PASSAGES)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_covered_rows(unit), "key binary, covered binary")
        .groupBy(F.col("key").alias("_key"))
        .agg(F.collect_list("covered").alias("covered"))
    )
    named = rows.select(*columns)
    cut = (
        suspects.select(*columns, "_text", "_key")
        .join(covered, "_key", "left")
        .select(*columns, "_text", "covered")
        .mapInArrow(_cut(unit, columns), StructType([*named.schema.fields, *RESULTS]))
    )
    text = F.col("_text").cast("binary")
    whole_ones = rows.where(F.col("_anchors").isNull()).select(
        *columns,
        F.length(text).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2(text, 256).alias("kept_sha256"),
        text.alias("kept"),
    )
    both = whole_ones.union(cut)
    return both if texts_too else both.drop("kept")
