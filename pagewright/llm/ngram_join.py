"""Jaccard join of documents on word n-grams with prefix trees.

1. A document's set is the fingerprints of its distinct n-grams. Sets are met n-gram by n-gram to
   learn which n-grams a second document has; only those can be part of an overlap. A document with
   fewer of them than any partner would have to share is done.
2. Of the others, equal sets are one. The global order is: n-grams that nobody shares first, then by
   fingerprint. Two linked sets share one of the first ``size - least overlap + 1`` n-grams in this
   order, so sets that share none of them are never compared. What hangs together by such n-grams is
   a block.
3. A block's sets are filtered once more among themselves, most frequent n-grams last, and what still
   hangs together stands in a prefix tree. A set walks the tree, adds up its overlap once for all
   sets that go on from a node, and leaves a branch when what remains on either side cannot reach the
   threshold any more, or when all sets below are already known to be of its component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.columns import whole
from pagewright.llm.components import components
from pagewright.llm.tokens import Runs, chunks, lowered, words
from pagewright.session import stage

# n-grams of the sets that are packed together, of one bucket, and of one slice of a block
PACKED = 500_000
BUCKET = 1_000_000
SLICE = 1_000_000
LEAST_BUCKETS = 256
CHARS_PER_WORD = 6


@dataclass(frozen=True)
class Join:
    """Width of the n-grams and the least Jaccard similarity, as a fraction."""

    width: int
    part: int
    of: int

    def overlap(self, a, b):
        """Least size of the intersection of linked sets of sizes a and b."""
        return -(-self.part * (a + b) // (self.of + self.part))

    def own_overlap(self, n):
        """Least size of the intersection of a set of size n with any linked set."""
        return -(-self.part * n // self.of)


FOUR_WORDS_85 = Join(4, 85, 100)
FIVE_WORDS_80 = Join(5, 80, 100)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, fingerprint) of the distinct n-grams of each text, by text and fingerprint.

    A text of fewer words has all of them as its one n-gram, a text without words none.
    """
    prints, _, _, offsets = words(texts)
    count = np.diff(offsets)
    starts = np.arange(len(prints))
    text = np.repeat(np.arange(len(texts)), count)
    whole_run = starts + width <= offsets[text + 1] if len(text) else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < width))
    runs = Runs(prints)
    first = np.concatenate((starts[whole_run], offsets[short]))
    last = np.concatenate((starts[whole_run] + width, offsets[short + 1]))
    owner = np.concatenate((text[whole_run], short))
    value = runs.fingerprints(first, last)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def _packed_values(values: np.ndarray, bits: int) -> bytes:
    """Sorted values of one bucket: their gaps in six bytes, or the seven low bytes where a gap is too wide."""
    low = values & np.uint64((1 << (64 - bits)) - 1)
    gaps = np.diff(low, prepend=np.uint64(0))
    size = 6 if gaps.max() < 1 << 48 else 7
    kept = gaps if size == 6 else low
    return bytes([size]) + np.ascontiguousarray(kept.view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _unpacked_values(data: bytes, bucket: int, bits: int) -> np.ndarray:
    size = data[0]
    out = np.zeros(((len(data) - 1) // size, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, size)
    low = out.reshape(-1).view(np.uint64)
    return (np.cumsum(low) if size == 6 else low) + np.uint64(bucket << (64 - bits))


def _packed_docs(docs: np.ndarray, of: int) -> bytes:
    """Numbers of documents below ``of``, in two bytes when they fit."""
    return docs.astype(np.uint16 if of <= 1 << 16 else np.uint32).tobytes()


def _unpacked_docs(data: bytes, of: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * of else np.uint32).astype(np.int64)


def _pack(width: int, bits: int):
    """Sets of some documents as one pack: unshared n-grams by bucket, each once, and the rest as it is."""
    kinds = [
        ("bucket", pa.int64()), ("pack", pa.int64()), ("docs", pa.binary()), ("values", pa.binary()),
        ("known", pa.bool_()), ("ids", pa.list_(pa.string())), ("sizes", pa.binary()),
    ]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, made, part = 0, 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal made
            pack = (part << 24) | made
            made += 1
            doc, value = (np.concatenate(x) for x in zip(*held, strict=True))
            sizes = np.bincount(doc, minlength=len(ids)).astype(np.int64)
            order = np.lexsort((doc, value))
            doc, value = doc[order], value[order]
            head = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))[: len(value)]
            count = np.diff(np.concatenate((head, [len(value)])))
            several = np.repeat(count > 1, count)
            rows = [(pack % (1 << bits), pack, _packed_docs(doc[several], len(ids)), value[several].tobytes(), None, list(ids), sizes.tobytes())]
            for known in (False, True):
                at = head[(count > 1) == known]
                bucket = (value[at] >> np.uint64(64 - bits)).astype(np.int64)
                edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(at) else [0]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    some = at[a:b]
                    docs = b"" if known else _packed_docs(doc[some], len(ids))
                    rows.append((int(bucket[a]), pack, docs, _packed_values(value[some], bits), known, None, None))
            ids.clear()
            held.clear()
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema=schema)

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            texts = [lowered(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in chunks(texts):
                doc, value = shingle_sets(texts[a:b], width)
                held.append((doc + len(ids), value))
                ids.extend(keys[a:b])
                size += len(value)
                if size >= PACKED:
                    yield flush()
                    size = 0
        if ids:
            yield flush()

    return run


def _meet(bits: int):
    """Tells each pack which of its lone n-grams another pack has as well; the rest passes through."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        met = group[group["known"].notna()]
        out = group[group["known"].isna()][["pack", "docs", "values", "ids", "sizes"]]
        if met.empty:
            return out
        bucket = int(met["bucket"].iloc[0])
        parts = [_unpacked_values(v, bucket, bits) for v in met["values"]]
        value = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        known = met["known"].to_numpy(dtype=bool)
        order = np.argsort(value, kind="stable")
        ordered = value[order]
        head = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        of = np.cumsum(head) - 1
        shared = (np.bincount(of) > 1)[of]
        asks = shared & ~known[owner[order]]
        hit = np.sort(order[asks])
        begin = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        edges = np.searchsorted(hit, begin)
        answers = []
        for i, (pack, docs) in enumerate(zip(met["pack"], met["docs"], strict=True)):
            if edges[i] < edges[i + 1]:
                at = hit[edges[i] : edges[i + 1]]
                width = 2 if len(docs) == 2 * len(parts[i]) else 4
                docs = np.frombuffer(docs, f"u{width}")[at - begin[i]]
                answers.append((pack, docs.tobytes(), value[at].tobytes(), None, None))
        return pd.concat([out, pd.DataFrame(answers, columns=out.columns)], ignore_index=True) if answers else out

    return run


def _unpack(join: Join):
    """Per document its size and, if it may have partners, its shared n-grams in order."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["sizes"].notna()].iloc[0]
        sizes = np.frombuffer(head["sizes"], np.int64)
        doc = np.concatenate([_unpacked_docs(d, len(v) // 8) for d, v in zip(group["docs"], group["values"], strict=True)])
        value = np.concatenate([np.frombuffer(v, np.uint64) for v in group["values"]])
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        edges = np.searchsorted(doc, np.arange(len(sizes) + 1))
        count = np.diff(edges)
        may = (sizes > 0) & (count >= join.own_overlap(sizes))
        return pd.DataFrame(
            {
                "row": (int(head["pack"]) << 24) + np.arange(len(sizes)),
                "doc_id": list(head["ids"]),
                "n_shingles": sizes,
                "shared": [value[edges[i] : edges[i + 1]].tobytes() if may[i] else None for i in range(len(sizes))],
            }
        )

    return run


def _prefixes(join: Join):
    """The n-grams of which a linked set must have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values, sizes = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("row", "n_shingles", "shared")]
            for row, n, shared in zip(*columns, strict=True):
                value = np.frombuffer(shared, np.int64)
                length = len(value) - join.own_overlap(n) + 1
                rows.append(np.full(length, row, dtype=np.int64))
                values.append(value[:length])
                sizes.append(np.full(length, n, dtype=np.int64))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (values, rows, sizes)], names=["gram", "row", "n_shingles"]
                )

    return run


@dataclass
class Node:
    """A tree node: its path ends after ``depth`` n-grams of set ``of``; a leaf is that set."""

    depth: int
    of: int
    leaf: bool
    kids: list[Node] = field(default_factory=list)


def build_tree(sets: list[np.ndarray], sizes: list[int], inside: list[int]) -> Node:
    """The path-compressed prefix tree of the sorted sets with the numbers ``inside``."""
    keys = {i: sets[i].astype(">u8").tobytes() for i in inside}
    root = Node(0, -1, False)
    stack = [root]
    before: np.ndarray | None = None
    for i in sorted(inside, key=keys.__getitem__):
        same = 0
        if before is not None:
            k = min(len(before), len(sets[i]))
            differ = np.flatnonzero(before[:k] != sets[i][:k])
            same = int(differ[0]) if len(differ) else k
        while stack[-1].depth > same:
            last = stack.pop()
            if stack[-1].depth < same:
                middle = Node(same, last.of, False, [last])
                stack[-1].kids[-1] = middle
                stack.append(middle)
        if stack[-1].leaf:  # the set before is the beginning of this one
            old = stack.pop()
            both = Node(old.depth, old.of, False, [old])
            stack[-1].kids[-1] = both
            stack.append(both)
        leaf = Node(len(sets[i]), i, True)
        stack[-1].kids.append(leaf)
        stack.append(leaf)
        before = sets[i]
    return root


class Tree:
    """A prefix tree as arrays, nodes by level, so that a set walks all open branches at once."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], inside: list[int]):
        nodes, begin, first = [build_tree(sets, sizes, inside)], [0], []
        for node in nodes:  # grows while it is read
            first.append(len(nodes))
            for kid in node.kids:
                nodes.append(kid)
                begin.append(node.depth)
        self.first_kid = np.array([*first, len(nodes)])
        self.kids = np.diff(self.first_kid)
        self.leaf = np.array([n.leaf for n in nodes])
        self.of = np.array([n.of for n in nodes])
        self.depth = np.array([n.depth for n in nodes])
        paths = [sets[n.of][b : n.depth] if n.of >= 0 else sets[inside[0]][:0] for n, b in zip(nodes, begin, strict=True)]
        self.path = np.concatenate(paths).astype(np.int64)
        self.path_end = np.cumsum([len(p) for p in paths])
        self.path_start = self.path_end - [len(p) for p in paths]
        self.last = np.array([int(sets[n.of][n.depth - 1]) if n.depth else -1 for n in nodes])
        # of the sets below each node: least and greatest size, most n-grams
        self.least = np.array([sizes[n.of] if n.leaf else 1 << 62 for n in nodes])
        self.most = np.array([sizes[n.of] if n.leaf else 0 for n in nodes])
        self.longest = np.array([len(sets[n.of]) if n.leaf else 0 for n in nodes])
        for i in range(len(nodes) - 1, -1, -1):
            if self.kids[i]:
                below = slice(self.first_kid[i], self.first_kid[i + 1])
                self.least[i] = self.least[below].min()
                self.most[i] = self.most[below].max()
                self.longest[i] = self.longest[below].max()


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Forest:
    """Union-find that remembers the links which joined two components."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def link(self, a: int, b: int) -> None:
        x, y = self.find(a), self.find(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))


def walk(tree: Tree, query: np.ndarray, size: int, me: int, sizes: np.ndarray, marks: np.ndarray, labels: np.ndarray, join: Join, forest: Forest) -> None:
    """Link ``me`` with every component in the tree that has a set linked to ``query``.

    ``marks`` is a false array over all n-gram ranks, given back as it was; ``labels`` names the
    component of each set.
    """
    own = join.own_overlap(size)
    marks[query] = True
    nodes, overlap = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    while len(nodes):
        kids = _ranges(tree.first_kid[nodes], tree.kids[nodes])
        overlap = np.repeat(overlap, tree.kids[nodes])
        leaf = tree.leaf[kids]
        stays = (tree.most[kids] >= own) & (join.own_overlap(tree.least[kids]) <= size)
        stays &= ~leaf | (labels[tree.of[kids]] != labels[me])
        kids, overlap, leaf = kids[stays], overlap[stays], leaf[stays]
        lengths = tree.path_end[kids] - tree.path_start[kids]
        hits = np.concatenate(([0], np.cumsum(marks[tree.path[_ranges(tree.path_start[kids], lengths)]])))
        ends = np.cumsum(lengths)
        overlap = overlap + hits[ends] - hits[ends - lengths]
        found = leaf.copy()
        found[leaf] = overlap[leaf] >= join.overlap(size, sizes[tree.of[kids[leaf]]])
        for other in tree.of[kids[found]].tolist():
            if labels[other] != labels[me]:
                forest.link(me, other)
                labels[labels == labels[other]] = labels[me]
        left = len(query) - np.searchsorted(query, tree.last[kids], side="right")
        reach = overlap + np.minimum(left, tree.longest[kids] - tree.depth[kids])
        on = ~leaf & (reach >= join.overlap(size, np.maximum(tree.least[kids], own)))
        nodes, overlap = kids[on], overlap[on]
    marks[query] = False


def refined(sets: list[np.ndarray], sizes: list[int], join: Join) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The sets that may be linked, in parts of which none has a link to another part.

    Within a part, n-grams that only one set has cannot overlap, and a set with too few others is
    out. The part's own order is by frequency, then by value; sets that are compatible in size and
    share a prefix in it stay together. This goes on until a part stays whole; it is given as the
    numbers of its sets, and the sets as sorted ranks in its order.
    """
    work = [list(range(len(sets)))]
    while work:
        part = work.pop()
        if len(part) < 2:
            continue
        doc = np.repeat(np.arange(len(part)), [len(sets[i]) for i in part])
        value, of, count = np.unique(np.concatenate([sets[i] for i in part]), return_inverse=True, return_counts=True)
        size = np.array([sizes[i] for i in part])
        common = count[of] > 1
        doc, of = doc[common], of[common]
        held = np.bincount(doc, minlength=len(part))
        stays = held >= join.own_overlap(size)
        if not stays.all():
            work.append([i for i, stay in zip(part, stays, strict=True) if stay])
            continue
        rank = np.empty(len(value), dtype=np.uint64)
        rank[np.lexsort((value, count))] = np.arange(len(value), dtype=np.uint64)
        order = np.lexsort((rank[of], doc))
        doc, ranks = doc[order], rank[of][order]
        edges = np.searchsorted(doc, np.arange(len(part) + 1))
        in_prefix = np.arange(len(doc)) - edges[doc] < (held - join.own_overlap(size) + 1)[doc]
        gram, owner = ranks[in_prefix], doc[in_prefix]
        by_gram = np.lexsort((size[owner], gram))
        gram, owner = gram[by_gram], owner[by_gram]
        near = (gram[1:] == gram[:-1]) & (join.own_overlap(size[owner[1:]]) <= size[owner[:-1]])
        forest = Forest(len(part))
        for pair in np.unique(owner[:-1][near] * len(part) + owner[1:][near]).tolist():
            forest.link(*divmod(pair, len(part)))
        parts: dict[int, list[int]] = {}
        for i in range(len(part)):
            parts.setdefault(forest.find(i), []).append(i)
        if len(parts) == 1:
            yield part, [ranks[edges[i] : edges[i + 1]].astype(np.int64) for i in range(len(part))]
        else:
            work.extend([part[i] for i in some] for some in parts.values())


def link_sets(sets: list[np.ndarray], sizes: list[int], join: Join, left: list[bool] | None = None, right: list[bool] | None = None) -> list[tuple[int, int]]:
    """Links that join all sets which hang together, at most one less than there are sets.

    With ``left`` and ``right``, only pairs of a left and a right set are compared.
    """
    links: list[tuple[int, int]] = []
    for part, ranked in refined(sets, sizes, join):
        size = np.array([sizes[i] for i in part])
        inside = [i for i, of in enumerate(part) if right is None or right[of]]
        if not inside:
            continue
        forest = Forest(len(part))
        tree = Tree(ranked, size.tolist(), inside)
        marks = np.zeros(int(max(r[-1] for r in ranked)) + 1, dtype=bool)
        labels = np.arange(len(part))
        for i, of in enumerate(part):
            if left is None or left[of]:
                walk(tree, ranked[i], int(size[i]), i, size, marks, labels, join, forest)
        links += [(part[a], part[b]) for a, b in forest.links]
    return links


def _link_blocks(join: Join):
    """Links within each (block, left slice, right slice) of sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = None

        def out() -> pa.RecordBatch:
            sets = [np.frombuffer(r[1], np.uint64) for r in rows]
            links = link_sets(sets, [r[2] for r in rows], join, [r[3] for r in rows], [r[4] for r in rows])
            pairs = [(rows[a][0], rows[b][0]) for a, b in links]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("block", "i", "j")], strict=True)
            values = zip(*[batch.column(c).to_pylist() for c in ("row", "shared", "n_shingles", "left", "right")], strict=True)
            for key, value in zip(keys, values, strict=True):
                if key != last and rows:
                    yield out()
                rows.append(value)
                last = key
        if rows:
            yield out()

    return run


def _sliced(sizes: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Every pair of slices of a block, each with the rows of both; most blocks are one slice.

    Slices hold ``SLICE`` n-grams of sets in order of size; only slices whose sizes allow a link meet.
    """
    before = Window.partitionBy("block").orderBy("n_shingles", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sizes.select("block", "row", "n_shingles", "grams")
        .withColumn("slice", F.floor(F.coalesce(F.sum("grams").over(before), F.lit(0)) / SLICE).cast("int"))
        .drop("grams")
    )
    slices = placed.groupBy("block", "slice").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    a, b = slices.alias("a"), slices.alias("b")
    pairs = a.join(
        b,
        (F.col("a.block") == F.col("b.block"))
        & (F.col("a.slice") <= F.col("b.slice"))
        & (F.col("b.low") * join.part <= F.col("a.high") * join.of),
    ).select(F.col("a.block").alias("block"), F.col("a.slice").alias("i"), F.col("b.slice").alias("j"))
    sides = pairs.select(
        "block", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("slice")
    ).select("*", (F.col("slice") == F.col("i")).alias("left"), (F.col("slice") == F.col("j")).alias("right"))
    return placed.select("block", "row", "slice").join(sides, ["block", "slice"]).join(
        sets.select("row", "n_shingles", "shared"), "row"
    )


def near_components(docs: DataFrame, join: Join = FOUR_WORDS_85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``.

    Two rows are linked when ``of * intersection >= part * union`` of their sets of lower-cased word
    n-grams; ``component_id`` is the smallest doc_id that links lead to, the row's own included.
    N-grams are compared by 64-bit fingerprints. A component comes out whole, whatever its size; its
    pairs are never listed.

    Null texts and texts without words have an empty set and are linked with nothing. Repeated rows
    are linked rows. A row without doc_id takes part, and keeps a null component_id if its component
    has no doc_id. An empty table gives no rows; further columns are ignored.
    """
    # ids travel as strings, which pandas keeps as they are also beside nulls
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole(F.col("text")).alias("text"))
    id_type = dict(docs.dtypes)["doc_id"]
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    bits = max(LEAST_BUCKETS, chars // CHARS_PER_WORD // BUCKET).bit_length() - 1
    packed = texts.mapInArrow(
        _pack(join.width, bits),
        "bucket long, pack long, docs binary, values binary, known boolean, ids array<string>, sizes binary",
    )
    answered = packed.groupBy("bucket").applyInPandas(
        _meet(bits), "pack long, docs binary, values binary, ids array<string>, sizes binary"
    )
    sets = stage(
        answered.groupBy("pack")
        .applyInPandas(_unpack(join), "row long, doc_id string, n_shingles long, shared binary")
        .withColumn("doc_id", F.col("doc_id").cast(id_type)),
        "shingle-sets",
    )
    may = sets.where(F.col("shared").isNotNull()).withColumn(
        "same", F.concat_ws("-", F.md5("shared"), F.col("n_shingles").cast("string"), F.when(F.length("shared") < 8 * F.col("n_shingles"), F.col("row").cast("string")))
    )
    classes = stage(may.groupBy("same").agg(F.min("row").alias("row"), F.min("doc_id").alias("least")), "set-classes")
    # only small rows move until it is known which sets meet
    firsts = classes.select(F.col("row").alias("first"))
    grams = may.select("row", "n_shingles", "shared").mapInArrow(_prefixes(join), "gram long, row long, n_shingles long")
    grams = grams.join(firsts, F.col("row") == F.col("first"), "left_semi")
    # of the sets with one n-gram, neighbours in size; a linked pair has only compatible sizes between
    by_size = Window.partitionBy("gram").orderBy("n_shingles", "row")
    met = grams.select(
        "row", "n_shingles", F.lag("row").over(by_size).alias("before"), F.lag("n_shingles").over(by_size).alias("size_before")
    ).where(F.col("size_before") * join.of >= F.col("n_shingles") * join.part)
    blocks = components(met.select(F.col("row").alias("a"), F.col("before").alias("b")))
    sizes = may.select("row", "n_shingles", (F.length("shared") / 8).alias("grams"))
    blocked = sizes.join(blocks.select(F.col("node").alias("row"), F.col("component").alias("block")), "row")
    compared = _sliced(blocked, may, join)
    links = stage(
        compared.select("block", "i", "j", "row", "shared", "n_shingles", "left", "right")
        .repartition("block", "i", "j")
        .sortWithinPartitions("block", "i", "j", "n_shingles", "row")
        .mapInArrow(_link_blocks(join), "a long, b long"),
        "links",
    )
    found = components(links)
    named = (
        classes.join(found.withColumnRenamed("node", "row"), "row")
        .groupBy("component")
        .agg(F.min("least").alias("smallest"))
    )
    classed = classes.join(found.withColumnRenamed("node", "row"), "row", "left").join(named, "component", "left")
    of_rows = may.select("row", "same").join(
        classed.select("same", F.coalesce("smallest", "least").alias("component_id")), "same"
    )
    return sets.join(of_rows.select("row", "component_id"), "row", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, join: Join, columns: list[str]) -> DataFrame:
    """``columns`` of one row of each component of ``near_components``: the first by doc_id, then by md5 of the text.

    Rows without doc_id come last. Rows without words are linked with nothing and stay. Rows alike in
    doc_id and text are one row.
    """
    doc_id, kind = F.col("doc_id"), dict(docs.dtypes)["doc_id"]
    if kind != "string":  # so that the order of the names is that of the numbers
        doc_id = F.lpad((doc_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    name = F.concat_ws("-", F.coalesce(doc_id, F.lit("~")), F.md5(whole(F.col("text"))))
    classes = near_components(docs.select(name.alias("doc_id"), "text"), join)
    first = (
        classes.where((F.col("doc_id") == F.col("component_id")) | (F.col("n_shingles") == 0))
        .select(F.col("doc_id").alias("_name"))
        .distinct()
    )
    return docs.select(*columns, name.alias("_name")).join(first, "_name", "left_semi").dropDuplicates(["_name"]).select(*columns)
