"""SentencePiece encoding and decoding by a lattice of pieces.

Per batch of documents: the distinct words are exploded into their substrings of at most the longest
piece's length, substrings are joined with the piece table on equal fingerprints, and what is found
are the edges (word, start, end, piece) of a lattice. A fold over each word's edges gives its pieces:
the best path for unigram models (Viterbi), merges in order of rank for byte-pair models, where a best
path would be another segmentation. The piece table is a fixed part of the model.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.columns import whole
from pagewright.llm.tokens import Runs

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, BYTE = 1, 2, 6
NEVER = np.int64(1) << 62
# characters of text, and of distinct words, worked on at once; longer words are folded one by one
TEXT_CHARS = 6_000_000
WORD_CHARS = 40_000
LONG_WORD = 200
# encoded words a worker keeps for its next texts, in each of two generations
KNOWN_WORDS = 250_000
# places in the table that tells most fingerprints of no piece from those of pieces
MARKS = 1 << 20


@dataclass
class Pieces:
    """A piece table: pieces by id, scores, and kinds as in the model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int
    ids: dict[str, int] = field(init=False)
    bytes_at: list[int] = field(init=False)
    known: dict[str, bytes] = field(init=False, default_factory=dict)  # words a worker has met, bounded
    older: dict[str, bytes] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        self.bytes_at = [i for i, k in enumerate(self.kinds) if k == BYTE]
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece holds a space behind another character, so words are not independent")
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t" if c not in joined)
        self.word = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]" if alone else ""))
        order = sorted(self.ids, key=lambda p: self.ids[p])
        # rank of a merge: highest score first, as scores are distinct or ties go by id
        ranked = sorted(order, key=lambda p: -self.scores[self.ids[p]])
        self.rank = {p: r for r, p in enumerate(ranked)}
        text = np.frombuffer("".join(order).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        ends = np.cumsum([len(p) for p in order])
        prints = Runs(text).fingerprints(ends - [len(p) for p in order], ends)
        by_print = np.argsort(prints)
        self.prints = prints[by_print]
        self.print_ids = np.array([self.ids[p] for p in order], dtype=np.int64)[by_print]
        self.print_ranks = np.array([self.rank[p] for p in order], dtype=np.int64)[by_print]
        self.marks = np.zeros(MARKS, dtype=bool)
        self.marks[self.prints & np.uint64(MARKS - 1)] = True
        self.plain = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for value, i in enumerate(self.bytes_at):
            self.plain[i] = bytes([value])
        self.plain = [b"" if k not in (NORMAL, BYTE) else p for p, k in zip(self.plain, self.kinds, strict=True)]
        self.plain_sizes = np.array(list(map(len, self.plain)), dtype=np.int64)

    def spelled(self, text: str) -> list[int]:
        """Ids of characters that are no piece."""
        return [self.bytes_at[b] for b in text.encode("utf-8", "replace")] if self.bytes_at else [self.unknown] * len(text)


def load(path: str) -> Pieces:
    """The pieces of a model file that keeps white space and does not normalise."""
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    how = model.normalizer_spec
    if how.precompiled_charsmap or how.remove_extra_whitespaces or not how.add_dummy_prefix:
        raise ValueError("models that normalise text are not supported")
    return Pieces(
        [p.piece for p in model.pieces], [p.score for p in model.pieces], [p.type for p in model.pieces],
        model.trainer_spec.model_type,
    )


def edges(words: list[str], table: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lattice of ``words`` laid end to end: (start, length, id, rank) of each edge, and word ends."""
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    limit = np.repeat(ends, sizes)
    runs, start = Runs(chars), np.arange(len(chars))
    found = []
    for length in range(1, table.longest + 1):
        fits = start[start + length <= limit]
        prints = runs.fingerprints(fits, fits + length)
        maybe = np.flatnonzero(table.marks[prints & np.uint64(MARKS - 1)])
        fits, prints = fits[maybe], prints[maybe]
        at = np.minimum(np.searchsorted(table.prints, prints), len(table.prints) - 1)
        hit = table.prints[at] == prints
        found.append((fits[hit], np.full(hit.sum(), length), table.print_ids[at[hit]], table.print_ranks[at[hit]]))
    return (*(np.concatenate(x) for x in zip(*found, strict=True)), ends)


def merge_words(words: list[str], table: Pieces) -> list[list[int]]:
    """Pieces of each word by merges: again and again the neighbours whose joint piece ranks first, leftmost on ties."""
    start, length, ids, ranks, ends = edges(words, table)
    n = int(ends[-1]) if len(ends) else 0
    wide = table.longest + 1
    rank_at = np.full(n * wide, NEVER)
    rank_at[start * wide + length] = ranks
    id_at = np.full(n * wide, -1, dtype=np.int64)
    id_at[start * wide + length] = ids
    # symbols in order: where they begin, how long they are, and of which word
    at = np.arange(n)
    size = np.ones(n, dtype=np.int64)
    word = np.repeat(np.arange(len(words)), np.diff(np.concatenate(([0], ends))))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(at):
        both = size[:-1] + size[1:]
        joint = np.full(len(at), NEVER)
        can = (word[:-1] == word[1:]) & (both < wide)
        joint[:-1][can] = rank_at[at[:-1][can] * wide + both[can]]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        best = np.minimum.reduceat(joint, first)
        count = np.diff(np.concatenate((first, [len(at)])))
        over = np.repeat(best == NEVER, count)
        done.append((at[over], size[over]))
        # the leftmost symbol with its word's best rank takes in its neighbour
        winner = np.flatnonzero((joint == np.repeat(best, count)) & ~over)
        winner = winner[np.concatenate(([True], word[winner[1:]] != word[winner[:-1]]))] if len(winner) else winner
        size[winner] += size[winner + 1]
        stays = ~over
        stays[winner + 1] = False
        at, size, word = at[stays], size[stays], word[stays]
    at, size = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, int), np.zeros(0, int))
    order = np.argsort(at)
    at, size = at[order], size[order]
    chosen = id_at[at * wide + size]
    cuts = np.searchsorted(at, np.concatenate(([0], ends)))
    pieces, bounds = chosen.tolist(), cuts.tolist()
    out = [pieces[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    for i in np.unique(np.searchsorted(cuts, np.flatnonzero(chosen == -1), side="right") - 1).tolist():
        begin = ends[i] - len(words[i])
        spelled: list[int] = []
        for piece, a, k in zip(out[i], at[bounds[i] : bounds[i + 1]].tolist(), size[bounds[i] : bounds[i + 1]].tolist(), strict=True):
            spelled += [piece] if piece >= 0 else table.spelled(words[i][a - begin : a - begin + k])
        out[i] = spelled
    return out


def merge_long(word: str, table: Pieces) -> list[int]:
    """The same for one word of any length, with a queue of possible merges."""
    text = list(word)
    after = list(range(1, len(text) + 1))
    before = list(range(-1, len(text) - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = after[a]
        if b < len(text):
            rank = table.rank.get(text[a] + text[b])
            if rank is not None:
                heapq.heappush(queue, (rank, a, len(text[a]) + len(text[b])))

    for a in range(len(text) - 1):
        offer(a)
    while queue:
        _, a, size = heapq.heappop(queue)
        b = after[a]
        if not text[a] or b >= len(text) or len(text[a]) + len(text[b]) != size:
            continue
        text[a] += text[b]
        text[b] = ""
        after[a] = after[b]
        if after[b] < len(text):
            before[after[b]] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out: list[int] = []
    for symbol in filter(None, text):
        out += [table.ids[symbol]] if symbol in table.ids else table.spelled(symbol)
    return out


def best_paths(words: list[str], table: Pieces) -> list[list[int]]:
    """Pieces of each word by the path of the highest total score (Viterbi); unknown characters cost most."""
    start, length, ids, _, ends = edges(words, table)
    order = np.argsort(start + length, kind="stable")
    unknown = min(table.scores, default=0.0) - 10.0
    arriving: dict[int, list[tuple[int, int]]] = {}
    for i in order.tolist():
        arriving.setdefault(int(start[i] + length[i]), []).append((int(start[i]), int(ids[i])))
    out = []
    for text, end in zip(words, ends.tolist(), strict=True):
        begin = end - len(text)
        best: dict[int, tuple[float, int, int]] = {begin: (0.0, -1, -1)}
        for at in range(begin + 1, end + 1):
            options = [(best[a][0] + table.scores[i], a, i) for a, i in arriving.get(at, ())]
            if not any(a == at - 1 for _, a, _ in options):
                options.append((best[at - 1][0] + unknown, at - 1, -1))
            best[at] = max(options, key=lambda o: o[0])
        path, at = [], end
        while at > begin:
            _, a, i = best[at]
            path.append([i] if i >= 0 else table.spelled(text[a - begin : at - begin]))
            at = a
        out.append([i for step in reversed(path) for i in step])
    return out


def encode_words(words: list[str], table: Pieces) -> list[list[int]]:
    """Ids of each word; words are encoded some thousand at a time."""
    fold = best_paths if table.model == UNIGRAM else merge_words
    out: list[list[int]] = [[]] * len(words)
    some: list[int] = []
    size = 0

    def flush() -> None:
        for i, ids in zip(some, fold([words[i] for i in some], table), strict=True):
            out[i] = ids
        some.clear()

    for i, word in enumerate(words):
        if len(word) > LONG_WORD and table.model == BPE:
            out[i] = merge_long(word, table)
            continue
        some.append(i)
        size += len(word)
        if size >= WORD_CHARS:
            flush()
            size = 0
    if some:
        flush()
    return out


def _learned(words: list[str], table: Pieces) -> tuple[dict[str, bytes], set[str]]:
    """The ids of each word as bytes, and the words that their pieces do not spell again."""
    encoded = encode_words(words, table)
    sizes = np.fromiter(map(len, encoded), np.int64, len(words))
    ids = np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes.sum()))
    raw, ends = ids.tobytes(), np.cumsum(sizes)
    bounds = [0, *(4 * ends).tolist()]
    packed = {w: raw[a:b] for w, a, b in zip(words, bounds, bounds[1:], strict=False)}
    written = [w.replace(SPACE, " ").encode("utf-8", "surrogatepass") for w in words]
    lengths = np.concatenate(([0], np.cumsum(table.plain_sizes[ids])))[ends]
    if (lengths == np.cumsum(np.fromiter(map(len, written), np.int64, len(words)))).all():
        if b"".join(map(table.plain.__getitem__, ids.tolist())) == b"".join(written):
            return packed, set()
    plain = (b"".join(map(table.plain.__getitem__, some)) for some in encoded)
    return packed, {w for w, a, b in zip(words, plain, written, strict=True) if a != b}


def encode_texts(texts: list[str], table: Pieces) -> tuple[list[np.ndarray], list[bool]]:
    """Ids of each text and whether they decode to it; every distinct word is encoded and decoded once.

    A text whose words are spelled again by their pieces comes out whole but for U+2581; a text with other
    words is decoded.
    """
    found = [table.word.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
    words = list(chain.from_iterable(found))
    distinct = list(dict.fromkeys(words))
    new = [w for w in distinct if w not in table.known]
    met = {w: table.older[w] for w in new if w in table.older}
    made, odd = _learned([w for w in new if w not in met], table)
    parts = [table.known.get(w) or met.get(w) or made[w] for w in distinct]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat = np.frombuffer(b"".join(parts), dtype=np.int32)
    codes = dict(zip(distinct, range(len(distinct)), strict=True))
    used = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    # what does not come out again is met anew each time
    made = {w: ids for w, ids in made.items() if w not in odd}
    for some in (met, made):
        if len(table.known) + len(some) > KNOWN_WORDS:
            table.older, table.known = table.known, {}
        table.known.update(islice(some.items(), KNOWN_WORDS))
    count = sizes[used]
    ends = np.concatenate(([0], np.cumsum(count)))
    first = np.cumsum(sizes) - sizes
    ids = flat[np.arange(ends[-1]) + np.repeat(first[used] - ends[:-1], count)]
    cuts = ends[np.cumsum([0, *map(len, found)])].tolist()
    out = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    same = [
        decode(some, table) == text if odd and not odd.isdisjoint(its) else SPACE not in text
        for some, text, its in zip(out, texts, found, strict=True)
    ]
    return out, same


def decode(ids: np.ndarray, table: Pieces) -> str:
    """The text of some ids: pieces in a row, byte pieces as bytes, without the space put in front."""
    text = b"".join(map(table.plain.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode_documents(docs: DataFrame, table: Pieces, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of each row of ``docs`` with ``ids`` (array of int) and ``round_trip``.

    ``ids`` are the pieces of ``text`` without any added marks; ``round_trip`` says whether decoding
    them gives the text again, which holds for all texts but those with U+2581, the mark for spaces.
    Characters that are no piece are spelled in bytes. Null and empty texts have no ids; repeated rows
    are each encoded; no rows give no rows. Columns not named are ignored.
    """
    rows = docs.select(F.struct(*columns).alias("row"), whole(F.col("text")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        kept: list[pa.Array] = []
        texts: list[str] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, same = encode_texts(texts, pieces)
            offsets = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            rows = pa.concat_arrays(kept)
            yield pa.RecordBatch.from_arrays(
                [rows, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())), pa.array(same)],
                names=["row", "ids", "round_trip"],
            )
            kept.clear()
            texts.clear()

        for batch in batches:
            column = batch.column("text").to_pylist()
            begin = 0
            for i, text in enumerate(column):
                texts.append(text)
                size += len(text)
                if size >= TEXT_CHARS:
                    kept.append(batch.column("row").slice(begin, i + 1 - begin))
                    begin, size = i + 1, 0
                    yield from flush()
            if begin < len(column):
                kept.append(batch.column("row").slice(begin))
        if texts:
            yield from flush()

    kind = dict(rows.dtypes)["row"]
    return rows.mapInArrow(run, f"row {kind}, ids array<int>, round_trip boolean").select("row.*", "ids", "round_trip")
