"""Packing: whole ids, full coverage, no gaps, and about as few sequences as plain best fit finds."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import packing
from pagewright.llm.queries import TOKENIZER_PATH


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= n]
        if fitting:
            best = min(fitting, key=lambda i: rooms[i])
            rooms[best] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def packed(spark, lengths, capacity=2048, **options):
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "item long, length long")
    rows = packing.pack(frame, capacity, **options).collect()
    assert sorted((r.item, r.length) for r in rows) == list(enumerate(lengths))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences)


@pytest.mark.parametrize("kind", ["mixed", "large", "small", "few sizes", "full"])
def test_pack(spark, kind):
    rng = random.Random(kind)
    draw = {
        "mixed": lambda: min(2048, max(1, int(rng.lognormvariate(6.3, 1.1)))),
        "large": lambda: rng.randint(500, 1400),
        "small": lambda: rng.randint(1, 256),
        "few sizes": lambda: rng.choice([683, 682, 1024, 1025, 512, 1536, 40]),
        "full": lambda: rng.choice([2048, 2048, 2047, 1]),
    }[kind]
    lengths = [draw() for _ in range(3000)]
    found = packed(spark, lengths)
    assert found >= -(-sum(lengths) // 2048)
    assert found <= 1.02 * plain_best_fit(lengths, 2048) + 2


@pytest.mark.parametrize("lengths", [[], [2048], [1], [5, 5, 5], [1500, 1500], [2047, 1, 1], [257], [256] * 9])
def test_few_pieces(spark, lengths):
    assert packed(spark, lengths) == plain_best_fit(lengths, 2048)


def test_configurations_hold_all_demands():
    rng = random.Random(1)
    for _ in range(5):
        sizes = np.array(sorted(rng.sample(range(130, 1000), 12), reverse=True))
        demands = np.array([rng.randint(1, 400) for _ in sizes])
        chosen = packing.configurations(sizes, demands, 1000)
        held = sum(numbers * times for numbers, times in chosen)
        assert (held >= demands).all() and all(numbers @ sizes <= 1000 for numbers, _ in chosen)
        used = sum(times for _, times in chosen)
        assert used <= plain_best_fit([s for s, d in zip(sizes, demands) for _ in range(d)], 1000) + 3


def test_token_pieces(spark, docs, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(TOKENIZER_PATH)
    library.encode_special_tokens = True
    rng = random.Random(3)
    texts = [None, "", " ", "<|endoftext|> x", "é🙂\n\n a  b", " ".join(f"w{rng.randrange(999)}" for _ in range(3000))]
    texts += ["".join(rng.choice("ab \n\t'.é7") for _ in range(400_000)), "x" * 5000]
    odd = " \u00a0\u3000\x1c\x85\u2028\r\n\tab.'s9é<|>"
    texts += ["".join(rng.choice(odd) for _ in range(n)) for n in (1, 2, 3, 5, 9, 30, 400) * 30]
    rows = [*enumerate(texts), (None, "null id"), (1, ""), (5, texts[5])]
    df = docs(rows).withColumn("piece", F.lit("p")).withColumn("length", F.lit("l")).withColumn("row", F.lit(1))
    found = packing.token_pieces(df, TOKENIZER_PATH).collect()
    expected = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048
        edges = [0, *range(first, len(ids) + 1, 2048)] if first else list(range(0, len(ids) + 1, 2048))
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            raw = b"".join(x.to_bytes(4, "little") for x in ids[a:b])
            expected.append((str(doc_id), i, a, b - a, zlib.crc32(raw)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)


def test_pieces_are_packed_whole(spark, docs):
    rows = [(i % 50, "word " * (i * 37 % 3000)) for i in range(60)] + [(None, None), (None, "a")]
    pieces = packing.token_pieces(docs(rows), TOKENIZER_PATH)
    got = packing.pack(pieces).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length) for r in got) == sorted(
        (str(r.doc_id), r.piece, r.start, r.length) for r in pieces.collect()
    )
    assert packing.token_pieces(docs([]), TOKENIZER_PATH).count() == 0
