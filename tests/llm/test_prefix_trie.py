"""Prefix trie against a plain one: hot first turns, long conversations, nulls, ties, turnless ones."""

import random
import zlib

import brute
from pyspark.sql import functions as F

from pagewright.llm import prefix_trie as trie
from pagewright.llm.queries import _rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"


def built(spark, sequences):
    rows = [(c, d + 1, f"{r}:{t}", len(t)) for c, turns in sequences.items() for d, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, depth long, said string, chars long")
    return trie.prefix_trie(turns, spark.createDataFrame([(c,) for c in sequences], "conv_id long"))


def rows_of(df):
    return sorted((*(str(r[c]) if c == "parent_conv_id" else r[c] for c in COLUMNS),) for r in df.collect())


def random_sequences(n, seed=1):
    rng = random.Random(seed)
    made = {}
    for i in range(n):
        length = rng.choice([0, 1, 2, 3, 5, 8, 40])
        # a third begins alike, some are the same throughout
        turns = [("user", rng.choice("aaab")) for _ in range(length)] if i % 3 else [("system", "be good")] * min(length, 2) + [
            ("user", f"t{rng.randrange(4)} é🙂") for _ in range(length)
        ]
        made[i * 37 % 1009 - 200] = turns
    return made


def test_trie(spark):
    sequences = random_sequences(300)
    assert rows_of(built(spark, sequences)) == brute.trie_rows(sequences)


def test_long_conversation_over_many_partitions(spark):
    sequences = {7: [("u", str(i % 5)) for i in range(4000)], 8: [("u", str(i % 5)) for i in range(1500)] + [("u", "x")], 9: []}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = built(spark, sequences).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(frame) == 4002
    by_place = {(r.conv_id, r.depth): r for r in frame}
    root = by_place[7, 0]
    assert (root.n_convs, root.n_leaves, root.n_children, root.saved_tokens) == (3, 2, 1, 1500)
    assert (by_place[7, 1500].n_convs, by_place[7, 1500].n_children, by_place[7, 1501].n_leaves) == (2, 2, 1)
    assert by_place[8, 1501].parent_conv_id == 7 and by_place[7, 1000].saved_tokens == 501


def test_no_conversations(spark):
    assert built(spark, {1: []}).select("depth", "n_leaves", "n_convs").collect() == [(0, 1, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(*_rebuilt(none)).count() == 0


def plainly_rebuilt(rows):
    own = {}
    for conv_id, turn, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[1] is not None, r[1] or 0, brute.hashed(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}")),
    ):
        own.setdefault(conv_id, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def test_rebuilt_conversations(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(100, 160), 200, 201, 333, 334, 405, 7]:
        for turn in range(rng.choice([1, 2, 4, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "", None, "long " * 50])))
    rows += [(100, None, "user", "z"), (101, None, "user", "y"), (101, 1, "user", "tie"), (101, 1, "user", "tie"), (None, 1, "user", "x")]
    rows += [(150, 1, "user", "w" * 300_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("depth", "fp1", "node", "parent", "shard", "position", "said", "chars", "n", "base", "h", "anchor"):
        df = df.withColumn(name, F.lit(name))
    assert rows_of(trie.prefix_trie(*_rebuilt(df))) == brute.trie_rows(plainly_rebuilt(rows))


def test_queue_spills():
    rng = random.Random(2)
    queue = trie.SpillingQueue(limit=50)
    sent, last = {}, -1
    for step in range(3000):
        key = (step + rng.randrange(1, 900),)
        sent[key] = sent.get(key, 0) + step
        queue.push(key, (step, 1))
        assert queue.take((step,))[0] == sent.pop((step,), 0)
    assert len(queue.runs) > 1 and queue.held <= 51
    for key in sorted(sent):
        assert queue.take(key)[0] == sent[key]
