"""Merkle manifest against a plain tree: several tiers, nulls, ties, lone rows, clashing columns."""

import zlib

import brute
import pytest
from pyspark.sql import functions as F

from pagewright.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def found(df, **options):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(merkle.document_leaves(df, changed), **options).collect()
    out = []
    for r in rows:
        siblings = "".join(entry[1:] for entry in r.proof)
        last = r.version[-1] if r.version else r.changed or r.leaf
        out.append((str(r.doc_id), r.leaf, r.subroot, r.root, brute.hashed(siblings), last))
    return sorted(out)


def many():
    rows = [(i * 3 % 301, f"s{i % 3}", ["en", "en", "en", "de", "zz", None, "é"][i % 7], i, f"text {i}\n") for i in range(301)]
    return rows + [
        (None, None, None, None, None), (5, "s", "en", 1, "same"), (5, "s", "en", 1, "same"), (7, "", "", 0, ""),
        (-4, "s", "en", None, "x" * 100_000), (None, "s", "en", 4, "a"), (None, "s", "en", 4, "b"), (14, "s", "one", 2**63 - 2, "b"),
    ]


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_manifest(spark, height):
    assert found(spark.createDataFrame(many(), SCHEMA), height=height) == brute.merkle_rows(many(), tampered)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_small_trees(spark, n):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(n)]
    assert found(spark.createDataFrame(rows, SCHEMA), height=1) == brute.merkle_rows(rows, tampered)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_clashing_columns(spark):
    rows = many()[:40]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "changed", "at", "hash", "path", "none", "name", "block", "position", "_part", "root", "proof"):
        df = df.withColumn(name, F.lit(name))
    assert found(df, height=2) == brute.merkle_rows(rows, tampered)


def test_a_version_shares_what_is_beside_its_path(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(11)]
    df = spark.createDataFrame(rows, SCHEMA)
    last = merkle.manifest(merkle.document_leaves(df, F.col("doc_id") == 6), 2).collect()
    by_id = {r.doc_id: r for r in last}
    changed, beside = by_id[6], by_id[7]
    assert changed.version[-1] != changed.root and len(changed.version) == len(changed.proof) == 4
    assert all(r.version[-1] == r.root for r in last if r.doc_id != 6)
    # the sibling's own path goes through the nodes that the version copies, the others are those of the tree
    assert set(beside.proof[1:]) == set(changed.proof[1:])
