"""Stored layouts read only what a lookup or a shard needs; options of a pushed query."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pagewright.sources import tables
from pagewright.streaming import grouping


def metric(df, name):
    """A figure of the scan of a plan without a shuffle, once it has run."""
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply(name).value()


def scanned(df):
    df.collect()
    return metric(df, "numOutputRows")


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.uuid().alias("payload"))
    spark.conf.set("parquet.block.size", str(64 * 1024))
    try:
        tables.write_sorted(rows, str(tmp_path / "sorted"), "k", "payload")
        rows.write.option("parquet.block.size", str(64 * 1024)).parquet(str(tmp_path / "plain"))
    finally:
        spark.conf.unset("parquet.block.size")
    wanted = [5, n // 2, n + 3]
    found = tables.lookup(spark, str(tmp_path / "sorted"), "k", wanted, ["k", "payload"])
    assert sorted(r.k for r in found.collect()) == [5, n // 2]
    few = scanned(found)
    assert few * 4 < n
    assert few * 4 < scanned(tables.lookup(spark, str(tmp_path / "plain"), "k", wanted, ["k", "payload"]))


def test_a_shard_is_read_alone(spark, tmp_path):
    urls = spark.range(300).select(F.concat(F.lit("http://h"), F.col("id") % 40, F.lit(".com:80/"), "id").alias("url"))
    path = str(tmp_path / "shards")
    grouping.write_by_shard(urls, path, 4)
    total = 0
    for shard in range(4):
        read = grouping.read_shard(spark, path, shard)
        read.collect()
        assert metric(read, "numPartitions") == 1
        total += read.count()
        for row in read.select("url").collect():
            domain = row.url.rsplit("/", 1)[0]
            assert int(hashlib.md5(domain.encode()).hexdigest()[:8], 16) % 4 == shard
    assert total == 300


OPTIONS = {"url": "jdbc:x", "user": "u"}


def test_a_pushed_query_is_one_task_by_itself():
    assert tables.pushed_query_options(OPTIONS, "SELECT 1;") == {**OPTIONS, "query": "SELECT 1"}


def test_a_pushed_query_in_ranges():
    got = tables.pushed_query_options(OPTIONS, " SELECT id FROM t; ", "id", (1, 1000), 16)
    assert got == {
        **OPTIONS, "dbtable": "(SELECT id FROM t) pushed", "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }
    with pytest.raises(ValueError, match="bounds"):
        tables.pushed_query_options(OPTIONS, "SELECT 1", "id")
