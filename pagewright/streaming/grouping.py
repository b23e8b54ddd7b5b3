"""How rows are handed to the parallel consumers of a step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions.url import crawl_domain, domain_shard


def shuffle_grouping(df: DataFrame, consumers: int) -> DataFrame:
    """An even share for every consumer."""
    return df.repartition(consumers)


def fields_grouping(df: DataFrame, consumers: int, *fields: str) -> DataFrame:
    """Equal field values go to the same consumer."""
    return df.repartition(consumers, *fields)


def all_grouping(df: DataFrame, consumers: int) -> DataFrame:
    """Every consumer gets every row."""
    ids = F.sequence(F.lit(0), F.lit(consumers - 1))
    return df.withColumn("consumer", F.explode(ids)).repartition(consumers, "consumer")


def domain_sharding(urls: DataFrame, shards: int) -> DataFrame:
    """Add the shard that owns each URL's crawl domain."""
    return urls.withColumn("shard", domain_shard(crawl_domain(F.col("url")), shards))


def write_by_shard(urls: DataFrame, path: str, shards: int) -> None:
    """Store rows that have a ``url`` in one folder per shard; a hot domain's rows are several files."""
    rows = domain_sharding(urls, shards)
    rows.repartitionByRange("shard", "url").write.partitionBy("shard").mode("overwrite").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows one shard owns; no other shard's files are listed for reading."""
    return spark.read.parquet(path).where(F.col("shard") == shard)
