"""Registration of queries and access to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is its equivalent on the same tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from pagewright.session import tune

            return fn(Tables(tune(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def oracle(sql: str) -> str:
    """Fill in table names: ``{{events}}`` in shared SQL text is plain ``events`` for the oracle."""
    for table in TABLES:
        sql = sql.replace("{" + table + "}", table)
    return sql


class Tables:
    """The parquet tables of one scale factor; ``sql`` runs text shared with the oracle."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used)
