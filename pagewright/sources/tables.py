"""Table reads and writes: parquet first, JDBC with the caller's own options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A parquet table, optionally spread over a number of partitions."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


def read_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A SQL text over named tables."""
    return spark.sql(sql, **tables)


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with a numeric column and its bounds it is read by many tasks at once."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def pushed_query_options(
    options: dict[str, str],
    sql: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Reader options for a SQL text that the database runs.

    With a numeric column of its result and the column's bounds, the text stands as a derived table and
    each task asks for one range of the column; rows outside the bounds are in the first and last range.
    A text on its own can only be read by one task.
    """
    text = sql.strip().rstrip(";")
    if partition_column is None:
        return {**options, "query": text}
    if bounds is None:
        raise ValueError("a partition column needs bounds")
    return {
        **options,
        "dbtable": f"({text}) pushed",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_jdbc_query(
    spark: SparkSession,
    options: dict[str, str],
    sql: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    predicates: list[str] | None = None,
) -> DataFrame:
    """The result of a SQL text the database runs, read by one task or by many.

    ``predicates`` are conditions on the result that exclude each other and hold for every row between
    them: one task each. They serve keys that are not numbers.
    """
    if predicates:
        rest = {name: value for name, value in options.items() if name != "url"}
        return spark.read.jdbc(options["url"], f"({sql.strip().rstrip(';')}) pushed", predicates=predicates, properties=rest)
    return spark.read.format("jdbc").options(**pushed_query_options(options, sql, partition_column, bounds, partitions)).load()


def overwrite_jdbc(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Replace all rows and keep the table definition."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )


def recreate_jdbc(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Drop the table and create it from the schema of ``df``."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("truncate", "false")
        .mode("overwrite")
        .save()
    )


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a parquet table's rows; the columns must be those it already has."""
    spark = df.sparkSession
    existing = spark.read.parquet(path)
    df = df.select(*[df[c].cast(existing.schema[c].dataType) for c in existing.columns])
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(existing.schema).parquet(path)


def recreate_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a parquet table together with its definition."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_sorted(df: DataFrame, path: str, *keys: str) -> None:
    """Save sorted by ``keys``, with a Bloom filter on the first, so that a lookup reads few row groups.

    Rows are range partitioned on all keys: end them with a unique one, and a key value that holds
    many rows is spread over several files.
    """
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true")
        .mode("overwrite")
        .parquet(path)
    )


def lookup(spark: SparkSession, path: str, key: str, values: list, columns: list[str]) -> DataFrame:
    """``SELECT columns WHERE key IN (values)`` on a stored table, for as many values as a caller types.

    The list reaches the parquet reader: of a ``write_sorted`` table only the row groups and pages that
    may hold a value are read. Many keys are a table; see ``operators.tables.by_keys``.
    """
    return spark.read.parquet(path).where(F.col(key).isin(values)).select(*columns)


def write_clustered(df: DataFrame, table: str, buckets: int, key: str) -> None:
    """Save as a bucketed table, so later joins on ``key`` need no shuffle."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
