"""Joins, ranks and limits that hold when one key carries a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagewright.session import stage

HOT_SHARE = 1000
TRACKED_ITEMS = 4000
MERGE_GROUPS = 128
SLICES_PER_PARTITION = 8
TOP_K_SLICES = 32


def spread(df: DataFrame) -> DataFrame:
    """Repartition the input of CPU-heavy work when the session asks for it.

    ``spark.pagewright.inputPartitions`` is for tables of one small file; without it rows stay as scanned.
    """
    parts = df.sparkSession.conf.get("spark.pagewright.inputPartitions", None)
    return df.repartition(int(parts)) if parts and not df.isStreaming else df


def slices_of(rows: Column, total: Column) -> Column:
    """Over how many slices a key with ``rows`` of ``total`` rows is split.

    It follows the key's share, so a slice holds an eighth of a mean shuffle partition however large
    the key is, and what hashes to one partition stays near the mean.
    """
    parts = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    return F.greatest(F.ceil(rows / total * (SLICES_PER_PARTITION * parts)), F.lit(1)).cast("int")


def hot_keys(df: DataFrame, *keys: str) -> dict[str, DataFrame]:
    """For each column, (value, slices) of the values that hold at least ``1/HOT_SHARE`` of the rows.

    One pass with a frequent-items sketch, merged in two levels; no key is shuffled. The sketch never
    misses such a value, and what it lists too much only costs a few more copies. Each result has at
    most ``HOT_SHARE`` rows.
    """
    merged = (
        df.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("_group"))
        .agg(
            F.count("*").alias("_rows"),
            *[F.expr(f"approx_top_k_accumulate({key}, {TRACKED_ITEMS})").alias(key) for key in keys],
        )
        # grouped by a constant: a task without rows then has no sketch to combine
        .groupBy(F.lit("all"))
        .agg(
            F.sum("_rows").alias("_rows"),
            *[F.expr(f"approx_top_k_combine({key}, {TRACKED_ITEMS})").alias(key) for key in keys],
        )
    )

    def listed(key: str) -> DataFrame:
        found = F.explode(F.expr(f"approx_top_k_estimate({key}, {HOT_SHARE})")).alias("_found")
        return (
            merged.select("_rows", found)
            .where(F.col("_found.count") * HOT_SHARE >= F.col("_rows"))
            .select(F.col("_found.item").alias(key), slices_of(F.col("_found.count"), F.col("_rows")).alias("slices"))
        )

    return {key: listed(key) for key in keys}


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    spread_by: list[str],
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``facts`` with a table that has at most one row per ``key``.

    Rows of hot keys are split over as many slices as their share asks for, by a hash of
    ``spread_by``; only the lookup rows of those keys are repeated. ``hot`` is (key, slices). It is
    broadcast, which is safe because at most ``HOT_SHARE`` keys can hold ``1/HOT_SHARE`` of the rows
    each. Null keys meet nothing and are spread as well.
    """
    hot = hot_keys(facts, key)[key] if hot is None else hot
    marked = F.broadcast(hot.select(key, F.col("slices").alias("_slices")))
    spread_hash = F.xxhash64(*spread_by)
    fact_salt = (
        F.when(F.col(key).isNull(), F.pmod(spread_hash, F.lit(2**20)))
        .when(F.col("_slices").isNotNull(), F.pmod(spread_hash, F.col("_slices")))
        .otherwise(0)
        .cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
    left = facts.join(marked, key, "left").withColumn("_salt", fact_salt).drop("_slices")
    right = lookup.join(marked, key, "left").withColumn("_salt", F.explode(copies)).drop("_slices")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int, spread_by: str, salts: int = TOP_K_SLICES
) -> DataFrame:
    """The first ``k`` rows of every group, ranked in ``rank``; exact for groups of any size.

    Each of ``salts`` slices of a group is cut to ``k`` rows first, so the task that ranks a group
    sees at most ``k * salts`` rows. A slice is what some tasks hold of the group, as each task sends
    no more than ``k`` rows of a group on; for a ``k`` above Spark's limit for that cut, rows are dealt to
    slices by a hash of ``spread_by``.
    """
    cut_first = k <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    dealt = F.spark_partition_id() if cut_first else F.xxhash64(spread_by)
    slice_window = Window.partitionBy(*group, "_slice").orderBy(*order)
    sliced = (
        df.withColumn("_slice", F.pmod(dealt, F.lit(salts)))
        .withColumn("_rank", F.row_number().over(slice_window))
        .where(F.col("_rank") <= k)
        .drop("_rank", "_slice")
    )
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return sliced.withColumn("rank", rank).where(F.col("rank") <= k)


def positions(df: DataFrame, order: list[str], group: str | None = None) -> DataFrame:
    """Add ``position``, the 1-based place of a row in ``order`` (within ``group`` when given).

    Same values as ``row_number()``, but a group may span many partitions: rows are range
    partitioned, numbered where they are, and shifted by the sizes of the parts before them.
    ``order`` must be total.
    """
    keys = ["_part"] + ([group] if group else [])
    sort = ([group] if group else []) + order
    numbered = stage(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_index", F.monotonically_increasing_id()),
        "positions",
    )
    parts = numbered.groupBy(*keys).agg(
        F.min("_index").alias("_first"), F.count("*").alias("_size")
    )
    earlier = Window.orderBy("_part") if group is None else Window.partitionBy(group).orderBy("_part")
    offsets = parts.select(
        *[F.col(name).alias(f"_at_{name}") for name in keys],
        "_first",
        F.coalesce(
            F.sum("_size").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    # without a group there is one offset row per partition of the range shuffle
    offsets = F.broadcast(offsets) if group is None else offsets
    same = [F.col(name).eqNullSafe(F.col(f"_at_{name}")) for name in keys]
    return numbered.join(offsets, same).select(
        *df.columns,
        (F.col("_index") - F.col("_first") + F.col("_before") + 1).alias("position"),
    )
