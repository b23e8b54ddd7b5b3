"""Mixing sources of documents to target shares of words.

Documents get hash-random keys. A source's keys are cut into ranges, ranges are summed before any
row moves, and prefix sums over ranges and then within them say where the source's budget ends. A
source of any size is spread over many ranges, so no task holds more than one range's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.columns import word_count
from pagewright.operators.scale import positions
from pagewright.session import stage

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
# documents per key range aimed at, and hex digits of the key that name a range
ROWS_PER_RANGE = 20_000
MAX_DIGITS = 8


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) for ``sizes(source, size)``.

    Sources in code-point order, null last, take ``weights`` in turn and share all words in that
    proportion. A target stops at ``max_epochs`` times its source; the excess is shared again by
    weight among the others until none is above. Each round is one aggregate over the sources and
    caps at least one source; all rounds but a few cap many.
    """
    sums = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    keyed = sums.select(
        F.col("source").isNull().cast("int").alias("none"),
        F.coalesce("source", F.lit("")).alias("name"),
        "source",
        "source_size",
    )
    ranked = stage(
        positions(keyed, ["none", "name"]).select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
            .cast("long")
            .alias("weight"),
        ),
        "weights",
    )
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, shared, limit = total, None, F.lit(max_epochs) * F.col("source_size")
    above = F.lit(False)
    while True:
        row = ranked.agg(
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(above, limit).otherwise(0)).alias("capped"),
        ).first()
        open_weight, left = row["weight"] or 0, total - (row["capped"] or 0)
        if open_weight == 0 or (shared is not None and shared == (left, open_weight)):
            break
        shared = (left, open_weight)
        # exact in integers: weight * left / open_weight > limit
        above = (F.col("weight") * F.lit(left).cast("decimal(38,0)")) >= limit * F.lit(open_weight).cast("decimal(38,0)")
    share = F.col("weight") * F.lit(left if shared else 0).cast("long") / F.lit(shared[1] if shared else 1)
    return ranked.select(
        "source", "source_size", "weight", F.when(above, limit.cast("double")).otherwise(share).alias("target")
    )


def _range_digits(rows: int) -> int:
    digits = 0
    while rows > ROWS_PER_RANGE * 16**digits and digits < MAX_DIGITS:
        digits += 1
    return digits


def mix(
    docs: DataFrame,
    columns: tuple[str, ...] = (),
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    whole_documents: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``columns`` of the row come along as the struct ``row``.

    ``size`` counts the words of ``text`` unless another column expression is given; ``taken`` is
    how many of them the mix takes, repeats counted. A source whose target is e whole passes and a
    rest gives each document e times, and once more the documents that come first in hash order
    until the rest is reached. The document at the cut gives only the words that are missing, so a
    source's sum is its target rounded down; with ``whole_documents`` it is taken whole when at
    least half of it fits.

    The order is by md5 of doc_id, then doc_id and size, so reruns agree, also after a lost
    executor. Null doc_ids sort first. Repeated rows are documents of their own, null texts have
    size 0 and give nothing, a null source is a source of its own. An empty table gives no rows.
    Further columns are ignored.
    """
    counted = word_count(F.col("text")) if size is None else size.cast("long")
    sizes = stage(
        docs.select(
            "doc_id",
            "source",
            counted.alias("size"),
            *([F.struct(*columns).alias("row")] if columns else []),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
        ),
        "sizes",
    )
    digits = _range_digits(sizes.count())
    ranged = sizes.withColumn("part", F.substring("key", 1, digits))
    parts = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sizes, weights, max_epochs)
    offsets = parts.withColumn("before_part", F.coalesce(F.sum("part_size").over(before), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.withColumn("passes", passes.cast("long")).withColumn(
        "rest", F.floor("target") - F.col("passes") * F.col("source_size")
    )
    plan = (
        offsets.alias("o")
        .join(budgets.alias("b"), F.col("o.source").eqNullSafe(F.col("b.source")))
        .select(
            F.col("o.source").alias("of"), F.col("part").alias("of_part"), "before_part", "source_size", "target", "passes", "rest"
        )
    )
    within = (
        Window.partitionBy("source", "part")
        .orderBy("key", "doc_id", "size", *(["row"] if columns else []))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = ranged.withColumn("before_row", F.coalesce(F.sum("size").over(within), F.lit(0)))
    located = ordered.join(
        plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    )
    room = F.col("rest") - F.col("before_part") - F.col("before_row")
    fits = F.greatest(F.lit(0), F.least(F.col("size"), room))
    if whole_documents:
        fits = F.when((fits > 0) & (2 * fits >= F.col("size")), F.col("size")).otherwise(0)
    return located.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + fits).cast("long").alias("taken"),
        *(["row"] if columns else []),
    )


def mixed_documents(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the documents of a mix of whole documents, a row for each time one is taken.

    Documents without words, which add nothing to a mix, are left out.
    """
    taken = mix(docs, tuple(columns), whole_documents=True).where(F.col("taken") > 0)
    times = F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int")))
    return taken.select("row", times.alias("time")).select("row.*")
