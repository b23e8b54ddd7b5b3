"""Block-max retrieval: postings in blocks of ids; blocks that cannot reach a query's k-th score are left out.

Beside the postings there is a bounds table: per term and range of ids, how many documents hold the term
and the smallest and largest term frequency. Weights are term frequency times idf, and the idf comes with
the query's term: postings are written as they are counted, without a shuffle, only bounds are aggregated
(in the tasks first), and no idf is joined to postings. A (term, block) key has as many postings as a
block has ids, so a term found in a third of all documents is many keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.text import STOP_WORDS, index_terms
from pagewright.operators.scale import top_k_per_group
from pagewright.plans.index import SMOOTHING, inverse_document_frequency, term_counts, term_frequency
from pagewright.session import stage

BLOCK_IDS = 256
# bounds and scores are sums in different orders
SLACK = 1e-9


def block_of(id: Column, block_ids: int) -> Column:
    return F.floor((id - F.pmod(id, F.lit(block_ids))) / block_ids).cast("long")


@dataclass(frozen=True)
class BlockIndex:
    """Postings (term, block, id, tf) and bounds (term, block, n, low, high), both stored tables."""

    postings: DataFrame
    bounds: DataFrame
    block_ids: int


def block_index(counts: DataFrame, a: float, block_ids: int = BLOCK_IDS) -> BlockIndex:
    """The index of (id, term, n, max_n) counts.

    Ids are integers. Neighbouring ids that are alike, as those of URLs in order, give sharper bounds.
    """
    tf = term_frequency(F.col("n"), F.col("max_n"), a)
    rows = counts.select("term", block_of(F.col("id"), block_ids).alias("block"), "id", tf.alias("tf"))
    postings = stage(rows, "postings")
    bounds = postings.groupBy("term", "block").agg(
        F.count("*").alias("n"), F.min("tf").alias("low"), F.max("tf").alias("high")
    )
    return BlockIndex(postings, stage(bounds, "term-bounds"), block_ids)


def build_block_index(
    docs: DataFrame,
    text: str = "text",
    a: float = SMOOTHING,
    stem: bool = True,
    stop_words: list[str] | None = STOP_WORDS,
    block_ids: int = BLOCK_IDS,
) -> tuple[BlockIndex, DataFrame]:
    """Block index and idfs (term, idf) of (id, text) documents; the same weights as ``index.build_index``.

    Document frequencies are sums over the bounds; the postings are not read for them.
    """
    counts = term_counts(docs, text, lambda c: index_terms(c, stop_words), stem)
    built = block_index(counts, a, block_ids)
    frequencies = built.bounds.groupBy("term").agg(F.sum("n").alias("df"))
    idf = inverse_document_frequency(docs.count(), F.col("df"))
    return built, frequencies.select("term", idf.alias("idf"))


def dot_bounds(met: DataFrame, weights: DataFrame) -> DataFrame:
    """No document scores above the sum of its terms' largest products, negative ones left out."""
    return met.groupBy("qid", "block").agg(F.max("n").alias("n"), F.sum("most").alias("bound"))


def cosine_bounds(met: DataFrame, weights: DataFrame) -> DataFrame:
    """By Cauchy and Schwarz only the query's weights of terms that can add something count."""
    norms = weights.groupBy("qid").agg(F.sum(F.col("weight") * F.col("weight")).alias("square"))
    found = F.sum(F.when(F.col("most") > 0, F.col("weight") * F.col("weight")).otherwise(0.0))
    summed = met.groupBy("qid", "block").agg(F.max("n").alias("n"), found.alias("found"))
    bound = F.sqrt(F.try_divide(F.col("found"), F.col("square")))
    return summed.join(norms, "qid").select("qid", "block", "n", bound.alias("bound"))


BOUNDS = {"dot": dot_bounds, "cosine": cosine_bounds}


def block_bounds(index: BlockIndex, weights: DataFrame, scorer: str) -> DataFrame:
    """(qid, block, n, bound): a score that no document of the block exceeds; it holds ``n`` matches or more.

    The postings are not read.
    """
    product = F.col("weight") * F.col("idf")
    most = F.greatest(product * F.col("low"), product * F.col("high"), F.lit(0.0))
    met = index.bounds.join(weights, "term").withColumn("most", most)
    return BOUNDS[scorer](met, weights)


def leading_blocks(bounds: DataFrame, k: int) -> DataFrame:
    """(qid, block) of the blocks with the highest bounds that hold ``k`` matches together.

    Every block holds one match at least, so ``k`` blocks a query are enough to choose from.
    """
    order = [F.col("bound").desc_nulls_last(), F.col("block")]
    chosen = top_k_per_group(bounds, ["qid"], order, k, "block")
    earlier = Window.partitionBy("qid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return chosen.withColumn("_before", before).where(F.col("_before") < k).select("qid", "block")


def marked_blocks(chosen: DataFrame) -> DataFrame:
    """(qid, word, bits): the chosen (qid, block) pairs, 64 neighbouring blocks to a row."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("block", F.lit(64)).cast("int"))
    return chosen.groupBy("qid", F.shiftright("block", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def matches_in(index: BlockIndex, weights: DataFrame, chosen: DataFrame) -> DataFrame:
    """(qid, id, q, w) of the query terms in the chosen (qid, block) pairs; other postings meet nothing.

    The marks of the blocks are a stored table like the weights: while both are small the planner
    broadcasts them, and postings stay where they are. Blocks that no query chose go before terms are met.
    """
    marked = stage(marked_blocks(chosen), "marked-blocks")
    of_any = marked.groupBy("word").agg(F.bit_or("bits").alias("_any"))
    wanted = weights.select("qid", "term", "idf", F.col("weight").alias("q"))
    place = F.pmod("block", F.lit(64)).cast("int")
    postings = index.postings.withColumn("word", F.shiftright("block", 6)).join(of_any, "word")
    met = postings.where(F.getbit("_any", place) == 1).join(wanted, "term").join(marked, ["qid", "word"])
    return met.where(F.getbit("bits", place) == 1).select("qid", "id", "q", (F.col("tf") * F.col("idf")).alias("w"))


def reaching_blocks(bounds: DataFrame, leading: DataFrame, floors: DataFrame) -> DataFrame:
    """(qid, block) beyond the leading ones that may hold a score of at least the query's floor.

    A query without a floor has fewer scores than it may show, so all its blocks stay.
    """
    others = bounds.join(leading, ["qid", "block"], "left_anti").join(floors, "qid", "left")
    floor = F.col("floor")
    reaches = F.col("bound") >= floor - SLACK * (1 + F.abs(floor))
    return others.where(floor.isNull() | F.col("bound").isNull() | reaches).select("qid", "block")


def with_block_ranks(bounds: DataFrame, ranks: DataFrame, block_ids: int) -> DataFrame:
    """Bounds for scores to which the document's rank is added; blocks without a ranked document go."""
    highest = ranks.groupBy(block_of(F.col("id"), block_ids).alias("block")).agg(F.max("rank").alias("_pr"))
    bound = (F.col("bound") + F.col("_pr")).alias("bound")
    return bounds.join(highest, "block").select("qid", "block", "n", bound)
