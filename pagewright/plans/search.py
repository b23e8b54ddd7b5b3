"""Batch search: TF-IDF retrieval, blending with PageRank, match bonuses, result pages.

Many queries are answered by one plan. Everything after retrieval works on at most ``k`` rows per
query, and the terms of a query travel inside its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.counts import exploded_counts
from pagewright.functions.exprs import bind, blank_if_null
from pagewright.functions.similarity import longest_common_subsequence
from pagewright.functions.stem import stem_all
from pagewright.functions.text import query_terms, raw_terms, typed_terms
from pagewright.functions.url import authority
from pagewright.operators.gates import truncated
from pagewright.operators.scale import top_k_per_group
from pagewright.plans import blocks
from pagewright.plans.blocks import BlockIndex
from pagewright.session import stage

CANDIDATES = 2000
EARLY_CANDIDATES = 100
PAGE_SIZE = 10
TIE_DIGITS = 12

# Blend factor and rank floor, then the bonuses per field.
RANK_FACTOR = 0.013
RANK_FLOOR = 0.1
MISSING_RANK = 0.00001
EXACT_BONUS = {"title": 0.01, "headers": 0.005}
STEM_BONUS = {"title": 0.003, "headers": 0.003}
STRICT_STEM_BONUS = {"title": 0.003, "headers": 0.0015}
SEQUENCE_BONUS = {"title": 0.06, "headers": 0.03}
CONTAINS_BONUS = {"title": 0.04, "headers": 0.02, "preview": 0.04}
SEQUENCE_THRESHOLD = 0.9
CARD_LENGTHS = {"url": 110, "title": 70, "preview": 600}


def query_counts(
    queries: DataFrame, stem: bool = True, tokenizer: Callable[[Column], Column] = query_terms
) -> DataFrame:
    """(qid, term, n, max_n): term counts of each query and the largest one."""
    return exploded_counts(queries, "qid", [tokenizer(F.col("query"))], (1,), stem)


def query_weights(counts: DataFrame, idfs: DataFrame) -> DataFrame:
    """(qid, term, idf, weight) of the query terms that have an idf.

    A small table, written once: retrieval, norms and bonuses all read it. The idfs of other terms are
    left out before they are worked out.
    """
    weight = 0.5 + 0.5 * F.col("n") / F.col("max_n") * F.col("idf")
    counts = stage(counts, "query-counts")
    asked = idfs.select("term", "idf").join(counts.select("term"), "term", "left_semi")
    found = counts.join(asked, "term")
    return stage(found.select("qid", "term", "idf", weight.alias("weight")), "query-weights")


def matching_postings(index: DataFrame, weights: DataFrame) -> DataFrame:
    """(qid, id, q, w): one row per query term a document holds.

    ``weights`` is a stored table, so the planner broadcasts it by the size of its files while that is
    small and only scans the postings. Beyond that both sides are shuffled by term, reduced by a
    runtime filter, and the partitions of very frequent terms are split. Postings of other terms are left
    out first, which the planner does before an index that is not stored joins its idfs.
    """
    met = index.join(weights.select("term"), "term", "left_semi")
    postings = met.select("term", "id", F.col("weight").alias("w"))
    wanted = weights.select("term", "qid", F.col("weight").alias("q"))
    return postings.join(wanted, "term").select("qid", "id", "q", "w")


def dot_of(matches: DataFrame, weights: DataFrame) -> DataFrame:
    return matches.groupBy("qid", "id").agg(F.sum(F.col("q") * F.col("w")).alias("score"))


def cosine_of(matches: DataFrame, weights: DataFrame) -> DataFrame:
    norms = weights.groupBy("qid").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("query_norm")
    )
    sums = matches.groupBy("qid", "id").agg(
        F.sum(F.col("q") * F.col("w")).alias("dot"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("doc_norm"),
    )
    return sums.join(norms, "qid").select(
        "qid",
        "id",
        F.try_divide(F.col("dot"), F.col("query_norm") * F.col("doc_norm")).alias("score"),
    )


SCORERS = {"dot": dot_of, "cosine": cosine_of}


def dot_scores(index: DataFrame, weights: DataFrame) -> DataFrame:
    return dot_of(matching_postings(index, weights), weights)


def cosine_scores(index: DataFrame, weights: DataFrame) -> DataFrame:
    """Cosine over the query terms; NULL when either vector is zero."""
    return cosine_of(matching_postings(index, weights), weights)


def by_score(column: str = "score") -> list[Column]:
    """Best first, undefined scores last, ties by id.

    Documents that match the same single term have the same cosine up to the last bits, which depend
    on the order of a distributed sum; rounding makes them the ties they are.
    """
    return [F.round(column, TIE_DIGITS).desc_nulls_last(), F.col("id")]


def top_scores(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents per query."""
    order = by_score()
    return top_k_per_group(scores, ["qid"], order, k, "id")


def best(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of one query's scores."""
    return scores.orderBy(*by_score()).limit(k)


def retrieve(
    index: DataFrame | BlockIndex,
    weights: DataFrame,
    k: int,
    scorer: str = "cosine",
    ranks: DataFrame | None = None,
) -> DataFrame:
    """(qid, id, score, rank) of the ``k`` best documents per query.

    ``index`` is a block index (``blocks.build_block_index``) or a plain inverted index, of which all
    matching postings are read. Of a block index, the blocks with the highest bounds are scored first;
    their k-th score is the floor that any other block must be able to reach to be scored at all.
    """
    score = SCORERS[scorer]

    def scored(matches: DataFrame) -> DataFrame:
        scores = score(matches, weights)
        return scores if ranks is None else with_document_rank(scores, ranks)

    if not isinstance(index, BlockIndex):
        return top_scores(scored(matching_postings(index, weights)), k)
    bounds = blocks.block_bounds(index, weights, scorer)
    if ranks is not None:
        bounds = blocks.with_block_ranks(bounds, ranks, index.block_ids)
    bounds = stage(bounds, "block-bounds")
    leading = stage(blocks.leading_blocks(bounds, k), "leading-blocks")
    first = stage(top_scores(scored(blocks.matches_in(index, weights, leading)), k), "first-scores")
    floors = first.where(F.col("rank") == k).select("qid", F.col("score").alias("floor"))
    others = blocks.reaching_blocks(bounds, leading, floors)
    more = scored(blocks.matches_in(index, weights, others))
    return top_scores(first.drop("rank").unionByName(more), k)


def search_scored(
    queries: DataFrame,
    index: DataFrame | BlockIndex,
    idfs: DataFrame,
    k: int = CANDIDATES,
    scorer: str = "cosine",
    stem: bool = True,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """(qid, id, score, rank) by cosine or dot product.

    With ``ranks`` (id, rank) the PageRank of the document is added; unranked documents drop out.
    """
    weights = query_weights(query_counts(queries, stem), idfs)
    return retrieve(index, weights, k, scorer, ranks)


def with_document_rank(scores: DataFrame, ranks: DataFrame) -> DataFrame:
    """score + rank per document id; inner, as only ranked documents are shown."""
    return scores.join(ranks.select("id", F.col("rank").alias("_pr")), "id").select(
        "qid", "id", (F.col("score") + F.col("_pr")).alias("score")
    )


def rank_signal(rank: Column) -> Column:
    """ln of the rank with a floor; a missing rank counts as the floor."""
    return F.log(F.greatest(F.coalesce(rank, F.lit(MISSING_RANK)), F.lit(RANK_FLOOR)))


def blended_score(cosine: Column, rank: Column) -> Column:
    return RANK_FACTOR * rank_signal(rank) + (1 - RANK_FACTOR) * cosine


def enrich(
    candidates: DataFrame, urls: DataFrame, content: DataFrame, ranks: DataFrame
) -> DataFrame:
    """Add url, title, preview, headers and domain rank to (qid, id, score) rows.

    Content and rank may be missing. The large tables are first reduced to the candidates' keys.
    Candidates without a URL have no domain.
    """
    ids = candidates.select("id").distinct()
    their_urls = urls.select("id", "url").join(ids, "id", "left_semi")
    fields = content.select(
        "id",
        F.col("title"),
        F.col("content").alias("preview"),
        F.col("headers"),
        F.lit(True).alias("has_content"),
    ).join(ids, "id", "left_semi")
    return (
        candidates.join(their_urls, "id", "left")
        .join(fields, "id", "left")
        .withColumn("domain", F.when(F.col("url") != "", authority(F.col("url"))))
        .join(ranks.select("domain", F.col("rank").alias("domain_rank")), "domain", "left")
    )


def with_fallback(rows: DataFrame) -> DataFrame:
    """Rows without content show their URL as title and have no headers or preview."""
    return (
        rows.withColumn("has_content", F.coalesce("has_content", F.lit(False)))
        .withColumn("title", F.when(F.col("has_content"), blank_if_null(F.col("title"))).otherwise(F.col("url")))
        .withColumn("preview", blank_if_null(F.col("preview")))
        .withColumn("headers", blank_if_null(F.col("headers")))
    )


def term_bonus(
    field: str, text: Column, terms: Column, stems: Column, idf: Column, strict: bool = False
) -> Column:
    """Per query term (duplicates count): exact match, else a stem bonus times the term's idf.

    Case is ignored for the exact match only; stem and idf are those of the term as it is given.

    Headers earn the stem bonus whether or not the stem occurs, unless ``strict``.
    """
    stem_weight = (STRICT_STEM_BONUS if strict else STEM_BONUS)[field]
    tested = strict or field == "title"

    def one(words: Column, stemmed_words: Column, term: Column, stem: Column) -> Column:
        stem_bonus = stem_weight * F.coalesce(F.try_element_at(idf, term), F.lit(1.0))
        met = F.array_contains(stemmed_words, stem) if tested else F.lit(True)
        return (
            F.when(F.array_contains(words, F.lower(term)), EXACT_BONUS[field])
            .when(met, stem_bonus)
            .otherwise(0.0)
        )

    words = raw_terms(text)
    # a Python expression cannot sit inside a lambda, so words and stems are bound side by side
    both = F.struct(words.alias("words"), (stem_all(words) if tested else words).alias("stems"))
    return bind(
        both,
        lambda page: F.aggregate(
            F.zip_with(terms, stems, lambda t, s: one(page["words"], page["stems"], t, s)),
            F.lit(0.0),
            lambda acc, earned: acc + earned,
        ),
    )


def sequence_bonus(field: str, text: Column, query: Column) -> Column:
    """Query and field share a subsequence of at least 90 % of the query.

    Texts too short to reach that are not sent to the subsequence function.
    """
    long_enough = F.length(text) >= SEQUENCE_THRESHOLD * F.length(query)
    shared = longest_common_subsequence(query, F.when(long_enough, F.lower(text)))
    ratio = F.try_divide(shared.cast("double"), F.length(query))
    earned = F.log(F.length(query)) * SEQUENCE_BONUS[field] * ratio
    return F.when(ratio >= SEQUENCE_THRESHOLD, earned).otherwise(0.0)


def contains_bonus(field: str, text: Column, query: Column) -> Column:
    earned = F.log(F.length(query)) * CONTAINS_BONUS[field]
    return F.when(F.contains(F.lower(text), query), earned).otherwise(0.0)


def bonus(
    title: Column,
    headers: Column,
    preview: Column,
    query: Column,
    terms: Column,
    stems: Column,
    idf: Column,
    strict: bool = False,
) -> Column:
    """All match bonuses of a page for a query; an empty field earns nothing."""
    query = F.lower(query)
    total = F.lit(0.0)
    for field, text in (("title", title), ("headers", headers)):
        earned = (
            term_bonus(field, text, terms, stems, idf, strict)
            + sequence_bonus(field, text, query)
            + contains_bonus(field, text, query)
        )
        total = total + F.when(text != "", earned).otherwise(0.0)
    return total + F.when(preview != "", contains_bonus("preview", preview, query)).otherwise(0.0)


def query_details(queries: DataFrame, weights: DataFrame, lower: bool = False) -> DataFrame:
    """Per query: terms as typed with their stems, and a map from matched term to idf.

    With ``lower`` terms are lower-cased first, so that capitals in a query change nothing.
    """
    found = weights.groupBy("qid").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "idf"))).alias("idf_of")
    )
    terms = queries.select("qid", "query", (raw_terms if lower else typed_terms)(F.col("query")).alias("terms"))
    return terms.select("*", stem_all(F.col("terms")).alias("stems")).join(found, "qid")


def rescore(pages: DataFrame, details: DataFrame, strict: bool = False) -> DataFrame:
    """Add the bonuses to ``score`` of (qid, title, preview, headers, score) rows."""
    rows = pages.join(details, "qid")
    added = bonus(
        F.col("title"), F.col("headers"), F.col("preview"), F.col("query"),
        F.col("terms"), F.col("stems"), F.col("idf_of"), strict,
    )
    return rows.withColumn("score", F.col("score") + added).select(*pages.columns)


def without_repeats(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Keep the first row per query of pages with the same non-empty title and preview.

    Copies are cut where they are before the shuffle, so a group of any size sends one row a task.
    """
    comparable = F.coalesce((F.col("title") != "") & (F.col("preview") != ""), F.lit(False))
    # a page that cannot be compared is a group of its own
    own = F.when(~comparable, F.col("id"))
    same = Window.partitionBy("qid", "title", "preview", own).orderBy(*order)
    return rows.withColumn("_copy", F.row_number().over(same)).where(F.col("_copy") == 1).drop("_copy")


def final_order(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "rank", F.row_number().over(Window.partitionBy("qid").orderBy(*by_score()))
    )


def search(
    queries: DataFrame,
    index: DataFrame | BlockIndex,
    idfs: DataFrame,
    urls: DataFrame,
    content: DataFrame,
    ranks: DataFrame,
    k: int = CANDIDATES,
    stem: bool = True,
    strict: bool = False,
    lower: bool = False,
) -> DataFrame:
    """Ranked results (qid, id, url, title, preview, headers, score, rank) of a batch of queries.

    The candidates (``k`` per query) are written once; all later steps read those few rows.
    """
    weights = query_weights(query_counts(queries, stem), idfs)
    scores = retrieve(index, weights, k)
    candidates = stage(scores.select("qid", "id", F.col("score").alias("cosine")), "candidates")
    rows = with_fallback(enrich(candidates, urls, content, ranks)).withColumn(
        "score", blended_score(F.col("cosine"), F.col("domain_rank"))
    )
    # pages without content keep their base score: for the bonuses their title is empty
    pages = rows.withColumnRenamed("title", "shown").withColumn(
        "title", F.when(F.col("has_content"), F.col("shown")).otherwise("")
    )
    scored = rescore(pages, query_details(queries, weights, lower), strict)
    shown = scored.drop("title").withColumnRenamed("shown", "title")
    kept = without_repeats(shown, by_score("cosine"))
    return final_order(kept).select(
        "qid", "id", "url", "title", "preview", "headers", "score", "rank"
    )


def result_cards(results: DataFrame) -> DataFrame:
    """Results as shown in a list: long fields cut."""
    return results.select(
        "qid", "rank", *[truncated(F.col(c), n).alias(c) for c, n in CARD_LENGTHS.items()]
    )


def result_page(results: DataFrame, page: int, size: int = PAGE_SIZE) -> DataFrame:
    """One 1-based page of every query's ranked results."""
    return results.where(F.col("rank").between((page - 1) * size + 1, page * size))


def page_counts(results: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return results.groupBy("qid").agg(
        F.ceil(F.count("*") / size).cast("long").alias("total_pages")
    )


def as_json(results: DataFrame) -> DataFrame:
    """One JSON object per result, in rank order within a query."""
    return results.select(
        "qid", "rank", F.to_json(F.struct("url", "title", "preview", "headers", "score")).alias("json")
    )
