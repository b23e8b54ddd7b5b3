"""Upserts and add-if-absent on the crawl tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.http import content_hash
from pagewright.operators.scale import positions


def absent(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``, one per key."""
    return new.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def held(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a large table whose keys occur in a small, persisted one.

    The planner knows the persisted table's size and broadcasts its keys while they are small.
    """
    return existing.join(new.select(*keys), keys, "left_semi")


def new_urls(dictionary: DataFrame, seen: DataFrame, last_id: Column) -> DataFrame:
    """(id, url) of the URLs not in the dictionary: the ids after ``last_id``, in URL order."""
    fresh = absent(seen.select("url").where("url IS NOT NULL"), dictionary, ["url"])
    return positions(fresh, ["url"]).select((F.col("position") + last_id).alias("id"), "url")


def upsert_urls(dictionary: DataFrame, seen: DataFrame) -> DataFrame:
    """Every distinct URL has one id; known URLs keep theirs."""
    added = new_urls(dictionary, seen, largest_id(dictionary))
    return dictionary.select("id", "url").unionByName(added)


def largest_id(dictionary: DataFrame) -> Column:
    return dictionary.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()


def latest_by_key(updates: DataFrame, key: str, sequence: str) -> DataFrame:
    """The row with the highest ``sequence`` per key; of equal ones that with the highest row hash.

    The winner is found on (key, sequence, hash) rows, combined before the shuffle; the payload only
    meets its own key.
    """
    payload = [name for name in updates.columns if name != key]
    place = F.struct(F.col(sequence).alias("at"), F.xxhash64(*payload).alias("hash"))
    marked = updates.withColumn("_place", place)
    last = marked.groupBy(F.col(key).alias("_key")).agg(F.max("_place").alias("_last"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_place").eqNullSafe(F.col("_last"))
    return marked.join(last, same, "left_semi").select(key, *payload).dropDuplicates([key])


def upsert_docs(current: DataFrame, updates: DataFrame, sequence: str = "seq") -> DataFrame:
    """Last write wins per document id."""
    winners = latest_by_key(updates, "id", sequence).select("id", "content", "type")
    kept = current.join(winners.select("id"), "id", "left_anti").select("id", "content", "type")
    return kept.unionByName(winners)


def insert_links(current: DataFrame, new: DataFrame) -> DataFrame:
    """All current links plus the new pairs that are not among them."""
    pair = ["source", "dest"]
    return current.select(*pair).unionByName(absent(new.select(*pair), current, pair))


def first_per_content(docs: DataFrame, content: str, order: list[str], key: str) -> DataFrame:
    """Exact content dedupe: the first row in ``order`` of each group of equal contents.

    The winner is found on (hash, order, key) rows with a map-side minimum, so a text that makes up
    a third of the table sends one row per task; the texts themselves only meet their own key.
    """
    fields = list(dict.fromkeys([*order, key]))
    first = (
        docs.select(content_hash(F.col(content)).alias("_hash"), *fields)
        .groupBy("_hash")
        .agg(F.min(F.struct(*fields)).alias("_first"))
        .select(F.col("_first")[key].alias(key))
    )
    return docs.join(first, key, "left_semi")


def lookup_documents(docs: DataFrame, urls: DataFrame, wanted: Column | DataFrame) -> DataFrame:
    """Stored documents with their URL, for one URL (a condition) or a table of URLs."""
    chosen = (
        urls.join(wanted.select("url").distinct(), "url", "left_semi")
        if isinstance(wanted, DataFrame)
        else urls.where(wanted)
    )
    return docs.join(chosen, "id").select("id", "url", "content", "type")


def by_keys(table: DataFrame, keys: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``SELECT columns WHERE key IN (keys)``."""
    wanted = keys.select(key).distinct()
    return table.join(wanted, key, "left_semi").select(*columns)
