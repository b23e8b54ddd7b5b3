"""Merkle manifest of a documents table: one hash tree per language, one tree over the languages.

Trees are cut into aligned blocks of 1,024 nodes. A block is folded in one task, its top goes on to the
next tier, so a tree of n leaves takes log(n) / log(1,024) tiers of shrinking tables. What
stands above a block is the same for all its leaves: one path per block, joined back once.

The tree is persistent. A changed leaf makes a version that shares every node beside its path and
copies only the leaf's ancestors: those inside its block in the block's task, and, continued from the
block's top along the block's path, those of the upper tiers. Versions never meet in one task, so any
number of leaves may change.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators.scale import positions
from pagewright.session import stage

# levels of a block: 1,024 nodes
BLOCK_LEVELS = 10

# a tree's name as two columns that are never null, so that it can be grouped and joined by
TREE = ["none", "name"]
# entries of a path: the sibling's hash behind the side it stands on, or nothing for a lone node
LEFT, RIGHT, ALONE = "<", ">", ""


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value as ``bytes:value``, null as ``-``, so that neighbouring fields cannot run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def levels_of(hashes: list[str], first: bool, height: int) -> list[list[str]]:
    """The levels of a block of ``height`` levels above its nodes, which come first.

    Every two neighbours become one node, a lone last one too. The first block of a tree that is not
    full is the whole tree and ends at one node; any other has all its levels.
    """
    whole = first and len(hashes) < 1 << height
    levels = [hashes]
    while len(levels[-1]) > 1 or (not whole and len(levels) <= height):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def path_of(levels: list[list[str]], at: int) -> list[str]:
    """The siblings of node ``at`` of the lowest level and of its ancestors, bottom up."""
    path = []
    for below in levels[:-1]:
        other = at ^ 1
        path.append(ALONE if other >= len(below) else (LEFT if other < at else RIGHT) + below[other])
        at >>= 1
    return path


def copy_path(node: str, path: list[str]) -> list[str]:
    """New ancestors of a changed node, bottom up; all siblings are shared with the tree."""
    made = []
    for entry in path:
        node = digest(entry[1:] + node if entry.startswith(LEFT) else node + entry[1:])
        made.append(node)
    return made


def _block_tops(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, at, hash) of the blocks of ``nodes``, named by their place among the blocks."""

    def fold(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        hashes = block.sort_values("at")["hash"].tolist()
        return pd.DataFrame([(*key, levels_of(hashes, key[-1] == 0, height)[-1][0])])

    return nodes.groupBy(*TREE, "block").applyInPandas(fold, "none int, name string, at long, hash string")


def _block_paths(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, at, block, path to the block's top, top) of every node."""

    def fold(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        levels = levels_of(block["hash"].tolist(), key[-1] == 0, height)
        paths = [path_of(levels, at) for at in range(len(block))]
        return block[[*TREE, "at", "block"]].assign(path=paths, top=levels[-1][0])

    schema = "none int, name string, at long, block long, path array<string>, top string"
    return nodes.groupBy(*TREE, "block").applyInPandas(fold, schema)


def _with_block(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("at", height))


def _tower(nodes: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """All tiers above ``nodes(tree, at, hash)``: each node's path to its tree's top, and the tops."""
    tiers = []
    while True:
        tier = stage(_block_paths(_with_block(nodes, height), height), "tier")
        tiers.append(tier)
        nodes = tier.where(F.col("at") % (1 << height) == 0).select(
            *TREE, F.col("block").alias("at"), F.col("top").alias("hash")
        )
        if nodes.where("at > 0").isEmpty():
            break
    paths = tiers[-1].select(*TREE, "at", "path")
    for tier in reversed(tiers[:-1]):
        above = paths.select(*TREE, F.col("at").alias("block"), F.col("path").alias("above"))
        paths = tier.join(above, [*TREE, "block"]).select(*TREE, "at", F.concat("path", "above").alias("path"))
    return paths, nodes.select(*TREE, "hash")


def manifest(leaves: DataFrame, height: int = BLOCK_LEVELS) -> DataFrame:
    """Place, proof and version of every row of ``leaves(doc_id, lang, leaf, changed)``.

    ``leaf`` is the row's hash; ``changed`` the hash of its altered row, or null. Leaves of a language
    ascend by doc_id, null first, rows of one doc_id by their hash; languages ascend by their bytes,
    null first. The result has lang, doc_id, ``at`` (place in the language, from 0), leaf, changed,
    subroot, root, ``proof``, the path's entries from the leaf to the root, and ``version``: the nodes
    that a version with this one row changed copies, bottom up, the last its root. For a row that is
    not changed they are worked out from the leaf itself and equal the tree's. A table of one row has
    a root, its leaf, but no path and no copies. An empty table gives no rows.

    A task holds one block of 2 ** ``height`` leaves and one path. Texts do not travel.
    """
    placed = positions(leaves.select("lang", "doc_id", "leaf", "changed"), ["doc_id", "leaf"], group="lang")
    placed = stage(
        _with_block(
            placed.select(
                F.when(F.col("lang").isNull(), 0).otherwise(1).alias("none"),
                F.coalesce("lang", F.lit("")).alias("name"),
                (F.col("position") - 1).alias("at"),
                "lang",
                "doc_id",
                "leaf",
                "changed",
            ),
            height,
        ),
        "placed",
    )
    blocks = stage(_block_tops(placed.withColumnRenamed("leaf", "hash"), height), "blocks")
    paths, subroots = _tower(blocks, height)
    subroots = stage(subroots, "subroots")
    ordered = positions(subroots, TREE)
    trees = ordered.select(
        F.lit(0).alias("none"), F.lit("").alias("name"), (F.col("position") - 1).alias("at"), "hash"
    )
    tree_paths, roots = _tower(trees, height)
    named = ordered.select(*TREE, F.col("hash").alias("subroot"), (F.col("position") - 1).alias("tree")).join(
        tree_paths.select(F.col("at").alias("tree"), F.col("path").alias("above")), "tree"
    )
    # one value: there is one tree over the languages
    named = named.withColumn("root", roots.select("hash").scalar())
    above = paths.join(named, TREE).select(
        *TREE, "at", F.concat("path", "above").alias("path"), "subroot", "root"
    )

    def fold(block: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        levels = levels_of(block["leaf"].tolist(), block["block"].iat[0] == 0, height)
        outer = list(upper["path"].iat[0])
        proofs = [path_of(levels, at) + outer for at in range(len(block))]
        starts = block["changed"].where(block["changed"].notna(), block["leaf"])
        versions = [copy_path(start, proof) for start, proof in zip(starts, proofs, strict=True)]
        return block[["lang", "doc_id", "at", "leaf", "changed"]].assign(
            subroot=upper["subroot"].iat[0], root=upper["root"].iat[0], proof=proofs, version=versions
        )

    id_type = leaves.schema["doc_id"].dataType.simpleString()
    schema = (
        f"lang string, doc_id {id_type}, at long, leaf string, changed string, subroot string, root string, "
        "proof array<string>, version array<string>"
    )
    return placed.groupBy(*TREE, "block").cogroup(above.groupBy(*TREE, "at")).applyInPandas(fold, schema)


def proof_text(proof: Column) -> Column:
    """The hashes of a proof's siblings, in order."""
    return F.array_join(F.transform(proof, lambda entry: F.substring(entry, 2, 64)), "")


def root_of(leaf: Column, version: Column) -> Column:
    """The root of a version, which is the leaf itself where nothing stands above it."""
    return F.coalesce(F.try_element_at(version, F.lit(-1)), leaf)


def document_leaves(docs: DataFrame, n_chars_changed: Column) -> DataFrame:
    """(doc_id, lang, leaf, changed) of documents; ``changed`` has n_chars one higher where asked.

    Null fields count as null, not as empty; other columns take no part. Very long texts are hashed
    where they are read. The rows are written once, so texts are read once.
    """

    def hashed(n_chars: Column) -> Column:
        return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    more = hashed(F.try_add(F.col("n_chars"), F.lit(1)))
    return stage(
        docs.select(
            "doc_id",
            "lang",
            hashed(F.col("n_chars")).alias("leaf"),
            F.when(n_chars_changed, more).alias("changed"),
        ),
        "leaves",
    )
