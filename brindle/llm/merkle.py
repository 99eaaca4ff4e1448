"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots, a proof for every row.

Nodes are hashed level by level. Conditional aggregates over the nodes of one parent spread its children
into ``fanout`` columns, one for each slot: the columns joined in order are what the parent hashes, and
without a node's own slot they are its siblings.

Levels are taken in tiers. A tier deals the nodes of a tree out in blocks of ``fanout ** levels`` neighbours, so one
shuffle serves all levels of the tier and no task needs more than a block at once, however
large a source is. The block's root is one node of the next tier. On the way back each tier joins the
path above its blocks, so a row of the leaves meets one join in all.

Positions come from a range sort: rows are counted per task and source, and running sums of these counts, at
most one per task and source, turn a place inside a task into a place inside the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.tables import measured, number
from brindle.scratch import materialize

BLOCK_NODES = 1_000  # at most so many nodes in a block
PATH = "array<struct<before string, after string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated; NULL parts count as empty."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf(*fields: Column) -> Column:
    """Digest of a row's fields: ``-`` for NULL, else the value's length in UTF-8 bytes, a colon and the value as text."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.when(field.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return digest(*map(written, fields))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, start, lambda node, level: digest(level["before"], node, level["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf to the root and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), ""), 256)


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (_tree, *order, ...) with the _index of each in its tree and the tree's _count. Rows that agree in the order are taken as stored."""
    stored = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), "tree-rows")
    keys = ["_tree", *order, "_tie"]
    return number(stored.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie"), "_tree", "_index", "_count")


def _tier(nodes: DataFrame, most: int, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (_tree, _index, _count, _hash, ...) with their _block, the _path inside it and the block's root in _hash."""
    size = fanout**levels
    widths = [fanout**i for i in range(levels) if fanout**i < most]
    tier = nodes.withColumn("_block", F.expr(f"_index div {size}")).withColumn("_path", F.array().cast(PATH))
    columns = tier.columns
    # The parents of a level are named by all levels above them, so one sort by these names orders the rows for every level.
    parents = [f"_parent{i}" for i in range(len(widths))]
    tier = tier.select("*", *[F.expr(f"_index div {w * fanout}").alias(name) for w, name in zip(widths, parents)])
    tier = tier.repartition("_tree", "_block").sortWithinPartitions("_tree", "_block", *reversed(parents))
    for i, width in enumerate(widths):
        slot = F.expr(f"_index div {width} % {fanout}")
        parent = Window.partitionBy("_tree", "_block", *reversed(parents[i:]))
        slots = [f"_slot{j}" for j in range(fanout)]
        spread = [F.max(F.when(slot == j, F.col("_hash"))).over(parent).alias(name) for j, name in enumerate(slots)]
        tier = tier.select(*columns, *parents[i:], *spread)
        before = F.concat_ws("", *[F.when(slot > j, F.col(name)) for j, name in enumerate(slots)])
        after = F.concat_ws("", *[F.when(slot < j, F.col(name)) for j, name in enumerate(slots)])
        # A tree whose nodes are down to one at this level is done.
        grows = F.col("_count") > width
        step = F.concat("_path", F.array(F.struct(before.alias("before"), after.alias("after"))).cast(PATH))
        new = {"_path": F.when(grows, step).otherwise(F.col("_path")), "_hash": F.when(grows, digest(*map(F.col, slots))).otherwise(F.col("_hash"))}
        tier = tier.select(*[new[c].alias(c) if c in new else c for c in columns], *parents[i + 1 :])
    return materialize(tier, "tier")


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers from ``nodes`` up, and the roots: one row (_tree, _index 0, _hash) for each tree."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK_NODES:
        levels += 1
    size = fanout**levels
    tiers = []
    while (most := nodes.agg(F.max("_count")).first()[0] or 0) > 1:
        tiers.append(_tier(nodes, most, fanout, levels))
        tops = tiers[-1].where(F.col("_index") % size == 0)
        nodes = tops.select("_tree", F.col("_block").alias("_index"), F.expr(f"(_count + {size - 1}) div {size}").alias("_count"), "_hash")
    return tiers, nodes


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first tier with whole paths; ``above`` (_tree, _index, _path, ...) has the paths from the roots on."""
    for i, tier in reversed(list(enumerate(tiers))):
        upper = above.select("_tree", F.col("_index").alias("_block"), F.col("_path").alias("_upper"), *[c for c in above.columns if c not in ("_tree", "_index", "_path")])
        joined = tier.join(measured(upper), ["_tree", "_block"]).withColumn("_path", F.concat("_path", "_upper")).drop("_block", "_upper", "_hash", "_count")
        above = materialize(joined, "paths") if i else joined
    return above


def manifest(rows: DataFrame, fields: Sequence[str], source: str, key: str, keep: Sequence[str] = (), fanout: int = 3) -> DataFrame:
    """One row per row: ``key``, ``source``, the columns in ``keep``, leaf, subroot, root and path.

    A leaf is the digest of ``fields``. Leaves of one source ascend by ``key`` (NULL first); while several nodes remain,
    every ``fanout`` consecutive ones, the last run fewer or even one, become their digest; what remains is the source's
    subroot. Subroots, by source (NULL first, then bytewise), become the root in the same way. ``path`` has for each
    level the siblings ``before`` and ``after`` the node, both empty for a run of one; ``fold`` gets the root from it.

    A NULL source is a source of its own, apart from an empty one; any field may be NULL or empty. Repeated keys are ordered by
    leaf, and rows that agree in both are interchangeable. A text needs memory for a few copies of itself in one task.
    An empty table gives an empty result. Columns that are not named are ignored, whatever their names.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    # "" sorts before "+...", so a NULL source comes first.
    tree = F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))
    wanted = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    leaves = rows.select(tree.alias("_tree"), F.col(key).alias("_key"), leaf(*map(F.col, fields)).alias("_hash"), F.col(source).alias("_source"), *wanted)
    leaves = _ranked(leaves, ["_key", "_hash"]).withColumn("_leaf", F.col("_hash"))
    tiers, subroots = _climb(leaves, fanout)
    subroots = materialize(subroots.select("_tree", F.col("_hash").alias("_subroot")), "subroots")

    tops = subroots.select(F.lit("").alias("_tree"), F.col("_tree").alias("_name"), F.col("_subroot").alias("_hash"))
    tops = materialize(_ranked(tops, ["_name"]).withColumn("_subroot", F.col("_hash")), "tops")
    top_tiers, root = _climb(tops, fanout)
    found = root.first()
    root = F.lit(found["_hash"] if found else None).cast("string")
    no_path = F.array().cast(PATH)
    if top_tiers:
        one = tops.sparkSession.range(1).select(F.lit("").alias("_tree"), F.lit(0).cast("long").alias("_index"), no_path.alias("_path"))
        tops = _descend(top_tiers, one)
    else:
        tops = tops.withColumn("_path", no_path)
    above = tops.select(F.col("_name").alias("_tree"), F.lit(0).cast("long").alias("_index"), "_path", "_subroot")
    if tiers:
        result = _descend(tiers, materialize(above, "paths"))
    else:
        result = leaves.join(above, ["_tree", "_index"])
    kept = [F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)]
    return result.select(
        F.col("_key").alias(key), F.col("_source").alias(source), *kept, F.col("_leaf").alias("leaf"), F.col("_subroot").alias("subroot"),
        root.alias("root"), F.col("_path").alias("path"),
    )
