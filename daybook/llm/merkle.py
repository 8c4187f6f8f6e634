"""A Merkle manifest of a table, with a proof for every row.

Rows are leaves. The leaves of a group, in order, are hashed two by two until one digest
is left; the groups' digests are hashed likewise into the root. A leaf's proof is the
digests beside its path to the root: whoever holds a row, its proof and the root can
tell that the row belongs to the table as it was.

Proofs come by pointer jumping. At first every node points to its parent and holds the
digest beside it. A join of the nodes with themselves then gives each one what the node
it points to holds, and that node's pointer: the distance to the ancestor doubles each
time, and the segments of the proof are concatenated. As only the leaves need the way to
the top, only nodes at multiples of the distance go on to the next round.

All of it is joins and array functions. Leaves are numbered by a range partitioning, so
no task holds a group; nodes are hashed in aligned chunks of ``CHUNK``, a fixed number
of levels at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.names import col
from daybook.operators.joins import join_per_key
from daybook.sources.scratch import saved, scratch_folder

LEVELS = 8
CHUNK = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_LOCAL_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def _no_path() -> Column:
    return F.array().cast("array<binary>")


def row_digest(*values: Column) -> Column:
    """SHA-256 over the values as texts, each ``-`` if null, else its UTF-8 length, a colon and itself."""
    parts = []
    for value in values:
        text = value.cast("string")
        length = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, group: str, order: list[str], folder: str) -> DataFrame:
    """The rows with ``tree`` (a number for the group), ``i`` (from 0 in ``order``) and ``n`` (rows of the group).

    ``order`` has to tell all rows apart, so that a hot group is cut anywhere.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = saved(placed.withColumn("place", F.monotonically_increasing_id()), f"{folder}/placed")
    part = F.shiftright("place", _LOCAL_BITS)
    placed = placed.withColumn("part", part)
    # A row per partition and group: partitions follow the groups' order.
    counts = placed.groupBy("part", group).agg(F.min("place").alias("first"), F.count("*").alias("here"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = saved(
        counts.select(
            F.col("part").alias("of_part"),
            F.col(group).alias("of_group"),
            "first",
            F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
            F.sum("here").over(whole).alias("n"),
            F.min("first").over(whole).alias("tree"),
        ),
        f"{folder}/counts",
    )
    same = (F.col("part") == F.col("of_part")) & F.col(group).eqNullSafe(F.col("of_group"))
    i = (F.col("place") - F.col("first") + F.col("before")).alias("i")
    return placed.join(counts, same).select(*rows.columns, "tree", i, "n")


def _pair_digests(below: str) -> Column:
    """The next level of an array of digests: two by two, the last one alone if it has no other."""
    at = lambda k: F.get(F.col(below), k)
    pairs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda k: F.sha2(F.concat(at(2 * k), F.coalesce(at(2 * k + 1), F.lit(""))), 256))


def _beside(digests: str, k: Column) -> Column:
    return F.unhex(F.get(F.col(digests), k.bitwiseXOR(F.lit(1))))


def _nodes(j: int, base: int) -> Column:
    """The j-th level of a chunk as nodes, none where it is the tree's root or above."""

    def node(_: Column, k: Column) -> Column:
        place = (F.shiftleft("chunk", LEVELS - j) + k).alias("i")
        return F.struct(F.lit(base + j).alias("level"), place, _beside(f"l{j}", k).alias("beside"))

    nodes = F.when(F.col(f"l{j + 1}").isNotNull(), F.transform(F.col(f"l{j}"), node))
    return F.coalesce(nodes, F.array().cast("array<struct<level:int,i:bigint,beside:binary>>"))


def _hashed(leaves: DataFrame, payload: list[str], folder: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Trees over ``tree, i, n, digest`` and a payload.

    Gives the leaves ``tree, i, digest, payload, path``, the inner nodes ``tree, level, i,
    path`` (a path holds the one digest beside, as bytes, null if the node is alone), the
    roots ``tree, root``, and the greatest number of levels.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    depth = max(0, most - 1).bit_length()
    inner, roots, base = [], [], 0
    now, kept = leaves, ["i", "digest", *payload]
    while True:
        items = F.array_sort(F.collect_list(F.struct(*kept))).alias("items")
        rows = now.groupBy("tree", "n", F.shiftright("i", LEVELS).alias("chunk")).agg(items)
        rows = rows.withColumn("l0", F.col("items.digest"))
        for j in range(LEVELS):
            # A tree of one chunk ends where one node is left; the others go on for all levels.
            goes_on = (F.col("n") > CHUNK) | (F.size(f"l{j}") > 1)
            rows = rows.withColumn(f"l{j + 1}", F.when(goes_on, _pair_digests(f"l{j}")))
        rows = saved(rows, f"{folder}/chunks-{base}")
        if base == 0:
            alone = F.col("l1").isNull()
            path = F.when(alone, _no_path()).otherwise(F.array(_beside("l0", F.col("at")))).alias("path")
            opened = rows.select("tree", "l0", "l1", F.posexplode("items").alias("at", "item"))
            leaf_rows = opened.select("tree", *[F.col(f"item.{c}").alias(c) for c in kept], path)
        levels = F.concat(*[_nodes(j, base) for j in range(int(base == 0), LEVELS)])
        inner.append(rows.select("tree", F.explode(levels).alias("node")).select("tree", "node.*"))
        top = F.coalesce(*[F.col(f"l{j}") for j in range(LEVELS, -1, -1)])
        roots.append(rows.where(F.col("n") <= CHUNK).select("tree", F.get(top, F.lit(0)).alias("root")))
        most = -(-most // CHUNK)
        if most <= 1:
            break
        now = rows.where(F.col("n") > CHUNK).select(
            "tree",
            F.col("chunk").alias("i"),
            F.ceil(F.col("n") / CHUNK).alias("n"),
            F.get(f"l{LEVELS}", F.lit(0)).alias("digest"),
        )
        base, kept = base + LEVELS, ["i", "digest"]
    nodes = reduce(DataFrame.unionAll, inner).select("tree", "level", "i", F.array("beside").alias("path"))
    return leaf_rows, nodes, reduce(DataFrame.unionAll, roots), depth


def _jump(nodes: DataFrame, ahead: DataFrame, hop: int) -> DataFrame:
    """Each node with what the node ``hop`` levels up holds; those near the top keep what they have."""
    target = ahead.toDF("of_tree", "of_level", "of_i", "more")
    same = (F.col("tree") == F.col("of_tree")) & (F.col("level") + hop == F.col("of_level"))
    same &= F.shiftright("i", hop) == F.col("of_i")
    path = F.concat("path", F.coalesce("more", _no_path())).alias("path")
    return nodes.join(target, same, "left").select(*[c for c in nodes.columns if c != "path"], path)


def _paths(leaves: DataFrame, nodes: DataFrame, depth: int, folder: str) -> DataFrame:
    """Pointer jumping: the leaves with all digests beside their way up, the lowest first."""
    leaves, hop = leaves.withColumn("level", F.lit(0)), 1
    while hop < depth:
        ahead = nodes.where(F.col("level") % (2 * hop) == hop)
        leaves = _jump(leaves, ahead.where(F.col("level") == hop), hop)
        if 2 * hop < depth:
            staying = nodes.where(F.col("level") % (2 * hop) == 0)
            nodes = saved(_jump(staying, ahead, hop).select(*nodes.columns), f"{folder}/jumped-{hop}")
        hop *= 2
    return leaves.drop("level")


def _sided(path: str, i: str) -> Column:
    """The path's digests, each with whether it stands to the left: the place's bits say so."""

    def entry(digest: Column, level: Column) -> Column:
        left = F.call_function("shiftright", F.col(i), level) % 2 == 1
        return F.struct(digest.alias("digest"), left.alias("left"))

    return F.transform(F.col(path), entry)


def _trees(
    rows: DataFrame, group: str, order: list[str], payload: list[str], folder: str
) -> tuple[DataFrame, DataFrame]:
    """Leaves ``tree, i, digest, payload, path`` with their whole way up, and ``tree, root``."""
    numbered = _numbered(rows, group, order, folder)
    leaves, nodes, roots, depth = _hashed(numbered, payload, folder)
    return _paths(leaves, nodes, depth, folder), roots


def folded(path: Column, presented: Column) -> Column:
    """The root that a leaf's digest and its path give."""

    def up(below: Column, beside: Column) -> Column:
        other = F.lower(F.hex(beside["digest"]))
        both = F.when(other.isNull(), below).when(beside["left"], F.concat(other, below))
        return F.sha2(both.otherwise(F.concat(below, other)), 256)

    return F.aggregate(path, presented, up)


def merkle_manifest(
    docs: DataFrame,
    group_col: str = "lang",
    id_col: str = "doc_id",
    fields: tuple[str, ...] = FIELDS,
    presented: Column | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof, folded_root, verified``.

    A leaf is the :func:`row_digest` of ``fields``. Leaves of a group ascend by id (null
    first, ties by digest), groups by their bytes (null first). ``proof`` lists the
    digests beside the way to the root, the lowest first, each with ``left``; where a
    node stands alone, ``digest`` is null. ``presented`` is the digest of the row as
    somebody hands it in, the leaf itself where it is null or not given: ``folded_root``
    is what it and the proof give, ``verified`` whether that is the root.

    Nulls are values of their own, an empty text differs from a null one, and repeated
    rows are leaves each. A lone leaf is its group's digest, a lone group's digest the
    root; their way up has no entry. An empty table gives no rows.
    """
    folder = scratch_folder(docs.sparkSession)
    given = F.lit(None).cast("string") if presented is None else presented
    rows = saved(
        docs.select(
            col(id_col).alias("doc_id"),
            col(group_col).alias("group"),
            row_digest(*[col(c) for c in fields]).alias("digest"),
            given.alias("presented"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        f"{folder}/rows",
    )
    order = ["doc_id", "digest", "row_id"]
    leaves, subroots = _trees(rows, "group", order, ["doc_id", "presented"], f"{folder}/groups")
    subroots = saved(subroots, f"{folder}/subroots")
    # Trees are numbered in the order of their groups.
    tops = subroots.select(F.lit(0).alias("all"), F.col("tree").alias("of"), F.col("root").alias("digest"))
    tops, root = _trees(tops, "all", ["of"], ["of"], f"{folder}/top")
    above = tops.join(root, "tree").select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"), "root", _sided("path", "i").alias("above")
    )
    above = saved(above, f"{folder}/above")
    proved = join_per_key(leaves, above, ["tree"], "inner").select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.concat(_sided("path", "i"), "above").alias("proof"),
        F.coalesce("presented", "digest").alias("presented"),
    )
    proved = proved.withColumn("folded_root", folded(F.col("proof"), F.col("presented"))).drop("presented")
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
