"""Merkle manifest of a dataset: one tree for each group, and one over the group roots.

Leaves are hashes of whole rows, ordered by id inside their group; every two consecutive nodes become the hash
of their digests (the last one of an odd level alone). Only every `STRIDE`-th level is stored. A proof needs
the levels between as well: they are made again from the stored descendants, one aligned block of at most
2^STRIDE nodes at a time, their siblings are handed to the rows below, and they are gone with the row that held
them. So what is kept beside the leaves is about 1/2^STRIDE of their number, at any height of the tree.

Positions come from a range sort: each task numbers its own rows, and a small table with the rows of each group
in each task gives the offset of each. Blocks are keys of their own, so that a group with most of the rows is
spread like any other. No step brings more than one block of nodes together.

Defined results: nulls in any column are told from empty texts; a null group is a group of its own and comes
first; null ids come first in their group. Repeated ids are ordered by their leaf, repeated rows have equal leaves
and a place each. An empty table has no rows and no root. Other columns are ignored; ids are returned under their
own name, whatever it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, stored

STRIDE = 5
_TASK_BITS = 33  # monotonically_increasing_id: task number above, row number in the task below


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and its text; a null as a dash."""
    return F.sha2(F.concat(*(_spelled(c.cast("string")) for c in columns)), 256)


def _spelled(text: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _key(group: Column) -> Column:
    """Group as a text that is never null and sorts bytewise, null first."""
    return F.coalesce(F.concat(F.lit("v"), group.cast("string")), F.lit("n"))


def _above(nodes: Column) -> Column:
    """The level over a level, both as arrays of digests."""
    places = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(
        places, lambda i: F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256)
    )


def _steps(n: Column, most: int) -> Column:
    """The numbers 1 to n, for n of at most `most`; none for n = 0."""
    return F.filter(F.array(*(F.lit(i) for i in range(1, most + 1))), lambda i: i <= n)


def _folded(nodes: Column, levels: Column) -> Column:
    """The node that stands `levels` levels over a block."""
    return F.get(F.aggregate(_steps(levels, STRIDE), nodes, lambda level, _: _above(level)), F.lit(0))


def _regrown(nodes: Column, levels: Column) -> Column:
    """A block's level and those over it, up to the one below its top; none if the block is its own top."""
    grown = F.aggregate(
        _steps(levels - 1, STRIDE - 1), F.array(nodes), lambda got, _: F.concat(got, F.array(_above(F.element_at(got, -1))))
    )
    return F.when(levels > 0, grown).otherwise(F.slice(grown, 1, 0))


def _siblings(levels: Column, place: Column) -> Column:
    """For each level, what stands beside the node over `place`: (left, right), empty where nothing does."""

    def beside(level: Column, i: Column) -> Column:
        at = F.call_function("shiftright", place, i)
        odd = at % 2 == 1
        return F.struct(
            F.when(odd, F.get(level, at - 1)).otherwise("").alias("left"),
            F.when(odd, "").otherwise(F.coalesce(F.get(level, at + 1), F.lit(""))).alias("right"),
        )

    return F.transform(levels, beside)


def refold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to with the siblings of `path`."""
    return F.aggregate(path, digest, lambda got, p: F.sha2(F.concat(p["left"], got, p["right"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, lowest level first."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


@dataclass
class Forest:
    """One tree for each `grp`. `levels[k]` holds the nodes `k * STRIDE` levels up, or the root of a lower tree."""

    levels: list[DataFrame]  # grp, at, height, digest; the first one with the item of each leaf besides

    @classmethod
    def grow(cls, rows: DataFrame, order: Sequence[str]) -> Forest:
        """Trees over rows (grp, digest, item), ordered by `order` in each group."""
        levels = [_numbered(rows, order)]
        highest = levels[0].agg(F.max("height")).first()[0] or 0
        for k in range(max(1, -(-highest // STRIDE))):
            nodes = _blocks(levels[k], k, ("digest",))
            folded = _folded(F.col("items.digest"), F.col("inside"))
            nodes = nodes.select("grp", F.col("block").alias("at"), "height", folded.alias("digest"))
            levels.append(stored(nodes, f"merkle-{k + 1}"))
        return cls(levels)

    def roots(self) -> DataFrame:
        """One row for each group: grp, ends (number of the level it ends at), digest."""
        found = [
            nodes.where(_ends() == k).select("grp", F.lit(k).alias("ends"), "digest")
            for k, nodes in enumerate(self.levels)
            if k
        ]
        return reduce(DataFrame.unionByName, found)

    def paths(self, tops: DataFrame) -> DataFrame:
        """Each leaf's item and digest with its way to the top; `tops`: grp, ends, path and further columns."""
        more = [c for c in tops.columns if c not in ("grp", "ends", "path")]
        below = None
        for k in reversed(range(len(self.levels) - 1)):
            over = tops.where(F.col("ends") == k + 1).select("grp", F.lit(0).cast("bigint").alias("block"), "path", *more)
            if below is not None:
                over = over.unionByName(below.select("grp", F.col("at").alias("block"), "path", *more))
            fields = ("digest",) if k else ("digest", "item")
            nodes = _blocks(self.levels[k], k, fields).withColumn("grown", _regrown(F.col("items.digest"), F.col("inside")))
            # The block's levels stand beside each of its nodes until the siblings are picked, and no longer.
            nodes = nodes.join(over, ["grp", "block"]).select("grp", "grown", "path", *more, F.posexplode("items").alias("place", "node"))
            path = F.concat(_siblings(F.col("grown"), F.col("place")), F.col("path"))
            below = nodes.select("grp", "node.*", path.alias("path"), *more)
        return below


def _ends() -> Column:
    """Number of the stored level at which a tree ends."""
    return F.greatest(F.lit(1), F.ceil(F.col("height") / STRIDE))


def _blocks(nodes: DataFrame, k: int, fields: Sequence[str]) -> DataFrame:
    """Aligned blocks of the nodes of a stored level, for the trees that go on above it.

    `inside` is the number of levels from these nodes to the top of their block.
    """
    block = F.shiftright("at", STRIDE).alias("block")
    items = F.sort_array(F.collect_list(F.struct("at", *fields))).alias("items")
    inside = F.least(F.lit(STRIDE), F.col("height") - k * STRIDE).alias("inside")
    return nodes.where(_ends() > k).groupBy("grp", block, "height").agg(items).withColumn("inside", inside)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (grp, digest, item) with their place `at` in their group and the height of its tree.

    Equal rows are told apart by where they were read, so that many copies of one row fill several tasks.
    """
    rows = rows.withColumn("read", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("grp", *order, "read").sortWithinPartitions("grp", *order, "read")
    placed = rows.select("grp", "digest", "item", F.monotonically_increasing_id().alias("place"))
    rows = stored(placed, "merkle-leaves").withColumn("task", F.shiftright("place", _TASK_BITS))
    parts = rows.groupBy("grp", "task").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp")
    before = F.sum("n").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    size = F.sum("n").over(whole)
    height = F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)
    first = (F.coalesce(before, F.lit(0)) - F.col("start")).alias("shift")
    parts = stored(parts.select("grp", "task", first, height.alias("height")), "merkle-parts")
    at = (F.col("place") + F.col("shift")).alias("at")
    return rows.join(parts, ["grp", "task"]).select("grp", at, "height", "digest", "item")


@dataclass
class Manifest:
    """The trees of a dataset and the tree over them."""

    groups: Forest
    top: Forest

    def root(self) -> DataFrame:
        """One row with the root, or none for an empty dataset."""
        return self.top.roots().select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """One row for each row of the dataset: its id, what was carried, leaf, subroot, root and path."""
        root = self.top.roots().select("grp", "ends", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
        tops = self.top.paths(root).select(
            F.col("item.grp").alias("grp"), F.col("item.ends").alias("ends"), "path", F.col("digest").alias("subroot"), "root"
        )
        rows = self.groups.paths(tops)
        manifest = ("subroot", "root", "path")
        return rows.select(F.col("digest").alias("leaf"), *manifest, "item")


def build(
    docs: DataFrame,
    columns: Sequence[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """Manifest of the `columns` of the rows. `carry`: small values that travel with each row to its proof.

    A proof's `item` has the id as `id` and what was carried under its own names.
    """
    prepare(docs.sparkSession)
    item = F.struct(F.col(id_col).alias("id"), *(c.alias(name) for name, c in (carry or {}).items()))
    rows = docs.select(
        _key(F.col(group_col)).alias("grp"),
        F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        item.alias("item"),
    )
    groups = Forest.grow(rows, ["id", "digest"])
    roots = groups.roots()
    top = roots.select(F.lit("all").alias("grp"), "digest", F.col("grp").alias("name"), F.struct("grp", "ends").alias("item"))
    return Manifest(groups, Forest.grow(top, ["name"]))


# The contract of `op12_merkle`. crc32 is spelled out bit by bit; trees, proofs and folding are recursive.
_BITS = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
_ID = "cast(doc_id AS varchar)"
_CRC = (
    f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(range(1, strlen({_ID}) + 1),"
    f" lambda i: ascii(substr({_ID}, i, 1))::bigint)), lambda c, b: {_BITS}), 4294967295)"
)


def _leaf_sql(n_chars: str) -> str:
    values = ("cast(doc_id AS varchar)", "source", "lang", f"cast({n_chars} AS varchar)", "text")
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + "))"


SQL = f"""WITH RECURSIVE leaves AS (
 SELECT doc_id, lang, leaf, shown, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
 FROM (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
  CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS shown FROM documents) d),
nodes AS (
 SELECT lang, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
 UNION ALL
 SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 1) // 2 FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
subroots AS (
 SELECT lang, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
 SELECT 0 AS level, pos, digest, n FROM subroots
 UNION ALL
 SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, pos // 2),
steps AS (
 SELECT n.lang, n.level, n.pos, CASE WHEN n.pos % 2 = 1 THEN s.digest ELSE '' END AS lft, CASE WHEN n.pos % 2 = 0 THEN coalesce(s.digest, '') ELSE '' END AS rgt
 FROM nodes n LEFT JOIN nodes s ON n.lang IS NOT DISTINCT FROM s.lang AND n.level = s.level AND s.pos = xor(n.pos, 1) WHERE n.n > 1
 UNION ALL
 SELECT r.lang, r.height + t.level, 0, CASE WHEN t.pos % 2 = 1 THEN s.digest ELSE '' END, CASE WHEN t.pos % 2 = 0 THEN coalesce(s.digest, '') ELSE '' END
 FROM subroots r JOIN tops t ON t.pos = r.pos >> t.level LEFT JOIN tops s ON t.level = s.level AND s.pos = xor(t.pos, 1) WHERE t.n > 1),
folds AS (
 SELECT lang, pos AS place, 0 AS level, shown AS got, '' AS proof FROM leaves
 UNION ALL
 SELECT f.lang, f.place, f.level + 1, sha256(lft || got || rgt), proof || lft || rgt
 FROM folds f JOIN steps s ON f.lang IS NOT DISTINCT FROM s.lang AND f.level = s.level AND s.pos = f.place >> f.level)
SELECT doc_id, leaf, r.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, got AS folded_root, got = t.digest AS verified
FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang JOIN (SELECT digest FROM tops WHERE n = 1) t ON true
JOIN (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY lang, place ORDER BY level DESC) = 1) f ON l.lang IS NOT DISTINCT FROM f.lang AND l.pos = f.place"""
