"""Merkle manifest of a dataset: one root for all rows, and a proof for each.

Rows are leaves, by group (language) and key. Within a group every two
consecutive nodes become their hash, level by level, until one is left, the
group's subroot; a last node without a partner is hashed alone. The subroots, by
group (null first, then by bytes), become the root in the same way. Digests
enter a hash as hexadecimal text.

A group may hold most rows, so positions come from a range-partitioned sort
(keys of equal rows are told apart by a row number) and the tree is built over
aligned blocks of 2^10 nodes: one task sees one block of a level at a time, and
block digests are the nodes of the next level. Proofs come the other way down.
Within a block the successive authentication paths are those of a fractal
traversal: tiers of a few levels each keep one subtree and build the next one
while the leaves go by, a leaf for each step; the proof of the block itself is
appended to each path.

Null values are marked in the leaf, null groups are a group of their own and
come first, null keys come first in their group. Empty and very long texts are
hashed whole, by built-in functions. Ties: rows with equal keys lie by leaf;
wholly equal rows get one place each, and their proofs may be exchanged. An
empty table has no rows and no root. Only the named columns are read, so others
may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import text_batches
from tallyspan.session import materialize

#: Levels of a block.
LEVELS = 10
#: Levels of a tier of the traversal.
TIER = 3


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def parent(left: str | None, right: str | None) -> str | None:
    """The node above two nodes; None stands for a node that isn't there."""
    return None if left is None else digest(left, right or "")


def height_of(n: int) -> int:
    """Levels above ``n`` nodes."""
    return max(n - 1, 0).bit_length()


class Growth:
    """Treehash over the leaves from ``start`` on; ``kept`` gets the nodes of the levels that ``wanted`` names."""

    def __init__(self, leaves: list[str], start: int, low: int, top: int):
        self.leaves, self.at, self.low, self.top = leaves, start, low, top
        self.stack: list[tuple[int, str | None]] = []
        self.kept: list[list[str | None]] = [[] for _ in range(top - low)]

    def step(self) -> None:
        """Takes one leaf and the merges that it completes, below the level ``top``."""
        node, level = self.leaves[self.at] if self.at < len(self.leaves) else None, 0
        self.at += 1
        while True:
            if level >= self.low:
                self.kept[level - self.low].append(node)
            if not self.stack or self.stack[-1][0] != level or level + 1 >= self.top:
                break
            node, level = parent(self.stack.pop()[1], node), level + 1
        if level + 1 < self.top:
            self.stack.append((level, node))


class Traversal:
    """Authentication paths of the leaves of one block, one after the other.

    Tier t covers ``TIER`` levels; of each the subtree above the present leaf is
    kept and its right neighbour grows by one leaf a step, so it is ready when
    the leaf enters it. The lowest levels hold 2 * 2^TIER nodes, and so does
    each tier: memory grows with the height, not with the leaves.
    """

    def __init__(self, leaves: list[str], height: int, tier: int = TIER):
        self.leaves, self.height, self.tier = leaves, height, tier
        self.tops = [min(low + tier, height) for low in range(0, height, tier)]
        self.existing: list[list[list[str | None]]] = []
        for t, top in enumerate(self.tops):
            first = Growth(leaves, 0, t * tier, top)
            for _ in range(1 << top):
                first.step()
            self.existing.append(first.kept)
        self.desired = [Growth(leaves, 1 << top, t * tier, top) for t, top in enumerate(self.tops)]

    def paths(self) -> Iterator[tuple[str, list[str]]]:
        """(sides, siblings) of each leaf: of each level l, r or -, for a sibling to the left, right or none."""
        for j in range(len(self.leaves)):
            sides, path = [], []
            for level in range(self.height):
                t = level // self.tier
                beside = (j >> level) ^ 1
                node = self.existing[t][level - t * self.tier][beside & ((1 << (self.tops[t] - level)) - 1)]
                sides.append("-" if node is None else "r" if beside & 1 else "l")
                if node is not None:
                    path.append(node)
            yield "".join(sides), path
            for t, top in enumerate(self.tops):
                if top == self.height:
                    continue
                self.desired[t].step()
                if (j + 1) % (1 << top) == 0:
                    self.existing[t] = self.desired[t].kept
                    self.desired[t] = Growth(self.leaves, j + 1 + (1 << top), t * self.tier, top)


def block_root(leaves: list[str], height: int) -> str:
    """The node ``height`` levels above the leaves."""
    for _ in range(height):
        leaves = [parent(leaves[i], leaves[i + 1] if i + 1 < len(leaves) else None) for i in range(0, len(leaves), 2)]
    return leaves[0]


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The leaf of a row, from its values in order."""
    return F.sha2(F.concat(*map(field, values)), 256)


def folded(leaf: Column, sides: Column, siblings: Column) -> Column:
    """The root that a leaf and its proof give."""
    start = F.struct(leaf.alias("h"), F.lit(0).alias("k"))

    def up(acc: Column, side: Column) -> Column:
        other = F.get(siblings, acc["k"])
        both = F.when(side == "l", F.concat(other, acc["h"])).when(side == "r", F.concat(acc["h"], other)).otherwise(acc["h"])
        return F.struct(F.sha2(both, 256).alias("h"), (acc["k"] + (side != "-").cast("int")).alias("k"))

    steps = F.filter(F.split(sides, ""), lambda c: c != "")
    return F.aggregate(steps, start, up, lambda acc: acc["h"])


def _numbered(rows: DataFrame, groups: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``__pos``, the place within their group, and ``__n``, the group's rows; the groups with ``__n``).

    A sort by ranges gives each row its number within its partition; partition
    offsets (a row each) make it a global rank, whose least in a group is
    subtracted.
    """
    spark = rows.sparkSession
    keys = [*groups, *order]
    run = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id())
    run = materialize(run, "merkle-sorted")
    part = run.groupBy(F.shiftright("__id", 33).alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offset = part.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    offset = spark.createDataFrame(offset.collect(), offset.schema)
    local = F.col("__id").bitwiseAND((1 << 33) - 1)
    ranked = run.withColumn("__part", F.shiftright("__id", 33)).join(F.broadcast(offset), "__part").withColumn("__rank", local + F.col("__offset"))
    ranked = ranked.drop("__part", "__id", "__offset")
    count = ranked.groupBy(*groups).agg(F.min("__rank").alias("__first"), F.count(F.lit(1)).alias("__n"))
    count = materialize(count, "merkle-groups")
    own = count.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], "__first", "__n")
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    return ranked.join(own, same).withColumn("__pos", F.col("__rank") - F.col("__first")).drop("__rank", "__first", *[f"__g{i}" for i in range(len(groups))]), count


def _blocks(nodes: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """``(__group, __block, __n, __rows)``: aligned blocks of nodes, in order."""
    rows = F.sort_array(F.collect_list(F.struct("__pos", "__leaf", *payload)))
    made = nodes.groupBy("__group", F.shiftright("__pos", levels).alias("__block")).agg(F.first("__n").alias("__n"), rows.alias("__rows"))
    return materialize(made, "merkle-blocks")


def _height(n: int, levels: int) -> int:
    """Levels of a block where its group has ``n`` nodes."""
    return min(height_of(n), levels)


def _above(blocks: DataFrame, levels: int) -> DataFrame:
    """The nodes that blocks become: ``(__group, __pos, __n, __leaf)``."""
    source = blocks.select("__group", F.col("__block").alias("__pos"), "__n", F.col("__rows.__leaf").alias("__leaves"))
    kind = source.schema["__group"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = [block_root([x.hex() for x in leaves], _height(n, levels)) for n, leaves in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            n = [-(-x // (1 << levels)) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([bytes.fromhex(r) for r in roots], pa.binary())], names=["__group", "__pos", "__n", "__leaf"])

    return materialize(source.mapInArrow(run, f"__group {kind}, __pos long, __n long, __leaf binary"), "merkle-nodes")


def _paths(blocks: DataFrame, upper: DataFrame, payload: list[str], levels: int) -> DataFrame:
    """Proofs of the nodes of blocks: ``(__group, __pos, __n, leaf, payload, sides, siblings, subroot)``.

    ``upper`` has the blocks' own proofs, ``__whole`` for those of groups (whose only block it is).
    """
    up = upper.select(F.col("__group").alias("__own"), F.col("__pos").alias("__at"), "__whole", "sides", "siblings", "subroot")
    place = (F.col("__block") == F.col("__at")) & ((F.col("__n") <= 1 << levels) == F.col("__whole"))
    joined = blocks.join(up, place & F.col("__group").eqNullSafe(F.col("__own"))).drop("__own", "__at", "__whole")
    joined = joined.select("__group", "__n", "sides", "siblings", "subroot", "__rows")
    row = joined.schema["__rows"].dataType.elementType
    own = [row[name] for name in ("__pos", *payload)]
    schema = ", ".join([f"__group {joined.schema['__group'].dataType.simpleString()}, __n long, leaf string, sides string, siblings array<string>, subroot string", *[f"`{f.name}` {f.dataType.simpleString()}" for f in own]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n, sides, siblings, subroot = (b.column(c)[i].as_py() for c in (1, 2, 3, 4))
                rows = b.column(5)[i].values
                leaves = [x.hex() for x in rows.field("__leaf").to_pylist()]
                found = list(Traversal(leaves, _height(n, levels)).paths())
                m = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array([i] * m)),
                        pa.array([n] * m, pa.int64()),
                        pa.array(leaves, pa.string()),
                        pa.array([s + sides for s, _ in found], pa.string()),
                        pa.array([p + siblings for _, p in found], pa.list_(pa.string())),
                        pa.array([subroot] * m, pa.string()),
                        *[rows.field(f.name) for f in own],
                    ],
                    names=["__group", "__n", "leaf", "sides", "siblings", "subroot", *[f.name for f in own]],
                )

    return joined.mapInArrow(run, schema)


class Tree:
    """The trees of all groups of ``nodes`` ``(__group, __pos, __n, __leaf, payload)``; ``most`` is the largest ``__n``."""

    def __init__(self, nodes: DataFrame, most: int, payload: list[str], levels: int):
        self.payload, self.height, self.levels, roots = payload, levels, [], []
        while True:
            self.levels.append(_blocks(nodes, payload if not self.levels else [], levels))
            nodes = _above(self.levels[-1], levels)
            roots.append(nodes.filter("__n = 1").select("__group", "__leaf"))
            most = -(-most // (1 << levels))
            if most == 1:
                break
            nodes = nodes.filter("__n > 1")
        self.roots = roots[0]
        for r in roots[1:]:
            self.roots = self.roots.unionByName(r)

    def proofs(self, top: DataFrame) -> DataFrame:
        """All leaves with their proofs, those of their groups, ``top``, appended: ``(__group, sides, siblings, subroot)``."""
        top = top.withColumns({"__pos": F.lit(0).cast("long"), "__whole": F.lit(True)})
        upper, columns = top, top.columns
        for level in reversed(range(1, len(self.levels))):
            found = _paths(self.levels[level], upper, [], self.height)
            upper = materialize(found.withColumn("__whole", F.lit(False)).select(*columns).unionByName(top), "merkle-paths")
        return _paths(self.levels[0], upper, self.payload, self.height)


def manifest(docs: DataFrame, leaf: Column, key: str = "doc_id", group: str = "lang", carry: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """``(key, group, leaf, subroot, root, sides, siblings, carried columns)``: every row with its place's proof.

    ``leaf`` is the row's digest, ``leaf_of(...)`` of the columns that the
    manifest covers. ``siblings`` holds the digests beside the path from the leaf
    to the root, ``sides`` for each level whether one stands to the left (l), to
    the right (r) or nowhere (-); ``folded(leaf, sides, siblings)`` gives the
    root again. ``carry`` names further columns to take along; ``levels`` sizes the blocks.
    """
    spark = docs.sparkSession
    text_batches(spark)
    carry = carry or {}
    base = docs.select(F.col(key).alias("__key"), F.col(group).alias("__group"), F.unhex(leaf).alias("__leaf"), *[c.alias(f"__c_{n}") for n, c in carry.items()])
    base = materialize(base.withColumn("__row", F.monotonically_increasing_id()), "merkle-leaves")
    payload = ["__key", *[f"__c_{n}" for n in carry]]
    nodes, groups = _numbered(base, ["__group"], ["__key", "__leaf", "__row"])
    most = groups.agg(F.max("__n").alias("n")).first()["n"]
    columns = [F.col("__key").alias(key), F.col("__group").alias(group), "leaf", "subroot", "root", "sides", "siblings", *[F.col(f"__c_{n}").alias(n) for n in carry]]
    if not most:
        empty = base.limit(0).selectExpr("*", "'' as leaf", "'' as subroot", "'' as root", "'' as sides", "array('') as siblings")
        return empty.select(*columns)
    tree = Tree(nodes, most, payload, levels)
    count = groups.count()
    over, _ = _numbered(tree.roots.select(F.lit(0).alias("__group"), F.col("__group").alias("__name"), "__leaf"), ["__group"], ["__name"])
    upper = Tree(over, count, ["__name"], levels)
    start = upper.roots.select("__group", F.lit("").alias("sides"), F.array().cast("array<string>").alias("siblings"), F.lower(F.hex("__leaf")).alias("subroot"))
    places = upper.proofs(start)  # here the subroot is the root of all, and the leaf a subroot
    root = upper.roots.select(F.lower(F.hex("__leaf"))).first()[0]
    tops = materialize(places.select(F.col("__name").alias("__group"), "sides", "siblings", F.col("leaf").alias("subroot")), "merkle-groups")
    return tree.proofs(tops).withColumn("root", F.lit(root)).select(*columns)
