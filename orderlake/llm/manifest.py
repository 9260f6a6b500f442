"""A Merkle manifest: one hash tree per source, one over the sources, and the proof of every row.

Three consecutive nodes make their parent, the last run may be shorter. A tree is cut into aligned subtrees
of a fixed height. A task builds whole subtrees and hands on their roots, which are the leaves of the next
round, until every source has one node; the sources' nodes are one more tree, built the same way. Proofs go
the other way: a subtree is built again, beside the proof of its root, and each of its leaves gets the
siblings inside the subtree followed by that proof.

Inside a task a subtree is stored in van Emde Boas order: cut at half its height, the upper half first, then
the lower trees one after the other, each stored the same way. A node and its siblings are found by address
arithmetic alone, and a path from a leaf to the root touches few neighbouring stretches of the store.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.staging import staged
from orderlake.operators.joins import join_unique

#: Nodes that make a parent; levels of a subtree above its leaves.
FAN, LEVELS = 3, 8
SPAN = FAN**LEVELS
_PLACE_BITS = 33
_SOURCES = -1


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- one subtree ---------------------------------------------------------------------------------


def levels(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


@cache
def addresses(height: int) -> list[np.ndarray]:
    """Where the nodes of a full tree of ``height`` levels are stored, per depth from the root."""
    if height == 1:
        return [np.zeros(1, np.int64)]
    upper, lower = addresses(height // 2), addresses(height - height // 2)
    first, size = _nodes(height // 2), _nodes(height - height // 2)
    trees = first + size * np.arange(FAN ** (height // 2))
    return upper + [(trees[:, None] + inner).ravel() for inner in lower]


def _nodes(height: int) -> int:
    return (FAN**height - 1) // (FAN - 1)


class Subtree:
    """Digests of a subtree ``height`` levels high over its leaves, which fill it from the left."""

    def __init__(self, leaves: list[str], height: int):
        self._at = [a.tolist() for a in addresses(height + 1)]
        self._store: list[str | None] = [None] * _nodes(height + 1)
        self._height, self._count = height, [len(leaves)]
        for at, leaf in zip(self._at[height], leaves):
            self._store[at] = leaf
        for level in range(height):
            self._count.append(-(-self._count[level] // FAN))
            here = self._at[height - level - 1]
            for parent in range(self._count[level + 1]):
                self._store[here[parent]] = digest("".join(self._run(level, parent)))

    def _run(self, level: int, parent: int) -> list[str]:
        """The children of a node, as they are stored."""
        here = self._at[self._height - level]
        return [self._store[a] for a in here[FAN * parent : min(FAN * parent + FAN, self._count[level])]]

    @property
    def root(self) -> str:
        return self._store[0]

    def siblings(self) -> list[list[tuple[str, str]]]:
        """Per level and node: the digests of its run before it and after it, joined."""
        found = []
        for level in range(self._height):
            own = []
            for parent in range(self._count[level + 1]):
                run = self._run(level, parent)
                own += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
            found.append(own)
        return found


def _subtrees(table: pa.Table) -> Iterator[tuple[int, int, int, np.ndarray, Subtree]]:
    """The subtrees of a group: tree, block, nodes of the layer, the rows that are its leaves, in order."""
    tree, place, n = (table.column(c).to_numpy() for c in ("tree", "pos", "n"))
    digests = table.column("digest").to_pylist()
    order = np.lexsort((place, tree))
    block = place // SPAN
    edges = np.flatnonzero(np.diff(tree[order]) | np.diff(block[order])) + 1
    for rows in np.split(order, edges) if len(order) else ():
        size = int(n[rows[0]])
        yield int(tree[rows[0]]), int(block[rows[0]]), size, rows, Subtree([digests[i] for i in rows], min(LEVELS, levels(size)))


_NODES = "g1 bigint, g2 bigint, tree bigint, pos bigint, n bigint, digest string"


def _roots(table: pa.Table) -> pa.Table:
    """The roots of a group's subtrees, with the group they came from."""
    g1, g2 = table.column("c1")[0].as_py(), table.column("c2")[0].as_py()
    found = [(tree, block, -(-n // SPAN), subtree.root) for tree, block, n, _, subtree in _subtrees(table)]
    tree, block, n, root = zip(*found)
    whole = pa.int64()
    columns = [pa.array([g1] * len(found), whole), pa.array([g2] * len(found), whole)]
    columns += [pa.array(c, whole) for c in (tree, block, n)] + [pa.array(root, pa.string())]
    return pa.table(columns, ["g1", "g2", "tree", "pos", "n", "digest"])


_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_PROOF = "proof array<struct<left string, right string>>"


def _prove(names: list[str]):
    """A function that gives the leaves of a group's subtrees their proofs; columns ``names`` go along."""

    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        upper = {
            (tree, block): i for i, (tree, block) in enumerate(zip(above.column("tree").to_pylist(), above.column("pos").to_pylist()))
        }
        left: list[str] = []
        right: list[str] = []
        ends, order, parents = [0], [], []
        for tree, block, _, rows, subtree in _subtrees(nodes) if nodes.num_rows else ():
            at = upper[tree, block]
            rest = above.column("proof")[at].as_py()
            levels_ = subtree.siblings()
            for i, row in enumerate(rows):
                steps = [own[i // FAN**level] for level, own in enumerate(levels_)]
                left += [s[0] for s in steps] + [s["left"] for s in rest]
                right += [s[1] for s in steps] + [s["right"] for s in rest]
                ends.append(len(left))
                order.append(row)
                parents.append(at)
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(_STEP))
        out = nodes.select(names).take(pa.array(order, pa.int64()))
        out = out.append_column("proof", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps))
        parents = pa.array(parents, pa.int64())
        for name in ("subroot", "root"):
            out = out.append_column(name, above.column(name).take(parents))
        return out

    return run


# --- layers --------------------------------------------------------------------------------------


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Layers of nodes from ``nodes`` up, and per layer the trees that end in it, as their last node."""
    layers, tops = [nodes], []
    while True:
        slim = layers[-1].select("c1", "c2", "tree", "pos", "n", "digest")
        parents = staged(slim.groupBy("c1", "c2").applyInArrow(_roots, _NODES), f"{name}{len(layers)}")
        tops.append(parents.filter("n = 1"))
        rest = parents.filter("n > 1")
        if rest.isEmpty():
            return layers, tops
        block = F.floor(F.col("pos") / SPAN)
        layers.append(rest.withColumns({"c1": F.col("tree"), "c2": block}))


def _descend(layers: list[DataFrame], tops: list[DataFrame]) -> DataFrame:
    """The first layer with proofs. ``tops`` are the last nodes of the trees with theirs and the roots."""
    above = None
    needed = ["g1", "g2", "tree", "pos", "proof", "subroot", "root"]
    for layer, top in zip(reversed(layers), reversed(tops)):
        above = top.select(*needed) if above is None else top.select(*needed).unionByName(above.select(*needed))
        names = [c for c in layer.columns if c not in ("c1", "c2")]
        kinds = dict(layer.dtypes)
        schema = ", ".join([*(f"{c} {kinds[c]}" for c in names), _PROOF, "subroot string, root string"])
        above = layer.groupBy("c1", "c2").cogroup(above.groupBy("g1", "g2")).applyInArrow(_prove(names), schema)
    return above


def _placed(leaves: DataFrame) -> DataFrame:
    """Rows with the number of their source's tree, their place in it, its size and the task they go to.

    The rows are sorted once, in ranges, by source, id, digest and, as equal rows may be many, a row number.
    Places follow from the number of rows per part and source. Trees of at most one subtree share tasks:
    those that begin within one span of rows go together.
    """
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), "digest", "row"]
    placed = staged(leaves.orderBy(*order).drop("row").withColumn("id", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("part", F.shiftrightunsigned("id", _PLACE_BITS))
    placed = placed.withColumn("place", F.col("id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop("id")
    pieces = staged(placed.groupBy("source", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")), "pieces")
    trees = pieces.groupBy("source").agg(F.min(F.struct("part", "first")).alias("at"), F.sum("rows").alias("n")).select("source", "at.*", "n")
    # one row per part of the sort
    parts = pieces.groupBy("part").agg(F.sum("rows").alias("rows"))
    begun = trees.groupBy("part").agg(F.count(F.lit(1)).alias("trees"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.join(begun, "part", "left").select(
        "part",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("trees").over(earlier), F.lit(0)).alias("trees_before"),
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    trees = trees.withColumn("inside", inside).join(parts, "part").select(
        "source", "n", (F.col("trees_before") + F.col("inside")).alias("tree"), (F.col("rows_before") + F.col("first")).alias("begin")
    )
    pieces = join_unique(pieces.select("source", "part"), trees, ["source"], "inner", null_safe=True)
    pieces = pieces.join(parts.select("part", "rows_before"), "part")
    placed = join_unique(placed, pieces, ["source", "part"], "inner", null_safe=True)
    pos = F.col("rows_before") + F.col("place") - F.col("begin")
    large = F.col("n") > SPAN
    cells = {
        "c1": F.when(large, F.col("tree")).otherwise(-2 - F.floor(F.col("begin") / SPAN)),
        "c2": F.when(large, F.floor(pos / SPAN)).otherwise(0),
    }
    return placed.withColumn("pos", pos).withColumns(cells).drop("source", "part", "place", "rows_before", "begin")


# --- operator ------------------------------------------------------------------------------------


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields: each its UTF-8 byte count, a colon and its value, or a dash if null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root a leaf leads to along a proof."""
    return F.aggregate(proof, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def manifest(docs: DataFrame, fields: dict[str, Column], claims: dict[str, Column], source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, claim, subroot (of its source), root and proof, from the leaf up the
    digests beside it in its run, before and after it.

    ``fields`` are the columns hashed, ``doc_id`` among them; ``claims`` replaces some of them, and ``claim`` is
    the leaf made of these. Rows of a source are ordered by doc_id, rows without one first, then by leaf;
    repeated rows are leaves of their own. Null sources are one source, before the others. Null fields are
    dashes and differ from empty text. Other columns are not read. An empty table gives no rows.
    """
    rows = staged(
        docs.select(
            fields["doc_id"].cast("bigint").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            leaf(*fields.values()).alias("digest"),
            leaf(*(fields | claims).values()).alias("claim"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    first = staged(_placed(rows), "placed")
    layers, tops = _climb(first, "layer")
    ended = reduce(DataFrame.unionByName, [top.withColumn("layer", F.lit(i)) for i, top in enumerate(tops)])
    # the sources' last nodes are the leaves of one more tree
    at = F.col("tree")
    sources = ended.select(
        F.lit(_SOURCES).cast("bigint").alias("c1"),
        F.floor(at / SPAN).alias("c2"),
        F.lit(_SOURCES).cast("bigint").alias("tree"),
        at.alias("pos"),
        F.lit(ended.count()).cast("bigint").alias("n"),
        "digest",
        F.col("g1").alias("h1"),
        F.col("g2").alias("h2"),
        "layer",
    )
    above, last = _climb(sources, "sources")
    nothing = F.array().cast("array<struct<left string, right string>>")
    of_root = {"proof": nothing, "subroot": F.lit(None).cast("string"), "root": F.col("digest")}
    proven = _descend(above, [top.withColumns(of_root) for top in last])
    proven = proven.select(
        "layer", F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("pos").alias("tree"), "proof", F.col("digest").alias("subroot"), "root"
    )
    proven = staged(proven.withColumn("pos", F.lit(0).cast("bigint")), "proven")
    found = _descend(layers, [proven.filter(F.col("layer") == i) for i in range(len(layers))])
    return found.select("doc_id", F.col("digest").alias("leaf"), "claim", "subroot", "root", "proof")
