"""Merkle manifest of a dataset: digests of rows, a tree per group of rows and a tree over the groups' roots.

Rows of a group are numbered in order without a window over the group: rows are range-partitioned, counted per partition,
and numbered inside each partition behind the sum of the counts before it. Every ``ARITY`` consecutive nodes become one
until one is left.

Only every ``stride``-th level is stored (checkpoint and recompute): an aligned subtree is ``ARITY ** stride`` consecutive
stored nodes. Going up, each subtree is hashed to its top node, and what lies between is forgotten. Going down, the nodes
between are regenerated from the subtree's stored ones, each of these is given its siblings inside the subtree and behind
them the siblings of the subtree's top, and the regenerated nodes are discarded again. A task holds one subtree at a time,
whatever the size of the group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import shuffle_width
from tierlake.sources.staging import stage

ARITY = 3
STRIDE = 3
#: Subtrees whose nodes are Python objects at one time.
SUBTREES = 500


def _hash(digests: Sequence[bytes]) -> bytes:
    """Digest of the hexadecimal digests in a row."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """sha256 of all fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def regenerate(stored: list[bytes], width: int, stride: int) -> list[list[bytes]]:
    """The levels of an aligned subtree above its stored nodes; ``width``: nodes of the whole tree at the stored level."""
    levels = [stored]
    while width > 1 and len(levels) <= stride:
        below = levels[-1]
        levels.append([_hash(below[at : at + ARITY]) for at in range(0, len(below), ARITY)])
        width = -(-width // ARITY)
    return levels


def siblings(levels: list[list[bytes]], place: int) -> bytes:
    """The way from a stored node to the subtree's top: per level a byte (place and size of the run), then the siblings."""
    way = []
    for level in levels[:-1]:
        first = place - place % ARITY
        run = level[first : first + ARITY]
        way.append(bytes([place % ARITY * 16 + len(run)]) + b"".join(run[: place % ARITY] + run[place % ARITY + 1 :]))
        place //= ARITY
    return b"".join(way)


def runs(way: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(own place, siblings) of every level of a way."""
    at = 0
    while at < len(way):
        place, others = way[at] // 16, way[at] % 16 - 1
        yield place, [way[at + 1 + 32 * n : at + 33 + 32 * n] for n in range(others)]
        at += 1 + 32 * others


def fold(digest: bytes, way: bytes) -> bytes:
    """The root that a node and its siblings give."""
    for place, others in runs(way):
        digest = _hash([*others[:place], digest, *others[place:]])
    return digest


def proof_digest(way: bytes) -> bytes:
    """Digest of all siblings of a way, from the leaf's to the root's."""
    return _hash([one for _, others in runs(way) for one in others])


def numbered(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (from 0, within ``tree``) and ``width`` (rows of the tree) by ``order``, which begins with the tree.

    Ascending, nulls first. No partition holds a whole tree unless the tree is small.
    """
    sort = [F.col(name).asc_nulls_first() for name in order]
    ranged = frame.repartitionByRange(shuffle_width(frame), *sort).withColumn("part", F.spark_partition_id())
    cut = stage(ranged, "ranged")
    counts = cut.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    starts = stage(counts.select("part", "tree", start, F.sum("size").over(tree).alias("width")), "starts")
    place = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*sort)) - 1
    return cut.withColumn("pos", place).join(starts, ["part", "tree"]).withColumn("pos", F.col("pos") + F.col("start")).drop("part", "start")


def _subtrees(nodes: DataFrame, stride: int, payload: Sequence[str] = ()) -> DataFrame:
    """(tree, top, width, nodes): the stored nodes of every aligned subtree in order, at most ARITY ** stride."""
    node = F.struct("pos", "digest", *payload)
    grouped = nodes.groupBy("tree", F.expr("pos div {}".format(ARITY**stride)).alias("top"))
    return stage(grouped.agg(F.max("width").alias("width"), F.sort_array(F.collect_list(node)).alias("nodes")), "subtrees")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SUBTREES):
            yield batch.slice(at, SUBTREES).to_pylist()


def _tops(subtrees: DataFrame, stride: int) -> DataFrame:
    """The next stored level: one node per subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            levels = [regenerate([n["digest"] for n in r["nodes"]], r["width"], stride) for r in rows]
            width = [max(1, -(-r["width"] // ARITY ** (len(found) - 1))) for r, found in zip(rows, levels)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["tree"] for r in rows], pa.string()),
                    pa.array([r["top"] for r in rows], pa.int64()),
                    pa.array(width, pa.int64()),
                    pa.array([found[-1][0] for found in levels], pa.binary()),
                ],
                ["tree", "pos", "width", "digest"],
            )

    return subtrees.mapInArrow(run, "tree string, pos long, width long, digest binary")


def _ways(subtrees: DataFrame, above: DataFrame, stride: int, payload: str = "") -> DataFrame:
    """Every stored node with its way to the root; ``above`` (tree, pos, way, subroot, root) has those of the tops."""
    fields = "tree string, pos long, digest binary, way binary, subroot binary, root binary" + payload
    extra = [part.split()[0] for part in payload.split(",") if part.strip()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _slices(batches):
            out = []
            for row in rows:
                levels = regenerate([n["digest"] for n in row["nodes"]], row["width"], stride)
                for place, node in enumerate(row["nodes"]):
                    way = siblings(levels, place) + row["way"]
                    out.append({**node, "tree": row["tree"], "way": way, "subroot": row["subroot"], "root": row["root"]})
            yield pa.RecordBatch.from_pylist(out, kinds)

    own = subtrees.schema["nodes"].dataType.elementType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    kinds = pa.schema(
        [
            ("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.binary()), ("way", pa.binary()),
            ("subroot", pa.binary()), ("root", pa.binary()), *[(name, arrow[own[name].dataType.simpleString()]) for name in extra],
        ]
    )
    matched = subtrees.join(above.withColumnRenamed("pos", "top").drop("digest"), ["tree", "top"])
    return matched.mapInArrow(run, fields)


@dataclass
class Tree:
    """Stored subtrees from the leaves up, and the node that is left of every tree."""

    levels: list[DataFrame]
    tops: DataFrame


def grow(leaves: DataFrame, stride: int, payload: Sequence[str] = ()) -> Tree:
    """Trees over numbered leaves (tree, pos, width, digest and payload)."""
    levels = [_subtrees(leaves, stride, payload)]
    left = levels[0].agg(F.max("width")).first()[0] or 0
    while left > ARITY**stride:
        levels.append(_subtrees(_tops(levels[-1], stride), stride))
        left = -(-left // ARITY**stride)
    return Tree(levels, stage(_tops(levels[-1], stride), "tops"))


def proofs(
    rows: DataFrame, key: str, group: str, fields: Sequence[str], changed: Column | None = None, stride: int = STRIDE
) -> DataFrame:
    """One row per row of ``rows``: row_id, leaf, way (siblings up to the root), subroot, root and altered, all binary.

    ``fields`` make up the leaf; rows are grouped by ``group`` (a null group is one of its own, and the first) and ordered
    by ``key`` (nulls first; equal keys by leaf). ``altered`` is the leaf with the last field replaced by ``changed``, null
    if that gives the same leaf. Repeated rows are leaves of their own. No row gives no row. Other columns are ignored.
    """
    digest = leaf_digest([F.col(name) for name in fields])
    other = leaf_digest([*[F.col(name) for name in fields[:-1]], F.col(fields[-1]) if changed is None else changed])
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n"))
    made = rows.select(tree.alias("tree"), F.col(key).alias("row_id"), digest.alias("digest"), other.alias("altered"))
    spread = F.monotonically_increasing_id()  # equal rows needn't lie in one range
    leaves = stage(
        made.select("tree", "row_id", "digest", F.nullif("altered", "digest").alias("altered"), spread.alias("at")), "leaves"
    )
    inner = grow(numbered(leaves, ["tree", "row_id", "digest", "at"]).drop("at"), stride, ["row_id", "altered"])
    groups = inner.tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    outer = grow(numbered(groups, ["tree", "name"]), stride, ["name"])

    above = outer.tops.select("tree", "pos", F.lit(b"").alias("way"), F.lit(b"").alias("subroot"), F.col("digest").alias("root"))
    for level in reversed(outer.levels[1:]):
        above = stage(_ways(level, above, stride), "ways")
    named = _ways(outer.levels[0], above, stride, ", name string")
    above = named.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "way", F.col("digest").alias("subroot"), "root")
    above = stage(above, "ways")
    for level in reversed(inner.levels[1:]):
        above = stage(_ways(level, above, stride), "ways")
    kind = rows.schema[key].dataType.simpleString()
    found = _ways(inner.levels[0], above, stride, ", row_id {}, altered binary".format(kind))
    return found.select("row_id", F.col("digest").alias("leaf"), "way", "subroot", "root", "altered")


def verify(proved: DataFrame) -> DataFrame:
    """Add proof (digest of the siblings), folded (root recomputed from the altered leaf, if any) and verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, leaves, altered = (batch.column(name).to_pylist() for name in ("way", "leaf", "altered"))
            folded = [fold(leaf if other is None else other, way) for leaf, other, way in zip(leaves, altered, ways)]
            kept = [batch.column(name) for name in ("row_id", "leaf", "subroot", "root")]
            same = [a == b for a, b in zip(folded, batch.column("root").to_pylist())]
            proof = pa.array([proof_digest(way) for way in ways], pa.binary())
            arrays = [*kept, proof, pa.array(folded, pa.binary()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["row_id", "leaf", "subroot", "root", "proof", "folded", "verified"])

    kind = proved.schema["row_id"].dataType.simpleString()
    fields = "row_id {}, leaf binary, subroot binary, root binary, proof binary, folded binary, verified boolean".format(kind)
    return proved.select("row_id", "leaf", "way", "subroot", "root", "altered").mapInArrow(run, fields)
