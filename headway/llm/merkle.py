"""Merkle manifest of a dataset: checkpoint some levels, recompute the others for proofs.

Every row is a leaf. The leaves of a tree stand in order, and of every `fan` consecutive
nodes the concatenated digests, as hex text, are hashed to a node of the next level until
one is left, the tree's root. Only every `step`-th level is written. What lies between
belongs to aligned subtrees of at most `fan ** step` nodes of the level below, so a proof
regenerates the interior of one subtree from its stored nodes, emits the siblings and lets
the interior go. Subtrees are the groups of a shuffle: no task holds more than one at once,
and a hot tree is as many groups as it has subtrees.

Defined results: an empty table has no root and no proofs; a null or empty field differs
from every other value (see `row_digest`); rows that repeat a key are leaves each, in the
order of their digests, and equal rows have equal digests, so their order cannot matter;
null keys come first. Texts of any length are hashed by the JVM where they are read, and
only digests travel. Columns that are not asked for are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from headway.llm.grouping import stored
from headway.llm.ordering import with_position

_NODE = "tree string, at long, nodes long, digest binary"
_PATH = ("siblings", "places", "top")


def row_digest(*fields: Column) -> Column:
    """sha256 over the fields: ``-`` for null, else UTF-8 length, colon and value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tree_name(value: Column) -> Column:
    """A name without null that keeps the order: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit("-"))


@dataclass
class Manifest:
    """Stored levels 0, step, 2 * step and so on of a forest; level 0 has other columns too.

    A level's table: tree, at (number of the node in its level of the tree, from 0), nodes
    (how many that level has; 1: the root), digest.
    """

    levels: list[DataFrame]
    fan: int
    step: int

    def roots(self) -> DataFrame:
        """tree, digest: one row per tree."""
        tops = [level.filter("nodes = 1").select("tree", "digest") for level in self.levels]
        found = tops[0]
        for top in tops[1:]:
            found = found.union(top)
        return found


def build_manifest(
    leaves: DataFrame, order: list[Column], fan: int = 2, step: int = 8
) -> Manifest:
    """leaves: tree (no null), digest binary, and columns to keep; `order` within a tree."""
    width = fan**step
    placed = with_position(leaves, ["tree"], order, "at", "nodes")
    level = stored(placed, "level")
    levels = [level]
    while True:
        inner = level.filter("nodes > 1").select("tree", "at", "nodes", "digest")
        groups = inner.groupBy("tree", F.floor(F.col("at") / width).alias("block"))
        level = stored(groups.applyInArrow(_climb(fan, step), _NODE), "level")
        if level.isEmpty():
            return Manifest(levels, fan, step)
        levels.append(level)


def _parent(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


def _interior(digests: list[str], nodes: int, fan: int, step: int) -> list[list[str]]:
    """The levels of a subtree from its lowest; nodes: of that level in the whole tree.

    The subtree that is the whole level ends at the root, any other after `step` levels,
    also where one node is all that is left of it.
    """
    levels = [digests]
    whole = nodes == len(digests)
    for _ in range(step):
        below = levels[-1]
        if whole and len(below) == 1:
            break
        levels.append([_parent(below[i : i + fan]) for i in range(0, len(below), fan)])
    return levels


def _sorted_nodes(table: pa.Table) -> tuple[pa.Table, list[str], int]:
    table = table.sort_by("at")
    return table, [d.hex() for d in table["digest"].to_pylist()], table["nodes"][0].as_py()


def _climb(fan: int, step: int) -> Callable[[pa.Table], pa.Table]:
    """One subtree to its topmost node."""
    schema = pa.schema(
        [("tree", pa.string()), ("at", pa.int64()), ("nodes", pa.int64()), ("digest", pa.binary())]
    )

    def run(table: pa.Table) -> pa.Table:
        table, digests, nodes = _sorted_nodes(table)
        top = _interior(digests, nodes, fan, step)[-1]
        width = fan**step
        row = {
            "tree": table["tree"][0].as_py(),
            "at": table["at"][0].as_py() // width,
            "nodes": -(-nodes // width),
            "digest": bytes.fromhex(top[0]),
        }
        return pa.Table.from_pylist([row], schema=schema)

    return run


def _descend(
    fan: int, step: int, names: list[str]
) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Paths of a subtree's lowest nodes: their own siblings, then the path of its top."""

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, digests, nodes = _sorted_nodes(table)
        levels = [[bytes.fromhex(d) for d in x] for x in _interior(digests, nodes, fan, step)]
        siblings, places = above["siblings"][0].as_py(), above["places"][0].as_py()
        top = above["top"][0].as_py()
        found: dict[str, list[bytes]] = {name: [] for name in _PATH}
        for i in range(len(digests)):
            others, steps = [], bytearray()
            for level in levels[:-1]:
                first = i - i % fan
                run_of = level[first : first + fan]
                steps += bytes((i - first, len(run_of)))
                others += run_of[: i - first] + run_of[i - first + 1 :]
                i //= fan
            found["siblings"].append(b"".join(others) + siblings)
            found["places"].append(bytes(steps) + places)
            found["top"].append(top)
        columns = [table[name].combine_chunks() for name in names]
        columns += [pa.array(found[name], pa.binary()) for name in _PATH]
        return pa.Table.from_arrays(columns, names=[*names, *_PATH])

    return run


def extract_proofs(manifest: Manifest, tops: DataFrame | None = None) -> DataFrame:
    """Level 0 with siblings, places and top for each leaf.

    siblings: the digests of the run's others from the leaf's level up, 32 bytes each;
    places: for each level a byte for the node's place in its run and one for the run's
    size; top: the tree's own root. `tops` (tree, siblings, places) carries on the paths
    of the trees' roots, for instance in a tree of roots.
    """
    fan, step = manifest.fan, manifest.step
    width = fan**step
    above = None
    for level in reversed(manifest.levels):
        names = level.columns
        ends = level.filter("nodes = 1")
        if tops is None:
            empty = F.lit(b"")
            ends = ends.withColumns({"siblings": empty, "places": empty})
        else:
            ends = ends.join(tops.select("tree", "siblings", "places"), "tree")
        ends = ends.withColumn("top", F.col("digest")).select(*names, *_PATH)
        if above is not None:
            extra = [StructField(name, BinaryType()) for name in _PATH]
            schema = StructType([*level.schema.fields, *extra])
            children = level.filter("nodes > 1").groupBy(
                "tree", F.floor(F.col("at") / width).alias("block")
            )
            paths = above.groupBy("tree", "at")
            inner = children.cogroup(paths).applyInArrow(_descend(fan, step, names), schema)
            ends = ends.union(inner)
        # Levels above the leaves are few and read again below; leaves' proofs go out.
        above = ends if level is manifest.levels[0] else stored(ends, "paths")
    return above


def fold(digest: bytes, siblings: bytes, places: bytes) -> bytes:
    """The root that follows from a leaf and its path."""
    at, current, others = 0, digest.hex(), siblings.hex()
    for place, size in zip(places[::2], places[1::2], strict=True):
        here, end = at + 64 * place, at + 64 * (size - 1)
        current = sha256((others[at:here] + current + others[here:end]).encode()).hexdigest()
        at = end
    return bytes.fromhex(current)


def with_folded(proofs: DataFrame, leaf: str, name: str, keep: list[str]) -> DataFrame:
    """The columns to keep and, as `name`, the root that follows from the digest in `leaf`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = [batch.column(c).to_pylist() for c in (leaf, "siblings", "places")]
            roots = pa.array([fold(*row) for row in zip(*path, strict=True)], pa.binary())
            columns = [*(batch.column(c) for c in keep), roots]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, name])

    kept = [proofs.schema[c] for c in keep]
    wanted = dict.fromkeys([*keep, leaf, "siblings", "places"])
    return proofs.select(*wanted).mapInArrow(run, StructType([*kept, StructField(name, BinaryType())]))


def dataset_proofs(
    rows: DataFrame,
    key: str,
    tree: str,
    fields: list[str],
    keep: list[str],
    fan: int = 2,
    step: int = 8,
) -> tuple[DataFrame, bytes | None]:
    """Proofs of all rows in a tree of trees, and the root of it all.

    The rows form a tree per value of `tree`, in the order of `key`; the roots of those
    form one more, null first, then by bytes. Returned are the columns of `keep`, digest,
    top (the root of the row's own tree), siblings and places up to the one root.
    """
    digest = row_digest(*(F.col(f) for f in fields))
    kept = [F.col(c).alias(f"kept_{c}") for c in keep]
    order = F.col(key).alias("key")
    leaves = rows.select(tree_name(F.col(tree)).alias("tree"), order, digest.alias("digest"), *kept)
    forest = build_manifest(
        stored(leaves, "leaves"), [F.col("key").asc_nulls_first(), F.col("digest")], fan, step
    )
    subroots = forest.roots().select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"
    )
    crown = build_manifest(stored(subroots, "leaves"), [F.col("name")], fan, step)
    # One row, the root itself, comes to the driver.
    root = crown.roots().select("digest").first()
    tops = extract_proofs(crown).select(F.col("name").alias("tree"), "siblings", "places")
    found = extract_proofs(forest, stored(tops, "tops"))
    named = [F.col(f"kept_{c}").alias(c) for c in keep]
    return found.select(*named, "digest", *_PATH), bytes(root["digest"]) if root else None
