"""Merkle manifest of a dataset: checkpoint and recompute.

Every row is a leaf. The leaves of a source, by document id, form a tree whose nodes
are the digests of ``FANOUT`` consecutive nodes below; the sources' roots, by name,
form one more tree on top.

* *Places.* Leaves are sorted by ranges of (tree, id, digest), so a source with a third
  of all rows spreads over many tasks. A leaf's number is its place in its partition
  plus what earlier partitions hold of its tree: sums over partitions, not over rows.
* *Checkpoints.* Only every ``KEPT``-th level is stored, as one row per aligned subtree
  of at most ``FANOUT ** KEPT`` nodes. The subtree's top goes to the next stored level,
  the levels between are discarded.
* *Proofs.* From the top stored level down, each subtree meets the proof of its own top,
  makes its missing interior nodes anew from the stored ones, gives every stored node
  its siblings followed by the proof above, and discards the interior again. A leaf's
  siblings leave the last step; nothing but stored levels and paths is ever shuffled.

A digest is SHA-256 of the inputs' lowercase hex texts. Null fields count as ``-`` and
differ from empty ones. A missing id comes before all others, a missing source before
all names; rows with one id are ordered by their digests, so repeated rows have equal
leaves at neighbouring places. An empty table has no rows and no root. Texts are hashed
whole, in the scan. Columns other than the fields and ``carry`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, KEPT = 16, 2
DIGEST = 32
MOST_LEVELS = 15  # FANOUT ** 15 leaves still count in 64 bits


def field(value: Column) -> Column:
    """A null as ``-``, anything else as its UTF-8 length, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def told(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def tree_key(source: Column) -> Column:
    """A key that is never null and sorts as sources do: missing first, then bytewise."""
    text = source.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


def height(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return sum(((size > FANOUT**k).cast("int") for k in range(MOST_LEVELS)), F.lit(0))


def numbered(nodes: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``nodes`` with ``pos``, the number in the tree by ``order``, and the tree's ``size``."""
    placed = stored(
        nodes.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id()),
        label,
    )
    parts = placed.groupBy("tree", "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree",
        "_part",
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(tree).alias("size"),
    )
    pos = (F.col("_row") - F.col("_first") + F.col("_before")).alias("pos")
    return placed.join(starts, ["tree", "_part"]).select(*nodes.columns, pos, "size")


@dataclass
class Forest:
    """Stored levels, lowest first: (tree, size, at, nodes); and (tree, size, h) of the roots."""

    levels: list[DataFrame]
    roots: DataFrame


def above(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of ``levels`` levels over ``digests``, these included."""
    out = [digests]
    for _ in range(levels):
        low = out[-1]
        runs = (b"".join(low[i : i + FANOUT]) for i in range(0, len(low), FANOUT))
        out.append([sha256(run.hex().encode()).digest() for run in runs])
    return out


def _levels_between(size: int, base: int) -> int:
    """How many levels an aligned subtree over stored level ``base`` has in its tree."""
    tall = 0
    while FANOUT**tall < size:
        tall += 1
    return min(KEPT, tall - base)


def _tops(base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [
                above(digests.as_py(), _levels_between(size, base))[-1][0]
                for digests, size in zip(batch["digests"], batch["size"].to_pylist(), strict=True)
            ]
            columns = [batch["tree"], batch["size"], batch["at"], pa.array(tops, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "size", "pos", "h"])

    return run


def grow(nodes: DataFrame, label: str) -> Forest:
    """The forest over ``nodes``: tree, size, pos, h and columns that stay beside a leaf."""
    levels, roots, base = [], [], 0
    while True:
        kept = F.struct("pos", "h", *(c for c in nodes.columns if c not in ("tree", "size", "pos", "h")))
        block = F.floor(F.col("pos") / FANOUT**KEPT) if base == 0 else F.col("block")
        level = stored(
            nodes.withColumn("at", block.cast("bigint"))
            .groupBy("tree", "size", "at")
            .agg(F.sort_array(F.collect_list(kept)).alias("nodes")),
            f"{label}_level{base}",
        )
        levels.append(level)
        tops = stored(
            level.select("tree", "size", "at", F.col("nodes.h").alias("digests")).mapInArrow(
                _tops(base), "tree string, size bigint, pos bigint, h binary"
            ),
            f"{label}_tops",
        )
        base += KEPT
        done = height(F.col("size")) <= base
        roots.append(tops.filter(done).select("tree", "size", "h"))
        open_ = tops.filter(~done)
        if open_.isEmpty():
            break
        nodes = open_.withColumn("block", F.floor(F.col("pos") / FANOUT**KEPT))
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Forest(levels, found)


def _subtree_paths(digests: list[bytes], levels: int, tail: tuple) -> list[tuple]:
    """(siblings, places, runs) of each node, level by level up to the top and then ``tail``."""
    interior = above(digests, levels)
    paths = [tail]
    for low in reversed(interior[:levels]):
        found = []
        for run, (siblings, places, runs) in zip(range(0, len(low), FANOUT), paths, strict=True):
            nodes = low[run : run + FANOUT]
            joined = b"".join(nodes)
            counts = [len(nodes), *runs]
            for place in range(len(nodes)):
                at = place * DIGEST
                own = joined[:at] + joined[at + DIGEST :]
                found.append((own + siblings, [place, *places], counts))
        paths = found
    return paths


def _paths(base: int, names: list[str]):
    steps = pa.list_(pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                tail = tuple(row[c][0].as_py() for c in ("siblings", "places", "runs"))
                levels = _levels_between(row["size"][0].as_py(), base)
                digests = row["nodes"].flatten().field("h").to_pylist()
                siblings, places, runs = map(list, zip(*_subtree_paths(digests, levels, tail), strict=True))
                made = {
                    "siblings": pa.array([siblings], pa.list_(pa.binary())),
                    "places": pa.array([places], steps),
                    "runs": pa.array([runs], steps),
                }
                yield pa.RecordBatch.from_arrays([made.get(c, row[c]) for c in names], names=names)

    return run


def paths(forest: Forest, upper: DataFrame) -> DataFrame:
    """Proofs of the leaves: their columns with ``siblings``, ``places`` and ``runs``.

    ``siblings`` holds the digests one after another; per level ``places`` is the node's
    place in its run and ``runs`` the run's length. ``upper`` has, per tree, these three
    for the way above its root, and columns to hand down to every leaf.
    """
    handed = [c for c in upper.columns if c not in ("tree", "siblings", "places", "runs")]
    way = ["siblings", "places", "runs", *handed]
    tops = upper.join(forest.roots.select("tree", height(F.col("size")).alias("_height")), "tree")
    found = None
    for k in reversed(range(len(forest.levels))):
        base, level = k * KEPT, forest.levels[k]
        ends = F.col("_height") <= base + KEPT
        if base:
            ends &= F.col("_height") > base
        known = tops.filter(ends).select("tree", F.lit(0).cast("bigint").alias("at"), *way)
        if found is not None:
            known = known.unionByName(found.select("tree", F.col("pos").alias("at"), *way))
        rows = level.join(known, ["tree", "at"])
        kinds = {c: t.dataType.simpleString() for c, t in ((f.name, f) for f in rows.schema.fields)}
        kinds |= {
            "siblings": "array<binary>",
            "places": "array<array<int>>",
            "runs": "array<array<int>>",
        }
        schema = ", ".join(f"{c} {kinds[c]}" for c in rows.columns)
        each = F.inline(F.arrays_zip("nodes", "siblings", "places", "runs"))
        made = rows.mapInArrow(_paths(base, rows.columns), schema).select("tree", *handed, each)
        found = made.select("tree", "nodes.*", *way)
        if base:
            found = stored(found, "paths")
    return found


@dataclass
class Manifest:
    """The trees of the sources, the tree over their roots, and the dataset's root."""

    sources: Forest
    top: Forest
    root: str | None


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, carry: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of ``docs``; ``carry`` names columns to keep beside each leaf."""
    carry = carry or {}
    leaves = docs.select(
        tree_key(F.col("source")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(*(F.col(c) for c in fields)).alias("h"),
        *(value.alias(name) for name, value in carry.items()),
    )
    sources = grow(numbered(leaves, ["doc_id", "h"], "leaves"), "merkle")
    tops = sources.roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "h")
    top = grow(numbered(tops, ["source"], "subroots"), "merkle_top")
    root = top.roots.select(told(F.col("h"))).first()
    return Manifest(sources, top, root[0] if root else None)


def proofs(made: Manifest) -> DataFrame:
    """Per leaf: tree, doc_id, pos, h, carried columns, subroot and its path to the root."""
    none = made.top.roots.select(
        "tree",
        F.lit(b"").alias("siblings"),
        F.array().cast("array<int>").alias("places"),
        F.array().cast("array<int>").alias("runs"),
    )
    upper = paths(made.top, none).select(
        F.col("source").alias("tree"), F.col("h").alias("subroot"), "siblings", "places", "runs"
    )
    return paths(made.sources, stored(upper, "subroot_paths"))


def folded(leaf: Column, siblings: Column, places: Column, runs: Column) -> Column:
    """The root (hex) that a leaf (hex) and its path give."""

    def part(start: Column, n: Column) -> Column:
        return told(F.substring(siblings, start * DIGEST + 1, n * DIGEST))

    def step(state: Column, level: Column) -> Column:
        place, rest = level["places"], level["runs"] - 1 - level["places"]
        joined = F.concat(
            part(state["used"], place), state["h"], part(state["used"] + place, rest)
        )
        return F.struct(
            F.sha2(joined, 256).alias("h"), (state["used"] + level["runs"] - 1).alias("used")
        )

    start = F.struct(leaf.alias("h"), F.lit(0).alias("used"))
    return F.aggregate(F.arrays_zip(places, runs), start, step, lambda state: state["h"])
