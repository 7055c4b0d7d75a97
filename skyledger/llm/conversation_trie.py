"""Prefix trie of conversations: union-find over LCP edges, partition forests merged.

A turn is 16 bytes of a digest of its role and text, and its text's length in code
points; a conversation is the string of its turns. Equal conversations are one row
before anything is sorted, so a large group of copies costs its ids only.

* *Sorted blocks.* Distinct strings are sorted by ranges and cut into blocks of at most
  ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` bytes. A block knows the string before its
  first and after its last; across partitions these come from a table of the
  partitions' ends.
* *Union-find.* Neighbours share a longest common prefix. These edges are taken in
  descending depth; a merge of two components makes the branching node of that depth,
  or hangs one component below the other's top if that lies at this depth already.
* *Contraction.* A node that the block shares with a neighbour is open: the block gives
  only sums for it. Every figure of a node is a sum (or minimum) over blocks, for which
  a node is counted as new by the first block that holds it; so one aggregation merges
  the open nodes of all blocks. Other nodes are final at once.

Members' ids are hashed in ascending order as a stream over sorted rows; a group of
copies of any size needs no more memory than a batch.

Turns are ordered by turn (null first), then role, then text's digest; null role or text is
empty. Turns without conv_id belong to no conversation and are left out. Repeated
rows are repeated turns. Very long texts are hashed in the scan and go no further.
An empty table gives no node, not even a root. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

MARK, UNIT = 16, 20  # bytes of a turn's digest, and with the length of its text
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 20
NO_MEMBERS = sha256(b"").hexdigest()
ROOT = sha256(b"").digest()[:MARK]

BLOCK = (
    "part int, seq bigint, last boolean, keys array<binary>, ids array<bigint>, counts array<bigint>, "
    "ends array<string>, before binary, after binary"
)
NODE = (
    "block bigint, node binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)
ARROW = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def turn_key(role: Column, text: Column) -> Column:
    """``UNIT`` bytes that stand for a turn."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    length = F.lpad(F.hex(F.char_length(text)), 2 * (UNIT - MARK), "0")
    return F.unhex(F.concat(F.substring(F.sha2(told, 256), 1, 2 * MARK), length))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            turn_key(F.col("role"), F.col("text")).alias("key"),
        ).alias("turn"),
    )
    told = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(told["key"].alias("turns"))


def _joined(turns: Column) -> Column:
    return F.unhex(F.array_join(F.transform(turns, F.hex), ""))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, ends) from rows sorted by class and id, an unfinished group at a time."""

    def row(group: bytes, digest) -> pa.RecordBatch:
        columns = [pa.array([group], pa.binary()), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=["class", "ends"])

    group, digest = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch["class"])
        ids, at = batch["conv_id"].cast(pa.string()).to_pylist(), 0
        for found, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
            told = ",".join(ids[at:end]).encode()
            if found == group:
                digest.update(b"," + told)
            else:
                if digest is not None:
                    yield row(group, digest)
                group, digest = found, sha256(told)
            at = end
    if digest is not None:
        yield row(group, digest)


def _blocks(most_rows: int):
    """Sorted rows of a partition as blocks; each knows its neighbours in the partition."""
    names = ["keys", "ids", "counts", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, before, seq, part = None, None, 0, None

        def row(columns: list[list], after: bytes | None) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            data = [pa.array([c], pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]
            ends = [pa.array([x], pa.binary()) for x in (before, after)]
            place = [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([after is None])]
            return pa.RecordBatch.from_arrays(
                [*place, *data, *ends], names=["part", "seq", "last", *names, "before", "after"]
            )

        for batch in batches:
            at = 0
            sizes = np.cumsum(pc.binary_length(batch["key"]).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < batch.num_rows:
                used = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, used + BLOCK_BYTES, "right")))
                to = min(to, at + most_rows, batch.num_rows)
                piece = batch.slice(at, to - at)
                columns = [piece[c].to_pylist() for c in ("key", "conv_id", "n", "ends")]
                if waiting is not None:
                    yield row(waiting, columns[0][0])
                    before, seq = waiting[0][-1], seq + 1
                waiting, part, at = columns, piece["part"][0].as_py(), to
        if waiting is not None:
            yield row(waiting, None)

    return run


def shared(a: bytes, b: bytes) -> int:
    """Turns that two strings have in common at their start."""
    most = min(len(a), len(b)) // UNIT
    if a[: most * UNIT] == b[: most * UNIT]:
        return most
    low, high = 0, most
    while low < high:  # the first ``low`` agree, the first ``high`` do not
        middle = (low + high + 1) // 2
        if a[: middle * UNIT] == b[: middle * UNIT]:
            low = middle
        else:
            high = middle - 1
    return low


class Forest:
    """The compressed trie of sorted distinct strings.

    Node ``v`` covers the strings ``first[v]`` to ``last[v]`` and lies at ``depth[v]``;
    the first nodes are the strings themselves.
    """

    def __init__(self, depths: list[int], edges: list[int]):
        n = len(depths)
        self.depth = list(depths)
        self.first, self.last = list(range(n)), list(range(n))
        self.below: list[list[int]] = [[] for _ in range(n)]
        top, leader = list(range(n)), list(range(n))

        def find(i: int) -> int:
            while leader[i] != i:
                leader[i] = leader[leader[i]]
                i = leader[i]
            return i

        for i in np.argsort(-np.array(edges, np.int64), kind="stable").tolist():
            left, right, at = find(i), find(i + 1), edges[i]
            a, b = top[left], top[right]  # b lies deeper: its strings come after a's
            leader[right] = left
            if self.depth[a] != at:
                self.depth.append(at)
                self.first.append(self.first[a])
                self.last.append(self.last[a])
                self.below.append([a])
                a = top[left] = len(self.depth) - 1
            self.below[a].append(b)
            self.last[a] = self.last[b]
        self.root = top[find(0)] if n else None

    def upward(self) -> list[tuple[int, int]]:
        """(node, depth of its parent) with children before parents; -1 above the root."""
        order, stack = [], [(self.root, -1)]
        while stack:
            v, above = stack.pop()
            order.append((v, above))
            stack += [(w, self.depth[v]) for w in self.below[v]]
        return order[::-1]


def _prefixes(key: bytes, depth: int) -> list[bytes]:
    """Marks of the nodes at depths 0 to ``depth`` on the way to ``key``."""
    state, out = sha256(), [ROOT]
    for k in range(depth):
        state.update(key[k * UNIT : (k + 1) * UNIT])
        out.append(state.copy().digest()[:MARK])
    return out


def nodes_of(
    block: int,
    keys: list[bytes],
    ids: list[int],
    counts: list[int],
    ends: list[str],
    before: bytes | None,
    after: bytes | None,
) -> list[tuple]:
    """Rows of NODE for a block's nodes; ``node`` is null for a final node and ``parent``
    for a node whose parent is final."""
    n = len(keys)
    depths = [len(k) // UNIT for k in keys]
    edges = [shared(keys[i], keys[i + 1]) for i in range(n - 1)]
    open_left = -1 if before is None else shared(before, keys[0])
    open_right = -1 if after is None else shared(keys[-1], after)
    left, right = _prefixes(keys[0], open_left), _prefixes(keys[-1], open_right)
    childless = [f < d for f, d in zip([*edges, open_right], depths, strict=True)]
    convs, leaves = ([0, *accumulate(x)] for x in (counts, childless))
    forest, rows = Forest(depths, edges), []
    least, saved, top_row = {}, {}, {}
    for v, above in forest.upward():
        low, high, below, bottom = forest.first[v], forest.last[v], forest.below[v], forest.depth[v]
        n_convs, n_leaves = convs[high + 1] - convs[low], leaves[high + 1] - leaves[low]
        smallest = min([least[w] for w in below] + ids[v : v + 1] * (v < n))
        tokens = sum(saved[w] for w in below)
        # A child that the block before holds too has been counted as new there.
        new_children = sum(forest.first[w] > 0 or bottom >= open_left for w in below)
        children, ended = [top_row[w] for w in below], ends[v] if v < n else None
        for depth in range(bottom, above, -1):
            is_new = low > 0 or depth > open_left
            if depth:
                length = int.from_bytes(keys[low][depth * UNIT - UNIT + MARK : depth * UNIT], "big")
                tokens += (n_convs - is_new) * length
            node = None
            if low == 0 and depth <= open_left:
                node = left[depth]
            elif high == n - 1 and depth <= open_right:
                node = right[depth]
            for child in children:
                rows[child][2] = node
                rows[child][5] = None if node else smallest
            children = [len(rows)]
            rows.append(
                [block, node, None, depth, smallest, None, n_convs, new_children, n_leaves, tokens, ended]
            )
            new_children, ended = int(is_new), None
        least[v], saved[v], top_row[v] = smallest, tokens, children[0]
    return rows


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(c, ARROW[kind]) for c, kind in (column.split() for column in NODE.split(", "))]
    )
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            block = (row["part"] << 32) + row["seq"]
            found = nodes_of(block, *(row[c] for c in ("keys", "ids", "counts", "ends", "before", "after")))
            columns = zip(*found, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def distinct_turns(sequences: DataFrame) -> DataFrame:
    """(key, conv_id, n, ends): each distinct sequence of ``sequences`` (conv_id, turns)."""
    keyed = stored(
        sequences.select("conv_id", _joined(F.col("turns")).alias("key")).withColumn(
            "class", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * MARK))
        ),
        "sequences",
    )
    ends = (
        keyed.select("class", "conv_id")
        .repartition("class")
        .sortWithinPartitions("class", "conv_id")
        .mapInArrow(_ends, "class binary, ends string")
    )
    groups = keyed.groupBy("key", "class").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")
    )
    return groups.join(ends, "class").select("key", "conv_id", "n", "ends")


def sorted_blocks(classes: DataFrame) -> DataFrame:
    """``classes`` sorted and cut into blocks; each knows the strings around it."""
    blocks = stored(
        classes.repartitionByRange("key")
        .sortWithinPartitions("key")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(_blocks(BLOCK_ROWS), BLOCK),
        "blocks",
    )
    heads = blocks.filter("seq = 0").select("part", F.get("keys", F.lit(0)).alias("head"))
    tails = blocks.filter("last").select("part", F.element_at("keys", -1).alias("tail"))
    parts = Window.orderBy("part")  # as many rows as partitions
    around = heads.join(tails, "part").select(
        "part", F.lag("tail").over(parts).alias("_before"), F.lead("head").over(parts).alias("_after")
    )
    before = F.when(F.col("seq") == 0, F.col("_before")).otherwise(F.col("before"))
    after = F.when(F.col("last"), F.col("_after")).otherwise(F.col("after"))
    return blocks.join(around, "part").withColumns({"before": before, "after": after})


def trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie over ``sequences`` (conv_id, turns of :func:`turn_key`).

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    blocks = sorted_blocks(distinct_turns(sequences))
    wanted = ["part", "seq", "keys", "ids", "counts", "ends", "before", "after"]
    nodes = stored(blocks.select(*wanted).mapInArrow(_nodes, NODE), "nodes")
    shared_nodes = nodes.filter(F.col("node").isNotNull())
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = stored(
        shared_nodes.groupBy("node").agg(
            F.max("parent").alias("parent"),
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in sums),
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "merged",
    )
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", *sums]
    ends = F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256")
    final = nodes.filter(F.col("node").isNull())
    inside = final.filter(F.col("parent").isNull())
    # An open parent is looked up by block, so that a parent with many children is no hot key.
    of_block = shared_nodes.select("block", F.col("node").alias("parent")).join(parents, "parent")
    hanging = final.filter(F.col("parent").isNotNull()).drop("parent_conv_id")
    return (
        inside.select(*out, ends)
        .unionByName(hanging.join(of_block, ["block", "parent"]).select(*out, ends))
        .unionByName(merged.join(parents, "parent", "left").select(*out, ends))
    )
