"""Jaccard join of n-gram sets: count-vector R-trees over exact buckets.

A document's set holds its distinct ``SHINGLE``-word sequences, with A-Z lower-cased; two
documents link when 100 * intersection >= ``PERCENT`` * union. Documents with equal
sets form a class; only classes go on, so a large group of copies is one row.

* *Points.* Shingles are hashed into ``GROUPS`` groups; the numbers per group are the
  class's point. Two sets share at most the summed coordinate minima of their points.
* *Buckets.* If sets of a <= b shingles link, they differ in at most 3a/17 of them, and
  b <= 20a/17. Sizes are cut into bands of that ratio, and for a band whose pairs differ
  in at most D shingles the shingles are dealt to a few more than D groups: among the first D + 1
  groups that either set has shingles of, one must be the same in both. A class has a
  signature (the shingles of one group) for each of its first D + 1 groups, for its own
  band and for the one below. Where a set fills at most D groups, it adds its first
  D + 1 shingles in hash order, among which linked sets of this kind must share one.
  So every linked pair shares a bucket; nothing is left to chance.
* *Clusters.* Each class is tied to the least class of each of its buckets; what is tied
  together, by ids alone, is a cluster, and no link leaves a cluster. Clusters are cut into
  blocks of about ``BLOCK`` classes and ``SHINGLES`` shingles, and every two blocks meet
  in a task; most clusters are one block.
* *R-trees.* In the task the points are packed into R-trees, whose boxes (largest counts,
  least size) are descended in pairs as long as the bound allows a link. Surviving pairs
  of different components are verified on the full sets; only links leave the task.
* *Wide clusters*, those of more blocks than a class has buckets, are taken by their buckets:
  ties are verified first, which connects a group of near copies by a few pairs each.
  Then the buckets of three or more that still hold several components are cut into
  blocks instead of the cluster.

Every size is treated exactly: there is no cap. A pair bound for one component
needs no verification, which is why links are not counted: a group of N near copies has
N * N of them. A bucket of N classes that do not link costs N * N bounds, in blocks.

Shingles are compared by 64 bits, classes by 128. Null and empty texts have no shingles
and are linked with nothing; texts shorter than a shingle are one shingle. Long texts are
taken whole. Repeated rows share a class; a missing id is larger than any other. An
empty table has no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import Words, chunked_words, mix, stored

SHINGLE, PERCENT, GROUPS = 4, 85, 64
LEAF, FAN = 32, 8  # points in a leaf, boxes in a node
BLOCK, SHINGLES, SLICE = 2048, 1 << 22, 1 << 13

POINT = "doc_id bigint, n_shingles bigint, class binary, counts array<int>, signatures array<bigint>"
BLOCK_KEY = ["bucket", "other", "low", "high"]
_GROUP_SEED, _POINT_SEED, _ORDER_SEED = (
    np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
)


def _bands() -> tuple[np.ndarray, np.ndarray]:
    """Least size of each band, and how many shingles its linked pairs may differ in."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(20 * starts[-1] // 17 + 1)
    starts = np.array(starts, np.int64)
    return starts[:-1], 3 * (starts[1:] - 1) // 17


BAND_STARTS, BAND_DIFFERENCES = _bands()


def shingle_sets(words: Words) -> list[tuple[np.ndarray, bytes | None]]:
    """Per text its sorted distinct shingle hashes and 128 bits that stand for the set."""
    hashes, others = words.hashes(), words.hashes(seed=1)
    grams, more = words.grams(hashes, SHINGLE), words.grams(others, SHINGLE)
    out = []
    for first, n in zip(words.first.tolist(), words.counts().tolist(), strict=False):
        if n >= SHINGLE:
            values, at = np.unique(grams[first : first + n - SHINGLE + 1], return_index=True)
            second = more[first + at]
        else:
            values = words.grams(hashes[first : first + n], n) if n else hashes[:0]
            second = words.grams(others[first : first + n], n) if n else hashes[:0]
        key = (np.sum(mix(x ^ _ORDER_SEED), dtype=np.uint64).tobytes() for x in (values, second))
        out.append((values, b"".join(key) if n else None))
    return out


def band_signatures(values: np.ndarray, sizes: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) for sets laid end to end in ``values``, one band for each set.

    A set's pairs in the band differ in no more shingles than the band allows, nor in
    more than 3/17 of its own.
    """
    most = np.where(band >= 0, BAND_DIFFERENCES[band], 0)
    least = np.minimum(most, 3 * sizes // 17)
    groups = np.where(most > 0, most + 3 + most // 16, 1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    base = np.concatenate([[0], np.cumsum(groups)])
    spread = mix(values ^ _GROUP_SEED)
    slot = base[owner] + (spread % groups[owner].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, slot, mix(spread ^ _ORDER_SEED))
    filled = np.bincount(slot, minlength=base[-1]) > 0
    of = np.repeat(np.arange(len(sizes)), groups)
    rank = np.cumsum(filled)
    rank -= np.concatenate([[0], rank])[base[:-1]][of]
    taken = np.flatnonzero(filled & (rank <= least[of] + 1) & (least[of] > 0))
    place = (taken - base[:-1][of[taken]]).astype(np.uint64) + (band[of[taken]].astype(np.uint64) << np.uint64(40))
    sets, signatures = [of[taken]], [mix(sums[taken] ^ mix(place ^ _GROUP_SEED))]
    n_filled = np.bincount(of[filled], minlength=len(sizes))
    ends, marks = np.cumsum(sizes), mix(band.astype(np.uint64) ^ _POINT_SEED)
    for k in np.flatnonzero((n_filled <= least) & (least > 0) & (sizes > 0)).tolist():
        few = np.sort(mix(values[ends[k] - sizes[k] : ends[k]] ^ _ORDER_SEED))[: least[k] + 1]
        sets.append(np.full(len(few), k))
        signatures.append(mix(few ^ marks[k]))
    return np.concatenate(sets), np.concatenate(signatures)


def signatures_of(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The signatures of each set, for its own band and for the one below."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    band = np.searchsorted(BAND_STARTS, sizes, "right") - 1
    found = [band_signatures(values, sizes, b) for b in (band, np.maximum(band - 1, -1))]
    owner = np.concatenate([o for o, _ in found])
    signature = np.concatenate([s for _, s in found]).view(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(sets)))
    return np.split(signature[order], cuts)


def points(sets: list[np.ndarray]) -> np.ndarray:
    """The numbers of shingles per group."""
    sizes = [len(s) for s in sets]
    group = mix(np.concatenate(sets) ^ _POINT_SEED) % np.uint64(GROUPS)
    slot = np.repeat(np.arange(len(sets)), sizes) * GROUPS + group.astype(np.int64)
    return np.bincount(slot, minlength=len(sets) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), kind))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, words in chunked_words(batch["text"], lower=True):
            sets, keys = map(list, zip(*shingle_sets(words), strict=True))
            columns = [
                batch["doc_id"].slice(lo, hi - lo),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                _lists(list(points(sets)), pa.int32()),
                _lists(signatures_of(sets), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "n_shingles", "class", "counts", "signatures"]
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in chunked_words(batch["text"], lower=True):
            sets, keys = map(list, zip(*shingle_sets(words), strict=True))
            sets = [s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), _lists(sets, pa.int64())], names=["key", "grams"]
            )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def linked(both, a, b):
    return 100 * both >= PERCENT * (a + b - both)


class CountTree:
    """A packed R-tree: levels of boxes, from the points up to one root."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        slabs = max(1, round((len(sizes) / LEAF) ** 0.5))
        slab = np.empty(len(sizes), np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(len(sizes)) * slabs // max(1, len(sizes))
        widest = np.argmax(counts.max(axis=0) - counts.min(axis=0))
        self.order = np.lexsort((counts[:, widest], slab))
        self.levels = [(counts[self.order], sizes[self.order], sizes[self.order])]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            most, low, high = self.levels[-1]
            cuts = np.arange(0, len(low), width)
            self.levels.append(
                (
                    np.maximum.reduceat(most, cuts),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                )
            )
            width = FAN

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``node``, child) one level below."""
        width = LEAF if level == 1 else FAN
        n = len(self.levels[level - 1][0])
        child = node[:, None] * width + np.arange(width)
        at = np.nonzero(child < n)
        return at[0], child[at]


def pairs_below(a: CountTree, b: CountTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points of two trees that the bound leaves, in the trees' own numbers.

    With the same tree twice, each pair comes once.
    """
    same = a is b

    def may_link(level_a: int, i: np.ndarray, level_b: int, j: np.ndarray) -> np.ndarray:
        (most_a, low_a, high_a), (most_b, low_b, high_b) = a.levels[level_a], b.levels[level_b]
        fits = (100 * high_a[i] >= PERCENT * low_b[j]) & (100 * high_b[j] >= PERCENT * low_a[i])
        if same and level_a == level_b:
            fits &= i < j if level_a == 0 else i <= j
        at = np.flatnonzero(fits)
        shared = np.minimum(most_a[i[at]], most_b[j[at]]).sum(axis=1)
        return at[linked(shared, low_a[i[at]], low_b[j[at]])]

    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        x, y, i, j = stack.pop()
        if len(i) > SLICE:
            half = len(i) // 2
            stack += [(x, y, i[:half], j[:half]), (x, y, i[half:], j[half:])]
            continue
        keep = may_link(x, i, y, j)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if x == y == 0:
            yield i, j
            continue
        # The taller side goes down, both of them at equal height.
        for k in range(0, len(i), 256):
            p, q = i[k : k + 256], j[k : k + 256]
            low_x, low_y = x, y
            if x >= y:
                at, p = a.children(x, p)
                q, low_x = q[at], x - 1
            if y >= x:
                at, q = b.children(y, q)
                p, low_y = p[at], y - 1
            stack.append((low_x, low_y, p, q))


def links_of_block(
    one: np.ndarray, two: np.ndarray, counts: np.ndarray, grams: list[np.ndarray], component: np.ndarray
) -> list[tuple[int, int]]:
    """Links that connect different components among rows ``one`` and ``two`` of a block.

    ``two`` is ``one`` itself for a block on the diagonal. Later links of components
    that an earlier link has connected are left out.
    """
    sizes = np.array([len(g) for g in grams], np.int64)
    label = np.unique(component, return_inverse=True)[1]
    first = CountTree(counts[one], sizes[one])
    second = first if two is one else CountTree(counts[two], sizes[two])
    sets: dict[int, set] = {}
    found = []

    def full(k: int) -> set:
        if k not in sets:
            sets[k] = set(grams[k].tolist())
        return sets[k]

    for i, j in pairs_below(first, second):
        i, j = one[first.order[i]], two[second.order[j]]
        apart = label[i] != label[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            if label[x] != label[y] and linked(len(full(x) & full(y)), sizes[x], sizes[y]):
                label[label == label[x]] = label[y]
                found.append((x, y))
    return found


def sorted_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, one group after another, from rows sorted by ``names``."""
    waiting, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch[c].to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in pairwise(cuts):
            key = tuple(keys[:, lo].tolist())
            if key != last and waiting:
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting = []
            waiting.append(batch.slice(lo, hi - lo))
            last = key
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _content(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Points and full sets of a group's rows."""
    counts = pc.list_flatten(table["counts"]).to_numpy().reshape(-1, GROUPS)
    ends = np.cumsum(pc.list_value_length(table["grams"]).to_numpy().astype(np.int64))
    return counts, np.split(pc.list_flatten(table["grams"]).to_numpy(), ends[:-1])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the blocks."""
    for table in sorted_groups(batches, BLOCK_KEY):
        chunk, low, high = (table[c].to_numpy() for c in ("chunk", "low", "high"))
        one, two = np.flatnonzero(chunk == low[0]), np.flatnonzero(chunk == high[0])
        if len(one) and len(two):
            two = one if low[0] == high[0] else two
            found = links_of_block(one, two, *_content(table), table["component"].to_numpy())
            names = table["class"].to_numpy()
            pairs = np.sort(names[np.array(found, np.int64).reshape(-1, 2)], axis=1)
            columns = [pa.array(pairs[:, k].copy()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, other, class, star, n): the members of buckets of two or more classes.

    A bucket is named by 128 bits of its members; ``star`` is its least class.
    """
    whole = Window.partitionBy("signature")
    members = classes.select("class", F.explode("signatures").alias("signature"))
    found = members.select(
        "class",
        F.count(F.lit(1)).over(whole).alias("n"),
        F.min("class").over(whole).alias("star"),
        F.bit_xor(F.xxhash64("class")).over(whole).alias("bucket"),
        F.bit_xor(F.xxhash64("class", F.lit(1))).over(whole).alias("other"),
    )
    return found.filter("n > 1").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) the linked ones: by the points' bound, then by the full sets."""
    known = classes.select("class", F.col("n_shingles").alias("n"), "counts")
    left, right = (known.toDF(x, f"n_{x}", f"counts_{x}") for x in ("a", "b"))
    least = F.zip_with("counts_a", "counts_b", lambda x, y: F.least(x, y))
    bound = F.aggregate(least, F.lit(0).cast("bigint"), lambda n, x: n + x)
    likely = stored(
        pairs.join(left, "a")
        .join(right, "b")
        .filter(linked(bound, F.col("n_a"), F.col("n_b")))
        .select("a", "b"),
        "likely",
    )
    met = likely.join(sets.toDF("a", "grams_a"), "a").join(sets.toDF("b", "grams_b"), "b")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    return stored(
        met.filter(linked(both, F.size("grams_a"), F.size("grams_b"))).select("a", "b"), "links"
    )


def components(links: DataFrame) -> DataFrame:
    """(class, component): the least class reachable, for every class with a link (a, b).

    Each round every class goes over to its least neighbour, and that to its own; the
    links are redrawn between what is left, at most half of the classes. So the rounds'
    work shrinks, and their maps are chained at the end.
    """
    maps = []
    while not links.isEmpty():
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy(F.col("a").alias("class")).agg(F.min("b").alias("near"))
        step = stored(near.select("class", F.least("class", "near").alias("to")), "steps")
        following = step.select(F.col("class").alias("to"), F.col("to").alias("far"))
        maps.append(stored(step.join(following, "to").select("class", F.col("far").alias("to")), "map"))
        of_a, of_b = (maps[-1].select(F.col("class").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        moved = links.join(of_a, "a").join(of_b, "b").filter("to_a != to_b")
        low, high = F.least("to_a", "to_b"), F.greatest("to_a", "to_b")
        links = stored(moved.select(low.alias("a"), high.alias("b")).distinct(), "links")
    if not maps:
        return links.select(F.col("a").alias("class"), F.col("b").alias("component"))
    found = maps.pop().withColumnRenamed("to", "component")
    while maps:
        upper = found.select(F.col("class").alias("to"), "component")
        found = maps.pop().join(upper, "to", "left").select("class", F.coalesce("component", "to").alias("component"))
    return stored(found, "components")


def _links_in_blocks(members: DataFrame, classes: DataFrame, grams: DataFrame) -> DataFrame:
    """Links between components in groups of ``members``: bucket, other, class, component, blocks.

    The full sets are moved twice: by key, to find their blocks, and to the blocks.
    """
    blocks = F.col("blocks")
    dealt = members.select(
        "bucket",
        "other",
        "class",
        "component",
        F.pmod(F.xxhash64("class", F.lit(2)), blocks).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_second"),
    )
    rows = dealt.withColumns(
        {"low": F.least("chunk", "_second"), "high": F.greatest("chunk", "_second")}
    ).drop("_second")
    named = rows.join(classes.select("class", "key", "counts"), "class")
    together = named.join(grams, "key").drop("key")
    together = together.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    return together.mapInArrow(_links, "a bigint, b bigint").distinct()


def _links_of_buckets(buckets: DataFrame, classes: DataFrame, grams: DataFrame) -> DataFrame:
    """Links that connect what is linked: the ties first, then what is left in the buckets."""
    sets = classes.select("class", "key").join(grams, "key").select("class", "grams")
    pairs = buckets.filter("class != star").select(F.col("star").alias("a"), F.col("class").alias("b"))
    links = _confirmed(pairs.distinct(), classes, sets)
    placed = buckets.join(components(links), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    open_ = (
        placed.filter("n > 2")
        .groupBy("bucket", "other")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .filter("_low != _high")
        .select("bucket", "other")
    )
    still = placed.filter("n > 2").join(open_, ["bucket", "other"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    return links.unionByName(_links_in_blocks(still.withColumn("blocks", blocks), classes, grams))


def clusters_of(buckets: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, cluster), and per cluster its blocks and whether it is wide."""
    ties = buckets.filter("class != star").select(F.col("star").alias("a"), F.col("class").alias("b"))
    tied = components(stored(ties.distinct(), "ties")).withColumnRenamed("component", "cluster")
    cost = buckets.groupBy("class").agg(F.sum(F.ceil(F.col("n") / BLOCK)).alias("rows"))
    known = tied.join(cost, "class").join(classes.select("class", "n_shingles"), "class")
    n = F.count(F.lit(1))
    blocks = F.ceil(F.greatest(n / BLOCK, F.sum("n_shingles") / SHINGLES)).cast("int")
    sizes = known.groupBy("cluster").agg(
        n.alias("n"), blocks.alias("blocks"), (n * blocks > F.greatest(n, F.sum("rows"))).alias("wide")
    )
    return tied, stored(sizes, "clusters")


def _placed(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(class, component) of the classes that are linked."""
    buckets = stored(_buckets(classes), "buckets")
    tied, sizes = clusters_of(buckets, classes)
    members = tied.join(sizes.filter("not wide"), "cluster").select(
        F.col("cluster").alias("bucket"),
        F.lit(0).cast("bigint").alias("other"),
        "class",
        F.col("class").alias("component"),
        "blocks",
    )
    links = stored(_links_in_blocks(members, classes, _grams_of(members, classes, docs)), "links")
    wide = sizes.filter("wide").select("cluster")
    if not wide.isEmpty():
        within = stored(tied.join(wide, "cluster").select("class"), "wide")
        own = stored(buckets.join(within, "class", "left_semi"), "wide_buckets")
        grams = stored(_grams_of(within, classes, docs), "wide_sets")
        links = stored(links.unionByName(_links_of_buckets(own, classes, grams)), "links")
    return components(links)


def _grams_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, grams) with the sets of the ``wanted`` classes, made anew from one text of each."""
    crowded = classes.join(wanted.select("class"), "class", "left_semi")
    ids = crowded.select("min_id").distinct()
    texts = _rows(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("min_id")), "left_semi")
    # An id that is not unique also brings other texts, or its own several times.
    sets = texts.mapInArrow(_full_sets, "key binary, grams array<bigint>")
    return sets.groupBy("key").agg(F.first("grams").alias("grams"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    signed = stored(_rows(docs).mapInArrow(_signed, POINT), "points")
    classes = stored(
        signed.filter(F.col("class").isNotNull())
        .groupBy(F.col("class").alias("key"))
        .agg(
            F.min("doc_id").alias("min_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("counts").alias("counts"),
            F.first("signatures").alias("signatures"),
        )
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    found = _placed(classes, docs)
    by_class = classes.select("class", "key", "min_id").join(found, "class", "left").select(
        "key", "min_id", F.coalesce("component", "class").alias("component")
    )
    least = by_class.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = by_class.join(least, "component").select(F.col("key").alias("class"), "component_id")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.select("doc_id", "n_shingles", "class").join(named, "class", "left").select(
        "doc_id", "n_shingles", own.alias("component_id")
    )
