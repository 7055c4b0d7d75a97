"""Near duplicates: banded MinHash, odd sketches, exact confirmation.

A document's set holds the hashes of its distinct ``SHINGLE``-word sequences, with
A-Z lower-cased. Documents with equal sets form a class; only classes go on, so a
large group of copies is one row.

* *Signatures.* ``PERMUTATIONS`` minima; the first ones are cut into ``BANDS``
  bands of ``ROWS``. A pair of similarity 0.75 shares a band except with probability
  5e-6, one of 0.8 except with 5e-8.
* *Odd sketches.* Each (permutation, minimum) flips one of ``BITS`` bits. The XOR
  of two sketches has a bit set where an odd number of samples differ, and its
  population count estimates the similarity: 1 + n / 4k * ln(1 - 2x / n). At 0.75
  the estimate strays by 0.029; pairs estimated below ``LEAST_ESTIMATE`` are dropped.
* *Confirmation.* The full sets of the remaining pairs are intersected.

* *Clusters.* The classes of a bucket are tied to its least class; buckets of the same
  members are one. What the ties connect, by ids alone, is a cluster: no pair that shares
  a band leaves it. Clusters are cut into blocks of about 2048 classes, and every two
  blocks meet in a task, where classes of different components are compared by sketch
  and, if that allows a link, by full set. Only links that connect something leave the task.
* *Wide clusters*, those of more blocks than their classes have buckets, are taken by
  their buckets: the ties are verified first, which connects a group of N near copies by
  about N pairs; then buckets that still hold several components are cut into blocks.

So no link between components is missed for want of a comparison, and no bucket is squared
into rows. What is left to chance is the bands and the sketch's estimate; with
``least_estimate`` 0 no pair is dropped by its sketch, and every pair of a cluster that is
not connected yet is compared by full sets.

Null and empty texts have an empty set and are linked with nothing; a text shorter than a
shingle is one shingle. Long texts are taken whole. Repeated rows share a class. A missing
id is larger than any other. An empty table has no rows; :func:`drop_near_duplicates`
keeps all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import Words, chunked_words, mix, stored
from skyledger.llm.ngram_join import BLOCK, BLOCK_KEY, clusters_of, components, sorted_groups

SHINGLE = 5
PERMUTATIONS, BANDS, ROWS, BITS = 256, 32, 4, 1024
LEAST_PERCENT, LEAST_ESTIMATE = 75, 0.62
_seeds = np.random.default_rng(20240229)
FACTORS = _seeds.integers(0, 1 << 32, PERMUTATIONS, np.uint32) | np.uint32(1)
SHIFTS = _seeds.integers(0, 1 << 32, PERMUTATIONS, np.uint32)

SIGNED = "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>, sketch array<bigint>"


def shingles(words: Words) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a chunk."""
    hashes, counts = words.hashes(), words.counts()
    grams = words.grams(hashes, SHINGLE)
    out = []
    for first, n in zip(words.first.tolist(), counts.tolist(), strict=False):
        if n >= SHINGLE:
            out.append(np.unique(grams[first : first + n - SHINGLE + 1]))
        else:
            out.append(words.grams(hashes[first : first + n], n) if n else hashes[:0])
    return out


def class_key(values: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    keys = (np.uint64(0x51_7C_C1_B7_27_22_0A_95), np.uint64(0x2545F4914F6CDD1D))
    return b"".join(np.sum(mix(values ^ k), dtype=np.uint64).tobytes() for k in keys)


def minima(values: np.ndarray) -> np.ndarray:
    low = (values >> np.uint64(16)).astype(np.uint32)
    out = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 512):  # a slice that stays in the cache
        part = low[k : k + 512, None] * FACTORS + SHIFTS
        np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """One key per text and band; a key holds its band's number."""
    rows = mins[:, : BANDS * ROWS].astype(np.uint64).reshape(len(mins), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        key = mix(key ^ rows[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """Per text ``BITS`` parity bits as 64-bit words."""
    number = np.arange(PERMUTATIONS, dtype=np.uint64) << np.uint64(32)
    bit = (mix(mins.astype(np.uint64) | number) % np.uint64(BITS)).astype(np.int64)
    at = np.arange(len(mins))[:, None] * BITS + bit
    odd = (np.bincount(at.ravel(), minlength=len(mins) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(mins), BITS), axis=1).view(np.int64)


def _lists(rows: np.ndarray, empty: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    made = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
    return pc.if_else(pa.array(empty), pa.scalar(None, made.type), made)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, words in chunked_words(batch["text"], lower=True):
            sets = shingles(words)
            sizes = np.array([len(s) for s in sets], np.int64)
            mins = np.stack([minima(s) for s in sets])
            keys = [class_key(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].slice(lo, hi - lo),
                    pa.array(sizes),
                    pa.array(keys, pa.binary()),
                    _lists(band_keys(mins), sizes == 0),
                    _lists(odd_sketches(mins), sizes == 0),
                ],
                names=["doc_id", "n_shingles", "class", "bands", "sketch"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in chunked_words(batch["text"], lower=True):
            sets = [s for s in shingles(words) if len(s)]
            if sets:
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                grams = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(sets).view(np.int64))
                )
                keys = pa.array([class_key(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, grams], names=["key", "grams"])


def most_flips(least_estimate: float) -> int:
    """How many bits may differ for the estimate to be at least ``least_estimate``."""
    if least_estimate <= 0:
        return BITS
    return int(BITS / 2 * (1 - np.exp((least_estimate - 1) * 4 * PERMUTATIONS / BITS)))


def linked(both, one, two):
    """Whether sets of ``one`` and ``two`` shingles link if they share ``both``."""
    return 100 * both >= LEAST_PERCENT * (one + two - both)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def _sets_of(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(key, grams) of the classes in ``wanted``, made anew from one text of each."""
    ids = classes.join(wanted.select("class"), "class", "left_semi").select("min_id").distinct()
    texts = _rows(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("min_id")), "left_semi")
    # An id that is not unique also brings other texts, or its own several times.
    sets = texts.mapInArrow(_full_sets, "key binary, grams array<bigint>")
    return sets.groupBy("key").agg(F.first("grams").alias("grams"))


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, other, class, star, n): the members of buckets of two or more classes.

    A bucket is named by 128 bits of its members; ``star`` is its least class.
    """
    members = classes.select("class", F.explode("bands").alias("band"))
    crowded = (
        members.groupBy("band")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("class").alias("star"),
            F.bit_xor(F.xxhash64("class")).alias("bucket"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("other"),
        )
        .filter("n > 1")
    )
    one = crowded.groupBy("bucket", "other", "n", "star").agg(F.min("band").alias("band"))
    return members.join(one, "band").select("bucket", "other", "class", "star", "n")


def links_of_block(
    one: np.ndarray,
    two: np.ndarray,
    sketch: np.ndarray,
    grams: list[np.ndarray],
    component: np.ndarray,
    flips: int,
) -> list[tuple[int, int]]:
    """Links that connect different components among rows ``one`` and ``two`` of a block.

    ``two`` is ``one`` itself for a block on the diagonal. A row is compared with those
    that are not connected with it by then.
    """
    sizes = np.array([len(g) for g in grams], np.int64)
    label = np.unique(component, return_inverse=True)[1]
    found = []
    for k, x in enumerate(one.tolist()):
        rest = two[k + 1 :] if two is one else two
        rest = rest[label[rest] != label[x]]
        rest = rest[linked(np.minimum(sizes[rest], sizes[x]), sizes[rest], sizes[x])]
        near = np.bitwise_count(sketch[rest] ^ sketch[x]).sum(axis=1) <= flips
        for y in rest[near].tolist():
            if label[x] != label[y]:
                both = len(np.intersect1d(grams[x], grams[y], assume_unique=True))
                if linked(both, sizes[x], sizes[y]):
                    label[label == label[x]] = label[y]
                    found.append((x, y))
    return found


def _links(flips: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, BLOCK_KEY):
            chunk, low, high = (table[c].to_numpy() for c in ("chunk", "low", "high"))
            one, two = np.flatnonzero(chunk == low[0]), np.flatnonzero(chunk == high[0])
            sketch = pc.list_flatten(table["sketch"]).to_numpy().view(np.uint64).reshape(len(chunk), -1)
            ends = np.cumsum(pc.list_value_length(table["grams"]).to_numpy().astype(np.int64))
            grams = np.split(pc.list_flatten(table["grams"]).to_numpy(), ends[:-1])
            two = one if low[0] == high[0] else two
            found = links_of_block(one, two, sketch, grams, table["component"].to_numpy(), flips)
            pairs = np.sort(table["class"].to_numpy()[np.array(found, np.int64).reshape(-1, 2)], axis=1)
            columns = [pa.array(pairs[:, k].copy()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


def _links_in_blocks(members: DataFrame, classes: DataFrame, sets: DataFrame, flips: int) -> DataFrame:
    """Links between components in groups of ``members``: bucket, other, class, component, blocks."""
    blocks = F.col("blocks")
    dealt = members.withColumns(
        {
            "chunk": F.pmod(F.xxhash64("class", F.lit(2)), blocks).cast("int"),
            "second": F.explode(F.sequence(F.lit(0), blocks - 1)),
        }
    )
    named = dealt.select(
        "bucket",
        "other",
        F.least("chunk", "second").alias("low"),
        F.greatest("chunk", "second").alias("high"),
        "chunk",
        "class",
        "component",
    ).join(classes.select("class", "key", "sketch"), "class")
    together = named.join(sets, "key").drop("key")
    together = together.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    return together.mapInArrow(_links(flips), "a bigint, b bigint").distinct()


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, flips: int) -> DataFrame:
    """Of ``pairs`` (a, b) the linked ones: by their sketches, then by the full sets."""
    known = classes.select("class", "sketch")
    apart = F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    likely = stored(
        pairs.join(known.toDF("a", "x"), "a")
        .join(known.toDF("b", "y"), "b")
        .filter(F.aggregate(apart, F.lit(0), lambda n, x: n + x) <= flips)
        .select("a", "b"),
        "likely",
    )
    met = likely.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    both = F.size(F.array_intersect("x", "y"))
    return stored(met.filter(linked(both, F.size("x"), F.size("y"))).select("a", "b"), "links")


def _links_of_buckets(buckets: DataFrame, classes: DataFrame, docs: DataFrame, flips: int) -> DataFrame:
    """Links of wide clusters: the ties first, then what is left in the buckets."""
    by_key = stored(_sets_of(buckets.select("class").distinct(), classes, docs), "wide_sets")
    sets = classes.select("class", "key").join(by_key, "key").select("class", "grams")
    pairs = buckets.filter("class != star").select(F.col("star").alias("a"), F.col("class").alias("b"))
    links = _confirmed(pairs.distinct(), classes, sets, flips)
    placed = buckets.join(components(links), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    open_ = (
        placed.groupBy("bucket", "other")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .filter("_low != _high")
        .select("bucket", "other")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    still = placed.filter("n > 2").join(open_, ["bucket", "other"]).withColumn("blocks", blocks)
    return links.unionByName(_links_in_blocks(still, classes, by_key, flips))


def _placed(classes: DataFrame, docs: DataFrame, flips: int) -> DataFrame:
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
    links = stored(_links_in_blocks(members, classes, _sets_of(members, classes, docs), flips), "links")
    wide = sizes.filter("wide").select("cluster")
    if not wide.isEmpty():
        within = stored(tied.join(wide, "cluster").select("class"), "wide")
        own = stored(buckets.join(within, "class", "left_semi"), "wide_buckets")
        links = stored(links.unionByName(_links_of_buckets(own, classes, docs, flips)), "links")
    return components(links)


def near_duplicates(docs: DataFrame, least_estimate: float = LEAST_ESTIMATE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class, component, component_id, kept."""
    signed = stored(_rows(docs).mapInArrow(_sign, SIGNED), "signed")
    classes = stored(
        signed.filter(F.col("class").isNotNull())
        .groupBy(F.col("class").alias("key"))
        .agg(
            F.min("doc_id").alias("min_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    found = _placed(classes, docs, most_flips(least_estimate))
    placed = classes.select("class", "key", "min_id").join(found, "class", "left").select(
        "key", "min_id", F.coalesce("component", "class").alias("component")
    )
    least = placed.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = placed.join(least, "component").select(F.col("key").alias("class"), "component", "component_id")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "class")
        .join(named, "class", "left")
        .select("doc_id", "n_shingles", "class", "component", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component."""
    gone = stored(
        near_duplicates(docs)
        .groupBy("doc_id")
        .agg(F.bool_or("kept").alias("kept"))
        .filter("not kept")
        .select(F.col("doc_id").alias("_gone")),
        "near_copies",
    )
    rows = docs.select(F.struct("*").alias("_row"))
    same = F.col("_row.doc_id").cast("bigint").eqNullSafe(F.col("_gone"))
    return rows.join(gone, same, "left_anti").select("_row.*")
