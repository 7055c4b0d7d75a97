"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources in code point order, null last, weigh 5, 2, 1, repeating. They share
``share`` (1.5) times all words by weight; a source's target stops at ``most`` (2)
times its own size and the excess is shared again by weight among the others.

Targets are met in blocks of ``block_words`` words. The sources get whole blocks
by the highest quotients target / (2k - 1); each source's blocks are dealt to its
shards in the same way, by shard size. A shard holds the documents of one source
with one value of a hash of their id, about ``shard_words`` words, so a large
source is many shards. In a shard the documents follow one another in an order
drawn from ``seed``; its first blocks are the selection, and where the quota is
larger than the shard a second round begins. So nearly all documents are taken
whole, once or twice, and no document more than twice.

A text without words, or null, has size 0. Rows with equal id, source and text
stand next to one another as copies of one document. Long texts are counted whole.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

WHITE = "[\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
BROADCAST_SOURCES = 20_000  # with the sums below at most a few MB


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), WHITE), "")


def sainte_lague(targets: np.ndarray, most: np.ndarray, seats: int) -> np.ndarray:
    """Seats by the highest quotients target / (2k - 1), at most ``most`` each.

    All but about two seats per candidate are given at once: with the divisor
    total / seats each has at least its share less one.
    """
    targets = np.asarray(targets, float)
    most = np.asarray(most, np.int64)
    seats = min(int(seats), int(most[targets > 0].sum()))
    total = targets.sum()
    given = np.zeros(len(targets), np.int64)
    if total > 0 and seats > 0:
        sure = np.floor(targets * (seats / total)).astype(np.int64) - 1
        given = np.clip(sure, 0, most)
    quotients = [
        (-t / (2 * int(n) + 1), k)
        for k, (t, n, top) in enumerate(zip(targets, given, most, strict=True))
        if t > 0 and n < top
    ]
    heapq.heapify(quotients)
    for _ in range(seats - int(given.sum())):
        _, k = heapq.heappop(quotients)
        given[k] += 1
        if given[k] < most[k]:
            heapq.heappush(quotients, (-targets[k] / (2 * int(given[k]) + 1), k))
    return given


def with_targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with the weight and the target of each source.

    One row per source: the windows without a key hold aggregated rows only. The
    level is the words per unit of weight at which the targets add up to the share.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    )
    everything = Window.partitionBy()
    cap = F.col("source_size") * F.lit(most)
    ratio = F.col("_cap") / F.col("weight")
    before = Window.orderBy("_ratio", "_n").rowsBetween(Window.unboundedPreceding, -1)
    spread = (
        sources.withColumn("weight", weight)
        .withColumn("_n", F.row_number().over(order))
        .withColumn("_cap", cap)
        .withColumn("_ratio", ratio)
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn(
            "_weight",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
        .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_weight"))
    )
    # Capping a source whose cap lies below the level raises the level for the rest,
    # capping one above would lower it: the right number of capped ones has the highest.
    level = F.max("_level").over(everything)
    target = F.least("_cap", level * F.col("weight"))
    return spread.withColumn("target", target).select("source", "source_size", "weight", "target")


def _allotted(block_words: int, most: float):
    def allot(rows: pd.DataFrame) -> pd.DataFrame:
        top = np.ceil(rows["source_size"] / block_words).astype("int64") * int(most)
        seats = round(rows["target"].sum() / block_words)
        rows["blocks"] = sainte_lague(rows["target"].to_numpy(), top.to_numpy(), seats)
        return rows[["source", "source_size", "target", "blocks"]]

    return allot


def _dealt(block_words: int, most: float):
    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        top = np.ceil(rows["shard_size"] / block_words).astype("int64") * int(most)
        rows["quota"] = sainte_lague(
            rows["shard_size"].to_numpy(), top.to_numpy(), rows["blocks"].iloc[0]
        )
        return rows[["source", "shard", "quota", "shard_size"]]

    return deal


def mix(
    docs: DataFrame,
    seed: int = 17,
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 32,
    shard_words: int = 1 << 20,
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, digest, size, source_size, target, first, second.

    ``first`` and ``second`` are the words taken in the two rounds, from the start
    of the text; ``digest`` tells texts of one id apart.
    """
    sizes = stored(
        keyed(docs)
        .groupBy("doc_id", "source", "digest")
        .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("copies")),
        "sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    blocks = stored(
        with_targets(totals, share, most)
        .groupBy()
        .applyInPandas(
            _allotted(block_words, most),
            "source string, source_size bigint, target double, blocks bigint",
        ),
        "blocks",
    )
    few = blocks.count() <= BROADCAST_SOURCES
    per_source = blocks.withColumnRenamed("source", "_s").withColumn(
        "_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    )
    placed = sizes.join(
        F.broadcast(per_source) if few else per_source, F.col("_s").eqNullSafe(F.col("source"))
    ).withColumn("shard", F.pmod(F.xxhash64("doc_id", "digest", F.lit(seed)), F.col("_shards")))
    span = F.col("size") * F.col("copies")
    shards = placed.groupBy("source", "shard", "blocks").agg(F.sum(span).alias("shard_size"))
    quotas = (
        shards.groupBy("source")
        .applyInPandas(
            _dealt(block_words, most),
            "source string, shard bigint, quota bigint, shard_size bigint",
        )
        .withColumnsRenamed({"source": "_q", "shard": "_h"})
    )
    order = Window.partitionBy("source", "shard").orderBy(
        F.xxhash64(F.lit(seed), "doc_id", "digest"), "doc_id", "digest"
    )
    before = F.sum(span).over(order.rowsBetween(Window.unboundedPreceding, 0)) - span
    copy = F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))
    lined = (
        placed.withColumn("_before", before)
        .join(quotas, F.col("_q").eqNullSafe(F.col("source")) & (F.col("_h") == F.col("shard")))
        .withColumn("_copy", copy)
    )
    here = F.col("quota") * block_words - F.col("_before") - F.col("_copy") * F.col("size")

    def taken(words: Column) -> Column:
        return F.greatest(F.least(words, "size"), F.lit(0)).cast("bigint")

    return lined.select(
        "doc_id",
        "source",
        "digest",
        "size",
        "source_size",
        "target",
        taken(here).alias("first"),
        taken(here - F.col("shard_size")).alias("second"),
    )


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("digest"),
        F.size(words_of(text)).cast("bigint").alias("size"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time a text is taken.

    Texts taken whole stay as they are; of the one at the end of a selection the
    words taken are joined by a space. ``n_chars``, where there is one, is counted
    anew for those. Other columns are kept, whatever their names; texts without words are
    not taken; an empty table gives an empty mix.
    """
    each = F.explode(F.array("first", "second")).alias("_words")
    plan = (
        mix(docs, **options)
        .select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                F.col("digest").alias("_digest"), "size", each)
        .filter("_words > 0")
        .groupBy("_id", "_source", "_digest", "size")
        .agg(F.collect_list("_words").alias("_pieces"))
    )  # one row per document: two pieces, or two for each copy of a repeated row
    rows = docs.select(F.struct("*").alias("_row"))  # whatever its columns are called
    if _repeats(docs):
        rows = rows.groupBy("_row").agg(F.lit(1).alias("_1")).drop("_1")
    own = {name: F.col("_row").getField(name) for name in docs.columns}
    text = own["text"].cast("string")
    met = rows.join(
        plan,
        own["doc_id"].cast("bigint").eqNullSafe(F.col("_id"))
        & own["source"].cast("string").eqNullSafe(F.col("_source"))
        & (F.xxhash64(text) == F.col("_digest")),
    ).select("_row", "size", F.explode("_pieces").alias("_words"))
    part = F.array_join(F.slice(words_of(text), 1, F.col("_words").cast("int")), " ")
    whole = F.col("_words") == F.col("size")
    own["text"] = F.when(whole, own["text"]).otherwise(part)
    if "n_chars" in own:
        count = F.char_length(part).cast(docs.schema["n_chars"].dataType)
        own["n_chars"] = F.when(whole, own["n_chars"]).otherwise(count)
    return met.select(*[column.alias(name) for name, column in own.items()])


def _repeats(docs: DataFrame) -> bool:
    """Whether a row occurs twice (id, source and text)."""
    copies = keyed(docs).groupBy("doc_id", "source", "digest").count()
    return not copies.filter("count > 1").isEmpty()
