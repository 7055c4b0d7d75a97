"""Exact deduplication with a split for heavy hitters.

Texts are equal when they are after every run of white space became one space;
null counts as empty. Groups are formed on the SHA-256 of that text.

Misra-Gries summaries of the digests are made per partition and merged; the best
``counters`` of them are certain to hold every digest that more than
``2 / (counters + 1)`` of the rows share. Exact counts verify which ones do; these
winners, at most ``(counters + 1) / 2``, are broadcast, so that their rows are
settled and removed where they lie. The remaining digests, none of them frequent,
are grouped by an ordinary shuffle.

The row with the smallest id of a group stays; a missing id is after all others.
Of rows repeated with id and text one stays.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

WHITE = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def merged(counts: Counter, k: int) -> Counter:
    """A Misra-Gries summary of ``k`` counters from any number of counts."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({digest: n - cut for digest, n in counts.items() if n > cut})


def _summaries(k: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            for digest, n in zip(*(batch[c].to_pylist() for c in ("digest", "copies")), strict=True):
                kept[digest] += n
            kept = merged(kept, k)
        yield pa.RecordBatch.from_pydict(
            {
                "digest": pa.array(list(kept), pa.binary()),
                "low": pa.array(list(kept.values()), pa.int64()),
            }
        )

    return summarise


def frequent(digests: DataFrame, counters: int) -> DataFrame:
    """Group size and smallest id of the digests that many rows share, counted exactly."""
    total = digests.agg(F.sum("copies")).first()[0] or 0
    low = digests.select("digest", "copies").mapInArrow(
        _summaries(counters), "digest binary, low bigint"
    )
    best = (
        low.groupBy("digest")
        .agg(F.sum("low").alias("low"))
        .orderBy(F.desc("low"), "digest")
        .limit(counters)
        .select("digest")
    )
    found = digests.join(F.broadcast(best), "digest")
    return _groups(found).filter(F.col("group_size") * (counters + 1) > 2 * total)


def _groups(digests: DataFrame) -> DataFrame:
    return digests.groupBy("digest").agg(
        F.sum("copies").alias("group_size"), F.min("doc_id").alias("keep_id")
    )


def grouped(docs: DataFrame, counters: int = 1023) -> DataFrame:
    """One row per distinct (doc_id, digest): copies, keep_id, group_size."""
    digests = stored(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), digest_of(F.col("text")).alias("digest")
        )
        .groupBy("doc_id", "digest")
        .agg(F.count(F.lit(1)).alias("copies")),
        "digests",
    )
    winners = stored(frequent(digests, counters), "winners")
    heavy = digests.join(F.broadcast(winners), "digest")
    light = digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return heavy.unionByName(light.join(_groups(light), "digest"))


def exact_groups(docs: DataFrame, counters: int = 1023) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return grouped(docs, counters).select("*", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, counters: int = 1023) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Usually few rows go: their ids are stored, so that Spark knows their size and
    broadcasts them when they are few.
    """
    groups = stored(grouped(docs, counters), "groups")
    ours, theirs = F.col("_row.doc_id").cast("bigint"), F.col("_id")
    same = ours.eqNullSafe(theirs) & (F.col("_row_digest") == F.col("_digest"))

    def chosen(condition: Column, label: str) -> DataFrame:
        rows = groups.filter(condition).select(
            F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")
        )
        return stored(rows, label)

    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = chosen(~stays, "copies")
    rows = docs.select(F.struct("*").alias("_row"), digest_of(F.col("text")).alias("_row_digest"))
    left = rows.join(gone, same, "left_anti")
    repeated = chosen(stays & (F.col("copies") > 1), "repeated")
    if not repeated.isEmpty():
        once = (
            left.join(repeated, same, "left_semi")
            .groupBy(ours.alias("_id"), "_row_digest")
            .agg(F.first("_row").alias("_row"))
            .select("_row")
        )
        left = left.join(repeated, same, "left_anti").select("_row").unionByName(once)
    return left.select("_row.*")
