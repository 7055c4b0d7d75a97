"""What the operators share: reading, scratch tables, words and their hashes.

Words and hashes are computed with numpy over the bytes of a whole Arrow column:
no Python object per word. White space is the six ASCII characters 0x20 and
0x09-0x0D, so words can be cut from UTF-8 without decoding it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import skyledger
from skyledger.session import scratch_path

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LAST = np.iinfo(np.int64).max  # stands for a missing doc_id: after all others
CHUNK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15
LONG_WORD = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers unless they find it by themselves."""
    root = Path(skyledger.__file__).resolve().parents[1]
    found = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(":") if p]
    if root in found or Path.cwd().resolve() == root or getattr(spark, "_skyledger_sent", 0):
        return
    packed = Path(tempfile.mkdtemp(prefix="skyledger-")) / "skyledger_package.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for file in (root / "skyledger").rglob("*.py"):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(packed))
    spark._skyledger_sent = 1


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: ends its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0]
    return total or 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of consecutive texts.

    ``starts`` and ``ends`` are byte positions in ``data``; words of text ``i`` are
    numbered ``first[i]`` to ``first[i + 1]``; its bytes are ``bounds[i]`` to
    ``bounds[i + 1]``.
    """

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def owner(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, length: int | None = None, seed: int = 0) -> np.ndarray:
        """64-bit hash of each word, or of its first ``length`` bytes.

        Eight bytes at a time are mixed into the state, for all words that have so many;
        words over ``LONG_WORD`` bytes are hashed one by one.
        """
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        sizes = ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        out = mix(sizes.astype(np.uint64) + np.uint64((seed + 1) * _BASE % (1 << 64)))
        live, done = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD)), 0
        while len(live):
            left = sizes[live] - done
            unused = 8 * np.maximum(8 - left, 0).astype(np.uint64)
            block = eight[self.starts[live] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> unused)
            out[live] = mix((out[live] ^ block) * np.uint64(_BASE))
            live, done = live[left > 8], done + 8
        for k in np.flatnonzero(sizes > LONG_WORD).tolist():
            word = self.data[self.starts[k] : ends[k]].tobytes()
            digest = blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little"))
            out[k] = int.from_bytes(digest.digest(), "little")
        return out

    def grams(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hash of ``size`` consecutive words for each first word, across texts too."""
        n = max(0, len(hashes) - size + 1)
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out *= np.uint64(_BASE)
            out += hashes[k : k + n]
        return mix(out)

    def gram_starts(self, size: int) -> np.ndarray:
        """Mask over :meth:`grams`: the window lies in one text."""
        n = max(0, len(self.starts) - size + 1)
        last = np.repeat(self.first[1:], self.counts())[:n]
        return np.arange(n) + size <= last


def columns_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), bounds


def chunked_words(
    column: pa.Array,
    lower: bool = False,
    space: np.ndarray = SPACE,
    chunk_bytes: int = CHUNK_BYTES,
) -> Iterator[tuple[int, int, Words]]:
    """Words of the texts ``lo`` to ``hi``, so many texts at a time as memory is meant for.

    A text is never cut: one longer than ``chunk_bytes`` is a chunk of its own.
    """
    data, bounds = columns_bytes(column)
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = int(np.searchsorted(bounds, bounds[lo] + chunk_bytes, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, words_of(data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo], lower, space)
        lo = hi


def words_of(data: np.ndarray, bounds: np.ndarray, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    if lower:
        data = LOWER[data]
    gap = space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[True], gap[:-1]]) if len(data) else gap
    after = np.concatenate([gap[1:], [True]]) if len(data) else gap
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(starts, bounds))


def ids_of(column: pa.Array) -> np.ndarray:
    """doc_id as int64, missing ones as LAST."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.int64()), LAST).to_numpy(zero_copy_only=False)


def pack(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions by shard, for the shards that occur."""
    order = np.argsort(shard, kind="stable")
    names, cuts = np.unique(shard[order], return_index=True)
    yield from zip(names.tolist(), np.split(order, cuts[1:]), strict=False)
