"""Byte-level BPE by monoid tree reduction.

The pattern cuts a text into pieces, and merges never cross a piece. A piece longer
than ``LEAF`` bytes is halved; the halves are encoded, and joined: the last tokens
of the left and the first of the right are encoded anew as one window, which grows
until its first and last tokens are compatible with the tokens next to them. Two
tokens are compatible if encoding their bytes together gives just the two. A
sequence of tokens is the encoding of its bytes exactly if all its neighbours are
compatible: a merge across a border would have to start at two neighbours, and
what decides on it is the two tokens alone. So the tokens outside the window stay
what they were, and the joined sequence is the encoding. A long piece thus takes
about n log n steps, where plain merging takes n squared.

Decoding concatenates the bytes of tokens up the same tree.

A null or empty text has no tokens. Every text is encoded whole, however long. A
repeated row, or a repeated or missing id, is a row like any other; an empty table gives
none; columns beside doc_id and text are left out. Each worker remembers the encodings of
distinct pieces, up to ``REMEMBERED``, which changes the speed and no result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF, LONGEST_RUN = 6, 64  # bytes encoded at once; tokens decoded at once
REMEMBERED = 100_000


class Remembered(dict):
    """Results by argument, made when first asked for.

    What is in use stays: once ``REMEMBERED`` are held they become the older half, from which
    those asked for again come back; the former older half goes.
    """

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = made
        return made


class Tokenizer:
    """Ranks of merged byte strings and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pattern = regex.compile(pattern)
        # What two neighbours merge into, for every way to cut a token into two tokens.
        self.merged = {
            (left, right): rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None
            and (right := ranks.get(token[cut:])) is not None
        }
        self.windows = Remembered(self.merge)
        self.neighbours = Remembered(self._compatible)
        self.pieces = Remembered(self._round_trip_piece)

    def merge(self, data: bytes) -> list[int]:
        """Plain merging, lowest rank first and leftmost among equals."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > 2 * LONGEST_RUN:
            return self._merge_long(data)
        merged, none = self.merged.get, len(self.ranks) + (1 << 30)
        parts = [self.single[b] for b in data]
        found = [merged(two, none) for two in pairwise(parts)]
        while found and (best := min(found)) != none:
            at = found.index(best)
            parts[at : at + 2] = [best]
            del found[at]
            if at < len(found):
                found[at] = merged((best, parts[at + 1]), none)
            if at:
                found[at - 1] = merged((parts[at - 1], best), none)
        return parts

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for a large window, with a heap: part [i, ends[i]) starts at i."""
        ranks, n = self.ranks, len(data)
        ends, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or ends[middle] != end:
                continue  # one of the two has been merged since
            ends[i], ends[middle] = end, 0
            if end < n:
                previous[end] = i
                if (r := ranks.get(data[i : ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end]))
            if (before := previous[i]) >= 0 and (r := ranks.get(data[before:end])) is not None:
                heapq.heappush(heap, (r, before, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : ends[i]]])
            i = ends[i]
        return out

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.tokens[pair[0]] + self.tokens[pair[1]]) == [*pair]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` and ``right``, both encodings."""
        neighbours = self.neighbours
        if not left or not right or neighbours[left[-1], right[0]]:
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.decode(left[-i:] + right[:j])
            middle = self.windows[window] if len(window) <= 4 * LEAF else self.merge(window)
            grow_left = i < len(left) and not neighbours[left[-i - 1], middle[0]]
            grow_right = j < len(right) and not neighbours[middle[-1], right[j]]
            if not grow_left and not grow_right:
                return left[:-i] + middle + right[j:]
            i, j = i + i * grow_left, j + j * grow_right

    def encode_piece(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.windows[data]
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) > LONGEST_RUN:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join([self.tokens[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def _round_trip_piece(self, piece: str) -> tuple[str, bytes]:
        ids = self.encode_piece(piece.encode())
        return " ".join(map(str, ids)), self.decode(ids)

    def round_trip(self, text: str) -> tuple[str, int, bytes]:
        """Ids as decimal numbers joined by a space, their number, the decoded bytes."""
        pieces = self.pattern.findall(text)
        if not pieces:
            return "", 0, b""
        parts = [self.pieces[p] if len(p) <= LONGEST_RUN else self._round_trip_piece(p) for p in pieces]
        texts, decoded = zip(*parts, strict=True)
        ids = " ".join(texts)
        return ids, ids.count(" ") + 1, b"".join(decoded)


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Tokenizer:
    """A rank file: per line a token in base 64 and its rank. Kept by the worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Tokenizer(ranks, pattern)


def _batches(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = [tokenizer.round_trip(t.as_py() or "") for t in part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([n for _, n, _ in done], pa.int64()),
                        pa.array([ids for ids, _, _ in done], pa.string()),
                        pa.array([data for _, _, data in done], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (decimal, joined by a space), decoded (bytes).

    ``path`` is a rank file that every executor has; the default is that of the
    installed vocabularies.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(
        _batches(path, pattern), "doc_id bigint, n_tokens bigint, ids string, decoded binary"
    )
