"""Substring deduplication: repeated passages found by sharded automata.

A window is ``window`` consecutive words. A word goes if a window covers it whose
sequence also starts in a document with a smaller id.

1. *Anchors.* Each window has one anchor, the smallest hash of the ``anchor``-word
   sequences in it; equal windows have equal anchors. Blocks of documents send
   their distinct anchors, packed as binary, to hash shards, which answer each
   block with those that another block has too.
2. *Fragments.* Neighbouring windows of one recurring anchor are a fragment (at most
   ``2 * window - anchor`` words, unless the text repeats itself). Each block sends its
   distinct fragments, as words, with the first document that has them, to the shard
   of their anchor. So all places where a passage may occur stream through one shard.
3. *Automata.* Each shard confirms the windows that several documents have, word by
   word, compiles them to one Aho-Corasick automaton over word numbers, and streams
   all its fragments through it. Every occurrence it locates goes back to the block,
   with the first document of the passage; the block removes what comes later.

Hashes only find where to look; what recurs is decided on words. Only the answers
name fragments by 128-bit digests. A document goes to the shards that concern it and
to no others, so work grows with the input: an automaton of all passages would
have to read the whole corpus once per shard.

A passage in a third of all documents is one fragment per block and shard, or a
few that differ in the words around it.

Texts that are null or without words keep nothing and give an empty text. Equal
ids (also several missing ones, which come after all others) are not smaller
than one another. Rows are kept as they are, repeated ones included.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    LAST,
    Words,
    chunked_words,
    ids_of,
    mix,
    pack,
    text_bytes,
)

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
SENT = "shard int, block int, hashes binary"
BACK = "block int, hashes binary"
FRAGMENTS = "shard int, block int, hashes binary, firsts binary, shared binary, texts binary"
LOCATED = "block int, hashes binary, digests binary, sizes binary, firsts binary"
NOWHERE = LAST  # the first document of a window that no other document has
DIGEST = 16


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    out, width = values, 1
    while width < size:
        step = min(width, size - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def _fragments(words: Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows and anchor of each fragment: neighbouring windows
    of one text that have one anchor."""
    inside = np.flatnonzero(words.gram_starts(window))
    if not len(inside):
        return inside, inside, np.zeros(0, np.uint64)
    anchors = _sliding_min(words.grams(words.hashes(), anchor), window - anchor + 1)[inside]
    owner = words.owner()[inside]
    cut = (np.diff(inside) != 1) | (np.diff(owner) != 0) | (anchors[1:] != anchors[:-1])
    heads = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return inside[heads], np.diff(np.append(heads, len(inside))), anchors[heads]


def _joined(words: Words) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each of them starts."""
    sizes = words.ends - words.starts + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(words.starts - offsets[:-1], sizes)
    joined = np.append(words.data, np.uint8(32))[at]
    joined[offsets[1:] - 1] = 32
    return joined.tobytes(), offsets


def _shard_of(hashes: np.ndarray, n_shards: int) -> np.ndarray:
    """Independent of the order of the hashes, so that it adds to their bits."""
    return (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(n_shards)).astype(np.int64)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
    fields = [part.split() for part in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.table(
        {
            name: pa.array(list(c), kinds[kind])
            for (name, kind), c in zip(fields, columns, strict=True)
        }
    )


def _recurring_here(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct values with the smallest owner, and whether a second owner has them."""
    order = np.lexsort((owners, values))
    values, owners = values[order], owners[order]
    head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    tail = np.append(head[1:], len(values)) - 1 if len(values) else head
    return values[head], owners[head], owners[head] != owners[tail]


def _send_anchors(window: int, anchor: int, n_shards: int):
    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        found = [np.zeros(0, np.uint64)]
        for _, _, words in chunked_words(table["text"]):
            found.append(np.unique(_fragments(words, window, anchor)[2]))
        distinct = np.unique(np.concatenate(found))
        rows = [
            (shard, block, distinct[at].tobytes())
            for shard, at in pack(_shard_of(distinct, n_shards))
        ]
        return _table(rows, SENT)

    return send


def _answer_anchors(table: pa.Table) -> pa.Table:
    """To each block, those of its anchors that another block has too."""
    parts = [np.frombuffer(x.as_py(), np.uint64) for x in table["hashes"]]
    blocks = np.repeat(table["block"].to_numpy(), [len(p) for p in parts])
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = ranked[1:] == ranked[:-1]
    several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    values, blocks = ranked[several], blocks[order][several]
    order = np.argsort(blocks, kind="stable")
    names, cuts = np.unique(blocks[order], return_index=True)
    rows = [
        (int(name), part.tobytes())
        for name, part in zip(names, np.split(values[order], cuts[1:]), strict=False)
    ]
    return _table(rows, BACK)


def _gathered(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.concatenate(
        [np.zeros(0, kind), *(np.frombuffer(x.as_py(), kind) for x in table[name] if x.is_valid)]
    )


def _among(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    if not len(ranked):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return ranked[at] == values


def _send_fragments(window: int, anchor: int, n_shards: int):
    def send(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], FRAGMENTS)
        block = key[0].as_py()
        ids = ids_of(docs["doc_id"])
        chunks, anchors, owners = [], [], []
        for lo, _, words in chunked_words(docs["text"]):
            firsts, sizes, hashes = _fragments(words, window, anchor)
            chunks.append((words, firsts, sizes))
            anchors.append(hashes)
            owners.append(ids[lo + words.owner()[firsts]])
        all_anchors, all_owners = np.concatenate(anchors), np.concatenate(owners)
        recurring = np.sort(_gathered(known, "hashes", np.uint64))
        rest = ~_among(all_anchors, recurring)
        values, _, shared = _recurring_here(all_anchors[rest], all_owners[rest])
        recurring = np.sort(np.concatenate([recurring, values[shared]]))

        found: dict[bytes, tuple[int, int, bool]] = {}
        for (words, firsts, sizes), hashes, owner in zip(chunks, anchors, owners, strict=True):
            at = np.flatnonzero(_among(hashes, recurring))
            if not len(at):
                continue
            joined, offsets = _joined(words)
            starts = offsets[firsts[at]].tolist()
            ends = (offsets[firsts[at] + sizes[at] + window - 1] - 1).tolist()
            for start, end, hashed, doc in zip(
                starts, ends, hashes[at].tolist(), owner[at].tolist(), strict=True
            ):
                text = joined[start:end]
                before = found.get(text)
                if before is None:
                    found[text] = (hashed, doc, False)
                elif before[1] != doc:
                    found[text] = (hashed, min(doc, before[1]), True)
        texts = list(found)
        hashes = np.array([hashed for hashed, _, _ in found.values()], np.uint64)
        firsts = np.array([first for _, first, _ in found.values()], np.int64)
        shared = np.array([several for _, _, several in found.values()], bool)
        rows = [
            (
                s,
                block,
                hashes[at].tobytes(),
                firsts[at].tobytes(),
                shared[at].tobytes(),
                b"\n".join([texts[k] for k in at.tolist()]),
            )
            for s, at in pack(_shard_of(hashes, n_shards))
        ]
        return _table(rows, FRAGMENTS)

    return send


def _runs(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begin[0]``, the next ``sizes[0] - 1`` numbers, ``begin[1]`` and so on."""
    return np.arange(sizes.sum()) + np.repeat(begin - np.cumsum(sizes) + sizes, sizes)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Equal values numbered alike, and the distinct values."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _names(numbers: np.ndarray, window: int) -> np.ndarray:
    """A number for each ``window`` consecutive words, alike for equal ones only.

    Pairs of numbered halves are numbered again, so no hash takes part.
    """
    names, width = numbers, 1
    while width < window:
        step = min(width, window - width)
        pairs = names[: len(names) - step] * (names.max() + 1) + names[step:]
        names, width = _codes(pa.array(pairs))[0], width + step
    return names


def confirmed(
    numbers: np.ndarray, sizes: np.ndarray, firsts: np.ndarray, shared: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """A place of each window of more than one document, and the first of them.

    ``numbers`` are the words of all fragments, ``sizes`` how many each has, ``firsts``
    the first document that has it, ``shared`` whether another has it too.
    """
    n_windows = sizes - window + 1
    place = _runs(np.cumsum(sizes) - sizes, n_windows)
    names = _names(numbers, window)
    where = np.full(names.max() + 1, -1)
    low, high = np.full(len(where), LAST), np.full(len(where), np.iinfo(np.int64).min)
    names, doc = names[place], np.repeat(firsts, n_windows)
    where[names] = place
    np.minimum.at(low, names, doc)
    np.maximum.at(high, names, doc)
    several = low != high
    several[names[np.repeat(shared, n_windows)]] = True
    several &= where >= 0
    return where[several], low[several]


def compile_passages(
    numbers: np.ndarray, places: np.ndarray, firsts: np.ndarray, window: int
) -> ahocorasick.Automaton:
    """Automaton over word numbers; a passage's value is its first document."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    words = numbers.tolist()
    for place, first in zip(places.tolist(), firsts.tolist(), strict=True):
        automaton.add_word(tuple(words[place : place + window]), first)
    automaton.make_automaton()
    return automaton


def located(automaton: ahocorasick.Automaton, numbers: np.ndarray, window: int) -> np.ndarray:
    """For each place in a stream of words, the first document of the passage found there."""
    firsts = np.full(len(numbers), NOWHERE)
    matches = chain.from_iterable(automaton.iter(tuple(numbers.tolist())))
    ends, values = np.fromiter(matches, np.int64).reshape(-1, 2).T
    firsts[ends + 1 - window] = values
    return firsts


def _locate(window: int):
    """One shard: confirm, compile, stream its fragments, answer the blocks."""

    def locate(table: pa.Table) -> pa.Table:
        data = b"".join([text + b"\n" for text in table["texts"].to_pylist()])
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
        sent = _slices(data, np.concatenate([[0], ends]))
        hashes = _gathered(table, "hashes", np.uint64)
        docs, many = _gathered(table, "firsts", np.int64), _gathered(table, "shared", bool)

        # Equal fragments of several blocks are streamed once.
        code, distinct = _codes(sent)
        first, last = np.full(len(distinct), LAST), np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(first, code, docs)
        np.maximum.at(last, code, docs)
        shared = first != last
        shared[code[many]] = True

        # Words with the space or line end after them, which become alike.
        bounds = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
        text = np.frombuffer(distinct.buffers()[2], np.uint8)[: bounds[-1]]
        text = np.where(text == 10, np.uint8(32), text)
        starts = np.concatenate([[0], np.flatnonzero(text == 32) + 1])
        numbers, _ = _codes(_slices(text.tobytes(), starts))
        sizes = np.diff(np.searchsorted(starts, bounds))
        places, lows = confirmed(numbers, sizes, first, shared, window)
        if not len(places):
            return _table([], LOCATED)
        found = located(compile_passages(numbers, places, lows, window), numbers, window)
        n_windows, begin = sizes - window + 1, np.cumsum(sizes) - sizes
        heads = np.cumsum(n_windows) - n_windows
        found = found[_runs(begin, n_windows)]

        # A fragment's own documents lose nothing where none of them comes later.
        least = np.minimum.reduceat(found, heads)[code]
        told = (least < docs) | (many & (least < NOWHERE))
        wanted = np.unique(code[told])
        digests = np.frombuffer(
            b"".join(
                blake2b(x[:-1], digest_size=DIGEST).digest()
                for x in distinct.take(pa.array(wanted)).to_pylist()
            ),
            f"V{DIGEST}",
        )
        rows, lo = [], 0
        for block, count in zip(table["block"].to_pylist(), table["hashes"], strict=True):
            hi = lo + len(count.as_py()) // 8
            at = lo + np.flatnonzero(told[lo:hi])
            lo = hi
            if len(at):
                mine = code[at]
                rows.append(
                    (
                        block,
                        hashes[at].tobytes(),
                        digests[np.searchsorted(wanted, mine)].tobytes(),
                        n_windows[mine].tobytes(),
                        found[_runs(heads[mine], n_windows[mine])].tobytes(),
                    )
                )
        return _table(rows, LOCATED)

    return locate


def _slices(data: bytes, bounds: np.ndarray) -> pa.Array:
    """The bytes from each bound to the next."""
    offsets = pa.py_buffer(bounds.astype(np.int64))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)]
    )


def joined_words(words: Words, keep: np.ndarray) -> pa.Array:
    """Per text its kept words, joined by one space."""
    data = np.append(words.data, np.uint8(32))
    mask = np.zeros(len(data) + 1, np.int8)
    starts, ends, owner = words.starts[keep], words.ends[keep], words.owner()[keep]
    follows = np.concatenate([owner[1:] == owner[:-1], [False]])[: len(owner)]
    data[ends[follows]] = 32
    mask[starts] += 1  # no position occurs twice within starts or within ends
    mask[ends + follows] -= 1
    mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
    sizes = np.bincount(
        owner, weights=(ends - starts) + follows, minlength=len(words.first) - 1
    ).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[mask])
    )


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"


def _remove(window: int, anchor: int):
    def remove(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
        ids = ids_of(docs["doc_id"])
        anchors = np.unique(_gathered(known, "hashes", np.uint64))
        sizes = _gathered(known, "sizes", np.int64)
        firsts_of = _gathered(known, "firsts", np.int64)
        begin = np.cumsum(sizes) - sizes
        digests = b"".join(x.as_py() for x in known["digests"])
        number = {digests[k * DIGEST : (k + 1) * DIGEST]: k for k in range(len(sizes))}
        seen: dict[bytes, int] = {}

        def occurrences(words: Words, owner: np.ndarray) -> np.ndarray:
            """First words of the located windows that an earlier document has."""
            heads, counts, hashes = _fragments(words, window, anchor)
            at = np.flatnonzero(_among(hashes, anchors))
            if not len(at):
                return at
            joined, offsets = _joined(words)
            starts = offsets[heads[at]].tolist()
            ends = (offsets[heads[at] + counts[at] + window - 1] - 1).tolist()
            which = np.empty(len(at), np.int64)
            for k, (start, end) in enumerate(zip(starts, ends, strict=True)):
                text = joined[start:end]
                n = seen.get(text)
                if n is None:
                    n = number.get(blake2b(text, digest_size=DIGEST).digest(), -1)
                    seen[text] = n
                which[k] = n
            heads, which = heads[at][which >= 0], which[which >= 0]
            lengths = sizes[which]
            first = firsts_of[_runs(begin[which], lengths)]
            place = _runs(heads, lengths)
            return place[first < owner[place]]

        texts, n_words, n_removed = [], [], []
        for lo, hi, words in chunked_words(docs["text"]):
            n, owner = len(words.starts), words.owner()
            place = occurrences(words, ids[lo + owner]) if len(anchors) else np.zeros(0, np.int64)
            change = np.bincount(place, minlength=n + 1)
            change -= np.bincount(place + window, minlength=n + 1)
            gone = np.cumsum(change[:-1]) > 0
            texts.append(joined_words(words, ~gone).cast(pa.string()))
            n_words.append(words.counts())
            n_removed.append(np.bincount(owner[gone], minlength=hi - lo))
        none = np.zeros(0, np.int64)
        return pa.table(
            {
                "doc_id": docs["doc_id"].cast(pa.int64()),
                "n_words": pa.array(np.concatenate([none, *n_words])),
                "n_removed": pa.array(np.concatenate([none, *n_removed])),
                "kept_text": pa.chunked_array(texts, pa.string()),
            }
        )

    return remove


def remove_repeated_passages(docs: DataFrame, window: int = 13, anchor: int = 6) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (words joined by a space).

    ``docs`` needs doc_id (an integer) and text; other columns are left aside.
    """
    size = text_bytes(docs)
    n_blocks, n_shards = size // BLOCK_BYTES + 1, size // SHARD_BYTES + 1
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")
    blocks = rows.withColumn("block", block).groupBy("block")

    sent = blocks.applyInArrow(_send_anchors(window, anchor, n_shards), SENT)
    anchors = sent.groupBy("shard").applyInArrow(_answer_anchors, BACK)
    fragments = blocks.cogroup(anchors.groupBy("block")).applyInArrow(
        _send_fragments(window, anchor, n_shards), FRAGMENTS
    )
    found = fragments.groupBy("shard").applyInArrow(_locate(window), LOCATED)
    return blocks.cogroup(found.groupBy("block")).applyInArrow(_remove(window, anchor), KEPT)
