"""Repeated passages against a brute-force version, over many blocks and shards."""

import random

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import passages
from skyledger.llm.passages import compile_passages, confirmed, located, remove_repeated_passages

SCHEMA = "doc_id BIGINT, text STRING, block INT, shard INT, hashes STRING, firsts STRING"


def plain(rows, window):
    """All rows at once: (doc_id, n_words, n_removed, kept text)."""
    last = float("inf")
    split = [(last if i is None else i, (t or "").split()) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            passage = tuple(words[k : k + window])
            first[passage] = min(first.get(passage, last), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((None if i == last else i, len(words), len(gone), kept))
    return sorted(out, key=repr)


def corpus(seed):
    """Texts made of shared passages, own words, copies and texts that repeat themselves."""
    draw = random.Random(seed)
    shared = [[f"s{k}w{j}" for j in range(draw.randint(9, 40))] for k in range(12)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(draw.randint(0, 6)):
            part = shared[min(draw.randrange(12), draw.randrange(12))]
            lo = draw.randrange(len(part))
            words += part[lo : lo + draw.randint(5, 40)]
            words += [f"o{draw.randrange(9)}" for _ in range(draw.randint(0, 12))]
        rows.append((i - 20, draw.choice([" ", "\n", "  "]).join(words)))
    rows += [(500 + i, rows[i][1]) for i in range(30)]  # copies
    rows += rows[:5]  # repeated rows
    rows += [(None, rows[7][1]), (None, rows[7][1]), (None, None), (9, None), (8, ""), (7, " \t ")]
    rows += [(900, "a " * 3000), (901, "a " * 40), (902, "a b " * 30), (903, "b a " * 30), (899, "b " * 13)]
    rows += [(1000, "é" * 400 + " " + " ".join(f"ü{k}" for k in range(20)))]
    rows += [(1001, " ".join(f"ü{k}" for k in range(20)))]
    return rows


@pytest.mark.parametrize(("window", "anchor", "seed"), [(13, 6, 1), (5, 2, 2), (13, 13, 3), (1, 1, 4)])
def test_like_brute_force_over_many_blocks(spark, monkeypatch, window, anchor, seed):
    monkeypatch.setattr(passages, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(passages, "SHARD_BYTES", 9000)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*row, 1, 2, "h", "f") for row in rows], SCHEMA)
    found = remove_repeated_passages(docs, window, anchor)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, window)


def test_one_block_and_empty_table(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = remove_repeated_passages(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows, 13)
    assert remove_repeated_passages(docs.limit(0)).count() == 0


def test_what_recurs_is_decided_on_words_by_the_automaton(monkeypatch):
    """With all anchors alike every fragment meets every other; nothing else may recur."""
    alike = lambda values, size: values[: len(values) - size + 1] * 0
    monkeypatch.setattr(passages, "_sliding_min", alike)
    rows = corpus(6)
    table = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    key = (pa.scalar(0),)
    nothing = pa.table({name: [] for name in ("block", "hashes", "digests", "sizes", "firsts")})
    sent = passages._send_fragments(13, 6, 1)(key, table, nothing)
    back = passages._locate(13)(sent)
    kept = passages._remove(13, 6)(key, table, back).to_pylist()
    assert sorted((tuple(r.values()) for r in kept), key=repr) == plain(rows, 13)
    monkeypatch.setattr(passages, "located", lambda a, w, n: np.full(len(w), passages.NOWHERE))
    silent = passages._locate(13)(sent)
    assert silent.num_rows == 0  # without what the automaton finds nothing goes


def test_confirmed_and_located():
    numbers = np.array([1, 2, 3, 4, 2, 3, 4, 5, 8, 9, 8])
    places, firsts = confirmed(
        numbers, np.array([4, 4, 3]), np.array([7, 3, 5]), np.array([False, False, True]), 3
    )
    found = {tuple(numbers[p : p + 3].tolist()): int(f) for p, f in zip(places, firsts, strict=True)}
    assert found == {(2, 3, 4): 3, (8, 9, 8): 5}
    automaton = compile_passages(numbers, places, firsts, 3)
    nowhere = passages.NOWHERE
    assert located(automaton, np.array([1, 2, 3, 4]), 3).tolist() == [nowhere, 3, nowhere, nowhere]
    assert located(automaton, np.array([8, 9, 8, 9, 8]), 3).tolist() == [5, nowhere, 5, nowhere, nowhere]
