"""The corpus operators against plain versions, on edge rows in one small table."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from skyledger.llm import mixing, pii, secret_scan
from skyledger.llm.exact_dedup import exact_groups
from skyledger.llm.near_dedup import near_duplicates
from skyledger.llm.passages import remove_repeated_passages

WHITE = r"[\x20\x09-\x0D]+"
BASE = " ".join(f"word{i}" for i in range(40))
TEXTS = [
    BASE,
    BASE,
    BASE.replace(" ", "\n"),
    BASE + " tail",
    " ".join(f"other{i}" for i in range(30)),
    "Intro here " + " ".join(f"word{i}" for i in range(5, 25)) + " end",
    "",
    None,
    "one",
    "  \t ",
    "x " * 5000,
]
SCHEMA = "doc_id BIGINT, text STRING, source STRING, lang STRING, class STRING, bucket INT, digest STRING"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s" if i % 3 else None, None, "c", 1, "d") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [w for w in re.split(WHITE, text or "") if w]


def test_exact_groups(docs, empty):
    groups = {}
    for i, text in enumerate(TEXTS):
        groups.setdefault(re.sub(WHITE, " ", text or ""), []).append(i)
    expected = {
        (i, min(ids), len(ids), i == min(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    found = exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert set(map(tuple, found.collect())) == expected
    assert exact_groups(empty).count() == 0


def test_near_duplicates(docs, empty):
    sets = []
    for text in TEXTS:
        w = words((text or "").lower())
        n = max(1, len(w) - 4) if w else 0
        sets.append({tuple(w[i : i + 5]) for i in range(n)})
    component = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    component[a] = min(component[a], component[b])
    expected = {(i, len(s), component[i], component[i] == i) for i, s in enumerate(sets)}
    found = near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert set(map(tuple, found.collect())) == expected
    assert near_duplicates(empty).count() == 0


def test_repeated_passages(docs, empty):
    first, expected = {}, set()
    for i, text in enumerate(TEXTS):
        w = words(text)
        gone = set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.add((i, len(w), len(gone), kept))
    found = remove_repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_text")
    assert set(map(tuple, found.collect())) == expected
    assert remove_repeated_passages(empty).count() == 0


def test_mix_takes_no_document_more_than_twice(docs, empty):
    found = mixing.mix(docs).select("doc_id", "size", (F.col("first") + F.col("second")).alias("taken"))
    rows = found.collect()
    assert {(r.doc_id, r.size) for r in rows} == {(i, len(words(t))) for i, t in enumerate(TEXTS)}
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(rows) == sorted(found.collect())
    assert mixing.mix(empty).count() == 0


def test_personal_data():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    text = "a@b.co\n10.0.0.1\n300.1.1.1\n4111 1111 1111 1111\n+1 555 123 4567"
    kinds = [kind for kind, *_ in pii.find(text) if kind in pii.BASE]
    assert sorted(kinds) == ["card", "email", "ip", "phone"]
    assert pii.find("") == []


def test_secrets():
    text = 'password = "hunter22" AKIA' + "A1" * 8 + " " + "0f" * 12
    kinds = {kind for kind, *_ in secret_scan.find(text)}
    assert {"assign", "access", "hex"} <= kinds
    assert secret_scan.find("") == [] and secret_scan.find("token = abc") == []
