"""Near duplicates against brute force: planted similarities around 0.75, both paths, recall."""

import random

import pytest

from skyledger.llm import near_dedup, ngram_join

SCHEMA = "doc_id BIGINT, text STRING, class STRING, key INT, component STRING"


def planted():
    """Pairs and families of altered texts; among them many of a similarity around 0.75."""
    draw = random.Random(11)
    out = []
    for _ in range(60):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(90, 160))]
        out.append(base)
        for _ in range(draw.choice((1, 1, 2, 5))):
            copy, changed = list(base), draw.randrange(1, 6)
            for at in draw.sample(range(len(copy)), changed):
                copy[at] = f"n{draw.randrange(10**6)}"
            out.append(copy)
    group = [f"g{k}" for k in range(120)]
    for _ in range(60):  # near copies of one text
        copy = list(group)
        copy[draw.randrange(120)] = f"n{draw.randrange(10**6)}"
        out.append(copy)
    texts = [" ".join(words) for words in out]
    texts += [texts[0].upper(), "", None, "one", "One", " \t", "two words"]
    order = list(range(len(texts)))
    draw.shuffle(order)
    return [texts[k] for k in order]


def brute(texts):
    sets = []
    for text in texts:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0)})
    component = list(range(len(sets)))

    def root(k):
        while component[k] != k:
            k = component[k]
        return k

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and 100 * len(x & sets[b]) >= 75 * len(x | sets[b]):
                low, high = sorted((root(a), root(b)))
                component[high] = low
    return {(k, len(s), root(k), root(k) == k) for k, s in enumerate(sets)}


@pytest.mark.parametrize("block", [2048, 2])  # with 2, clusters are wide and cut into many blocks
@pytest.mark.parametrize("least_estimate", [near_dedup.LEAST_ESTIMATE, 0])
def test_planted_similarities_equal_brute_force(spark, monkeypatch, block, least_estimate):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = planted()
    docs = spark.createDataFrame([(i, t, "c", 1, "d") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    found = near_dedup.near_duplicates(docs, least_estimate)
    assert set(map(tuple, found.select("doc_id", "n_shingles", "component_id", "kept").collect())) == brute(texts)


def test_a_group_of_near_copies_gives_a_line_of_ties(spark):
    draw, n = random.Random(5), 400
    texts = []
    for _ in range(n):
        copy = [f"g{k}" for k in range(150)]
        for at in draw.sample(range(150), 2):
            copy[at] = f"n{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    signed = docs.mapInArrow(near_dedup._sign, near_dedup.SIGNED)
    classes = signed.selectExpr("doc_id AS class", "bands")
    ties = near_dedup._buckets(classes).filter("class != star").select("class", "star").distinct().count()
    assert ties <= 12 * n
    assert near_dedup.near_duplicates(docs).filter("component_id = 0").count() == n


def test_dropping_keeps_all_columns(spark):
    row = ("a b c d e f g", "x", 7, "y")
    docs = spark.createDataFrame(
        [(2, *row), (1, *row), (1, *row), (None, *row), (5, None, "x", 7, "y")], SCHEMA
    )
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 1, 5]
    assert near_dedup.drop_near_duplicates(docs.limit(0)).count() == 0
