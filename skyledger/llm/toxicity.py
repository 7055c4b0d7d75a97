"""Toxicity: a linear classifier regularised by counterfactuals.

Features are the words of a text and their first 4, 5 and 6 bytes (A-Z lowered,
cut at everything that is neither letter nor digit), hashed; a feature counts once
a text. Of those in the sample the ``FEATURES`` with the strongest difference
between the classes are kept. The weights minimise the logistic loss, an L1 term,
and for each labelled sentence with identity terms the squared change of its score
when these are swapped for others of their category. So what a sentence says of a
group cannot weigh more than what it says of another, and neutral mentions do not
raise the score.

The sample holds at most ``max_rows`` labelled documents of either class, those
with the smallest hashes of their ids; each class weighs as it does among all
labels. Of several labels of a document the largest holds; labels without an id or
a value are left aside. Without examples of both classes the score is the share of
toxic labels (0 without labels). Empty and null texts have no features and get the
score of the intercept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skyledger.llm.common import Words, chunked_words, stored, words_of

HASH_BITS = 22
PREFIXES = (4, 5, 6)
FEATURES = 20_000
SEPARATORS = np.ones(256, bool)
SEPARATORS[128:] = False
SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

# Identity terms by category; a term is swapped within its category.
IDENTITY = {
    "women": "woman man girl boy nonbinary".split(),
    "groups": "women men girls boys".split(),
    "religion": "christian muslim jewish hindu buddhist sikh atheist catholic protestant".split(),
    "believers": "christians muslims jews hindus buddhists sikhs atheists catholics".split(),
    "orientation": "straight gay lesbian bisexual queer heterosexual homosexual".split(),
    "gender": "transgender cisgender trans female male".split(),
    "colour": "black white asian latino african european american arab indigenous".split(),
    "origin": "immigrants refugees foreigners natives mexicans chinese africans europeans".split(),
    "ability": "deaf blind disabled autistic paralyzed".split(),
    "age": "old young elderly teenage".split(),
}
_CATEGORY = {term: terms for terms in IDENTITY.values() for term in terms}
_TERM = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join(_CATEGORY) + r")(?![A-Za-z0-9])", re.I | re.A)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes with a weight
    weights: np.ndarray
    intercept: float

    def logits(self, words: Words) -> np.ndarray:
        """One per text; a feature that is in the text twice counts once."""
        out = np.full(len(words.first) - 1, self.intercept)
        if not len(self.features) or not len(words.starts):
            return out
        owner = words.owner()
        table = np.zeros(1 << HASH_BITS, bool)
        table[self.features] = True
        pairs = []
        for hashed, at in features(words):
            hit = table[hashed]
            pairs.append(np.stack([owner[at][hit], hashed[hit]], axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        if len(pairs):
            weights = self.weights[np.searchsorted(self.features, pairs[:, 1])]
            out += np.bincount(pairs[:, 0], weights=weights, minlength=len(out))
        return out


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of whole words and of prefixes, each with the numbers of their words."""
    shift = np.uint64(64 - HASH_BITS)
    for length in (None, *PREFIXES):
        hashed = (words.hashes(length) >> shift).astype(np.int64)
        at = np.arange(len(hashed))
        if length is not None:
            at = np.flatnonzero(words.ends - words.starts > length)
        yield hashed[at], at


def feature_set(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    words = words_of(data, np.array([0, len(data)]), lower=True, space=SEPARATORS)
    return np.unique(np.concatenate([hashed for hashed, _ in features(words)]))


def swapped(text: str, step: int) -> str:
    """``text`` with each identity term replaced by one ``step`` further in its category."""

    def other(found: re.Match) -> str:
        terms = _CATEGORY[found[0].lower()]
        return terms[(terms.index(found[0].lower()) + step) % len(terms)]

    return _TERM.sub(other, text)


def counterfactuals(text: str, swaps: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features that a sentence loses and gains by each swap of its identity terms."""
    found = []
    if _TERM.search(text):
        for sentence in _SENTENCE.findall(text):
            if _TERM.search(sentence):
                own = feature_set(sentence.encode())
                for step in range(1, swaps + 1):
                    new = feature_set(swapped(sentence, step).encode())
                    found.append((np.setdiff1d(own, new), np.setdiff1d(new, own)))
    return found


def _examples(swaps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch["text"][k].as_py() or ""
                pairs = counterfactuals(text, swaps)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch["doc_id"].slice(k, 1),
                        "toxic": batch["toxic"].slice(k, 1),
                        "found": pa.array([feature_set(text.encode())], pa.list_(pa.int32())),
                        "lost": pa.array([[a for a, _ in pairs]], pa.list_(pa.list_(pa.int32()))),
                        "gained": pa.array([[b for _, b in pairs]], pa.list_(pa.list_(pa.int32()))),
                    }
                )

    return run


class _Rows:
    """A sparse matrix by rows, with the products that fitting needs."""

    def __init__(self, rows: list[np.ndarray], signs: list[np.ndarray] | None, width: int):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        self.signs = 1.0 if signs is None else np.concatenate([np.zeros(0), *signs])
        self.owner = np.repeat(np.arange(len(rows)), self.sizes)
        self.n, self.width = len(rows), width

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.signs * weights[self.columns], minlength=self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.signs * values[self.owner], minlength=self.width)


def fit(
    rows: list[np.ndarray],
    toxic: np.ndarray,
    share: np.ndarray,
    lost: list[np.ndarray],
    gained: list[np.ndarray],
    width: int,
    sparsity: float,
    fairness: float,
    steps: int,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal gradient steps."""
    x = _Rows(rows, None, width)
    signs = [np.repeat([-1.0, 1.0], [len(a), len(b)]) for a, b in zip(lost, gained, strict=True)]
    d = _Rows([np.concatenate(p) for p in zip(lost, gained, strict=True)], signs, width)
    pull = 2 * fairness / max(1, d.n)

    def bend(v: np.ndarray) -> np.ndarray:
        return x.back(share * x.dot(v)) / 4 + pull * d.back(d.dot(v))

    v = np.ones(width)
    for _ in range(12):
        v /= np.linalg.norm(v) + 1e-12
        v = bend(v)
    step = 1 / (1.1 * np.linalg.norm(v) + 0.3)
    weights = ahead = np.zeros(width)
    base = base_ahead = np.log((share @ toxic) / (share @ (1 - toxic)))
    t = 1.0
    for _ in range(steps):
        error = share * (1 / (1 + np.exp(-np.clip(x.dot(ahead) + base_ahead, -30, 30))) - toxic)
        moved = ahead - step * (x.back(error) + pull * d.back(d.dot(ahead)))
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
        new_base = base_ahead - step * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_next * (new - weights)
        base_ahead = new_base + (t - 1) / t_next * (new_base - base)
        weights, base, t = new, new_base, t_next
    return weights, float(base)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    max_rows: int = 3000,
    swaps: int = 2,
    sparsity: float = 1e-4,
    fairness: float = 1.0,
    steps: int = 300,
) -> Model:
    """Fit on a sample of the labels for whose rows ``learn`` holds."""
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter("_id IS NOT NULL AND toxic IS NOT NULL")
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = np.zeros(0, np.int64)
    every = sum(totals.values())
    if len(totals) < 2:
        only = totals.get(1, 0) / every if every else 0.0
        return Model(nothing, np.zeros(0), 30.0 if only else -30.0)

    order = [F.xxhash64("_id"), F.col("_id")]
    one, other = (known.filter(F.col("toxic") == k).orderBy(*order).limit(max_rows) for k in (1, 0))
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).join(F.broadcast(one.unionByName(other)), F.col("doc_id") == F.col("_id"))
    schema = "doc_id bigint, toxic int, found array<int>, lost array<array<int>>, gained array<array<int>>"
    examples = stored(
        texts.select("doc_id", "toxic", "text")
        .mapInArrow(_examples(swaps), schema)
        .dropDuplicates(["doc_id"]),
        "examples",
    )
    n = {r.toxic: r.n for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Model(nothing, np.zeros(0), float(np.log(totals[1] / totals[0])))
    bad, good = (F.sum(F.when(F.col("toxic") == k, 1).otherwise(0)) / n[k] for k in (1, 0))
    gap = F.abs(bad - good) / F.sqrt(bad + good + 1e-3)
    chosen = (
        examples.select("toxic", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("n"), gap.alias("gap"))
        .filter("n >= 3")
        .orderBy(F.desc("gap"), "feature")
        .limit(FEATURES)
    )
    kept = np.sort(np.array([r.feature for r in chosen.select("feature").collect()], np.int64))

    def number(found) -> np.ndarray:
        found = np.asarray(found, np.int64)
        at = np.minimum(np.searchsorted(kept, found), max(len(kept) - 1, 0))
        return at[kept[at] == found] if len(kept) and len(found) else nothing

    rows, toxic, lost, gained = [], [], [], []
    for r in examples.orderBy("doc_id").toLocalIterator():
        rows.append(number(r.found))
        toxic.append(r.toxic)
        lost += [number(x) for x in r.lost]
        gained += [number(x) for x in r.gained]
    toxic = np.array(toxic, float)
    share = np.where(toxic == 1, totals[1] / n[1], totals[0] / n[0]) / every
    weights, base = fit(rows, toxic, share, lost, gained, len(kept), sparsity, fairness, steps)
    used = weights != 0
    return Model(kept[used], weights[used], base)


def with_score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each text, between 0 and 1, as last column.

    Null and empty texts, and those without a feature, have the model's base score. A column
    that has the score's name already is replaced. Repeated rows stay; long texts are whole.
    """
    others = [f for f in docs.schema if f.name.lower() != column.lower()]
    schema = StructType([*others, StructField(column, DoubleType())])
    docs = docs.select(*[F.col(f"`{f.name}`") for f in others])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            logits = [
                model.logits(words)
                for _, _, words in chunked_words(text, lower=True, space=SEPARATORS)
            ]
            scores = 1 / (1 + np.exp(-np.clip(np.concatenate([np.zeros(0), *logits]), -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(score, schema)


def without_toxic(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, or that nothing speaks against.

    A text that scores no higher than an empty one is kept: where most labels are toxic, or
    no feature was found, the base score alone rejects nothing.
    """
    name = "_toxicity"
    while name in map(str.lower, docs.columns):
        name += "_"
    none = 1 / (1 + float(np.exp(-np.clip(model.intercept, -500, 500)))) + 1e-12
    scored = with_score(docs, model, name)
    return scored.filter((F.col(name) < least) | (F.col(name) <= none)).drop(name)


def remainder(column: str, by: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text; null where the id is."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by
