"""Scoring by a gated recurrent language model with a class-factored softmax.

Tokens are words (A-Z lowered) and one end per text. Counts cover every training
text. Words are ordered by count: the ``HEAD`` most frequent ones are split into
classes, each with a softmax of its own; frequent others (a share of at least one in
``KNOWN`` of the tokens, so at most ``KNOWN`` words, whose counts are broadcast) fall
into ``MIDDLE`` classes of equal mass; all the rest is one class. Within these two
kinds of class a word has its share of the smoothed counts. So

    P(word | past) = P(class | state) * P(word | class, state),

a distribution over all training words and one unseen word. The counts of the rest
are joined to the texts by a shuffle and are never gathered in one place.

The recurrent part is numpy: many texts run side by side, and windows of ``STEPS``
tokens are passed with the state carried from one to the next, in training
(backpropagation stops at a window's start) and in scoring (each text is scored
from its first token to its end, however long). Each training text is learnt from
once, in ``ROUNDS`` rounds: the tasks of a round start from the same parameters,
which are then averaged by their tokens, first in ``SLOTS`` streams on the executors.

A null or empty text is its end alone. Rows are scored each for itself.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import chunked_words, stored

END = np.uint64(0xE2D0_0000_0000_0001)
HEAD, HEAD_CLASSES, MIDDLE = 512, 16, 8
KNOWN = 1 << 20
HIDDEN, LANES, STEPS = 16, 256, 32
ROUNDS, SLOTS, RATE = 2, 8, 0.02
CLASS_WORDS = HEAD // HEAD_CLASSES
CLASSES = HEAD_CLASSES + MIDDLE + 1
REST = HEAD + MIDDLE  # number of a word of the last class; START is the next
START = REST + 1


# --- counts ---------------------------------------------------------------------


def _summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(words, kind="stable")
    words, counts = words[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])[: len(words)])
    return words[head], np.add.reduceat(counts, head) if len(head) else counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [(np.array([END]), np.array([batch.num_rows]))]
        for _, _, words in chunked_words(batch["text"], lower=True):
            parts.append(np.unique(words.hashes(), return_counts=True))
        found, counts = _summed(*map(np.concatenate, zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"]
        )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows: 64-bit hashes of words, the end included."""
    return texts.select("text").mapInArrow(_count, "word bigint, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")
    )


@dataclass(frozen=True)
class Vocabulary:
    """The broadcast words by hash, with their numbers and log shares in their class."""

    keys: np.ndarray  # sorted hashes
    slots: np.ndarray  # first key whose upper 20 bits are at least so large
    numbers: np.ndarray  # of the model's input, per key
    counts: np.ndarray
    shares: np.ndarray  # log P(word | class) of middle words, 0 for the head's
    total: int
    distinct: int
    rest_mass: float  # of the smoothed counts of the last class, the unseen word included

    @property
    def mass(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Position among the keys, -1 for a word of the last class."""
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        at, end = self.slots[slot], self.slots[slot + 1]
        out = np.full(len(hashes), -1)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            hit = self.keys[at[open_]] == hashes[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary, and the initial biases: log counts of head words, log class masses."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = totals.n or 0, totals.v
    often = counts.filter(F.col("n") * KNOWN >= total).orderBy(F.desc("n"), "word").toPandas()
    words = often["word"].to_numpy(np.int64).view(np.uint64)
    n = often["n"].to_numpy(np.int64)
    numbers = np.arange(len(words))
    middle = numbers >= HEAD
    rank = np.cumsum(n[middle]) - n[middle] / 2
    numbers[middle] = HEAD + np.minimum(
        (rank * MIDDLE / max(1, n[middle].sum())).astype(np.int64), MIDDLE - 1
    )
    smooth = n + 0.5
    mass = np.bincount(numbers, weights=smooth, minlength=REST + 1)
    shares = np.where(middle, np.log(smooth / mass[numbers]), 0.0)
    rest_mass = total - n.sum() + 0.5 * (distinct - len(n) + 1)
    mass[REST] = rest_mass
    order = np.argsort(words)
    keys = words[order]
    slots = np.searchsorted(keys >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64))
    vocab = Vocabulary(
        keys,
        slots,
        numbers[order],
        n[order],
        shares[order],
        total,
        distinct,
        float(rest_mass),
    )
    return vocab, np.log(np.maximum(mass, 1e-3))


# --- the network ----------------------------------------------------------------

SHAPES = {
    "inputs": (START + 1, 3 * HIDDEN),
    "state": (HIDDEN, 3 * HIDDEN),
    "class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "word": (HEAD_CLASSES, HIDDEN, CLASS_WORDS),
    "word_bias": (HEAD_CLASSES, CLASS_WORDS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def class_of(number: np.ndarray) -> np.ndarray:
    return np.where(number < HEAD, number // CLASS_WORDS, number - HEAD + HEAD_CLASSES)


def initial(log_mass: np.ndarray, seed: int = 7) -> np.ndarray:
    """Small random weights; biases that give the unigram distribution."""
    draw = np.random.default_rng(seed)
    parts = views(flat := np.zeros(SIZE, np.float32))
    parts["inputs"][:] = draw.normal(0, 0.5, SHAPES["inputs"])
    parts["state"][:] = draw.normal(0, HIDDEN**-0.5, SHAPES["state"])
    parts["class"][:] = draw.normal(0, 0.05, SHAPES["class"])
    parts["word"][:] = draw.normal(0, 0.05, SHAPES["word"])
    parts["word_bias"][:] = log_mass[:HEAD].reshape(HEAD_CLASSES, CLASS_WORDS)
    mass = np.bincount(class_of(np.arange(REST + 1)), weights=np.exp(log_mass), minlength=CLASSES)
    parts["class_bias"][:] = np.log(np.maximum(mass, 1e-3))
    return flat


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def run_states(p: dict, inputs: np.ndarray, keep: np.ndarray, h: np.ndarray, tape: list | None):
    """States after each input; ``keep`` is 0 where a text begins."""
    H = HIDDEN
    gates = p["inputs"][inputs]
    states = np.empty((*inputs.shape, H), np.float32)
    for t in range(len(inputs)):
        h = h * keep[t][:, None]
        a = h @ p["state"]
        g = gates[t]
        zr = _sigmoid(g[:, : 2 * H] + a[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(g[:, 2 * H :] + r * a[:, 2 * H :])
        new = n + z * (h - n)
        if tape is not None:
            tape.append((h, a, z, r, n))
        states[t] = h = new
    return states, h


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def log_probabilities(p: dict, states: np.ndarray, targets: np.ndarray, grad: dict | None = None):
    """log P of each target; with ``grad`` also d(-sum)/d(states), adding to ``grad``.

    Targets of -1 are padding. Words of one class share a product, so only the
    softmax of the own class is computed.
    """
    real = np.flatnonzero(targets >= 0)
    s, y = states[real], targets[real]
    cls = class_of(y)
    logp = _log_softmax(s @ p["class"] + p["class_bias"])
    rows = np.arange(len(y))
    out = np.zeros(len(targets))
    value = logp[rows, cls].astype(np.float64)
    back = None
    if grad is not None:
        delta = np.exp(logp)
        delta[rows, cls] -= 1
        grad["class"] += s.T @ delta
        grad["class_bias"] += delta.sum(axis=0)
        back = delta @ p["class"].T
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(HEAD_CLASSES + 1))
    for c in range(HEAD_CLASSES):
        at = order[cuts[c] : cuts[c + 1]]
        if not len(at):
            continue
        own, word = s[at], y[at] - c * CLASS_WORDS
        inner = _log_softmax(own @ p["word"][c] + p["word_bias"][c])
        k = np.arange(len(at))
        value[at] += inner[k, word]
        if grad is not None:
            delta = np.exp(inner)
            delta[k, word] -= 1
            grad["word"][c] += own.T @ delta
            grad["word_bias"][c] += delta.sum(axis=0)
            back[at] += delta @ p["word"][c].T
    out[real] = value
    if grad is None:
        return out, None
    whole = np.zeros_like(states)
    whole[real] = back
    return out, whole


def gradient(p: dict, grad: dict, inputs, targets, keep, h):
    """Adds the gradient of a window to ``grad``; the last state and the log-likelihood."""
    H, tape = HIDDEN, []
    states, last = run_states(p, inputs, keep, h, tape)
    flat = states.reshape(-1, H)
    logp, back = log_probabilities(p, flat, targets.reshape(-1), grad)
    back = back.reshape(states.shape)
    gates = np.empty((*inputs.shape, 3 * H), np.float32)
    carried = np.zeros_like(h)
    recurrent = np.empty_like(gates)
    before = np.empty_like(states)
    for t in range(len(inputs) - 1, -1, -1):
        h0, a, z, r, n = tape[t]
        d = back[t] + carried
        dn = d * (1 - z) * (1 - n * n)
        g = gates[t]
        g[:, :H] = d * (h0 - n) * z * (1 - z)
        g[:, H : 2 * H] = dn * a[:, 2 * H :] * r * (1 - r)
        g[:, 2 * H :] = dn
        q = recurrent[t]
        q[:, : 2 * H] = g[:, : 2 * H]
        q[:, 2 * H :] = dn * r
        before[t] = h0
        carried = (d * z + q @ p["state"].T) * keep[t][:, None]
    grad["state"] += before.reshape(-1, H).T @ recurrent.reshape(-1, 3 * H)
    x = inputs.reshape(-1)
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    grad["inputs"][ranked[head]] += np.add.reduceat(gates.reshape(-1, 3 * H)[order], head)
    return last, logp.sum()


def _numbered(batch: pa.RecordBatch, vocab: Vocabulary) -> Iterator[tuple]:
    """Per chunk: texts, words, their hashes, their position among the keys, their numbers."""
    for lo, hi, words in chunked_words(batch["text"], lower=True):
        hashes = words.hashes()
        at = vocab.find(hashes)
        numbers = np.where(at >= 0, vocab.numbers[at] if len(vocab.keys) else REST, REST)
        yield lo, hi, words, hashes, at, numbers


def _with_ends(numbers: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Targets (words, then the end of each text) and the inputs before them."""
    sizes = counts + 1
    stops = np.cumsum(sizes) - 1
    targets = np.empty(stops[-1] + 1 if len(stops) else 0, np.int32)
    inner = np.ones(len(targets), bool)
    inner[stops] = False
    targets[inner] = numbers
    targets[stops] = end
    inputs = np.roll(targets, 1)
    inputs[stops - counts] = START
    return targets, inputs


def _end_number(vocab: Vocabulary) -> int:
    at = vocab.find(np.array([END]))[0]
    return int(vocab.numbers[at]) if at >= 0 else REST


def _train(vocab, start: np.ndarray, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_known = vocab.value
        flat = start.value.copy()
        p, end = views(flat), _end_number(words_known)
        mean, square = np.zeros_like(flat), np.zeros_like(flat)
        seen = step = 0
        for batch in batches:
            parts = [
                _with_ends(numbers, words.counts(), end)
                for _, _, words, _, _, numbers in _numbered(batch, words_known)
            ]
            if not parts:
                continue
            targets, inputs = map(np.concatenate, zip(*parts, strict=True))
            seen += len(targets)
            lanes = max(1, min(LANES, len(targets) // STEPS))
            length = -(-len(targets) // lanes)
            pad = lanes * length - len(targets)
            y = np.append(targets, np.full(pad, -1, np.int32)).reshape(lanes, length).T
            x = np.append(inputs, np.full(pad, START, np.int32)).reshape(lanes, length).T
            keep = (x != START).astype(np.float32)
            h = np.zeros((lanes, HIDDEN), np.float32)
            for at in range(0, length, STEPS):
                window = slice(at, at + STEPS)
                change = np.zeros_like(flat)
                h, _ = gradient(p, views(change), x[window], y[window], keep[window], h)
                change /= max(1, int((y[window] >= 0).sum()))
                norm = float(np.linalg.norm(change))
                change *= min(1.0, 1.0 / max(norm, 1e-9))
                step += 1
                mean += 0.1 * (change - mean)
                square += 0.01 * (change * change - square)
                scale = rate * min(1.0, step / 20) / (1 - 0.9**step)
                flat -= scale * mean / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        if seen:
            yield pa.RecordBatch.from_pydict(
                {"tokens": pa.array([seen]), "weights": pa.array([flat.tobytes()])}
            )

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = np.zeros(SIZE), 0
    for batch in batches:
        for n, weights in zip(batch["tokens"].to_pylist(), batch["weights"], strict=True):
            total += n * np.frombuffer(weights.as_buffer(), np.float32)
            tokens += n
    if tokens:
        yield pa.RecordBatch.from_pydict(
            {
                "tokens": pa.array([tokens]),
                "weights": pa.array([(total / tokens).astype(np.float32).tobytes()]),
            }
        )


def fit(texts: DataFrame, vocab, flat: np.ndarray) -> np.ndarray:
    """Parameters after every row of ``texts`` (doc_id, text) was learnt from once."""
    context = texts.sparkSession.sparkContext
    schema = "tokens bigint, weights binary"
    for k in range(ROUNDS):
        start = context.broadcast(flat)
        part = texts.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(ROUNDS)) == k)
        trained = part.select("text").mapInArrow(_train(vocab, start, RATE / (1 + k)), schema)
        slot = F.pmod(F.xxhash64("weights"), F.lit(SLOTS))
        averaged = trained.repartition(SLOTS, slot).mapInArrow(_average, schema).collect()
        if averaged:
            tokens = np.array([r.tokens for r in averaged], float)
            rows = np.stack([np.frombuffer(r.weights, np.float32) for r in averaged])
            flat = (tokens @ rows / tokens.sum()).astype(np.float32)
        start.unpersist()
    return flat


# --- scoring --------------------------------------------------------------------


def _lanes(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """A lane and a start in it for each text, longest first onto the shortest lane."""
    lanes = min(LANES, max(1, len(sizes)))
    free = [(0, k) for k in range(lanes)]
    lane, begin = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        used, k = free[0]
        lane[i], begin[i] = k, used
        heapq.heapreplace(free, (used + int(sizes[i]), k))
    return lane, begin, lanes, max(used for used, _ in free)


def document_log_likelihoods(p: dict, targets, inputs, sizes: np.ndarray) -> np.ndarray:
    """log P of each text by the network: classes, and words of the head."""
    lane, begin, lanes, length = _lanes(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(targets)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = (np.repeat(begin, sizes) + inside) * lanes + np.repeat(lane, sizes)
    x = np.full(length * lanes, START, np.int32)
    y = np.full(length * lanes, -1, np.int32)
    x[at], y[at] = inputs, targets
    text = np.zeros(length * lanes, np.int32)
    text[at] = owner
    x, y, text = (v.reshape(length, lanes) for v in (x, y, text))
    total = np.zeros(len(sizes))
    h = np.zeros((lanes, HIDDEN), np.float32)
    for k in range(0, length, STEPS):
        window = slice(k, k + STEPS)
        keep = (x[window] != START).astype(np.float32)
        states, h = run_states(p, x[window], keep, h, None)
        logp, _ = log_probabilities(p, states.reshape(-1, HIDDEN), y[window].reshape(-1))
        total += np.bincount(text[window].reshape(-1), weights=logp, minlength=len(sizes))
    return total


SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
    "model double, word bigint, n bigint"
)


def _score(vocab, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        p, end = views(weights.value), _end_number(v)
        base = np.log10((v.counts + 0.5) / v.mass)
        at_end = int(v.find(np.array([END]))[0])
        names = [part.split()[0] for part in SCORED.split(", ")]
        for batch in batches:
            rows = batch["row"].to_numpy()
            n_tokens, known, base_sum, inner, parts, pairs = [], [], [], [], [], []
            for lo, hi, words, hashes, at, numbers in _numbered(batch, v):
                n, owner = words.counts(), words.owner()
                hit = at >= 0
                mine = owner[hit]
                found = np.bincount(mine, minlength=hi - lo)
                sums = np.bincount(mine, weights=base[at[hit]], minlength=hi - lo)
                shares = np.bincount(mine, weights=v.shares[at[hit]], minlength=hi - lo)
                if at_end >= 0:
                    found, sums, shares = found + 1, sums + base[at_end], shares + v.shares[at_end]
                else:
                    pairs.append((np.arange(lo, hi), np.full(hi - lo, END), np.ones(hi - lo, int)))
                n_tokens.append(n + 1)
                known.append(found)
                base_sum.append(sums)
                inner.append(shares)
                parts.append(_with_ends(numbers, n, end))
                pairs.append(_pairs(owner[~hit] + lo, hashes[~hit]))
            if not parts:
                continue
            targets, inputs = map(np.concatenate, zip(*parts, strict=True))
            sizes = np.concatenate(n_tokens)
            model = document_log_likelihoods(p, targets, inputs, sizes) + np.concatenate(inner)
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(sizes),
                    pa.array(np.concatenate(known).astype(np.int64)),
                    pa.array(np.concatenate(base_sum).astype(float)),
                    pa.array(model / np.log(10)),
                    none,
                    none,
                ],
                names=names,
            )
            owner, word, n = map(np.concatenate, zip(*pairs, strict=True))
            empty = [pa.nulls(len(owner), kind) for kind in (pa.int64(), pa.bool_(), pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[owner]),
                    empty[0],
                    empty[1],
                    empty[0],
                    empty[0],
                    empty[2],
                    empty[2],
                    pa.array(word.view(np.int64)),
                    pa.array(n.astype(np.int64)),
                ],
                names=names,
            )

    return run


def _pairs(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    head = np.flatnonzero(new)
    return owner[head], hashes[head], np.diff(np.append(head, len(owner)))


def language_model_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a condition on doc_id; the rows where it is not true are learnt from.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    context = docs.sparkSession.sparkContext
    learnt = texts.filter(~F.col("held_out"))
    counts = stored(word_counts(learnt), "counts")
    words, log_mass = vocabulary(counts)
    vocab = context.broadcast(words)
    weights = context.broadcast(fit(learnt, vocab, initial(log_mass)))
    scored = stored(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _score(vocab, weights), SCORED
        ),
        "scores",
    )
    rest = scored.filter("word IS NOT NULL").select("row", "word", "n")
    smooth = F.coalesce(F.col("c"), F.lit(0)) + 0.5
    sums = (
        rest.join(counts.withColumnRenamed("n", "c"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum("n").alias("m"),
            F.sum(F.col("n") * F.log10(smooth)).alias("logs"),
        )
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return (
        scored.filter("word IS NULL")
        .drop("word", "n")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + zero("more_known")).alias("n_known"),
            F.lit(words.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + zero("logs") - zero("m") * float(np.log10(words.mass))).alias("base_score"),
            (
                F.col("model") + zero("logs") - zero("m") * float(np.log10(words.rest_mass or 1.0))
            ).alias("score"),
        )
    )
