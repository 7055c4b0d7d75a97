"""Base columns of the language model's scores against plain counting."""

import math
import re
import zlib
from collections import Counter

import pytest

from skyledger.llm.language_model import language_model_scores
from skyledger.llm.toxicity import remainder

WORD = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))  # Thue-Morse
OTHER = WORD.translate(str.maketrans("ab", "ba"))


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w] + [None]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 1


def test_base_scores(spark):
    out = next(i for i in range(100, 200) if held_out(i))
    learnt = next(i for i in range(100, 200) if not held_out(i))
    texts = {i: f"The cat {i % 7} sat on mat {i % 3} THE end" for i in range(40)}
    texts |= {50: "", 51: None, 52: " \t\n", 53: "x " * 3000, learnt: WORD, out: OTHER}
    rows = [(i, t, 1.0) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, score DOUBLE")
    counts = Counter(t for i, text in texts.items() if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    found = language_model_scores(docs, remainder("doc_id") == 1).collect()
    assert len(found) == len(texts)
    for row in found:
        own = tokens(texts[row.doc_id])
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        assert row.held_out == held_out(row.doc_id)
        assert (row.n_tokens, row.train_tokens) == (len(own), n)
        assert row.n_known == sum(counts[t] > 0 for t in own)
        assert row.base_score == pytest.approx(base, abs=1e-6)
        assert row.score < 0 and math.isfinite(row.score)
    assert next(r.n_known for r in found if r.doc_id == out) == 1  # the end, not the other word
