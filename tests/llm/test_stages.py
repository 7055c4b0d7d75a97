"""Pipeline stages on tables with clashing columns, without evidence, and empty."""

import numpy as np
import pytest

from skyledger.llm import mixing, toxicity

CLASHING = "doc_id BIGINT, source STRING, lang STRING, n_chars INT, text STRING, size STRING, _own INT, _toxicity STRING, _row INT, _words INT"
TEXTS = ["a b c d", "a b c d", "bad words here", "", None, "one " * 300]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (k, "ab"[k % 2], "en", len(t or ""), t, f"size{k}", k, "own", k, k) for k, t in enumerate(TEXTS)
    ]
    return spark.createDataFrame([*rows, rows[0]], CLASHING)


def test_mixing_keeps_columns_of_any_name(docs):
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert rows and all(r["size"] == f"size{r.doc_id}" and r._own == r._row == r._words == r.doc_id for r in rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).selectExpr("doc_id", "first + second AS taken").collect()}
    for k in (1, 2, 5):
        assert sum(len(r.text.split()) for r in rows if r.doc_id == k) == taken[k]
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_scores_replace_a_column_of_their_name(docs):
    model = toxicity.Model(np.zeros(0, np.int64), np.zeros(0), -1.0)
    scored = toxicity.with_score(docs, model, "_toxicity")
    assert sorted(scored.columns) == sorted(docs.columns)
    assert {round(r._toxicity, 6) for r in scored.collect()} == {0.268941}


@pytest.mark.parametrize("base", [0.0, 2.0, -2.0])
def test_nothing_is_rejected_without_evidence(docs, base):
    model = toxicity.Model(np.zeros(0, np.int64), np.zeros(0), base)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.without_toxic(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("base", [2.0, -2.0])
def test_evidence_rejects(docs, base):
    found = toxicity.feature_set(b"bad")
    model = toxicity.Model(found, np.full(len(found), 9.0), base)
    assert {r.doc_id for r in toxicity.without_toxic(docs, model).collect()} == {0, 1, 3, 4, 5}
