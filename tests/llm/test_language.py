import itertools

import numpy as np
import pyarrow as pa
import pytest
from cases import all_documents, frame, small_documents
from pyspark.sql import functions as F

from tallyworks.llm import crf_language as crf


def plain_marginals(potentials, transitions):
    """By the sum over all label sequences."""
    words, labels = potentials.shape
    out = np.zeros((words, labels))
    for path in itertools.product(range(labels), repeat=words):
        weight = sum(transitions[s, path[0]] for s in range(labels)) / labels
        for t, y in enumerate(path):
            weight *= potentials[t, y] * (transitions[path[t - 1], y] if t else 1)
        for t, y in enumerate(path):
            out[t, y] += weight
    return out / out.sum(axis=1, keepdims=True)


def recursion(potentials, transitions):
    n, labels = potentials.shape
    f, b = np.empty_like(potentials), np.ones_like(potentials)
    s = np.full(labels, 1 / labels)
    for t in range(n):
        s = (s @ transitions) * potentials[t]
        s /= s.sum()
        f[t] = s
    for t in range(n - 2, -1, -1):
        b[t] = transitions @ (b[t + 1] * potentials[t + 1])
        b[t] /= b[t].sum()
    return f * b / (f * b).sum(axis=1, keepdims=True)


def test_marginals():
    rng = np.random.default_rng(1)
    transitions = rng.uniform(0.1, 2, (3, 3))
    short = rng.uniform(0.1, 2, (5, 3))
    assert np.allclose(crf.chain_marginals(short, np.array([5]), transitions), plain_marginals(short, transitions))
    lengths = np.array([0, 1, 31, 32, 33, 0, 64, 500, 2])
    long = np.exp(rng.normal(0, 4, (lengths.sum(), 3)))
    got = crf.chain_marginals(long, lengths, transitions)
    at = 0
    for n in lengths:
        if n:
            assert np.allclose(got[at : at + n], recursion(long[at : at + n], transitions))
        at += n


def test_gradients_of_the_field():
    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(4, 6, 3)), rng.normal(size=(3, 3))
    gold = rng.integers(0, 3, (4, 6))

    def likelihood(scores, moves):
        total = 0.0
        for chain, labels in zip(scores, gold):
            p, t = np.exp(chain), np.exp(moves)
            s = np.full(3, 1 / 3)
            for row in p:
                s = (s @ t) * row
            right = t[:, labels[0]].sum() / 3
            for i, y in enumerate(labels):
                right *= p[i, y] * (t[labels[i - 1], y] if i else 1)
            total += np.log(right / s.sum())
        return total

    _, emitted, seen, moved = crf._chain_gradient(np.exp(scores), gold, np.exp(moves))
    step = 1e-6
    for at in [(0, 0, 0), (1, 3, 2), (3, 5, 1)]:
        more = scores.copy()
        more[at] += step
        assert np.isclose((likelihood(more, moves) - likelihood(scores, moves)) / step, emitted[at], atol=1e-4)
    for at in [(0, 0), (1, 2), (2, 1)]:
        more = moves.copy()
        more[at] += step
        assert np.isclose((likelihood(scores, more) - likelihood(scores, moves)) / step, (seen - moved)[at], atol=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    docs = frame(spark, small_documents())
    return crf.fit(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))


def test_held_out_accuracy(spark, model):
    docs = frame(spark, small_documents()).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    got = crf.document_languages(docs, model, keep=["doc_id", "lang"]).collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_code_switched_text(model):
    """Pieces of two languages in one text are told apart word by word."""
    docs = small_documents()
    a = [d for d in docs if d[2] == "en" and len(d[1].split()) > 120][0][1].split()[:60]
    b = [d for d in docs if d[2] == "de" and len(d[1].split()) > 120][0][1].split()[:60]
    text = a[:30] + b[:30] + a[30:] + b[30:]
    gold = ["en"] * 30 + ["de"] * 30 + ["en"] * 30 + ["de"] * 30
    chances, lengths, _ = crf.label_texts(pa.array([" ".join(text)]), model)
    got = [model.labels[i] for i in chances.argmax(axis=1)]
    assert lengths.tolist() == [120] and sum(x == y for x, y in zip(got, gold)) >= 108


def test_odd_texts(spark, model):
    docs = frame(spark, all_documents() + [(1, "1234 ... 99", "en", "s"), (2, "é", "fr", "s"), (3, "x" * 50_000, "en", "s")])
    got = crf.document_languages(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        letters = any(c.isalpha() for c in r.asDict().get("text") or "") if "text" in r else None
        assert letters in (None, True, False) and (r.lang_pred != "und" or r.score == 0)
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[(1, 11)].lang_pred == "und" and by[(9001, 0)].lang_pred == "und" and by[(9002, 0)].runs == [] and by[(3, 50_000)].lang_pred != "und"
    long = [r for r in got if r.doc_id == 9005][0]
    assert sum(p["words"] for p in long.runs) == len([d for d in all_documents() if d[0] == 9005][0][1].split())


def test_empty_tables(spark, model):
    none = frame(spark, small_documents()).where("false")
    assert crf.fit(none) is None and crf.document_languages(none, model).count() == 0
    assert {r.lang_pred for r in crf.document_languages(frame(spark, small_documents()[:5]), None).collect()} == {"und"}
    one = crf.fit(frame(spark, [d for d in small_documents() if d[2] == "en"][:20]), steps=5)
    assert one.labels == ["en"]


def test_draw_is_bounded_with_null_and_repeated_ids(spark):
    rows = [(None if i % 3 else 5, f"text {i} of words", ["aa", "bb"][i % 2]) for i in range(3000)] + [(None, "one text many times", "aa")] * 2000
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = crf.sample(table, per_label=100).groupBy("lang").count().collect()
    assert {r.lang for r in got} == {"aa", "bb"} and all(10 < r["count"] <= 100 for r in got)
