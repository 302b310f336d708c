import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import words
from cases import all_documents, frame, small_documents
from pyspark.sql import functions as F

from tallyworks.llm import attention_lm as lm


@pytest.fixture(scope="module")
def fitted(spark):
    docs = frame(spark, small_documents())
    return lm.fit(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2))


def lowered(text):
    return [w.translate(str.maketrans(lm._UPPER, lm._UPPER.lower())) for w in words(text)]


def test_base_scores(spark, fitted):
    train = [d for d in small_documents() if zlib.crc32(str(d[0]).encode()) % 7 != 2]
    count = Counter(w for d in train for w in lowered(d[1]))
    total, distinct = sum(count.values()) + len(train), len(count) + 1
    docs = all_documents()
    got = Counter((r.doc, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm.document_scores(frame(spark, docs), fitted).collect())
    want = Counter()
    for d in docs:
        w = lowered(d[1])
        base = sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w) + math.log10((len(train) + 1) / (total + distinct + 1))
        want[d[0], len(w) + 1, sum(x in count for x in w) + 1, total, round(base, 6)] += 1
    assert got == want


def test_rare_words_by_the_join(spark, fitted):
    """With a handful of words at hand the others meet their counts in the join: same scores."""
    few = lm.Fitted(**{**fitted.__dict__, "common": dict(sorted(fitted.common.items(), key=lambda x: -x[1])[:20])})
    docs = frame(spark, [d for d in all_documents() if d[0] is not None])
    a = {(r.doc, r.n_tokens): r for r in lm.document_scores(docs, fitted).collect()}
    for r in lm.document_scores(docs, few).collect():
        other = a[r.doc, r.n_tokens]
        assert math.isclose(r.score, other.score, rel_tol=1e-9) and math.isclose(r.base_score, other.base_score, rel_tol=1e-9) and r.n_known == other.n_known


def score_of(fitted, texts):
    """Word by word from the ids' parts."""
    out = []
    for text in texts:
        mine, at = lowered(text), 0
        ids, sizes = fitted.encoder.words(mine)
        stream = np.append(ids.astype(np.int64), lm.END)
        classes, spelled, ended = lm.id_scores(fitted.model, stream, np.array([len(stream)]))
        total = 0.0
        for w, n in zip(mine, sizes):
            spelling = math.exp(float(np.sum(spelled[at : at + n], dtype=float)) + float(ended[at + n])) * 10**fitted.model.log10_new
            known = fitted.common.get(w, 0) * fitted.model.per_word[stream[at]]
            total += float(classes[at]) / math.log(10) + math.log10(known + spelling)
            at += n
        out.append(total + float(classes[at]) / math.log(10))
    return out


def test_scores(spark, fitted):
    docs = [d for d in small_documents() if len(words(d[1])) < 200][:30]
    got = {r.doc: r.score for r in lm.document_scores(frame(spark, docs), fitted).collect()}
    for d, want in zip(docs, score_of(fitted, [d[1] for d in docs])):
        assert math.isclose(got[d[0]], want, rel_tol=1e-4)


def test_layer_is_causal_and_sums_to_one(fitted):
    """Id by id with the window that scores it; later ids change nothing, and both distributions are whole."""
    m, rng = fitted.model, np.random.default_rng(3)
    ids = np.append(rng.integers(0, lm.IDS, 100), lm.END)
    inputs, places = lm.windows(ids, np.array([len(ids)]))
    assert sorted(places[places >= 0].tolist()) == list(range(len(ids)))
    logs = lm._log_shares(lm._forward(m, inputs)[-1])
    half = logs.shape[-1] // 2
    assert np.allclose(np.exp(logs[..., :half]).sum(axis=-1), 1, atol=1e-4) and np.allclose(np.exp(logs[..., half:]).sum(axis=-1), 1, atol=1e-4)
    changed = inputs.copy()
    changed[:, 20:] = rng.integers(0, lm.IDS, changed[:, 20:].shape)
    other = lm._log_shares(lm._forward(m, changed)[-1])
    assert np.allclose(logs[:, : 20 - lm.OVERLAP], other[:, : 20 - lm.OVERLAP], atol=1e-5)
    # attention of one place by hand
    x = m.embed[inputs[1]] + m.place
    at = 15
    weights = np.exp((x[at] @ m.query) @ (x[: at + 1] @ m.key).T)
    hidden = x[at] + (weights / weights.sum()) @ (x[: at + 1] @ m.value)
    odds = hidden @ m.out + m.bias + m.log_class[inputs[1, at]]
    assert np.allclose(lm._log_shares(odds[None, None].copy())[0, 0], logs[1, at - lm.OVERLAP], atol=1e-4)


def test_words_sum_to_one_at_most(fitted):
    """Known words and spellings: class parts times their shares."""
    m = fitted.model
    starts = fitted.encoder.starts()[: lm.IDS]
    by_class = Counter()
    for w, n in fitted.common.items():
        first = int(fitted.encoder.words([w])[0][0])
        by_class[int(m.of_class[first])] += n * m.per_word[first]
    assert all(x <= 1 - 10**m.log10_new + 1e-6 for x in by_class.values())
    for c in range(lm.CLASSES):
        member = starts & (m.of_class[: lm.IDS] == c)
        if member.any():
            assert math.isclose(float(np.exp(m.log_start[: lm.IDS][member]).sum()), 1, rel_tol=1e-4)
    inner = np.exp(m.log_inner[5])
    for c in range(lm.CLASSES + 1, 2 * lm.CLASSES + 1):
        member = ~starts & (m.of_class[: lm.IDS] == c)
        if member.any():
            assert math.isclose(float(inner[member].sum()), 1, rel_tol=1e-4)


def test_gradients(fitted):
    rng = np.random.default_rng(4)
    ids = np.append(rng.integers(0, lm.IDS, 60), lm.END)
    inputs, places = lm.windows(ids, np.array([len(ids)]))
    marked = rng.random(len(ids)) < 0.5
    before = np.append(False, marked[:-1])
    m = lm.Model(**{k: (v.astype(np.float64) if isinstance(v, np.ndarray) and v.dtype == np.float32 else v) for k, v in fitted.model.__dict__.items()})

    def loss(m):
        logs = lm._log_shares(lm._forward(m, inputs)[-1])
        real, half, total = places >= 0, logs.shape[-1] // 2, 0.0
        for w, t in zip(*np.nonzero(real)):
            at = places[w, t]
            kind = m.of_class[ids[at]]
            if kind < half:
                total -= logs[w, t, kind]
                if before[at] and inputs[w, t + lm.OVERLAP] != lm.END:
                    total -= logs[w, t, -1]
            elif marked[at]:
                total -= logs[w, t, kind]
        return total / real.sum()

    grads, base, step = lm._gradients(m, inputs, places, ids, marked, before), loss(m), 1e-5
    for name, at in [("query", (3, 2)), ("key", (1, 5)), ("value", (0, 7)), ("out", (2, 3)), ("bias", (4,)), ("place", (10, 1)), ("embed", (int(ids[9]), 2))]:
        old = getattr(m, name)
        more = old.copy()
        more[at] += step
        setattr(m, name, more)
        assert np.isclose((loss(m) - base) / step, grads[name][at], atol=2e-3), name
        setattr(m, name, old)


def test_gradients_take_asked_places_only(fitted, monkeypatch):
    """The layer is not worked out at ids inside words that nobody learns to spell from, and nothing is lost by it."""
    m, starts = fitted.model, fitted.encoder.starts()[: lm.IDS]
    begin, inside = np.flatnonzero(starts), np.flatnonzero(~starts)
    ids = np.append(np.resize([begin[3], *inside[5:10]], 144), lm.END).astype(np.int64)
    marked = np.zeros(len(ids), bool)
    marked[6:12] = True
    inputs, places = lm.windows(ids, np.array([len(ids)]))
    before, worked, forward = np.append(False, marked[:-1]), [], lm._forward

    def counting(*args):
        out = forward(*args)
        worked.append(out[-1].shape[0] * out[-1].shape[1])
        return out

    monkeypatch.setattr(lm, "_forward", counting)
    whole = lm._gradients(m, inputs, places, ids, marked, before)
    parts = [(i, lm._gradients(m, inputs[i : i + 1], places[i : i + 1], ids, marked, before)) for i in range(len(inputs))]
    # 24 word starts, 5 ids of the word to spell, the end
    assert sum(worked[1:]) == 30 and worked[0] < places.size
    real = (places >= 0).sum(axis=1)
    for k in lm.LEARNED:
        assert np.allclose(sum(g[k] * real[i] for i, g in parts) / real.sum(), whole[k], atol=1e-5), k


def test_training_helps(spark, fitted):
    """On held-out texts the trained layer is better than the counts it starts from."""
    held = [d for d in small_documents() if zlib.crc32(str(d[0]).encode()) % 7 == 2]
    untrained = lm.Model(**{**fitted.model.__dict__, "out": np.zeros_like(fitted.model.out), "bias": np.zeros_like(fitted.model.bias)})
    plain = lm.Fitted(**{**fitted.__dict__, "model": untrained})
    sums = [lm.document_scores(frame(spark, held), f).agg(F.sum("score")).first()[0] for f in (fitted, plain)]
    assert sums[0] > sums[1]


def test_words_are_split_as_told():
    coded, lengths = lm.split_words(pa.array(["A b c\x0bÄD", "", " \t\r\n"]))
    assert [coded.dictionary[i.as_py()].as_py() for i in coded.indices] == ["a", "b c", "Äd"] and lengths.tolist() == [3, 0, 0]


def test_empty_tables(spark, fitted):
    none = frame(spark, small_documents()).where("false")
    assert lm.document_scores(none, fitted).count() == 0
    untaught = lm.fit(none)
    got = lm.document_scores(frame(spark, [(1, "a word", "en", "s"), (2, None, "en", "s")]), untaught).orderBy("doc").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)] and all(r.score < 0 for r in got)


def tailed(docs):
    """The same words after the first 300 in another order: every count stays."""
    out = []
    for d in docs:
        w = words(d[1])
        out.append((d[0], " ".join(w[:300] + w[300:][::-1]), *d[2:]))
    return out


def test_layer_reads_whole_texts(spark):
    """Words far behind the drawn ones, in texts that are not drawn, reach the layer."""
    docs = [d for d in small_documents() if len(words(d[1])) > 400]
    a, b = (lm.fit(frame(spark, x), sample_docs=0, sample_words=5).model for x in (tailed(tailed(docs)), tailed(docs)))
    assert np.array_equal(a.log_start, b.log_start) and not np.allclose(a.out, b.out, atol=1e-6)


def test_classes_read_all_texts(spark):
    """The matrix behind the id classes is that of whole texts, one by one."""
    docs = all_documents()
    rows = frame(spark, docs).select(F.col("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("body"))
    encoder = lm.Encoder.load()
    lists = lm.stored_ids(rows, encoder, {}, 4)
    want = np.zeros((lm.IDS, lm.IDS))
    for d in docs:
        ids, _ = encoder.words(lowered(d[1]))
        root = np.sqrt(np.bincount(ids.astype(np.int64), minlength=lm.IDS))
        want += np.outer(root, root)
    assert np.allclose(lm.shared_texts(lists), want, rtol=1e-4, atol=1e-3)


def test_gradient_over_all_windows(spark, fitted):
    """The sum of all tasks is the gradient over every window, however the rows are dealt out."""
    docs = [d for d in all_documents() if d[0] is not None]
    rows = frame(spark, docs).select(F.col("doc_id").alias("doc"), F.coalesce("text", F.lit("")).alias("body"))
    streams, marks = [], []
    for d in docs:
        ids, sizes = fitted.encoder.words(lowered(d[1]))
        streams.append(np.append(ids.astype(np.int64), lm.END))
        marks.append(np.append(np.repeat([fitted.common.get(w, 0) <= lm.SPELLED for w in lowered(d[1])], sizes), False).astype(bool))
    marked = np.concatenate(marks)
    inputs, places = lm.windows(np.concatenate(streams), np.array([len(x) for x in streams]))
    want = lm._gradients(fitted.model, inputs, places, np.concatenate(streams), marked, np.append(False, marked[:-1]))
    for parts in (1, 7):
        got = lm.gradient(lm.stored_ids(rows.repartition(parts), fitted.encoder, fitted.common, 3), fitted.model)
        for k in lm.LEARNED:
            assert np.allclose(got[k], want[k], atol=1e-5), k


def test_draw_is_bounded_with_null_ids(spark):
    """Rows without an id are drawn by their text, and the layer starts from so many at most."""
    docs = [(None, f"text number {i} of many", "en", "s") for i in range(300)]
    seen = []
    old, lm.train = lm.train, lambda counted, texts, rare, **options: seen.extend(texts) or old(counted, texts, rare, **options)
    try:
        lm.fit(frame(spark, docs), sample_docs=20)
    finally:
        lm.train = old
    assert len(seen) == 20


def test_words_are_encoded_together():
    """One call for many words, with the ids that each word has alone."""
    encoder, many = lm.Encoder.load(), ["a", "don't", "Äd", "日本語", "\x1cx\x1f", " ", "1234567", "<|endoftext|>", "ab" * 3000, "a"]
    alone, calls = [encoder.encoding.encode_ordinary(" " + w) for w in many], []

    class Counting:
        def encode_ordinary(self, text):
            calls.append(text)
            return whole.encode_ordinary(text)

    whole, encoder.encoding = encoder.encoding, Counting()
    ids, sizes = encoder.words(many)
    assert len(calls) == 1 and ids.tolist() == sum(alone, []) and sizes.tolist() == [len(x) for x in alone]
    assert [len(x) for x in encoder.words([])] == [0, 0]


def test_gradient_is_worked_out_at_asked_places_only(fitted, monkeypatch):
    """Windows of many lengths are not filled up to the most that one of them asks for."""
    m, rng, worked, forward = fitted.model, np.random.default_rng(8), [], lm._forward
    texts = [np.append(rng.integers(0, lm.IDS, n), lm.END) for n in (0, 1, 30, 200, 333)]
    ids, lengths = np.concatenate(texts), np.array([len(x) for x in texts])
    marked = (rng.random(len(ids)) < 0.3) & (ids != lm.END)

    def counting(*args):
        out = forward(*args)
        worked.append(out[-1].shape[0] * out[-1].shape[1])
        return out

    want = lm._gradients(m, *lm.windows(ids, lengths), ids, marked, np.append(False, marked[:-1]))
    monkeypatch.setattr(lm, "_forward", counting)
    raw = (ids + marked * lm._MARK).astype("<i2")
    stops = np.cumsum(lengths)
    lists = pa.array([raw[b - n : b].tobytes() for b, n in zip(stops, lengths)], pa.binary())
    shared = type("Shared", (), {"value": m})
    (row,) = lm._gradient_sums(shared)(iter([pa.RecordBatch.from_arrays([lists], names=["ids"])]))
    total = np.frombuffer(row.column(0)[0].as_buffer(), np.float64)
    assert total[0] == len(ids) and sum(worked) == ((m.of_class[ids] <= lm.CLASSES) | marked).sum()
    got = np.concatenate([want[k].ravel() for k in lm.LEARNED])
    assert np.allclose(total[1:] / total[0], got, atol=1e-6)


def test_large_exponents(fitted):
    """Sums of exponentials neither overflow nor vanish, whatever the layer has learned."""
    rng = np.random.default_rng(9)
    ids = np.append(rng.integers(0, lm.IDS, 90), lm.END)
    lengths = np.array([len(ids)])
    inputs, places = lm.windows(ids, lengths)
    marked = rng.random(len(ids)) < 0.5
    wild = lm.Model(**{**fitted.model.__dict__, "embed": fitted.model.embed * 30, "out": fitted.model.out * 30})
    whole = lm.Model(**{k: (v.astype(np.float64) if isinstance(v, np.ndarray) and v.dtype == np.float32 else v) for k, v in wild.__dict__.items()})
    assert lm.Tables(fitted.model).calm and not lm.Tables(wild).calm
    for a, b in zip(lm.id_scores(wild, ids, lengths), lm.id_scores(whole, ids, lengths)):
        assert np.isfinite(a).all() and np.allclose(a, b, rtol=1e-2, atol=0.5)
    args = inputs, places, ids, marked, np.append(False, marked[:-1])
    a, b = lm._gradients(wild, *args), lm._gradients(whole, *args)
    for k in lm.LEARNED:
        assert np.isfinite(a[k]).all() and np.allclose(a[k], b[k], rtol=1e-2, atol=1e-2 * np.abs(b[k]).max()), k
