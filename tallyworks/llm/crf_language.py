"""Language of words and documents by a linear-chain conditional random field.

The words of a text are a chain of labels. A word speaks for its label by its character n-grams, its
affixes (n-grams that hold an end of the word) and, if it is in the lexicon, by itself; neighbouring labels by a
learned transition matrix. Forward-backward gives the probability of every label at every word, given the
whole text, so text that switches language is labelled piece by piece. A document's language is the label
of the largest summed probability; its score that sum's share.

Labels are known per document only. The model is fitted in numpy on a bounded sample: ``per_label``
documents of each language by a hash of their id, ``words_each`` consecutive words of each from a place drawn
by the same hash. Training chains are put together from pieces of documents of different languages, so that
transitions are learned from switches. The lexicon holds the sample's words seen ``lexicon_count`` times.

Long texts cost no long chain: forward-backward runs over all blocks of a task's slice of texts at once
with the transfer matrices of blocks, then along the blocks of each text, then inside them. The result is
that of the plain recursion.

Defined cases: null and empty texts and texts without a letter are ``und`` with a score of 0; a word
without a letter says nothing; without a labelled text all texts are ``und``; with one language all texts
with a letter are of it; ids may be null or repeat, as every row is read for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import plain_words, text_or_empty

BUCKETS = 1 << 15
NGRAMS = (1, 2, 3, 4)
PER_LABEL = 400
WORDS_EACH = 300
BLOCK = 32
SLICE_BYTES = 2_000_000


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # [buckets, labels]
    lexicon: np.ndarray  # sorted hashes of its words
    lexicon_weights: np.ndarray  # [words, labels]
    transitions: np.ndarray  # [labels, labels], log potentials

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``[words, labels]`` log potentials and whether a word has a letter."""
        owner, bucket, letters = word_features(words)
        out = np.empty((len(words), len(self.labels)))
        for label in range(len(self.labels)):
            out[:, label] = np.bincount(owner, self.weights[bucket, label], len(words))
        if len(self.lexicon):
            hashes = word_hashes(words)
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == hashes
            out[known] += self.lexicon_weights[at[known]]
        out[~letters] = 0
        return out, letters


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word, bucket)`` of every n-gram, and whether each word has a letter. Words hold no line feed."""
    joined = "\n" + "\n".join(words) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    end = code == 10
    word = np.cumsum(end) - 1
    known, place = np.unique(code, return_inverse=True)
    alpha = np.fromiter((chr(c).isalpha() for c in known), bool, len(known))[place]
    letters = np.bincount(word[alpha], minlength=len(words))[: len(words)] > 0
    owners, buckets = [], []
    for n in NGRAMS:
        if len(code) < n:
            continue
        size = len(code) - n + 1
        mixed = np.full(size, 0x811C9DC5 + n, np.uint32)
        inner = np.ones(size, bool)
        for k in range(n):
            part = code[k : k + size]
            mixed = (mixed ^ part) * np.uint32(0x01000193)
            mixed ^= mixed >> np.uint32(15)
            if 0 < k < n - 1:
                inner &= ~end[k : k + size]
        if n == 1:
            inner &= ~end[:size]
        if n == 2:
            inner &= ~(end[:size] & end[1 : 1 + size])
        at = np.flatnonzero(inner)
        owners.append(word[at])
        buckets.append((mixed[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15))
    return np.concatenate(owners), np.concatenate(buckets).astype(np.int64), letters


# --- forward-backward


def chain_marginals(potentials: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """``[words, labels]`` probabilities of labels in chains that lie one after another.

    ``potentials`` are positive factors per word, ``transitions`` between labels; the label before the first
    word is uniform. Chains are cut into blocks whose transfer matrices join them, exactly.
    """
    words, labels = potentials.shape
    blocks = -(-lengths // BLOCK)
    total = int(blocks.sum())
    starts = np.cumsum(lengths) - lengths
    chain = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = starts[chain] + nth * BLOCK
    last = (starts + lengths)[chain]
    at = first[None, :] + np.arange(BLOCK)[:, None]
    real = at < last[None, :]
    factor = np.where(real[..., None], potentials[np.minimum(at, max(words - 1, 0))], 1.0)

    # transfer matrix of every block, scaled as it grows
    move = np.broadcast_to(np.eye(labels), (total, labels, labels)).copy()
    for t in range(BLOCK):
        stepped = (move.reshape(-1, labels) @ transitions).reshape(total, labels, labels) * factor[t][:, None, :]
        move = np.where(real[t][:, None, None], stepped, move)
        move /= move.max(axis=(1, 2), keepdims=True)

    # messages into and out of the blocks, along each chain
    into = np.full((total, labels), 1.0 / labels)
    back = np.ones((total, labels))
    head = np.cumsum(blocks) - blocks
    for j in range(1, int(blocks.max()) if len(blocks) else 0):
        here = head[blocks > j] + j
        message = np.einsum("bl,blm->bm", into[here - 1], move[here - 1])
        into[here] = message / message.sum(axis=1, keepdims=True)
        tail = (head + blocks)[blocks > j] - 1 - j
        message = np.einsum("blm,bm->bl", move[tail + 1], back[tail + 1])
        back[tail] = message / message.sum(axis=1, keepdims=True)

    forward = np.empty((BLOCK, total, labels))
    state = into
    for t in range(BLOCK):
        stepped = (state @ transitions) * factor[t]
        state = np.where(real[t][:, None], stepped, state)
        state = state / state.sum(axis=1, keepdims=True)
        forward[t] = state
    out = np.empty((words, labels))
    state = back
    for t in range(BLOCK - 1, -1, -1):
        both = forward[t] * state
        both /= both.sum(axis=1, keepdims=True)
        out[at[t][real[t]]] = both[real[t]]
        stepped = (state * factor[t]) @ transitions.T
        state = np.where(real[t][:, None], stepped, state)
        state = state / state.sum(axis=1, keepdims=True)
    return out


def _chain_gradient(potentials: np.ndarray, gold: np.ndarray, transitions: np.ndarray):
    """For chains of one length ``[chains, words, labels]``: log likelihood per word, gradients of both."""
    chains, words, labels = potentials.shape
    forward = np.empty((words, chains, labels))
    state, likelihood = np.full((chains, labels), 1.0 / labels), 0.0
    for t in range(words):
        state = (state @ transitions) * potentials[:, t]
        scale = state.sum(axis=1, keepdims=True)
        likelihood -= np.log(scale).sum()
        state = state / scale
        forward[t] = state
    emitted = np.empty_like(potentials)
    moved = np.zeros((labels, labels))
    state = np.ones((chains, labels))
    before = np.full((chains, labels), 1.0 / labels)
    for t in range(words - 1, -1, -1):
        both = forward[t] * state
        emitted[:, t] = both / both.sum(axis=1, keepdims=True)
        ahead = state * potentials[:, t]
        previous = forward[t - 1] if t else before
        z = ((previous @ transitions) * ahead).sum(axis=1, keepdims=True)
        moved += transitions * ((previous / z).T @ ahead)
        state = ahead @ transitions.T
        state = state / state.sum(axis=1, keepdims=True)
    index = np.arange(labels)
    emitted = (gold[..., None] == index).astype(float) - emitted
    seen = np.zeros((labels, labels))
    np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    # the label before the first word is unknown: its share of the move to the first label
    share = transitions / transitions.sum(axis=0)
    seen += share * np.bincount(gold[:, 0], minlength=labels)
    likelihood += np.log(np.take_along_axis(potentials, gold[..., None], 2)).sum() + (seen * np.log(transitions)).sum()
    return likelihood / (chains * words), emitted, seen, moved


def train(
    samples: list[tuple[str, list[str]]],
    chain_words: int = 40,
    chains: int = 3000,
    piece_words: int = 12,
    steps: int = 120,
    lexicon_count: int = 3,
    decay: float = 1e-3,
    seed: int = 7,
) -> Model | None:
    """The field fitted to documents given as language and words; None without any."""
    samples = [(lang, words) for lang, words in samples if words]
    labels = sorted({lang for lang, _ in samples})
    if not labels:
        return None
    by_label = {lang: [w for x, w in samples if x == lang] for lang in labels}
    rng = np.random.default_rng(seed)
    chains = min(chains, max(50, 3 * sum(len(w) for _, w in samples) // chain_words))
    texts, gold = [], np.empty((chains, chain_words), np.int64)
    for c in range(chains):
        line: list[str] = []
        while len(line) < chain_words:
            label = int(rng.integers(len(labels)))
            words = by_label[labels[label]][int(rng.integers(len(by_label[labels[label]])))]
            start = int(rng.integers(len(words)))
            piece = words[start : start + min(1 + int(rng.geometric(1 / piece_words)), chain_words - len(line))]
            gold[c, len(line) : len(line) + len(piece)] = label
            line += piece
        texts += line
    unique, place = np.unique(np.array(texts, dtype=object), return_inverse=True)
    words = unique.tolist()
    owner, bucket, letters = word_features(words)
    counts = np.bincount(place)
    in_lexicon = np.flatnonzero((counts >= lexicon_count) & letters)
    hashes = word_hashes(words)
    in_lexicon = in_lexicon[np.argsort(hashes[in_lexicon])]
    n = len(labels)
    params = [np.zeros((BUCKETS, n)), np.zeros((len(in_lexicon), n)), np.zeros((n, n))]
    means = [np.zeros_like(p) for p in params]
    squares = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        weights, lexicon, moves = params
        scores = np.stack([np.bincount(owner, weights[bucket, k], len(words)) for k in range(n)], axis=1)
        scores[in_lexicon] += lexicon
        scores[~letters] = 0
        scores -= scores.max(axis=1, keepdims=True)
        potentials = np.exp(np.maximum(scores, -30))[place].reshape(chains, chain_words, n)
        _, emitted, seen, moved = _chain_gradient(potentials, gold, np.exp(moves))
        by_word = np.stack([np.bincount(place, emitted[..., k].ravel(), len(words)) for k in range(n)], axis=1)
        by_word[~letters] = 0
        gradients = [
            np.stack([np.bincount(bucket, by_word[owner, k], BUCKETS) for k in range(n)], axis=1),
            by_word[in_lexicon],
            seen - moved,
        ]
        rate = 0.08 * (1 - (step - 1) / steps) + 0.004
        for p, m, v, g in zip(params, means, squares, gradients):
            g = g / chains - decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(labels, params[0].astype(np.float32), hashes[in_lexicon], params[1], params[2])


# --- Spark


def sample(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_label: int = PER_LABEL, words_each: int = WORDS_EACH
) -> DataFrame:
    """``lang, words``: at most ``per_label`` documents of each language, ``words_each`` words of each at most; the draw is by id and text."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("_l"), F.col(doc_id).cast("string").alias("_id"), F.col(text).alias("_text")
    )
    # one number per language, as the model has labels: texts meet it without a join
    counts = {r["_l"]: r["count"] for r in rows.groupBy("_l").count().collect()}
    if not counts:
        return rows.select(F.col("_l").alias("lang"), F.lit(0.0).alias("_draw"), F.array("_text").alias("words"))
    shares = F.create_map(*[x for label, n in sorted(counts.items()) for x in (F.lit(label), F.lit(per_label / n))])
    few = rows.withColumn("_hash", F.xxhash64("_id", "_text")).withColumn("_draw", F.pmod("_hash", F.lit(1 << 30)) / F.lit(float(1 << 30)))
    few = few.withColumn("_share", shares[F.col("_l")]).where(F.col("_draw") < F.col("_share"))
    # equal rows are drawn once, and no language gives more rows than the bound
    few = few.groupBy("_l", "_hash").agg(*[F.first(c).alias(c) for c in ("_text", "_draw", "_share")])
    few = few.withColumn("_rank", F.row_number().over(Window.partitionBy("_l").orderBy("_draw", "_hash"))).where(F.col("_rank") <= per_label)
    share = F.col("_share")
    words = few.select(F.col("_l").alias("lang"), "_draw", (F.col("_draw") / share).alias("_at"), plain_words(F.lower(text_or_empty("_text"))).alias("_w"))
    start = F.floor(F.col("_at") * F.greatest(F.size("_w") - words_each, F.lit(0))).cast("int") + 1
    return words.select("lang", "_draw", F.slice("_w", start, F.lit(words_each)).alias("words"))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_label: int = PER_LABEL, **options) -> Model | None:
    """The field fitted on a bounded sample of the labelled documents."""
    drawn = sample(docs, doc_id, text, lang, per_label).collect()
    drawn = sorted(((r["lang"], r["_draw"], r["words"]) for r in drawn), key=lambda r: r[:2] + (len(r[2]),))
    return train([(str(r[0]), r[2]) for r in drawn], **options)


def _slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes of text; a longer text is a range of its own."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + size, side="right")))
        yield at, end
        at = end


def label_texts(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities ``[words, labels]`` of all words of the texts, words per text, and which have a letter."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    words = split.flatten()
    keep = pc.greater(pc.binary_length(words), 0)
    owner = pc.list_parent_indices(split).filter(keep).to_numpy(zero_copy_only=False)
    lengths = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    coded = words.filter(keep).dictionary_encode()
    if not len(coded):
        return np.empty((0, len(model.labels))), lengths, np.empty(0, bool)
    place = coded.indices.to_numpy()
    emitted, letters = model.emissions(coded.dictionary.to_pylist())
    emitted = np.exp(np.maximum(emitted - emitted.max(axis=1, keepdims=True), -30))
    return chain_marginals(emitted[place], lengths, np.exp(model.transitions)), lengths, letters[place]


def _predictor(shared, kept: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        for batch in batches:
            texts = batch.column(kept)
            best, score, runs = [], [], []
            for start, end in _slices(texts):
                part = texts.slice(start, end - start)
                if model is None:
                    best += ["und"] * len(part)
                    score += [0.0] * len(part)
                    runs += [[]] * len(part)
                    continue
                chances, lengths, letters = label_texts(part, model)
                owner = np.repeat(np.arange(len(part)), lengths)
                n = len(model.labels)
                sums = np.stack([np.bincount(owner[letters], chances[letters, k], len(part)) for k in range(n)], axis=1)
                total = sums.sum(axis=1)
                top = sums.argmax(axis=1)
                best += [model.labels[t] if s > 0 else "und" for t, s in zip(top, total)]
                score += (sums.max(axis=1) / np.where(total > 0, total, 1)).clip(0, 1).tolist()
                # runs of words of one language; a word without letters goes by its neighbours
                word = chances.argmax(axis=1)
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
                begins = np.flatnonzero(new)
                sizes = np.diff(np.append(begins, len(word)))
                mine: list[list[dict]] = [[] for _ in range(len(part))]
                for o, w, s in zip(owner[begins].tolist(), word[begins].tolist(), sizes.tolist()):
                    mine[o].append({"lang": model.labels[w], "words": s})
                runs += mine
            columns = [batch.column(i) for i in range(kept)]
            runs_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
            arrays = [*columns, pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(runs, runs_type)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:kept], "lang_pred", "score", "runs"])

    return predict


def document_languages(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns, ``lang_pred``, ``score`` and ``runs``: the text as runs of words of one language.

    Kept columns that bear the name of a result give way to it.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "lang_pred", "score", "runs")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets, sample and languages
    rows = docs.select(*keep, text_or_empty(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(
        _predictor(shared, len(keep)), f"{kinds}, lang_pred string, score double, runs array<struct<lang: string, words: bigint>>"
    )
