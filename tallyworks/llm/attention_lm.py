"""Scores of texts by a small causal self-attention model on subword ids, beside an add-one word model.

A text is its words and an end. Words become subword ids by the first ranks of a public byte-level vocabulary
(every byte is an id, so every text has one). Ids that begin a word and ids inside one are parted into classes by
the training texts in which they occur together.

One causal self-attention layer (embeddings, places, one head, residual) reads a window of ids and gives two
distributions at each place: the class of the next word's first id, or the end of the text; and inside a word
the class of its next id, or the word's end. A word then has the probability

    P(class of its first id | window) * (known * count / counts of the class + new * spelling)

where ``spelling`` is the product over its ids of P(class | window) * P(id | last id, class). The shares ``known``
and ``new`` are those of seen and unseen words by Good and Turing; word counts, ids of distinct words and class totals are
counted over all of the training part. All words' and the end's probabilities sum to one at most. The layer's odds start
at what the corpus counts say without a window.

Learning: the ids of all training texts are stored once, dealt into ``ROUNDS`` parts by a hash of id and text. The
classes come from one matrix of ids by ids, summed over all texts. The layer starts from some steps of Adam on a
bounded draw, which only shortens the way; then every part is one step of Adam with the gradient over all windows of
its whole texts. Tasks sum what they read, some tasks sum those sums: no step depends on how rows are dealt out.

Scoring: windows overlap by ``OVERLAP`` ids, each id is scored once, by the window in which it has at least
that much before it; windows of all texts of a slice are one batch with a causal mask.

Base scores and known words need the corpus count of every word. The most frequent words, ``common`` at most, are
looked up where the text is read; each other word meets its count in one join on the word, which therefore has
no hot key, and is summed per document.

Defined cases: null and empty texts are an end alone; a null id is trained on; rows that repeat id and
text give as many rows; without training texts all counts are 0 and the odds are even.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored, text_or_empty
from tallyworks.session import new_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
IDS = 1024
END = IDS
WINDOW, OVERLAP = 32, 8
WIDTH = 16
CLASSES = 16  # of ids that begin words, and as many of ids inside
COMMON = 300_000
# the layer learns to spell from words seen this often or less
SPELLED = 3
# texts that the layer starts from, before it is led over all of them
SAMPLE_DOCS, SAMPLE_WORDS = 1500, 250
# steps in which all training texts are read once
ROUNDS = 16
# windows at a time: more leave the processor's cache
CHUNK = 128
# tasks that add up the sums of the tasks that read
SUMMING = 8
SLICE_BYTES = 4_000_000
# bytes of stored ids at a time
STREAM_BYTES = 2_000_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# weight of the distribution without the last id
SMOOTH = 3.0
# words that are encoded at a time
WORDS = 200_000


# --- subword ids


@dataclass
class Encoder:
    """Ids of words by the first ranks of a vocabulary file; words are given their leading blank."""

    ranks: dict[bytes, int]

    @staticmethod
    def load(path: str = VOCABULARY, ids: int = IDS) -> Encoder:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if int(b) < ids}
        return Encoder(ranks)

    def __post_init__(self):
        import tiktoken

        # a word with its leading blank is one piece: nothing but the ranks decides where it is cut
        self.encoding = tiktoken.Encoding("words", pat_str=" [^ ]+", mergeable_ranks=self.ranks, special_tokens={})
        self.begins = self.starts()

    def __reduce__(self):
        return Encoder, (self.ranks,)

    def starts(self) -> np.ndarray:
        """Which ids begin a word."""
        out = np.zeros(IDS + 1, bool)
        for token, i in self.ranks.items():
            out[i] = token[:1] == b" "
        return out

    def words(self, words: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)`` of the words, one after another. Words hold no blank."""
        words, out = words if isinstance(words, pa.Array) else pa.array(words, pa.string()), []
        for at in range(0, len(words), WORDS):
            some = words.slice(at, WORDS)
            # words are encoded together: an id that begins with a blank begins a word
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some.cast(pa.string())), " ")[0].as_py()
            out.append(np.array(self.encoding.encode_ordinary(" " + text), np.int16))
        if not out:
            return np.empty(0, np.int16), np.empty(0, np.int64)
        ids = np.concatenate(out)
        return ids, np.diff(np.flatnonzero(self.begins[ids]), append=len(ids))


# --- the model


@dataclass
class Model:
    of_class: np.ndarray  # [ids + end] class of an id: 0.. of starts, the end of the text, then of inner ids
    log_start: np.ndarray  # [ids + end] log P(first id | its class) of words not seen before
    log_inner: np.ndarray  # [ids + end, ids] log P(inner id | last id, its class)
    log_class: np.ndarray  # [ids + end, classes] odds without a window
    per_word: np.ndarray  # [ids] known / corpus count of the words whose first id is in the class of this one
    log10_new: float
    embed: np.ndarray
    place: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def id_classes(shared: np.ndarray, starts: np.ndarray, classes: int = CLASSES, seed: int = 11) -> np.ndarray:
    """Class of every id by k-means on the documents that ids share.

    ``shared`` is ``[ids, ids]``, the sum over texts of the roots of both ids' counts. ``classes`` of ids that begin
    words, the end of the text, then ``classes`` of inner ids; the end of a word is the last.
    """
    norm = np.sqrt(np.diag(shared))
    scale = np.where(norm > 0, norm, 1)
    values, vectors = np.linalg.eigh(shared / scale[:, None] / scale[None, :])
    points = vectors[:, -12:] * np.sqrt(np.maximum(values[-12:], 0))
    points = points / np.maximum(np.sqrt((points**2).sum(axis=1, keepdims=True)), 1e-9)
    weight = norm + 1e-6
    rng, out = np.random.default_rng(seed), np.full(IDS + 1, classes)
    for kind, shift in ((starts[:IDS], 0), (~starts[:IDS], classes + 1)):
        mine, heavy = points[kind], weight[kind]
        centres = mine[rng.choice(len(mine), classes, replace=False, p=heavy / heavy.sum())]
        for _ in range(25):
            near = ((mine[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            for c in range(classes):
                if (near == c).any():
                    centres[c] = np.average(mine[near == c], axis=0, weights=heavy[near == c])
        out[:IDS][kind] = near + shift
    return out


def corpus_odds(counts: np.ndarray, texts: int, singles: int, of_class: np.ndarray, starts: np.ndarray, classes: int = CLASSES) -> dict:
    """The parts of the model that are counted. ``counts`` as of ``id_counts``, ``singles`` the words seen once."""
    follows, ends, first, tokens = counts[:IDS, :IDS], counts[:IDS, IDS], counts[IDS, :IDS], counts[IDS + 1, :IDS]
    kinds = 2 * classes + 2
    begin, inner = starts[:IDS], ~starts[:IDS]
    member = of_class[:IDS, None] == np.arange(kinds)[None, :]

    # first ids of new words, as often as distinct words have them
    one = (first + 0.5) * begin
    log_start = np.zeros(IDS + 1)
    log_start[:IDS][begin] = np.log(one[begin] / (one @ member)[of_class[:IDS][begin]])

    # the next id inside a distinct word, or its end, after the last id
    base = (follows.sum(axis=0) + 0.5) * inner
    share = (follows.sum() + 1) / (follows.sum() + ends.sum() + 2)
    plain = np.append(share * base / base.sum(), 1 - share)
    after = np.zeros((IDS + 1, IDS + 1))
    after[:IDS, :IDS], after[:IDS, IDS] = follows * inner, ends
    after = (after + SMOOTH * plain) / (after.sum(axis=1, keepdims=True) + SMOOTH)
    by_class = after[:, :IDS] @ member
    log_inner = np.zeros((IDS + 1, IDS))
    log_inner[:, inner] = np.log(after[:, :IDS][:, inner] / by_class[:, of_class[:IDS][inner]])

    # classes of first ids as often as words have them, whatever the last id
    words = tokens @ member
    log_class = np.zeros((IDS + 1, kinds))
    log_class[:, :classes] = np.log((words[:classes] + 1) / (words[:classes].sum() + texts + classes + 1))
    log_class[:, classes] = np.log((texts + 1) / (words[:classes].sum() + texts + classes + 1))
    log_class[:, classes + 1 : kinds - 1] = np.log(np.maximum(by_class[:, classes + 1 : kinds - 1], 1e-12))
    log_class[:, kinds - 1] = np.log(after[:, IDS])
    total = tokens.sum()
    new = min(max((singles + 1) / (total + 2), 1e-6), 1 - 1e-6)
    per_word = np.where(begin, (1 - new) / np.maximum(words[of_class[:IDS]], 1), 0.0)
    f32 = lambda a: a.astype(np.float32)
    return {
        "of_class": of_class, "log_start": f32(log_start), "log_inner": f32(log_inner), "log_class": f32(log_class), "per_word": per_word,
        "log10_new": float(np.log10(new)),
    }


def windows(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``[n, WINDOW]`` ids before ``[n, WINDOW - OVERLAP]`` places of scored ids in the stream.

    Every text starts after ends and closes with one; places beyond it are -1. ``lengths`` counts its ids with
    the closing end. The places that are not -1 are the stream in order.
    """
    step = WINDOW - OVERLAP
    count = -(-lengths // step)
    owner = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(lengths) - lengths)[owner]
    stop = start + lengths[owner]
    # place of the first scored id; its input is the id before it
    first = start + nth * step
    at = first[:, None] + np.arange(-OVERLAP - 1, step - 1)[None, :]
    inside = (at >= start[:, None]) & (at < stop[:, None])
    inputs = ids.take(at, mode="clip") if len(ids) else np.empty(at.shape, ids.dtype)
    inputs[~inside] = END
    goal = first[:, None] + np.arange(step)[None, :]
    return inputs, np.where(goal < stop[:, None], goal, -1)


# a place sees the ids up to its own
_SEES = (np.arange(WINDOW)[None, :] <= np.arange(OVERLAP, WINDOW)[:, None]).astype(np.float32)
# exponents up to this need not be made smaller: their sums neither overflow nor vanish in four bytes
_CALM = 50


class Tables:
    """What the layer works out from a single id or a single place, once per model."""

    def __init__(self, m: Model):
        end = lambda x, one: np.concatenate([x, np.full((len(x), 1), one, x.dtype)], axis=1)
        # with a one behind the values the weights are summed up where they meet the values, and the bias is one more row of ``out``
        self.ask, self.ask_place = end(m.embed, 0), end(m.place, 0)[OVERLAP:]
        self.query, self.query_place = m.embed @ m.query, (m.place @ m.query)[OVERLAP:]
        self.seen = end(np.concatenate([m.embed @ m.key, m.embed @ m.value], axis=1), 1)
        self.seen_place = end(np.concatenate([m.place @ m.key, m.place @ m.value], axis=1), 0)
        half = len(m.bias) // 2
        self.out = np.concatenate([m.out, m.bias[None]])
        self.back = end(m.out.T, 0)
        self.log_class = m.log_class
        apart = lambda x: [np.ascontiguousarray(x[:, :half]), np.ascontiguousarray(x[:, half:])]
        (self.out_first, self.out_inner), (self.log_first, self.log_inner) = apart(self.out), apart(m.log_class)
        self.halves = np.repeat(np.eye(2, dtype=m.out.dtype), half, axis=0)
        long = lambda x: float(np.sqrt((x * x).sum(axis=1).max()))
        most = lambda x, place: long(x) + long(place)
        key, value = (most(self.seen[:, some], self.seen_place[:, some]) for some in (slice(WIDTH), slice(WIDTH, 2 * WIDTH)))
        odds = (most(m.embed, m.place) + value) * long(m.out.T) + float(np.abs(m.bias).max())
        self.calm = most(self.query, self.query_place) * key < _CALM and odds < _CALM


def _hidden(t: Tables, inputs: np.ndarray, turn: np.ndarray | None = None):
    """The layer before its odds at all scored places, or at ``turn`` ([n, some] of them).

    The last id, keys and values, query, weights ``[n, some, WINDOW]`` before they are divided by their sums, what they are divided by,
    what is read by them and the sum with the id's own, both with a one behind.
    """
    seen = t.seen.take(inputs, axis=0)
    seen += t.seen_place
    last = inputs[:, OVERLAP:] if turn is None else np.take_along_axis(inputs, OVERLAP + turn, 1)
    at = (lambda a: a) if turn is None else (lambda a: a.take(turn, axis=0))
    query = t.query.take(last, axis=0)
    query += at(t.query_place)
    keys = seen[..., :WIDTH].transpose(0, 2, 1)
    weights = query @ (np.ascontiguousarray(keys) if turn is None else keys)
    sees = at(_SEES)
    if not t.calm:
        weights += np.where(sees > 0, np.float32(0), np.float32(-1e9))
        weights -= weights.max(axis=2, keepdims=True)
    np.exp(weights, out=weights)
    weights *= sees
    mixed = weights @ seen[..., WIDTH:]
    share = np.repeat(1 / mixed[..., WIDTH:], WIDTH + 1, axis=2)
    mixed *= share
    hidden = t.ask.take(last, axis=0)
    hidden += at(t.ask_place)
    hidden += mixed
    return last, seen, query, weights, share, mixed, hidden


def _forward(m: Model, inputs: np.ndarray, turn: np.ndarray | None = None, tables: Tables | None = None):
    """The layer and its odds ``[n, some, kinds]``."""
    t = tables or Tables(m)
    parts = _hidden(t, inputs, turn)
    last, hidden = parts[0], parts[-1]
    odds = hidden.reshape(-1, WIDTH + 1) @ t.out
    odds += t.log_class.take(last.ravel(), axis=0)
    return *parts, odds.reshape(*last.shape, -1)


def _log_sum(odds: np.ndarray, calm: bool = False) -> np.ndarray:
    """Log of the sums of the exponentials along the last axis; calm odds are overwritten."""
    most = None if calm else odds.max(axis=-1, keepdims=True)
    sums = np.log((np.exp(odds, out=odds) if calm else np.exp(odds - most)) @ np.ones(odds.shape[-1], odds.dtype))
    return sums if calm else sums + most[..., 0]


def _log_shares(odds: np.ndarray) -> np.ndarray:
    """Log probabilities of the two distributions that lie side by side; in place."""
    half = odds.shape[-1] // 2
    for part in (odds[..., :half], odds[..., half:]):
        part -= _log_sum(part)[..., None]
    return odds


def id_scores(m: Model, ids: np.ndarray, lengths: np.ndarray, chunk: int = CHUNK, tables: Tables | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per id of a stream of texts, natural logs: of its class if it starts a word or ends the text (else 0), of its
    spelling, and of the word before it ending there (0 if it is inside a word).
    """
    t = tables or Tables(m)
    inputs, places = windows(ids, lengths)
    half = m.bias.shape[0] // 2
    kinds = m.of_class.take(ids)
    classes, second = np.zeros(len(ids), np.float32), np.zeros(len(ids), np.float32)
    # where in the odds of the second half: the class of an id inside a word, or the end of the word before
    own = np.where(kinds < half, half - 1, kinds - half)
    for at in range(0, len(inputs), chunk):
        last, *_, hidden = _hidden(t, inputs[at : at + chunk])
        last, hidden = last.ravel(), hidden.reshape(-1, WIDTH + 1)
        goal = places[at : at + chunk].ravel()
        real = np.flatnonzero(goal >= 0)
        odds = hidden @ t.out_inner
        odds += t.log_inner.take(last, axis=0)
        mine = odds.ravel().take(np.arange(0, odds.size, half) + own.take(goal, mode="clip"))
        mine -= _log_sum(odds, t.calm)
        # the real places are the stream in order
        here = slice(goal[real[0]], goal[real[-1]] + 1)
        second[here] = mine.take(real)
        begin = real.take(np.flatnonzero(kinds[here] < half))
        goal = goal.take(begin)
        odds = hidden.take(begin, axis=0) @ t.out_first
        odds += t.log_first.take(last.take(begin), axis=0)
        mine = odds.ravel().take(np.arange(0, odds.size, half) + kinds.take(goal))
        mine -= _log_sum(odds, t.calm)
        classes[goal] = mine
    before = np.append(END, ids[:-1])[: len(ids)]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = END
    inner = np.flatnonzero(kinds >= half)
    spelled = m.log_start.take(ids)
    spelled[inner] = second.take(inner) + m.log_inner.ravel().take(before.take(inner) * IDS + ids.take(inner))
    second[inner] = 0
    return classes, spelled, second


LEARNED = ["embed", "place", "query", "key", "value", "out", "bias"]


class Adam:
    """Steps of Adam on the learned parts of a model."""

    def __init__(self, model: Model):
        self.model, self.steps = model, 0
        self.means = {k: np.zeros(getattr(model, k).shape) for k in LEARNED}
        self.squares = {k: np.zeros(getattr(model, k).shape) for k in LEARNED}

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        for k in LEARNED:
            mean, square = self.means[k], self.squares[k]
            mean += 0.1 * (grads[k] - mean)
            square += 0.01 * (grads[k] ** 2 - square)
            step = rate * (mean / (1 - 0.9**self.steps)) / (np.sqrt(square / (1 - 0.99**self.steps)) + 1e-7)
            setattr(self.model, k, (getattr(self.model, k) - step).astype(np.float32))


def train(counted: dict, texts: list[np.ndarray], rare: list[np.ndarray], epochs: int = 3, batch: int = 256, rate: float = 0.01, seed: int = 5) -> Model:
    """The layer fitted to texts given as ids; ``rare`` marks the ids of words to learn spelling from."""
    rng = np.random.default_rng(seed)
    kinds = counted["log_class"].shape[1]
    f32 = lambda a: a.astype(np.float32)
    scale = WIDTH**-0.5
    model = Model(
        **counted,
        embed=f32(rng.normal(0, 0.3, (IDS + 1, WIDTH))), place=f32(rng.normal(0, 0.1, (WINDOW, WIDTH))),
        query=f32(rng.normal(0, scale, (WIDTH, WIDTH)) * scale), key=f32(rng.normal(0, scale, (WIDTH, WIDTH))),
        value=f32(rng.normal(0, scale, (WIDTH, WIDTH))), out=np.zeros((WIDTH, kinds), np.float32), bias=np.zeros(kinds, np.float32),
    )
    if not texts:
        return model
    ids, marked = np.concatenate(texts), np.concatenate(rare)
    inputs, places = windows(ids, np.array([len(t) for t in texts]))
    before = np.append(False, marked[:-1])  # the id before belongs to a word to spell
    adam, total = Adam(model), epochs * -(-len(inputs) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            adam.step(_gradients(model, inputs[pick], places[pick], ids, marked, before), rate * (1 - adam.steps / total) + 0.0003)
    return model


def _by_row(rows: np.ndarray, of: np.ndarray, into: np.ndarray) -> None:
    """Sums of rows added to those rows of ``into`` that ``of`` tells."""
    of = of.astype(np.int16)
    order = np.argsort(of, kind="stable")
    of = of.take(order)
    new = np.ones(len(of), bool)
    np.not_equal(of[1:], of[:-1], out=new[1:])
    first = np.flatnonzero(new)
    # two numbers as a complex one: half as many sums
    pairs = rows.take(order, axis=0).view(np.result_type(rows.dtype, np.complex64))
    into[of[first]] += np.add.reduceat(pairs, first, axis=0).view(rows.dtype)


class GradientSums:
    """Sums over places of the gradient of their cross entropy, kept per id and place for as long as places are added."""

    def __init__(self, m: Model, tables: Tables | None = None):
        self.m, self.tables, self.real = m, tables or Tables(m), 0
        self.seen, self.seen_place = np.zeros((IDS + 1, 2 * WIDTH)), np.zeros((WINDOW, 2 * WIDTH))
        self.ask, self.ask_place = np.zeros((IDS + 1, 2 * WIDTH)), np.zeros((WINDOW, 2 * WIDTH))
        self.out = np.zeros(self.tables.out.shape)

    def add(self, inputs: np.ndarray, turn: np.ndarray, kind: np.ndarray, first: np.ndarray, inner: np.ndarray, close: np.ndarray, real: int) -> None:
        """The places ``turn`` of windows, flags and classes of all of them in turn; ``real`` are the places of the windows."""
        t = self.tables
        half = len(self.m.bias) // 2
        last, seen, query, weights, share, mixed, hidden, odds = _forward(self.m, inputs, turn, t)
        flat = lambda a: a.reshape(-1, a.shape[-1])
        odds, number = flat(odds), odds.dtype
        if not t.calm:
            for part in (odds[:, :half], odds[:, half:]):
                part -= part.max(axis=1, keepdims=True)
        np.exp(odds, out=odds)
        asked = np.empty((len(odds), 2), number)
        asked[:, 0], asked[:, 1] = first, inner | close
        asked /= odds @ t.halves
        odds *= asked @ t.halves.T
        at = np.flatnonzero(first | inner)
        odds.reshape(-1)[at * 2 * half + kind.take(at)] -= 1
        odds[:, -1] -= close
        # what a weight gains by its value, less what all gain: the ones behind the values take the last column
        gain = odds @ t.back
        d_ask = np.empty((len(odds), 2 * WIDTH), number)
        d_ask[:, :WIDTH] = gain[:, :WIDTH]
        gain *= flat(share)
        gain[:, WIDTH] = (gain * flat(mixed)) @ np.full(WIDTH + 1, -1, number)
        gain = gain.reshape(hidden.shape)
        d_scores = gain @ seen[..., WIDTH:].transpose(0, 2, 1)
        d_scores *= weights
        d_seen = np.empty((*inputs.shape, 2 * WIDTH), number)
        np.matmul(d_scores.transpose(0, 2, 1), query, out=d_seen[..., :WIDTH])
        np.matmul(weights.transpose(0, 2, 1), gain[..., :WIDTH], out=d_seen[..., WIDTH:])
        d_ask[:, WIDTH:] = flat(d_scores @ seen[..., :WIDTH])
        _by_row(flat(d_seen), inputs.ravel(), self.seen)
        self.seen_place += (np.ones(len(inputs), number) @ d_seen.reshape(len(inputs), -1)).reshape(WINDOW, -1)
        _by_row(d_ask, last.ravel(), self.ask)
        self.ask_place[OVERLAP:] += np.eye(WINDOW - OVERLAP, dtype=number).take(turn.ravel(), axis=0).T @ d_ask
        self.out += flat(hidden).T @ odds
        self.real += real

    def sums(self) -> dict[str, np.ndarray]:
        """Of the learned parts."""
        m = self.m
        back = np.concatenate([m.key, m.value], axis=1).T
        to_x = lambda seen, ask: seen @ back + ask[:, :WIDTH] + ask[:, WIDTH:] @ m.query.T
        by_seen = m.embed.T @ self.seen + m.place.T @ self.seen_place
        return {
            "embed": to_x(self.seen, self.ask),
            "place": to_x(self.seen_place, self.ask_place),
            "query": (m.embed.T @ self.ask + m.place.T @ self.ask_place)[:, WIDTH:],
            "key": by_seen[:, :WIDTH],
            "value": by_seen[:, WIDTH:],
            "out": self.out[:WIDTH],
            "bias": self.out[WIDTH],
        }


def _gradients(m: Model, inputs: np.ndarray, places: np.ndarray, ids: np.ndarray, marked: np.ndarray, before: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy of classes; of inner classes and word ends in the marked words only."""
    half = m.bias.shape[0] // 2
    real = places >= 0
    at = np.maximum(places, 0)
    kind = m.of_class[ids[at]]
    first = real & (kind < half)
    inner = real & (kind >= half) & marked[at]
    close = first & before[at] & (inputs[:, OVERLAP:] != END)
    # the places of a window that are asked for come first; the layer is not worked out at those that no window needs
    asked = first | inner
    turn = np.argsort(~asked, axis=1, kind="stable")[:, : max(1, int(asked.sum(axis=1).max(initial=0)))]
    sums = GradientSums(m)
    sums.add(inputs, turn, *(np.take_along_axis(a, turn, 1).ravel() for a in (kind, first, inner, close)), int(real.sum()))
    return {k: v / max(sums.real, 1) for k, v in sums.sums().items()}


def _add_stream(sums: GradientSums, ids: np.ndarray, marked: np.ndarray, lengths: np.ndarray, chunk: int = 2 * CHUNK) -> None:
    """All windows of a stream of texts, as ``_gradients``; windows of a chunk have as many places that are asked for."""
    inputs, places = windows(ids, lengths)
    half = len(sums.m.bias) // 2
    kinds = sums.m.of_class.take(ids)
    wanted = (kinds < half) | marked
    asked = wanted.take(places, mode="clip")
    asked &= places >= 0
    count = asked.sum(axis=1)
    order = np.argsort(count.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(count, minlength=1))
    sums.real += len(ids)
    for some in range(1, len(ends)):
        for at in range(ends[some - 1], ends[some], chunk):
            mine = order[at : min(at + chunk, ends[some])]
            turn = np.nonzero(asked.take(mine, axis=0))[1].reshape(-1, some)
            goal = np.take_along_axis(places.take(mine, axis=0), turn, 1).ravel()
            x = inputs.take(mine, axis=0)
            kind = kinds.take(goal)
            first = kind < half
            # the id before belongs to a word to spell, which ends here
            close = first & marked.take(goal - 1, mode="clip") & (goal > 0)
            close &= np.take_along_axis(x, OVERLAP + turn, 1).ravel() != END
            sums.add(x, turn, kind, first, ~first, close, 0)


# --- Spark: corpus counts


def _slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + size, side="right")))
        yield at, end
        at = end


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-case (A to Z) words of texts, coded, and the number per text."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    words = split.flatten()
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    # a text without words is split into one empty word
    empty = pc.equal(pc.binary_length(words), 0)
    if pc.any(empty).as_py():
        owner = np.repeat(np.arange(len(texts)), lengths)
        lengths -= np.bincount(owner[empty.to_numpy(zero_copy_only=False)], minlength=len(texts))
        words = words.filter(pc.invert(empty))
    return words.dictionary_encode(), lengths


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words and their numbers, slice by slice."""
    for batch in batches:
        texts = batch.column(0)
        for start, end in _slices(texts):
            coded, _ = split_words(texts.slice(start, end - start))
            counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(counts)], names=["word", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over rows with ``body``."""
    return texts.select("body").mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _count_ids(encoder: Encoder):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of ``last, next`` over the distinct words of a partition, see ``id_counts``."""
        sums = np.zeros((IDS + 2, IDS + 1), np.int64)
        for batch in batches:
            ids, lengths = encoder.words(batch.column(0))
            if not len(ids):
                continue
            ids = ids.astype(np.int64)
            ends = np.cumsum(lengths) - 1
            inner = np.ones(len(ids), bool)
            inner[ends] = False
            at = np.flatnonzero(inner)
            first = ids[ends - lengths + 1]
            np.add.at(sums, (ids[at], ids[at + 1]), 1)
            np.add.at(sums, (ids[ends], IDS), 1)
            np.add.at(sums, (IDS, first), 1)
            np.add.at(sums, (IDS + 1, first), batch.column(1).to_numpy())
        a, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sums[a, b])], names=["last", "next", "n"])

    return count


def id_counts(words: DataFrame, encoder: Encoder) -> np.ndarray:
    """``[last, next]`` counts of neighbours inside distinct words.

    The last column counts ends of words, row ``IDS`` first ids of distinct words, row ``IDS + 1`` first ids of all words.
    """
    counted = words.select("word", "n").mapInArrow(_count_ids(encoder), "last bigint, next bigint, n bigint")
    out = np.zeros((IDS + 2, IDS + 1))
    # at most (ids + 2)^2 rows, whatever the corpus
    table = counted.groupBy("last", "next").agg(F.sum("n").alias("n")).toArrow()
    out[table["last"].to_numpy(), table["next"].to_numpy()] = table["n"].to_numpy()
    return out


# --- Spark: fit and score


@dataclass
class Fitted:
    model: Model
    encoder: Encoder
    words: DataFrame  # word, n: counts of the training part
    common: dict[str, int]  # the most frequent of them
    tokens: int
    distinct: int
    texts: int


class Common:
    """Counts of words, looked up many words at a time."""

    def __init__(self, counts: dict[str, int]):
        self.words, self.n = pa.array(list(counts), pa.string()), np.append(np.fromiter(counts.values(), np.int64, len(counts)), -1)

    def counts(self, words: pa.Array) -> np.ndarray:
        """Of each word, -1 if it is not here."""
        return self.n.take(pc.fill_null(pc.index_in(words.cast(pa.string()), value_set=self.words), len(self.words)).to_numpy())


# --- Spark: sums over the ids of all training texts

_MARK = 2048  # added to an id of a word to learn spelling from
_TEXTS = "part int, draw bigint, ids binary"


def _text_ids(shared):
    """``part, draw, body`` -> ``part, draw, ids``: the ids of whole texts with their ends, marked, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, common = shared.value
        for batch in batches:
            for start, end in _slices(batch.column(2)):
                part = batch.slice(start, end - start)
                coded, lengths = split_words(part.column(2))
                ids, sizes = encoder.words(coded.dictionary)
                ids = ids + np.repeat(common.counts(coded.dictionary) <= SPELLED, sizes) * np.int16(_MARK)
                place = coded.indices.to_numpy() if len(coded) else np.empty(0, np.int64)
                stream, _, _, long = _laid_out(ids, sizes, place, lengths)
                raw, ends = stream.astype("<i2").tobytes(), np.cumsum(long) * 2
                out = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], names=["part", "draw", "ids"])

    return run


def stored_ids(rows: DataFrame, encoder: Encoder, common: dict[str, int], rounds: int) -> DataFrame:
    """``part, draw, ids`` of every row with ``doc, body``, written by part."""
    shared = rows.sparkSession.sparkContext.broadcast((encoder, Common({w: n for w, n in common.items() if n > SPELLED})))
    # id and text together: neither null nor repeated ids share a part or a draw
    drawn = rows.withColumn("draw", F.xxhash64(F.lit(3), F.col("doc").cast("string"), "body"))
    drawn = drawn.select(F.pmod("draw", F.lit(rounds)).cast("int").alias("part"), "draw", "body")
    path = new_folder(rows.sparkSession, "lm-ids")
    drawn.mapInArrow(_text_ids(shared), _TEXTS).write.partitionBy("part").parquet(path)
    return rows.sparkSession.read.schema("draw bigint, ids binary, part int").parquet(path)


def _streams(column: pa.Array, size: int = STREAM_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``ids, marked, lengths`` of some stored texts at a time."""
    for start, end in _slices(column, size):
        texts = column.slice(start, end - start)
        raw = np.frombuffer(b"".join(texts.to_pylist()), "<i2")
        yield (raw & (_MARK - 1)).astype(np.int64), raw >= _MARK, pc.binary_length(texts).to_numpy(zero_copy_only=False) // 2


def _add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column(0):
            value = np.frombuffer(x.as_buffer(), np.float64)
            total = value.copy() if total is None else total + value
    yield from _one_row(total)


def _one_row(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float64).tobytes()], pa.binary())], names=["sums"])


def _summed(parts: DataFrame) -> np.ndarray | None:
    """The sum of rows of one vector each: in some tasks, then of as many rows here."""
    rows = parts.repartition(SUMMING).mapInArrow(_add_sums, "sums binary").collect()
    return np.sum([np.frombuffer(r["sums"], np.float64) for r in rows], axis=0) if rows else None


def _share_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids`` of texts -> the lower half of the sum of products of the roots of their counts."""
    total = None
    for batch in batches:
        for ids, _, lengths in _streams(batch.column(0)):
            for at in range(0, len(lengths), 512):
                some = lengths[at : at + 512]
                first = int(lengths[:at].sum())
                owner = np.repeat(np.arange(len(some)), some)
                counts = np.bincount(owner * (IDS + 1) + ids[first : first + len(owner)], minlength=len(some) * (IDS + 1)).reshape(len(some), IDS + 1)
                roots = np.sqrt(counts[:, :IDS], dtype=np.float32)
                if total is None:
                    total = np.zeros((IDS, IDS))
                total += roots.T @ roots
    yield from _one_row(None if total is None else total[np.tril_indices(IDS)])


def shared_texts(texts: DataFrame) -> np.ndarray:
    """``[ids, ids]`` sums over all texts, see ``id_classes``."""
    out = np.zeros((IDS, IDS))
    # a task sends a sum of four megabytes: a few tasks a core rather than one for some small files
    texts = texts.coalesce(4 * texts.sparkSession.sparkContext.defaultParallelism)
    total = _summed(texts.select("ids").mapInArrow(_share_sums, "sums binary"))
    if total is not None:
        out[np.tril_indices(IDS)] = total
        out = out + np.tril(out, -1).T
    return out


def _gradient_sums(shared):
    """``ids`` of texts -> the number of their ids and the sum of their gradients, one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = GradientSums(shared.value)
        for batch in batches:
            for ids, marked, lengths in _streams(batch.column(0)):
                _add_stream(sums, ids, marked, lengths)
        yield from _one_row(np.concatenate([[sums.real], *(v.ravel() for v in sums.sums().values())]) if sums.real else None)

    return run


def gradient(texts: DataFrame, model: Model) -> dict[str, np.ndarray] | None:
    """The gradient over all windows of stored texts; None without any."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    total = _summed(texts.select("ids").mapInArrow(_gradient_sums(shared), "sums binary"))
    shared.destroy()
    if total is None:
        return None
    out, at = {}, 1
    for k in LEARNED:
        like = getattr(model, k)
        out[k] = total[at : at + like.size].reshape(like.shape) / total[0]
        at += like.size
    return out


def led_over(texts: DataFrame, model: Model, rounds: int = ROUNDS, rate: float = 0.01) -> Model:
    """The model after one step for every part of the texts."""
    adam = Adam(model)
    for part in range(rounds):
        grads = gradient(texts.where(F.col("part") == part), model)
        if grads is not None:
            adam.step(grads, rate * (1 - part / rounds) + 0.0003)
    return model


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS,
        sample_words: int = SAMPLE_WORDS, common: int = COMMON, rounds: int = ROUNDS, **options) -> Fitted:
    """Counts, id classes and the layer over all rows; its first steps on ``sample_docs`` of them with some ``sample_words`` words each."""
    rows = docs.select(F.col(doc_id).alias("doc"), text_or_empty(text).alias("body"))
    words = stored(word_counts(rows), "lm-words")
    texts = rows.count()
    # words by size of their count: some hundred rows
    size = F.floor(F.log2("n") * 8).cast("int")
    sizes = words.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).orderBy(F.desc("size")).collect()
    distinct, tokens = sum(r["v"] for r in sizes), sum(r["n"] for r in sizes)
    singles = sizes[-1]["v"] if sizes and sizes[-1]["size"] == 0 else 0
    held, least = 0, None
    for row in sizes:
        held += row["v"]
        if held > common:
            break
        least = row["size"]
    top = words.where(size >= least).toArrow() if least is not None else None
    table = dict(zip(top["word"].to_pylist(), top["n"].to_pylist())) if top is not None else {}

    encoder = Encoder.load(vocabulary)
    counts = id_counts(words, encoder)
    lists = stored_ids(rows, encoder, table, rounds)
    starts = encoder.starts()
    counted = corpus_odds(counts, texts, singles, id_classes(shared_texts(lists), starts), starts)
    # a stretch of the text from a place drawn with the document, as many bytes as words have in ids of two bytes
    size, long = F.lit(2 * 3 * sample_words), F.octet_length("ids")
    skip = F.floor(F.pmod(F.shiftrightunsigned("draw", 20), F.lit(1 << 20)) / float(1 << 20) * F.greatest(long - size, F.lit(0)) / 2).cast("int")
    few = lists.where(F.shiftrightunsigned("draw", 34) / float(1 << 30) < (2 * sample_docs + 100) / max(texts, 1))
    few = few.select("draw", F.substring("ids", 2 * skip + 1, size).alias("ids")).dropDuplicates(["draw"])
    drawn = few.orderBy("draw").limit(sample_docs).collect()
    raw = [np.frombuffer(r["ids"], "<i2") for r in sorted(drawn, key=lambda r: r["draw"])]
    model = train(counted, [(x % _MARK).astype(np.int64) for x in raw], [x >= _MARK for x in raw], **options)
    model = led_over(lists, model, rounds)
    return Fitted(model, encoder, words, table, tokens + texts, distinct + (texts > 0), texts)


_PART = pa.schema(
    [("word", pa.string()), ("texts", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
     ("score", pa.float64()), ("per_count", pa.float64()), ("spelling", pa.float64())]
)
_SCORED = "word string, texts bigint, tokens bigint, known bigint, base double, score double, per_count double, spelling double"


def _score(shared, kept: int):
    """A row per text with what is known here (``texts`` 1), and a row per word whose count is not at hand (``texts`` 0).

    Of the latter ``score`` is the class' part, ``per_count`` what one of its count is worth, ``spelling`` the log10 of the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encoder, common = shared.value
        tables = Tables(model)
        for batch in batches:
            for start, end in _slices(batch.column(kept)):
                part = batch.slice(start, end - start)
                coded, lengths = split_words(part.column(kept))
                unique = coded.dictionary
                place = coded.indices.to_numpy() if len(coded) else np.empty(0, np.int64)
                texts = part.num_rows
                owner = np.repeat(np.arange(texts), lengths)
                counts = common.counts(unique)
                here = counts.take(place)
                rare = here < 0
                base = np.bincount(owner, np.log10(np.maximum(counts, 0) + 1.0).take(place), texts)
                known = np.bincount(owner, ~rare, texts).astype(np.int64)
                per_count, classes, spelling, ends = word_scores(model, encoder, unique, place, lengths, tables)
                at = np.flatnonzero(~rare)
                with np.errstate(divide="ignore"):
                    word = classes.take(at) + np.log10(here.take(at) * per_count.take(at) + np.exp(spelling.take(at) * np.log(10)))
                score = np.bincount(owner.take(at), word, texts) + ends
                at = np.flatnonzero(rare)
                names = pa.nulls(texts, pa.string())
                words = pa.concat_arrays([names, coded.dictionary.cast(pa.string()).take(pa.array(place[at]))])
                zeros = np.zeros(len(at), np.int64)
                none = np.zeros(texts)
                both = lambda a, b: pa.array(np.concatenate([a, b]))
                rows = pa.array(np.concatenate([np.arange(texts), owner[at]]))
                columns = [part.column(i).take(rows) for i in range(kept)]
                columns += [
                    words, both(np.ones(texts, np.int64), zeros), both(lengths + 1, zeros), both(known, zeros), both(base, np.zeros(len(at))),
                    both(score, classes[at].astype(float)), both(none, per_count[at]), both(none, spelling[at].astype(float)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], *_PART.names])

    return run


def _laid_out(ids: np.ndarray, sizes: np.ndarray, place: np.ndarray, lengths: np.ndarray):
    """The ids of coded texts with their ends, the ids and the text of every word, and the ids of every text."""
    texts = len(lengths)
    per_word = sizes.take(place)
    owner = np.repeat(np.arange(texts), lengths)
    long = np.bincount(owner, per_word, texts).astype(np.int64) + 1
    # an end is one more word, after each text
    starts = np.append(np.cumsum(sizes) - sizes, len(ids))
    words = np.empty(len(place) + texts, np.int64)
    ends = np.cumsum(lengths) + np.arange(texts)
    words[np.arange(len(place)) + owner] = place
    words[ends] = len(sizes)
    sizes = np.append(sizes, 1).take(words)
    source = np.arange(int(sizes.sum()))
    source += np.repeat(starts.take(words) - (np.cumsum(sizes) - sizes), sizes)
    stream = np.append(ids, ids.dtype.type(END)).take(source).astype(np.int64)
    return stream, per_word, owner, long


def word_scores(model: Model, encoder: Encoder, unique: pa.Array, place: np.ndarray, lengths: np.ndarray, tables: Tables | None = None):
    """Per word of coded texts what a count of one is worth, log10 of its class and of its spelling as a new word; log10 of each text's end."""
    ids, sizes = encoder.words(unique)
    texts = len(lengths)
    stream, per_word, owner, long = _laid_out(ids, sizes, place, lengths)
    parts = [np.zeros(len(stream), np.float32) for _ in range(3)]
    # some texts at a time bound the memory of a slice
    bounds = np.cumsum(long)
    at = 0
    while at < texts:
        first = bounds[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(bounds, first + 400_000, side="right")))
        for out, values in zip(parts, id_scores(model, stream[first : bounds[stop - 1]], long[at:stop], tables=tables)):
            out[first : bounds[stop - 1]] = values
        at = stop
    classes, spelled, ended = parts
    begin = np.cumsum(per_word) - per_word + owner
    if len(begin):
        upto = np.concatenate([[0.0], np.cumsum(spelled, dtype=np.float64)])
        spelling = upto[begin + per_word] - upto[begin] + ended[begin + per_word]
    else:
        spelling = np.empty(0)
    log10 = np.log(10)
    return model.per_word[stream[begin]], classes[begin].astype(np.float64) / log10, spelling / log10 + model.log10_new, classes[bounds - 1] / log10


def document_scores(docs: DataFrame, fitted: Fitted, doc_id: str = "doc_id", text: str = "text", flag: Column | None = None) -> DataFrame:
    """``doc, flag, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    # the model and at most ``common`` words: of bounded size
    shared = docs.sparkSession.sparkContext.broadcast((fitted.model, fitted.encoder, Common(fitted.common)))
    rows = docs.select(
        F.col(doc_id).alias("doc"), (flag if flag is not None else F.lit(False)).alias("flag"), F.xxhash64(text).alias("hash"), text_or_empty(text).alias("body")
    )
    kind = rows.schema["doc"].dataType.simpleString()
    parts = rows.mapInArrow(_score(shared, 3), f"doc {kind}, flag boolean, hash bigint, {_SCORED}")
    # a text's own row meets no word: its key is no word, and spread by its hash
    named = parts.withColumn("word", F.coalesce("word", F.concat(F.lit("\n"), F.hex("hash"))))
    counts = fitted.words.select(F.col("word").alias("of"), "n")
    met = named.join(counts, F.col("word") == F.col("of"), "left")
    n, own = F.coalesce("n", F.lit(0)), F.col("texts") > 0
    mixed = F.when(n > 0, F.log10(n * F.col("per_count") + F.pow(F.lit(10.0), "spelling"))).otherwise(F.col("spelling"))
    summed = met.groupBy("doc", "hash", "flag").agg(
        F.sum("texts").alias("texts"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.col("known") + F.when(n > 0, 1).otherwise(0)).alias("known"),
        F.sum(F.when(own, F.col("base")).otherwise(F.log10(n + F.lit(1.0)))).alias("base"),
        F.sum(F.when(own, F.col("score")).otherwise(F.col("score") + mixed)).alias("score"),
    )
    one = {c: F.col(c) / F.col("texts") for c in ("tokens", "known", "base", "score")}
    tokens = one["tokens"].cast("bigint")
    scale = float(np.log10(fitted.tokens + fitted.distinct + 1))
    return summed.select(
        "doc",
        "flag",
        tokens.alias("n_tokens"),
        (one["known"].cast("bigint") + (1 if fitted.texts else 0)).alias("n_known"),
        F.lit(fitted.tokens).cast("bigint").alias("train_tokens"),
        (one["base"] + F.lit(float(np.log10(fitted.texts + 1.0))) - tokens * F.lit(scale)).alias("base_score"),
        one["score"].alias("score"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("texts"))).alias("_copy"),
    ).drop("_copy")
