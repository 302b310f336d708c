"""Alignment of two tokenizers over the bytes of a text, by fragments that compose.

Both token streams of a text cover the same bytes. Where a token of each ends at the same byte, a group ends.
A *fragment* is what a range of bytes knows of this: the tokens up to its first common end (open prefix), the
groups between its first and its last common end (closed), the tokens after that (open suffix). Two neighbouring
fragments compose into one: the left suffix and the right prefix together are one more group, the seam, as soon as the right one has a
common end. Composition is associative, so a long document is cut into byte ranges, ranges become fragments in any task,
and a tree of groupings composes their open ends. Closed groups stay where they were found; the
tree only hands on open ends and gives out seams.

Cuts of text. A *unit* begins at a space between two other characters that are not white space. Neither a word of the
byte-level pre-tokenizer nor a merge of the piece model (no piece holds a space after another character, which is checked when
it is loaded) reaches over such a space, so tokens of units are the tokens of the whole text. A byte range may end inside a unit: both
neighbours then read that unit whole and keep the tokens that end in their own range. A unit longer than a range stays whole.
Equal units have equal tokens, so a task tokenizes each distinct one once.

Links. A pair of overlapping tokens overlaps in one stretch between two neighbouring ends of either stream, and each such
stretch is one pair, so the links of a group are its distinct ends. Counts of id pairs over the corpus come from
sums per block of documents (some millions of characters); a block gets back the counts of its own distinct pairs, and its documents
sum them through the codes of their units. No table of all pairs is broadcast, no row per token is shuffled.

Defined cases: texts null, empty, or whose joined token bytes differ from space and text have zeros and an empty digest, and their tokens
count nowhere; every row is a document of its own, whether its id is null or repeated; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored

# bytes of a range; a document up to this size is one
RANGE_BYTES = 65_536
# characters of text whose documents form a block
BLOCK_CHARS = 4_000_000
# units that a worker keeps at hand between blocks
CACHE_UNITS = 200_000
# characters that are tokenized at once
ENCODE_CHARS = 100_000
# fragments that one composition takes
FAN_IN = 16


# --- the two tokenizers


def byte_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, others for 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Tokenizer A (byte-level, JSON file) and B (piece model, adds a space), with the bytes of their tokens."""

    def __init__(self, json_bytes: bytes, model_bytes: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_bytes.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
        back = byte_characters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any(" " in p.replace("▁", " ").lstrip(" ") for p in pieces):
            raise ValueError("a piece of B holds a space after another character: texts cannot be cut at spaces")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))

    def tokens(self, piece: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a piece that begins with the space that B adds; None if the bytes of one differ from it."""
        raw = piece.encode()
        ids_a = self.a.encode(piece, add_special_tokens=False).ids
        ids_b = self.b.encode(piece[1:])
        if b"".join([self.bytes_a[i] for i in ids_a]) != raw or b"".join([self.bytes_b[i] for i in ids_b]) != raw:
            return None
        return np.array(ids_a, np.int64), np.array(ids_b, np.int64)


_LOADED: dict[str, Pair] = {}


def loaded(files: tuple[bytes, bytes]) -> Pair:
    """The tokenizers of this worker, built once."""
    name = hashlib.sha1(files[0] + files[1]).hexdigest()
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Pair(*files)
    return _LOADED[name]


def tokenizer_files(json_path: str, model_path: str) -> tuple[bytes, bytes]:
    """Contents of the two vocabulary files, some megabytes, which go along with the tasks."""
    out = []
    for path in (json_path, model_path):
        try:
            with open(path, "rb") as file:
                out.append(file.read())
        except OSError as error:
            raise ValueError(f"the driver cannot read the vocabulary file {path}; give its path") from error
    return out[0], out[1]


# --- fragments


@dataclass
class Stream:
    """Token ids and the absolute byte at which each ends."""

    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ends: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def __add__(self, other: Stream) -> Stream:
        return Stream(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))

    def cut(self, low: int, high: int) -> Stream:
        """Tokens that end after ``low`` and up to ``high``."""
        at, to = np.searchsorted(self.ends, [low, high], side="right")
        return Stream(self.ids[at:to], self.ends[at:to])


@dataclass
class Fragment:
    """Open ends of a byte range. Without a common end all tokens are prefix; ``edge`` is the last common end."""

    prefix: tuple[Stream, Stream]
    edge: int | None = None
    suffix: tuple[Stream, Stream] = field(default_factory=lambda: (Stream(), Stream()))


def merged_ends(a: Stream, b: Stream) -> tuple[np.ndarray, np.ndarray]:
    """Bytes at which a token of either ends, and those at which one of each does, in order."""
    if not len(a.ends) or not len(b.ends):
        return np.concatenate([a.ends, b.ends]), np.empty(0, np.int64)
    base = min(a.ends[0], b.ends[0])
    marks = np.zeros(max(a.ends[-1], b.ends[-1]) - base + 1, np.uint8)
    marks[a.ends - base] = 1
    marks[b.ends - base] += 2
    return np.flatnonzero(marks) + base, np.flatnonzero(marks == 3) + base


def fragment(a: Stream, b: Stream) -> tuple[Fragment, tuple[Stream, Stream], int]:
    """The fragment of two streams, its closed tokens and the byte at which they begin."""
    _, common = merged_ends(a, b)
    if not len(common):
        return Fragment((a, b)), (Stream(), Stream()), 0
    first, last, top = int(common[0]), int(common[-1]), np.iinfo(np.int64).max
    closed = (a.cut(first, last), b.cut(first, last))
    return Fragment((a.cut(-1, first), b.cut(-1, first)), last, (a.cut(last, top), b.cut(last, top))), closed, first


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, tuple[Stream, Stream, int] | None]:
    """The fragment of both ranges and the group that closes where they meet, with the byte at which it begins."""
    joined = lambda x, y: (x[0] + y[0], x[1] + y[1])
    if left.edge is None:
        return Fragment(joined(left.prefix, right.prefix), right.edge, right.suffix), None
    met = joined(left.suffix, right.prefix)
    if right.edge is None:
        return Fragment(left.prefix, left.edge, met), None
    return Fragment(left.prefix, right.edge, right.suffix), (*met, left.edge)


def at_start() -> Fragment:
    """The empty range before a text: its end is common."""
    return Fragment((Stream(), Stream()), 0)


def links(a: Stream, b: Stream) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all overlapping pairs of closed tokens of both."""
    ends, _ = merged_ends(a, b)
    return a.ids[np.searchsorted(a.ends, ends)], b.ids[np.searchsorted(b.ends, ends)]


def group_texts(a: Stream, b: Stream) -> list[str]:
    """``a1,a2|b1`` of each closed group."""
    _, common = merged_ends(a, b)
    cuts_a, cuts_b = ([0, *(np.searchsorted(s.ends, common) + 1).tolist()] for s in (a, b))
    text_a, text_b = (list(map(str, s.ids.tolist())) for s in (a, b))
    return [
        (text_a[i] if j - i == 1 else ",".join(text_a[i:j])) + "|" + (text_b[k] if m - k == 1 else ",".join(text_b[k:m]))
        for i, j, k, m in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:])
    ]


# --- units: tokenized once per task


class Units:
    """Distinct units of a worker with their counts, links and group texts, as arrays that grow."""

    def __init__(self, pair: Pair):
        self.pair, self.known = pair, {}
        self.texts: list[str] = []
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links; -1 where the bytes differ
        self.link_a, self.link_b = np.empty(0, np.int32), np.empty(0, np.int32)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of new units

    def codes(self, units: list[str]) -> np.ndarray:
        """The number of each of the distinct units; unknown ones are tokenized."""
        known = self.known
        new = [u for u in units if u not in known]
        if new:
            # units that begin or end in white space, or whose bytes cannot come back, are tokenized alone
            clean = [u for u in new if not (u[1:2].isspace() or u[-1:].isspace() or len(u) == 1)]
            at, size = 0, 0
            for to, unit in enumerate(clean):
                size += len(unit)
                if size >= ENCODE_CHARS or to == len(clean) - 1:
                    self._add(clean[at : to + 1])
                    at, size = to + 1, 0
            for unit in new:
                if unit not in known:
                    self._add([unit])
            counts, link_a, link_b = zip(*self.found)
            self.counts = np.concatenate([self.counts, *counts])
            self.link_a, self.link_b = np.concatenate([self.link_a, *link_a]), np.concatenate([self.link_b, *link_b])
            self.found = []
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _add(self, units: list[str]) -> None:
        both = self.pair.tokens("".join(units))
        if both is None and len(units) > 1:
            # by halves down to the unit that does not come back
            self._add(units[: len(units) // 2])
            self._add(units[len(units) // 2 :])
            return
        for unit in units:
            self.known[unit] = len(self.known)
        if both is None:
            self.texts.append("")
            self.found.append((np.array([[-1, 0, 0, 0]]), np.empty(0, np.int32), np.empty(0, np.int32)))
            return
        a, b = (Stream(ids, np.cumsum(size[ids])) for ids, size in zip(both, (self.pair.size_a, self.pair.size_b)))
        ends = np.cumsum([len(u.encode()) for u in units])
        every, common = merged_ends(a, b)
        per_unit = lambda x: np.diff(np.searchsorted(x, ends, side="right"), prepend=0)
        groups = per_unit(common)
        link_a, link_b = links(a, b)
        counts = np.stack([per_unit(a.ends), per_unit(b.ends), groups, per_unit(every)], axis=1)
        self.found.append((counts, link_a.astype(np.int32), link_b.astype(np.int32)))
        texts, at = group_texts(a, b), 0
        for n in groups.tolist():
            self.texts.append(";".join(texts[at : at + n]))
            at += n


def split_units(texts: pa.Array, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the units of all texts, one after another, and the units per text; no text is null or empty."""
    split = pc.split_pattern(texts, " ")
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    words, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    opens = np.fromiter((w != "" and not w[0].isspace() for w in words), bool, len(words))[place]
    closes = np.fromiter((w != "" and not w[-1].isspace() for w in words), bool, len(words))[place]
    starts = np.ones(len(place), bool)
    starts[1:] = (owner[1:] != owner[:-1]) | (opens[1:] & closes[:-1])
    first = np.flatnonzero(starts)
    sizes = np.diff(np.append(first, len(place)))
    single = np.bincount(place[first[sizes == 1]], minlength=len(words)) > 0
    known = np.zeros(len(words), np.int64)
    wanted = np.flatnonzero(single)
    known[wanted] = units.codes([" " + words[i] for i in wanted])
    codes = known[place[first]]
    several = np.flatnonzero(sizes > 1)
    if len(several):
        runs = [" " + " ".join([words[j] for j in place[first[i] : first[i] + sizes[i]]]) for i in several]
        distinct = list(dict.fromkeys(runs))
        of = dict(zip(distinct, units.codes(distinct).tolist()))
        codes[several] = [of[r] for r in runs]
    return codes, np.bincount(owner[first], minlength=len(texts))


# --- long documents cut into ranges of bytes


def ranges(raw: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """``(start, end, from, to)``: byte ranges of a text with its space, and the whole units that hold each."""

    def next_cut(at: int) -> int:
        """The first start of a unit at ``at`` or after it, or the end."""
        while True:
            at = raw.find(b" ", at)
            if at < 0:
                return len(raw)
            if at and not _blank(raw[max(0, at - 4) : at], -1) and not _blank(raw[at + 1 : at + 5], 0):
                return at
            at += 1

    def last_cut(at: int) -> int:
        """The last start of a unit before ``at``, or the beginning."""
        while True:
            at = raw.rfind(b" ", 0, at)
            if at <= 0:
                return 0
            if not _blank(raw[max(0, at - 4) : at], -1) and not _blank(raw[at + 1 : at + 5], 0):
                return at

    start = begin = 0
    while start < len(raw):
        end = min(start + size, len(raw))
        to = next_cut(end)
        inside = max(last_cut(end), begin)
        if to - inside > size:
            end = to
        yield start, end, begin, to
        start, begin = end, to if end == to else inside


def _blank(near: bytes, place: int) -> bool:
    """Whether the character at that end of a few bytes is white space, or missing."""
    text = near.decode("utf-8", "ignore") if place == 0 else near.lstrip(bytes(range(128, 192))).decode()
    return not text or text[place].isspace()


_RANGES = pa.schema(
    [("uid", pa.string()), ("doc", pa.int64()), ("part", pa.int32()), ("parts", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("at", pa.int64()), ("piece", pa.string())]
)


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                raw, uid = b" " + text.as_py().encode(), uuid.uuid4().hex
                cuts = list(ranges(raw, size))
                rows = [(uid, doc.as_py(), i, len(cuts), low, high, at, raw[at:to].decode()) for i, (low, high, at, to) in enumerate(cuts)]
                # a few ranges at a time, as each holds its text
                for i in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_pylist([dict(zip(_RANGES.names, r)) for r in rows[i : i + 64]], _RANGES)

    return run


def _damaged(files: tuple[bytes, bytes]):
    """Ranges -> keys of those whose bytes do not come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(files)
        for batch in batches:
            bad = [u for u, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if pair.tokens(piece) is None]
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], ["uid"])

    return run


# --- blocks of documents


def packed(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32 with no more bits than the largest needs; the number of bits comes first."""
    bits = max(1, int(values.max()).bit_length()) if len(values) else 1
    flags = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return bytes([bits]) + np.packbits(flags.ravel()).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    flags = np.zeros((n, 32), np.uint8)
    flags[:, : data[0]] = np.unpackbits(np.frombuffer(data, np.uint8, offset=1), count=n * data[0]).reshape(n, data[0])
    return np.packbits(flags, axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)


_STREAM = "struct<a:array<bigint>,a_ends:array<bigint>,b:array<bigint>,b_ends:array<bigint>>"
_OPEN = f"uid string, part int, prefix {_STREAM}, edge bigint, suffix {_STREAM}"
_BLOCK = (
    "block string, docs array<struct<doc:bigint,uid:string,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,units:int>>, "
    "codes binary, links array<int>, pair_of binary, pairs array<struct<a:int,b:int,n:bigint>>, "
    f"open array<struct<uid:string,part:int,prefix:{_STREAM},edge:bigint,suffix:{_STREAM}>>, bodies array<struct<uid:string,part:int,body:string>>"
)
_ARROW_STREAM = pa.struct([(n, pa.list_(pa.int64())) for n in ("a", "a_ends", "b", "b_ends")])
_ARROW_BLOCK = pa.schema(
    [
        ("block", pa.string()),
        ("docs", pa.list_(pa.struct([("doc", pa.int64()), ("uid", pa.string()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("units", pa.int32())]))),
        ("codes", pa.binary()), ("links", pa.list_(pa.int32())), ("pair_of", pa.binary()),
        ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))),
        ("open", pa.list_(pa.struct([("uid", pa.string()), ("part", pa.int32()), ("prefix", _ARROW_STREAM), ("edge", pa.int64()), ("suffix", _ARROW_STREAM)]))),
        ("bodies", pa.list_(pa.struct([("uid", pa.string()), ("part", pa.int32()), ("body", pa.string())]))),
    ]
)


def _as_struct(streams: tuple[Stream, Stream]) -> dict:
    a, b = streams
    return {"a": a.ids.tolist(), "a_ends": a.ends.tolist(), "b": b.ids.tolist(), "b_ends": b.ends.tolist()}


def _as_streams(value: dict) -> tuple[Stream, Stream]:
    return tuple(Stream(np.array(value[n], np.int64), np.array(value[f"{n}_ends"], np.int64)) for n in ("a", "b"))


def _pieces(batch: pa.RecordBatch, column: int, chars: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + chars, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _block(batch: pa.RecordBatch, units: Units) -> pa.RecordBatch:
    """A block row out of documents (whole texts and ranges of long ones)."""
    pair = units.pair
    column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    n_rows = batch.num_rows
    docs = [None] * n_rows
    doc_ids, uids, sizes = column["doc"].to_pylist(), column["uid"].to_pylist(), pc.fill_null(pc.binary_length(column["piece"]), 0).to_numpy(zero_copy_only=False)
    whole = np.array([u is None for u in uids], bool)
    read = np.flatnonzero(whole & (sizes > 0))
    empty = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "units": 0}
    codes, per_text = split_units(column["piece"].take(pa.array(read)), units) if len(read) else (np.empty(0, np.int64), np.empty(0, np.int64))
    counts, ends = units.counts[codes], np.cumsum(per_text)
    bad = np.add.reduceat(counts[:, 0] < 0, ends - per_text) > 0 if len(read) else np.empty(0, bool)
    sums = np.add.reduceat(counts, ends - per_text, axis=0) if len(read) else np.empty((0, 4), np.int64)
    text_of = units.texts.__getitem__
    kept, code_list = [], codes.tolist()
    for k, row in enumerate(read.tolist()):
        if bad[k]:
            continue
        body = ";".join(map(text_of, code_list[ends[k] - per_text[k] : ends[k]]))
        n_a, n_b, n_groups, n_links = sums[k].tolist()
        docs[row] = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": hashlib.sha256(body.encode()).hexdigest(), "units": int(per_text[k])}
        kept.append((row, codes[ends[k] - per_text[k] : ends[k]]))

    # links per unit of the block, each range of a long document being a unit of its own
    used, inverse = np.unique(np.concatenate([c for _, c in kept]), return_inverse=True) if kept else (np.empty(0, np.int64), np.empty(0, np.int64))
    n_links = units.counts[used, 3] if len(used) else np.empty(0, np.int64)
    begins = (np.cumsum(np.maximum(units.counts[:, 3], 0)) - np.maximum(units.counts[:, 3], 0))[used] if len(used) else n_links
    take = np.arange(int(n_links.sum())) + np.repeat(begins - (np.cumsum(n_links) - n_links), n_links)
    link_a, link_b, times = [units.link_a[take]], [units.link_b[take]], [np.repeat(np.bincount(inverse, minlength=len(used)), n_links)]
    sizes_of, own_codes, opened, bodies = [n_links], {}, [], []
    next_code = len(used)
    for row in np.flatnonzero(~whole).tolist():
        low, high, at = (column[n][row].as_py() for n in ("low", "high", "at"))
        part = column["part"][row].as_py()
        tokens = pair.tokens(column["piece"][row].as_py())
        if tokens is None:
            raise ValueError("a range of a document that was found whole does not come back")
        a, b = (Stream(ids, at + np.cumsum(size[ids])).cut(low, high) for ids, size in zip(tokens, (pair.size_a, pair.size_b)))
        found, closed, _ = fragment(a, b)
        if part == 0:
            found, seam = compose(at_start(), found)
            if seam:
                closed = (seam[0] + closed[0], seam[1] + closed[1])
        texts = group_texts(*closed)
        la, lb = links(*closed)
        link_a.append(la.astype(np.int32)), link_b.append(lb.astype(np.int32)), times.append(np.ones(len(la), np.int64))
        sizes_of.append(np.array([len(la)]))
        own_codes[row], next_code = next_code, next_code + 1
        docs[row] = {"n_a": len(a.ids), "n_b": len(b.ids), "n_groups": len(texts), "n_links": len(la), "groups_sha256": "", "units": 1}
        opened.append({"uid": uids[row], "part": part, "prefix": _as_struct(found.prefix), "edge": found.edge, "suffix": _as_struct(found.suffix)})
        bodies.append({"uid": uids[row], "part": part, "body": ";".join(texts)})
    key = np.concatenate(link_a).astype(np.int64) * len(pair.bytes_b) + np.concatenate(link_b)
    distinct, pair_of = np.unique(key, return_inverse=True)
    total = np.bincount(pair_of, np.concatenate(times), len(distinct)).astype(np.int64) if len(key) else np.empty(0, np.int64)
    # codes in the order of rows: documents of units first, then ranges
    rows = [row for row, _ in kept] + sorted(own_codes)
    all_codes = np.concatenate([inverse, np.array([own_codes[r] for r in sorted(own_codes)], np.int64)])
    order = rows + [r for r in range(n_rows) if docs[r] is None]
    listed = [{"doc": doc_ids[r], "uid": uids[r], **(docs[r] or empty)} for r in order]
    pairs = [{"a": x // len(pair.bytes_b), "b": x % len(pair.bytes_b), "n": n} for x, n in zip(distinct.tolist(), total.tolist())]
    values = [uuid.uuid4().hex, listed, packed(all_codes), np.concatenate(sizes_of).tolist(), packed(pair_of), pairs, opened, bodies]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW_BLOCK)], schema=_ARROW_BLOCK)


def _blocks(files: tuple[bytes, bytes], chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(loaded(files))
        for whole in batches:
            for batch in _pieces(whole, whole.schema.get_field_index("piece"), chars):
                if len(units.known) > CACHE_UNITS:
                    units = Units(units.pair)
                yield _block(batch, units)

    return run


_SCORED = "doc bigint, uid string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the counts of their pairs -> rows of documents and ranges."""
    for batch in batches:
        for i in range(batch.num_rows):
            docs, codes, sizes, pair_of, found = (batch.column(c)[i] for c in range(5))
            docs, sizes = docs.values, sizes.values.to_numpy()
            count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if found.is_valid and len(found):
                place = found.values.field("i").to_numpy()
                count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                count[place] = found.values.field("n").to_numpy()
                best[place] = found.values.field("best").to_numpy()
            of = unpacked(pair_of.as_py(), int(sizes.sum()))
            n_codes = docs.field("units").to_numpy()
            code = unpacked(codes.as_py(), int(n_codes.sum()))
            sums = lambda x, n: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], np.cumsum(n)])])
            per_doc = [sums(sums(x[of], sizes)[code], n_codes) for x in (best, count)]
            names = ["doc", "uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(docs.field(n) for n in names), *map(pa.array, per_doc)], names=[*names, "n_best", "count_sum"])


# --- the tree over the ranges of long documents


_TREE = f"{_OPEN}, body string, links array<struct<a:bigint,b:bigint>>"
_ARROW_TREE = pa.schema(
    [("uid", pa.string()), ("part", pa.int32()), ("prefix", _ARROW_STREAM), ("edge", pa.int64()), ("suffix", _ARROW_STREAM), ("body", pa.string()),
     ("links", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]
)


def _composed(table: pa.Table) -> pa.Table:
    """Neighbouring fragments of one document -> one fragment under the lowest part, and a row per seam."""
    rows, out, now = sorted(table.to_pylist(), key=lambda r: r["part"]), [], None
    for r in rows:
        found = Fragment(_as_streams(r["prefix"]), r["edge"], _as_streams(r["suffix"]))
        if now is None:
            now = found
            continue
        now, seam = compose(now, found)
        if seam:
            # the seam stands before the part that closed it
            a, b = links(seam[0], seam[1])
            out.append({"uid": r["uid"], "part": r["part"], "body": ";".join(group_texts(seam[0], seam[1])), "links": [{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist())]})
    first = rows[0]
    out.append({"uid": first["uid"], "part": first["part"], "prefix": _as_struct(now.prefix), "edge": now.edge, "suffix": _as_struct(now.suffix), "body": None, "links": None})
    return pa.Table.from_pylist(out, _ARROW_TREE)


def seams(opened: DataFrame, most_parts: int, fan_in: int = FAN_IN) -> DataFrame | None:
    """``uid, part, body, links`` of all groups that close between ranges, by a tree of compositions."""
    found, width = None, 1
    while width < most_parts:
        width *= fan_in
        keyed = opened.withColumn("node", F.floor(F.col("part") / width))
        level = stored(keyed.groupBy("uid", "node").applyInArrow(lambda t: _composed(t.drop_columns(["node"])), _TREE), "align-level")
        new = level.where("body IS NOT NULL").select("uid", "part", "body", "links")
        found = new if found is None else found.unionByName(new)
        opened = level.where("body IS NULL").select("uid", "part", "prefix", "edge", "suffix")
    return found


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies in the order of documents, parts and kinds -> digest of each document, one body in memory at a time."""
    now, state, some = None, None, False
    for batch in batches:
        done = []
        for uid, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            if uid != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state, some = uid, hashlib.sha256(), False
            text = body.as_py()
            if text:
                state.update(((";" if some else "") + text).encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], ["uid", "sha"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["uid", "sha"])


def aligned(
    docs: DataFrame, json_path: str, model_path: str, doc_id: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES, block_chars: int = BLOCK_CHARS, fan_in: int = FAN_IN
) -> DataFrame:
    """``doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    files = tokenizer_files(json_path, model_path)
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("piece"))
    is_long = F.coalesce(F.octet_length("piece") >= range_bytes, F.lit(False))
    cut = plain.where(is_long).mapInArrow(_cut(range_bytes), "uid string, doc bigint, part int, parts int, low bigint, high bigint, at bigint, piece string")
    cut = stored(cut, "align-ranges")
    # ranges of a document are dealt to many tasks
    dealt = cut.repartition("uid", "part")
    bad = stored(dealt.select("uid", "piece").mapInArrow(_damaged(files), "uid string").distinct(), "align-damaged")
    whole = cut.join(bad, "uid", "left_anti")
    short = plain.where(~is_long).select(
        F.lit(None).cast("string").alias("uid"), "doc", *[F.lit(None).cast(t).alias(n) for n, t in (("part", "int"), ("low", "bigint"), ("high", "bigint"), ("at", "bigint"))], "piece"
    )
    ranged = whole.repartition("uid", "part").select(*short.columns)
    blocks = stored(
        short.mapInArrow(_blocks(files, block_chars), _BLOCK).unionByName(ranged.mapInArrow(_blocks(files, block_chars), _BLOCK)), "align-blocks"
    )
    most = cut.agg(F.max("parts")).first()[0] or 0
    opened = blocks.select(F.explode("open").alias("o")).select("o.*")
    closing = seams(opened, most, fan_in)

    # counts of id pairs over the corpus, and the highest of each id of B
    per_block = blocks.select("block", F.posexplode("pairs").alias("i", "p")).select("block", "i", "p.a", "p.b", "p.n")
    counted = per_block.select("a", "b", "n")
    if closing is not None:
        seam_pairs = closing.select("uid", F.explode("links").alias("p")).groupBy("uid", F.col("p.a").cast("int").alias("a"), F.col("p.b").cast("int").alias("b"))
        seam_pairs = stored(seam_pairs.agg(F.count(F.lit(1)).alias("n")), "align-seams")
        counted = counted.unionByName(seam_pairs.select("a", "b", "n"))
    pairs = stored(counted.groupBy("a", "b").agg(F.sum("n").alias("n")), "align-pairs")
    highest = pairs.groupBy("b").agg(F.max("n").alias("top"))
    pairs = stored(pairs.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("top")).cast("int").alias("best")), "align-counts")

    lists = per_block.drop("n").join(pairs, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("i", "n", "best")).alias("found"))
    scored = blocks.select("block", "docs", "codes", "links", "pair_of").join(lists, "block", "left")
    scored = scored.select("docs", "codes", "links", "pair_of", "found").mapInArrow(_score, _SCORED)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    if closing is None:
        return scored.select("doc", *names, "groups_sha256")
    scored = stored(scored, "align-scored")
    # long documents: sums over ranges and seams, digest of bodies in order (a seam stands before its part)
    added = seam_pairs.join(pairs.withColumnRenamed("n", "count"), ["a", "b"]).groupBy("uid").agg(
        F.sum("n").alias("n_links"), F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")
    )
    added = added.join(closing.groupBy("uid").agg(F.count(F.lit(1)).alias("n_groups")), "uid")
    none = F.lit(0).cast("bigint")
    parts = scored.where("uid IS NOT NULL").select("uid", *names).unionByName(
        added.select("uid", none.alias("n_a"), none.alias("n_b"), "n_groups", "n_links", "n_best", "count_sum")
    )
    summed = parts.groupBy("uid").agg(*[F.sum(n).alias(n) for n in names])
    bodies = blocks.select(F.explode("bodies").alias("o")).select("o.uid", "o.part", "o.body", F.lit(1).alias("kind"))
    bodies = bodies.unionByName(closing.select("uid", "part", "body", F.lit(0).alias("kind")))
    ordered = bodies.repartition("uid").sortWithinPartitions("uid", "part", "kind").select("uid", "body")
    digests = ordered.mapInArrow(_digests, "uid string, sha string")
    cut_docs = cut.where("part = 0").select("uid", "doc")
    long_docs = cut_docs.join(summed, "uid", "left").join(digests, "uid", "left").select(
        "doc", *[F.coalesce(n, none).alias(n) for n in names], F.coalesce("sha", F.lit("")).alias("groups_sha256")
    )
    return scored.where("uid IS NULL").select("doc", *names, "groups_sha256").unionByName(long_docs)
