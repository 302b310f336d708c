"""Near copies by DartMinHash: weighted signatures of word shingles, banded joining, exact similarity.

A text is a weighted set of runs of five words, the weight being how often a run occurs. Darts are thrown
at the region of each element, one unit of weight by one unit of rank at a time: their ranks are the
arrival times of a Poisson process seeded by element and unit, each with a coordinate of the signature and, for a last broken
unit, a height that must lie below the weight. Only darts up to a rank of ``t / total weight`` are thrown,
about ``k ln k + 3 k`` of them whatever the size of the text; the earliest dart of each coordinate is
kept. Two sets agree in a coordinate with the probability of their weighted Jaccard similarity. Where a
coordinate stayed empty, the rank limit is doubled for that text.

Rows of the signature form bands; texts that share a band meet in a bucket. 30 bands of 6 rows lose one
pair in nine thousand of similarity 0.8, one in a million of 0.84, and keep texts that only share a passage out of each
other's buckets. Candidates are verified on their whole texts.

A bucket of a third of all texts is no list of pairs: its members are compared with one pivot, the
member that shares most buckets in all (the original of a group of copies). Links to pivots give first classes. Two
members of different classes are then compared only if their differences from the pivot allow a link: with
``X = x - p`` (in one but not both), ``|x - y| = |X| + |Y| - 2 |X and Y|``, so a link asks for a number of common
differences. As one of the two is not linked to the pivot, that number is at least one, and the two lists
of differences, in any order that both share, must meet in a prefix of known length: one join on
pivot and difference, from the members outside the pivot's class to all, brings forward every pair that can be linked. The order
puts differences that many members share last, as a bounded draw of members shows them, so few others come along. So no link
between different texts of a bucket is lost, and a group of copies costs about one comparison a member.
Classes are the connected components of verified links, found by joins.

Defined cases: words are runs of letters, digits and marks in lower case; a text of one to four words is one
shingle; null and empty texts and texts without a word are alone; equal word sequences are one class; the
class id is the smallest document id in it (null only if all are null).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored, text_hash, text_or_empty

WIDTH = 5
THRESHOLD = 0.8
BANDS = 30
ROWS = 6
# characters of text that a task works on at once
SLICE_CHARS = 2_000_000
# words whose hashes a worker keeps at hand
CACHE_WORDS = 500_000
# pairs of a pivot that share one copy of its text in a join
PIVOT_ROWS = 200
# members of a large pivot whose differences set the order of cells around it, and the slots of that order
SAMPLE = 64
SLOTS = 4096
# bits that say which rows' texts are asked for, and those in one row of the table of them
BITS = 1 << 24
PAGE_BITS = 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


class Folder:
    """Hashes of the folded words inside words set apart by white space; known ones are kept at hand."""

    def __init__(self):
        import regex

        self.known: dict[str, list[int]] = {}
        self.inside = regex.compile(r"[\p{L}\p{N}\p{M}]+")

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(hashes, number per word)``"""
        import xxhash

        known, out = self.known, []
        for word in words:
            got = known.get(word)
            if got is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                got = known[word] = [xxhash.xxh3_64_intdigest(w) for w in self.inside.findall(word)]
            out.append(got)
        counts = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter((h for got in out for h in got), np.uint64, int(counts.sum())), counts


def word_hashes(texts: pa.Array, folder: Folder) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the folded words of texts, and the words per text."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    if not len(coded):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    hashes, sizes = folder(coded.dictionary.to_pylist())
    place = coded.indices.to_numpy()
    each = sizes[place]
    source = np.arange(int(each.sum())) + np.repeat((np.cumsum(sizes) - sizes)[place] - (np.cumsum(each) - each), each)
    return hashes[source], np.bincount(owner, each, len(texts)).astype(np.int64)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, owner)`` of every run of ``width`` words of texts that lie one after another; a shorter text is one run."""
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = place <= np.repeat(np.maximum(counts - width, 0), counts)
    at = np.flatnonzero(start)
    ends = np.cumsum(counts)[owner[at]]
    run = np.zeros(len(at), np.uint64)
    for j in range(width):
        inside = at + j < ends
        word = hashes[np.minimum(at + j, len(hashes) - 1)] if len(hashes) else hashes
        run = np.where(inside, mixed(run * _STEP + word), run)
    return run, owner[at]


def unit_cells(run: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Seeds of the unit cells of a multiset: the n-th occurrence of an element has the n-th cell."""
    order = np.lexsort((run, owner))
    r, o = run[order], owner[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (o[1:] != o[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    nth = (np.arange(len(r)) - first).astype(np.uint64)
    seeds = np.empty_like(run)
    seeds[order] = mixed(r + nth * _STEP)
    return seeds


def darts(seeds: np.ndarray, owner: np.ndarray, limit: np.ndarray, k: int, height: np.ndarray | None = None):
    """``(owner, coordinate, rank, dart)`` of all darts of the cells up to the rank limit of their owner.

    ``height`` is the part of a cell that belongs to the set; whole cells where it is missing.
    """
    found, rank, n = [], np.zeros(len(seeds)), 0
    while len(seeds):
        n += 1
        dart = mixed(seeds + np.uint64(n * int(_STEP) % 2**64))
        rank = rank - np.log1p(-((dart >> np.uint64(11)).astype(np.float64) * 2.0**-53))
        near = rank < limit[owner]
        seeds, owner, rank, dart = seeds[near], owner[near], rank[near], dart[near]
        more = mixed(dart ^ _STEP)
        hit = np.ones(len(dart), bool)
        if height is not None:
            height = height[near]
            hit = (mixed(more) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < height
        found.append((owner[hit], (more % np.uint64(k)).astype(np.int64)[hit], rank[hit], dart[hit]))
    return [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, t) for t in (np.int64, np.int64, float, np.uint64)]


def signatures(seeds: np.ndarray, owner: np.ndarray, weight: np.ndarray, k: int, height: np.ndarray | None = None) -> np.ndarray:
    """``[owners, k]`` darts: the earliest of each coordinate. Every owner has a positive weight."""
    out = np.zeros((len(weight), k), np.uint64)
    empty = np.ones((len(weight), k), bool)
    limit = k * (math.log(k) + 3) / weight
    while empty.any():
        open_ = empty.any(axis=1)
        use = open_[owner]
        who, where, rank, dart = darts(seeds[use], owner[use], limit, k, None if height is None else height[use])
        slot = who * k + where
        earliest = np.full(out.size, np.inf)
        np.minimum.at(earliest, slot, rank)
        first = rank == earliest[slot]
        out.ravel()[slot[first]] = dart[first]
        empty.ravel()[slot[first]] = False
        limit = limit * 2
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        acc = mixed(acc * _STEP + signature[:, r : bands * rows : rows])
    return acc.astype(np.int64)


def _slices(batch: pa.RecordBatch, column: int, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about so many bytes of text; a longer text is a part of its own."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + chars, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _banded(bands: int, rows: int, kept: int):
    """Kept columns and text -> kept columns, key of the word sequence (null without words) and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder()
        for whole in batches:
            for batch in _slices(whole, kept):
                hashes, counts = word_hashes(batch.column(kept), folder)
                runs, owner = shingles(hashes, counts)
                worded = np.flatnonzero(counts)
                sizes = np.bincount(owner, minlength=batch.num_rows)
                place = np.cumsum(counts > 0) - 1
                sig = signatures(unit_cells(runs, owner), place[owner], sizes[worded].astype(float), bands * rows)
                bandings = band_hashes(sig, bands, rows)
                ends = np.cumsum(counts)
                keys = [hashlib.md5(hashes[e - n : e].tobytes()).digest() if n else None for e, n in zip(ends, counts)]
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bandings.ravel()))
                columns = [batch.column(i) for i in range(kept)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(keys, pa.binary()), lists], names=[*batch.schema.names[:kept], "t", "bands"]
                )

    return run


def differences(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[float, int, int, int, int, int, np.ndarray]:
    """Of two sets of unit cells, sorted: weighted Jaccard similarity, size of ``a``, cells of ``a`` alone and of ``b`` alone,
    lengths of the prefix of the differences for a text in the class of ``b`` and outside, and the differences.
    """
    only_a, only_b = np.setdiff1d(a, b, assume_unique=True), np.setdiff1d(b, a, assume_unique=True)
    both = len(a) - len(only_a)
    sim = both / (len(a) + len(only_b))
    # |x - y| <= g (|x| + |y|) is a similarity of the threshold or more, and then |y| <= |x| / threshold
    g, apart = (1 - threshold) / (1 + threshold), len(only_a) + len(only_b)
    by_outsider = (apart + g * (len(b) - len(a))) / 2
    by_insider = apart - g * (1 + 1 / threshold) * len(a)
    prefix = lambda common: max(0, apart - max(1, math.ceil(common - 1e-9)) + 1)
    cells = np.concatenate([only_a, only_b]).view(np.int64)
    return sim, len(a), len(only_a), len(only_b), prefix(by_outsider), prefix(min(by_outsider, by_insider)), cells


_SIMS = "a binary, b binary, sim double, size int, alone int, missing int, inside int, outside int, cells array<bigint>"


def _similar(threshold: float):
    """``a, b, text_a, text_b`` -> similarity and differences; the last pivot is kept, as its pairs come together."""
    names = ["a", "b", "sim", "size", "alone", "missing", "inside", "outside", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, last, pivot = Folder(), None, None

        def cells(text: pa.Scalar) -> np.ndarray:
            return np.sort(unit_cells(*shingles(*word_hashes(pa.array([text.as_py()], pa.string()), folder))))

        for batch in batches:
            rows = []
            for name, left, right in zip(batch.column(1), batch.column(2), batch.column(3)):
                if name != last:
                    last, pivot = name, cells(right)
                rows.append(differences(cells(left), pivot, threshold))
            part = lambda i, kind: pa.array([r[i] for r in rows], kind)  # noqa: B023, E731
            columns = [batch.column(0), batch.column(1), part(0, pa.float64()), *(part(i, pa.int32()) for i in range(1, 6))]
            yield pa.RecordBatch.from_arrays([*columns, part(6, pa.list_(pa.int64()))], names=names)

    return run


def _sims(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Similarity and differences of the stored pairs ``a, b``; a hot ``b`` is dealt out with copies of its text, one for every
    ``PIVOT_ROWS`` pairs.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PIVOT_ROWS).cast("int").alias("parts"))
    left = texts.select(F.col("t").alias("a"), F.col("body").alias("text_a"))
    right = texts.select(F.col("t").alias("b"), F.col("body").alias("text_b")).join(parts, "b")
    right = right.select("b", "text_b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    salted = pairs.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    met = salted.join(left, "a").join(right, ["b", "part"]).select("a", "b", "text_a", "text_b")
    return met.mapInArrow(_similar(threshold), _SIMS)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``..., cells, n, levels`` -> the first ``n`` cells in the order of their pivot, rarest level first, in 32 bits."""
    for batch in batches:
        out = []
        for cells, n, levels in zip(*(batch.column(batch.num_columns - 3 + i) for i in range(3))):
            rank = np.zeros(SLOTS, np.int64)
            if levels.is_valid:
                coded = levels.values.to_numpy()
                rank[coded >> 3] = coded & 7
            found = cells.values.to_numpy()
            out.append((found[np.lexsort((found, rank[found & (SLOTS - 1)]))[: n.as_py()]] >> 32).astype(np.int32))
        kept = batch.num_columns - 3
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names[:kept], "prefix"])


# id and hash of a row as plain columns without nulls: a null-safe join and a grouping by them share one exchange
ROW_KEY = ["_none", "_id", "_hash"]


def row_key(doc: Column, doc_hash: Column) -> list[Column]:
    return [doc.isNull().alias("_none"), F.coalesce(doc.cast("string"), F.lit("")).alias("_id"), doc_hash.alias("_hash")]


def perhaps_among(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are in ``wanted``, and few others: one bit of a fixed number of ``BITS`` for each key.

    The bits are the same 2 MB for any input, so rows that nobody asks for are left out where they are read.
    """
    page, bit = (lambda: F.pmod(F.xxhash64(*keys), F.lit(BITS // PAGE_BITS)).cast("int")), (lambda: F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(PAGE_BITS)))
    pages = wanted.groupBy(page().alias("_page")).agg(F.bitmap_construct_agg(bit()).alias("_bits"))
    met = rows.join(F.broadcast(pages), page() == F.col("_page"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit() / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(byte, (bit() % 8).cast("int")) == 1).select(*rows.columns)


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``t, c`` with the smallest label of each connected component; ``edges`` has ``x, y`` between labels ``c``.

    Smallest-neighbour steps with pointer jumps on the graph of labels; a chain of n takes log n steps.
    """
    both = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    both = stored(both.where("x <> y").distinct(), "cc-edges")
    roots = stored(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("r")), "cc-roots")
    while True:
        # the smallest root among the neighbours of a node, offered to the node and to its root
        offers = both.join(roots.select(F.col("x").alias("y"), F.col("r").alias("of")), "y").select("x", "of")
        own = roots.select("x", F.col("r").alias("of"))
        hooked = offers.join(roots, "x").select(F.col("r").alias("x"), "of")
        best = offers.unionByName(own).unionByName(hooked).groupBy("x").agg(F.min("of").alias("n"))
        jump = best.select(F.col("x").alias("n"), F.col("n").alias("far"))
        after = best.join(jump, "n", "left").select("x", F.coalesce("far", "n").alias("r"))
        after = stored(after, "cc-roots")
        if after.join(roots, ["x", "r"], "left_anti").isEmpty():
            break
        roots = after
    renamed = roots.select(F.col("x").alias("c"), "r")
    return labels.join(renamed, "c", "left").select("t", F.coalesce("r", "c").alias("c"))


def signed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc, doc_hash, t, bands`` of every row: the key of its word sequence (null without words) and its band hashes."""
    plain = docs.select(F.col(doc_id).alias("doc"), text_hash(text).alias("doc_hash"), text_or_empty(text).alias("body"))
    kind = plain.schema["doc"].dataType.simpleString()
    return plain.mapInArrow(_banded(bands, rows, 2), f"doc {kind}, doc_hash bigint, t binary, bands array<bigint>")


def near_classes(signed: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``t, c``: the class of every distinct word sequence that shares a band with another one.

    ``signed`` is the stored table of ``signed_texts`` over ``docs``.
    """
    worded = signed.where("t IS NOT NULL")
    texts_signed = stored(worded.select("t", "bands").dropDuplicates(["t"]), "dart-bands")
    # a text and a bucket are 64 bits each while all bands travel; two texts of one number would only be tried in each other's buckets
    placed = texts_signed.select(F.xxhash64("t").alias("id"), F.posexplode("bands").alias("band", "h"))
    placed = placed.select("id", F.xxhash64("band", "h").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = stored(placed.join(shared, "bucket"), "dart-shared")
    central = placed.groupBy("id").agg(F.sum("n").alias("w"))
    named = texts_signed.select("t", F.xxhash64("t").alias("id")).join(central, "id")
    members = stored(placed.select("id", "bucket").join(named, "id").select("t", "bucket", "w"), "dart-buckets")
    met = members.select("t").distinct()
    # one row stands for all that hold the same words
    stands = worded.join(met, "t", "left_semi").groupBy("t").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "doc_hash")).alias("row"))
    stands = stored(stands.select("t", *row_key(F.col("row.doc"), F.col("row.doc_hash"))), "dart-stands")
    plain = docs.select(*row_key(F.col(doc_id), text_hash(text)), F.col(text).alias("body"))
    texts = perhaps_among(plain, stands, ROW_KEY).dropDuplicates(ROW_KEY)
    texts = stored(texts.join(stands, ROW_KEY).select("t", "body"), "dart-texts")
    labels = met.select("t", F.col("t").alias("c"))

    def linked(sims: DataFrame, now: DataFrame) -> DataFrame:
        close = sims.where(F.col("sim") >= threshold - 1e-12).select("a", "b")
        ends = close.join(now.select(F.col("t").alias("a"), F.col("c").alias("x")), "a").join(
            now.select(F.col("t").alias("b"), F.col("c").alias("y")), "b"
        )
        return stored(components(now, ends.select("x", "y")), "dart-labels")

    # the pivot of a bucket is its most central member
    pivots = members.groupBy("bucket").agg(F.max(F.struct("w", "t"))["t"].alias("p"))
    pairs = members.join(pivots, "bucket").where("t <> p").select(F.col("t").alias("a"), F.col("p").alias("b")).distinct()
    sims = stored(_sims(stored(pairs, "dart-first"), texts, threshold), "dart-sims")
    labels = linked(sims, labels)
    return linked(_between_classes(sims, labels, threshold), labels)


def _between_classes(sims: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """``a, b, sim`` of members of different classes around one pivot whose differences from it allow a link.

    The similarity comes from the two lists of differences alone; no text travels for it.
    """
    class_of_a = labels.select(F.col("t").alias("a"), F.col("c").alias("class_a"))
    class_of_b = labels.select(F.col("t").alias("b"), F.col("c").alias("class_b"))
    around = sims.join(class_of_a, "a").join(class_of_b, "b").withColumn("out", F.col("class_a") != F.col("class_b"))
    some = around.groupBy("b").agg(F.max(F.col("out").cast("int")).alias("open"), F.count(F.lit(1)).alias("n")).where("open = 1 AND n > 1")
    around = stored(around.join(some.select("b", "n"), "b").withColumns({"p": F.xxhash64("b"), "id": F.xxhash64("a")}), "dart-around")
    # an order of the cells around each large pivot, from about SAMPLE of its members: how many hold the cell. Any order
    # would do, and a cell that most members share comes late, so that it is in hardly any prefix
    drawn = around.where((F.col("n") > SAMPLE) & (F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / SAMPLE)) == 0))
    slots = drawn.select("b", F.explode("cells").alias("cell")).groupBy("b", "cell").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    slots = slots.groupBy("b", F.col("cell").bitwiseAND(F.lit(SLOTS - 1).cast("bigint")).alias("slot")).agg(F.max("k").alias("k"))
    level = F.least(F.floor(F.log2("k")), F.lit(7)).cast("int")
    levels = slots.groupBy("b").agg(F.collect_list((F.col("slot") * 8 + level).cast("int")).alias("levels"))
    # numbers instead of keys: a row is small
    placed = around.join(levels, "b", "left").select(
        "p", "id", F.xxhash64("class_a").alias("c"), "out", "size", "alone", "missing",
        "cells", F.when(F.col("out"), F.col("outside")).otherwise(F.col("inside")).alias("n"), "levels",
    )
    schema = "p bigint, id bigint, c bigint, out boolean, size int, alone int, missing int, prefix array<int>"
    listed = stored(placed.where("n > 0").mapInArrow(_prefixes, schema), "dart-prefixes")
    cells = listed.select(F.posexplode("prefix").alias("at", "cell"), "*").drop("prefix").select(F.xxhash64("p", "cell").alias("key"), "*").drop("cell")
    # one of the two is outside the class of the pivot; of the others only cells that it has matter
    outer, inner = cells.where("out"), cells.where("not out")
    inner = inner.join(outer.select("key").distinct(), "key", "left_semi")
    one, two = outer.drop("out").alias("one"), outer.unionByName(inner).alias("two")
    g = (1 - threshold) / (1 + threshold)
    x, y = (lambda n: F.col(f"one.{n}")), (lambda n: F.col(f"two.{n}"))
    # common differences that the link asks for, and as many as there can be from this cell on, were it the first
    all_1, all_2 = x("alone") + x("missing"), y("alone") + y("missing")
    allowed = F.lit(g) * (x("size") + y("size"))
    most = F.least(all_1 - x("at"), all_2 - y("at"), F.least(x("alone"), y("alone")) + F.least(x("missing"), y("missing")))
    may = (F.abs(all_1 - all_2) <= allowed + 1e-9) & (most >= (all_1 + all_2 - allowed) / 2 - 1e-9)
    # two outsiders meet twice, an outsider and an insider once
    once = ~y("out") | (x("id") < y("id"))
    rest = one.join(two, x("key") == y("key")).where(once & (x("c") != y("c")) & may)
    rest = rest.where(x("p") == y("p")).select(x("p").alias("p"), F.least(x("id"), y("id")).alias("i"), F.greatest(x("id"), y("id")).alias("j"))
    rest = stored(rest.groupBy("i", "j").agg(F.min("p").alias("p")), "dart-pairs")
    # back to the keys: of two that share a number both are tried, and the pivot must be the same
    lists = lambda i, t: around.select("p", F.col("id").alias(i), F.col("a").alias(t), F.col("b").alias(f"p_{t}"), F.col("size").alias(f"size_{t}"), F.col("cells").alias(f"cells_{t}"))
    both = rest.join(lists("i", "a"), ["p", "i"]).join(lists("j", "b"), ["p", "j"]).where("p_a = p_b AND a <> b")
    shared = F.size(F.array_intersect("cells_a", "cells_b"))
    met = (F.col("size_a") + F.col("size_b") - (F.size("cells_a") + F.size("cells_b") - 2 * shared)) / 2
    return both.select("a", "b", (met / (F.col("size_a") + F.col("size_b") - met)).alias("sim"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc, doc_hash, class, word_key``: one row per document with the smallest document id of its class."""
    signed = stored(signed_texts(docs, doc_id, text, bands, rows), "dart-signed")
    keyed = signed.select("doc", "doc_hash", "t")
    labels = near_classes(signed, docs, doc_id, text, threshold)
    # equal texts combine before they meet their label, so a hot text is one row per task
    smallest = keyed.where("t IS NOT NULL").groupBy("t").agg(F.min("doc").alias("low"))
    classed = stored(smallest.join(labels, "t", "left").select("t", F.coalesce("c", "t").alias("c"), "low"), "dart-classed")
    lows = classed.groupBy("c").agg(F.min("low").alias("class"))
    of_text = stored(classed.join(lows, "c").select("t", "class"), "dart-classes")
    worded = keyed.where("t IS NOT NULL").join(of_text, "t").select("doc", "doc_hash", "class", F.col("t").alias("word_key"))
    alone = keyed.where("t IS NULL").select("doc", "doc_hash", F.col("doc").alias("class"), F.col("t").alias("word_key"))
    return worded.unionByName(alone)


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, the one of the smallest id; texts without words all stay.

    Rows that repeat id and text are one document.
    """
    classes = stored(near_duplicates(docs, doc_id, text, **options), "near-classes")
    row = F.struct(F.col("doc").isNull().alias("none"), "doc", "doc_hash")
    # equal word sequences first, so a hot one is a row per task
    best = classes.where("word_key IS NOT NULL").groupBy("word_key", "class").agg(F.min(row).alias("row"))
    # a class of null ids only has no number; its word sequence stands for it
    own = F.when(F.col("class").isNull(), F.col("word_key")).alias("own")
    best = best.groupBy("class", own).agg(F.min("row").alias("row")).select("row.doc", "row.doc_hash")
    kept = stored(best.unionByName(classes.where("word_key IS NULL").select("doc", "doc_hash")).distinct(), "near-kept")
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(c).alias(n) for c, n in names.items()], *row_key(F.col(doc_id), text_hash(text)))
    # both by one key, so rows are exchanged once
    found = rows.join(kept.select(*row_key(F.col("doc"), F.col("doc_hash"))), ROW_KEY, "left_semi").dropDuplicates(ROW_KEY)
    return found.select(*[F.col(n).alias(c) for c, n in names.items()])
