"""Compression of vectors to codes: product codebooks by a dual-tree Lloyd iteration on whole numbers.

Components become ``floor(256 x)``; a vector is cut into equal parts, each with a codebook of its own. Vectors lie
in stored blocks. In a block every part position has a balanced tree over the block's parts: a node is a stretch of a stored
order, halved along its widest component, with box, sum and number. The entries of each codebook form a tree of boxes too.

A pass walks both trees down together, a level at a time for all part positions of the block at once. A pair of nodes
(parts, entries) has a least and a greatest squared distance between its boxes; no part of the node is farther from its nearest entry
than the least of the greatest distances of its pairs, so pairs whose least distance lies above that bound are pruned. A node left with
one entry is assigned whole by its cached sum and number. Parts in leaves that keep several entries are compared one by one. All bounds
and distances are whole numbers, so ties are real ties and go to the lower entry; entries equal to a lower one leave the tree.

Each task adds up its blocks, Spark adds up the tasks by entry and component, and the driver gets one codebook: parts x
entries x components, whatever the number of vectors.

Defined cases: vectors that are null or hold null or non-finite components are dropped, as are those whose length is not that of
the first kept vector or no multiple of the parts; components are held at +-2^27, since errors are 64-bit; null ids come last among
the first entries, ties of ids go by components; with fewer vectors than entries the codebook is as short; repeated rows count as often; without vectors there are no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
HIGHEST = 2**27
# vectors of a block; parts of a leaf
BLOCK_ROWS = 8192
LEAF = 8


# --- trees


def bounds_of_levels(n: int, leaf: int = LEAF) -> list[np.ndarray]:
    """Ends of the nodes of each level over ``n`` rows: halves of halves, down to leaves of that size."""
    levels = [np.array([0, n])]
    while n and np.diff(levels[-1]).max() > leaf:
        cut = levels[-1]
        levels.append(np.sort(np.concatenate([cut, (cut[:-1] + cut[1:]) // 2])))
    return levels


def tree_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``[parts, n]``: the order of the rows of ``points [parts, n, width]`` in which every node is a stretch."""
    parts, n, _ = points.shape
    order = np.tile(np.arange(n), (parts, 1))
    levels = bounds_of_levels(n, leaf)
    row = np.arange(parts)[:, None]
    for cut in levels[:-1]:
        here = points[row, order]
        wide = np.maximum.reduceat(here, cut[:-1], axis=1) - np.minimum.reduceat(here, cut[:-1], axis=1)
        axis = np.repeat(wide.argmax(axis=2), np.diff(cut), axis=1)
        value = np.take_along_axis(here, axis[:, :, None], axis=2)[:, :, 0]
        node = np.tile(np.repeat(np.arange(len(cut) - 1), np.diff(cut)), (parts, 1))
        order = np.take_along_axis(order, np.lexsort((value, node), axis=1), axis=1)
    return order


class EntryTrees:
    """Trees over the distinct entries of each codebook, as flat arrays; children -1 below a single entry."""

    def __init__(self, books: np.ndarray):
        self.low, self.high, self.left, self.right, self.entry, self.root = [], [], [], [], [], []
        for book in books:
            _, first = np.unique(book, axis=0, return_index=True)
            self.root.append(self._grow(book, np.sort(first)))
        for name in ("low", "high", "left", "right", "entry", "root"):
            setattr(self, name, np.array(getattr(self, name), np.int64))

    def _grow(self, book: np.ndarray, who: np.ndarray) -> int:
        me, here = len(self.left), book[who]
        self.low.append(here.min(axis=0)), self.high.append(here.max(axis=0))
        self.left.append(-1), self.right.append(-1), self.entry.append(who[0] if len(who) == 1 else -1)
        if len(who) > 1:
            sort = who[np.argsort(here[:, (self.high[me] - self.low[me]).argmax()], kind="stable")]
            self.left[me] = self._grow(book, sort[: len(who) // 2])
            self.right[me] = self._grow(book, sort[len(who) // 2 :])
        return me


class Walk:
    """One block under one set of codebooks: whole nodes and single parts that found their entry."""

    def __init__(self, points: np.ndarray, books: np.ndarray, trees: EntryTrees, leaf: int = LEAF):
        """``points [parts, n, width]`` in the order of their trees."""
        self.points, self.books = points, books
        self.whole: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # part, from, to, entry
        self.single: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # part, place, entry
        self.pairs = 0  # pairs of nodes looked at
        self.distances = 0  # single distances computed
        parts, n, _ = points.shape
        if not n:
            return
        part, node, entries = np.arange(parts), np.zeros(parts, np.int64), trees.root.copy()
        levels = bounds_of_levels(n, leaf)
        for depth, cut in enumerate(levels):
            low, high = np.minimum.reduceat(points, cut[:-1], axis=1), np.maximum.reduceat(points, cut[:-1], axis=1)
            while True:
                part, node, entries = self._prune(part, node, entries, low, high, cut, trees)
                if depth < len(levels) - 1 or not len(part) or (trees.left[entries] < 0).all():
                    break
                part, node, entries = self._split(part, node, entries, trees)
            if depth < len(levels) - 1 and len(part):
                part, node, entries = self._split(part, node, entries, trees)
                middle, after = (cut[:-1] + cut[1:]) // 2, levels[depth + 1]
                halves = np.stack([np.searchsorted(after[:-1], cut[:-1]), np.searchsorted(after[:-1], middle)])
                part, entries = np.tile(part, 2), np.tile(entries, 2)
                node = np.concatenate([halves[0][node], halves[1][node]])
        if len(part):
            self._compare(part, node, trees.entry[entries], levels[-1])

    @staticmethod
    def _split(part, node, entries, trees):
        """Entry nodes give way to their halves."""
        single = trees.left[entries] < 0
        down = ~single
        join = lambda x: np.concatenate([x[single], x[down], x[down]])
        return join(part), join(node), np.concatenate([entries[single], trees.left[entries[down]], trees.right[entries[down]]])

    def _prune(self, part, node, entries, low, high, cut, trees):
        order = np.lexsort((node, part))
        part, node, entries = part[order], node[order], entries[order]
        self.pairs += len(part)
        a_low, a_high, b_low, b_high = low[part, node], high[part, node], trees.low[entries], trees.high[entries]
        gap = np.maximum(np.maximum(b_low - a_high, a_low - b_high), 0)
        reach = np.maximum(a_high - b_low, b_high - a_low)
        least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (node[1:] != node[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            return part, node, entries
        size = np.diff(np.append(first, len(part)))
        keep = least <= np.repeat(np.minimum.reduceat(most, first), size)
        left = np.add.reduceat(keep.astype(np.int64), first)
        done = keep & np.repeat(left == 1, size) & (trees.left[entries] < 0)
        self.whole.append((part[done], cut[:-1][node[done]], cut[1:][node[done]], trees.entry[entries[done]]))
        keep &= ~done
        return part[keep], node[keep], entries[keep]

    def _compare(self, part, node, entry, cut):
        """Parts of leaves against all entries that are left, by whole numbers."""
        order = np.lexsort((entry, node, part))
        part, node, entry = part[order], node[order], entry[order]
        begin, size = cut[:-1][node], np.diff(cut)[node]
        for lot in np.array_split(np.arange(len(part)), np.flatnonzero(np.diff(part * len(cut) + node, prepend=-1))[4096::4096]):
            wide = int(size[lot].max())
            place = begin[lot][:, None] + np.minimum(np.arange(wide), size[lot][:, None] - 1)
            gap = self.points[part[lot][:, None], place] - self.books[part[lot], entry[lot]][:, None]
            far = (gap * gap).sum(axis=2)
            self.distances += int(size[lot].sum())
            first = np.flatnonzero(np.diff(part[lot] * len(cut) + node[lot], prepend=-1))
            count = np.diff(np.append(first, len(lot)))
            near = np.minimum.reduceat(far, first, axis=0)
            ranked = np.where(far == np.repeat(near, count, axis=0), entry[lot][:, None], np.iinfo(np.int64).max)
            best = np.minimum.reduceat(ranked, first, axis=0)
            inside = np.arange(wide) < size[lot][first][:, None]
            who = np.broadcast_to(part[lot][first][:, None], inside.shape)
            self.single.append((who[inside], place[first][inside], best[inside]))

    def sums(self) -> np.ndarray:
        """``[parts, entries, 1 + width]``: number and sum of the parts of each entry."""
        parts, _, width = self.points.shape
        out = np.zeros((*self.books.shape[:2], 1 + width), np.int64)
        before = np.concatenate([np.zeros((parts, 1, width), np.int64), np.cumsum(self.points, axis=1)], axis=1)
        for part, low, high, entry in self.whole:
            np.add.at(out, (part, entry, 0), high - low)
            np.add.at(out, (part, entry, slice(1, None)), before[part, high] - before[part, low])
        for part, place, entry in self.single:
            np.add.at(out, (part, entry, 0), 1)
            np.add.at(out, (part, entry, slice(1, None)), self.points[part, place])
        return out

    def codes(self) -> np.ndarray:
        """``[parts, n]`` entries in the order of the trees."""
        out = np.zeros(self.points.shape[:2], np.int64)
        for part, low, high, entry in self.whole:
            size = high - low
            place = np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size)
            out[np.repeat(part, size), place] = np.repeat(entry, size)
        for part, place, entry in self.single:
            out[part, place] = entry
        return out


# --- blocks in Spark


def whole_components(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id, label, x`` with whole components of the vectors that are kept, before their length is looked at."""
    value = F.col(vector)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    kept = vectors.where(value.isNotNull() & F.coalesce(F.forall(value, finite), F.lit(False)))
    top = F.lit(float(HIGHEST))
    whole = F.transform(value, lambda v: F.greatest(F.least(F.floor(F.greatest(F.least(v.cast("double") * scale, top), -top)), F.lit(HIGHEST)), F.lit(-HIGHEST)).cast("int"))
    return kept.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), whole.alias("x"))


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """``[parts, n, width]`` of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1).transpose(1, 0, 2).copy()


def _in_blocks(parts: int, rows: int):
    """Vectors -> the same rows with the block they belong to and, per part, their place in its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows_: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows_).combine_chunks()
            order = tree_order(_matrix(table.column(2).chunk(0), parts)).astype(np.int16)
            lists = [pa.array([table.column(i).to_pylist()], pa.list_(table.schema.field(i).type)) for i in range(2)]
            x = table.column(2).chunk(0).flatten().cast(pa.int32())
            flat = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            orders = pa.ListArray.from_arrays(pa.array([0, order.size], pa.int32()), pa.array(order.ravel()))
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *lists, flat, orders], ["block", "ids", "labels", "x", "place"])

        waiting, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, rows - size)
                waiting.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == rows:
                    yield block(waiting)
                    waiting, size = [], 0
        if size:
            yield block(waiting)

    return run


def _read_block(x: pa.Scalar, place: pa.Scalar, parts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of a block in the order of their trees, and that order."""
    points = x.values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, width).transpose(1, 0, 2)
    order = place.values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(parts, -1)
    return points[np.arange(parts)[:, None], order], order


def _sums(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, total = EntryTrees(books), None
        for batch in batches:
            for x, place in zip(batch.column(0), batch.column(1)):
                points, _ = _read_block(x, place, len(books), books.shape[2])
                found = Walk(points, books, trees).sums()
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["slot", "v"])

    return run


def _assigned(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, parts = EntryTrees(books), len(books)
        for batch in batches:
            for ids, labels, x, place in zip(*batch.columns):
                points, order = _read_block(x, place, parts, books.shape[2])
                in_order = Walk(points, books, trees).codes()
                gap = points - books[np.arange(parts)[:, None], in_order]
                codes, errors = np.empty_like(in_order), np.empty_like(in_order)
                np.put_along_axis(codes, order, in_order, axis=1)
                np.put_along_axis(errors, order, (gap * gap).sum(axis=2), axis=1)
                text = codes.T.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                names = [text[i : i + step] for i in range(0, len(text), step)]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(names), pa.array(errors.sum(axis=0))], ["id", "label", "code", "error"])

    return run


def compressed(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error`` of every kept vector, and the codebooks ``[parts, entries, width]``."""
    if not 0 < entries <= 256 or block_rows > 2**15:
        raise ValueError("codes are bytes and places in a block are 16-bit: at most 256 entries and 32,768 rows")
    rows = whole_components(vectors, vec_id, vector, label, scale)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    by_id = (F.col("id").asc_nulls_last(), "x")
    lead = rows.where(F.size("x") > 0).orderBy(*by_id).limit(1).collect()
    size = len(lead[0].x) if lead else 0
    if not size or size % parts:
        return rows.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    rows = rows.where(F.size("x") == size)
    start = [r.x for r in rows.select("id", "x").orderBy(*by_id).limit(entries).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    blocks = rows.mapInArrow(
        _in_blocks(parts, block_rows), f"block string, ids array<{kinds['id']}>, labels array<{kinds['label']}>, x array<int>, place array<smallint>"
    )
    blocks = stored(blocks, "vector-blocks")
    for _ in range(rounds):
        slots = blocks.select("x", "place").mapInArrow(_sums(books), "slot bigint, v bigint").groupBy("slot").agg(F.sum("v").alias("v")).collect()
        total = np.zeros(books.shape[0] * books.shape[1] * (1 + books.shape[2]), np.int64)
        total[[r.slot for r in slots]] = [r.v for r in slots]
        total = total.reshape(*books.shape[:2], -1)
        number = total[:, :, :1]
        books = np.where(number > 0, total[:, :, 1:] // np.maximum(number, 1), books)
    return blocks.select("ids", "labels", "x", "place").mapInArrow(_assigned(books), schema), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order of part, entry and place, in decimal, with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error`` beside every row: the errors of its label together; null where the sum leaves 64 bits."""
    coded = stored(coded, "vector-codes")
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"]), "left").drop("_label")
