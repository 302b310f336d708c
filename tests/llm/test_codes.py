import math
import random

import numpy as np

from tallyworks.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, id long, x int, block string, code string, error long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "b", "c", 3) for r in rows], SCHEMA)


def kept(rows):
    good = [(i, v, n) for i, v, n in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    floor = [(i, [max(-(2**27), min(2**27, math.floor(256 * float(np.float32(x))))) for x in v], n) for i, v, n in good]
    floor.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(floor[0][1]) if floor else 0
    return [r for r in floor if len(r[1]) == size]


def brute(rows, parts, entries, rounds):
    """Plain Python: every part against every entry."""
    rows = kept(rows)
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in rows[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in rows:
                own[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(o) for c in zip(*o)] if o else e for o, e in zip(own, books[p])]
    out = []
    for i, v, n in rows:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, n, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def made(n, size, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(n)]
    rows += [(n + i, rows[3][1], 5) for i in range(n // 3)]  # many copies of one vector
    rows += [(None, rows[5][1], 1), (7, rows[8][1], 2), (7, rows[8][1], 2), (7, rows[9][1], None), (n + 1, None, 1), (n + 2, [], 1)]
    rows += [(n + 3, [None] * size, 1), (n + 4, [float("nan")] * size, 1), (n + 5, [float("inf")] * size, 1), (n + 6, [0.5] * (size + 1), 1), (n + 7, [3e38] * size, 1)]
    return rows


def test_against_every_distance(spark):
    for n, parts, width, entries, block in ((700, 4, 3, 20, 100), (300, 2, 1, 64, 8192), (150, 16, 2, 7, 33)):
        rows = made(n, parts * width)
        coded, books = vc.compressed(frame(spark, rows).repartition(3), parts=parts, entries=entries, block_rows=block)
        want, want_books = brute(rows, parts, entries, 2)
        assert sorted(map(str, map(tuple, coded.collect()))) == sorted(map(str, want))
        assert books.tolist() == want_books


def test_labels_sum_and_fewer_vectors_than_entries(spark):
    rows = made(12, 16)
    coded, books = vc.compressed(frame(spark, rows))
    want, want_books = brute(rows, 16, 64, 2)
    total = {}
    for _, n, _, e in want:
        total[n] = total.get(n, 0) + e
    got = vc.with_label_errors(coded).collect()
    assert sorted(str((r.id, r.code, r.error, r.label_error)) for r in got) == sorted(str((i, c, e, total[n])) for i, n, c, e in want)
    text = ",".join(str(x) for book in want_books for e in book for x in e)
    assert vc.books_digest(books) == __import__("hashlib").sha256(text.encode()).hexdigest()


def test_trees_prune():
    rng = np.random.default_rng(4)
    centres = rng.integers(-2000, 2000, (64, 4))
    points = (centres[rng.integers(0, 64, 8000)] + rng.integers(-20, 21, (8000, 4)))[None]
    points = points[np.arange(1)[:, None], vc.tree_order(points)]
    books = centres[None].astype(np.int64)
    walk = vc.Walk(points, books, vc.EntryTrees(books))
    far = ((points[0][:, None] - books[0][None]) ** 2).sum(axis=2)
    assert (walk.codes()[0] == far.argmin(axis=1)).all()
    assert walk.pairs + walk.distances < 0.1 * far.size  # of 512,000 distances
    assert sum(len(p) for p, *_ in walk.whole) and walk.sums()[0, :, 0].sum() == 8000


def test_ties_go_to_the_lower_entry():
    points = np.array([[[0, 0], [5, 0], [10, 0], [5, 5], [-3, 0]]])
    books = np.array([[[10, 0], [0, 0], [0, 0], [10, 0]]])
    order = vc.tree_order(points)
    found = vc.Walk(points[np.arange(1)[:, None], order], books, vc.EntryTrees(books)).codes()[0]
    assert dict(zip(order[0].tolist(), found.tolist())) == {0: 1, 1: 0, 2: 0, 3: 0, 4: 1}


def test_without_vectors(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)], [(1, [1.0] * 15, 1)]):
        coded, books = vc.compressed(frame(spark, rows))
        assert vc.with_label_errors(coded).count() == 0 and vc.books_digest(books) == __import__("hashlib").sha256(b"").hexdigest()
