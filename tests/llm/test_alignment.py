import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from cases import all_documents, frame

from tallyworks.llm import alignment as al
from tallyworks.llm.queries import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ["doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def whole(pair, text):
    """Groups and links of one text by two hands that walk along its bytes."""
    raw = (" " + text).encode()
    ids_a, ids_b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    bytes_a, bytes_b = [pair.bytes_a[i] for i in ids_a], [pair.bytes_b[i] for i in ids_b]
    if not b"".join(bytes_a) == raw == b"".join(bytes_b):
        return [], [], [], []
    links, groups, i, j = [], [], 0, 0
    end_a, end_b, begin_a, begin_b = len(bytes_a[0]), len(bytes_b[0]), 0, 0
    while True:
        links.append((ids_a[i], ids_b[j]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        i, j = i + step_a, j + step_b
        if step_a and step_b:
            groups.append(",".join(map(str, ids_a[begin_a:i])) + "|" + ",".join(map(str, ids_b[begin_b:j])))
            begin_a, begin_b = i, j
            if i == len(ids_a):
                return ids_a, ids_b, groups, links
        end_a += len(bytes_a[i]) if step_a else 0
        end_b += len(bytes_b[j]) if step_b else 0


def brute(docs):
    pair = al.Pair(*al.tokenizer_files(A, B))
    found = [whole(pair, d[1]) if d[1] else ([], [], [], []) for d in docs]
    counts = Counter(p for f in found for p in f[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return Counter(
        (d[0], len(a), len(b), len(g), len(x), sum(counts[p] == top[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for d, (a, b, g, x) in zip(docs, found)
    )


def odd_texts():
    rng = random.Random(1)
    texts = [
        " ", "  two  spaces \n lines\n\n end ", "x" * 3000, "▁ bad", "don't <|endoftext|> </s> <s>   a\xa0 b\u3000", "日本語 テキスト " * 60, "ok " * 300 + "bad▁ " + "ok " * 300,
        " ".join("é" * rng.randrange(1, 9) + "\U0001f600" for _ in range(200)), "".join(rng.choice("ab \n\t é€'1.") for _ in range(3000)), "word\x00nul \x1c x", "\n", "a", "a",
    ]
    return [(60000 + i // 2, t, "en", "s") for i, t in enumerate(texts)]


def test_against_two_hands(spark):
    docs = all_documents() + odd_texts()
    want = brute(docs)
    for options in ({}, {"range_bytes": 700, "fan_in": 3, "block_chars": 50_000}):
        got = al.aligned(frame(spark, docs).repartition(3), A, B, **options)
        assert Counter(map(tuple, got.select(*COLUMNS).collect())) == want


def test_any_cuts_and_any_order_of_composition():
    """Fragments of arbitrary byte ranges compose to the same groups, however they are bracketed."""
    pair, rng = al.Pair(*al.tokenizer_files(A, B)), random.Random(3)
    text = " " + " ".join(d[1] for d in all_documents()[:4] if d[1])[:1500] + "日本語 ééé"
    ids = pair.tokens(text)
    a, b = (al.Stream(i, np.cumsum(s[i])) for i, s in zip(ids, (pair.size_a, pair.size_b)))
    want = al.group_texts(a, b)
    for _ in range(30):
        size = int(a.ends[-1])
        cuts = sorted({0, size, *(rng.randrange(size) for _ in range(rng.choice([1, 5, 60, 400])))})
        parts = []
        for low, high in zip(cuts, cuts[1:]):
            found, closed, _ = al.fragment(a.cut(low, high), b.cut(low, high))
            parts.append((found, {low: al.group_texts(*closed)}))

        def both(x, y):
            joined, seam = al.compose(x[0], y[0])
            return joined, x[1] | y[1] | ({seam[2] + 0.5: al.group_texts(*seam[:2])} if seam else {})

        def tree(items):
            if len(items) == 1:
                return items[0]
            cut = rng.randrange(1, len(items))
            return both(tree(items[:cut]), tree(items[cut:]))

        for done in (tree(parts), reduce(both, parts)):
            final, groups = both((al.at_start(), {}), done)
            assert final.edge == size and not len(final.suffix[0].ids)
            assert Counter(g for lot in groups.values() for g in lot) == Counter(want)


def test_ranges_cover_the_bytes():
    rng = random.Random(5)
    for text in [d[1] for d in odd_texts()] + ["".join(rng.choice("aé \n") for _ in range(4000))]:
        raw = b" " + text.encode()
        for size in (1, 7, 100, 10**6):
            cuts = list(al.ranges(raw, size))
            assert cuts[0][0] == 0 and cuts[-1][1] == len(raw) and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))
            for low, high, at, to in cuts:
                assert at <= low < high <= to and raw[at:to].decode().startswith(" ")


def test_packing():
    for values in ([], [0], [1, 0, 5], list(range(70_000)), [2**31]):
        x = np.array(values, np.int64)
        assert al.unpacked(al.packed(x), len(x)).tolist() == values


def test_units_are_split_at_single_spaces():
    units = al.Units(al.Pair(*al.tokenizer_files(A, B)))
    codes, sizes = al.split_units(pa.array(["a b  c", "a", " a\nb c "]), units)
    names = {v: k for k, v in units.known.items()}
    assert [names[c] for c in codes.tolist()] == [" a", " b  c", " a", "  a\nb", " c "] and sizes.tolist() == [2, 1, 2]


def test_empty_table_and_empty_texts(spark):
    none = frame(spark, all_documents()).where("false")
    assert al.aligned(none, A, B).count() == 0
    blank = frame(spark, [(None, None, "en", "s"), (1, "", "en", "s")])
    assert Counter(tuple(r)[1:] for r in al.aligned(blank, A, B).select(*COLUMNS).collect()) == Counter({(0, 0, 0, 0, 0, 0, ""): 2})
