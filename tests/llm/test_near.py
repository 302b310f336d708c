import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from cases import all_documents, frame
from pyspark.sql import functions as F

from tallyworks.llm import dart_minhash as dm


def planted(seed=3):
    rng = random.Random(seed)
    docs = all_documents()
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    # a hot group around one text, a chain whose ends are far apart, and pairs on both sides of the threshold
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6])):
            w[rng.randrange(300)] = word()
        docs.append((40000 + i, " ".join(w), "en", f"s{i % 7}"))
    chain = [word() for _ in range(250)]
    for i in range(12):
        chain = chain[9:] + [word() for _ in range(9)]
        docs.append((41000 + i, ", ".join(chain).upper(), "en", "s"))
    for i in range(60):
        w = [word() for _ in range(rng.choice([5, 8, 40, 150]))]
        docs.append((42000 + 2 * i, " ".join(w), "en", "s"))
        for _ in range(rng.choice([0, 1, 2, 3])):
            w[rng.randrange(len(w))] = word()
        docs.append((42001 + 2 * i, " ".join(w + w[:3]), "en", "s"))
    docs += [(43000, "one line " * 50, "en", "s"), (43001, "one line " * 47, "en", "s"), (43002, "one line " * 20, "en", "s")]
    return docs


def test_classes_against_all_pairs(spark):
    docs = planted()
    got = Counter((r.doc, getattr(r, "class")) for r in dm.near_duplicates(frame(spark, docs)).collect())
    want = Counter(zip((d[0] for d in docs), brute.classes(docs)))
    assert got == want and any(a != b for a, b in want)


def test_one_of_each_class_stays(spark):
    docs = planted()
    table = frame(spark, docs)
    kept = dm.without_near_duplicates(table)
    assert kept.columns == table.columns
    classes = brute.classes(docs)
    worded = {c for d, c in zip(docs, classes) if brute.folded(d[1])}
    rows = kept.collect()
    want = len({c for c in worded if c is not None}) + len({tuple(brute.folded(d[1])) for d, c in zip(docs, classes) if c is None and brute.folded(d[1])})
    want += len({(d[0], d[1]) for d in docs if not brute.folded(d[1])})
    assert len(rows) == want
    assert {r.doc_id for r in rows if brute.folded(r.text)} >= {c for c in worded if c is not None}


def test_signature_agrees_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    sims = []
    for shared in (50, 200, 350):
        a = np.concatenate([np.arange(shared), 1000 + np.arange(400 - shared)])
        b = np.concatenate([np.arange(shared), 2000 + np.arange(400 - shared)])
        a, b = np.repeat(a, rng.integers(1, 4, len(a))), np.repeat(b, rng.integers(1, 4, len(b)))
        both = sum((Counter(a.tolist()) & Counter(b.tolist())).values())
        true = both / (len(a) + len(b) - both)
        run = np.concatenate([a, b]).astype(np.uint64)
        owner = np.repeat([0, 1], [len(a), len(b)])
        sig = dm.signatures(dm.unit_cells(dm.mixed(run), owner), owner, np.array([len(a), len(b)], float), 4000)
        sims.append((true, (sig[0] == sig[1]).mean()))
    assert all(abs(x - y) < 0.03 for x, y in sims)


def test_earliest_dart_of_all():
    """Throwing far more darts changes nothing; broken cells take part by their height."""
    seeds = dm.mixed(np.arange(1, 41, dtype=np.uint64))
    owner = np.zeros(40, np.int64)
    height = np.where(np.arange(40) < 35, 1.0, 0.3)
    weight = np.array([height.sum()])
    got = dm.signatures(seeds, owner, weight, 64, height)
    _, where, rank, dart = dm.darts(seeds, owner, np.array([500.0]), 64, height)
    for c in range(64):
        mine = np.flatnonzero(where == c)
        assert got[0, c] == dart[mine[rank[mine].argmin()]]


def test_number_of_darts_does_not_grow_with_the_text():
    for n in (5, 500, 50_000):
        seeds = dm.mixed(np.arange(n, dtype=np.uint64))
        found = dm.darts(seeds, np.zeros(n, np.int64), np.array([800.0 / n]), 96)
        assert 650 < len(found[0]) < 950


def test_shingles():
    texts = ["a B, c.d  e f", "x", "... -", "a b c d e", "one two three four", ""]
    run, owner = dm.shingles(*dm.word_hashes(pa.array(texts), dm.Folder()))
    assert np.bincount(owner, minlength=6).tolist() == [2, 1, 0, 1, 1, 0] and run[0] == run[3] and len(set(run.tolist())) == 4


def test_components(spark):
    chain = [(f"{i:04d}", f"{i + 1:04d}") for i in range(300)] + [("x", "y"), ("y", "z"), ("z", "x"), ("q", "q")]
    nodes = sorted({n for e in chain for n in e} | {"alone"})
    labels = spark.createDataFrame([(n, n) for n in nodes], "t string, c string")
    got = {r.t: r.c for r in dm.components(labels, spark.createDataFrame(chain, "x string, y string")).collect()}
    assert {got[f"{i:04d}"] for i in range(301)} == {"0000"} and got["z"] == "x" and got["q"] == "q" and got["alone"] == "alone"


def test_empty_table(spark):
    none = frame(spark, all_documents()).where("false")
    assert dm.near_duplicates(none).count() == 0 and dm.without_near_duplicates(none).count() == 0
    blank = frame(spark, [(1, None, "en", "s"), (2, "", "en", "s"), (3, "...", "en", "s"), (None, " ", "en", "s")])
    assert Counter(getattr(r, "class") for r in dm.near_duplicates(blank).collect()) == Counter([1, 2, 3, None])
    assert dm.without_near_duplicates(blank).count() == 4


def test_rows_travel_once_and_bands_twice(spark, monkeypatch):
    # bands are exchanged to be counted and to meet their counts; texts that nobody asks for are left out where they are read
    plans, write = {}, dm.stored

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(dm, "stored", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = dm.stored(frame(spark, all_documents()), "docs")
        kept = dm.without_near_duplicates(docs)
        last = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(p.count("Generate posexplode(bands") for p in plans.values()) == 2
    assert "_bits" in plans["dart-texts"]
    assert last.count("Exchange hashpartitioning") == 2  # the rows, and the keys of those that stay


def test_asked_for_rows_are_all_found(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 50 > 0, F.col("id") % 700).alias("doc"), F.xxhash64("id").alias("doc_hash"))
    keyed = rows.select(*dm.row_key(F.col("doc"), F.col("doc_hash")), "doc")
    wanted = keyed.where("doc is null or doc % 10 = 3")
    found = dm.perhaps_among(keyed, wanted, dm.ROW_KEY)
    assert found.join(wanted, dm.ROW_KEY, "left_semi").count() == wanted.count() <= found.count() < wanted.count() + 20
    assert dm.perhaps_among(keyed, wanted.where("false"), dm.ROW_KEY).count() == 0
