import math
from collections import Counter, defaultdict

import brute
from cases import all_documents, frame
from pyspark.sql import functions as F

from tallyworks.llm import mixing


def skewed():
    docs = all_documents()
    return docs + [(50000 + i, d[1], "en", "hot") for i, d in enumerate(docs)] + [(60000, "", "en", "empty"), (60001, None, "en", "empty")]


def test_against_plain_python(spark):
    docs = skewed()
    got = mixing.mixed_blocks(frame(spark, docs), block_tokens=5000).collect()
    want = brute.mixture(docs, block_tokens=5000)
    # rows without id, or of one id, block and pass, may only change places among themselves
    assert Counter((r.doc, r.source, r["pass"], r.block, r.tokens) for r in got) == Counter((*r[:4], r[5]) for r in want)
    once = Counter(d[0] for d in docs)
    mine = {(r.doc, r["pass"], r.block): r.place for r in got if once[r.doc] == 1}
    assert mine == {(r[0], r[2], r[3]): r[4] for r in want if once[r[0]] == 1}


def test_targets(spark):
    docs = skewed()
    rows = mixing.token_rows(frame(spark, docs))
    totals = mixing.source_totals(rows)
    by = {r.source: r.tokens for r in totals.collect() if r.tokens}
    tokens = sum(by.values())
    own = -sum(t / tokens * math.log(t / tokens) for t in by.values())
    goal = (own + math.log(len(by))) / 2
    a = mixing.entropy_exponent(totals, tokens, goal)
    z = sum((t / tokens) ** a for t in by.values())
    q = {s: (t / tokens) ** a / z for s, t in by.items()}
    assert 0 < a < 1 and abs(-sum(x * math.log(x) for x in q.values()) - goal) < 1e-4
    b = mixing.repeat_exponent(totals, tokens, tokens, 2.0)
    z = sum((t / tokens) ** b for t in by.values())
    assert max((t / tokens) ** b / z * tokens / t for t in by.values()) <= 2.0
    assert mixing.entropy_exponent(totals, tokens, 0.0) == 1.0


def test_prefixes_have_the_mixture(spark):
    docs = skewed()
    got = mixing.mixed_blocks(frame(spark, docs), block_tokens=5000).collect()
    per, passes = defaultdict(Counter), defaultdict(set)
    for r in got:
        per[r.block][r.source] += r.tokens
        passes[r.source].add(r["pass"])
    places = defaultdict(list)
    for r in got:
        places[r.block].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(map(len, passes.values())) <= 4 and "empty" not in passes


def test_empty_table(spark):
    assert mixing.mixed_blocks(frame(spark, skewed()).where("false")).count() == 0
    only = frame(spark, [(1, None, "en", "a"), (2, "", "en", None)])
    assert mixing.mixed_blocks(only).count() == 0
    one = frame(spark, [(1, "a b c", "en", None)])
    assert [(r.doc, r.source, r.tokens) for r in mixing.mixed_blocks(one).collect()] == [(1, None, 3)]


def test_rows_without_id_are_spread_over_the_ranges(spark):
    docs = [(None if i % 2 else i, f"text number {i} here", "en", "s") for i in range(900)]
    rows = mixing.token_rows(frame(spark, docs)).withColumn("hash", F.md5(F.concat_ws(":", F.lit("mix"), F.lit("0"), F.col("doc").cast("string"), "source", "digest")))
    most = rows.withColumn("n", F.lit(30)).groupBy(mixing._hash_place("n", "hash")).count().agg(F.max("count")).first()[0]
    assert most < 70
