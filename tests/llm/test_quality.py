import math
from collections import Counter

import brute
import pytest
from cases import all_documents, frame
from pyspark.sql import functions as F

from tallyworks.llm import robust_quality


def test_against_plain_python(spark):
    docs = all_documents()
    got = robust_quality.judged(frame(spark, docs)).collect()
    want = brute.quality(docs)

    def row(i):
        c, failed, distance, kept = want[i]
        d = None if distance is None else round(distance, 1)
        return docs[i][0], c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"], failed, d, kept

    mine = Counter(
        (r.doc, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
         None if r.distance is None else round(r.distance, 1), r.kept)
        for r in got
    )
    theirs = Counter(row(i) for i in range(len(docs)))
    # distances may round apart
    assert sum((mine - theirs).values()) <= 0.1 * len(docs)
    assert Counter((*r[:7], r[8]) for r in mine.elements()) == Counter((*r[:7], r[8]) for r in theirs.elements())


def test_distances_are_close(spark):
    docs = [d for d in all_documents() if d[0] is not None]
    want = brute.quality(docs)
    got = robust_quality.judged(frame(spark, docs)).where("distance IS NOT NULL").groupBy("doc").agg(F.max("distance").alias("d"))
    best = {}
    for i, d in enumerate(docs):
        if want[i][2] is not None:
            best[d[0]] = max(best.get(d[0], 0), want[i][2])
    for r in got.collect():
        assert math.isclose(r.d, best[r.doc], rel_tol=0.02, abs_tol=0.01)


@pytest.mark.parametrize(
    "text",
    ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "x " * 30, "a b c d e f g", "", "u v w x y z 1 2 3 u v w x y z 1 2 3 4 w x y z 1 2 3 4 q"],
)
def test_repeated_words(spark, text):
    got = spark.range(1).select(robust_quality.repeated_words(robust_quality.plain_words(F.lit(text))).alias("n")).first().n
    assert got == brute.counts(text)["n_repeat_words"]


def test_junk_goes_and_columns_stay(spark):
    # one large group: of two rows neither is the outlier
    docs = [(d[0], d[1], "en", "one") for d in all_documents() if d[2] == "en"]
    junk = [(8000 + i, d[1].replace(" ", "### $$$ "), "en", "one") for i, d in enumerate(docs[:5]) if d[1]]
    table = frame(spark, docs + junk)
    kept = robust_quality.without_outliers(table)
    assert kept.columns == table.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {j[0] for j in junk}
    want = brute.quality(docs + junk)
    assert kept.count() == sum(w[3] for w in want.values())


def test_consistency_factor():
    # closed form for an even number of degrees: 1 - exp(-x/2) (1 + x/2) at four, one more term at six
    factor = robust_quality.consistency(0.75, 4)
    x = 5.385269
    assert math.isclose(factor, 0.75 / (1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)), rel_tol=1e-5)


def test_empty_table(spark):
    table = frame(spark, all_documents()).where("false")
    assert robust_quality.judged(table).count() == 0
    assert robust_quality.without_outliers(table).count() == 0


def test_one_extreme_statistic_is_enough(spark):
    """Repeated lines alone, words apart; every other statistic as in the group."""
    plain = lambda i: "\n".join(f"line {i} {j} of some words that are its own {i * 31 + j}" for j in range(30))
    docs = [(i, plain(i), "en", "one") for i in range(400)]
    lines = [f"a{k} b{k} c{k}" for k in range(33)]
    docs.append((9000, "\n".join(lines[(k * 7) % 33] + ("" if k % 2 else " ") for k in range(182)), "en", "one"))
    got = {r.doc: r for r in robust_quality.judged(frame(spark, docs)).collect()}
    assert not got[9000].kept and sum(r.kept for r in got.values()) == 400


def test_chi2():
    assert math.isclose(robust_quality.chi2_quantile(0.95, 5), 11.0705, abs_tol=1e-3)
    assert math.isclose(robust_quality.chi2_share(11.0705, 5), 0.95, abs_tol=1e-5)
    extremes = [(e / f) ** 2 for (_, e), f in zip(robust_quality.STEPS, robust_quality.FLOORS)]
    assert min(extremes) > robust_quality.CUTOFF


def test_a_filter_on_distances_names_each_statistic_a_few_times(spark):
    # a step that names all earlier ones doubles with every statistic once the filter moves below the projection
    rows = spark.range(50).select(F.lit("a").alias("g1"), F.lit("b").alias("g2"), *[F.rand(i).alias(x) for i, x in enumerate(robust_quality.STATS)])
    rows = robust_quality.stored(rows, "rows")
    fit = robust_quality.stored(robust_quality._scatter(rows, robust_quality.KEYS, 1.0), "fit")
    near = robust_quality._distances(rows, robust_quality.KEYS, fit)
    plan = near.where("d2 <= 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("x1#") <= 20
    l, m = (fit.first()[k] for k in ("l", "m"))
    for r in near.collect():
        z, at = [], 0
        for i, x in enumerate(robust_quality.STATS):
            z.append((r[x] - m[i] - sum(l[at + j] * z[j] for j in range(i))) / l[at + i])
            at += i + 1
        assert math.isclose(r.d2, sum(v * v for v in z), rel_tol=1e-9, abs_tol=1e-12)
