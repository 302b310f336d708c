"""Quality rules: documents whose statistics lie far from the robust centre of their language and source.

Each document gets counts of words, characters, symbols, repeated lines and repeated words, turned into a
vector of five transformed statistics. Per language and source the minimum-covariance-determinant
estimate is found by concentration steps: mean and covariance of the current subset, Mahalanobis
distances of all rows, the closest ``subset`` share of them as the next subset, until the distance that cuts off the subset stays the
same in every group. There are two starts, run side by side: the share closest to the medians, scaled by median absolute
deviations, and the share closest to the mean of all rows; of the two ends the one of smaller determinant holds.
Rows beyond ``cutoff``, a quantile of the chi-squared distribution, are rejected.

Medians and shares are read from counts of fine value bins, so a group of a third of all rows is a few
hundred counts that combine on the map side; no group is collected or sorted. Sums of squares and
products are one aggregate per step; the Cholesky factor is column arithmetic on one row per group.
A floor per statistic (``FLOORS``) is added to its variance: it keeps the covariance of small or constant
groups regular and says what difference counts as one step. No floor is so high that a statistic at its extreme, in a group that has
no spread in it, stays within the cutoff.

Defined cases: a null text has no words and fails the base rule; null languages and sources form groups
of their own; a group of one row keeps it, as it is its own centre; repeated rows count as often as they
come; an empty table gives no rows. A window of eight words is told by a 64-bit hash within its text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import BLANKS, let, plain_words, stored, text_hash, text_or_empty

WINDOW = 8
SUBSET = 0.75
# concentration ends when no cut moves; where binned cuts go round, after so many steps
MOST_STEPS = 30
# share of normal rows beyond the cutoff
REJECTED = 1.5e-5
STATS = ["x1", "x2", "x3", "x4", "x5"]
BINS_PER_UNIT = 200


def chi2_share(x: float, degrees: int) -> float:
    """Share of the chi-squared distribution below ``x``, by the series of the lower incomplete gamma function."""
    a, half = degrees / 2, x / 2
    term = total = 1 / a
    for i in range(1, 400):
        term *= half / (a + i)
        total += term
    return total * math.exp(a * math.log(half) - half - math.lgamma(a))


def chi2_quantile(share: float, degrees: int) -> float:
    low, high = 1e-9, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, degrees) < share else (low, mid)
    return low


def consistency(subset: float, degrees: int) -> float:
    """By how much the covariance of the closest ``subset`` of normal rows falls short of the whole."""
    return subset / chi2_share(chi2_quantile(subset, degrees), degrees + 2)


# squared distance beyond which a row goes
CUTOFF = chi2_quantile(1 - REJECTED, len(STATS))
# ln mean word length, roots of the shares of symbols, repeated lines, repeated words, capitals: the step that counts, and the most
# there can be (a text of over 0.3 repeated words has failed the base rule)
STEPS = [(0.06, math.inf), (0.05, 1.0), (0.155, 1.0), (0.2, math.sqrt(0.3)), (0.08, 1.0)]
FLOORS = [min(step, 0.95 * extreme / math.sqrt(CUTOFF)) for step, extreme in STEPS]
KEYS = ["g1", "g2"]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words stand in a window of ``width`` words that the text holds twice or more."""

    def runs(hashes: Column) -> Column:
        last = F.size(hashes) - width
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            ordered,
            lambda s: F.filter(
                s,
                lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(width), F.coalesce(F.get(p, j + 1) - x, F.lit(width)))),
                F.lit(0),
                lambda n, x: n + x,
            ),
        )

    def counted(windows: Column) -> Column:
        # most texts hold no window twice: a hash set of longs says so at little cost
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(windows))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(hashed, lambda h: let(runs(h), counted)))


def text_statistics(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``doc, doc_hash, g1, g2``, the counts, ``base_failed`` and the statistics ``x1`` to ``x5`` of every document."""
    body = docs.select(
        F.col(doc_id).alias("doc"),
        text_hash(text).alias("doc_hash"),
        # a group is named by two texts that are never null
        F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("")).alias("g1"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("g2"),
        text_or_empty(text).alias("body"),
    )
    worded = body.withColumn("words", plain_words(F.col("body")))
    counted = worded.select(
        "doc", "doc_hash", "g1", "g2", "body",
        F.size("words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("body", F.lit("\\p{Lu}")).cast("bigint").alias("n_capitals"),
        F.filter(F.split("body", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
        repeated_words(F.col("words")).cast("bigint").alias("n_repeat_words"),
    )
    counted = counted.withColumn("n_lines", F.size("lines").cast("bigint")).withColumn(
        "n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines"))
    )

    def root(part: str, whole: str) -> Column:
        return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    return counted.select(
        "doc", "doc_hash", "g1", "g2", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("x1"),
        root("n_symbols", "word_chars").alias("x2"),
        root("n_dup_lines", "n_lines").alias("x3"),
        root("n_repeat_words", "n_words").alias("x4"),
        root("n_capitals", "word_chars").alias("x5"),
    )


def _bin(value: Column) -> Column:
    return F.floor(value * BINS_PER_UNIT).cast("bigint")


def _share_bin(counts: DataFrame, keys: list[str], share: float) -> DataFrame:
    """``keys, cut``: the lowest bin up to which ``share`` of the rows lie. ``counts`` has ``keys, bin, n``."""
    upto = Window.partitionBy(*keys).orderBy("bin")
    whole = Window.partitionBy(*keys)
    summed = counts.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(whole))
    return summed.where(F.col("_upto") >= F.lit(share) * F.col("_all")).groupBy(*keys).agg(F.min("bin").alias("cut"))


def _medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """``g1, g2`` and one array of medians of the values, exact to half a bin."""
    long = rows.select("g1", "g2", F.posexplode(F.array(*[_bin(v) for v in values])).alias("k", "bin"))
    cuts = _share_bin(long.groupBy("g1", "g2", "k", "bin").agg(F.count(F.lit(1)).alias("n")), ["g1", "g2", "k"], 0.5)
    placed = cuts.groupBy("g1", "g2").agg(F.sort_array(F.collect_list(F.struct("k", "cut"))).alias("all"))
    return placed.select("g1", "g2", F.transform("all", lambda x: (x["cut"] + 0.5) / BINS_PER_UNIT).alias("m"))


def _log_distance(squared: Column) -> Column:
    """Bin of a squared distance; logarithmic, so bins are as fine near the centre as far out."""
    return F.floor(F.log1p(squared) * BINS_PER_UNIT).cast("bigint")


def _closest(rows: DataFrame, keys: list[str], subset: float) -> DataFrame:
    """Bin of the squared distance ``d2`` within which the ``subset`` share of each group lies."""
    counts = rows.groupBy(*keys, _log_distance(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return _share_bin(counts, keys, subset)


def _scatter(rows: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """The keys, means ``m``, lower Cholesky factor ``l`` (row by row) and log determinant ``det`` of the rows of each group."""
    k = range(len(STATS))
    sums = [F.avg(STATS[i]).alias(f"m{i}") for i in k]
    products = [F.avg(F.col(STATS[i]) * F.col(STATS[j])).alias(f"p{i}{j}") for i in k for j in k if j <= i]
    fit = rows.groupBy(*keys).agg(*sums, *products)
    for i in k:
        for j in range(i + 1):
            cov = (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * F.lit(factor)
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + F.lit(FLOORS[i] ** 2)
            rest = reduce(lambda s, t: s - F.col(f"l{i}{t}") * F.col(f"l{j}{t}"), range(j), cov)
            # the floor bounds the diagonal from below; rounding may not pass it
            value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}")
            fit = fit.withColumn(f"l{i}{j}", value)
    return fit.select(
        *keys, F.array(*[F.col(f"m{i}") for i in k]).alias("m"), F.array(*[F.col(f"l{i}{j}") for i in k for j in range(i + 1)]).alias("l"),
        (2 * reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in k])).alias("det"),
    )


def _whitening(fit: DataFrame) -> DataFrame:
    """The fit with ``w``, the inverse of its Cholesky factor (row by row), in place of ``l``."""
    at = lambda i, j: i * (i + 1) // 2 + j
    k = range(len(STATS))
    for i in k:
        for j in range(i + 1):
            own = F.col("l")[at(i, i)]
            below = [F.col("l")[at(i, t)] * F.col(f"_w{t}{j}") for t in range(j, i)]
            fit = fit.withColumn(f"_w{i}{j}", 1 / own if i == j else -reduce(lambda a, b: a + b, below) / own)
    names = [f"_w{i}{j}" for i in k for j in range(i + 1)]
    return fit.withColumn("w", F.array(*names)).drop("l", *names)


def _distances(rows: DataFrame, keys: list[str], fit: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance to the fit; keys that only the fit has come along.

    Every statistic stands in the expression once for each row of the inverse factor. Solved step by step, each step would name
    all earlier ones, and a filter on ``d2``, which the planner moves below the projection, would evaluate them over and over.
    """
    out, at, parts = rows.join(_whitening(fit.drop("det")), keys), 0, []
    for i in range(len(STATS)):
        terms = [F.col("w")[at + j] * (F.col(STATS[j]) - F.col("m")[j]) for j in range(i + 1)]
        parts.append(F.pow(reduce(lambda a, b: a + b, terms), F.lit(2.0)))
        at += i + 1
    return out.withColumn("d2", reduce(lambda a, b: a + b, parts)).drop("m", "w")


def robust_fit(rows: DataFrame, subset: float = SUBSET, most_steps: int = MOST_STEPS) -> DataFrame:
    """The estimate of every group over rows with ``g1, g2`` and the statistics; a small table."""
    values = [F.col(x) for x in STATS]
    centre = stored(_medians(rows, values), "mcd-medians")
    moved = rows.join(centre, KEYS)
    spread = stored(_medians(moved, [F.abs(F.col(x) - F.col("m")[i]) for i, x in enumerate(STATS)]).withColumnRenamed("m", "s"), "mcd-spread")
    parts = [
        F.pow((F.col(x) - F.col("m")[i]) / (F.col("s")[i] * 1.4826 + FLOORS[i]), F.lit(2.0)) for i, x in enumerate(STATS)
    ]
    by_medians = moved.join(spread, KEYS).withColumn("d2", reduce(lambda a, b: a + b, parts)).drop("m", "s")
    by_means = _distances(rows, KEYS, stored(_scatter(rows, KEYS, 1.0), "mcd-means"))
    near = by_medians.withColumn("start", F.lit(0)).unionByName(by_means.withColumn("start", F.lit(1)))
    keys, factor, last, fit = ["start", *KEYS], consistency(subset, len(STATS)), None, None
    for step in range(most_steps):
        cut = stored(_closest(near, keys, subset), f"mcd-cut-{step}")
        if last is not None and cut.join(last, [*keys, "cut"], "left_anti").isEmpty():
            break
        kept = near.join(cut, keys).where(_log_distance(F.col("d2")) <= F.col("cut"))
        fit, last = stored(_scatter(kept, keys, factor), f"mcd-fit-{step}"), cut
        near = _distances(rows, KEYS, fit)
    best = fit.groupBy(*KEYS).agg(F.min(F.struct("det", "start", "m", "l")).alias("f"))
    return stored(best.select(*KEYS, "f.m", "f.l", "f.det"), "mcd-best")


def judged(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    subset: float = SUBSET,
    most_steps: int = MOST_STEPS,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``doc, doc_hash``, the counts, ``base_failed``, ``distance`` (squared, null if the base failed) and ``kept``."""
    rows = stored(text_statistics(docs, doc_id, text, lang, source), "text-statistics")
    fit = robust_fit(rows.where(~F.col("base_failed")).select(*KEYS, *STATS), subset, most_steps)
    passed = _distances(rows.where(~F.col("base_failed")), KEYS, fit)
    failed = rows.where("base_failed").withColumn("d2", F.lit(None).cast("double"))
    return passed.unionByName(failed).select(
        "doc", "doc_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("d2").alias("distance"), F.coalesce(F.col("d2") <= F.lit(cutoff), F.lit(False)).alias("kept"),
    )


def without_outliers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", **options) -> DataFrame:
    """The documents that are kept; columns as they came."""
    rejected = judged(docs, doc_id, text, lang, source, **options).where("not kept").select("doc", "doc_hash").distinct()
    rejected = stored(rejected, "rejected")
    # text_hash of a null text is the hash of nothing, on both sides
    return docs.join(rejected, docs[doc_id].eqNullSafe(rejected["doc"]) & (text_hash(text) == rejected["doc_hash"]), "left_anti")
