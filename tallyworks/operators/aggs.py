"""Group, column and table summaries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.text import line_anchored
from tallyworks.operators.quantiles import exact_quantiles, long_values, wide_quantiles
from tallyworks.operators.scan import _BLOCK, OrderedScan, null_safe_join


def _known(df: DataFrame, keys: list[str], keep_null_keys: bool) -> DataFrame:
    return df if keep_null_keys else df.dropna(subset=keys)


def sum_by(df: DataFrame, keys: list[str], value: Column, name: str, keep_null_keys: bool = False) -> DataFrame:
    """Sum per group in ascending order; rows without key are left out, a sum of nothing is 0."""
    return (
        _known(df, keys, keep_null_keys)
        .groupBy(*keys)
        .agg(F.coalesce(F.sum(value), F.lit(0)).alias(name))
        .orderBy(name, *keys)
    )


def count_by(df: DataFrame, keys: list[str], name: str = "n", keep_null_keys: bool = False) -> DataFrame:
    return _known(df, keys, keep_null_keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, keys: list[str], value: Column, name: str, keep_null_keys: bool = False) -> DataFrame:
    return _known(df, keys, keep_null_keys).groupBy(*keys).agg(F.avg(value).alias(name))


def profile_by(df: DataFrame, keys: list[str], spec: dict[str, Column], keep_null_keys: bool = False) -> DataFrame:
    """Many named aggregates of each group in one pass."""
    return _known(df, keys, keep_null_keys).groupBy(*keys).agg(*[c.alias(n) for n, c in spec.items()])


def any_by(df: DataFrame, keys: list[str], flag: Column, name: str) -> DataFrame:
    """Whether a flag holds on any row of the group."""
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(flag), F.lit(False)).alias(name))


def concat_by(
    df: DataFrame, keys: list[str], text: str, order: list[str], sep: str = " ", name: str = "content",
    extra: dict[str, Column] | None = None, parts: int | None = None,
) -> DataFrame:
    """Texts of each group in order, as one text, with ``extra`` aggregates of the group.

    A group is put together in parts by the partitions of an ``OrderedScan``; only the finished parts meet.
    """
    more = [c.alias(n) for n, c in (extra or {}).items()]

    def joined(what: str, at: list[str]) -> Column:
        items = F.array_sort(F.collect_list(F.when(F.col(what).isNotNull(), F.struct(*at, F.col(what).alias("__t")))))
        return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda s: s["__t"]), sep))

    scan = OrderedScan(df, keys, order, parts)
    pieces = scan.df.groupBy(*keys, _BLOCK).agg(joined(text, order).alias("__part"))
    done = pieces.groupBy(*keys).agg(joined("__part", [_BLOCK]).alias(name))
    if more:
        done = null_safe_join(done, scan.df.groupBy(*keys).agg(*more), keys)
    return done.withColumn(name, F.coalesce(name, F.lit("")))


def keyword_share(df: DataFrame, code: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """Per code and topic: texts, matching texts and their percentage. One pass for all patterns."""
    hits = [F.count_if(F.col(text).rlike(line_anchored(p))).alias(f"__{t}") for t, p in patterns.items()]
    wide = df.groupBy(code).agg(F.count(text).alias("texts"), *hits)
    rows = [F.struct(F.lit(t).alias("topic"), F.col(f"__{t}").alias("matches")) for t in patterns]
    return wide.select(code, "texts", F.inline(F.array(*rows))).withColumn(
        "percent", F.round(F.try_divide(F.col("matches") * 100.0, F.col("texts")), 2)
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Values by falling frequency."""
    return count_by(df, [col]).orderBy(F.desc("n"), col)


def nunique(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values of every column, one row per column.

    Exact counts reduce (column, value) pairs on the map side, so that no row is expanded once per
    column through the shuffle with all its values; ``approx`` needs a single aggregate.
    """
    columns = columns or df.columns
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return unpivot_row(wide, columns, "distinct_values")
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]
    pairs = df.select(F.inline(F.array(*cells))).distinct()
    return pairs.groupBy("column").agg(F.count("v").alias("distinct_values"))


def unpivot_row(wide: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One-row table as rows (column, name)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns]
    return wide.select(F.inline(F.array(*cells)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column (NaN counts as missing)."""

    def missing(name: str, kind: str) -> Column:
        gap = F.col(name).isNull()
        return gap | F.isnan(name) if kind in ("double", "float") else gap

    wide = df.agg(*[F.count_if(missing(n, t)).alias(n) for n, t in df.dtypes])
    return unpivot_row(wide, df.columns, "nulls")


def describe_numbers(
    df: DataFrame, columns: list[str], parts: int | None = None, accuracy: int | None = None
) -> DataFrame:
    """count, mean, sd, min, quartiles, max of each column.

    Quartiles are exact; with ``accuracy`` they are those of ``percentile_approx``, in one pass.
    """
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    moments = (
        long_values(df, columns)
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("sd"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            *(
                [F.percentile_approx("value", s, accuracy).alias(n) for s, n in names.items()]
                if accuracy
                else []
            ),
        )
    )
    if accuracy:
        return moments
    quartiles = exact_quantiles(df, columns, list(names), parts=parts)
    return moments.join(wide_quantiles(quartiles, names, ["column"]), "column")


def describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, distinct values, most frequent value and its frequency (ties: first in order)."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*cells))).where(F.col("v").isNotNull())
        .groupBy("column", "v").agg(F.count(F.lit(1)).alias("k"))
    )
    return counted.groupBy("column").agg(
        F.sum("k").alias("n"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.min_by("v", F.struct(-F.col("k"), F.col("v"))).alias("top"),
        F.max("k").alias("freq"),
    )


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete correlations (a, b, r) of all column pairs in one aggregate.

    Pairs of one column with itself and both orders are listed; booleans count as 0 and 1.
    """
    kinds = dict(df.dtypes)
    num = {c: F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c) for c in columns}
    upper = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    wide = df.agg(*[F.corr(num[columns[i]], num[columns[j]]).alias(f"r_{i}_{j}") for i, j in upper])
    cells = [
        F.struct(F.lit(columns[a]).alias("a"), F.lit(columns[b]).alias("b"), F.col(f"r_{i}_{j}").alias("r"))
        for i, j in upper
        for a, b in ({(i, j), (j, i)})
    ]
    return wide.select(F.inline(F.array(*cells)))


def band_of(r: Column) -> Column:
    """S above 0.75, M above 0.5, W above 0.25, by absolute value; else N."""
    size = F.abs(r)
    return F.when(size > 0.75, "S").when(size > 0.5, "M").when(size > 0.25, "W").otherwise("N")


def class_ratio(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(label).alias("n"), F.avg(label).alias("ratio"))


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """Counts by the codes of ``a`` (rows) and the given codes of ``b`` (columns)."""
    return df.groupBy(a).agg(*[F.count_if(F.col(b) == v).alias(f"{b}_{v}") for v in values])


def confusion(df: DataFrame, label: Column, pred: Column, by: list[str] = (), digits: int = 2) -> DataFrame:
    """Counts of the four outcomes with accuracy and the six rates, per group.

    A rate over nothing is null. ``npv`` is the negative predictive value; recall is ``tpr``.
    """
    yes, no = label == 1, label == 0
    hit, miss = pred == 1, pred == 0
    counts = df.groupBy(*by).agg(
        F.count_if(no & miss).alias("tn"),
        F.count_if(no & hit).alias("fp"),
        F.count_if(yes & miss).alias("fn"),
        F.count_if(yes & hit).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def rate(part: Column, whole: Column) -> Column:
        return F.round(F.try_divide(part, whole), digits)

    return counts.withColumns(
        {
            "accuracy": rate(tp + tn, tp + tn + fp + fn),
            "fnr": rate(fn, fn + tp),
            "fpr": rate(fp, fp + tn),
            "tpr": rate(tp, tp + fn),
            "tnr": rate(tn, tn + fp),
            "ppv": rate(tp, tp + fp),
            "npv": rate(tn, tn + fn),
        }
    )


def box_stats(df: DataFrame, columns: list[str], keys: list[str] = (), parts: int | None = None) -> DataFrame:
    """Minimum, quartiles, maximum and the fences 1.5 quartile distances away."""
    names = {0.0: "min", 0.25: "q25", 0.5: "q50", 0.75: "q75", 1.0: "max"}
    five = wide_quantiles(
        exact_quantiles(df, columns, list(names), list(keys), parts), names, [*keys, "column"]
    )
    spread = F.col("q75") - F.col("q25")
    return five.withColumns({"low_fence": F.col("q25") - 1.5 * spread, "high_fence": F.col("q75") + 1.5 * spread})


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Counts of equal-width bins between minimum and maximum; the last bin holds the maximum."""
    ends = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, n long")
    width = (hi - lo) / bins or 1.0
    place = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("int")
    return df.where(F.col(col).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each group, found by a map-side combined minimum (no sort of the group)."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("__r")).select(*keys, "__r.*").select(*df.columns)


def argmax_by(df: DataFrame, keys: list[str], item: str, value: str) -> DataFrame:
    """Item with the largest value of each group, the smallest item on a tie."""
    best = F.min_by(F.struct(F.col(item), F.col(value)), F.struct(-F.col(value), F.col(item)))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def scores_wide(df: DataFrame, keys: list[str], label: str, score: str, labels: list[str], prefix: str = "") -> DataFrame:
    """Mean score per group in one column per label, in the given order."""
    cols = [
        F.avg(F.when(F.col(label) == v, F.col(score))).alias(prefix + re.sub(r"\W+", "_", v)) for v in labels
    ]
    return df.groupBy(*keys).agg(*cols)
