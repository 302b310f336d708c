"""Ordered columns: one partition and many have to agree, whatever the partitioning."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyworks.operators import windows
from tallyworks.operators.aggs import concat_by, describe_numbers
from tallyworks.operators.quantiles import _full_scan, exact_quantiles
from tallyworks.operators.scan import OrderedScan

WHOLE, TINY = 1, 9


@pytest.fixture(scope="module")
def events(spark):
    """A hot key with a third of the rows, keys with one row, a null key, null values."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        key = "hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{i % 40}"
        value = None if rng.random() < 0.3 else rng.randint(-20, 20) / 4
        rows.append((key, i, rng.choice(["a", "b"]), value, rng.random() < 0.5))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, pos long, kind string, value double, flag boolean").repartition(5)


def test_only_groups_that_a_bound_cuts_are_carried(events, monkeypatch):
    """What is joined to the rows is smaller than the number of partitions, whatever the number of groups."""
    from tallyworks.operators import scan

    stored, keep = [], scan.cut_lineage
    monkeypatch.setattr(scan, "cut_lineage", lambda df: stored.append(keep(df)) or stored[-1])
    assert windows.runs(events, ["key"], ["pos"], "kind", parts=TINY).count() == 300
    carried = [df.count() for df in stored if "__carry" in df.columns]
    assert len(carried) == 2 and 0 < max(carried) < TINY


CASES = {
    "previous": lambda df, keys, n: windows.previous(df, keys, ["pos"], "kind", "out", n),
    "change_flag": lambda df, keys, n: windows.change_flag(df, keys, ["pos"], "kind", "out", n),
    "runs": lambda df, keys, n: windows.runs(df, keys, ["pos"], "kind", "out", n),
    "run_starts": lambda df, keys, n: windows.run_starts(df, keys, ["pos"], "flag", "out", n),
    "cum_sum": lambda df, keys, n: windows.cum_sum(df, keys, ["pos"], "value", "out", n).withColumn("out", F.round("out", 6)),
    "mean_before": lambda df, keys, n: windows.running_mean(df, keys, ["pos"], "value", False, n)
    .withColumn("out", F.round("mean_so_far", 6)).drop("mean_so_far"),
    "fill_back": lambda df, keys, n: windows.fill_back(df, keys, ["pos"], "value", "out", n),
    "even_parts": lambda df, keys, n: windows.even_parts(df, keys, ["pos"], F.lit(4), "out", n),
    "group_size": lambda df, keys, n: OrderedScan(df, keys, ["pos"], n).with_group_size("out").result(),
    "merge": lambda df, keys, n: windows.merge_adjacent(df.drop("kind", "value", "flag").withColumn("t", F.col("pos").cast("string")), keys, "pos", "t", None, "out", n),
    "concat": lambda df, keys, n: concat_by(df, keys, "kind", ["pos"], ",", "out", {"n": F.count(F.lit(1))}, n),
}


@pytest.mark.parametrize("keys", [["key"], []], ids=["keyed", "no_key"])
@pytest.mark.parametrize("case", CASES)
def test_split_scan_agrees_with_window(events, as_rows, case, keys):
    if case == "concat" and not keys:
        pytest.skip("one text of the whole table is asked for nowhere")
    plain = CASES[case](events, keys, WHOLE)
    split = CASES[case](events, keys, TINY)
    assert plain.columns == split.columns
    assert as_rows(plain) == as_rows(split)


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_matter(events, as_rows, parts):
    assert as_rows(CASES["runs"](events.repartition(parts), ["key"], WHOLE)) == as_rows(CASES["runs"](events, ["key"], TINY))


def test_hot_key_is_spread(events):
    scan = OrderedScan(events, ["key"], ["pos"], TINY)
    assert scan.df.where("key = 'hot'").select("__block").distinct().count() > 2


def test_first_row_single_row_and_equal_runs(spark, as_rows):
    df = spark.createDataFrame([("x", 1, "a"), ("y", 1, "a"), ("y", 2, "a"), ("y", 3, "b")], "k string, pos long, v string")
    assert as_rows(windows.change_flag(df, ["k"], ["pos"], "v"), "k", "pos", "changed") == [
        ("x", 1, 1), ("y", 1, 1), ("y", 2, 0), ("y", 3, 1)
    ]


def test_fill_back_leading_inner_trailing(spark, as_rows):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 7.0), (5, None)], "day int, price double")
    assert as_rows(windows.fill_back(df, [], ["day"], "price", "p"), "day", "p") == [(1, 5.0), (2, 5.0), (3, 7.0), (4, 7.0), (5, None)]


@pytest.mark.parametrize("n", [0, 1, 29, 30, 31, 65])
@pytest.mark.parametrize("k", [1, 2, 30])
def test_even_parts(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "pos")
    got = [r["part"] for r in windows.even_parts(df, [], ["pos"], F.lit(k)).orderBy("pos").collect()]
    short, longer = divmod(n, k)
    want = [i + 1 for i in range(k) for _ in range(short + (i < longer))]
    assert got == want


def quantile(values, share):
    values = sorted(values)
    place = share * (len(values) - 1)
    low = int(place)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("size", [1, 2, 50, 30_000])
def test_quantiles_are_exact(spark, size):
    rng = random.Random(size)
    values = [round(rng.gauss(0, 10), 1) if i % 3 else 0.5 for i in range(size)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    for found in (exact_quantiles(df, ["v"], shares), exact_quantiles(df, ["v"], shares, parts=20), _full_scan(df, ["v"], shares, [], 20)):
        got = {r["share"]: r["quantile"] for r in found.collect()}
        assert got == pytest.approx({s: quantile(values, s) for s in shares})


def test_describe_with_accuracy_is_close(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    row = describe_numbers(df, ["v"], accuracy=10_000).first()
    assert (row["q25"], row["q50"], row["q75"]) == pytest.approx((250, 500, 750), abs=1)


def test_merge_adjacent_marks_and_separate_places(spark, as_rows):
    df = spark.createDataFrame(
        [("a", 1, "▁Mal"), ("a", 2, "ware"), ("a", 5, "▁Bot"), ("a", 6, "▁net"), ("b", 3, "▁X")], "k string, pos long, w string"
    )
    out = windows.merge_adjacent(df, ["k"], "pos", "w", "▁")
    assert as_rows(out, "k", "start", "term") == [("a", 1, "Malware"), ("a", 5, "Bot net"), ("b", 3, "X")]


def test_flags_and_runs_over_nulls(spark, as_rows):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a", None, None, "a", "a", None])], "pos int, v string")
    for parts in (1, 2, 6):
        assert as_rows(windows.change_flag(df, [], ["pos"], "v", "c", parts), "pos", "c") == [(0, 1), (1, 1), (2, 0), (3, 1), (4, 0), (5, 1)]
        assert [r[1] for r in as_rows(windows.runs(df, [], ["pos"], "v", "r", parts), "pos", "r")] == [1, 2, 2, 3, 3, 4]


def test_against_a_plain_window(events, as_rows):
    w = Window.partitionBy("key").orderBy("pos")
    plain = events.withColumn("out", F.sum(F.coalesce("value", F.lit(0.0))).over(w))
    split = CASES["cum_sum"](events, ["key"], TINY)
    assert as_rows(plain.withColumn("out", F.round("out", 6)), "key", "pos", "out") == as_rows(split, "key", "pos", "out")
