"""Traps of columns, filters, recoding, joins, summaries and sources."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import dates, text
from tallyworks.functions.fixed_values import AGE_EDGES, AGE_LABELS, CHARGE_SEVERITY, IS_A_RULES
from tallyworks.operators import aggs, features, frame, joins
from tallyworks.session import new_folder
from tallyworks.sources import files, pages, tables


def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("Low",), ("N/A",), (None,)], "s string")
    assert {r[0] for r in df.where(frame.not_equal_keep_null(F.col("s"), "N/A")).collect()} == {"Low", None}


def test_bins_on_edges(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 20, 21, 30, 60, 61)], "v int")
    got = [r[0] for r in df.select(frame.bin_by(F.col("v"), AGE_EDGES, AGE_LABELS)).collect()]
    assert got == ["0", "<20", "<20", "20-30", "20-30", "50-60", ">60"]


def test_recode_all_codes_and_unknown(spark):
    df = spark.createDataFrame([(c,) for c in [*CHARGE_SEVERITY, "(Z9)"]], "c string")
    got = [r[0] for r in df.select(frame.recode(F.col("c"), CHARGE_SEVERITY, keep_unknown=False)).collect()]
    assert got == [*CHARGE_SEVERITY.values(), None]


def test_indicators_and_row_sum_with_nulls(spark, as_rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    wide = frame.indicators(df, "c")
    assert as_rows(wide, "id", "c_a", "c_b") == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    total = wide.select("id", frame.row_sum([F.lit(None).cast("int"), F.col("c_a"), F.lit(2)]).alias("s"))
    assert as_rows(total) == [(1, 3), (2, 2), (3, 2)]


def test_too_many_codes_are_an_error(spark):
    with pytest.raises(ValueError):
        frame.distinct_codes(spark.range(20), "id", limit=10)


def test_sum_of_nothing_and_null_keys(spark, as_rows):
    df = spark.createDataFrame([("a", None), (None, 2.0), ("b", 1.0)], "k string, v double")
    assert as_rows(aggs.sum_by(df, ["k"], F.col("v"), "s")) == [("a", 0.0), ("b", 1.0)]
    assert len(aggs.sum_by(df, ["k"], F.col("v"), "s", keep_null_keys=True).collect()) == 3


def test_confusion_without_positives(spark):
    df = spark.createDataFrame([("g", 0, 0), ("g", 0, 1), ("h", 1, 1)], "g string, y int, p int")
    got = {r["g"]: r for r in aggs.confusion(df, F.col("y"), F.col("p"), ["g"]).collect()}
    assert got["g"]["fnr"] is None and got["g"]["fpr"] == 0.5 and got["g"]["accuracy"] == 0.5
    assert got["h"]["tpr"] == 1.0 and got["h"]["tnr"] is None


def test_first_match_wins_in_lookup(spark, as_rows):
    df = spark.createDataFrame([(1, "uk"), (2, "xx"), (3, None)], "id int, c string")
    dim = spark.createDataFrame([("uk", "Britain", 2), ("uk", "United Kingdom", 1)], "k string, v string, ord int")
    assert as_rows(joins.lookup_or_self(df, "c", dim, "k", "v", ["ord"])) == [(1, "United Kingdom"), (2, "xx"), (3, None)]
    assert as_rows(joins.lookup_inner(df, "c", dim, "k", "v", ["ord"], "n"), "id", "n") == [(1, "United Kingdom")]


def test_suffixes(spark):
    a = spark.createDataFrame([(1, "x")], "k int, type string")
    b = spark.createDataFrame([(1, "y")], "k int, type string")
    assert joins.join_suffixed(a, b, ["k"]).columns == ["k", "type_x", "type_y"]


def test_holidays(spark, as_rows):
    rows = [
        (1, "Holiday", "National", "Country", False), (2, "Holiday", "Local", "Quito", False), (3, "Holiday", "Local", "Cuenca", False),
        (4, "Holiday", "Regional", "Pichincha", False), (5, "Holiday", "National", "Country", True), (6, "Work Day", "National", "Country", False),
        (7, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, day_type string, locale string, locale_name string, transferred boolean")
    flag = features.holiday_flag(*[F.col(c) for c in ("day_type", "locale", "locale_name", "transferred")], F.lit("Quito"), F.lit("Pichincha"))
    out = df.withColumn("h", flag).withColumn("s", features.holiday_scope(F.col("h"), F.col("locale")))
    assert [r[0] for r in as_rows(out.where("h"), "id")] == [1, 2, 4]
    assert dict(as_rows(out, "id", "s"))[3] == "No Holidays"


def test_sales_base_multiplies_and_fills(spark, as_rows):
    sales = spark.createDataFrame([(1, "2017-08-14", 1, 5.0), (2, "2017-08-15", 1, 6.0)], "id int, date string, store_nbr int, sales double")
    rest = spark.createDataFrame([(3, "2017-08-16", 1)], "id int, date string, store_nbr int")
    prices = spark.createDataFrame([("2017-08-15", 47.0)], "date string, dcoilwtico double")
    stores = spark.createDataFrame([(1, "Quito", "Pichincha", "D")], "store_nbr int, city string, state string, type string")
    days = [("2017-08-15", "Holiday", "Local", "Riobamba", "x", False), ("2017-08-15", "Event", "National", "Country", "y", False)]
    holidays = spark.createDataFrame(days, "date string, type string, locale string, locale_name string, description string, transferred boolean")
    out = features.sales_base(sales, rest, prices, stores, holidays)
    assert as_rows(out, "id", "dcoilwtico", "day_type", "sales") == [
        (1, 47.0, "Work Day", 5.0), (2, 47.0, "Event", 6.0), (2, 47.0, "Holiday", 6.0), (3, None, "Work Day", None)
    ]


def test_person_profile_and_two_statuses(spark, as_rows):
    charges = spark.createDataFrame(
        [(1, "(F1)", 2, -29, "2013-05-01"), (1, "(M1)", 1, 10, "2012-05-01"), (1, "(F6)", 9, -30, "2000-01-01"), (2, "(0)", 1, 5, "2013-01-01")],
        "person_id long, charge_degree string, charge_number int, days_since_screening int, date_charge_filed string",
    )
    people = spark.createDataFrame([(1, "1990-05-02"), (2, "2014-01-01")], "id long, dob string")
    profiles = features.person_profile(charges, people)
    assert as_rows(profiles, "id", "highest_degree_charged", "count_deg_5", "count_deg_2", "max_charge_incid", "ear_charge_age") == [
        (1, 5, 1, 1, 2, 21), (2, 0, 0, 0, 1, -1)
    ]
    scores = spark.createDataFrame([(1, 1, 30.0, None), (2, 1, 0.0, "Low")], "id long, is_recid int, days_b_screening_arrest double, score_text string")
    status = spark.createDataFrame([(1, "Single"), (1, "Married"), (1, "Single"), (2, "Single")], "person_id long, marital_status string")
    base = features.base_table(profiles, scores, status, ["id", "marital_status", "total_prior_charges"])
    assert as_rows(base) == [(1, "Married", 2), (1, "Single", 2)]


def test_pay_day_and_periods(spark):
    days = ["2016-02-29", "2016-02-28", "2015-08-15", "2016-04-16", "2016-07-14", "2016-07-15"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = [tuple(r) for r in df.select(dates.pay_day(F.col("d")), dates.in_period(F.col("d"), "2016-04-16")).collect()]
    assert got == [(True, False), (False, False), (True, False), (False, True), (False, True), (True, False)]


def test_csv_null_tokens(spark, as_rows):
    path = new_folder(spark, "csv")
    spark.createDataFrame([("1", "N/A"), ("2", "x"), ("oops", "")], "a string, b string").write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("a int, b string")
    assert as_rows(files.read_csv(spark, path, schema)) == [(None, None), (1, None), (2, "x")]


def test_append_new_twice(spark, as_rows):
    path = new_folder(spark, "new")
    a = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("m", 1, "m")], "key string, ord int, v string")
    tables.append_new(a, path, "key", ["ord"])
    tables.append_new(a.withColumn("v", F.lit("again")), path, "key", ["ord"])
    assert as_rows(spark.read.parquet(path), "key", "v") == [("k", "early"), ("m", "m")]


def test_load_database_and_table(spark):
    spark.range(3).createOrReplaceTempView("three_rows")
    assert files.load_database(spark)["three_rows"].count() == 3
    assert tables.read_table(spark, "three_rows", ["id"]).columns == ["id"]


HTML = """<html><script>var t="</div>";</script><div class="a b">x<div class="b">in<p>ner &amp; on</div></div><div id="b">last</div>"""


@pytest.mark.parametrize(
    "rule, want",
    [
        (("div", "class", "b", 0), "xinner & on"), (("div", "class", "b", 1), "inner & on"), (("div", None, None, 2), "last"),
        (("div", "class", "b", 2), None), (("script", None, None, 0), 'var t="</div>";'), (("p", None, None, 0), "ner & on"),
        (("div", "class", "a b", 0), "xinner & on"),
    ],
)
def test_nested_elements(rule, want):
    assert pages.nth_element_text(HTML, *rule) == want


def test_hosts(spark):
    urls = ["https://a.example.com/x?y", "http://u:p@h.example.org:81/", "no address"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(pages.host_of(F.col("u"))).collect()] == ["a.example.com", "h.example.org:81", None]


def test_seconds_with_bad_text(spark):
    df = spark.createDataFrame([("1.500s",), ("abc",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(text.seconds(F.col("s"))).collect()] == [1.5, None, None, None]


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in ("Germans", "Swiss", "Countries", "Classes", "Chinese")], "w string")
    assert [r[0] for r in df.select(text.stem_place(F.col("w"))).collect()] == ["german", "swiss", "countri", "class", "chinese"]


def test_rules_are_whole(spark):
    assert len(IS_A_RULES) == 47
    line = "animals NP__ such as NP__ live"
    df = spark.createDataFrame([(line,), ("NP__ and other NP__",), ("nothing",)], "s string")
    assert [r[0] for r in df.select(joins.first_rule(F.col("s"), IS_A_RULES)).collect()] == ["first", "last", None]


def test_files_have_stems(spark, as_rows):
    df = spark.createDataFrame([("/a/b/episode-1.json",), ("x.tar.gz",), ("plain",)], "p string")
    assert [r[0] for r in df.select(files.file_stem(F.col("p"))).collect()] == ["episode-1", "x.tar", "plain"]
