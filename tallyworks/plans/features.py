"""Queries on features of dated sales and case histories."""

from pyspark.sql import functions as F

from tallyworks.functions import dates
from tallyworks.operators import features
from tallyworks.operators.aggs import sum_by
from tallyworks.operators.frame import expect_empty
from tallyworks.plans.registry import query
from tallyworks.plans.summaries import revenue


def _calendar(t):
    """Customers as stores; the priority of an order as the kind of its day."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    stores = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey"), F.col("n_name").alias("city"), F.col("r_name").alias("state")
    )
    kind = F.substring("o_orderpriority", 1, 1)
    days = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(kind == "5", "Work Day").otherwise("Holiday").alias("day_type"),
        F.when(kind == "1", "National").when(kind == "2", "Local").when(kind == "3", "Regional").alias("locale"),
        F.when(kind == "2", F.concat(F.lit("NATION_"), F.col("o_orderkey") % 5))
        .when(kind == "3", F.lit("ASIA")).alias("locale_name"),
        (F.col("o_orderstatus") == "P").alias("transferred"),
    )
    rows = days.join(stores, "c_custkey")
    args = [F.col(c) for c in ("day_type", "locale", "locale_name", "transferred", "city", "state")]
    return rows.withColumn("holiday", features.holiday_flag(*args))


CALENDAR = """(SELECT o_orderkey, c_custkey, day, locale, coalesce(NOT transferred AND day_type = 'Holiday' AND (locale = 'National' OR (locale = 'Local' AND city = locale_name)
 OR (locale = 'Regional' AND state = locale_name)), false) AS holiday, state, city FROM (
SELECT o_orderkey, o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderpriority LIKE '5%' THEN 'Work Day' ELSE 'Holiday' END AS day_type,
CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'National' WHEN '2' THEN 'Local' WHEN '3' THEN 'Regional' END AS locale,
CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN 'NATION_' || (o_orderkey % 5) WHEN '3' THEN 'ASIA' END AS locale_name,
o_orderstatus = 'P' AS transferred, n_name AS city, r_name AS state
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey))"""


@query("d01_holiday_flag", f"SELECT o_orderkey, holiday FROM {CALENDAR}")
def d01(t):
    return _calendar(t).select("o_orderkey", "holiday")


@query("d02_holiday_scope", f"SELECT o_orderkey, CASE WHEN holiday THEN locale ELSE 'No Holidays' END AS scope FROM {CALENDAR}")
def d02(t):
    return _calendar(t).select("o_orderkey", features.holiday_scope(F.col("holiday"), F.col("locale")).alias("scope"))


_PAY_DAY = "(day(o_orderdate) = 15 OR CAST(o_orderdate AS DATE) = last_day(CAST(o_orderdate AS DATE)))"


@query("d03_pay_day", f"SELECT o_orderkey, {_PAY_DAY} AS pay_day FROM orders")
def d03(t):
    return t.orders.select("o_orderkey", dates.pay_day(F.col("o_orderdate")).alias("pay_day"))


@query(
    "d04_in_period",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 89 AS during FROM orders",
)
def d04(t):
    return t.orders.select("o_orderkey", dates.in_period(F.col("o_orderdate"), "1996-04-16").alias("during"))


@query(
    "d05_proximity",
    f"""SELECT o_orderkey, CASE WHEN NOT day BETWEEN DATE '1996-04-16' AND DATE '1996-04-16' + 89 THEN 0 WHEN state = 'ASIA' THEN 2
WHEN state IN ('EUROPE', 'AFRICA') THEN 1 ELSE 0 END AS closeness FROM {CALENDAR}""",
)
def d05(t):
    near = features.proximity(
        F.col("day"), F.col("state"), "1996-04-16", centre=["ASIA"], neighbours=["EUROPE", "AFRICA"]
    )
    return _calendar(t).select("o_orderkey", near.alias("closeness"))


@query(
    "d06_first_holiday",
    f"""WITH c AS {CALENDAR}, d AS (SELECT day, bool_or(holiday) AS h FROM c GROUP BY 1),
s AS (SELECT day, h AND NOT coalesce(lag(h) OVER (ORDER BY day), false) AS first_any FROM d)
SELECT o_orderkey, first_any, holiday AND first_any AS first_here FROM c JOIN s USING (day)""",
)
def d06(t):
    return features.first_holiday(_calendar(t), "holiday", "day").select("o_orderkey", "first_any", "first_here")


@query(
    "d06_first_error_day",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS h FROM events GROUP BY 1, 2),
s AS (SELECT user_id, day, h AND NOT coalesce(lag(h) OVER (PARTITION BY user_id ORDER BY day), false) AS first_any FROM d)
SELECT event_id, first_any, event_type = 'error' AND first_any AS first_here FROM events e JOIN s ON s.user_id = e.user_id AND s.day = CAST(ts AS DATE)""",
)
def d06_users(t):
    rows = t.events.select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day"), (F.col("event_type") == "error").alias("error")
    )
    return features.first_holiday(rows, "error", "day", ["user_id"]).select("event_id", "first_any", "first_here")


_SEVERITY = {"A": 0, "N": 2, "R": 5}


def _profiles(t):
    """Line items as charges of the customer who ordered them, customers as people."""
    charges = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person_id"),
        F.col("l_returnflag").alias("charge_degree"),
        F.col("l_linenumber").alias("charge_number"),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1996-01-01").cast("date")).alias("days_since_screening"),
        F.col("l_shipdate").cast("date").alias("date_charge_filed"),
    )
    people = t.customer.select(
        F.col("c_custkey").alias("id"), F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")).alias("dob")
    )
    return features.person_profile(charges, people, _SEVERITY)


PROFILES = """(SELECT o_custkey AS id, max(s) AS highest_degree_charged, count(*) FILTER (WHERE s = 0) AS count_deg_0, count(*) FILTER (WHERE s = 2) AS count_deg_2,
count(*) FILTER (WHERE s = 5) AS count_deg_5, max(l_linenumber) AS max_charge_incid, min(age) AS ear_charge_age FROM (
SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 WHEN 'R' THEN 5 END AS s,
CAST(floor((CAST(l_shipdate AS DATE) - (DATE '1950-01-01' + CAST(o_custkey % 9000 AS INTEGER))) / 365.25) AS BIGINT) AS age
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) - DATE '1996-01-01' > -30) GROUP BY 1)"""


@query("d07_person_profile", f"SELECT * FROM {PROFILES}")
def d07(t):
    return _profiles(t)


@query(
    "d08_base_table",
    f"""SELECT p.id, marital_status, two_year_recid, highest_degree_charged, count_deg_0 + count_deg_2 + count_deg_5 AS total_prior_charges
FROM {PROFILES} p JOIN customer ON id = c_custkey JOIN (SELECT DISTINCT o_custkey, o_orderstatus AS marital_status FROM orders) o ON o.o_custkey = id,
LATERAL (SELECT CAST(c_acctbal > 4000 AS INTEGER) AS two_year_recid)
WHERE highest_degree_charged <> 0 AND c_nationkey <> 3 AND CAST(c_acctbal / 100 AS INTEGER) BETWEEN -30 AND 30
AND nullif(c_mktsegment, 'BUILDING') IS DISTINCT FROM 'MACHINERY'""",
)
def d08(t):
    c = F.col
    segment = F.when(c("c_mktsegment") == "MACHINERY", "N/A").when(c("c_mktsegment") != "BUILDING", c("c_mktsegment"))
    scores = t.customer.select(
        c("c_custkey").alias("id"),
        F.when(c("c_nationkey") == 3, -1).otherwise(1).alias("is_recid"),
        F.round(c("c_acctbal") / 100).cast("int").alias("days_b_screening_arrest"),
        segment.alias("score_text"),
        (c("c_acctbal") > 4000).cast("int").alias("two_year_recid"),
    )
    statuses = t.orders.select(c("o_custkey").alias("person_id"), c("o_orderstatus").alias("marital_status"))
    columns = ["id", "marital_status", "two_year_recid", "highest_degree_charged", "total_prior_charges"]
    return features.base_table(_profiles(t), scores, statuses, columns)


@query("d09_expect_empty", "SELECT count(*) AS rows, count(*) = 0 AS ok FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL")
def d09(t):
    orphans = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    return expect_empty(orphans)


@query(
    "d10_sales_by_place",
    f"""SELECT n_name, {_PAY_DAY} AS pay_day, count(*) AS lines, count(p_brand) AS known_parts, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sales
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def d10(t):
    """Flagship: the star join of the sales tables, sales by place on pay days and off."""
    c = F.col
    small = t.part.where("p_size <= 25").select("p_partkey", "p_brand")
    wide = (
        t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"), "left")
        .join(small, c("l_partkey") == c("p_partkey"), "left")
        .join(t.customer, c("o_custkey") == c("c_custkey"), "left")
        .join(t.nation, c("c_nationkey") == c("n_nationkey"), "left")
        .withColumn("pay_day", dates.pay_day(c("o_orderdate")))
    )
    return wide.groupBy("n_name", "pay_day").agg(
        F.count(F.lit(1)).alias("lines"), F.count("p_brand").alias("known_parts"), F.round(F.sum(revenue()), 2).alias("sales")
    )


@query(
    "d10_sales_by_priority",
    """SELECT o_orderpriority, round(sum(o_totalprice), 2) AS sales FROM orders GROUP BY 1""",
)
def d10_priority(t):
    sold = sum_by(t.orders, ["o_orderpriority"], F.col("o_totalprice"), "sales")
    return sold.withColumn("sales", F.round("sales", 2))


def _sales_base(t):
    """Orders as sales rows of one store per nation, error events as oil prices by month day."""
    c = F.col
    fact = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select(
        c("o_orderkey").alias("id"),
        c("o_orderdate").cast("date").alias("date"),
        c("c_nationkey").alias("store_nbr"),
        c("o_totalprice").alias("sales"),
    )
    labelled, rest = fact.where("date < DATE'1998-01-01'"), fact.where("date >= DATE'1998-01-01'").drop("sales")
    prices = (
        t.lineitem.groupBy(c("l_shipdate").cast("date").alias("date"))
        .agg(F.max("l_extendedprice").alias("dcoilwtico"))
    )
    stores = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select(
        c("n_nationkey").alias("store_nbr"), c("n_name").alias("city"), c("r_name").alias("state"), F.lit("A").alias("type")
    )
    holidays = (
        t.orders.groupBy(c("o_orderdate").cast("date").alias("date"))
        .agg(F.max("o_orderkey").alias("key"), F.max("o_orderpriority").alias("description"), F.count(F.lit(1)).alias("n"))
        .where("n % 5 = 0")
        .select(
            "date",
            F.lit("Holiday").alias("type"),
            F.lit("Local").alias("locale"),
            F.concat(F.lit("NATION_"), (c("key") % 25).cast("string")).alias("locale_name"),
            "description",
            F.lit(False).alias("transferred"),
        )
    )
    return features.sales_base(labelled, rest, prices, stores, holidays)


@query(
    "d10_sales_base",
    """WITH f AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date, c_nationkey AS store_nbr,
 CASE WHEN o_orderdate < DATE '1998-01-01' THEN o_totalprice END AS sales FROM orders JOIN customer ON o_custkey = c_custkey),
p AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price FROM lineitem GROUP BY 1),
g AS (SELECT date, first_value(price IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS oil
 FROM (SELECT DISTINCT date FROM f) LEFT JOIN p USING (date)),
h AS (SELECT CAST(o_orderdate AS DATE) AS date, 'NATION_' || (max(o_orderkey) % 25) AS locale_name, max(o_orderpriority) AS description FROM orders GROUP BY 1 HAVING count(*) % 5 = 0)
SELECT id, date, sales, oil, n_name AS city, CASE WHEN h.date IS NULL THEN 'Work Day' ELSE 'Holiday' END AS day_type,
coalesce(locale_name, 'No Holiday') AS locale_name, coalesce(description, 'No Holiday') AS description, false AS transferred
FROM f JOIN g USING (date) JOIN nation ON store_nbr = n_nationkey LEFT JOIN h USING (date)""",
)
def d10_base(t):
    return _sales_base(t).select(
        "id", "date", "sales", F.col("dcoilwtico").alias("oil"), "city", "day_type", "locale_name", "description", "transferred"
    )
