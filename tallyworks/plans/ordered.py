"""Queries on ordered columns within groups."""

from pyspark.sql import functions as F

from tallyworks.functions.text import words
from tallyworks.operators import windows
from tallyworks.operators.aggs import any_by
from tallyworks.plans.registry import query

_ORDER = ["ts", "event_id"]
_W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


def _events(t):
    return t.events.select("event_id", "ts", "user_id", "event_type", "value")


def _steady(mean):
    """The mean of two-digit values from their exact sum, free of the order of additions."""
    return F.try_divide(F.round(mean * F.col("seen"), 2), F.col("seen")).alias("mean_so_far")


@query("w01_previous", f"SELECT event_id, lag(event_type) {_W} AS before FROM events")
def w01(t):
    return windows.previous(_events(t), ["user_id"], _ORDER, "event_type", "before").select("event_id", "before")


_FLAG = f"CASE WHEN lag(event_type) {_W} IS NULL OR lag(event_type) {_W} <> event_type THEN 1 ELSE 0 END"


@query("w02_change_flag", f"SELECT event_id, {_FLAG} AS changed FROM events")
def w02(t):
    return windows.change_flag(_events(t), ["user_id"], _ORDER, "event_type").select("event_id", "changed")


@query(
    "w03_runs",
    f"""SELECT event_id, CAST(sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run
FROM (SELECT *, {_FLAG} AS f FROM events)""",
)
def w03(t):
    return windows.runs(_events(t), ["user_id"], _ORDER, "event_type").select("event_id", "run")


def user_days(t):
    days = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return any_by(days, ["user_id", "day"], F.col("event_type") == "error", "failed")


USER_DAYS = "(SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1, 2)"


@query(
    "w04_run_starts",
    f"""SELECT user_id, day, failed AND NOT coalesce(lag(failed) OVER (PARTITION BY user_id ORDER BY day), false) AS starts FROM {USER_DAYS}""",
)
def w04(t):
    return windows.run_starts(user_days(t), ["user_id"], ["day"], "failed").drop("failed")


DAILY = "(SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS value FROM events GROUP BY 1, 2)"


@query(
    "w05_running_total",
    f"SELECT event_type, day, round(sum(value) OVER (PARTITION BY event_type ORDER BY day), 2) AS total FROM {DAILY}",
)
def w05(t):
    daily = t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.sum("value").alias("value"))
    out = windows.cum_sum(daily, ["event_type"], ["day"], "value", "total")
    return out.select("event_type", "day", F.round("total", 2).alias("total"))


@query(
    "w05_running_total_no_key",
    "SELECT o_orderkey, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS total FROM orders",
)
def w05_all(t):
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    out = windows.cum_sum(rows, [], ["o_orderdate", "o_orderkey"], "o_totalprice", "total")
    return out.select("o_orderkey", F.round("total", 2).alias("total"))


@query(
    "w06_running_mean",
    """SELECT event_id, count(value) OVER w AS seen, round(sum(value) OVER w, 2) / nullif(count(value) OVER w, 0) AS mean_so_far FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def w06(t):
    out = windows.running_mean(_events(t), ["event_type"], _ORDER, "value")
    return out.select("event_id", "seen", _steady(F.col("mean_so_far")))


@query(
    "w06_mean_before",
    """SELECT event_id, count(value) OVER w AS seen, round(sum(value) OVER w, 2) / nullif(count(value) OVER w, 0) AS mean_so_far FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def w06_before(t):
    out = windows.running_mean(_events(t), ["event_type"], _ORDER, "value", inclusive=False)
    return out.select("event_id", "seen", _steady(F.col("mean_so_far")))


@query(
    "w07_fill_back",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), u AS (SELECT DISTINCT user_id FROM events),
g AS (SELECT user_id, day, (SELECT round(avg(value), 4) FROM events e WHERE e.user_id = u.user_id AND CAST(e.ts AS DATE) = day AND event_type = 'error') AS price FROM u, d)
SELECT user_id, day, first_value(price IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price FROM g""",
)
def w07(t):
    day = F.col("ts").cast("date")
    ends = t.events.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
    # the calendar is a literal list of days; each user gets it by a generator, not by a cross join
    calendar = F.explode(F.sequence(F.lit(ends["lo"]), F.lit(ends["hi"]))).alias("day")
    grid = t.events.select("user_id").distinct().select("user_id", calendar)
    known = t.events.where("event_type = 'error'").groupBy("user_id", day.alias("day")).agg(F.round(F.avg("value"), 4).alias("known"))
    rows = grid.join(known, ["user_id", "day"], "left")
    return windows.fill_back(rows, ["user_id"], ["day"], "known", "price").drop("known")


@query(
    "w08_even_parts",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(ntile(3) OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS INTEGER) AS part FROM lineitem",
)
def w08(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return windows.even_parts(rows, ["l_orderkey"], order, F.lit(3)).drop("l_suppkey", "l_extendedprice")


@query(
    "w08_even_parts_no_key",
    "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS part FROM orders",
)
def w08_all(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return windows.even_parts(rows, [], ["o_totalprice", "o_orderkey"], F.lit(7)).drop("o_totalprice")


CAPITALISED = r"^[A-ZÀ-ÖØ-Þ]"

CAPITAL_WORDS = f"""(SELECT doc_id, pos, w FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos
FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws FROM documents)) WHERE regexp_matches(w, '{CAPITALISED}'))"""


def capital_words(t):
    rows = t.documents.select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "w"))
    return rows.where(F.col("w").rlike(CAPITALISED))


@query(
    "w09_merge_adjacent",
    f"""SELECT doc_id, min(pos) AS start, trim(replace(string_agg('_' || w, '' ORDER BY pos), '_', ' ')) AS term FROM
(SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM {CAPITAL_WORDS}) GROUP BY doc_id, island""",
)
def w09(t):
    marked = capital_words(t).withColumn("w", F.concat(F.lit("_"), "w")).withColumn("pos", F.col("pos").cast("long"))
    return windows.merge_adjacent(marked, ["doc_id"], "pos", "w", "_")


@query(
    "w10_rank_scale",
    """SELECT "column", value, round(percent_rank() OVER (PARTITION BY "column" ORDER BY value), 6) AS scaled FROM (
SELECT DISTINCT 'l_quantity' AS "column", l_quantity AS value FROM lineitem UNION ALL SELECT DISTINCT 'l_extendedprice', l_extendedprice FROM lineitem)""",
)
def w10(t):
    rows = t.lineitem
    out = windows.rank_scale(rows, rows, ["l_quantity", "l_extendedprice"])
    return out.withColumn("scaled", F.round("scaled", 6))
