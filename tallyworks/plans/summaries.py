"""Queries on group, column and table summaries."""

from pyspark.sql import functions as F

from tallyworks.functions.fixed_values import CHARGE_TOPICS
from tallyworks.operators import aggs
from tallyworks.plans.frame import LABELLED, labelled
from tallyworks.plans.registry import query

def revenue():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query(
    "a01_sum_by_brand",
    """SELECT p_brand, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def a01_brand(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return aggs.sum_by(sold, ["p_brand"], revenue(), "sales").withColumn("sales", F.round("sales", 2))


@query(
    "a01_sum_by_segment",
    """SELECT c_mktsegment, round(sum(o_totalprice), 2) AS sales FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def a01_segment(t):
    sold = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return aggs.sum_by(sold, ["c_mktsegment"], F.col("o_totalprice"), "sales").withColumn("sales", F.round("sales", 2))


@query(
    "a01_sum_null_groups",
    f"SELECT lang, CAST(coalesce(sum(quality), 0) AS BIGINT) AS good FROM {LABELLED} WHERE lang IS NOT NULL GROUP BY 1",
)
def a01_nulls(t):
    return aggs.sum_by(labelled(t), ["lang"], F.col("quality"), "good")


@query("a02_count_by", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def a02(t):
    return aggs.count_by(t.events, ["event_type"])


@query(
    "a02_count_drops_null_keys",
    f"SELECT quality, count(*) AS n FROM {LABELLED} WHERE quality IS NOT NULL GROUP BY 1",
)
def a02_nulls(t):
    return aggs.count_by(labelled(t), ["quality"])


@query("a03_two_key_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a03(t):
    return aggs.count_by(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    "a04_mean_by",
    "SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS quantity FROM lineitem GROUP BY 1, 2",
)
def a04(t):
    means = aggs.mean_by(t.lineitem, ["l_returnflag", "l_linestatus"], F.col("l_quantity"), "quantity")
    return means.withColumn("quantity", F.round("quantity", 4))


@query(
    "a05_profile_by",
    """SELECT o_custkey, max(o_totalprice) AS highest, round(sum(o_totalprice), 2) AS total, CAST(min(o_orderdate) AS DATE) AS first_day,
round(sum(o_totalprice), 2) / count(*) AS mean, count(*) AS n FROM orders GROUP BY 1""",
)
def a05(t):
    price = F.col("o_totalprice")
    return aggs.profile_by(
        t.orders,
        ["o_custkey"],
        {
            "highest": F.max(price),
            "total": F.round(F.sum(price), 2),
            "first_day": F.min("o_orderdate").cast("date"),
            "mean": F.round(F.sum(price), 2) / F.count(price),
            "n": F.count(F.lit(1)),
        },
    )


@query(
    "a06_any_by",
    "SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1, 2",
)
def a06(t):
    days = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return aggs.any_by(days, ["user_id", "day"], F.col("event_type") == "error", "failed")


@query(
    "a07_ordered_concat",
    "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS content FROM conversations GROUP BY 1",
)
def a07(t):
    return aggs.concat_by(t.conversations.select("conv_id", "turn", "text"), ["conv_id"], "text", ["turn"])


TOPICS = {"spam": "free|win|click", "numbers": "[0-9]{3,}", "articles": "(^|\\s)(the|la|der)(\\s|$)", "list": "\\|"}


@query(
    "a08_keyword_share",
    " UNION ALL ".join(
        f"""SELECT lang, count(*) AS texts, '{k}' AS topic, count(*) FILTER (WHERE regexp_matches(text, '{p}')) AS matches,
round(100.0 * count(*) FILTER (WHERE regexp_matches(text, '{p}')) / count(*), 2) AS percent FROM documents GROUP BY 1"""
        for k, p in TOPICS.items()
    ),
)
def a08(t):
    return aggs.keyword_share(t.documents, "lang", "text", TOPICS)


def _matches(pattern: str) -> str:
    if pattern.startswith("(?="):
        words = pattern[len("(?=.*") : -1].split(")(?=.*")
        return " AND ".join(f"regexp_matches(p_name || ' ' || p_type, '{w}')" for w in words)
    return f"regexp_matches(p_name || ' ' || p_type, '{pattern}')"


@query(
    "a08_charge_topics",
    " UNION ALL ".join(
        f"""SELECT p_brand, count(*) AS texts, '{k}' AS topic, count(*) FILTER (WHERE {_matches(p)}) AS matches,
round(100.0 * count(*) FILTER (WHERE {_matches(p)}) / count(*), 2) AS percent FROM part GROUP BY 1"""
        for k, p in CHARGE_TOPICS.items()
    ),
)
def a08_charges(t):
    texts = t.part.select("p_brand", F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return aggs.keyword_share(texts, "p_brand", "text", CHARGE_TOPICS)


@query("a09_value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1")
def a09(t):
    return aggs.value_counts(t.part, "p_type")


_CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "a10_nunique",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM customer" for c in _CUSTOMER),
)
def a10(t):
    return aggs.nunique(t.customer)


@query(
    "a11_null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {LABELLED}"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def a11(t):
    return aggs.null_counts(labelled(t))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a12_describe_numbers",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd, min({c}) AS min,
max({c}) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem"""
        for c in _NUMBERS
    ),
)
def a12(t):
    out = aggs.describe_numbers(t.lineitem, _NUMBERS)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "sd", "q25", "q50", "q75")})


_TEXTS = ["p_name", "p_brand", "p_type"]


@query(
    "a12_describe_texts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(k) AS BIGINT) AS n, count(*) AS distinct_values, arg_min(v, (-k, v)) AS top, max(k) AS freq
FROM (SELECT {c} AS v, count(*) AS k FROM part GROUP BY 1)"""
        for c in _TEXTS
    ),
)
def a12_texts(t):
    return aggs.describe_texts(t.part, _TEXTS)


_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM lineitem" for a in _NUMBERS for b in _NUMBERS)


@query("a13_correlations", f"SELECT a, b, round(r, 4) + 0.0 AS r FROM ({_CORR})")
def a13(t):
    return aggs.corr_matrix(t.lineitem, _NUMBERS).withColumn("r", F.round("r", 4) + 0.0)


@query(
    "a14_correlation_bands",
    f"""SELECT a, b, CASE WHEN abs(r) > 0.75 THEN 'S' WHEN abs(r) > 0.5 THEN 'M' WHEN abs(r) > 0.25 THEN 'W' ELSE 'N' END AS band FROM ({_CORR})""",
)
def a14(t):
    return aggs.corr_matrix(t.lineitem, _NUMBERS).select("a", "b", aggs.band_of(F.col("r")).alias("band"))


@query("a15_class_ratio", "SELECT count(quality) AS n, round(avg(quality), 4) AS ratio FROM labels")
def a15(t):
    return aggs.class_ratio(t.labels, "quality").withColumn("ratio", F.round("ratio", 4))


@query(
    "a16_crosstab",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS l_linestatus_F, count(*) FILTER (WHERE l_linestatus = 'O') AS l_linestatus_O
FROM lineitem GROUP BY 1""",
)
def a16(t):
    return aggs.crosstab(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O"])


def scored(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id").withColumn(
        "pred", (F.col("n_chars") > 2000).cast("int")
    )


SCORED = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, CAST(d.n_chars > 2000 AS INTEGER) AS pred
FROM documents d JOIN labels l USING (doc_id))"""


def confusion_sql(by: str, source: str = SCORED) -> str:
    rate = lambda a, b: f"round(CAST({a} AS DOUBLE) / nullif({b}, 0), 2)"
    return f"""SELECT *, {rate('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {rate('fn', 'fn + tp')} AS fnr, {rate('fp', 'fp + tn')} AS fpr,
{rate('tp', 'tp + fn')} AS tpr, {rate('tn', 'tn + fp')} AS tnr, {rate('tp', 'tp + fp')} AS ppv, {rate('tn', 'tn + fn')} AS npv
FROM (SELECT {by + ',' if by else ''} count(*) FILTER (WHERE quality = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE quality = 0 AND pred = 1) AS fp,
count(*) FILTER (WHERE quality = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE quality = 1 AND pred = 1) AS tp
FROM {source} {'GROUP BY ' + by if by else ''})"""


@query("a17_confusion", confusion_sql("lang"))
def a17(t):
    return aggs.confusion(scored(t), F.col("quality"), F.col("pred"), ["lang"])


@query(
    "a18_box_stats",
    """SELECT event_type, 'value' AS "column", round(q[1], 4) AS min, round(q[2], 4) AS q25, round(q[3], 4) AS q50, round(q[4], 4) AS q75,
round(q[5], 4) AS max, round(q[2] - 1.5 * (q[4] - q[2]), 4) AS low_fence, round(q[4] + 1.5 * (q[4] - q[2]), 4) AS high_fence
FROM (SELECT event_type, quantile_cont(value, [0, 0.25, 0.5, 0.75, 1]) AS q FROM events GROUP BY 1)""",
)
def a18(t):
    out = aggs.box_stats(t.events, ["value"], ["event_type"])
    return out.withColumns({c: F.round(c, 4) for c in ("min", "q25", "q50", "q75", "max", "low_fence", "high_fence")})


@query(
    "a19_histogram",
    """WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events)
SELECT CAST(least(floor((value - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM events, e GROUP BY 1""",
)
def a19(t):
    return aggs.histogram(t.events, "value", 20)


@query(
    "a20_first_by",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r
FROM orders) WHERE r = 1""",
)
def a20(t):
    cols = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return aggs.first_by(cols, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "a21_argmax",
    """SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r
FROM part) WHERE r = 1""",
)
def a21(t):
    return aggs.argmax_by(t.part, ["p_brand"], "p_partkey", "p_retailprice")


_TYPES = ["view", "click", "signup", "purchase", "error"]


@query(
    "a22_scores_wide",
    "SELECT user_id, "
    + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{k}'), 6) AS {k}" for k in _TYPES)
    + " FROM events GROUP BY 1",
)
def a22(t):
    wide = aggs.scores_wide(t.events, ["user_id"], "event_type", "value", _TYPES)
    return wide.withColumns({k: F.round(k, 6) for k in _TYPES})


@query(
    "a23_global_scalars",
    """SELECT round(avg(value), 4) AS mean, max(value) AS highest, round(sum(value), 2) AS total,
round(avg(value) FILTER (WHERE event_type = 'purchase') - avg(value) FILTER (WHERE event_type = 'view'), 4) AS gap FROM events""",
)
def a23(t):
    kind, value = F.col("event_type"), F.col("value")
    gap = F.avg(F.when(kind == "purchase", value)) - F.avg(F.when(kind == "view", value))
    return t.events.agg(
        F.round(F.avg(value), 4).alias("mean"),
        F.max(value).alias("highest"),
        F.round(F.sum(value), 2).alias("total"),
        F.round(gap, 4).alias("gap"),
    )
