"""Queries on columns, filters, recoding, sorting and stacking."""

from functools import reduce

from pyspark.sql import functions as F

from tallyworks.operators import aggs, frame, joins
from tallyworks.plans.registry import query


def labelled(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


LABELLED = "(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query("p01_select", "SELECT o_orderkey, o_totalprice FROM orders")
def p01(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("p02_drop", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def p02(t):
    return t.customer.drop("c_name", "c_acctbal")


@query("p03_rename", "SELECT s_suppkey AS supplier_id, s_name AS supplier, s_acctbal AS balance FROM supplier")
def p03(t):
    return t.supplier.withColumnsRenamed(
        {"s_suppkey": "supplier_id", "s_name": "supplier", "s_acctbal": "balance"}
    ).drop("s_nationkey")


@query(
    "p04_join_suffixes",
    """SELECT c_nationkey AS nationkey, c_name AS name_x, c_acctbal AS acctbal_x, s_name AS name_y, s_acctbal AS acctbal_y
FROM customer JOIN (SELECT s_nationkey, min(s_name) AS s_name, max(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1)
ON c_nationkey = s_nationkey""",
)
def p04(t):
    left = t.customer.select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal")
    )
    right = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.min("s_name").alias("name"), F.max("s_acctbal").alias("acctbal")
    )
    return joins.join_suffixed(left, right, ["nationkey"])


@query(
    "p05_cast",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_custkey AS VARCHAR) AS o_custkey,
TRY_CAST(o_orderstatus AS DOUBLE) AS o_orderstatus FROM orders""",
)
def p05(t):
    cols = t.orders.select("o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus")
    return frame.cast_columns(cols, {"o_orderdate": "date", "o_custkey": "string", "o_orderstatus": "double"})


@query(
    "p06_columns_by_type",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
)
def p06(t):
    return t.lineitem.select(*frame.columns_of(t.lineitem, exclude=["string", "date"]))


@query(
    "p07_filter",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_quantity > 45 AND l_discount <> 0.05) OR l_returnflag = 'R' AND l_tax >= 0.07""",
)
def p07(t):
    c = F.col
    keep = ((c("l_quantity") > 45) & (c("l_discount") != 0.05)) | ((c("l_returnflag") == "R") & (c("l_tax") >= 0.07))
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber")


@query("p08_null_filter", f"SELECT doc_id, lang FROM {LABELLED} WHERE quality IS NULL AND toxic IS NULL")
def p08(t):
    gone = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in ("quality", "toxic")])
    return labelled(t).where(gone).select("doc_id", "lang")


@query(
    "p09_between",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000",
)
def p09(t):
    return t.orders.where(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@query("p10_not_equal_keep_null", f"SELECT doc_id FROM {LABELLED} WHERE quality IS DISTINCT FROM 1")
def p10(t):
    return labelled(t).where(frame.not_equal_keep_null(F.col("quality"), 1)).select("doc_id")


@query(
    "p11_constant_column",
    "SELECT p_partkey, 'catalogue' AS origin, CAST(NULL AS DOUBLE) AS sales FROM part",
)
def p11(t):
    return t.part.select("p_partkey").withColumns(
        {"origin": F.lit("catalogue"), "sales": F.lit(None).cast("double")}
    )


@query(
    "p12_if_else",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 200000 THEN 'middle' ELSE 'low' END AS band,
coalesce(o_orderstatus = 'F', false) AS finished FROM orders""",
)
def p12(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(price > 400000, "high").when(price > 200000, "middle").otherwise("low").alias("band"),
        frame.same(F.col("o_orderstatus"), F.lit("F")).alias("finished"),
    )


@query(
    "p13_bins",
    """SELECT event_id, CASE WHEN value IS NULL THEN '0' WHEN value <= 5 THEN '<5' WHEN value <= 10 THEN '5-10'
WHEN value <= 20 THEN '10-20' ELSE '>20' END AS band FROM events""",
)
def p13(t):
    return t.events.select("event_id", frame.bin_by(F.col("value"), [5, 10, 20], ["<5", "5-10", "10-20", ">20"]).alias("band"))


PRIORITY = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("p14_recode", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders")
def p14(t):
    return t.orders.select("o_orderkey", frame.recode(F.col("o_orderpriority"), PRIORITY, keep_unknown=False).alias("priority"))


@query(
    "p15_fill_values",
    f"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM {LABELLED}",
)
def p15(t):
    return frame.fill_values(labelled(t).select("doc_id", "quality", "toxic"), {"quality": -1, "toxic": 0})


@query(
    "p16_indicators",
    """SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS INTEGER) AS flag_A, CAST(l_returnflag = 'N' AS INTEGER) AS flag_N,
CAST(l_returnflag = 'R' AS INTEGER) AS flag_R FROM lineitem""",
)
def p16(t):
    cols = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return frame.indicators(cols, "l_returnflag", prefix="flag").drop("l_returnflag")


@query(
    "p17_row_sum",
    f"SELECT doc_id, coalesce(quality, 0) + coalesce(toxic, 0) + n_chars AS total FROM {LABELLED}",
)
def p17(t):
    return labelled(t).select("doc_id", frame.row_sum([F.col("quality"), F.col("toxic"), F.col("n_chars")]).alias("total"))


@query(
    "p18_first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def p18(t):
    return frame.first_rows(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("p19_distinct_values", "SELECT DISTINCT p_brand FROM part")
def p19(t):
    return t.part.select("p_brand").distinct()


@query("p20_drop_duplicates", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def p20(t):
    return t.orders.select("o_custkey", "o_orderstatus").dropDuplicates()


@query("p21_membership", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'error', 'refund')")
def p21(t):
    return t.events.where(F.col("event_type").isin("click", "error", "refund")).select("event_id", "event_type")


@query("p22_row_key", "SELECT doc_id + 1461 AS id, n_chars FROM documents")
def p22(t):
    return t.documents.select((F.col("doc_id") + 1461).alias("id"), "n_chars")


@query(
    "p23_profile",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{k}' AS type, count(*) AS rows, count({c}) AS non_null FROM {LABELLED}"
        for i, (c, k) in enumerate(
            [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]
        )
    ),
)
def p23(t):
    return frame.profile(labelled(t))


@query("o01_sort", "SELECT n_name, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY total")
def o01(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(F.sum("c_acctbal"), 2).alias("total")).orderBy("total", "n_name")


@query("o02_order_by_list", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def o02(t):
    return frame.order_by_list(aggs.count_by(t.events, ["event_type"]), "event_type", ["view", "click", "signup", "purchase", "error"])


@query("o03_sorted_codes", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def o03(t):
    return t.orders.select("o_orderpriority").distinct().orderBy("o_orderpriority")


@query(
    "u01_stack",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS sales FROM orders""",
)
def u01(t):
    cols = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("sales"), "o_orderstatus")
    finished = cols.where("o_orderstatus = 'F'").drop("o_orderstatus")
    rest = cols.where("o_orderstatus <> 'F'").drop("o_orderstatus", "sales")
    return frame.stack(finished, rest)


@query(
    "u02_array_set_ops",
    """SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(w), lambda x: NOT list_contains(['the', 'of', 'la', 'de'], x))), ' ') AS others,
array_to_string(list_sort(list_filter(list_distinct(w), lambda x: list_contains(['the', 'of', 'la', 'de'], x))), ' ') AS common
FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM documents)""",
)
def u02(t):
    listed = F.array(*[F.lit(w) for w in ("the", "of", "la", "de")])
    w = t.documents.select("doc_id", F.split(F.lower("text"), r"\s+").alias("w"))
    others = F.filter(F.array_except("w", listed), lambda x: x != "")
    return w.select(
        "doc_id",
        F.array_join(F.array_sort(others), " ").alias("others"),
        F.array_join(F.array_sort(F.array_intersect("w", listed)), " ").alias("common"),
    )


@query("u03_distinct_items", "SELECT DISTINCT user_id, event_type FROM events")
def u03(t):
    return t.events.select("user_id", "event_type").distinct()


@query(
    "j01_left_lookup",
    """SELECT l_orderkey, l_linenumber, p_brand FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey""",
)
def j01(t):
    small = t.part.where("p_size <= 25").select("p_partkey", "p_brand")
    return t.lineitem.join(small, F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "l_linenumber", "p_brand")


@query("j02_multiplying_join", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def j02(t):
    bought = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.multiplying_left_join(t.customer.select("c_custkey"), bought, ["c_custkey"])


@query(
    "j02_multiplying_join_with_misses",
    "SELECT p_partkey, l_orderkey FROM part LEFT JOIN lineitem ON p_partkey = 2 * l_partkey",
)
def j02_misses(t):
    # odd keys have no partner
    sold = t.lineitem.select((2 * F.col("l_partkey")).alias("p_partkey"), "l_orderkey")
    return joins.multiplying_left_join(t.part.select("p_partkey"), sold, ["p_partkey"])


@query("j02_fanout_report", "SELECT o_custkey, count(*) AS factor FROM orders GROUP BY 1 HAVING count(*) > 1")
def j02_report(t):
    return joins.fanout(t.orders, ["o_custkey"])


@query("j03_left_join", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j03(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")


@query("j04_inner_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def j04(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@query("j05_anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j05(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")


@query("j06_semi_join", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j06(t):
    return t.documents.join(t.labels, "doc_id", "left_semi").select("doc_id")


@query("j07_align", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def j07(t):
    return joins.align(
        [t.customer.select("c_custkey", "c_name"), t.customer.select("c_custkey", "c_acctbal"), t.customer.select("c_custkey", "c_mktsegment")],
        ["c_custkey"],
    )


def _odd_nations(t):
    odd = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("k"), "n_name")
    again = odd.withColumn("n_name", F.concat(F.lit("late "), "n_name"))
    return odd.withColumn("ord", F.lit(1)).unionByName(again.withColumn("ord", F.lit(2)))


def _nation_codes(t):
    return t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("code"))


@query(
    "j08_reattach_columns",
    "SELECT doc_id, lang, source, quality, CAST(n_chars > 2000 AS INTEGER) AS pred FROM documents JOIN labels USING (doc_id)",
)
def j08(t):
    """Predictions from the features alone, joined to the columns that the model did not see."""
    answered = t.documents.join(t.labels, "doc_id", "left_semi").select("doc_id", (F.col("n_chars") > 2000).cast("int").alias("pred"))
    held_out = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id", "quality"), "doc_id")
    return joins.align([held_out, answered], ["doc_id"])


@query(
    "j09_lookup_or_self",
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS place FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON c_nationkey = n_nationkey""",
)
def j09(t):
    return joins.lookup_or_self(_nation_codes(t), "code", _odd_nations(t), "k", "n_name", ["ord"], "place").drop("code")


@query(
    "j10_lookup_inner",
    "SELECT c_custkey, n_name AS place FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0",
)
def j10(t):
    return joins.lookup_inner(_nation_codes(t), "code", _odd_nations(t), "k", "n_name", ["ord"], "place").drop("code")


@query(
    "j11_neighbour_pairs",
    """SELECT * FROM (SELECT s_nationkey, s_suppkey AS right_item, lag(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS left_item
FROM supplier) WHERE left_item IS NOT NULL""",
)
def j11(t):
    return joins.neighbour_pairs(t.supplier.select("s_nationkey", "s_suppkey"), ["s_nationkey"], ["s_suppkey"], "s_suppkey")


@query(
    "j11_pair_count",
    """SELECT a.s_nationkey, count(DISTINCT a.s_suppkey) AS items, count(b.s_suppkey) AS pairs FROM supplier a LEFT JOIN supplier b
ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey GROUP BY 1""",
)
def j11_count(t):
    return joins.pair_count(t.supplier, ["s_nationkey"])


_WANTED = """SELECT DISTINCT least(p_brand, 'Brand#' || (CAST(substr(p_brand, 7) AS INTEGER) % 25 + 1)) AS left_item,
  greatest(p_brand, 'Brand#' || (CAST(substr(p_brand, 7) AS INTEGER) % 25 + 1)) AS right_item FROM part"""


@query(
    "j11_listed_pairs",
    f"""WITH wanted AS ({_WANTED}), seen AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT a.l_orderkey, left_item, right_item FROM wanted JOIN seen a ON a.p_brand = left_item
JOIN seen b ON b.p_brand = right_item AND b.l_orderkey = a.l_orderkey""",
)
def j11_listed(t):
    follower = F.concat(F.lit("Brand#"), (F.substring("p_brand", 7, 9).cast("int") % 25 + 1).cast("string"))
    wanted = t.part.select(
        F.least("p_brand", follower).alias("left_item"), F.greatest("p_brand", follower).alias("right_item")
    ).distinct()
    members = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")
    return joins.listed_pairs(members, "l_orderkey", "p_brand", wanted)


RULES = [
    ("the \\w+ of ", "first"),
    (" of the ", "last"),
    ("^La |^Le ", "first"),
    ("[0-9]{3}", "last"),
    (" (and|et|und|y) ", "first"),
]


@query(
    "j12_first_rule",
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{d}'" for p, d in RULES)
    + " END AS direction FROM documents",
)
def j12(t):
    return t.documents.select("doc_id", joins.first_rule(F.col("text"), RULES).alias("direction"))


@query(
    "j13_value_grid",
    "SELECT c_custkey, CAST(g AS DOUBLE) AS rate, round(c_acctbal * CAST(g AS DOUBLE), 4) AS amount FROM customer, (VALUES (0.5), (1.0), (1.5)) AS v(g)",
)
def j13(t):
    rows = joins.with_grid(t.customer.select("c_custkey", "c_acctbal"), "rate", [0.5, 1.0, 1.5])
    return rows.select("c_custkey", F.col("rate"), F.round(F.col("c_acctbal") * F.col("rate"), 4).alias("amount"))
