"""Queries on graphs of nations, customers and orders."""

from pyspark.sql import functions as F

from tallyworks.operators import graph
from tallyworks.plans.registry import query


def trade(t):
    """Supplier nation to customer nation, one triple per line item with its return flag."""
    c = F.col
    sold = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).join(t.customer, c("o_custkey") == c("c_custkey"))
    made = sold.join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    name = lambda key: F.concat(F.lit("Nation "), c(key).cast("string"))
    return made.select(
        name("s_nationkey").alias("head"), name("c_nationkey").alias("tail"), c("l_returnflag").alias("type"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )


def synonyms(t):
    """Nations 0 to 4 are known under the name of their region as well."""
    known = t.nation.where("n_nationkey < 5").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return known.select(
        F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("synonym"), F.lower("r_name").alias("entity_id")
    )


_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "type"]

EDGES = """(SELECT head, tail, type FROM (SELECT *, row_number() OVER (PARTITION BY head, tail ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, type) AS rn FROM (
SELECT coalesce(h.entity_id, 'nation ' || s_nationkey) AS head, coalesce(k.entity_id, 'nation ' || c_nationkey) AS tail, l_returnflag AS type, l_orderkey, l_linenumber, l_partkey, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN (SELECT n_nationkey, lower(r_name) AS entity_id FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 5) h ON h.n_nationkey = s_nationkey
LEFT JOIN (SELECT n_nationkey, lower(r_name) AS entity_id FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 5) k ON k.n_nationkey = c_nationkey)) WHERE rn = 1)"""


def edges(t):
    return graph.canonical_edges(trade(t), synonyms(t), _ORDER)


@query("g01_canonical_edges", f"SELECT head, type, tail FROM {EDGES}")
def g01(t):
    return edges(t)


ORDER_EDGES = """(SELECT DISTINCT 'p' || p_brand AS head, 's' || l_suppkey AS tail FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def order_edges(t):
    """Brands point to the suppliers of their orders."""
    big = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return big.select(
        F.concat(F.lit("p"), "p_brand").alias("head"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("tail")
    ).distinct()


def all_suppliers(t):
    return t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("node"))


NODES = f"(SELECT head AS node FROM {ORDER_EDGES} UNION SELECT tail FROM {ORDER_EDGES} UNION SELECT 's' || s_suppkey FROM supplier)"


@query("g02_nodes", f"SELECT node FROM {NODES}")
def g02(t):
    return graph.nodes(order_edges(t), all_suppliers(t))


@query(
    "g03_adjacency",
    f"""SELECT 'out' AS side, head AS node, row_number() OVER (PARTITION BY head ORDER BY tail) AS position, tail AS neighbour
FROM (SELECT DISTINCT head, tail FROM {ORDER_EDGES})
UNION ALL SELECT 'in', tail, row_number() OVER (PARTITION BY tail ORDER BY head), head FROM (SELECT DISTINCT head, tail FROM {ORDER_EDGES})""",
)
def g03(t):
    e = order_edges(t)
    out = graph.adjacency(e).withColumn("side", F.lit("out"))
    return out.unionByName(graph.adjacency(e, "tail", "head").withColumn("side", F.lit("in")))


DEGREES = f"""(SELECT node, (SELECT count(*) FROM {ORDER_EDGES} WHERE tail = node) AS incoming, (SELECT count(*) FROM {ORDER_EDGES} WHERE head = node) AS outgoing FROM {NODES})"""


@query("g04_degrees", f"SELECT * FROM {DEGREES}")
def g04(t):
    e = order_edges(t)
    return graph.degrees(graph.nodes(e, all_suppliers(t)), e)


@query("g05_root_candidates", f"SELECT * FROM {DEGREES} ORDER BY incoming DESC, outgoing, node LIMIT 10")
def g05(t):
    e = order_edges(t)
    return graph.root_candidates(graph.nodes(e, all_suppliers(t)), e, 10)


@query("g06_delete_edges", f"SELECT head, tail FROM {ORDER_EDGES} WHERE NOT (tail IN (SELECT 's' || s_suppkey FROM supplier WHERE s_nationkey = 3))")
def g06(t):
    e = order_edges(t)
    small = t.supplier.where("s_nationkey = 3").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("tail"))
    return graph.delete_edges(e, e.join(small, "tail").select("head", "tail"))


@query("g07_root_at", f"SELECT head, type, tail FROM {EDGES} WHERE head <> 'nation 7'")
def g07(t):
    return graph.root_at(edges(t), "nation 7")


def places(t):
    """Customers below nations below regions below the world, and customers that point to others."""
    c = F.col
    text = lambda mark, key: F.concat(F.lit(mark), c(key).cast("string"))
    last = t.customer.agg(F.max("c_custkey")).first()[0] + 1
    other = F.concat(F.lit("c"), ((c("c_custkey") * 7 + 3) % last).cast("string"))
    out = t.customer.select(text("c", "c_custkey").alias("head"), text("n", "c_nationkey").alias("tail"))
    out = out.unionByName(t.customer.where("c_custkey % 3 = 0").select(text("c", "c_custkey").alias("head"), other.alias("tail")))
    out = out.unionByName(t.nation.select(text("n", "n_nationkey").alias("head"), text("r", "n_regionkey").alias("tail")))
    return out.unionByName(t.region.select(text("r", "r_regionkey").alias("head"), F.lit("world").alias("tail")))


PLACES = """(SELECT 'c' || c_custkey AS head, 'n' || c_nationkey AS tail FROM customer UNION ALL
SELECT 'c' || c_custkey, 'c' || ((c_custkey * 7 + 3) % (SELECT max(c_custkey) + 1 FROM customer)) FROM customer WHERE c_custkey % 3 = 0 UNION ALL
SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region)"""


@query("g08_hierarchy")
def g08(t):
    return graph.build_hierarchy(places(t), "world")


@query(
    "g08_hierarchy_of_forest",
    """SELECT 'world' AS node, CAST(NULL AS VARCHAR) AS parent, 1 AS level UNION ALL SELECT 'r' || r_regionkey, 'world', 2 FROM region
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 3 FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 4 FROM customer""",
)
def g08_forest(t):
    return graph.build_hierarchy(places(t).where("NOT (head LIKE 'c%' AND tail LIKE 'c%')"), "world")


def item_chains(t):
    """Items point to their order and to the item numbered one below, which is missing for the first of a run."""
    order = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
    item = lambda number: F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("-"), number.cast("string"))
    number = F.col("l_linenumber")
    rows = t.lineitem.select(item(number).alias("head"), order.alias("tail"))
    rows = rows.unionByName(t.lineitem.select(item(number).alias("head"), item(number - 1).alias("tail")))
    return rows.unionByName(t.lineitem.select(order.alias("head"), F.lit("all").alias("tail")))


@query(
    "g08_hierarchy_of_chains",
    """WITH i AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS k FROM lineitem),
n AS (SELECT o, k, k - row_number() OVER (PARTITION BY o ORDER BY k) AS g FROM i),
r AS (SELECT o, k, row_number() OVER (PARTITION BY o, g ORDER BY k) AS p FROM n)
SELECT 'all' AS node, CAST(NULL AS VARCHAR) AS parent, 1 AS level UNION ALL SELECT DISTINCT 'o' || o, 'all', 2 FROM i
UNION ALL SELECT 'l' || o || '-' || k, CASE WHEN p = 1 THEN 'o' || o ELSE 'l' || o || '-' || (k - 1) END, CAST(2 + p AS INTEGER) FROM r""",
)
def g08_chains(t):
    return graph.build_hierarchy(item_chains(t), "all")


@query(
    "g09_levels",
    f"""WITH RECURSIVE e AS (SELECT DISTINCT head, tail FROM {PLACES}), l AS (SELECT 'world' AS node, 1 AS level UNION
SELECT e.head, l.level + 1 FROM l JOIN e ON e.tail = l.node WHERE l.level < 12) SELECT node, min(level) AS level FROM l GROUP BY 1""",
)
def g09(t):
    return graph.levels(places(t), "world")


@query("g10_extend")
def g10(t):
    """Nations by the regions they lie in, then the trade between nations by all orders."""
    c = F.col
    text = lambda mark, key: F.concat(F.lit(mark), c(key).cast("string"))
    rows = places(t).withColumns({"type": F.lit("lies in"), "ord": F.lit(0)})
    sold = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).join(t.customer, c("o_custkey") == c("c_custkey"))
    links = sold.join(t.supplier, c("l_suppkey") == c("s_suppkey")).where("s_nationkey <> c_nationkey")
    links = links.groupBy("s_nationkey", "c_nationkey").agg(F.min("l_orderkey").alias("first"))
    later = links.select(
        text("n", "s_nationkey").alias("head"), text("n", "c_nationkey").alias("tail"), F.lit("sells to").alias("type"),
        c("first").cast("int").alias("ord"),
    )
    none = t.nation.where("false").select(F.col("n_name").alias("synonym"), F.col("n_name").alias("entity_id"))
    return graph.extend(rows, later, none, "world")[1]
