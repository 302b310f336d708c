"""Queries on sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions.text import one_line
from tallyworks.operators.transcripts import TRANSCRIPT_DDL, transcript_of, words_from_transcript
from tallyworks.plans.registry import query
from tallyworks.session import new_folder
from tallyworks.sources import files, pages, tables

_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


def _order_columns(t):
    return t.orders.select(*_ORDERS.names)


@query(
    "s01_csv_round_trip",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def s01(t):
    path = new_folder(t.spark, "s01")
    files.write_csv(_order_columns(t), path)
    return files.read_csv(t.spark, path, _ORDERS)


@query(
    "s01_csv_null_tokens",
    """SELECT doc_id, CASE WHEN quality IS NOT NULL THEN quality END AS quality FROM documents LEFT JOIN labels USING (doc_id)""",
)
def s01_nulls(t):
    path = new_folder(t.spark, "s01n")
    rows = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("N/A")).alias("quality")
    )
    rows.write.option("header", False).csv(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType())])
    return files.read_csv(t.spark, path, schema, header=False)


_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
).split()


@query(
    "s02_load_folder",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _TABLES),
)
def s02(t):
    loaded = files.load_folder(t.spark, t.folder)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in loaded.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("s03_json_tree", "SELECT conv_id, turn, text FROM conversations")
def s03(t):
    path = new_folder(t.spark, "s03")
    t.conversations.write.partitionBy("role").json(path)
    return files.read_json_tree(t.spark, path, T.StructType.fromDDL("conv_id long, turn long, text string"))


_WORDS_SQL = """words AS (
  SELECT conv_id, turn, role, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS word,
         generate_subscripts(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''), 1) - 1 AS pos
  FROM conversations)"""


@query(
    "s04_words_from_transcript",
    f"WITH {_WORDS_SQL} SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word, CAST(0.4 AS DOUBLE) AS duration FROM words",
)
def s04(t):
    path = new_folder(t.spark, "s04")
    t.conversations.select("conv_id", "turn", transcript_of(F.col("text"), F.col("turn")).alias("results")).write.json(path)
    schema = T.StructType.fromDDL(f"conv_id long, turn long, {TRANSCRIPT_DDL}")
    words = words_from_transcript(files.read_json_tree(t.spark, path, schema), ["conv_id", "turn"])
    return words.select("conv_id", "turn", "pos", "word", F.round("duration", 4).alias("duration"))


@query("s05_read_table", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 5000")
def s05(t):
    t.customer.createOrReplaceTempView("s05_customer")
    return tables.read_table(t.spark, "s05_customer").where("c_acctbal > 5000").select("c_custkey", "c_name")


@query(
    "s06_file_key",
    "SELECT 'events' AS file_key, count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders",
)
def s06(t):
    keyed = [files.with_file_key(df).select("file_key") for df in (t.events, t.orders)]
    return keyed[0].unionByName(keyed[1]).groupBy("file_key").agg(F.count(F.lit(1)).alias("n"))


_CLEAN = (
    "regexp_replace(html, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->', '', 'g')"
)


def _decoded(expr: str) -> str:
    for a, b in [("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "''"), ("&nbsp;?", "\u00a0"),
                 ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")]:
        expr = f"regexp_replace({expr}, '{a}', '{b}', 'g')"
    return expr


def _flat(tag: str, n: int) -> str:
    found = f"regexp_extract_all({_CLEAN}, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1)[{n + 1}]"
    return _decoded(f"regexp_replace({found}, '<[^>]*>', '', 'g')")


@query(
    "s07_flat_elements",
    f"SELECT page_id, {_flat('title', 0)} AS title, {_flat('p', 1)} AS second_p FROM pages",
)
def s07(t):
    html = F.col("html")
    return t.pages.select(
        "page_id", pages.flat_element(html, "title", 0).alias("title"), pages.flat_element(html, "p", 1).alias("second_p")
    )


def page_rules(t):
    """Rules for the hosts of the page table: heading or title by host name, spam hosts have none."""
    hosts = t.pages.select(pages.host_of(F.col("url")).alias("host")).distinct()
    ruled = hosts.where(~F.col("host").startswith("spam"))
    heading = F.length("host") % 2 == 0
    return ruled.select(
        "host",
        F.when(heading, "h1").otherwise("title").alias("tag"),
        F.lit(None).cast("string").alias("attr"),
        F.lit(None).cast("string").alias("value"),
        F.lit(0).alias("n"),
    )


HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query(
    "s07_extract_by_rule",
    f"""SELECT page_id, {HOST_SQL} AS host,
       CASE WHEN length({HOST_SQL}) % 2 = 0 THEN {_flat('h1', 0)} ELSE {_flat('title', 0)} END AS text
FROM pages WHERE {HOST_SQL} NOT LIKE 'spam%'""",
)
def s07_rules(t):
    return pages.extract_by_rule(t.pages, page_rules(t)).select("page_id", "host", "text")


@query(
    "s08_collect_pairs",
    """SELECT page_id, array_to_string(list_transform(
  list_zip(regexp_extract_all(html, '<a href="([^"]*)"', 1), regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1)),
  lambda x: x[1] || ' ' || x[2]), ' ' || chr(10) || ' ') || ' ' || chr(10) || ' ' || regexp_extract(html, '<title>([^<]*)', 1) AS pairs FROM pages""",
)
def s08(t):
    pairs = pages.collect_pairs(
        F.col("html"), '<a href="([^"]*)"', "<a [^>]*>([^<]*)</a>", "<title>([^<]*)"
    )
    return t.pages.select("page_id", pairs.alias("pairs"))


@query("s09_csv_write", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def s09(t):
    path = new_folder(t.spark, "s09")
    files.write_csv(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), path)
    schema = T.StructType.fromDDL("c_custkey long, c_mktsegment string, c_acctbal double")
    return files.read_csv(t.spark, path, schema)


@query(
    "s10_append",
    "SELECT event_type, 2 * count(*) AS n, round(2 * sum(value), 2) AS total FROM events GROUP BY 1",
)
def s10(t):
    path = new_folder(t.spark, "s10")
    for _ in range(2):
        tables.append(t.events, path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query("s11_append_new", "SELECT md5(url) AS article_id, min(page_id) AS page_id FROM pages GROUP BY 1")
def s11(t):
    path = new_folder(t.spark, "s11")
    keyed = t.pages.select(F.md5("url").alias("article_id"), "page_id")
    third = keyed.agg(F.max("page_id")).first()[0] // 3
    tables.append_new(keyed.where(F.col("page_id") <= 2 * third), path, "article_id", ["page_id"])
    tables.append_new(keyed.where(F.col("page_id") >= third), path, "article_id", ["page_id"])
    return t.spark.read.parquet(path)


@query(
    "s13_sink_schema",
    "SELECT event_id, user_id AS speaker_id, value AS sp_time FROM events",
)
def s13(t):
    rows = t.events.select("event_id", "user_id", "value", "props")
    return tables.to_sink_schema(rows, {"user_id": "speaker_id", "value": "sp_time"}, ["props"])


@query("s07_one_line_text", "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents")
def s07_one_line(t):
    return t.documents.select("doc_id", one_line(F.col("text")).alias("text"))
