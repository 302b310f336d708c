"""Queries on scalar functions."""

from pyspark.sql import functions as F

from tallyworks.functions import dates, text
from tallyworks.operators.frame import not_equal_keep_null
from tallyworks.plans.registry import query
from tallyworks.sources.pages import host_of

WORDS = "list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')"


@query("f01_lower", "SELECT p_partkey, lower(p_type) AS v FROM part")
def f01(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("v"))


@query("f02_capitalise", "SELECT p_partkey, upper(substr(v, 1, 1)) || lower(substr(v, 2)) AS v FROM (SELECT p_partkey, p_name || p_type AS v FROM part)")
def f02(t):
    return t.part.select("p_partkey", text.capitalise(F.concat("p_name", "p_type")).alias("v"))


@query("f03_trim", "SELECT doc_id, trim(text) AS v FROM documents")
def f03(t):
    return t.documents.select("doc_id", F.trim("text").alias("v"))


@query("f04_one_line", "SELECT conv_id, turn, replace(text, chr(10), ' ') AS v FROM conversations")
def f04(t):
    return t.conversations.select("conv_id", "turn", text.one_line(F.col("text")).alias("v"))


@query(
    "f05_contains",
    """SELECT doc_id, regexp_matches(text, 'free|[0-9]{4}') AS any_of, regexp_matches(text, 'the') AND regexp_matches(text, 'ing') AS all_of
FROM (SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents)""",
)
def f05(t):
    line = t.documents.select("doc_id", text.one_line(F.col("text")).alias("text"))
    return line.select(
        "doc_id",
        F.col("text").rlike("free|[0-9]{4}").alias("any_of"),
        text.contains_all(F.col("text"), ["the", "ing"]).alias("all_of"),
    )


@query("f06_starts_with_pattern", "SELECT doc_id, regexp_matches(text, '^(?:[A-Z][a-z]+ [a-z]+|De)') AS v FROM documents")
def f06(t):
    return t.documents.select("doc_id", text.starts_with_pattern(F.col("text"), "[A-Z][a-z]+ [a-z]+|De").alias("v"))


@query(
    "f07_seconds",
    "SELECT event_id, value + 1 AS good, CAST(NULL AS DOUBLE) AS bad FROM events",
)
def f07(t):
    shown = F.concat((F.col("value") + 1).cast("string"), F.lit("s"))
    return t.events.select(
        "event_id", text.seconds(shown).alias("good"), text.seconds(F.concat("event_type", F.lit("s"))).alias("bad")
    )


@query("f08_md5", "SELECT page_id, md5(url) AS v FROM pages")
def f08(t):
    return t.pages.select("page_id", F.md5("url").alias("v"))


@query(
    "f09_host",
    "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || ':8080' AS v FROM pages",
)
def f09(t):
    ported = F.regexp_replace("url", "^([a-z]+://[^/?#]*)", "$1:8080")
    return t.pages.select("page_id", host_of(ported).alias("v"))


@query(
    "f10_file_stem",
    "SELECT page_id, regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(?:\\.[^.]*)?$', 1) AS v FROM pages",
)
def f10(t):
    from tallyworks.sources.files import file_stem

    return t.pages.select("page_id", file_stem(F.col("url")).alias("v"))


@query("f11_words", f"SELECT doc_id, len(w) AS n, array_to_string(w, ' ') AS v FROM (SELECT doc_id, {WORDS} AS w FROM documents)")
def f11(t):
    w = t.documents.select("doc_id", text.words(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", " ").alias("v"))


@query("f12_length_ceil", "SELECT doc_id, length(text) AS n, CAST(ceil(length(text) / 512.0) AS INTEGER) AS k FROM documents")
def f12(t):
    return t.documents.select("doc_id", F.length("text").cast("long").alias("n"), text.chunk_count(F.col("text"), 512).alias("k"))


@query(
    "f13_whole_years",
    """SELECT o_orderkey, CAST(floor((CAST(o_orderdate AS DATE) - DATE '1990-05-17') / 365.25) AS BIGINT) AS since,
CAST(floor((DATE '1990-05-17' - CAST(o_orderdate AS DATE)) / 365.25) AS BIGINT) AS before FROM orders""",
)
def f13(t):
    day, mark = F.col("o_orderdate").cast("date"), F.lit("1990-05-17").cast("date")
    return t.orders.select(
        "o_orderkey", dates.whole_years(day, mark).alias("since"), dates.whole_years(mark, day).alias("before")
    )


@query(
    "f14_month_days",
    "SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders",
)
def f14(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", F.dayofmonth(day).alias("day"), F.last_day(day).alias("month_end"))


@query(
    "f15_day_list",
    "SELECT o_orderkey, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 4, INTERVAL 1 DAY)) AS DATE) AS day FROM orders",
)
def f15(t):
    return t.orders.select("o_orderkey", F.explode(dates.day_list(F.col("o_orderdate"), 5)).alias("day"))


@query(
    "f16_parse_dates",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def f16(t):
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("d"))
    return written.select("o_orderkey", F.to_date("d", "dd.MM.yyyy").alias("day"))


@query("f17_round", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * 0.5 + 0.001, 2) AS v FROM lineitem")
def f17(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 0.5 + 0.001, 2).alias("v"))


@query("f18_abs", "SELECT c_custkey, abs(c_acctbal) AS v FROM customer")
def f18(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("v"))


@query(
    "f19_sqrt_ln",
    """SELECT p_partkey, round(sqrt(p_size), 6) AS root, round(ln(p_retailprice), 6) AS log,
CASE WHEN p_size = 1 THEN CAST('Infinity' AS DOUBLE) ELSE 0.0::DOUBLE END > 1e300 AS unbounded FROM part""",
)
def f19(t):
    top = F.when(F.col("p_size") == 1, F.lit(float("inf"))).otherwise(0.0)
    return t.part.select(
        "p_partkey",
        F.round(F.sqrt("p_size"), 6).alias("root"),
        F.round(F.ln("p_retailprice"), 6).alias("log"),
        (top > 1e300).alias("unbounded"),
    )


@query(
    "f20_first_available",
    "SELECT doc_id, coalesce(quality, toxic, -1) AS v FROM documents LEFT JOIN labels USING (doc_id)",
)
def f20(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", F.coalesce("quality", "toxic", F.lit(-1)).alias("v"))


@query("f21_strip_markup", "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS v FROM pages")
def f21(t):
    return t.pages.select("page_id", text.strip_markup(F.col("html")).alias("v"))


@query(
    "f22_stem_place",
    f"""SELECT doc_id, array_to_string(list_transform({WORDS}, lambda x: regexp_replace(regexp_replace(lower(x), '(ss|i)es$', '\\1'), '([^s])s$', '\\1')), ' ') AS v
FROM documents""",
)
def f22(t):
    w = t.documents.select("doc_id", text.words(F.col("text")).alias("w"))
    return w.select("doc_id", F.array_join(F.transform("w", text.stem_place), " ").alias("v"))


@query(
    "f23_mark_terms",
    "SELECT doc_id, replace(replace(text, 'the', 'NP__'), 'la.', 'NP__') AS v FROM documents",
)
def f23(t):
    terms = F.array(F.lit("the"), F.lit("la."))
    return t.documents.select("doc_id", text.mark_terms(F.col("text"), terms, "NP__").alias("v"))


@query("f24_first_position", "SELECT doc_id, CAST(instr(lower(text), 'th') AS INTEGER) AS v FROM documents")
def f24(t):
    return t.documents.select("doc_id", text.first_position(F.col("text"), F.lit("TH")).alias("v"))


SENTENCES = "list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')"


@query("f25_sentences", f"SELECT doc_id, len(s) AS n, array_to_string(s, ' | ') AS sentences FROM (SELECT doc_id, {SENTENCES} AS s FROM documents)")
def f25(t):
    s = t.documents.select("doc_id", text.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n"), F.array_join("s", " | ").alias("sentences"))


@query(
    "f26_tagged_triples",
    """SELECT p_partkey, p_brand AS head, 'made as' AS type, p_type AS tail FROM part
UNION ALL SELECT p_partkey, p_brand, 'named', p_name FROM part UNION ALL SELECT p_partkey, p_type, 'same', p_type FROM part""",
)
def f26(t):
    tagged = F.format_string(
        "<s><triplet> %s <subj> %s <obj> made as <subj> %s <obj> named <triplet> %s <subj> %s <obj> same <triplet> cut <subj> off</s>",
        "p_brand", "p_type", "p_name", "p_type", "p_type",
    )
    return t.part.select("p_partkey", F.inline(text.tagged_triples(tagged)))


def even_slice_sql(k: str, source: str) -> str:
    """Slices of list ``w`` into ``k`` parts, the longer ones first."""
    return f"""SELECT *, i + 1 AS part, array_to_string(w[i * q + least(i, r) + 1 : (i + 1) * q + least(i + 1, r)], ' ') AS content FROM
(SELECT *, len(w) // k AS q, len(w) % k AS r, unnest(range(k)) AS i FROM (SELECT *, {k} AS k FROM {source}))"""


@query(
    "f27_text_chunks",
    f"""SELECT doc_id, CAST(part AS INTEGER) AS chunk, CASE WHEN k > 1 THEN content ELSE text END AS content FROM
({even_slice_sql("greatest(CAST(ceil(length(text) / 512.0) AS BIGINT), 1)", f"(SELECT doc_id, text, {WORDS} AS w FROM documents)")})""",
)
def f27(t):
    from tallyworks.operators.transcripts import text_chunks

    return text_chunks(t.documents, ["doc_id"], "text")


@query(
    "f28_null_safe_filters",
    "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS DISTINCT FROM 0 AND (n_chars BETWEEN 200 AND 3000) AND lang IN ('en', 'fr')",
)
def f28(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    keep = not_equal_keep_null(F.col("quality"), 0) & F.col("n_chars").between(200, 3000) & F.col("lang").isin("en", "fr")
    return rows.where(keep).select("doc_id")
