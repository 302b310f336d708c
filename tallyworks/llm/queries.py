"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import alignment, attention_lm, crf_language, dart_minhash, decontaminate, html_template, line_spread, mixing
from tallyworks.llm import preference, robust_quality, url_filter, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- 1: WARC in seekable Zstandard

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BITS = (
    "array_to_string(list_transform(range(1, 41), lambda i: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', "
    "'1010', '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', substr(sha1(html), i, 1))]), '')"
)
_FIVE = " + ".join(f"CASE WHEN substr(bits, 5 * i + {j + 1}, 1) = '1' THEN {16 >> j} ELSE 0 END" for j in range(5))


@query(
    "op1_warc_round_trip",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    f AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first, {_BITS} AS bits FROM p)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr({_BASE32}, {_FIVE} + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first THEN first END AS refers_to
    FROM f""",
)
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written as a record and read back; the id of a record without one is empty and becomes null again."""
    read = warc.archive_round_trip(table(spark, folder, "pages"), revisit_bytes=0)
    return read.select(
        F.col("record_id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast("bigint").alias("refers_to")
    )


# --- 2: preference pairs


def _render_sql(turns: str) -> str:
    return f"coalesce(list_aggregate(list_transform({turns}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), 'string_agg', ''), '')"


def _runs_sql(turns: str) -> str:
    head, tail = "length('<|' || t.role || '|>' || chr(10))", "length(t.text || '<|end|>' || chr(10))"
    pair = f"CASE WHEN t.role = 'assistant' THEN [{head}, {tail}] ELSE [{head} + {tail}, 0] END"
    return f"array_to_string(flatten(list_transform({turns}, lambda t: {pair})), ',')"


@query(
    "op2_preference_pairs",
    f"""
    WITH g AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn) AS turns, max(turn) FILTER (WHERE role = 'assistant') AS lastr,
                      count(*) AS n FROM conversations GROUP BY conv_id),
    k AS (SELECT g.conv_id, (SELECT count(*) FROM conversations c WHERE c.conv_id = g.conv_id AND (g.lastr IS NULL OR c.turn <= g.lastr)) AS upto,
                 turns, lastr FROM g),
    c AS (SELECT conv_id, turns[1:upto] AS chosen, lastr FROM k),
    p AS (SELECT c.conv_id, c.chosen, CASE WHEN c.lastr IS NOT NULL AND o.lastr IS NOT NULL
                 THEN list_concat(c.chosen[1:len(c.chosen) - 1], [o.chosen[len(o.chosen)]]) ELSE c.chosen END AS rejected
          FROM c LEFT JOIN c o ON o.conv_id = xor(c.conv_id, 1)),
    m AS (SELECT *, CASE WHEN chosen = rejected THEN len(chosen) ELSE len(chosen) - 1 END AS same FROM p)
    SELECT conv_id, CAST(same AS BIGINT) AS prompt_turns, {_render_sql('chosen[1:same]')} AS prompt,
           {_render_sql('chosen[same + 1:]')} AS chosen, {_runs_sql('chosen[same + 1:]')} AS chosen_mask,
           {_render_sql('rejected[same + 1:]')} AS rejected, {_runs_sql('rejected[same + 1:]')} AS rejected_mask
    FROM m""",
)
def preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against its neighbour's reply; masks as text of run lengths."""
    rows = preference.preference_rows(preference.swapped_replies(table(spark, folder, "conversations")))
    runs = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return rows.select(
        F.col("conv").alias("conv_id"), "prompt_turns", "prompt", "chosen", runs("chosen_mask"), "rejected", runs("rejected_mask")
    )


# --- 3: language of words in context; held-out accuracy in tests/llm/test_language.py


def crc_part(column: str, parts: int):
    """Part of a row by CRC-32 of its id as text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


@query("op3_crf_language")
def crf_language_query(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three of four parts."""
    docs = table(spark, folder, "documents")
    held = F.coalesce(crc_part("doc_id", 4) == 2, F.lit(False))
    model = crf_language.fit(docs.where(~held), doc_id="doc_id")
    read = crf_language.document_languages(docs.withColumn("_held", held), model, keep=["doc_id", "_held"])
    return read.select("doc_id", F.col("_held").alias("held_out"), "lang_pred", "score")


# --- 4: benchmark decontamination

_SHINGLES = """
    SELECT {id}, array_to_string(w[i:i + 4], ' ') AS g FROM (
        SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM (
            SELECT {id}, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g')), ' ') AS w FROM {table}))
"""


@query(
    "op4_benchmark_containment",
    f"""
    WITH b AS (SELECT DISTINCT item_id, g FROM ({_SHINGLES.format(id='item_id', table='benchmark')})),
    n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
    d AS (SELECT DISTINCT doc_id, g FROM ({_SHINGLES.format(id='doc_id', table='documents')}))
    SELECT doc_id, item_id, count(*) AS shared, any_value(n.n) AS n_shingles
    FROM d JOIN b USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n.n)""",
)
def benchmark_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the shingles shared and all of the item."""
    found = decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "shared", F.col("n").alias("n_shingles"))


# --- 5: main text of pages; brute force in tests/llm/test_html.py


@query("op5_html_template")
def html_template_query(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    read = html_template.extract(table(spark, folder, "pages"))
    return read.select(F.col("id").alias("page_id"), F.col("address").alias("url"), "text", "n_chars")


# --- 6: cross-site lines


@query(
    "op6_line_spread",
    """
    WITH l AS (SELECT doc_id, source, line, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS raw FROM (
                   SELECT doc_id, source, string_split(text, chr(10)) AS lines, NULL AS line FROM documents)),
    t AS (SELECT doc_id, source, pos, raw, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
    s AS (SELECT line FROM t WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5),
    f AS (SELECT t.*, s.line IS NOT NULL AS spread FROM t LEFT JOIN s ON t.line = s.line),
    d AS (SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines, count(*) FILTER (WHERE spread) AS marked,
                 count(*) FILTER (WHERE line <> '' AND NOT spread) > 0 AS cut,
                 coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT spread), '') AS rest FROM f GROUP BY doc_id)
    SELECT doc_id, CASE WHEN cut AND marked > 0 THEN rest ELSE text END AS text, n_lines,
           CASE WHEN cut THEN marked ELSE 0 END AS n_removed
    FROM documents JOIN d USING (doc_id)""",
)
def line_spread_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand on five sites or more."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return line_spread.without_spread_lines(docs, counts=True).select("doc_id", "text", "n_lines", "n_removed")


# --- 7: mixing


@query(
    "op7_temperature_mix",
    """
    WITH RECURSIVE d AS (SELECT doc_id, source, digest, CASE WHEN w = '' THEN 0 ELSE len(regexp_split_to_array(w, '[\\x20\\x09-\\x0D]+')) END AS tokens
        FROM (SELECT doc_id, source, md5(text) AS digest, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS w FROM documents)),
    s AS (SELECT source, count(*) AS docs, sum(tokens)::BIGINT AS total FROM d GROUP BY source),
    a AS (SELECT list(total / whole ORDER BY source) AS ps, any_value(whole) AS budget FROM s, (SELECT sum(total)::BIGINT AS whole FROM s)),
    t AS (SELECT *, -list_sum(list_transform(ps, lambda p: p * ln(p))) AS own FROM a),
    g AS (SELECT ps, budget, own + 0.5 * (ln(len(ps)) - own) AS goal FROM t),
    b AS (SELECT 0 AS step, 0 AS low, 1048576 AS high, ps, budget, goal FROM g UNION ALL
          SELECT step + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END, ps, budget, goal FROM (
              SELECT *, ln(list_sum(list_transform(ps, lambda p: pow(p, mid / 1048576)))) - mid / 1048576
                     * list_sum(list_transform(ps, lambda p: pow(p, mid / 1048576) * ln(p))) / list_sum(list_transform(ps, lambda p: pow(p, mid / 1048576))) >= goal AS ok
              FROM (SELECT *, (low + high) // 2 AS mid FROM b WHERE high - low > 1))),
    e AS (SELECT low / 1048576 AS ex, ps, budget FROM b WHERE high - low = 1),
    q AS (SELECT source, docs, total, floor(pow(total / budget, ex) / list_sum(list_transform(ps, lambda p: pow(p, ex))) * budget)::BIGINT AS quota, budget FROM s, e),
    x AS (SELECT doc_id, source, digest, tokens, total, quota, budget, unnest(range(0, ((quota - 1) // total) + 1)) AS pass FROM d JOIN q USING (source)),
    y AS (SELECT *, pass * total + coalesce(sum(tokens) OVER (PARTITION BY source, pass ORDER BY md5(concat_ws(':', 'mix', pass, doc_id, source, digest))
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM x),
    z AS (SELECT *, least(floor(pos::DOUBLE / quota * ceil(budget / 100000))::BIGINT, ceil(budget / 100000)::BIGINT - 1) AS block FROM y WHERE pos < quota)
    SELECT doc_id, source, pass, block, row_number() OVER (PARTITION BY block ORDER BY md5(concat_ws(':', 'mix', block, pass, doc_id, source, digest))) - 1 AS place, tokens::BIGINT AS tokens
    FROM z""",
)
def temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mixed stream over all documents: half way to the even mixture, four passes at most."""
    return mixing.mixed_blocks(table(spark, folder, "documents")).withColumnRenamed("doc", "doc_id")


# --- 8: scores of a language model; base scores against SQL and the model's sums in tests/llm/test_attention.py


@query("op8_attention_lm")
def attention_lm_query(spark: SparkSession, folder: str) -> DataFrame:
    """Base and model score of every document, learned from six of seven parts."""
    docs = table(spark, folder, "documents")
    held = F.coalesce(crc_part("doc_id", 7) == 2, F.lit(False))
    fitted = attention_lm.fit(docs.where(~held))
    scored = attention_lm.document_scores(docs, fitted, flag=held)
    return scored.withColumnRenamed("doc", "doc_id").withColumnRenamed("flag", "held_out")


# --- 9: near copies


@query(
    "op9_dart_minhash",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, string_split(x, ' ') AS w FROM (
            SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}]+', ' ', 'g')) AS x FROM documents) WHERE x <> ''),
    s AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w)),
    c AS (SELECT doc_id, g, count(*) AS n FROM s GROUP BY ALL),
    t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS met FROM c a JOIN c b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE met >= 0.8 * (x.total + y.total - met)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a""",
)
def dart_minhash_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the smallest id of its class of near copies."""
    found = dart_minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.col("class").alias("class_id"))


# --- 10: robust outliers; the concentration steps have no SQL, see tests/llm/test_quality.py


@query("op10_robust_quality")
def robust_quality_query(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    return robust_quality.judged(table(spark, folder, "documents")).drop("doc_hash").withColumnRenamed("doc", "doc_id")


# --- 11: codes of vectors

_NEW = ", ".join(f"CASE WHEN s.n > 0 THEN CAST(floor(s.s{i} / s.n) AS BIGINT) ELSE c.x{i} END AS x{i}" for i in range(4))
_DISTANCE = " + ".join(f"(p.x{i} - c.x{i}) * (p.x{i} - c.x{i})" for i in range(4))
_SUMS = ", ".join(f"CAST(sum(p.x{i}) AS DOUBLE) AS s{i}" for i in range(4))


def _assign_sql(book: str) -> str:
    return f"SELECT rid, part, min(({_DISTANCE}) * 64 + entry) AS far FROM p JOIN {book} c USING (part) GROUP BY rid, part"


def _round_sql(book: str, pairs: str) -> str:
    return (
        f"SELECT c.part, c.entry, {_NEW} FROM {book} c LEFT JOIN (SELECT p.part, far % 64 AS entry, count(*) AS n, {_SUMS} "
        f"FROM p JOIN {pairs} USING (rid, part) GROUP BY ALL) s ON s.part = c.part AND s.entry = c.entry"
    )


@query(
    "op11_dual_tree_codes",
    f"""
    WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
               FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT rid, part, v[4 * part + 1] AS x0, v[4 * part + 2] AS x1, v[4 * part + 3] AS x2, v[4 * part + 4] AS x3 FROM k, (SELECT unnest(range(16)) AS part)),
    c0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, x0, x1, x2, x3 FROM p WHERE rid <= 64),
    a0 AS MATERIALIZED ({_assign_sql("c0")}), c1 AS MATERIALIZED ({_round_sql("c0", "a0")}),
    a1 AS MATERIALIZED ({_assign_sql("c1")}), c2 AS MATERIALIZED ({_round_sql("c1", "a1")}),
    a2 AS MATERIALIZED ({_assign_sql("c2")}),
    o AS (SELECT rid, string_agg(format('{{:02x}}', far % 64), '' ORDER BY part) AS code, sum(far // 64)::BIGINT AS error FROM a2 GROUP BY rid),
    h AS (SELECT sha256(string_agg(x0 || ',' || x1 || ',' || x2 || ',' || x3, ',' ORDER BY part, entry)) AS sha FROM c2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM k JOIN o USING (rid), h""",
)
def dual_tree_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's code, error and its label's error under codebooks of two rounds."""
    coded, books = vector_codes.compressed(table(spark, folder, "embeddings"))
    rows = vector_codes.with_label_errors(coded)
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


# --- 12: addresses

URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_FITS = " ".join(
    f"WHEN (host = '{r.split('/', 1)[0]}' OR suffix(host, '.{r.split('/', 1)[0]}')) AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'"
    for r, _ in sorted(URL_RULES, key=lambda r: -len(r[0]))
)


@query(
    "op12_digest_urls",
    f"""
    WITH h AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM h),
    r AS (SELECT *, CASE {_FITS} END AS rule FROM p)
    SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN map {{{', '.join(f"'{r}': '{v}'" for r, v in URL_RULES)}}}[rule]
           WHEN list_has_any(string_split_regex(host, '[^a-z0-9]+'), {url_filter.WORDS}) THEN 'block' ELSE 'allow' END AS verdict
    FROM r""",
)
def digest_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's address under five rules of sites and the words of hosts."""
    listed = url_filter.entries(spark, URL_RULES)
    return url_filter.judged(table(spark, folder, "pages"), listed).withColumnRenamed("id", "page_id")


# --- 13: two tokenizers over the same bytes; brute force in tests/llm/test_alignment.py

TOKENIZERS = "/opt/tokenizers"


@query("op13_fragment_alignment")
def fragment_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document."""
    rows = alignment.aligned(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return rows.withColumnRenamed("doc", "doc_id")
