"""Queries on transcripts, articles and relations in text."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.functions import text as tx
from tallyworks.functions.fixed_values import EMOTIONS, IS_A_RULES
from tallyworks.functions.scoring import with_scores
from tallyworks.operators import articles, relations, transcripts
from tallyworks.plans.ordered import CAPITALISED
from tallyworks.plans.registry import query
from tallyworks.plans.scalars import SENTENCES, WORDS, even_slice_sql
from tallyworks.plans.sources import HOST_SQL, _flat, page_rules
from tallyworks.session import cut_lineage, new_folder
from tallyworks.sources.files import read_json_tree, with_file_key
from tallyworks.sources.tables import append, to_sink_schema

_FILE, _ORDER = ["conv_id"], ["turn", "pos"]


def call_files(t):
    """All conversations as transcript files of a speech service, read back with their schema."""
    path = new_folder(t.spark, "calls")
    calls = t.conversations.select("conv_id", "turn", "role", transcripts.transcript_of(F.col("text"), F.col("turn")).alias("results"))
    calls.write.partitionBy("role").json(path)
    schema = T.StructType.fromDDL(f"conv_id long, turn long, {transcripts.TRANSCRIPT_DDL}")
    return read_json_tree(t.spark, path, schema)


def call_words(t):
    """Words of all conversations, as a transcript of each lists them."""
    return transcripts.words_from_transcript(call_files(t), ["conv_id", "turn"])


CALL_WORDS = f"""(SELECT conv_id, turn, pos, word, length(word) % 3 AS speaker, CAST(0.4 AS DOUBLE) AS duration FROM (SELECT conv_id, turn, unnest(ws) AS word,
generate_subscripts(ws, 1) - 1 AS pos FROM (SELECT conv_id, turn, {WORDS} AS ws FROM conversations)))"""

WORD_TABLE = f"""(SELECT *, CAST(sum(f) OVER (PARTITION BY conv_id ORDER BY turn, pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS part FROM (
SELECT *, CASE WHEN lag(speaker) OVER w IS NULL OR lag(speaker) OVER w <> speaker THEN 1 ELSE 0 END AS f FROM {CALL_WORDS}
WINDOW w AS (PARTITION BY conv_id ORDER BY turn, pos)))"""


def _word_table(t):
    return transcripts.word_table(call_words(t), _FILE, _ORDER)


@query("t01_word_table", f"SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, word, CAST(speaker AS INTEGER) AS speaker, part FROM {WORD_TABLE}")
def t01(t):
    return _word_table(t).drop("duration")


def _numbers(df):
    return df.withColumn("time", F.round("time", 4))


@query(
    "t02_speaker_runs",
    f"""SELECT conv_id, part, CAST(min(speaker) AS INTEGER) AS speaker, round(sum(duration), 4) AS time, count(*) AS count,
string_agg(word, ' ' ORDER BY turn, pos) AS content FROM {WORD_TABLE} GROUP BY 1, 2""",
)
def t02(t):
    return _numbers(transcripts.speaker_runs(_word_table(t), _FILE, _ORDER))


TOTALS = f"""(SELECT conv_id, speaker, sum(duration) AS time, count(*) AS count, string_agg(word, ' ' ORDER BY turn, pos) AS content
FROM {CALL_WORDS} GROUP BY 1, 2)"""


@query("t03_speaker_totals", f"SELECT conv_id, CAST(speaker AS INTEGER) AS speaker, round(time, 4) AS time, count, content FROM {TOTALS}")
def t03(t):
    return _numbers(transcripts.speaker_totals(call_words(t), _FILE, _ORDER))


@query("s12_job_over_files", f"SELECT conv_id, CAST(speaker AS INTEGER) AS speaker, round(time, 4) AS time, count FROM {TOTALS}")
def s12(t):
    """Transcript files of a folder tree, all in one plan keyed by what the files say."""
    read = with_file_key(call_files(t))
    rows = transcripts.words_from_transcript(read, ["file_key", "conv_id", "turn"])
    return _numbers(rows.groupBy("conv_id", "speaker").agg(F.sum("duration").alias("time"), F.count(F.lit(1)).alias("count")))


@query(
    "t04_text_windows",
    f"""SELECT doc_id, CAST(part AS INTEGER) AS "window", content FROM ({even_slice_sql("30", f"(SELECT doc_id, {WORDS} AS w FROM documents)")})""",
)
def t04(t):
    return transcripts.text_windows(t.documents, ["doc_id"], "text")


def chunk_sql(source: str, keys: str, size: int = 512) -> str:
    return f"""(SELECT {keys}, CAST(part AS INTEGER) AS chunk, CASE WHEN k > 1 THEN content ELSE text END AS content FROM
({even_slice_sql(f"greatest(CAST(ceil(length(text) / {size}.0) AS BIGINT), 1)", f"(SELECT {keys}, text, {WORDS} AS w FROM {source})")}))"""


@query("t05_text_chunks", f"SELECT * FROM {chunk_sql('conversations', 'conv_id, turn')}")
def t05(t):
    return transcripts.text_chunks(t.conversations, ["conv_id", "turn"], "text")


def lexicon(t):
    """Words of the benchmark texts, each with a label by hash and a whole-number weight."""
    word = t.benchmark.select(F.explode(tx.words(F.lower("text"))).alias("word")).distinct()
    pick = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long") % len(EMOTIONS)
    names = F.array(*[F.lit(v) for v in EMOTIONS])
    return word.select("word", F.element_at(names, (pick + 1).cast("int")).alias("label"), F.length("word").alias("weight"))


LEXICON = f"""(SELECT word, [{', '.join(repr(v) for v in EMOTIONS)}][CAST(('0x' || substr(md5(word), 1, 8))::BIGINT % 6 AS INTEGER) + 1] AS label,
length(word) AS weight FROM (SELECT DISTINCT unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS word FROM benchmark))"""


def score_sql(chunks: str, keys: str) -> str:
    """Scores per chunk of a relation with ``content``."""
    cols = ", ".join(
        f"coalesce(CAST(sum(weight) FILTER (WHERE label = '{v}') AS DOUBLE) / nullif(sum(weight), 0), 0) AS {v}" for v in EMOTIONS
    )
    return f"""(SELECT {keys}, {cols} FROM (SELECT {keys}, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS word FROM (
SELECT {keys}, list_filter(regexp_split_to_array(lower(content), '\\s+'), lambda x: x <> '') AS ws FROM {chunks}))
LEFT JOIN {LEXICON} USING (word) GROUP BY ALL)"""


def _mean_sql(prefix: str = "") -> str:
    return ", ".join(f"round(avg({v}), 9) AS {prefix}{v}" for v in EMOTIONS)


def _rounded(df, prefix=""):
    return df.withColumns({prefix + v: F.round(prefix + v, 9) for v in EMOTIONS})


@query(
    "t06_chunk_scores",
    f"SELECT doc_id, {_mean_sql()} FROM {score_sql(chunk_sql('documents', 'doc_id'), 'doc_id, chunk')} GROUP BY 1",
)
def t06(t):
    chunks = transcripts.text_chunks(t.documents, ["doc_id"], "text")
    scores = transcripts.lexicon_scores(chunks, ["doc_id", "chunk"], lexicon(t), EMOTIONS)
    return _rounded(transcripts.mean_scores(scores, ["doc_id"], EMOTIONS))


_SPEAKER_CHUNKS = chunk_sql(f"(SELECT conv_id, speaker, content AS text FROM {TOTALS})", "conv_id, speaker")


@query(
    "t07_speaker_table",
    f"""SELECT conv_id AS episode_id, CAST(speaker AS INTEGER) AS speaker_id, sp_time, count, {', '.join('sp_' + v for v in EMOTIONS)} FROM
(SELECT conv_id, speaker, round(time, 4) AS sp_time, count FROM {TOTALS}) JOIN
(SELECT conv_id, speaker, {_mean_sql('sp_')} FROM {score_sql(_SPEAKER_CHUNKS, 'conv_id, speaker, chunk')} GROUP BY 1, 2) USING (conv_id, speaker)""",
)
def t07_speakers(t):
    by = ["conv_id", "speaker"]
    said = cut_lineage(call_words(t))
    totals = _numbers(said.groupBy(*by).agg(F.sum("duration").alias("time"), F.count(F.lit(1)).alias("count")))
    chunks = transcripts.word_chunks(said, by, _ORDER)
    scores = transcripts.lexicon_scores(chunks, [*by, "chunk"], lexicon(t), EMOTIONS)
    means = _rounded(transcripts.mean_scores(scores, by, EMOTIONS, "sp_"), "sp_")
    rows = to_sink_schema(totals.join(means, by), {"conv_id": "episode_id", "speaker": "speaker_id", "time": "sp_time"})
    path = new_folder(t.spark, "t07s")
    append(rows, path)
    return t.spark.read.parquet(path)


_EPISODES = "(SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text FROM conversations GROUP BY 1)"
_WINDOWS = f"""(SELECT conv_id, part AS window_slide, content AS text FROM ({even_slice_sql("30", f"(SELECT conv_id, {WORDS} AS w FROM {_EPISODES})")}))"""


@query(
    "t07_window_table",
    f"""SELECT conv_id AS episode_id, CAST(window_slide AS INTEGER) AS window_slide, {_mean_sql('su_')} FROM
{score_sql(chunk_sql(_WINDOWS, 'conv_id, window_slide'), 'conv_id, window_slide, chunk')} GROUP BY 1, 2""",
)
def t07_windows(t):
    """Windows of whole conversations; a conversation with few words has empty windows that score 0."""
    by = ["conv_id", "window"]
    said = cut_lineage(transcripts.word_windows(call_words(t), _FILE, _ORDER))
    chunks = transcripts.word_chunks(said, by, _ORDER)
    scores = transcripts.lexicon_scores(chunks, [*by, "chunk"], lexicon(t), EMOTIONS)
    means = _rounded(transcripts.mean_scores(scores, by, EMOTIONS, "su_"), "su_")
    every = said.select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("window"))
    filled = every.join(means, by, "left").fillna(0.0, ["su_" + v for v in EMOTIONS])
    path = new_folder(t.spark, "t07w")
    append(to_sink_schema(filled, {"conv_id": "episode_id", "window": "window_slide"}), path)
    return t.spark.read.parquet(path)


def feed_items(t):
    """Pages as feed items; those with an even id have only the date of their last change."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")).cast("string")
    return t.pages.select(
        F.col("url").alias("link"),
        F.format_string("page %d", "page_id").alias("title"),
        F.when(F.col("page_id") % 2 == 1, day).alias("published"),
        F.concat(F.lit("upd "), day).alias("updated"),
        "html",
    )


@query(
    "t08_article_table",
    f"""SELECT md5(url) AS article_id, 'page ' || page_id AS article_title,
CASE WHEN page_id % 2 = 1 THEN '' ELSE 'upd ' END || CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS VARCHAR) AS article_date, url AS article_url,
replace(CASE WHEN length({HOST_SQL}) % 2 = 0 THEN {_flat('h1', 0)} ELSE {_flat('title', 0)} END, chr(10), ' ') AS article_text
FROM pages WHERE {HOST_SQL} NOT LIKE 'spam%'""",
)
def t08(t):
    return articles.article_table(feed_items(t), page_rules(t))


CAPITAL_WORDS = f"""(SELECT CAST(doc_id AS VARCHAR) AS article_id, pos, w FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos
FROM (SELECT doc_id, {WORDS} AS ws FROM documents)) WHERE regexp_matches(w, '{CAPITALISED}'))"""


def tagged_tokens(t):
    """Capitalised words with a piece mark, as a tagger would return them."""
    rows = t.documents.select(
        F.col("doc_id").cast("string").alias("article_id"), F.posexplode(tx.words(F.col("text"))).alias("pos", "w")
    )
    kept = rows.where(F.col("w").rlike(CAPITALISED))
    return kept.select("article_id", F.col("pos").cast("long").alias("index"), F.concat(F.lit("▁"), "w").alias("word"))


@query(
    "t09_tag_table",
    f"""WITH terms AS (SELECT DISTINCT article_id, trim(replace(string_agg('▁' || w, '' ORDER BY pos), '▁', ' ')) AS security_tag FROM
(SELECT *, pos - row_number() OVER (PARTITION BY article_id ORDER BY pos) AS island FROM {CAPITAL_WORDS}) GROUP BY article_id, island)
SELECT CAST(doc_id AS VARCHAR) AS article_id, coalesce(security_tag, 'tagless') AS security_tag FROM documents LEFT JOIN terms ON article_id = CAST(doc_id AS VARCHAR)""",
)
def t09(t):
    return articles.tag_table(t.documents.select(F.col("doc_id").cast("string").alias("article_id")), tagged_tokens(t))


_STEM = "regexp_replace(regexp_replace(lower({0}), '(ss|i)es$', '\\1'), '([^s])s$', '\\1')"
_CAP = "upper(substr({0}, 1, 1)) || lower(substr({0}, 2))"
_DEMONYMS = f"""(SELECT demonym, min('NATION_' || (length(demonym) % 30)) AS country FROM (
SELECT DISTINCT {_CAP.format('w')} AS demonym FROM (SELECT unnest({WORDS}) AS w FROM benchmark)) GROUP BY 1)"""


@query(
    "t10_geo_tags",
    f"""WITH e AS (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest({WORDS}) AS w FROM documents)
 WHERE regexp_matches(w, '{CAPITALISED}') AND length(w) % 4 <> 3),
s AS (SELECT DISTINCT doc_id, {_STEM.format('w')} AS stem FROM e)
SELECT CAST(doc_id AS VARCHAR) AS article_id, 'N' || n_nationkey AS country_tag FROM (SELECT doc_id, {_CAP.format('stem')} AS word FROM s)
LEFT JOIN {_DEMONYMS} ON demonym = word JOIN nation ON lower(n_name) = lower(coalesce(country, word))""",
)
def t10(t):
    found = t.documents.select(
        F.col("doc_id").cast("string").alias("article_id"), F.explode(tx.words(F.col("text"))).alias("entity")
    ).where(F.col("entity").rlike(CAPITALISED))
    labels = F.array(*[F.lit(v) for v in ("NORP", "GPE", "LOC", "PERSON")])
    entities = found.withColumn("label", F.element_at(labels, (F.length("entity") % 4 + 1)))
    word = t.benchmark.select(F.explode(tx.words(F.col("text"))).alias("w"))
    word = word.select(tx.capitalise(F.col("w")).alias("demonym")).distinct()
    demonyms = word.withColumn("country", F.concat(F.lit("NATION_"), (F.length("demonym") % 30).cast("string")))
    countries = t.nation.select(
        F.col("n_name").alias("country"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code")
    )
    return articles.geo_tags(entities, demonyms, countries)


def _terms(t):
    """All words and pairs of neighbouring words of the benchmark texts."""
    w = t.benchmark.select(relations.tokens(F.col("text")).alias("w"))
    pairs = F.transform("w", lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1)))
    return w.select(F.explode(F.concat("w", F.filter(pairs, lambda p: p.isNotNull()))).alias("term")).distinct()


_TOK = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}]+'), lambda x: x <> '')"
SENTENCE_TABLE = f"(SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS sentence_no FROM (SELECT doc_id, {SENTENCES} AS s FROM documents))"


@query("t12_sentence_table", f"SELECT doc_id, CAST(sentence_no AS INTEGER) AS sentence_no, sentence FROM {SENTENCE_TABLE}")
def t12(t):
    return relations.sentence_table(t.documents, ["doc_id"], "text")


_SENTENCE_TOKENS = f"(SELECT doc_id, sentence_no, {_TOK.format('sentence')} AS w FROM {SENTENCE_TABLE})"
_TERMS = f"""(SELECT DISTINCT unnest(w) AS term FROM (SELECT {_TOK.format('text')} AS w FROM benchmark)
UNION SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM (SELECT {_TOK.format('text')} AS w FROM benchmark)))"""


@query(
    "t11_mentions",
    f"""SELECT doc_id, CAST(sentence_no AS INTEGER) AS sentence_no, CAST(pos AS INTEGER) AS pos, term FROM (
SELECT doc_id, sentence_no, i - 1 AS pos, unnest([w[i], CASE WHEN i < len(w) THEN w[i] || ' ' || w[i + 1] END]) AS gram
FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM {_SENTENCE_TOKENS})) JOIN {_TERMS} ON term = gram""",
)
def t11(t):
    rows = relations.sentence_table(t.documents, ["doc_id"], "text")
    return relations.mentions(rows, ["doc_id", "sentence_no"], _terms(t), longest=2)


SMALL_RULES = [("NP__ (of|the|and|on) NP__", "first"), ("NP__,? NP__", "last")]

def relations_sql(rules) -> str:
    """All pairs of different terms of a sentence."""
    return f"""WITH m AS (SELECT doc_id, sentence_no, tok AS term, min(pos) AS pos FROM (SELECT doc_id, sentence_no, unnest(w) AS tok, generate_subscripts(w, 1) AS pos
FROM {_SENTENCE_TOKENS}) JOIN (SELECT DISTINCT unnest({_TOK.format('text')}) AS term FROM benchmark) ON term = tok GROUP BY ALL),
p AS (SELECT a.doc_id, a.sentence_no, a.term AS l, b.term AS r FROM m a JOIN m b ON a.doc_id = b.doc_id AND a.sentence_no = b.sentence_no AND a.pos < b.pos),
x AS (SELECT doc_id, sentence_no, l, r, replace(replace(lower(sentence), CASE WHEN length(l) >= length(r) THEN l ELSE r END, 'NP__'),
 CASE WHEN length(l) >= length(r) THEN r ELSE l END, 'NP__') AS s FROM p JOIN {SENTENCE_TABLE} USING (doc_id, sentence_no)),
d AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches(s, '{p}') THEN '{v}'" for p, v in rules)} END AS dir FROM x)"""


_STRICT = """SELECT DISTINCT doc_id, CAST(sentence_no AS INTEGER) AS sentence_no, CASE WHEN dir = 'first' THEN r ELSE l END AS head, 'subgroup of' AS type,
CASE WHEN dir = 'first' THEN l ELSE r END AS tail FROM d WHERE dir IS NOT NULL"""


def _relation_rows(t, **options):
    rows = relations.sentence_table(t.documents, ["doc_id"], "text")
    words = t.benchmark.select(F.explode(relations.tokens(F.col("text"))).alias("term")).distinct()
    keys = ["doc_id", "sentence_no"]
    return relations.pattern_relations(rows, keys, relations.mentions(rows, keys, words), **options)


@query("t13_pattern_relations", f"{relations_sql(SMALL_RULES)} {_STRICT}")
def t13(t):
    return _relation_rows(t, rules=SMALL_RULES)


@query(
    "t13_pattern_relations_as_found",
    f"""{relations_sql(SMALL_RULES)} SELECT DISTINCT doc_id, CAST(sentence_no AS INTEGER) AS sentence_no, greatest(l, r) AS head, 'subgroup of' AS type, least(l, r) AS tail
FROM d WHERE dir IS NOT NULL""",
)
def t13_found(t):
    return _relation_rows(t, rules=SMALL_RULES, strict=False)


@query("t13_all_rules", f"{relations_sql(IS_A_RULES)} {_STRICT}")
def t13_all(t):
    return _relation_rows(t, rules=IS_A_RULES)


@query(
    "t14_parse_triples",
    """SELECT o_orderkey, 0 AS ord, o_orderpriority AS head, 'has status' AS type, o_orderstatus AS tail FROM orders""",
)
def t14(t):
    tagged = F.format_string(
        "<s><triplet> %s <subj> %s <obj> has status <triplet> %s <subj> %s <obj> is</s><pad>",
        "o_orderpriority", "o_orderstatus", "o_orderstatus", "o_orderstatus",
    )
    return relations.parse_triples(t.orders.select("o_orderkey", tagged.alias("g")), ["o_orderkey"], "g")


def _make_counter():
    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array([[len(s), s.count("the")] for s in texts], dtype="float64")

    return predict


@query(
    "x01_batch_scorer",
    """SELECT doc_id, CAST(length(text) AS DOUBLE) AS size, CAST((length(text) - length(replace(text, 'the', ''))) // 3 AS DOUBLE) AS the_count FROM documents""",
)
def x01(t):
    return with_scores(t.documents, "text", _make_counter, ["size", "the_count"]).select("doc_id", "size", "the_count")
