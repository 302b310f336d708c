"""Cross-site boilerplate: lines found on many distinct sites are taken out of the documents.

Every line is hashed (two 64-bit hashes of the trimmed line); one HyperLogLog sketch of sites per line
hash is built on the map side and merged by aggregation, so a line on a third of all rows is one small
sketch per task. Lines whose estimate lies near the threshold get an exact count of distinct sites.

A document loses its boilerplate lines, however much of it they are. Only a document all of whose lines that are not blank are spread
stays whole: it is a copy of a spread document, which near-duplicate search judges. So no document becomes empty.

Defined cases: a null text stays null, an empty one empty; blank lines are never boilerplate and stay
where they are; a null site is no site; a line that repeats in a document counts once per site and goes
wherever it stands; rows that repeat an id are told apart by their text, equal rows are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import BLANKS, stored, text_hash

MIN_SITES = 5
LOG_REGISTERS = 12


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _line_keys(line: Column) -> list[Column]:
    """Two independent 64-bit hashes: at 10^12 lines, one alone would confuse some."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def site_lines(docs: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """``h1, h2, site`` of every line that is not blank, with repeats."""
    lines = docs.select(F.col(site).alias("site"), F.explode(F.split(F.col(text), "\n")).alias("raw"))
    trimmed = lines.select("site", _trimmed(F.col("raw")).alias("line")).where("line <> ''")
    return trimmed.select("site", *_line_keys(F.col("line")))


def spread_lines(
    docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, log_registers: int = LOG_REGISTERS
) -> DataFrame:
    """``h1, h2`` of the lines that stand on ``min_sites`` distinct sites or more."""
    lines = site_lines(docs, text, site).where(F.col("site").isNotNull())
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_registers))).alias("sites"))
    # four standard errors of the sketch, and the neighbouring counts at least
    margin = max(1.0, 4 * 1.04 / 2 ** (log_registers / 2) * min_sites)
    estimated = stored(sketched.where(F.col("sites") >= min_sites - margin), "line-spread")
    sure = estimated.where(F.col("sites") > min_sites + margin).select("h1", "h2")
    near = estimated.where(F.col("sites") <= min_sites + margin).select("h1", "h2")
    # sites first become distinct per line, then are counted: both steps combine on the map side
    exact = lines.join(near, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites"))
    return sure.unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2"))


def without_spread_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    counts: bool = False,
) -> DataFrame:
    """The documents without their cross-site lines; columns as they came.

    With ``counts`` the columns ``n_lines`` (not blank) and ``n_removed`` follow.
    """
    spread = stored(spread_lines(docs, text, site, min_sites), "spread-lines")
    key = [F.col(doc_id).alias("_key"), text_hash(text).alias("_hash")]
    lines = docs.select(*key, F.explode(F.split(F.col(text), "\n")).alias("raw"))
    lines = lines.select("_key", "_hash", _trimmed(F.col("raw")).alias("line")).where("line <> ''")
    lines = lines.select("_key", "_hash", "line", *_line_keys(F.col("line"))).join(spread, ["h1", "h2"], "left_semi")
    marked = lines.groupBy("_key", "_hash").agg(F.collect_set("line").alias("_spread"))
    renamed = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)], text_hash(text).alias("_text_hash"))
    place = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    joined = renamed.join(
        marked, renamed[place[doc_id]].eqNullSafe(marked["_key"]) & (renamed["_text_hash"] == marked["_hash"]), "left"
    )
    body = F.col(place[text])
    mine = F.when(F.col("_spread").isNull(), F.array().cast("array<string>")).otherwise(F.split(body, "\n"))
    parts = joined.withColumn("_lines", mine)
    parts = parts.withColumn("_rest", F.filter("_lines", lambda x: ~F.array_contains(F.col("_spread"), _trimmed(x))))
    parts = parts.withColumn("_cut", F.col("_spread").isNotNull() & F.exists("_rest", lambda x: _trimmed(x) != ""))
    cleaned = F.when(F.col("_cut"), F.array_join("_rest", "\n")).otherwise(body)
    out = [(cleaned if c == text else F.col(place[c])).alias(c) for c in docs.columns]
    if counts:
        filled = F.size(F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), lambda x: _trimmed(x) != ""))
        gone = F.when(F.col("_cut"), F.size("_lines") - F.size("_rest")).otherwise(0)
        out += [filled.cast("bigint").alias("n_lines"), gone.cast("bigint").alias("n_removed")]
    return parts.select(*out)
