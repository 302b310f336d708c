"""Temperature mixing of sources, realised as a stream of token blocks.

A source with the share ``p`` of all tokens gets the weight ``p^a / sum p^a``. The exponent ``a`` is
bisected over the grid ``k / 2^20`` of [0, 1]: entropy falls as ``a`` grows, and so do repetitions of small sources as it
falls, so the largest ``a`` that reaches the target entropy, or the smallest that keeps every source
within ``max_repeats`` passes, is found in twenty steps. The sources' totals are a table; each step is one
aggregate over it.

The budget of tokens is then spent: a source's documents are drawn in passes, each pass a permutation of
its own by MD5 of seed, pass and id. A draw's place in its source's stream of tokens gives the block, as
every block takes the same share of a source; inside a block the draws of all sources are permuted again.
So every prefix of whole blocks has the target mixture, up to a document per source.

Running sums need no group in one task: a pass of a source with n documents is cut into about sqrt(n)
ranges of the hash, summed within and across ranges.

Defined cases: a null source is a source; null and empty texts have no tokens and are drawn with their
source's passes; a source without tokens has no weight and is not drawn; rows that repeat an id are drawn
as often as they come, in a stable order of equal hashes; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import plain_words, stored, text_or_empty

GRID = 2**20


def source_totals(rows: DataFrame) -> DataFrame:
    """``source, docs, tokens`` of rows that carry ``source`` and ``tokens``."""
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))


def _shape(totals: DataFrame, tokens: int, exponent: float) -> tuple[float, float]:
    """Entropy of the mixture, and the most passes over a source per token of budget and corpus."""
    p = F.col("tokens") / F.lit(tokens)
    power = F.pow(p, F.lit(exponent))
    row = totals.where("tokens > 0").agg(
        F.sum(power).alias("z"), F.sum(power * F.log(p)).alias("s"), F.max(power / p).alias("m")
    ).first()
    return math.log(row["z"]) - exponent * row["s"] / row["z"], row["m"] / row["z"]


def entropy_exponent(totals: DataFrame, tokens: int, target: float) -> float:
    """The largest grid exponent whose mixture has at least the target entropy (0 if none has)."""
    low, high = 0, GRID
    if _shape(totals, tokens, 1.0)[0] >= target:
        return 1.0
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if _shape(totals, tokens, mid / GRID)[0] >= target else (low, mid)
    return low / GRID


def repeat_exponent(totals: DataFrame, tokens: int, budget: int, max_repeats: float) -> float:
    """The smallest grid exponent at which no source is read more than ``max_repeats`` times (1 if none)."""
    low, high = 0, GRID
    if _shape(totals, tokens, 0.0)[1] * budget / tokens <= max_repeats:
        return 0.0
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if _shape(totals, tokens, mid / GRID)[1] * budget / tokens <= max_repeats else (mid, high)
    return high / GRID


def token_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc, source, tokens, digest``: the words of each document counted; the digest of its text tells rows of one id apart."""
    return docs.select(
        F.col(doc_id).alias("doc"), F.col(source).alias("source"), F.size(plain_words(text_or_empty(text))).cast("bigint").alias("tokens"),
        F.md5(F.col(text)).alias("digest"),
    )


def _hash_place(bucket: str, hashed: str) -> Column:
    """Range of an MD5 hash among ``bucket`` equal ranges; grows with the hash."""
    return F.floor(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") * F.col(bucket) / F.lit(float(2**32))).cast("bigint")


def running_tokens(rows: DataFrame, keys: list[str], size: str) -> DataFrame:
    """Adds ``before``: the tokens of the rows of the same keys that come earlier by ``hash``.

    ``size`` names the number of rows of the keys; sqrt(size) ranges of the hash are summed one by one,
    and the ranges' totals are summed in turn, so neither step sees more than about sqrt(size) rows at once.
    """
    ranged = rows.withColumn("_parts", F.ceil(F.sqrt(F.col(size).cast("double")))).withColumn("_range", _hash_place("_parts", "hash"))
    within = Window.partitionBy(*keys, "_range").orderBy("hash", "doc", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("tokens").alias("_sum"))
    starts = totals.select(*keys, "_range", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_start"))
    summed = ranged.withColumn("_inner", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    named = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_k_range"), "_start")
    cond = summed["_range"] == named["_k_range"]
    for k in keys:
        cond = cond & summed[k].eqNullSafe(named[f"_k_{k}"])
    return summed.join(named, cond).withColumn("before", F.col("_start") + F.col("_inner")).select(*rows.columns, "before")


def mixed_blocks(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    entropy_gain: float | None = 0.5,
    max_repeats: float | None = 4.0,
    budget_share: float = 1.0,
    block_tokens: int = 100_000,
    seed: str = "mix",
) -> DataFrame:
    """``doc, source, pass, block, place, tokens``: the draws of the mixed stream.

    ``entropy_gain`` sets the target entropy that part of the way from the corpus' own to the even mixture
    of its sources; ``max_repeats`` bounds the passes over any source; the larger exponent of the two
    holds. ``budget_share`` is the budget of tokens as a share of the corpus.
    """
    rows = stored(token_rows(docs, doc_id, text, source), "mix-tokens")
    totals = stored(source_totals(rows), "mix-sources")
    whole = totals.where("tokens > 0").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    tokens, sources = whole["t"] or 0, whole["n"]
    budget = math.floor(tokens * budget_share)
    exponent = 1.0
    if tokens and entropy_gain is not None:
        own = _shape(totals, tokens, 1.0)[0]
        exponent = entropy_exponent(totals, tokens, own + entropy_gain * (math.log(sources) - own))
    if tokens and max_repeats is not None:
        lowest = repeat_exponent(totals, tokens, budget, max_repeats)
        exponent = max(exponent if entropy_gain is not None else 0.0, lowest)
    scale = totals.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(max(tokens, 1)), F.lit(exponent)))).first()[0] or 1.0
    weight = F.pow(F.col("tokens") / F.lit(max(tokens, 1)), F.lit(exponent)) / F.lit(scale)
    plan = totals.where("tokens > 0").select(
        F.col("source").alias("_source"), "docs", F.col("tokens").alias("_total"), F.floor(weight * budget).alias("_quota")
    )
    drawn = rows.join(plan, rows["source"].eqNullSafe(plan["_source"])).where("_quota > 0")
    passes = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_quota") - 1) / F.col("_total"))))
    drawn = drawn.select("doc", "source", "digest", "tokens", "docs", "_total", "_quota", passes.alias("pass"))
    row = [F.col("doc").cast("string"), F.col("source").cast("string"), F.col("digest")]
    drawn = drawn.withColumn("hash", F.md5(F.concat_ws(":", F.lit(seed), F.col("pass").cast("string"), *row)))
    placed = running_tokens(drawn, ["source", "pass"], "docs")
    at = F.col("pass") * F.col("_total") + F.col("before")
    placed = placed.withColumn("at", at).where(F.col("at") < F.col("_quota"))
    # block b of a source takes the tokens from b / blocks of its quota on
    blocks = max(1, math.ceil(budget / block_tokens))
    part = F.floor(F.col("at") / F.col("_quota") * F.lit(blocks)).cast("bigint")  # a double: no product of large numbers
    placed = placed.withColumn("block", F.least(part, F.lit(blocks - 1).cast("bigint")))
    shuffled = F.md5(F.concat_ws(":", F.lit(seed), F.col("block").cast("string"), F.col("pass").cast("string"), *row))
    order = Window.partitionBy("block").orderBy("_in_block", "doc", "pass", "source", "at")
    return placed.withColumn("_in_block", shuffled).select(
        "doc", "source", "pass", "block", (F.row_number().over(order) - 1).cast("bigint").alias("place"), "tokens"
    )
