"""Articles from feeds, and the tags found in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.fixed_values import PLACE_LABELS
from tallyworks.functions.text import capitalise, one_line, stem_place, strip_markup
from tallyworks.operators.joins import lookup_inner, lookup_or_self, multiplying_left_join
from tallyworks.operators.windows import merge_adjacent
from tallyworks.sources.pages import extract_by_rule
from tallyworks.sources.tables import unseen


def article_table(items: DataFrame, rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Feed items ``(link, title, published, updated, html)`` as articles, each link once.

    The key is the MD5 of the link. Links that ``known`` holds are left out before any page is
    parsed; hosts without rule and pages without the element yield no article.
    """
    keyed = items.withColumn("article_id", F.md5("link")).withColumn(
        "article_date", F.coalesce(F.col("published"), F.col("updated"))
    )
    new = unseen(keyed, known, "article_id", ["article_date", "title", "html"])
    found = extract_by_rule(new, rules, "link", "html").where(F.col("text").isNotNull())
    return found.select(
        "article_id",
        F.col("title").alias("article_title"),
        "article_date",
        F.col("link").alias("article_url"),
        one_line(strip_markup(F.col("text"))).alias("article_text"),
    )


def tag_table(
    articles: DataFrame, tokens: DataFrame, mark: str = "▁", name: str = "security_tag", parts: int | None = None
) -> DataFrame:
    """Distinct terms of each article; word pieces on consecutive places are one term.

    ``tokens(article_id, index, word)``. An article without any token has the tag "tagless".
    """
    terms = merge_adjacent(tokens, ["article_id"], "index", "word", mark, name, parts)
    tags = terms.select("article_id", name).distinct()
    every = multiplying_left_join(articles.select("article_id").distinct(), tags, ["article_id"])
    return every.withColumn(name, F.coalesce(name, F.lit("tagless")))


def geo_tags(
    entities: DataFrame, demonyms: DataFrame, countries: DataFrame, labels: list[str] = PLACE_LABELS, dedupe: bool = False
) -> DataFrame:
    """Country codes of the places named in each article.

    ``entities(article_id, entity, label)``, ``demonyms(demonym, country)``, ``countries(country,
    code)``. Words are stemmed, looked up as people's names, then as countries; what is no country
    is dropped. Two words for one country give two rows unless ``dedupe``.
    """
    places = entities.where(F.col("label").isin(labels)).select("article_id", "entity").distinct()
    stems = places.select("article_id", stem_place(F.col("entity")).alias("stem")).distinct()
    named = stems.withColumn("country", capitalise(F.col("stem")))
    known = lookup_or_self(named, "country", demonyms.select("demonym", F.col("country").alias("__c")), "demonym", "__c", ["__c"])
    by_name = known.withColumn("__low", F.lower("country"))
    table = countries.select(F.lower("country").alias("__name"), "code")
    tags = lookup_inner(by_name, "__low", table, "__name", "code", ["code"], "country_tag").select("article_id", "country_tag")
    return tags.distinct() if dedupe else tags
