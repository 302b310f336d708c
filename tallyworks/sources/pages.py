"""Elements of raw web pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyworks.functions.text import decode_entities, strip_markup

# Elements of the HTML standard that never have a closing tag.
_VOID = frozenset(
    ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
)


def host_of(url: Column) -> Column:
    """Host with its port, as in the address; null where the text is no address."""
    return F.regexp_extract(F.try_parse_url(url, F.lit("AUTHORITY")), r"([^@]*)$", 1)


def without_scripts(html: Column) -> Column:
    """Page without scripts, styles and comments; these may hold closing tags as text."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")


def flat_element(html: Column, tag: str, n: int) -> Column:
    """Text of the n-th ``tag`` (from 0) that does not nest; stays inside the JVM.

    Scripts are removed first and entities decoded last.
    """
    found = F.regexp_extract_all(without_scripts(html), F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))
    return decode_entities(strip_markup(F.try_element_at(found, F.lit(n + 1))))


class _NthElement(HTMLParser):
    """Text inside the n-th element with a tag and attribute, nested elements included."""

    def __init__(self, tag: str, attr: str | None, value: str | None, n: int):
        super().__init__(convert_charrefs=True)
        self.tag, self.attr, self.value, self.left = tag, attr, value, n
        self.open: list[str] = []
        self.depth: int | None = None
        self.done = False
        self.text: list[str] = []

    def _fits(self, tag, attrs) -> bool:
        if tag != self.tag:
            return False
        if not self.attr:
            return True
        given = dict(attrs).get(self.attr) or ""
        return given == self.value or (self.attr == "class" and self.value in given.split())

    def handle_starttag(self, tag, attrs):
        fits = not self.done and self.depth is None and self._fits(tag, attrs)
        if fits and self.left > 0:
            self.left -= 1
            fits = False
        if tag in _VOID:
            self.done = self.done or fits
            return
        self.open.append(tag)
        if fits:
            self.depth = len(self.open)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            if self.depth is not None and len(self.open) < self.depth:
                self.depth, self.done = None, True

    def handle_data(self, data):
        if self.depth is not None:
            self.text.append(data)

    def found(self) -> str | None:
        return "".join(self.text) if self.done or self.depth is not None else None


def nth_element_text(html: str, tag: str, attr: str | None, value: str | None, n: int) -> str | None:
    parser = _NthElement(tag, attr, value, n)
    parser.feed(html)
    parser.close()
    return parser.found()


@F.pandas_udf(StringType())
def _nested_element(
    batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]],
) -> Iterator[pd.Series]:
    for html, tag, attr, value, n in batches:
        yield pd.Series(
            [
                None if h is None or t is None else nth_element_text(h, t, a, v, int(i))
                for h, t, a, v, i in zip(html, tag, attr, value, n)
            ],
            dtype=object,
        )


def extract_by_rule(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pages of the hosts that ``rules(host, tag, attr, value, n)`` names, with the text of that element.

    Elements may nest, so a parser reads each page in Arrow batches. Pages of other hosts are left
    out before their markup is sent to Python. The rule side carries no hint: Spark broadcasts it
    while it is below the broadcast threshold and splits hot hosts beyond it.
    """
    ruled = pages.withColumn("host", host_of(F.col(url))).join(rules, "host")
    return ruled.withColumn("text", _nested_element(html, "tag", "attr", "value", "n")).drop("tag", "attr", "value", "n")


def collect_pairs(html: Column, name_pattern: str, value_pattern: str, tail_pattern: str | None = None) -> Column:
    """One text "name value" per labelled pair, pairs set apart by a line, then an optional tail.

    Patterns have one group. Values lead: a name without value is left out.
    """
    names = F.regexp_extract_all(html, F.lit(name_pattern), F.lit(1))
    values = F.regexp_extract_all(html, F.lit(value_pattern), F.lit(1))
    pairs = F.transform(values, lambda v, i: F.concat_ws(" ", F.try_element_at(names, i + 1), v))
    joined = F.array_join(pairs, " \n ")
    if tail_pattern:
        joined = F.concat(joined, F.lit(" \n "), F.regexp_extract(html, tail_pattern, 1))
    return joined
