"""Main text of pages by the template that the pages of a host share.

Pass one reads every page into tokens: elements named by their path (tags with class, id and role, digits
left out) and texts of whole blocks named by path and content. The occurrence vector of a token, its count on every page of the
host, is never built: its fingerprint is a sum over pages of page hash times count, so vectors combine on
the map side and a host of a third of all pages is a few sums per token. Tokens of equal fingerprints form
an equivalence class. Classes that are large and frequent are the template; nested by their paths they
give the page's frame, and what stands between their tokens are its slots.

Texts whose tokens are themselves in a class of the template stand on the pages of the host alike: its fixed
wording. A slot is what an element of the template, one per page, holds beside the elements of the template
below it and beside fixed wording, so it counts the text that differs between pages. The content slot is an article or main element, which pages
name themselves, or else the deepest element whose slots have most of the differing text of the element around it; names play
no part in that. Fixed wording in it is no content. Pages with equal html count once; where nearly all text is alike, the pages are copies
of one another and their text is weighed whole, and where most of the content slot is alike, nothing is cut from it. No number of pages switches the
rule: a host of two different pages has a template. Pass two reads the pages again and keeps what is in the content slot and not in a nested
region of another kind (menus, headers, footers, sidebars, notices, adverts, forms, comments). A page
without the slot, as it has another layout, is read as a host of its own.

The template table has one row per host; Spark sends it to all tasks if it is small, or else joins.

Defined cases: null html is an empty page with an empty text; pages without a host in their address are
one host; repeated rows give repeated rows and count once; broken and cut markup is read as far as
it goes, as browsers do; a host of one page is its own template.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored

# a token belongs to the template if it is on this share of the host's pages
SUPPORT = 0.3
# a class needs so many tokens
CLASS_TOKENS = 3
# fixed wording is on this share of the pages
FIXED_SUPPORT = 0.9
# pages with a smaller share of text that differs are copies of one another
DIFFERS = 0.1
# the content element holds this share of the text of the element around it
HOLDS = 0.6

# fixed values of HTML: elements without an end, with raw text, and those that begin a block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
ENDS_P = BLOCK - frozenset("br caption dd dt head html legend li option tbody td tfoot th thead title tr body".split())
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# elements that hold a page's parts, not parts of a text
HOLDERS = frozenset("html body div section article main center table tbody tr td".split())
SCOPE = frozenset("ul ol dl table td th select button article section div main aside nav body".split())

# regions that are no content wherever they stand
NEVER = frozenset("head title nav footer aside menu script style noscript template iframe select button textarea svg canvas object dialog".split())
# words of class, id and role that say the same
NEVER_WORDS = re.compile(r"^(comment.*|disqus|respond|repl(y|ies)|sidebar.*|nav|navbar|navigation|menu.*|footer|breadcrumbs?|complementary|contentinfo)$")
# words of adverts, notices and forms; inside an article no others take text away
INSIDE_WORDS = re.compile(r"^(ad|ads|advert.*|adsense|adslot|sponsor.*|promo.*|cookies?|consent|notices?|newsletter|subscri.*|signup|login)$")
# regions that are no content unless the article stands in them
OUTSIDE = frozenset("header form fieldset".split())
OUTSIDE_WORDS = re.compile(
    r"^(ad|ads|advert.*|adsense|adslot|banner|sponsor.*|promo.*|header|masthead|cookies?|consent|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscri.*|signup|login|shar(e|ing)|social|related|recommend.*|widget.*|toolbar|paginat.*|pager|copyright|legal|disclaimer|search)$"
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

CONTENT = frozenset(["article", "main"])


def _label(tag: str, attrs: str) -> tuple[str, list[str]]:
    """Name of an element in paths, and the words of its class, id and role."""
    if "=" not in attrs:
        return tag, []
    names = [a or b or c for _, a, b, c in _NAMED.findall(attrs)]
    if not names:
        return tag, []
    text = " ".join(names)
    return f"{tag}.{re.sub(r'[0-9/]+', '', '.'.join(text.split()))}", [w.lower() for w in _WORDS.findall(text)]


def _hidden(attrs: str) -> bool:
    """Is the element hidden by an attribute of that name, by ``aria-hidden`` or by its style."""
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), (a or b or c).strip()
        if (
            name == "hidden" and value.lower() != "until-found"
            or name == "aria-hidden" and value.lower() == "true"
            or name == "style" and _NO_DISPLAY.search(value)
        ):
            return True
    return False


class Page:
    """Elements and texts of one page.

    ``elements``: (path, parent index) in order; ``texts``: (element index, text, kind of region, in a link,
    number of the block). Kinds: 0 content, 1 outside the content unless an article comes below, 2 never.
    """

    def __init__(self, source: str):
        self.elements: list[tuple[str, int]] = [("", -1)]
        self.texts: list[tuple[int, str, int, bool, int]] = []
        self.mains: set[int] = set()
        self._read(source)

    def _read(self, source: str) -> None:
        # open elements: tag, element index, kind, in a link
        stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        block, at, size = 0, 0, len(source)
        while at < size:
            found = _TAG.search(source, at)
            start = found.start() if found else size
            if start > at:
                text = source[at:start]
                if not text.isspace():
                    _, element, kind, link = stack[-1]
                    self.texts.append((element, text, kind, link, block))
                elif self.texts:
                    # white space between inline elements parts words
                    element, last, *rest = self.texts[-1]
                    self.texts[-1] = (element, last + " ", *rest)
            if not found:
                break
            at = found.end()
            closing, tag, attrs = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCK:
                block += 1
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                continue
            if tag in ENDS_P:
                self._end(stack, {"p"})
            elif tag in ENDS_SAME:
                self._end(stack, ENDS_SAME[tag])
            label, words = _label(tag, attrs)
            _, parent, kind, link = stack[-1]
            if tag in CONTENT and kind < 2 and not any(w.startswith("comment") for w in words):
                kind = 0
            elif tag in NEVER:
                kind = 2
            elif any(NEVER_WORDS.match(w) for w in words) and tag not in ("html", "body") and tag not in CONTENT:
                # words alone: around an article they name the page, not a region; comments come after it
                named = any(s[0] in CONTENT for s in stack) or self.mains and any(w.startswith("comment") for w in words)
                kind = 2 if named else max(kind, 1)
            elif any(w.startswith("comment") for w in words) and tag not in ("html", "body"):
                kind = 2
            elif kind == 0 and tag not in ("html", "body"):
                # inside the article a header is its heading
                inside = any(s[0] in CONTENT for s in stack)
                if tag in OUTSIDE and not (tag == "header" and inside):
                    kind = 1
                elif any((INSIDE_WORDS if inside else OUTSIDE_WORDS).match(w) for w in words):
                    kind = 1
            if attrs and _MAY_HIDE.search(attrs) and _hidden(attrs):
                kind = 2
            self.elements.append((f"{self.elements[parent][0]}/{label}", parent))
            here = len(self.elements) - 1
            if kind == 0 and (tag in CONTENT or "main" in words and tag in ("div", "section")):
                self.mains.add(here)
            if tag in VOID or attrs.endswith("/") and tag not in BLOCK:
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = end.end() if end else size
                continue
            stack.append((tag, here, kind, link or tag == "a"))

    @staticmethod
    def _end(stack: list, tags: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in SCOPE:
                return

    def blocks(self) -> list[tuple[int, str, int]]:
        """Content blocks in order: the element where a block begins, its text, and its characters in the source outside links."""
        out: dict[int, list] = {}
        size: dict[int, int] = {}
        for element, text, kind, link, block in self.texts:
            if kind == 0:
                out.setdefault(block, [element]).append(entities.unescape(text))
                size[block] = size.get(block, 0) + (0 if link else len(text))
        plain = ((parts[0], " ".join("".join(parts[1:]).split()), size[block]) for block, parts in out.items())
        return [b for b in plain if b[1]]

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters of content text, and of those in links, below every element."""
        chars, links = [0] * len(self.elements), [0] * len(self.elements)
        for element, text, kind, link, _ in self.texts:
            if kind == 0:
                chars[element] += len(text)
                links[element] += len(text) if link else 0
        for i in range(len(self.elements) - 1, 0, -1):
            parent = self.elements[i][1]
            chars[parent] += chars[i]
            links[parent] += links[i]
        return chars, links


def _hash(text: str, seed: int = 0) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def text_token(path: str, text: str) -> str:
    return f"{_hash(path + chr(0) + text):016x}"


def page_tokens(page: Page) -> dict[str, list[int]]:
    """Per token: occurrences, first place, characters, characters in links, is it main, is it a text."""
    chars, links = page.sizes()
    out: dict[str, list[int]] = {}
    for i, (path, _) in enumerate(page.elements):
        got = out.get(path)
        if got is None:
            out[path] = [1, i, chars[i], links[i], int(i in page.mains), 0]
        else:
            got[0] += 1
            got[2] += chars[i]
            got[3] += links[i]
            got[4] |= int(i in page.mains)
    for element, text, size in page.blocks():
        path = page.elements[element][0]
        got = out.setdefault(f"={text_token(path, text)} {path}", [0, element, 0, 0, 0, 1])
        got[0] += 1
        got[2] += size
    return out


TOKENS = "host string, token string, is_text int, pages long, total long, f1 long, f2 long, place long, chars long, links long, main long"
_TOKENS_ARROW = pa.schema(
    [("host", pa.string()), ("token", pa.string()), ("is_text", pa.int32())]
    + [(n, pa.int64()) for n in ("pages", "total", "f1", "f2", "place", "chars", "links", "main")]
)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``host, html`` -> sums per host and token over the pages of one batch."""
    for batch in batches:
        sums: dict[tuple[str, str], list[int]] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = source.as_py()
            # 28 bits of page hash times a count: sums stay far from 64 bits
            h1, h2 = _hash(text, 1) >> 36, _hash(text, 2) >> 36
            for token, (n, place, chars, links, main, is_text) in page_tokens(Page(text)).items():
                add = (1, n, h1 * n, h2 * n, place, chars, links, main)
                got = sums.get((host, token))
                if got is None:
                    sums[host, token] = [is_text, *add]
                else:
                    for i, x in enumerate(add, 1):
                        got[i] += x
        columns = [[k[0] for k in sums], [k[1] for k in sums], *([v[i] for v in sums.values()] for i in range(9))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOKENS_ARROW)], schema=_TOKENS_ARROW)


def equivalence_classes(tokens: list[dict]) -> list[dict]:
    """Tokens of equal occurrence vectors, in order of the page; nested where a class lies below a token of another.

    ``within`` is the path of the deepest token of another class around all of the class' elements.
    """
    groups: dict[tuple, list[dict]] = {}
    for t in tokens:
        groups.setdefault((t["f1"], t["f2"], t["pages"], t["total"]), []).append(t)
    large = [sorted(g, key=lambda t: (t["place"], t["token"])) for g in groups.values() if len(g) >= CLASS_TOKENS]
    paths = {t["token"]: i for i, g in enumerate(large) for t in g if not t["is_text"]}
    out = []
    for i, group in enumerate(large):
        own = [t["token"] for t in group if not t["is_text"]]
        within = ""
        if own:
            above = min(own, key=lambda p: p.count("/")).rsplit("/", 1)[0]
            while above and (paths.get(above, i) == i):
                above = above.rsplit("/", 1)[0]
            within = above if all(p.startswith(above + "/") for p in own) else ""
        out.append(
            {"tokens": [t["token"] for t in group], "pages": group[0]["pages"], "per_page": group[0]["total"] / group[0]["pages"], "within": within}
        )
    return out


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


def _around(path: str) -> Iterator[str]:
    """A path and those of the elements around it, up to the page."""
    while path:
        yield path
        path = path.rsplit("/", 1)[0]
    yield ""


def part_holders(paths: Iterable[str]) -> set[str]:
    """Paths of elements that hold other blocks; the rest are blocks of text themselves."""
    return {above for p in paths if _tag(p) in BLOCK for above in _around(p.rsplit("/", 1)[0])}


def slots(frame: set[str], text: dict[str, int]) -> dict[str, int]:
    """Characters in the slots of every element of the frame: its ``text`` without that of the next elements of the frame below it."""
    own = {p: text.get(p, 0) for p in frame | {""}}
    for p in frame - {""}:
        above = next(q for q in _around(p.rsplit("/", 1)[0]) if q in own)
        own[above] -= text.get(p, 0)
    return {p: max(n, 0) for p, n in own.items()}


def content_path(mains: dict[str, int], own: dict[str, int], parts: set[str]) -> str:
    """Path of the content slot, of ``mains`` (article and main elements with their text), or else by the ``slots`` of a frame.

    From the page down, the element that holds ``HOLDS`` of what the slots of the one around it hold, as long as it holds parts.
    """
    named = [p for p, n in mains.items() if n > 0]
    if named:
        outermost = [p for p in named if not any(p.startswith(q + "/") for q in named)]
        return max(outermost, key=lambda p: (mains[p], p))
    whole: dict[str, int] = {}
    for p, n in own.items():
        for above in _around(p):
            whole[above] = whole.get(above, 0) + n
    at = ""
    while True:
        below = [p for p in own if p != at and p.rsplit("/", 1)[0] == at and _tag(p) in HOLDERS and p in parts and whole[p] >= HOLDS * max(whole[at], 1)]
        if not below:
            return at
        at = max(below, key=lambda p: (whole[p], p))


TEMPLATE = "host string, content string, fixed array<string>, classes string, slots string"


def _template(rows: pd.DataFrame) -> pd.DataFrame:
    """The template of one host out of its frequent tokens."""
    tokens = rows.to_dict("records")
    classes = equivalence_classes(tokens)
    pages = int(rows["host_pages"].iloc[0])
    members = {p for c in classes for p in c["tokens"]}
    elements = {t["token"]: t for t in tokens if not t["is_text"]}
    plain = {p: int(t["chars"] - t["links"]) for p, t in elements.items()}
    alike = [
        t for t in tokens
        if t["is_text"] and pages > 1 and t["pages"] >= FIXED_SUPPORT * pages and t["total"] == t["pages"] and t["token"] in members
    ]
    fixed_below: dict[str, int] = {}
    for t in alike:
        for above in _around(t["token"].split(" ", 1)[1]):
            fixed_below[above] = fixed_below.get(above, 0) + int(t["chars"])
    differing = {p: max(n - fixed_below.get(p, 0), 0) for p, n in plain.items()}
    if differing.get("", 0) < DIFFERS * plain.get("", 0):
        differing, alike = plain, []
    frame = {p for c in classes if c["per_page"] == 1 for p in c["tokens"] if p in elements}
    own = slots(frame, differing)
    mains = {p: plain[p] for p, t in elements.items() if t["main"]}
    content = content_path(mains, own, part_holders(elements))
    if mains.get(content) or fixed_below.get(content, 0) > differing.get(content, 0):
        alike = []
    fixed = sorted(t["token"][1:].split(" ", 1)[0] for t in alike)
    row = {
        "host": rows["host"].iloc[0], "content": content, "fixed": fixed, "classes": json.dumps(classes, ensure_ascii=False),
        "slots": json.dumps({p: n for p, n in sorted(own.items()) if n}, ensure_ascii=False),
    }
    return pd.DataFrame([row])


def main_text(page: Page, content: str, fixed: frozenset[str]) -> str | None:
    """Text of the content slot, blocks joined by one blank; None if the page has no such element."""
    inside = [False] * len(page.elements)
    for i, (path, parent) in enumerate(page.elements):
        inside[i] = path == content or (parent >= 0 and inside[parent])
    if not any(inside):
        return None
    blocks = [(element, text) for element, text, _ in page.blocks() if inside[element]]
    kept = [text for element, text in blocks if not (fixed and text_token(page.elements[element][0], text) in fixed)]
    return " ".join(kept or [text for _, text in blocks])


def alone(page: Page) -> str:
    """Text of a page read as a host of its own."""
    chars, links = page.sizes()
    count: dict[str, int] = {}
    for path, _ in page.elements:
        count[path] = count.get(path, 0) + 1
    text: dict[str, int] = {}
    for i, (path, _) in enumerate(page.elements):
        text[path] = text.get(path, 0) + chars[i] - links[i]
    single = {p for p, n in count.items() if n == 1}
    mains = {page.elements[i][0]: chars[i] - links[i] for i in sorted(page.mains)}
    return main_text(page, content_path(mains, slots(single, text), part_holders(count)), frozenset()) or ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, address, html, content, fixed`` -> ``id, address, text``."""
    for batch in batches:
        texts = []
        known: dict[tuple[str, ...], frozenset[str]] = {}
        for source, content, fixed in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4)):
            page = Page(source.as_py())
            text = None
            if content is not None:
                wording = tuple(fixed.as_py() or ())
                text = main_text(page, content, known.setdefault(wording, frozenset(wording)))
            texts.append(alone(page) if text is None else text)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "address", "text"])


def _hosted(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("address"), F.coalesce(F.col(html), F.lit("")).alias("html"), F.coalesce(host, F.lit("")).alias("host")
    )


def _distinct(rows: DataFrame) -> DataFrame:
    """``host, html`` with equal pages of a host once; only pages that repeat are dealt out."""
    rows = rows.select("host", "html", F.xxhash64("html").alias("h1"), F.xxhash64(F.lit(1), "html").alias("h2"))
    key = ["host", "h1", "h2"]
    again = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "pages-again")
    once = rows.join(again, key, "left_anti")
    return once.unionByName(rows.join(again, key, "left_semi").dropDuplicates(key)).select("host", "html")


def templates(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT) -> DataFrame:
    """``host, content, fixed, classes, slots``: the template of every host."""
    rows = _hosted(pages, page_id, url, html)
    counted = _distinct(rows).mapInArrow(_count_tokens, TOKENS)
    sums = counted.groupBy("host", "token", "is_text").agg(
        *[F.sum(n).alias(n) for n in ("pages", "total", "f1", "f2", "place", "chars", "links", "main")]
    )
    sums = stored(sums.where("is_text = 0 OR pages > 1"), "page-tokens")
    # the path of the page itself is on every page
    hosts = stored(sums.where("token = '' AND is_text = 0").select(F.col("host").alias("of"), F.col("pages").alias("host_pages")), "page-hosts")
    frequent = sums.join(hosts, F.col("host") == F.col("of")).where(F.col("pages") >= F.lit(support) * F.col("host_pages"))
    frequent = frequent.withColumn("place", F.col("place") / F.col("pages")).drop("of")
    return frequent.groupBy("host").applyInPandas(_template, TEMPLATE)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT) -> DataFrame:
    """``id, address, text, n_chars`` of every page."""
    found = stored(templates(pages, page_id, url, html, support), "page-templates")
    rows = _hosted(pages, page_id, url, html)
    joined = rows.join(found.select("host", "content", "fixed"), "host", "left").select("id", "address", "html", "content", "fixed")
    kind = pages.schema[page_id].dataType.simpleString()
    texts = joined.mapInArrow(_extract, f"id {kind}, address string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
