"""Short test items inside long documents: MinHash containment over size classes, then exact containment.

An item is a set of n word shingles (five words; a shorter item is one shingle of all its words). A
document contains it if it holds at least ``threshold`` of the set. At most ``a = floor((1 - threshold)
* n)`` shingles may then be missing, so of any ``a + h`` of them at least ``h`` are in the document.
Items are partitioned by size (classes of powers of two, as in an ensemble of MinHash indexes); each
class keeps the ``a + h`` smallest hashes of an item, its bottom sketch, with ``a`` taken at the upper
end of the class. A document is a candidate for an item if it holds ``h`` hashes of the sketch, which by
the count above no true container misses, whatever its length. Candidates are verified on the shingles
themselves.

Defined cases: null and empty texts have no shingle, items without a word match nothing; items of fewer
than five words are looked for as one run of words; a shingle that repeats counts once; rows that
repeat id and text give one result; null ids are ids of their own. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import folded_words, same, stored, text_hash, text_or_empty

WIDTH = 5
THRESHOLD = 0.8
HITS = 3


def _shingle_hashes(words: Column, width: int) -> Column:
    """64-bit hashes of all runs of ``width`` words, with repeats."""
    last = F.size(words) - width
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    )


def _shingles(words: Column, width: int) -> Column:
    last = F.size(words) - width
    return F.when(last < 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(width)]))
    )


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``item, width, shingle, hash, n``: the distinct shingles of every item and their number."""
    # repeated item ids with other texts are one item with the shingles of both
    words = items.select(F.col(item_id).alias("item"), folded_words(text_or_empty(text)).alias("words"))
    parts = [
        words.where((F.size("words") >= width) if w == width else (F.size("words") == w))
        .select("item", F.lit(w).alias("width"), F.explode(_shingles(F.col("words"), w)).alias("shingle"))
        for w in range(1, width + 1)
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.distinct()
    sizes = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.split("shingle", " ")
    hashed = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for w in range(1, width + 1):
        hashed = hashed.when(F.col("width") == w, F.xxhash64(*[F.get(pieces, F.lit(k)) for k in range(w)]))
    return rows.join(sizes.withColumnRenamed("item", "of"), F.col("item").eqNullSafe(F.col("of"))).select(
        "item", "width", "shingle", hashed.alias("hash"), "n"
    )


def sketches(shingles: DataFrame, threshold: float = THRESHOLD, hits: int = HITS) -> DataFrame:
    """``item, width, hash, need``: the smallest hashes of each item, as many as its size class asks for.

    ``need`` hashes of them are in every document that contains the item.
    """
    top = F.pow(F.lit(2), F.ceil(F.log2(F.col("n")))).cast("bigint")  # upper end of the size class
    missing = F.floor(top * F.lit(1 - threshold) + F.lit(1e-9))
    by_item = shingles.groupBy("item").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_set(F.struct("hash", "width"))).alias("all")
    )
    held = by_item.withColumn("missing", missing).withColumn("size", F.least(F.col("missing") + hits, F.size("all")).cast("int"))
    # the count of an item of its own bounds what may be missing of a sketch that holds all of it
    own = F.floor(F.col("n") * F.lit(1 - threshold) + F.lit(1e-9))
    need = F.greatest(F.lit(1), F.col("size") - F.least(own, F.col("missing")))
    return held.select("item", need.cast("bigint").alias("need"), F.explode(F.slice("all", 1, F.col("size"))).alias("s")).select(
        "item", "need", "s.hash", "s.width"
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    width: int = WIDTH,
) -> DataFrame:
    """``doc, doc_hash, item, shared, n`` of every document that holds ``threshold`` of an item's shingles.

    ``doc_hash`` tells rows apart that share an id. The items are few against the documents; their
    tables are written, and Spark broadcasts them only if their size allows it.
    """
    grams = stored(item_shingles(items, item_id, item_text, width), "item-shingles")
    sketch = stored(sketches(grams, threshold), "item-sketches")
    widths = sorted(r[0] for r in grams.select("width").distinct().collect())  # at most five numbers
    rows = docs.select(F.col(doc_id).alias("doc"), text_hash(text).alias("doc_hash"), F.col(text).alias("body")).where(
        F.col("body").isNotNull()
    )
    if not widths:
        return _nothing(rows, grams)
    worded = rows.withColumn("words", folded_words(F.col("body")))
    parts = None
    for w in widths:
        part = worded.select("doc", "doc_hash", F.lit(w).alias("w"), F.explode(_shingle_hashes(F.col("words"), w)).alias("h"))
        parts = part if parts is None else parts.unionByName(part)
    hit = parts.join(sketch, (parts["h"] == sketch["hash"]) & (parts["w"] == sketch["width"]))
    candidates = (
        hit.groupBy("doc", "doc_hash", "item", "need")
        .agg(F.count_distinct(F.struct("h", "w")).alias("found"))
        .where(F.col("found") >= F.col("need"))
        .select("doc", "doc_hash", "item")
    )
    candidates = stored(candidates, "contained-candidates")
    suspects = candidates.select("doc", "doc_hash").distinct()
    texts = rows.join(suspects, same(rows, suspects, ["doc", "doc_hash"]), "left_semi").dropDuplicates(["doc", "doc_hash"])
    texts = texts.withColumn("words", folded_words(F.col("body")))
    parts = None
    for w in widths:
        part = texts.select("doc", "doc_hash", F.explode(F.array_distinct(_shingles(F.col("words"), w))).alias("shingle"))
        parts = part if parts is None else parts.unionByName(part)
    wanted = grams.select("item", "shingle", "n")
    met = parts.join(wanted, "shingle")
    # only the pairs that the search brought forward are counted
    pairs = candidates.select(F.col("doc").alias("d"), F.col("doc_hash").alias("dh"), F.col("item").alias("it"))
    met = met.join(
        pairs, met["doc"].eqNullSafe(pairs["d"]) & (met["doc_hash"] == pairs["dh"]) & met["item"].eqNullSafe(pairs["it"]), "left_semi"
    )
    counted = met.groupBy("doc", "doc_hash", "item", "n").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where(F.col("shared") >= F.col("n") * F.lit(threshold) - F.lit(1e-9)).select("doc", "doc_hash", "item", "shared", "n")


def _nothing(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """The result over no items, with its columns."""
    doc = rows.schema["doc"].dataType.simpleString()
    item = grams.schema["item"].dataType.simpleString()
    return rows.sparkSession.createDataFrame([], f"doc {doc}, doc_hash bigint, item {item}, shared bigint, n bigint")


def without_contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that contain no item; columns as they came."""
    found = contained_items(docs, items, doc_id, text, **options).select("doc", "doc_hash").distinct()
    return docs.join(found, docs[doc_id].eqNullSafe(found["doc"]) & (text_hash(text) == found["doc_hash"]), "left_anti")
