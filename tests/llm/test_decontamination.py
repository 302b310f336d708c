import random
from collections import Counter

import brute
from cases import all_documents, frame

from tallyworks.llm import decontaminate

ITEMS = "item_id long, text string, doc string"


def planted(seed=1):
    rng = random.Random(seed)
    docs = all_documents()
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(rng.choice([5, 6, 9, 15, 31, 32, 33, 60, 200])))) for i in range(40)]
    items += [(100, "two words"), (101, "Lonely"), (102, ""), (103, None), (104, items[3][1]), (None, items[4][1] + " more")]
    for i in range(150):
        item, text = rng.choice(items[:40])
        w = text.split()
        # some words changed, so containment lies on both sides of the threshold
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = word()
        cut = rng.choice([0, 0, 1, len(w) // 8])
        body = docs[rng.randrange(150)][1] + " " + "  ".join(w[cut:]).upper() + ", " + docs[rng.randrange(150)][1]
        docs.append((20000 + i, body, "en", "src1"))
    docs += [(30000, "These are two words.", "en", "s"), (30001, "lonely", "en", "s")]
    return docs, items


def test_against_plain_python(spark):
    docs, items = planted()
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = decontaminate.contained_items(frame(spark, docs), table).collect()
    want = brute.contained(docs, items)
    mine = Counter((r.doc, r.item, r.shared, r.n) for r in got)
    # rows that repeat id and text give one result
    theirs = Counter({(docs[i][0], docs[i][1], item): (docs[i][0], item, *v) for (i, item), v in want.items()}.values())
    assert mine == theirs and len(mine) > 100


def test_sketch_never_misses(spark):
    """Every set of allowed losses leaves the asked number of hashes."""
    _, items = planted(2)
    grams = decontaminate.item_shingles(spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    sizes = {r["item"]: r.n for r in grams.select("item", "n").distinct().collect()}
    held = Counter(r["item"] for r in decontaminate.sketches(grams).collect())
    need = {r["item"]: r.need for r in decontaminate.sketches(grams).collect()}
    for item, n in sizes.items():
        assert held[item] - int(0.2 * n + 1e-9) >= need[item] >= 1


def test_decision(spark):
    docs, items = planted()
    table = frame(spark, docs)
    kept = decontaminate.without_contained(table, spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    gone = {i for i, _ in brute.contained(docs, items)}
    same = {(docs[i][0], docs[i][1]) for i in gone}
    assert kept.columns == table.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d[0] for d in docs if (d[0], d[1]) not in same)


def test_empty_tables(spark):
    docs, items = planted()
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    assert decontaminate.contained_items(frame(spark, docs).where("false"), table).count() == 0
    assert decontaminate.contained_items(frame(spark, docs), table.where("false")).count() == 0
    assert decontaminate.without_contained(frame(spark, docs), table.where("false")).count() == len(docs)
