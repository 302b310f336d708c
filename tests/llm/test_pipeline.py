from collections import Counter

import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cases import SMALL
from compare import compare, database


def plain_pipeline(folder):
    docs = [tuple(r) for r in duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()]
    items = duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    kept = brute.quality(docs)
    docs = [d for i, d in enumerate(docs) if kept[i][3]]
    docs = [(d[0], t, *d[2:]) for d, t in zip(docs, brute.lines(docs))]
    docs = [d for d, c in zip(docs, brute.classes(docs)) if d[0] == c]
    gone = {i for i, _ in brute.contained(docs, items)}
    docs = [d for i, d in enumerate(docs) if i not in gone]
    return brute.mixture(docs)


def test_against_plain_python(spark):
    got = corpus_pipeline.run(spark, SMALL).collect()
    want = plain_pipeline(SMALL)
    assert Counter((r.doc_id, r.source, r["pass"], r.block, r.place, r.tokens) for r in got) == Counter(want)


def test_stages(spark):
    """All but the last stage keep the columns of documents; each lets something go."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.dtypes, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "test-stage")
        assert docs.dtypes == columns
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2] and counts[4] < counts[3]


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({int(n[2:].split("_")[0]) for n in names if n != "pipeline"}) == list(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_sql(spark, name):
    ok, note = compare(spark, database(SMALL), SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note
