"""Documents for the tests: the smallest test table and rows with everything that may go wrong."""

import duckdb

SMALL = "/root/testdata/sf0.001"
# names that the operators use inside
CLASHES = "doc long, t string, body string, hash string, words string, tokens long, h1 long, site string, _key long, _hash long, _c0 string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def small_documents():
    return [tuple(r) for r in duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()]


def odd_documents():
    docs = small_documents()
    long = " ".join(d[1] for d in docs[:60])
    base = max((d[1] for d in docs), key=lambda t: len(set(t.split())))
    near = base.split(" ")
    near[len(near) // 2] = "otherword"
    return [
        (9001, None, "en", "src1"),
        (9002, "", None, "src2"),
        (9003, " \t\n ", "de", None),
        (9004, "...", "en", "src3"),
        (9005, long, "en", "src4"),
        (9006, base, "en", "src5"),
        (9006, base, "en", "src5"),
        (9007, " ".join(near), "en", "src6"),
        (9007, "another text that bears the same id as the one before it", "en", "src6"),
        (None, base + " and one more word", "en", "src7"),
        (None, "a text of a row without id", "fr", None),
        (9008, "word " * 40, "en", "src8"),
        (9009, "two words", "en", "src9"),
        (9010, "Two, words!", "en", "src9"),
    ]


def all_documents():
    return small_documents() + odd_documents()


def frame(spark, docs):
    clashing = (7, "t", "body", "hash", "words", 8, 9, "site", 10, 11, "c")
    return spark.createDataFrame([(*d, len(d[1] or ""), *clashing) for d in docs], DOCS)
