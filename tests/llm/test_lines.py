from collections import Counter

import brute
from cases import all_documents, frame

from tallyworks.llm import line_spread


def spread_documents():
    docs = all_documents()
    # a line on 4, 5 and 40 sites, twice on one page, and a page that is copied to many sites
    for n, line in ((4, "on four sites"), (5, " on five sites "), (40, "on forty sites")):
        docs += [(7000 + 100 * n + i, f"first own line {n} {i}\n{line}\n\n{line}\nlast line, own as well {i}", "en", f"s{i}") for i in range(n)]
    docs += [(6000 + i, "a page that is copied\nwith two lines", "en", f"s{i}") for i in range(9)]
    docs += [(6100, "no site here\non five sites", "en", None)]
    # nine tenths of it are boilerplate, and the rest is its own
    docs += [(6200, "own\n" + "on forty sites", "en", "s1")]
    return docs


def test_against_plain_python(spark):
    docs = spread_documents()
    got = line_spread.without_spread_lines(frame(spark, docs))
    assert got.columns == frame(spark, docs).columns
    want = Counter((d[0], text) for d, text in zip(docs, brute.lines(docs)))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert any(t != d[1] for d, t in zip(docs, brute.lines(docs)))


def test_counts(spark):
    docs = spread_documents()
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_spread.without_spread_lines(frame(spark, docs), counts=True).collect()}
    assert got[7400] == (4, 0) and got[7500] == (4, 2) and got[11000] == (4, 2) and got[6200] == (2, 1) and got[6000] == (2, 0) and got[9002] == (0, 0)


def test_coarse_sketches_are_made_exact(spark):
    """With sixteen registers the estimate is rough; lines near the threshold still come out right."""
    docs = [(100 * n + i, f"line {n}\nx{n}.{i}", "en", f"s{i}") for n in range(1, 14) for i in range(n)]
    rows = line_spread.spread_lines(frame(spark, docs), min_sites=7, log_registers=4)
    assert rows.count() == len([n for n in range(1, 14) if n >= 7])


def test_empty_table(spark):
    table = frame(spark, spread_documents()).where("false")
    assert line_spread.without_spread_lines(table, counts=True).count() == 0
