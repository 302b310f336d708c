import random

import numpy as np
import pytest
import xxhash

from tallyworks.llm import queries, url_filter

URLS = [
    None, "", "no address", "://", "http://", "http://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://xexample.org/en/12", "http://org/en/1",
    "http://a.com/de/", "http://a.com/de", "http://com/fr/x", "http://COM?/fr/", "http://a.com#/de/", "ftp://u@b.com:80/de/q", "http://a.org", "x://y://z.org/",
    "http://free-Casino.net/", "http://casinos2.net/", "http://casino.org/", "http://bets.example.com/de/9", "http://ü-spam.net/É?",
    "http://" + "a." * 5000 + "com/de/" + "x" * 100_000, "http://a..org./es/", "http://.org/",
]


def plain(url, rules, words):
    """Host, path, rule and verdict by the words of the contract."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        ends = [i for i, c in enumerate(rest) if c in "/?#"] + [len(rest)]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[: ends[0]])
        path = rest[ends[0] :]
        path = path[: min([i for i, c in enumerate(path) if c in "?#"] + [len(path)])]
    best = None
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or (-len(rule), rule) < (-len(best[0]), best[0])):
            best = (rule, verdict)
    if best:
        return host, path, *best
    tokens = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in host).split()
    return host, path, None, "block" if set(tokens) & set(words) else "allow"


def frame(spark, urls):
    return spark.createDataFrame([(i if i % 7 else None, u, "h", "p", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string, verdict string")


def test_odd_addresses(spark):
    got = url_filter.judged(frame(spark, URLS + URLS[:9]), url_filter.entries(spark, queries.URL_RULES)).collect()
    want = [(i if i % 7 else None, *plain(u, queries.URL_RULES, url_filter.WORDS)) for i, u in enumerate(URLS + URLS[:9])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_random_lists_in_several_volumes(spark):
    rng = random.Random(5)
    host = lambda: ".".join(rng.choice(["a", "b", "c", "dd", "e-f"]) for _ in range(rng.randrange(1, 5)))
    path = lambda: "/" + "/".join(rng.choice(["x", "yy", "z", ""]) for _ in range(rng.randrange(1, 4)))
    rules = list({host() + path(): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    urls = [f"http://{host()}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(1500)]
    got = url_filter.judged(frame(spark, urls), url_filter.entries(spark, rules, ["dd"]), volume_entries=9).collect()
    want = [(i if i % 7 else None, *plain(u, rules, ["dd"])) for i, u in enumerate(urls)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and {r.rule is None for r in got} == {True, False}


def test_collisions_are_told_apart_by_the_strings(tmp_path, monkeypatch):
    """All strings share one hash: only the confirmed ones are found."""
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *_: 7)
    texts = ["/a/", "/b/", "=w"]
    parts = [np.array([3], "<u8"), np.array([7, 7, 7], "<u8"), np.cumsum([0, 3, 3, 2]).astype("<u8"), np.array([0, 1, 1], np.uint8)]
    path = tmp_path / "v"
    path.write_bytes(b"".join(p.tobytes() for p in parts) + "".join(texts).encode())
    assert url_filter.DigestArray([path]).probe(["/b/", "=w", "/a/", "/c/"]).tolist() == [1, 1, 0, -1]


def test_repeated_entries_block_and_large_lists_are_refused(spark):
    listed = spark.createDataFrame([("/a.com/", "allow"), ("/a.com/", "block"), (None, "block")], "entry string, verdict string")
    assert [r.verdict for r in url_filter.judged(frame(spark, ["http://a.com/"]), listed).collect()] == ["block"]
    with pytest.raises(ValueError, match="bound is 1"):
        url_filter.write_list(url_filter.entries(spark, queries.URL_RULES), max_entries=1)


def test_empty(spark):
    none = url_filter.entries(spark, [("a/", "block")]).where("false")
    assert [r.verdict for r in url_filter.judged(frame(spark, ["http://a/"]), none).collect()] == ["allow"]
    assert url_filter.judged(frame(spark, URLS).where("false"), url_filter.entries(spark, queries.URL_RULES)).count() == 0
