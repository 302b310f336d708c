"""Transcripts, relations, tags, graphs, rewards and ingest on small made-up rows."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.functions import text
from tallyworks.functions.scoring import with_scores
from tallyworks.operators.aggs import concat_by
from tallyworks.operators import articles, graph, relations, rewards, transcripts
from tallyworks.plans import graphs
from tallyworks.plans.registry import Tables
from tallyworks.session import new_folder
from tallyworks.streaming import ingest


def test_last_result_first_alternative(spark, as_rows):
    word = lambda w, s, e, tag: {"startTime": s, "endTime": e, "word": w, "speakerTag": tag}
    files = [
        ("f", [{"alternatives": [{"words": [word("no", "0s", "1s", 0)]}]},
               {"alternatives": [{"words": [word("a", "1.500s", "2s", 1), word("b", "2s", "x", 2)]}, {"words": []}]}]),
        ("empty", [{"alternatives": []}]),
        ("none", []),
    ]
    df = spark.createDataFrame(files, f"file string, {transcripts.TRANSCRIPT_DDL}")
    words = transcripts.words_from_transcript(df, ["file"])
    assert as_rows(words, "file", "pos", "word", "speaker", "duration") == [("f", 0, "a", 1, 0.5), ("f", 1, "b", 2, None)]


def test_speaker_runs_and_totals(spark, as_rows):
    rows = [("f", i, w, s, 1.0) for i, (w, s) in enumerate([("a", 1), ("b", 1), ("c", 2), ("d", 1)])]
    df = spark.createDataFrame(rows, "file string, pos int, word string, speaker int, duration double")
    table = transcripts.word_table(df, ["file"], ["pos"])
    runs = transcripts.speaker_runs(table, ["file"], ["pos"])
    assert as_rows(runs, "part", "speaker", "content", "time", "count") == [(1, 1, "a b", 2.0, 2), (2, 2, "c", 1.0, 1), (3, 1, "d", 1.0, 1)]
    totals = transcripts.speaker_totals(df, ["file"], ["pos"], parts=2)
    assert as_rows(totals, "speaker", "content", "count") == [(1, "a b d", 3), (2, "c", 1)]


@pytest.mark.parametrize("n", [0, 1, 29, 30, 31, 65])
def test_windows_and_chunks_as_even_arrays(spark, n):
    words = [f"w{i}" * (1 + i % 3) for i in range(n)]
    line = "  ".join(words)
    df = spark.createDataFrame([(line,)], "t string")
    windows = [r["content"] for r in transcripts.text_windows(df, [], "t").orderBy("window").collect()]
    assert windows == [" ".join(p) for p in np.array_split(words, 30)]
    chunks = [r["content"] for r in transcripts.text_chunks(df, [], "t", 50).orderBy("chunk").collect()]
    k = -(-len(line) // 50)
    assert chunks == ([" ".join(p) for p in np.array_split(words, k)] if k > 1 else [line])


@pytest.mark.parametrize("parts", [1, 20])
def test_word_rows_are_cut_like_texts(spark, as_rows, parts):
    rng = random.Random(4)
    texts = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(n))) for i, n in enumerate([1, 29, 30, 31, 200])]
    df = spark.createDataFrame(texts, "id int, t string")
    said = df.select("id", F.posexplode(F.split("t", " ")).alias("pos", "word"))
    chunks = transcripts.word_chunks(said, ["id"], ["pos"], size=50, parts=parts)
    assert as_rows(chunks, "id", "chunk", "content") == as_rows(transcripts.text_chunks(df, ["id"], "t", 50))
    windows = concat_by(transcripts.word_windows(said, ["id"], ["pos"], 30, parts), ["id", "window"], "word", ["pos"])
    want = transcripts.text_windows(df, ["id"], "t").where("content <> ''")
    assert as_rows(windows, "id", "window", "content") == as_rows(want)


TAGGED = {
    "<s><triplet> A b <subj> C <obj> is <subj> D <obj> has</s>": [("A b", "is", "C"), ("A b", "has", "D")],
    "<s><triplet> A <subj> A <obj> is <triplet> B <subj> C <obj> of<pad>": [("A", "is", "A"), ("B", "of", "C")],
    "<triplet> A <subj> C <obj> is <subj> D": [("A", "is", "C"), ("A", "is", "D")],
    "<triplet> A <subj> C <obj> is <triplet> B <subj> D": [("A", "is", "C")],
    "<triplet> A <subj>": [],
    "words only": [],
    "": [],
}


def test_tagged_triples(spark):
    df = spark.createDataFrame([(t,) for t in TAGGED], "t string")
    got = [[tuple(x) for x in r[0]] for r in df.select(text.tagged_triples(F.col("t"))).collect()]
    assert got == list(TAGGED.values())
    kept = relations.parse_triples(df, ["t"], "t")
    assert kept.where("head = tail").isEmpty() and kept.count() == 6


def pairs_by_brute_force(sentence, terms, rules):
    """All pairs of terms of a sentence, one regex after the other."""
    found = sorted({t for t in terms if re.search(rf"\b{t}\b", sentence)}, key=len, reverse=True)
    out = set()
    for a, b in itertools.combinations(found, 2):
        marked = sentence.replace(a, "NP__").replace(b, "NP__")
        if any(re.search(p, marked) for p, _ in rules):
            out.add(frozenset((a, b)))
    return out


def test_neighbours_find_what_all_pairs_find(spark):
    from tallyworks.functions.fixed_values import IS_A_RULES

    rng = random.Random(1)
    terms = ["cat", "dog", "ferret", "animal", "plant", "moss"]
    cues = ["such as", "and other", "or some other", "include", "like", "which be call", "near", "beside", "for example"]
    lines = []
    for _ in range(60):
        picked = rng.sample(terms, rng.randint(2, 4))  # each term once: see the operator's note on pairs
        line = "the "
        for i, term in enumerate(picked):
            line += term + (f" {rng.choice(cues)} " if i + 1 < len(picked) else " end")
        lines.append(line)
    df = spark.createDataFrame(list(enumerate(lines)), "id int, sentence string")
    dim = spark.createDataFrame([(t,) for t in terms], "term string")
    found = relations.pattern_relations(df, ["id"], relations.mentions(df, ["id"], dim))
    got = {(r["id"], frozenset((r["head"], r["tail"]))) for r in found.collect()}
    want = {(i, p) for i, line in enumerate(lines) for p in pairs_by_brute_force(line, terms, IS_A_RULES)}
    assert got == want and len(want) > 20


def test_all_pairs_of_long_sentences(spark):
    """Repeated terms, terms inside words, terms that are words of a phrase, and several terms in between."""
    from tallyworks.functions.fixed_values import IS_A_RULES

    rng = random.Random(7)
    terms = ["a", "an", "cat", "cats", "big cats", "other", "and", "include", "such", "as", "like", "s", "dog", "kind of", "any", "té", "i"]
    words = terms + ["other", "such as", "include", ",", "and", "or some", "like", "catsuit", "another", "type", "be a", "for example", "café", "x", "a  kind of"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.choice([4, 9, 25]))).replace(" ,", ",") for _ in range(150)]
    small = [("NP__ (of|the|and|on) NP__", "first"), ("NP__,? NP__", "last")]
    df = spark.createDataFrame(list(enumerate(lines)), "id int, sentence string")
    places = relations.mentions(df, ["id"], spark.createDataFrame([(t,) for t in terms], "term string"), longest=2)
    found = {}
    for r in places.collect():
        found.setdefault(r.id, {}).setdefault(r.term, set()).add(r.pos)
    for rules in (IS_A_RULES, small):
        got = {(r["id"], frozenset((r["head"], r["tail"]))) for r in relations.pattern_relations(df, ["id"], places, rules=rules).collect()}
        want = set()
        for i, line in enumerate(lines):
            for x, y in itertools.combinations(sorted(found.get(i, ()), key=lambda t: -len(t)), 2):
                marked = line.replace(x, "NP__").replace(y, "NP__")
                if any(re.search(p, marked, re.ASCII) for p, _ in rules):
                    want.add((i, frozenset((x, y))))
        # terms of one length may be marked in either order
        assert {w for w in got ^ want if len({len(t) for t in w[1]}) == 2} == set() and len(want) > 50


def test_pairs_carry_the_words_around_a_phrase_only():
    """A sentence of n words hands on about n short parts; whole sentences would be n squared."""
    import pyarrow as pa

    small = [("NP__ (of|the|and|on) NP__", "first"), ("NP__,? NP__", "last")]
    terms = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    handed = []
    for n in (300, 600):
        batch = pa.record_batch({"id": [1], "__s": [" ".join(terms[:n])], "__t": [terms[:n]]})
        out = next(relations._candidates(small)(iter([batch])))
        assert out.num_rows == n - 1
        handed.append(sum(len(s) for s in out.column("__s").to_pylist()))
    assert handed[1] < 2.1 * handed[0]


def test_a_word_of_a_phrase_may_be_a_term(spark, as_rows):
    df = spark.createDataFrame([(1, "Vehicles include cars")], "id int, sentence string")
    dim = spark.createDataFrame([("vehicles",), ("cars",), ("include",)], "term string")
    assert as_rows(relations.pattern_relations(df, ["id"], relations.mentions(df, ["id"], dim)), "head", "tail") == [("cars", "vehicles")]


def test_relation_direction(spark, as_rows):
    df = spark.createDataFrame([(1, "Animals such as cats sleep"), (2, "cats and other animals")], "id int, sentence string")
    dim = spark.createDataFrame([("animals",), ("cats",)], "term string")
    places = relations.mentions(df, ["id"], dim)
    assert as_rows(relations.pattern_relations(df, ["id"], places), "id", "head", "tail") == [(1, "cats", "animals"), (2, "cats", "animals")]
    loose = relations.pattern_relations(df, ["id"], places, strict=False)
    assert as_rows(loose, "head", "tail") == [("cats", "animals"), ("cats", "animals")]


def test_tags(spark, as_rows):
    arts = spark.createDataFrame([("x",), ("y",)], "article_id string")
    tokens = spark.createDataFrame([("x", 1, "▁Tro"), ("x", 2, "jan"), ("x", 9, "▁Trojan")], "article_id string, index long, word string")
    assert as_rows(articles.tag_table(arts, tokens)) == [("x", "Trojan"), ("y", "tagless")]


def test_geo_tags_keep_two_words_of_one_country(spark, as_rows):
    found = [("x", "Germans", "NORP"), ("x", "Germany", "GPE"), ("x", "Berlin", "GPE"), ("x", "France", "PERSON")]
    entities = spark.createDataFrame(found, "article_id string, entity string, label string")
    demonyms = spark.createDataFrame([("German", "Germany")], "demonym string, country string")
    countries = spark.createDataFrame([("Germany", "DE"), ("France", "FR")], "country string, code string")
    assert as_rows(articles.geo_tags(entities, demonyms, countries)) == [("x", "DE"), ("x", "DE")]
    assert as_rows(articles.geo_tags(entities, demonyms, countries, dedupe=True)) == [("x", "DE")]


def test_mentions_of_several_words(spark, as_rows):
    df = spark.createDataFrame([(1, "Deep neural network, a neural network."), (2, "net")], "id int, sentence string")
    dim = spark.createDataFrame([("neural network",), ("deep neural network",), ("net",)], "term string")
    assert as_rows(relations.mentions(df, ["id"], dim, 3), "id", "pos", "term") == [
        (1, 0, "deep neural network"), (1, 1, "neural network"), (1, 4, "neural network"), (2, 0, "net")
    ]


def hierarchy_by_hand(edges, root):
    """Level by level over plain dictionaries."""
    out = {}
    for a, b in edges:
        if a != b and a != root:
            out.setdefault(a, set()).add(b)
    placed, frontier, level = {root: (None, 1)}, {root}, 1
    while frontier:
        level += 1
        met = {a: min(out[a] & frontier) for a in out if a not in placed and out[a] & frontier}
        sets = {}
        for a, p in met.items():
            sets.setdefault(p, set()).add(a)
        falling = {}
        for group in sets.values():
            one_way = {a: {b for b in out[a] & group if a not in out.get(b, ())} for a in group}
            one_way = {a: t for a, t in one_way.items() if t}
            reach = {}
            for a in one_way:
                seen, stack = set(), [a]
                while stack:
                    for b in one_way.get(stack.pop(), ()):
                        if b not in seen:
                            seen.add(b)
                            stack.append(b)
                reach[a] = seen
            rings = {frozenset({b for b in reach[a] if a in reach.get(b, ())}) for a in one_way if a in reach[a]}
            closed = [r for r in rings if all(reach[x] <= r for x in r)]
            keep = {min(r) for r in closed}
            falling.update({a: t for a, t in one_way.items() if a not in keep})
        frontier = set(met) - set(falling)
        placed.update({a: (met[a], level) for a in frontier})
        out.update({a: set(t) for a, t in falling.items()})
    return {(n, p, lv) for n, (p, lv) in placed.items()}


CASES = {
    "worked": [("p", "r0"), ("q", "r0"), ("r", "r0"), ("r", "p")],
    "mutual": [("a", "r0"), ("b", "r0"), ("a", "b"), ("b", "a"), ("r0", "a")],
    "chain": [("a", "r0"), ("b", "r0"), ("c", "r0"), ("a", "b"), ("b", "c")],
    "ring": [("a", "r0"), ("b", "r0"), ("c", "r0"), ("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("z", "r0"), ("z", "b")],
    "two_rings": [(x, "r0") for x in "abcdefg"] + [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "e"), ("f", "g"), ("g", "e")],
    "rings_of_rings": [(x, "r0") for x in "abcdefgh"] + [("b", "c"), ("c", "d"), ("d", "b"), ("d", "e"), ("e", "f"), ("f", "c"), ("h", "g"), ("g", "a"), ("a", "h"), ("a", "b")],
    "open_ring": [(x, "r0") for x in "abcs"] + [("a", "b"), ("b", "c"), ("c", "a"), ("c", "s"), ("w", "a")],
    "outside": [("a", "r0"), ("b", "r0"), ("x", "a"), ("y", "b"), ("x", "y"), ("x", "b"), ("iso", "far")],
}


@pytest.mark.parametrize("case", CASES)
def test_hierarchy_cases(spark, as_rows, case):
    df = spark.createDataFrame(CASES[case], "head string, tail string")
    got = {tuple(r) for r in graph.build_hierarchy(df, "r0").select("node", "parent", "level").collect()}
    assert got == hierarchy_by_hand(CASES[case], "r0")
    if case == "worked":
        assert got == {("r0", None, 1), ("p", "r0", 2), ("q", "r0", 2), ("r", "p", 3)}


@pytest.mark.parametrize("seed", range(3))
def test_random_hierarchies(spark, seed):
    rng = random.Random(seed)
    names = ["r0"] + [f"n{i:02d}" for i in range(14)]
    edges = [(a, "r0") for a in names[1:] if rng.random() < 0.6]
    edges += [tuple(rng.sample(names, 2)) for _ in range(14)]
    df = spark.createDataFrame(edges, "head string, tail string")
    placed = graph.build_hierarchy(df, "r0")
    assert {tuple(r) for r in placed.select("node", "parent", "level").collect()} == hierarchy_by_hand(edges, "r0")
    below = {r["node"]: r["level"] for r in placed.collect()}
    left = graph.hierarchy_edges(placed).collect()
    assert all(below[r["head"]] == below[r["tail"]] + 1 for r in left)


@pytest.mark.parametrize("query", ["g08_hierarchy", "g08_hierarchy_of_chains"])
def test_registered_hierarchy_by_hand(spark, query):
    tables = Tables(spark, "/root/testdata/sf0.001")
    if query == "g08_hierarchy":
        edges, root, placed = graphs.places(tables), "world", graphs.g08(tables)
    else:
        edges, root, placed = graphs.item_chains(tables), "all", graphs.g08_chains(tables)
    want = hierarchy_by_hand([tuple(r) for r in edges.select("head", "tail").collect()], root)
    assert {tuple(r) for r in placed.select("node", "parent", "level").collect()} == want


def test_long_chain_and_ring_of_siblings(spark):
    """Logarithmic rounds: a visit per level would take a thousand steps."""
    n, m = 1000, 40
    edges = [(f"x{i:04d}", "r") for i in range(n)] + [(f"x{i:04d}", f"x{i + 1:04d}") for i in range(n - 1)]
    edges += [(f"y{i:02d}", "r") for i in range(m)] + [(f"y{i:02d}", f"y{(i + 1) % m:02d}") for i in range(m)]
    placed = graph.build_hierarchy(spark.createDataFrame(edges, "head string, tail string"), "r")
    want = {("r", None, 1), ("y00", "r", 2)} | {(f"x{i:04d}", f"x{i + 1:04d}", n - i + 1) for i in range(n - 1)}
    want |= {(f"x{n - 1:04d}", "r", 2)} | {(f"y{i:02d}", f"y{(i + 1) % m:02d}", m - i + 2) for i in range(1, m)}
    assert {tuple(r) for r in placed.select("node", "parent", "level").collect()} == want


def test_hierarchy_of_nothing_and_of_null_ends(spark):
    df = spark.createDataFrame([("a", None), (None, "r"), ("b", "b"), ("p", "q"), ("q", "p"), ("s", "p")], "head string, tail string")
    for rows in (df, df.where("false")):
        assert [tuple(r) for r in graph.build_hierarchy(rows, "r").collect()] == [("r", None, 1)]


def test_chains_of_siblings_are_stored_a_few_times(spark, monkeypatch):
    """Short chains below many parents: less than four rows are stored on the way for an edge."""
    edges = [(f"l{o:05d}-{k}", f"o{o:05d}") for o in range(1000) for k in range(1, 6)] + [(f"o{o:05d}", "all") for o in range(1000)]
    edges += [(f"l{o:05d}-{k}", f"l{o:05d}-{k - 1}") for o in range(1000) for k in range(1, 6)]
    stored, kept = [], graph.cut_lineage

    def counting(df):
        stored.append(kept(df))
        return stored[-1]

    monkeypatch.setattr(graph, "cut_lineage", counting)
    placed = graph.build_hierarchy(spark.createDataFrame(edges + edges[:500], "head string, tail string"), "all")
    want = {("all", None, 1)} | {(f"o{o:05d}", "all", 2) for o in range(1000)}
    want |= {(f"l{o:05d}-{k}", f"l{o:05d}-{k - 1}" if k > 1 else f"o{o:05d}", k + 2) for o in range(1000) for k in range(1, 6)}
    rows = [tuple(r) for r in placed.collect()]
    assert len(rows) == len(want) and set(rows) == want
    assert sum(df.count() for df in stored) < 4 * len(edges)


def test_levels_take_the_shortest_way(spark, as_rows):
    edges = [("a", "r"), ("b", "a"), ("c", "b"), ("c", "r"), ("r", "c"), ("x", "y"), ("d", "c")]
    df = spark.createDataFrame(edges, "head string, tail string")
    assert as_rows(graph.levels(df, "r")) == [("a", 2), ("b", 3), ("c", 2), ("d", 3), ("r", 1)]


def test_edges_are_linked_and_kept_once(spark, as_rows):
    triples = [("BERT", "is", "Model", 1), ("bert", "uses", "model", 2), ("Bidirectional", "of", "model", 3), ("x", "t", "X", 0)]
    df = spark.createDataFrame(triples, "head string, type string, tail string, ord int")
    synonyms = spark.createDataFrame([("bidirectional", "bert")], "synonym string, entity_id string")
    edges = graph.canonical_edges(df, synonyms, ["ord"])
    assert as_rows(edges) == [("bert", "is", "model"), ("x", "t", "x")]
    extra = spark.createDataFrame([("alone",), ("bert",)], "node string")
    nodes = graph.nodes(edges, extra)
    assert as_rows(graph.degrees(nodes, edges)) == [("alone", 0, 0), ("bert", 0, 1), ("model", 1, 0), ("x", 1, 1)]
    assert [r["node"] for r in graph.root_candidates(nodes, edges, 2).collect()] == ["model", "x"]


def test_hub_has_a_row_per_neighbour(spark, as_rows):
    df = spark.createDataFrame([("hub", f"n{i:02d}") for i in range(50)] * 2 + [("small", "n1")], "head string, tail string")
    rows = as_rows(graph.adjacency(df), "node", "position", "neighbour")
    assert rows == [("hub", i + 1, f"n{i:02d}") for i in range(50)] + [("small", 1, "n1")]


def test_later_triples_and_same_root(spark, as_rows):
    first = spark.createDataFrame([("p", "is", "top", 1), ("q", "is", "top", 2), ("r", "is", "top", 3)], "head string, type string, tail string, ord int")
    more = spark.createDataFrame([("r", "part of", "p", 1), ("p", "again", "top", 2)], first.schema)
    none = spark.createDataFrame([], "synonym string, entity_id string")
    edges, placed = graph.extend(first, more, none, "top")
    assert ("p", "is", "top") in as_rows(edges)
    assert as_rows(placed, "node", "level") == [("p", 2), ("q", 2), ("r", 3), ("top", 1)]


@pytest.fixture(scope="module")
def log(spark):
    table = [[1.0, 2.0, 5.0, 1.0, 1.0, 1.0], [2.0, 5.0, 1.0, 3.0, 3.0, 3.0], [0.0, 0.0, 5.0, 9.0, 0.0, 0.0]]
    return spark.createDataFrame([(0, d, a, r) for a, days in enumerate(table) for d, r in enumerate(days)], "run int, day int, arm int, reward double")


def test_commit_takes_the_first_best(log, as_rows):
    chosen = rewards.replay_commit(log, 3)
    assert as_rows(chosen, "day", "arm") == [(0, 0), (1, 1), (2, 2), (3, 1), (4, 1), (5, 1)]
    regret = rewards.regret(chosen, log, 1).first()
    assert (regret["best"], regret["collected"], regret["regret"]) == (17.0, 20.0, -3.0)
    assert as_rows(rewards.cumulative(chosen, parts=2), "day", "collected")[-1] == (5, 20.0)


def test_scores_with_an_arm_not_tried(log, as_rows):
    chosen = log.where("arm < 2 AND day < 2")
    scores = {r["arm"]: r for r in rewards.ucb_scores(chosen, 3, 4).collect()}
    assert scores[2]["bound"] == float("inf") and scores[2]["chosen"]
    assert scores[0]["bound"] == pytest.approx(1.5 + (2 * np.log(4) / 2) ** 0.5)
    assert as_rows(rewards.greedy_arm(chosen), "arm", "mean") == [(1, 3.5)]
    after = {r["arm"]: r for r in rewards.posterior(chosen, 3).collect()}
    assert after[0]["variance"] == pytest.approx(1 / (1e-4 + 2)) and after[2]["mean"] == 0.0


def test_uniform_replay_is_stable(log, as_rows):
    assert as_rows(rewards.replay_uniform(log, 3, 1)) == as_rows(rewards.replay_uniform(log.repartition(5), 3, 1))
    assert rewards.replay_uniform(log, 3, 1).count() == 6


def test_ingest_overlap_and_rerun(spark, as_rows):
    source, target, state = (new_folder(spark, n) for n in ("drop", "target", "state"))
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "key string, ord int")
    for drop in (df, df.union(spark.createDataFrame([("c", 4)], df.schema)), None):
        if drop is not None:
            drop.write.mode("append").parquet(source)
        ingest.ingest_stream(spark, source, df.schema, target, "key", ["ord"], state).awaitTermination()
    assert as_rows(spark.read.parquet(target)) == [("a", 1), ("b", 2), ("c", 4)]
    # the same files with a new checkpoint, as after a lost one: nothing is added
    ingest.ingest_stream(spark, source, df.schema, target, "key", ["ord"], new_folder(spark, "state")).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_fan_out_completes_a_stopped_batch(spark, as_rows):
    source, main, tags, state = (new_folder(spark, n) for n in ("drop", "main", "tags", "state"))
    df = spark.createDataFrame([("a", "x y"), ("b", "z")], "key string, words string")
    df.write.parquet(source)
    df.write.parquet(main)  # a run that stopped after its first write
    rows = lambda d: d.select("key", F.explode(F.split("words", " ")).alias("tag"))
    for checkpoint in (state, new_folder(spark, "state")):
        ingest.fan_out_stream(spark, source, df.schema, (main, lambda d: d), {tags: rows}, "key", ["words"], checkpoint).awaitTermination()
    assert spark.read.parquet(main).count() == 2
    assert as_rows(spark.read.parquet(tags)) == [("a", "x"), ("a", "y"), ("b", "z")]


def test_fan_out_leaves_nothing_of_dropped_copies(spark, as_rows):
    source, main, tags, state = (new_folder(spark, n) for n in ("drop", "main", "tags", "state"))
    rows = lambda d: d.select("key", F.explode(F.filter(F.split("words", " "), lambda w: w != "")).alias("tag"))
    drops = [[("a", 2, "z"), ("a", 1, "x y"), ("b", 1, "")], [("a", 3, "q"), ("b", 2, "late"), ("c", 1, "new")]]
    for drop in drops:
        df = spark.createDataFrame(drop, "key string, ord int, words string")
        df.coalesce(1).write.mode("append").parquet(source)
        ingest.fan_out_stream(spark, source, df.schema, (main, lambda d: d), {tags: rows}, "key", ["ord"], state).awaitTermination()
    assert as_rows(spark.read.parquet(main), "key", "ord") == [("a", 1), ("b", 1), ("c", 1)]
    assert as_rows(spark.read.parquet(tags)) == [("a", "x"), ("a", "y"), ("c", "new")]


def test_scorer_slot(spark, as_rows):
    def make():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], dtype="float64")

    df = spark.createDataFrame([("banana",), ("x",)], "t string")
    assert as_rows(with_scores(df, "t", make, ["n", "a"])) == [("banana", 6.0, 3.0), ("x", 1.0, 0.0)]


def test_lexicon_scores_without_a_listed_word(spark, as_rows):
    chunks = spark.createDataFrame([(1, "Good good bad"), (2, "nothing"), (3, "")], "id int, content string")
    lexicon = spark.createDataFrame([("good", "joy", 1), ("bad", "fear", 2)], "word string, label string, weight int")
    out = transcripts.lexicon_scores(chunks, ["id"], lexicon, ["joy", "fear"])
    assert as_rows(out) == [(1, 0.5, 0.5), (2, 0.0, 0.0), (3, 0.0, 0.0)]
