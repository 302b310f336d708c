"""Preparation, metrics, neighbours and explanation."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallyworks.learn import audit, explain, metrics, models, neighbours, prep, search
from tallyworks.plans import learning
from tallyworks.plans.registry import Tables


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x, z, g = rng.uniform(0, 10), rng.uniform(-1, 1), rng.random() < 0.4
        rows.append((i, x, z, float(g), float(x + 3 * g + rng.gauss(0, 1) > 6), g))
    return spark.createDataFrame(rows, "id long, x double, z double, g double, label double, member boolean")


FEATURES = ["x", "z", "g"]


def test_splits_do_not_depend_on_partitions(people, as_rows):
    plain = prep.split(people, "id", 0.25, 3, by="label")
    assert as_rows(plain, "id", "is_test") == as_rows(prep.split(people.repartition(7), "id", 0.25, 3, by="label", parts=9), "id", "is_test")
    shares = plain.groupBy("label").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()
    assert all(0.24 < r["s"] <= 0.25 for r in shares)
    assert 0.2 < prep.split(people, "id", 0.3).agg(F.avg(F.col("is_test").cast("int"))).first()[0] < 0.4


def test_folds_are_even_in_every_class(people):
    counts = prep.folds(people, "id", 5, 1, by="label").groupBy("label", "fold").count().groupBy("label").agg(F.max("count") - F.min("count"))
    assert all(r[1] <= 1 for r in counts.collect())


def test_codes_of_unseen_and_missing(spark, as_rows):
    fit = spark.createDataFrame([("b", 10), ("a", 9)], "s string, n int")
    df = spark.createDataFrame([("a", 10), ("zz", None), (None, 9)], "s string, n int")
    assert as_rows(prep.codes(df, ["s", "n"], fit_on=fit)) == [(-1, -1), (-1, 0), (0, 1)]
    wide = prep.dummies(df, ["s"], fit_on=fit)
    assert wide.columns == ["n", "s_b"] and {r["s_b"] for r in wide.collect()} == {0}


def test_impute(spark, as_rows):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, 4.0, None), (4, 10.0, "b")], "id int, v double, s string")
    assert [r[1] for r in as_rows(prep.impute(df, ["v"], "mean"), "id", "v")] == [1.0, 5.0, 4.0, 10.0]
    assert [r[1] for r in as_rows(prep.impute(df, ["v"], "median"), "id", "v")] == [1.0, 4.0, 4.0, 10.0]
    assert [r[1] for r in as_rows(prep.impute(df, ["s"], "most_frequent"), "id", "s")] == ["a", "a", "a", "b"]


def test_quantile_scaler(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 1, 2, 3, 4, 5, 6, 10]], "v double")
    scaler = prep.QuantileScaler(["v"]).fit(df)
    asked = spark.createDataFrame([(v, v) for v in (-5.0, 0.0, 1.0, 8.0, 10.0, 99.0, None)], "k double, v double")
    got = {r["k"]: r["v"] for r in scaler.transform(asked).collect()}
    assert got[-5.0] == got[0.0] == 0.0 and got[10.0] == got[99.0] == 1.0 and got[None] is None
    assert got[1.0] == pytest.approx(2 / 9) and got[8.0] == pytest.approx(8.5 / 9)


def by_pairs(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y]
    neg = [s for y, s in zip(labels, scores) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("scores", [[0.1, 0.4, 0.4, 0.8, 0.4, 0.9], [0.5] * 6, [1, 0, 1, 0, 1, 1]])
def test_auc_with_ties(spark, scores):
    labels = [0, 0, 1, 1, 1, 0]
    df = spark.createDataFrame([(y, float(s)) for y, s in zip(labels, scores)], "y int, s double")
    assert metrics.auc(df, "y", "s").first()[0] == pytest.approx(by_pairs(labels, scores))
    assert metrics.auc(df, "y", "s", parts=2).first()[0] == pytest.approx(by_pairs(labels, scores))
    last = metrics.roc(df, "y", "s").orderBy("threshold").first()
    assert (last["tpr"], last["fpr"]) == (1.0, 1.0)


def test_auc_without_positives(spark):
    df = spark.createDataFrame([(0, 0.5), (0, 0.7)], "y int, s double")
    assert metrics.auc(df, "y", "s").first()[0] is None


def test_class_report(spark, as_rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    got = {r["class"]: r for r in metrics.class_report(df, "y", "p").collect()}
    assert got["b"]["precision"] == pytest.approx(1 / 3) and got["b"]["recall"] == 1.0 and got["c"]["f1"] == 0.0
    assert got["a"]["support"] == 2


@pytest.mark.parametrize("block_rows", [10, 2000])
def test_neighbours_are_exact(spark, block_rows):
    rng = np.random.default_rng(2)
    spread = rng.normal(size=(150, 3)) * 4
    hot = rng.normal(size=(70, 3)) * 0.1  # a third of all points in one place, with copies
    hot[::7] = hot[0]
    points = np.concatenate([spread, hot]).round(3)
    df = spark.createDataFrame([(i, [float(x) for x in p], i % 4) for i, p in enumerate(points)], "id long, v array<double>, label int")
    train, query = df.where("id % 5 <> 0"), df.where("id % 5 = 0")
    found = neighbours.nearest(train, query, 4, "id", "v", "label", pivots=8, block_rows=block_rows)
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["neighbour"])
    ids = [i for i in range(len(points)) if i % 5]
    for q in range(0, len(points), 5):
        far = {i: round(float(np.sqrt(((points[i] - points[q]) ** 2).sum())), 9) for i in ids}
        assert got[q] == sorted(ids, key=lambda i: (far[i], i))[:4]
    near = neighbours.vote(found, "label", "distance")
    assert near.count() == query.count()


def test_fewer_training_rows_than_k(spark):
    df = spark.createDataFrame([(i, [float(i)], 0) for i in range(3)], "id long, v array<double>, label int")
    found = neighbours.nearest(df, df.where("id = 0"), 10, "id", "v", "label")
    assert [r["neighbour"] for r in found.orderBy("rank").collect()] == [0, 1, 2]


def test_partial_dependence_of_a_sum_is_a_line(people):
    model = SQLTransformer(statement="SELECT *, 2.0D * x + z AS prediction FROM __THIS__")
    out = explain.partial_dependence(model, people, FEATURES, "x", points=5).orderBy("value").collect()
    assert len(out) == 5
    steps = {round((b["mean_answer"] - a["mean_answer"]) / (b["value"] - a["value"]), 6) for a, b in zip(out, out[1:])}
    assert steps == {2.0}


def test_shapley_values_add_up(people):
    train = people.limit(200)
    model = models.fit(models.random_forest(trees=3, depth=3, regression=True), train, FEATURES)
    out = explain.sampled_shapley(model, people, "id", FEATURES, train, ["id"], 3, 2)
    gaps = out.select(F.max(F.abs(F.col("x") + F.col("z") + F.col("g") - F.col("answer") + F.col("base")))).first()[0]
    assert out.count() == 400 and gaps < 1e-9


def test_importance_sums_to_one(people):
    model = models.fit(models.random_forest(trees=4, depth=3), people, FEATURES)
    out = explain.tree_importance(model, FEATURES, people).collect()
    assert sum(r["importance"] for r in out) == pytest.approx(1) and out[0]["feature"] == "x"


def test_audit_proxy_and_steps(people):
    make = lambda: models.decision_tree(depth=3)
    sides = audit.audit_without(make, people, people, "label", FEATURES, "g", F.col("member")).collect()
    assert {r["protected"] for r in sides} == {True, False} and all(r["accuracy_change"] <= 0.001 for r in sides)
    rates, importance = audit.proxy_test(make, people, people, F.col("member"), ["x", "z"])
    assert rates.count() == 1 and importance.count() == 2
    rows = prep.folds(prep.assembler(FEATURES).transform(people), "id", 2)
    tried = search.tune_in_steps(
        models.linear(), [{"regParam": [0.0, 100.0]}, {"elasticNetParam": [0.0, 1.0]}], rows, RegressionEvaluator(labelCol="label"), 2, "fold"
    )
    assert tried[0].getOrDefault("regParam") == 0.0 and len(tried[1]) == 4
    assert len(search.draws(models.linear(), {"regParam": [0.1, 0.2, 0.3]}, 2, 1)) == 2


def test_ridge_classifier_and_early_stopping(people):
    ridge = models.RidgeClassifier("label", FEATURES).fit(people)
    assert metrics.accuracy(ridge.transform(people), F.col("label"), F.col("prediction")).first()[0] > 0.8
    rows = prep.split(people, "id", 0.3, name="held")
    model = models.fit(models.boosted_trees(trees=15, depth=2, rate=0.5, validation="held"), rows, FEATURES)
    assert model.stages[-1].getNumTrees <= 15


def test_prepared_estimator_with_unseen_category(spark):
    train = spark.createDataFrame([(1.0, "a", 1.0), (None, "b", 2.0), (3.0, "a", 3.0), (4.0, None, 4.0)], "v double, c string, label double")
    fitted = prep.prepared_estimator(models.linear(), ["v"], ["c"]).fit(train)
    out = fitted.transform(spark.createDataFrame([(None, "new"), (2.0, "a")], "v double, c string"))
    assert out.count() == 2 and out.where("prediction IS NULL").isEmpty()


def test_nearest_in_a_block_measures_few_rows_and_keeps_ties(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    b = np.concatenate([rng.normal(size=(300, 8)), rng.integers(0, 2, size=(300, 8)).astype("float64")])
    a = np.concatenate([b[:40], b[300:340], rng.normal(size=(20, 8)) * 1e-9 + b[5], np.full((1, 8), np.nan)])
    for few in (a, a[:-1]):
        d = neighbours._distances(few, b).round(9)
        want = d.argsort(axis=1, kind="stable")[:, :5]
        rows, cols, away = neighbours._nearest_of(few, b, 5, rows=16)
        assert rows.tolist() == np.repeat(np.arange(len(few)), 5).tolist() and cols.tolist() == want.ravel().tolist()
        assert np.array_equal(away, d[rows, cols], equal_nan=True)
    # nothing of the size of the block by the block is measured by differences
    monkeypatch.setattr(neighbours, "_distances", None)
    seen, measure = [], neighbours._distances_of
    monkeypatch.setattr(neighbours, "_distances_of", lambda x, y: seen.append(len(x)) or measure(x, y))
    assert len(neighbours._nearest_of(b[:300], b[:300], 5)[0]) == 1500 and sum(seen) < 2000


def test_tree_values_are_made_once_per_cell(spark, monkeypatch):
    leaves = [explain.Leaf(0, [(0, 1.0, True)], 1.0), explain.Leaf(0, [(0, 1.0, False), (1, 5.0, True)], 2.0), explain.Leaf(0, [(0, 1.0, False), (1, 5.0, False)], 4.0)]
    odd = [None, float("nan"), float("inf"), float("-inf"), 1.0, 5.0]
    rows = [(i, i % 7 / 2, float(i % 11)) for i in range(200)] + [(1000 + i, x, y) for i, (x, y) in enumerate(itertools.product(odd, odd))]
    df = spark.createDataFrame(rows, "id int, f0 double, f1 double")
    asked, by_row = [], explain._leaf_values
    monkeypatch.setattr(explain, "_leaf_values", lambda leaves, df, *rest: asked.append(df.count()) or by_row(leaves, df, *rest))
    got = {r.id: tuple(r) for r in explain.leaf_shapley(leaves, df, ["id"], ["f0", "f1"], df).collect()}
    assert len(got) == len(rows) and asked[0] <= 25
    monkeypatch.setattr(explain, "_MOST_CELLS", 0)
    assert got == {r.id: tuple(r) for r in explain.leaf_shapley(leaves, df, ["id"], ["f0", "f1"], df).collect()}


def test_tree_values_equal_all_orders(spark):
    """Random trees of depth 4 over four features; a share is asked of the whole background."""
    rng = random.Random(4)
    names = ["f0", "f1", "f2", "f3"]
    rows = [(i, *(rng.randrange(10) / 2 for _ in names)) for i in range(60)]
    leaves = []

    def grow(tree, path):
        if len(path) == 4 or (path and rng.random() < 0.2):
            leaves.append(explain.Leaf(tree, path, rng.random() * 10, 0.5))
            return
        f, cut = rng.randrange(4), rng.randrange(1, 9) / 2
        grow(tree, [*path, (f, cut, True)])
        grow(tree, [*path, (f, cut, False)])

    grow(0, []), grow(1, [])
    taken = lambda row, path: all((row[1 + f] <= cut) == left for f, cut, left in path)

    def answer(row, known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value * leaf.weight
            for k, (f, cut, left) in enumerate(leaf.path):
                above = [r for r in rows if taken(r, leaf.path[:k])]
                side = sum((r[1 + f] <= cut) == left for r in above) / len(above) if above else 0.0
                part *= float((row[1 + f] <= cut) == left) if f in known else side
            total += part
        return total

    df = spark.createDataFrame(rows, "id int, f0 double, f1 double, f2 double, f3 double")
    got = {r.id: r for r in explain.leaf_shapley(leaves, df, ["id"], names, df).collect()}
    orders = list(itertools.permutations(range(4)))
    for row in rows[:12]:
        for f in range(4):
            want = sum(answer(row, set(o[: o.index(f) + 1])) - answer(row, set(o[: o.index(f)])) for o in orders) / len(orders)
            assert abs(got[row[0]][names[f]] - want) < 1e-9
        assert abs(got[row[0]].base - answer(row, set())) < 1e-9
    assert abs(sum(r.answer for r in got.values()) / len(rows) - got[0].base) < 1e-9


def test_line_folds_keep_what_fits_read(spark, tmp_path):
    """A search copies every fold of its rows, so they hold no other columns."""
    columns = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    items = [(i, 1, float(i % 7), 3.0 * (i % 7) + i % 2, 0.1, 0.0) for i in range(60)] + [(None, 1, 2.0, 6.0, 0.1, 0.0)]
    spark.createDataFrame(items, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = learning._line_rows(Tables(spark, str(tmp_path)))
    assert rows.columns == ["features", "label", "fold"]
    assert sorted((r["features"][0], r["label"]) for r in rows.collect()) == sorted((q, y) for _, _, q, y, _, _ in items)
