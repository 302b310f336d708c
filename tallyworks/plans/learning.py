"""Queries on preparation, models, quality, explanation and audit."""

import itertools

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tallyworks.functions.text import words
from tallyworks.learn import audit, explain, metrics, models, neighbours, prep, search
from tallyworks.operators.aggs import confusion
from tallyworks.operators.frame import bin_by
from tallyworks.plans.frame import LABELLED, labelled
from tallyworks.plans.registry import query
from tallyworks.plans.summaries import SCORED, confusion_sql, scored
from tallyworks.session import cut_lineage, new_folder
from tallyworks.sources import files

DRAW = "('0x' || substr(md5({0} || '-' || {1}), 1, 8))::BIGINT"


@query("m01_split", f"SELECT o_orderkey, {DRAW.format('o_orderkey', 7)} < {int(0.3 * 2**32)} AS is_test FROM orders")
def m01(t):
    return prep.split(t.orders.select("o_orderkey"), "o_orderkey", 0.3, 7)


@query(
    "m02_stratified_split",
    f"""SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {DRAW.format('doc_id', 7)}, doc_id) <= 0.25 * count(*) OVER (PARTITION BY quality) AS is_test FROM labels""",
)
def m02(t):
    return prep.split(t.labels.select("doc_id", "quality"), "doc_id", 0.25, 7, by="quality")


@query(
    "m03_separate",
    f"SELECT 'known' AS part, count(*) AS n FROM {LABELLED} WHERE quality IS NOT NULL UNION ALL SELECT 'open', count(*) FROM {LABELLED} WHERE quality IS NULL",
)
def m03(t):
    known, rest = prep.separate(labelled(t), "quality")
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return count(known, "known").unionByName(count(rest, "open"))


_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "m04_dummies",
    "SELECT c_custkey, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS c_mktsegment_{s}" for s in _SEGMENTS)
    + " FROM customer",
)
def m04(t):
    return prep.dummies(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query(
    "m05_one_hot",
    """SELECT p_type, 1 + (p_type <> 'PROMO')::INT AS slots_on, p_type = 'PROMO' AS unknown FROM (SELECT DISTINCT p_type FROM part)""",
)
def m05(t):
    """Types other than PROMO are fitted; each row sets its own slot, an unknown one none of them."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from pyspark.ml.functions import vector_to_array

    stages = [
        StringIndexer(inputCol="p_type", outputCol="i", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="i", outputCol="v", handleInvalid="keep", dropLast=True),
    ]
    fitted = Pipeline(stages=stages).fit(t.part.where("p_type <> 'PROMO'"))
    hot = fitted.transform(t.part.select("p_type")).withColumn("a", vector_to_array("v"))
    known = F.aggregate(F.slice("a", 1, F.size("a") - 1), F.lit(0.0), lambda s, x: s + x)
    return hot.groupBy("p_type").agg((F.max(known) + 1).cast("int").alias("slots_on"), (F.max(known) == 0).alias("unknown"))


@query(
    "m06_codes",
    "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type, CAST(dense_rank() OVER (ORDER BY p_size) - 1 AS INTEGER) AS p_size FROM part",
)
def m06(t):
    return prep.codes(t.part.select("p_partkey", "p_type", "p_size"), ["p_type", "p_size"])


@query(
    "m07_impute_mean",
    f"SELECT doc_id, round(coalesce(quality, avg(quality) OVER ()), 6) AS quality, round(coalesce(toxic, avg(toxic) OVER ()), 6) AS toxic FROM {LABELLED}",
)
def m07(t):
    out = prep.impute(labelled(t).select("doc_id", "quality", "toxic"), ["quality", "toxic"], "mean")
    return out.withColumns({c: F.round(c, 6) for c in ("quality", "toxic")})


@query(
    "m07_impute_median_and_mode",
    f"""SELECT doc_id, coalesce(quality, (SELECT quantile_cont(quality, 0.5) FROM labels))::DOUBLE AS quality,
coalesce(toxic, (SELECT mode(toxic) FROM labels)) AS toxic FROM {LABELLED}""",
)
def m07_other(t):
    out = prep.impute(labelled(t).select("doc_id", "quality", "toxic"), ["quality"], "median")
    return prep.impute(out, ["toxic"], "most_frequent")


@query(
    "m09_quantile_scaler",
    """WITH m AS (SELECT v AS raw, min(i) / 199.0 AS lo, max(i) / 199.0 AS hi FROM (SELECT unnest(range(200)) AS i, unnest(q) AS v FROM (
SELECT quantile_cont(l_quantity, list_transform(range(200), lambda i: i / 199.0::DOUBLE)) AS q FROM lineitem)) GROUP BY 1)
SELECT raw, round(s, 6) AS lowest, round(s, 6) AS highest FROM (SELECT raw, CASE WHEN lo = 0 THEN 0 WHEN hi = 1 THEN 1 ELSE (lo + hi) / 2 END::DOUBLE AS s FROM m
WHERE raw IN (SELECT l_quantity FROM lineitem))""",
)
def m09(t):
    """Per quantity: its scaled place; rises with the quantity from 0 to 1."""
    rows = t.lineitem.select("l_quantity", "l_extendedprice")
    scaler = prep.QuantileScaler(["l_quantity"], 200).fit(rows)
    scaled = scaler.transform(rows.select("l_quantity", F.col("l_quantity").alias("raw")))
    ends = {"lowest": F.min("l_quantity"), "highest": F.max("l_quantity")}
    return scaled.groupBy("raw").agg(*[F.round(c, 6).alias(n) for n, c in ends.items()])


_FEATURES = ["n_chars", "n_words", "n_digits", "lang_code", "source_code"]


def learning_base(t, label="quality"):
    """Labelled documents with numeric features; stored once, as every fit reads it many times."""
    docs = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", "source", "n_chars",
        F.size(words(F.col("text"))).alias("n_words"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).alias("n_digits"),
        F.col(label).alias("label"),
        (F.col("lang") == "en").alias("member"),
    )
    coded = docs.withColumns(
        {
            "lang_code": F.array_position(F.array(*[F.lit(v) for v in ("de", "en", "es", "fr")]), F.col("lang")).cast("double"),
            "source_code": F.regexp_extract("source", "([0-9]+)", 1).cast("double"),
        }
    ).withColumns({c: F.col(c).cast("double") for c in ("n_chars", "n_words", "n_digits", "label")})
    return cut_lineage(coded)


def _halves(t, label="quality"):
    rows = prep.split(learning_base(t, label), "doc_id", 0.3, 11)
    return rows.where("NOT is_test"), rows.where("is_test")


def _classifier_report(model, test):
    """Held-out accuracy and area under the curve with the numbers of rows."""
    out = model.transform(test)
    both = metrics.accuracy(out, F.col("label"), F.col("prediction"))
    return both.withColumn("n", F.lit(test.count()))


@query("m08_prepared_elastic_net")
def m08(t):
    rows = labelled(t).withColumn("label", F.col("n_chars").cast("double"))
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("quality", "toxic")})
    estimator = models.elastic_net(alpha=1.0, l1_ratio=0.5)
    fitted = prep.prepared_estimator(estimator, ["quality", "toxic"], ["lang", "source"]).fit(rows)
    return fitted.transform(rows).select("doc_id", F.round("prediction", 3).alias("prediction"))


@query(
    "m10_linear_regression",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept FROM lineitem",
)
def m10(t):
    model = models.fit(models.linear("l_extendedprice"), t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity"])
    last = model.stages[-1]
    return t.spark.createDataFrame(
        [(round(float(last.coefficients[0]), 2), round(float(last.intercept), 1))], "slope double, intercept double"
    )


_PRICE = ["l_quantity", "l_discount", "l_tax"]


def _price_rows(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", *_PRICE, F.col("l_extendedprice").alias("label"))


@query("m11_lasso")
def m11(t):
    """Explained variance of least squares, lasso and elastic net on the same rows: never rises."""
    rows, out = _price_rows(t), None
    for name, est in (
        ("linear", models.linear()), ("lasso", models.lasso()), ("elastic_net", models.elastic_net(alpha=1.0, l1_ratio=0.5)),
    ):
        r2 = metrics.r2(models.fit(est, rows, _PRICE).transform(rows), F.col("label"), F.col("prediction"))
        one = r2.select(F.lit(name).alias("model"), F.round("r2", 6).alias("r2"))
        out = one if out is None else out.unionByName(one)
    return out


_MOMENTS = """(SELECT covar_pop(l_extendedprice, l_quantity) AS c, var_pop(l_quantity) AS vx, var_pop(l_extendedprice) AS vy,
var_samp(l_quantity) AS sx2, stddev_samp(l_extendedprice) AS sy FROM lineitem)"""


@query(
    "m11_lasso_one_feature",
    f"""SELECT penalty, round(w, 1) AS slope, round((2 * w * c - w * w * vx) / vy, 4) AS r2 FROM (SELECT *, sign(c) * greatest(abs(c) - penalty, 0) / vx AS w
FROM {_MOMENTS}, (VALUES (1.0::DOUBLE), (200.0::DOUBLE)) AS v(penalty))""",
)
def m11_one(t):
    """One feature has a closed form: the covariance is shortened by the penalty."""
    rows, out = _price_rows(t), None
    for penalty in (1.0, 200.0):
        model = models.fit(models.lasso(alpha=penalty), rows, ["l_quantity"])
        r2 = metrics.r2(model.transform(rows), F.col("label"), F.col("prediction"))
        one = r2.select(
            F.lit(penalty).alias("penalty"), F.lit(round(float(model.stages[-1].coefficients[0]), 1)).alias("slope"), F.round("r2", 4).alias("r2")
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "m12_elastic_net_one_feature",
    f"""SELECT round(sign(c) * greatest(abs(c) / sqrt(sx2) - 20.0 * 0.5, 0) / (vx / sx2 + 20.0 * 0.5 / sy) / sqrt(sx2), 2) AS slope FROM {_MOMENTS}""",
)
def m12_one(t):
    """On scaled features the absolute part shortens the covariance, the squared part adds to the variance."""
    model = models.fit(models.elastic_net(alpha=20.0, l1_ratio=0.5).setTol(1e-9), _price_rows(t), ["l_quantity"])
    return t.spark.createDataFrame([(round(float(model.stages[-1].coefficients[0]), 2),)], "slope double")


@query("m12_elastic_net")
def m12(t):
    rows = _price_rows(t)
    model = models.fit(models.elastic_net(alpha=0.5, l1_ratio=0.2), rows, _PRICE)
    return explain.coef_importance(model, _PRICE, rows).withColumns({c: F.round(c, 3) for c in ("coefficient", "importance")})


@query("m13_ridge_classifier")
def m13(t):
    train, test = _halves(t, "toxic")
    return _classifier_report(models.RidgeClassifier("label", _FEATURES).fit(train), test)


_DOCS = """(SELECT doc_id, n_chars, toxic AS label, lang = 'en' AS member FROM documents JOIN labels USING (doc_id))"""


@query(
    "m13_ridge_classifier_one_feature",
    f"""SELECT doc_id, CAST(slope * n_chars + base > 0 AS INTEGER) AS prediction FROM {_DOCS},
(SELECT regr_slope(2 * label - 1, n_chars) AS slope, regr_intercept(2 * label - 1, n_chars) AS base FROM {_DOCS})""",
)
def m13_one(t):
    rows = learning_base(t, "toxic")
    out = models.RidgeClassifier("label", ["n_chars"]).fit(rows).transform(rows)
    return out.select("doc_id", F.col("prediction").cast("int").alias("prediction"))


def _flag_rows(t):
    return learning_base(t, "toxic").withColumn("flag", F.col("member").cast("double"))


_FLAG_RATE = f"SELECT member, round(avg(label), 4) AS score FROM {_DOCS} GROUP BY 1"


@query("m14_logistic_regression_on_flag", _FLAG_RATE)
def m14_flag(t):
    """With a 0/1 feature and no penalty the probability is the class rate of each side."""
    rows = _flag_rows(t)
    model = models.fit(models.logistic().setTol(1e-10), rows, ["flag"])
    return models.with_probability(model, rows).select("member", F.round("score", 4).alias("score")).distinct()


@query(
    "m15_decision_tree_on_flag",
    f"SELECT member, round(avg(CAST(member <> (label = 1) AS INTEGER)), 4) AS score FROM {_DOCS} GROUP BY 1",
)
def m15_flag(t):
    """A class that mostly follows the flag, so that the two leaves differ and are kept."""
    rows = _flag_rows(t).withColumn("label", (F.col("member") != (F.col("label") == 1)).cast("double"))
    model = models.fit(models.decision_tree(depth=1), rows, ["flag"])
    return models.with_probability(model, rows).select("member", F.round("score", 4).alias("score")).distinct()


@query("m17_boosted_trees_first_step", _FLAG_RATE)
def m17_flag(t):
    """The first tree of a boosted regression answers with the mean of each side."""
    rows = _flag_rows(t)
    model = models.fit(models.boosted_trees(trees=1, depth=1, rate=1.0, regression=True), rows, ["flag"])
    return model.transform(rows).select("member", F.round("prediction", 4).alias("score")).distinct()


@query("m14_logistic_regression")
def m14(t):
    train, test = _halves(t, "toxic")
    model = models.fit(models.logistic(rows=train.count()), train, _FEATURES)
    scored_rows = models.with_probability(model, test)
    return metrics.auc(scored_rows, "label", "score").select(F.round("auc", 4).alias("auc"))


@query("m15_decision_tree")
def m15(t):
    train, test = _halves(t)
    return _classifier_report(models.fit(models.decision_tree(), train, _FEATURES), test)


@query("m16_random_forest")
def m16(t):
    train, test = _halves(t)
    return _classifier_report(models.fit(models.random_forest(trees=20, depth=5), train, _FEATURES), test)


@query("m16_random_forest_regression")
def m16_regression(t):
    rows = _price_rows(t)
    model = models.fit(models.random_forest(trees=5, depth=4, regression=True), rows, _PRICE)
    out = metrics.r2(model.transform(rows), F.col("label"), F.col("prediction"))
    return out.select(F.round("r2", 4).alias("r2"))


@query("m17_boosted_trees")
def m17(t):
    train, test = _halves(t)
    return _classifier_report(models.fit(models.boosted_trees(trees=10, depth=3, rate=0.1), train, _FEATURES), test)


@query("m18_early_stopping", "SELECT 12 AS allowed, count(DISTINCT quality) - 1 AS used FROM labels")
def m18(t):
    """The label as a feature: the first tree is exact, so the held-out rows improve no more."""
    rows = prep.split(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id", 0.25, 3, name="held_out")
    rows = rows.withColumn("flag", F.col("label"))
    model = models.fit(models.boosted_trees(trees=12, depth=3, rate=1.0, validation="held_out", regression=True), rows, ["flag"])
    return t.spark.createDataFrame([(12, model.stages[-1].getNumTrees)], "allowed int, used long")


_SHARE = int(0.3 * 2**32)
_KNN = f"""(SELECT q.vec_id AS query, t.vec_id AS neighbour, t.label,
round(sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))), 9) AS distance
FROM embeddings q, embeddings t WHERE {DRAW.format('q.vec_id', 5)} < {_SHARE} AND NOT {DRAW.format('t.vec_id', 5)} < {_SHARE})"""
_NEAREST = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank FROM {_KNN}) WHERE rank <= 5)"


def _nearest(t):
    rows = prep.split(t.embeddings, "vec_id", 0.3, 5)
    return neighbours.nearest(rows.where("NOT is_test"), rows.where("is_test"), 5, "vec_id", "embedding", "label")


@query("m19_nearest", f"SELECT query, CAST(rank AS INTEGER) AS rank, neighbour, label FROM {_NEAREST}")
def m19(t):
    return _nearest(t).drop("distance")


@query(
    "m19_knn_vote",
    f"""SELECT query, arg_min(label, (-n, label)) AS prediction FROM (SELECT query, label, count(*) AS n FROM {_NEAREST} GROUP BY 1, 2) GROUP BY 1""",
)
def m19_vote(t):
    return neighbours.vote(_nearest(t), "label")


def _fold_rows(t, label="toxic"):
    return cut_lineage(prep.folds(prep.assembler(_FEATURES).transform(learning_base(t, label)), "doc_id", 3, 1, by="label"))


def _auc_evaluator():
    return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")


@query("m20_grid_search")
def m20(t):
    estimator = models.decision_tree()
    maps = search.grid(estimator, {"maxDepth": [2, 4], "minInstancesPerNode": [1, 4]})
    model = search.grid_search(estimator, maps, _fold_rows(t), _auc_evaluator(), 3, "fold")
    return search.cv_results(t.spark, model).drop("mean_score", "rank").withColumn("settings", F.lit(len(maps)))


@query("m21_random_search")
def m21(t):
    estimator = models.decision_tree()
    maps = search.draws(estimator, {"maxDepth": [1, 2, 3, 4, 5], "minInstancesPerNode": [1, 2, 4, 8]}, 4, 9)
    model = search.grid_search(estimator, maps, _fold_rows(t), _auc_evaluator(), 3, "fold")
    return search.cv_results(t.spark, model)


@query("m22_tune_in_steps")
def m22(t):
    steps = [{"maxDepth": [2, 3]}, {"minInstancesPerNode": [1, 8]}]
    _, tried = search.tune_in_steps(models.decision_tree(), steps, _fold_rows(t), _auc_evaluator(), 3, "fold")
    return search.results(t.spark, tried)


_FOLDED = f"(SELECT l_quantity AS x, l_extendedprice AS y, {DRAW.format('l_orderkey', 1)} % 3 AS fold FROM lineitem)"

# mean held-out R2 of a line with and without intercept over three folds
_CV = f"""(SELECT intercept, avg(r2) AS score FROM (
SELECT intercept, h.fold, 1 - sum((y - slope * x - base) * (y - slope * x - base)) / (var_pop(y) * count(*)) AS r2 FROM {_FOLDED} h JOIN (
 SELECT f AS fold, true AS intercept, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM {_FOLDED}, (VALUES (0), (1), (2)) AS v(f) WHERE fold <> f GROUP BY f
 UNION ALL SELECT f, false, sum(x * y) / sum(x * x), 0 FROM {_FOLDED}, (VALUES (0), (1), (2)) AS v(f) WHERE fold <> f GROUP BY f) m
ON m.fold = h.fold GROUP BY intercept, h.fold) GROUP BY intercept)"""


def _line_rows(t):
    return cut_lineage(prep.folds(prep.assembler(["l_quantity"]).transform(_price_rows(t)), "l_orderkey", 3, 1).select("features", "label", "fold"))


def _r2_evaluator():
    return RegressionEvaluator(labelCol="label", metricName="r2")


def _settings(df):
    return df.select("setting", "params", F.round("mean_score", 4).alias("mean_score"))


@query(
    "m20_grid_search_of_lines",
    f"""SELECT CAST(2 * (NOT intercept)::INT + i AS INTEGER) AS setting, 'fitIntercept=' || CASE WHEN intercept THEN 'True' ELSE 'False' END || ', maxIter=' || (10 + 10 * i) AS params,
round(score, 4) AS mean_score FROM {_CV}, (VALUES (0), (1)) AS v(i)""",
)
def m20_lines(t):
    estimator = models.linear()
    maps = search.grid(estimator, {"fitIntercept": [True, False], "maxIter": [10, 20]})
    return _settings(search.cv_results(t.spark, search.grid_search(estimator, maps, _line_rows(t), _r2_evaluator(), 3, "fold")))


@query(
    "m21_random_search_of_lines",
    f"""SELECT count(*) AS settings, round(max(score), 4) AS best, round(min(score), 4) AS worst FROM {_CV}, (VALUES (0), (1), (2)) AS v(i)""",
)
def m21_lines(t):
    """Six draws from six combinations are all of them, in any order."""
    estimator = models.linear()
    maps = search.draws(estimator, {"fitIntercept": [True, False], "maxIter": [10, 20, 30]}, 6, 4)
    found = search.cv_results(t.spark, search.grid_search(estimator, maps, _line_rows(t), _r2_evaluator(), 3, "fold"))
    return found.agg(
        F.count_distinct("params").alias("settings"), F.round(F.max("mean_score"), 4).alias("best"), F.round(F.min("mean_score"), 4).alias("worst")
    )


@query(
    "m22_tune_in_steps_of_lines",
    f"""SELECT CAST(i AS INTEGER) AS setting, p AS params, round(score, 4) AS mean_score FROM {_CV} JOIN
(VALUES (0, 'fitIntercept=True', true), (1, 'fitIntercept=False', false), (2, 'maxIter=10', true), (3, 'maxIter=20', true)) AS v(i, p, intercept) USING (intercept)""",
)
def m22_lines(t):
    """The intercept is kept after the first step, so both settings of the second one have it."""
    steps = [{"fitIntercept": [True, False]}, {"maxIter": [10, 20]}]
    _, tried = search.tune_in_steps(models.linear(), steps, _line_rows(t), _r2_evaluator(), 3, "fold")
    return _settings(search.results(t.spark, tried))


@query(
    "m23_search_results",
    f"""SELECT CAST((NOT intercept)::INT AS INTEGER) AS setting, 'fitIntercept=' || CASE WHEN intercept THEN 'True' ELSE 'False' END AS params,
round(score, 4) AS mean_score, CAST(row_number() OVER (ORDER BY score DESC) AS INTEGER) AS rank FROM {_CV}""",
)
def m23(t):
    estimator = models.linear()
    maps = search.grid(estimator, {"fitIntercept": [True, False]})
    model = search.grid_search(estimator, maps, _line_rows(t), _r2_evaluator(), 3, "fold")
    return search.cv_results(t.spark, model).withColumn("mean_score", F.round("mean_score", 4))


@query(
    "m24_r2",
    """SELECT l_returnflag, round(1 - sum((l_extendedprice - p) * (l_extendedprice - p)) / (var_pop(l_extendedprice) * count(*)), 4) AS r2
FROM (SELECT l_returnflag, l_extendedprice, 1500 * l_quantity + 10 AS p FROM lineitem) GROUP BY 1""",
)
def m24(t):
    guess = 1500 * F.col("l_quantity") + 10
    return metrics.r2(t.lineitem, F.col("l_extendedprice"), guess, ["l_returnflag"]).withColumn("r2", F.round("r2", 4))


@query("m25_accuracy", f"SELECT lang, round(avg(CAST(quality = pred AS DOUBLE)), 4) AS accuracy FROM {SCORED} GROUP BY 1")
def m25(t):
    out = metrics.accuracy(scored(t), F.col("quality"), F.col("pred"), ["lang"])
    return out.withColumn("accuracy", F.round("accuracy", 4))


_STEPS = f"""(SELECT n_chars::DOUBLE AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM (
SELECT n_chars, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality = 0) AS neg FROM {SCORED} GROUP BY 1) WINDOW w AS (ORDER BY n_chars DESC))"""


@query("m26_roc", f"SELECT threshold, round(tp / p::DOUBLE, 6) AS tpr, round(fp / n::DOUBLE, 6) AS fpr FROM {_STEPS}")
def m26(t):
    return metrics.roc(scored(t), "quality", "n_chars").withColumns({c: F.round(c, 6) for c in ("tpr", "fpr")})


_AUC = f"""(SELECT sum(CASE WHEN a.n_chars > b.n_chars THEN 1.0 WHEN a.n_chars = b.n_chars THEN 0.5 ELSE 0 END)::DOUBLE / count(*) AS auc
FROM {SCORED} a, {SCORED} b WHERE a.quality = 1 AND b.quality = 0)"""


@query("m27_auc", f"SELECT round(auc, 6) AS auc FROM {_AUC}")
def m27(t):
    return metrics.auc(scored(t), "quality", "n_chars").withColumn("auc", F.round("auc", 6))


@query(
    "m27_auc_of_labels",
    f"""SELECT round(sum(CASE WHEN a.pred > b.pred THEN 1.0 WHEN a.pred = b.pred THEN 0.5 ELSE 0 END)::DOUBLE / count(*), 6) AS auc
FROM {SCORED} a, {SCORED} b WHERE a.quality = 1 AND b.quality = 0""",
)
def m27_labels(t):
    return metrics.auc(scored(t), "quality", "pred").withColumn("auc", F.round("auc", 6))


@query(
    "m28_class_report",
    f"""SELECT class, round(coalesce(hits / nullif(guessed, 0)::DOUBLE, 0), 6) AS precision, round(coalesce(hits / nullif(support, 0)::DOUBLE, 0), 6) AS recall,
round(coalesce(2 * hits / nullif(guessed + support, 0)::DOUBLE, 0), 6) AS f1, support FROM (
SELECT c AS class, count(*) FILTER (WHERE quality = c AND pred = c) AS hits, count(*) FILTER (WHERE pred = c) AS guessed, count(*) FILTER (WHERE quality = c) AS support
FROM {SCORED}, (VALUES (0), (1)) AS v(c) GROUP BY 1)""",
)
def m28(t):
    out = metrics.class_report(scored(t), "quality", "pred")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("m29_gini", f"SELECT round(2 * auc - 1, 6) AS gini FROM {_AUC}")
def m29(t):
    return metrics.gini(scored(t), "quality", "n_chars").withColumn("gini", F.round("gini", 6))


@query("m29_auc_pr", f"SELECT round(sum(pos * tp / (tp + fp)::DOUBLE) / max(p), 6) AS auc_pr FROM {_STEPS}")
def m29_pr(t):
    return metrics.auc_pr(scored(t), "quality", "n_chars").withColumn("auc_pr", F.round("auc_pr", 6))


@query("m30_coefficient_importance")
def m30(t):
    train, _ = _halves(t, "toxic")
    model = models.fit(models.logistic(rows=train.count()), train, _FEATURES)
    return explain.coef_importance(model, _FEATURES, train).select("feature")


_NORMAL = """(SELECT var_pop(l_discount) AS s11, var_pop(l_tax) AS s22, covar_pop(l_discount, l_tax) AS s12,
covar_pop(l_discount, l_extendedprice) AS s1, covar_pop(l_tax, l_extendedprice) AS s2 FROM lineitem)"""


@query(
    "m30_coefficients_of_two_features",
    f"""SELECT feature, round(c, 2) AS coefficient, round(abs(c), 2) AS importance FROM (
SELECT 'l_discount' AS feature, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS c FROM {_NORMAL}
UNION ALL SELECT 'l_tax', (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) FROM {_NORMAL})""",
)
def m30_two(t):
    rows, features = _price_rows(t), ["l_discount", "l_tax"]
    out = explain.coef_importance(models.fit(models.linear(), rows, features), features, rows)
    return out.withColumns({c: F.round(c, 2) for c in ("coefficient", "importance")})


@query(
    "m31_tree_importance",
    """SELECT 'flag' AS feature, CASE WHEN count(DISTINCT quality) = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM labels
UNION ALL SELECT 'same', 0.0::DOUBLE""",
)
def m31(t):
    """The label as a feature takes all of the importance, a constant none."""
    rows = t.labels.select(F.col("quality").cast("double").alias("label"), F.col("quality").cast("double").alias("flag"), F.lit(1.0).alias("same"))
    features = ["flag", "same"]
    found = explain.tree_importance(models.fit(models.decision_tree(depth=2), rows, features), features, rows)
    return found.withColumn("importance", F.round("importance", 6))


@query("m32_code_map", "SELECT p_type AS value, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT p_type FROM part)")
def m32(t):
    return prep.code_map(t.part, "p_type")


def _rule_model():
    """A model of known form: the answer is a sum of three weighted features."""
    return SQLTransformer(statement="SELECT *, 3.0D * l_quantity - 20.0D * l_discount + 5.0D * l_tax AS prediction FROM __THIS__")


@query(
    "m33_partial_dependence",
    "SELECT v AS value, round(3 * v + (SELECT avg(-20 * l_discount + 5 * l_tax) FROM lineitem), 4) AS mean_answer FROM (SELECT DISTINCT l_quantity AS v FROM lineitem)",
)
def m33(t):
    out = explain.partial_dependence(_rule_model(), t.lineitem.select(*_PRICE), _PRICE, "l_quantity")
    return out.withColumn("mean_answer", F.round("mean_answer", 4))


@query("m33_partial_dependence_of_trees")
def m33_trees(t):
    train, _ = _halves(t)
    model = models.fit(models.random_forest(trees=5, depth=4), train, _FEATURES)
    out = explain.partial_dependence(model, train, _FEATURES, "n_words", points=20)
    return out.withColumn("mean_answer", F.round("mean_answer", 6))


_COEFS = {"l_quantity": 3.0, "l_discount": -20.0, "l_tax": 5.0}


@query(
    "m34_linear_shapley",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(avg(abs({c} * ({f} - (SELECT avg({f}) FROM lineitem)))), 4) AS importance FROM lineitem"
        for f, c in _COEFS.items()
    ),
)
def m34(t):
    values = explain.linear_shapley(t.lineitem, "l_orderkey", _COEFS)
    return explain.mean_absolute(values, _PRICE).withColumn("importance", F.round("importance", 4))


@query(
    "m35_sampled_shapley",
    f"""WITH b AS (SELECT avg(p_size) AS s, avg(p_retailprice) AS r FROM (SELECT * FROM part ORDER BY md5('1:' || p_partkey), p_partkey LIMIT 4))
SELECT p_partkey, round(2 * (p_size - s), 4) AS p_size, round(0.5 * (p_retailprice - r), 4) AS p_retailprice, round(2 * s + 0.5 * r, 4) AS base,
round(2 * part.p_size + 0.5 * part.p_retailprice, 4) AS answer FROM part, b""",
)
def m35(t):
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    model = SQLTransformer(statement="SELECT *, 2.0D * p_size + 0.5D * p_retailprice AS prediction FROM __THIS__")
    out = explain.sampled_shapley(model, rows, "p_partkey", ["p_size", "p_retailprice"], rows, ["p_partkey"], 4, 1)
    return out.withColumns({c: F.round(c, 4) for c in ("p_size", "p_retailprice", "base", "answer")})


@query("m35_sampled_shapley_of_trees", f"SELECT doc_id, 0.0::DOUBLE AS gap FROM documents JOIN labels USING (doc_id) WHERE {DRAW.format('doc_id', 11)} < {int(0.3 * 2**32)}")
def m35_trees(t):
    """What the values of a row leave open between its answer and the base: nothing."""
    train, test = _halves(t)
    model = models.fit(models.random_forest(trees=5, depth=4, regression=True), train, _FEATURES)
    out = explain.sampled_shapley(model, test, "doc_id", _FEATURES, train, ["doc_id"], 4, 1)
    total = sum(F.col(f) for f in _FEATURES)
    return out.select("doc_id", (F.abs(F.round(total - F.col("answer") + F.col("base"), 6)) + 0.0).alias("gap"))


# a tree of known form over three features, one of them asked twice
_TREE = [
    explain.Leaf(0, [(0, 25.0, True), (1, 0.05, True)], 1.0), explain.Leaf(0, [(0, 25.0, True), (1, 0.05, False)], 2.5),
    explain.Leaf(0, [(0, 25.0, False), (2, 0.04, True)], 4.0), explain.Leaf(0, [(0, 25.0, False), (2, 0.04, False), (0, 40.0, True)], 7.0),
    explain.Leaf(0, [(0, 25.0, False), (2, 0.04, False), (0, 40.0, False)], 9.5),
]


def _tree_sql(known: tuple[str, ...]) -> str:
    """Answer of the tree where only some features are known; at a split on another one both sides count by their share."""
    side = lambda f, cut, share: f"CASE WHEN {f} <= {cut} THEN 1.0 ELSE 0.0 END" if f in known else share
    q, d, x, q2 = side("l_quantity", 25, "s_q"), side("l_discount", 0.05, "s_d"), side("l_tax", 0.04, "s_t"), side("l_quantity", 40, "s_q2")
    low = f"(({d}) * 1.0 + (1 - ({d})) * 2.5)"
    high = f"(({x}) * 4.0 + (1 - ({x})) * (({q2}) * 7.0 + (1 - ({q2})) * 9.5))"
    return f"(({q}) * {low} + (1 - ({q})) * {high})"


def _orders_sql(feature: str) -> str:
    """Mean change of the answer at a feature's turn over all orders of the three."""
    orders = list(itertools.permutations(_PRICE))
    turns = [(order[: order.index(feature)], order[: order.index(feature) + 1]) for order in orders]
    return "(" + " + ".join(f"({_tree_sql(after)} - {_tree_sql(before)})" for before, after in turns) + f") / {len(orders)}"


@query(
    "m35_tree_shapley_of_known_tree",
    f"""WITH s AS (SELECT avg(CASE WHEN l_quantity <= 25 THEN 1.0 ELSE 0 END) AS s_q, avg(CASE WHEN l_discount <= 0.05 THEN 1.0 ELSE 0 END) FILTER (WHERE l_quantity <= 25) AS s_d,
avg(CASE WHEN l_tax <= 0.04 THEN 1.0 ELSE 0 END) FILTER (WHERE l_quantity > 25) AS s_t, avg(CASE WHEN l_quantity <= 40 THEN 1.0 ELSE 0 END) FILTER (WHERE l_quantity > 25 AND l_tax > 0.04) AS s_q2 FROM lineitem),
a AS (SELECT avg({_tree_sql(tuple(_PRICE))}) AS base FROM lineitem, s)
SELECT l_orderkey, l_linenumber, {', '.join(f'round({_orders_sql(f)}, 9) AS {f}_value' for f in _PRICE)}, round(base, 9) AS base, round({_tree_sql(tuple(_PRICE))}, 9)::DOUBLE AS answer FROM lineitem, s, a""",
)
def m35_known(t):
    out = explain.leaf_shapley(_TREE, t.lineitem, ["l_orderkey", "l_linenumber"], _PRICE, t.lineitem)
    return out.select("l_orderkey", "l_linenumber", *[F.round(f, 9).alias(f"{f}_value") for f in _PRICE], F.round("base", 9).alias("base"), F.round("answer", 9).alias("answer"))


@query("m35_tree_shapley_of_forest", f"SELECT doc_id, 0.0::DOUBLE AS gap, 0.0::DOUBLE AS off, 0.0::DOUBLE AS shift FROM documents JOIN labels USING (doc_id) WHERE {DRAW.format('doc_id', 11)} < {int(0.3 * 2**32)}")
def m35_forest(t):
    """What the exact values leave open between a row's answer and the base, the leaves' answer against the model's, the base against the mean of all."""
    train, test = _halves(t)
    model = models.fit(models.random_forest(trees=5, depth=4, regression=True), train, _FEATURES)
    out = explain.tree_shapley(model, test, ["doc_id"], _FEATURES, train)
    mean = model.transform(train).agg(F.avg("prediction")).first()[0]
    total, near = sum(F.col(f) for f in _FEATURES), lambda x: F.abs(F.round(x, 6)) + 0.0
    return out.join(model.transform(test).select("doc_id", "prediction"), "doc_id").select(
        "doc_id", near(total - F.col("answer") + F.col("base")).alias("gap"), near(F.col("answer") - F.col("prediction")).alias("off"),
        near(F.col("base") - F.lit(mean)).alias("shift"),
    )


_MEMBERS = f"(SELECT *, coalesce(lang = 'en', false) AS protected FROM {SCORED})"


@query("m36_group_audit", confusion_sql("protected", _MEMBERS))
def m36(t):
    return audit.group_audit(scored(t), "quality", "pred", F.col("lang") == "en")


@query("m37_audit_without")
def m37(t):
    train, test = _halves(t)
    make = lambda: models.boosted_trees(trees=5, depth=3, rate=0.2)
    return audit.audit_without(make, train, test, "label", _FEATURES, "lang_code", F.col("member"))


@query("m38_proxy_test")
def m38(t):
    train, test = _halves(t)
    features = [f for f in _FEATURES if f != "lang_code"]
    rates, importance = audit.proxy_test(lambda: models.random_forest(trees=10, depth=5), train, test, F.col("member"), features)
    return importance.withColumn("accuracy", F.lit(rates.first()["accuracy"]))


@query(
    "m39_score_and_write",
    f"""WITH b AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x, CAST(quality AS DOUBLE) AS y, {DRAW.format('doc_id', 11)} < {int(0.3 * 2**32)} AS is_test
FROM documents JOIN labels USING (doc_id)), f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS base FROM b WHERE NOT is_test)
SELECT doc_id, round(slope * x + base, 5) AS prediction FROM b, f WHERE is_test""",
)
def m39(t):
    from pyspark.sql import types as T

    train, test = _halves(t)
    model = models.fit(models.linear(), train, ["n_chars"])
    path = new_folder(t.spark, "m39")
    files.write_csv(models.score(model, test, "doc_id"), path)
    read = files.read_csv(t.spark, path, T.StructType.fromDDL("doc_id long, prediction double"))
    return read.select("doc_id", F.round("prediction", 5).alias("prediction"))


@query(
    "a17_confusion_of_bands",
    confusion_sql("band", f"(SELECT *, CASE WHEN n_chars <= 500 THEN 'short' WHEN n_chars <= 3000 THEN 'middle' ELSE 'long' END AS band FROM {SCORED})"),
)
def a17_bands(t):
    rows = scored(t).withColumn("band", bin_by(F.col("n_chars"), [500, 3000], ["short", "middle", "long"]))
    return confusion(rows, F.col("quality"), F.col("pred"), ["band"])
