"""Preprocessor, calibration and scoring against numpy."""
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from vireo.operators import ml as M
from vireo.streaming.jobs import shared_path


def pool_adjacent_violators(x, y, w):
    """Brute force: merge neighbouring blocks while their means fall."""
    order = np.argsort(x, kind="stable")
    blocks = []
    for i in order:
        blocks.append([y[i] * w[i], w[i], [x[i]]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {v: s / n for s, n, xs in blocks for v in xs}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"ra": np.arange(n) // 2, "x": x, "z": rng.integers(0, 5, n).astype(float), "c": rng.choice(["a", "b", None], n),
                        "label": (rng.random(n) < 1 / (1 + np.exp(-2 * x))).astype(int)})
    pdf.loc[rng.random(n) < .1, "x"] = None
    return M.balanced_weights(spark.createDataFrame(pdf), "label"), pdf


def test_preprocessor_is_exact(table):
    df, pdf = table
    med = pdf.x.median()
    filled = pdf.x.fillna(med)
    prep = M.fit_preprocessor(df, ["x", "z"], ["c"])
    out = prep.transform(df).select("ra", "x", vector_to_array("features").alias("f")).collect()
    want = (filled - filled.mean()) / filled.std(ddof=0)
    assert np.allclose(sorted(r.f[0] for r in out), sorted(want))
    st = {r.feature: r for r in M.numeric_statistics(df, ["x", "z"]).collect()}
    assert st["x"].median == pytest.approx(med) and st["z"]["std"] == pytest.approx(pdf.z.std(ddof=0))
    # unseen level: zeros; a column without values: zero
    other = df.limit(1).withColumn("c", F.lit("new")).withColumn("x", F.lit(None).cast("double"))
    assert prep.transform(other).select(vector_to_array("features").alias("f")).first().f[2:] == [0.0] * 3
    empty = M.fit_preprocessor(df.withColumn("x", F.lit(None).cast("double")), ["x"], [])
    assert empty.transform(df).select(vector_to_array("features").alias("f")).distinct().collect()[0].f == [0.0]


def test_isotonic_calibrator_equals_pool_adjacent_violators(spark):
    rng = np.random.default_rng(5)
    raw = np.round(rng.random(3000), 2)
    y = (rng.random(3000) < raw ** 2).astype(float)
    held = spark.createDataFrame(pd.DataFrame({"__raw": raw, "label": y})).repartition(7)
    cal = M.fit_calibrator(held, "isotonic")
    xs = np.unique(raw)
    ys, ws = np.array([y[raw == v].mean() for v in xs]), np.array([(raw == v).sum() for v in xs], dtype=float)
    want = pool_adjacent_violators(xs, ys, ws)
    grid = spark.createDataFrame([(float(v),) for v in xs], "__score double")
    got = {r["__score"]: r.prediction for r in cal.transform(grid).collect()}
    assert all(got[v] == pytest.approx(want[v]) for v in xs)
    assert all(a <= b + 1e-12 for a, b in zip([got[v] for v in xs], [got[v] for v in xs][1:]))
    with pytest.raises(ValueError):
        M.fit_calibrator(held, "other")


@pytest.mark.parametrize("calibration", [None, "sigmoid", "isotonic"])
def test_fit_save_and_score(spark, table, calibration):
    df, pdf = table
    est = M.candidates(df.count())["logreg"]
    model = M.fit(df, ["x", "z"], ["c"], est, calibration)
    scored = M.score(df, model, 0.5, "v1", {"x": "double", "z": "double", "c": "string"}, keep=["ra"])
    rows = scored.collect()
    assert len(rows) == len(pdf) and all(0 <= r.risk_score <= 1 and r.risk_label == int(r.risk_score >= .5) for r in rows)
    path = shared_path(spark, "model")
    M.save(model, path)
    again = M.load(path, len(model.members), calibration)
    key = lambda rs: sorted((r.ra, r.risk_score) for r in rs)
    assert key(M.score(df, again, 0.5, "v1", {"x": "double", "z": "double", "c": "string"}, keep=["ra"]).collect()) == key(rows)


def test_too_many_classes_are_refused(spark):
    with pytest.raises(ValueError, match="values"):
        M.balanced_weights(spark.range(2000).withColumnRenamed("id", "label"))


@pytest.fixture(scope="module")
def features(spark):
    """Rows whose bins hold several values each, and a column of few values, of which many are equal."""
    rng = np.random.default_rng(11)
    n = 4000
    x, z, c = rng.normal(size=n), rng.integers(0, 4, n).astype(float), rng.integers(0, 2, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x - z + 2 * c))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "z": z, "c": c, "label": y})).withColumn("id", F.monotonically_increasing_id())
    df = M.balanced_weights(df, "label")
    return df.select("id", array_to_vector(F.array("x", "z", "c")).alias("features"), "label", "weight").cache()


def _scores(model, df):
    out = M.ScoringModel(None, [(model, None)]).score_features(df, ["id"], "p").orderBy("id").collect()
    return np.array([r.p for r in out])


def _trees():
    return M.candidates(4000)["gbt"].setMaxIter(8).setMaxDepth(4)


def test_boosted_trees_are_fitted_on_combinations_of_bins(features, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "POOL_FROM", 1000)
    plain = _trees().fit(features)
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: (seen.append(df.count()), fit(self, df, *a))[1])
    model = M.fit_classifier(_trees(), features)
    assert seen and seen[0] <= 32 * 4 * 2 * 2  # bins of x, values of z and c, labels; 4000 rows before
    # the same trees: equal scores for these rows and for others
    other = features.withColumn("features", array_to_vector(F.transform(vector_to_array("features"), lambda v: v * 1.1 + 0.01)))
    for rows in (features, other):
        assert np.allclose(_scores(model, rows), _scores(plain, rows), atol=1e-9)


def test_rows_that_are_drawn_one_by_one_are_not_pooled(features, monkeypatch):
    monkeypatch.setattr(M, "POOL_FROM", 1000)
    for est in (_trees().setSubsamplingRate(0.5), _trees().setMinInstancesPerNode(5)):
        assert np.allclose(_scores(M.fit_classifier(est, features), features), _scores(est.fit(features), features))


def test_forest_is_dealt_to_more_tasks_and_keeps_its_trees(features, monkeypatch):
    est = M.candidates(4000)["rf"].setNumTrees(4).setMaxDepth(6)
    plain = est.copy().setCacheNodeIds(False).fit(features)
    assert np.allclose(_scores(M.fit_classifier(est, features), features), _scores(plain, features))
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: (seen.append(df.rdd.getNumPartitions()), fit(self, df, *a))[1])
    few = features.coalesce(1)
    M.fit_classifier(est, few)  # few rows stay where they are
    monkeypatch.setattr(M, "ROWS_PER_TASK", 1000)
    M.fit_classifier(est, few)
    assert seen == [1, 4]


def test_binned_trees_are_saved_with_their_bins(spark, table, monkeypatch):
    monkeypatch.setattr(M, "POOL_FROM", 100)
    df, _ = table
    model = M.fit(df, ["x", "z"], ["c"], M.candidates(df.count())["gbt"].setMaxIter(2).setMaxDepth(2), "sigmoid")
    assert all(isinstance(clf, M.Binned) for clf, _ in model.members)
    path = shared_path(spark, "model")
    M.save(model, path)
    again = M.load(path, len(model.members), "sigmoid", GBTClassificationModel)
    key = lambda m: sorted((r.ra, r.risk_score) for r in m.transform(df).collect())
    assert key(again) == key(model) and len(set(key(model))) > 2


def test_drawn_forest_is_saved_with_its_bins(spark, table, monkeypatch):
    monkeypatch.setattr(M, "POOL_FROM", 100)
    monkeypatch.setattr(M, "FOREST_POOL", 1)
    df, _ = table
    model = M.fit(df, ["z"], ["c"], M.candidates(df.count())["rf"].setNumTrees(3).setMaxDepth(2), "sigmoid")
    assert all(isinstance(clf, M.Binned) for clf, _ in model.members)
    path = shared_path(spark, "model")
    M.save(model, path)
    again = M.load(path, len(model.members), "sigmoid", RandomForestClassificationModel)
    key = lambda m: sorted((r.ra, r.risk_score) for r in m.transform(df).collect())
    assert key(again) == key(model) and len(set(key(model))) > 2
    assert [clf.clf.getNumTrees for clf, _ in again.members] == [3] * 3


def test_selection_reads_its_rows_once_and_scores_them_once(spark, table, monkeypatch):
    df, pdf = table
    read, scored = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(acc):
        def rows(batches):
            for b in batches:
                acc.add(len(b))
                yield b
        return rows
    plain = M.ScoringModel.transform
    monkeypatch.setattr(M.ScoringModel, "transform", lambda self, d, *a: plain(self, d.mapInPandas(counted(scored), d.schema), *a))
    raw = df.drop("weight")
    _, _, report = M.train_and_select(raw.mapInPandas(counted(read), raw.schema), ["x", "z"], ["c"], names=["logreg"])
    assert read.value == len(pdf)
    # a fifth for the test, and a fifth of the others for validation, by whole subjects
    assert 0.3 * len(pdf) < scored.value < 0.42 * len(pdf)
    assert [(r.model, r.split) for r in report.collect()] == [("logreg", "validation"), ("logreg", "test")]


@pytest.fixture(scope="module")
def few_kinds(spark):
    """12,000 rows of which many are alike."""
    rng = np.random.default_rng(12)
    n = 12_000
    x, z, c = np.round(rng.normal(size=n)), rng.integers(0, 4, n).astype(float), rng.integers(0, 2, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x - z + 2 * c))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "z": z, "c": c, "label": y})).withColumn("id", F.monotonically_increasing_id())
    df = M.balanced_weights(df, "label")
    return df.select("id", array_to_vector(F.array("x", "z", "c")).alias("features"), "label", "weight",
                     (F.col("id") % 3).cast("int").alias("__fold")).cache()


def test_forest_is_drawn_from_combinations_of_bins(few_kinds, monkeypatch):
    est = M.candidates(12_000)["rf"].setNumTrees(12).setMaxDepth(5)
    plain = est.copy().fit(few_kinds)
    seen, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: (seen.append((df.count(), self.getFeatureSubsetStrategy())), fit(self, df, *a))[1])
    model = M.fit_classifier(est, few_kinds)
    kinds = few_kinds.groupBy("features", "label").count().count()
    # a tree's own draw each, of at most a row per combination (12,000 rows before); of a node's features the forest's share
    assert len(seen) == 12 and max(n for n, _ in seen) <= kinds < 300 and {s for _, s in seen} == {"sqrt"}
    assert len({t.toDebugString for t in model.clf.trees}) == 12 and model.clf.getNumTrees == 12
    assert model.clf.totalNumNodes == sum(t.numNodes for t in model.clf.trees) and max(t.depth for t in model.clf.trees) <= 5 and model.clf.numClasses == 2 and model.clf.numFeatures == 3
    # as near to the plain forest as another seed is
    mine, theirs, other = _scores(model, few_kinds), _scores(plain, few_kinds), _scores(est.copy().setSeed(7).fit(few_kinds), few_kinds)
    assert np.abs(mine - theirs).mean() < 2 * np.abs(other - theirs).mean() + 0.01
    again = M.fit_classifier(est, few_kinds.repartition(5))
    assert np.allclose(_scores(again, few_kinds), mine)


def test_forest_of_rows_that_differ_or_are_drawn_otherwise_is_not_pooled(few_kinds, monkeypatch):
    for est in (M.candidates(12_000)["rf"].setBootstrap(False), M.candidates(12_000)["rf"].setMinInstancesPerNode(3)):
        assert M.pool(few_kinds, est) is None
    monkeypatch.setattr(M, "FOREST_POOL", 10_000)
    assert not isinstance(M.fit_classifier(M.candidates(12_000)["rf"].setNumTrees(2).setMaxDepth(2), few_kinds), M.Binned)


def test_draws_are_poisson_and_follow_the_combination(spark):
    rows = [([float(i), float(n)], i % 2, 0.5, n) for i in range(20) for n in (1, 40, 3000)]
    counts = spark.createDataFrame(rows, "__bins array<double>, label int, __w double, __n bigint")
    read = lambda df: {tuple(r["__bins"]): [r[f"__t{k}"] for k in range(200)] for r in df.collect()}
    drawn = read(M.poisson_draws(counts, 200, 0.5, 3, "label"))
    assert drawn == read(M.poisson_draws(counts.repartition(7), 200, 0.5, 3, "label"))
    assert drawn != read(M.poisson_draws(counts, 200, 0.5, 4, "label")) and len(set(map(tuple, drawn.values()))) == 60
    for n in (1, 40, 3000):
        all_n = np.array([v for (_, m), v in drawn.items() if m == n]).ravel()
        assert all_n.mean() == pytest.approx(n / 2, rel=0.1) and all_n.var() == pytest.approx(n / 2, rel=0.2)


def test_rows_are_counted_once_for_all_folds_and_candidates(few_kinds, monkeypatch):
    pooled = M.pool(few_kinds, M.candidates(12_000)["gbt"])
    got = {(tuple(r["__bins"]), r.label, r["__fold"]): r["__n"] for r in pooled.table.collect()}
    rows = M.Binned(None, pooled.cuts).numbers(few_kinds, "features", "b").groupBy("b", "label", "__fold").count().collect()
    assert got == {(tuple(r.b), r.label, r["__fold"]): r["count"] for r in rows} and sum(got.values()) == 12_000
    monkeypatch.setattr(M, "pool", lambda *a: pytest.fail("counted again"))
    monkeypatch.setattr(M, "REPEAT", 7)
    for est in (M.candidates(12_000)["gbt"].setMaxIter(2), M.candidates(12_000)["rf"].setNumTrees(3)):
        # a fold's rows without it, less than POOL_FROM, are fitted as they are
        monkeypatch.setattr(M, "POOL_FROM", 5000)
        model = M.fit(None, [], [], est.setMaxDepth(3), "sigmoid", made=(None, few_kinds), pooled=pooled)
        assert model.cuts() == pooled.cuts
        counted = pooled.table.groupBy("label", "__bins").agg(F.sum("__n").alias("__n"))
        mine = sorted((r.label, r.risk_score) for r in model.score_counted(counted, ["label"]).collect())
        each = sorted((r.label, r.risk_score) for r in model.score_features(few_kinds, ["label"]).collect())
        assert np.allclose(mine, each, atol=1e-12)


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibrator_of_counted_scores_equals_that_of_rows(spark, method):
    rng = np.random.default_rng(8)
    raw = rng.integers(0, 20, 2000) / 20
    held = spark.createDataFrame(pd.DataFrame({"__raw": raw, "label": (rng.random(2000) < raw).astype(int)}))
    rows, counted = M.fit_calibrator(held, method), M.fit_calibrator(held.groupBy("__raw", "label").count(), method, count="count")
    if method == "sigmoid":
        assert [counted.coefficients[0], counted.intercept] == pytest.approx([rows.coefficients[0], rows.intercept], rel=1e-4)
    else:
        assert np.allclose(counted.predictions.toArray(), rows.predictions.toArray())


def test_bin_numbers_count_the_ends_below(spark):
    values = [-np.inf, -0.0, 0.0, 0.5, 1.0, 1.5, 9.0, np.inf, np.nan]
    df = spark.createDataFrame([([v, v],) for v in values], "f array<double>").select(array_to_vector("f").alias("features"))
    got = [r.b for r in M.Binned(None, [[0.0, 1.0, 1.5, 2.0], [0.5]]).numbers(df, "features", "b").collect()]
    assert got == [[0, 0], [0, 0], [0, 0], [1, 0], [1, 1], [2, 1], [4, 1], [4, 1], [4, 1]]
