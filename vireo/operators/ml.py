"""Fit and score with Spark ML (M1-M9, D11 helpers).

Preprocessing, weighting and the classifiers are Spark ML stages; training
runs distributed (tree learners aggregate histograms across executors, the
linear model uses distributed L-BFGS).  The stratified split is exact and
repeatable without a per-class window: ranks come from the bucketed prefix
sums of a per-row hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.stats import ordered_prefix_sums, quantiles

SEED = 42
MAX_CLASSES = 1000
#: rows that bins are drawn from at least (Spark's tree learners take as many), and
#: features beyond which rows hardly share all their bins
BIN_SAMPLE, MAX_BINNED = 10000, 256
#: rows up to which trees are fitted on the rows as they are
POOL_FROM = 10_000
#: rows that share their bins on average, from which a forest is drawn from the
#: combinations of bins, and its trees that are fitted at a time
FOREST_POOL, TREES_AT_ONCE = 8, 12
#: copies that a count of rows is turned into at a time
REPEAT = 10_000
#: rows from which a forest's training table is dealt to another task, up to the number of cores
ROWS_PER_TASK = 100_000


# M1 ------------------------------------------------------------------------
def numeric_statistics(df: DataFrame, numeric: list[str]) -> DataFrame:
    """(feature, median, mean, std): the exact median of each numeric column,
    and mean and population deviation after it has filled the gaps."""
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numeric]).unpivot([], numeric, "feature", "value")
    med = quantiles(long, "value", [0.5], ["feature"], names=["median"], few_groups=True, also=[F.count(F.lit(1)).alias("__rows")])
    filled = long.join(F.broadcast(med), "feature").withColumn("__x", F.coalesce(F.nanvl("value", "median"), "median"))
    return filled.groupBy("feature").agg(F.first("median").alias("median"), F.avg("__x").alias("mean"), F.stddev_pop("__x").alias("std"))


def fit_preprocessor(df: DataFrame, numeric: list[str], categorical: list[str]) -> PipelineModel:
    """Median impute + standardise numerics; 'missing' fill + one-hot text
    (unseen levels -> all zeros).  The learned numbers (three per numeric
    column) are literals of one projection; a column without any value becomes
    0, and one without spread is only centred."""
    parts, exprs, stages = [], [], []
    if numeric:
        learned = {r["feature"]: r for r in numeric_statistics(df, numeric).collect()}
        for c in numeric:
            r = learned[c] if c in learned and learned[c]["median"] is not None else None
            x = f"CAST(`{c}` AS DOUBLE)"
            exprs.append(f"(coalesce(nanvl({x}, NULL), {r['median']!r}D) - {r['mean']!r}D) / {r['std'] or 1.0!r}D AS `{c}__std`" if r
                         else f"0.0D AS `{c}__std`")
            parts.append(f"{c}__std")
    exprs += [f"coalesce(CAST(`{c}` AS STRING), 'missing') AS `{c}__txt`" for c in categorical]
    stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"))
    if categorical:
        idx, ohe = [f"{c}__idx" for c in categorical], [f"{c}__ohe" for c in categorical]
        stages += [StringIndexer(inputCols=[f"{c}__txt" for c in categorical], outputCols=idx,
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True)]
        parts += ohe
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages).fit(df)


# M2 ------------------------------------------------------------------------
def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """n / (k * n_class).  The class counts are k numbers (one per class),
    fetched once and applied as a literal CASE - no join.  A label with over
    ``MAX_CLASSES`` values is refused."""
    rows = df.groupBy(label).agg(F.count(F.lit(1))).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has over {MAX_CLASSES} values")
    counts = {r[0]: r[1] for r in rows}
    n, k = sum(counts.values()), len(counts)
    w = None
    for cls, nc in counts.items():
        cond = F.col(label).isNull() if cls is None else (F.col(label) == F.lit(cls))
        val = F.lit(float(n) / (k * nc))
        w = F.when(cond, val) if w is None else w.when(cond, val)
    return df.withColumn(out, w if w is not None else F.lit(None).cast("double"))


# M3 ------------------------------------------------------------------------
def candidates(n_train: int, seed: int = SEED, label: str = "label", weight: str = "weight") -> dict:
    """logreg (C=1, i.e. L2 1/n), boosted trees (100 x depth 6, lr .1),
    random forest (100 trees, depth 10), all class-weighted."""
    common = dict(featuresCol="features", labelCol=label, weightCol=weight)
    return {
        "logreg": LogisticRegression(maxIter=1000, tol=1e-4, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                                     **common),
        "gbt": GBTClassifier(maxIter=100, maxDepth=6, stepSize=0.1, seed=seed, **common),
        # each row's node is kept per tree (the same trees): else every level walks all trees from their roots
        "rf": RandomForestClassifier(numTrees=100, maxDepth=10, seed=seed, cacheNodeIds=True, checkpointInterval=-1, **common),
    }


# M4 ------------------------------------------------------------------------
def stratified_split(df: DataFrame, label: str, key: str | list[str], test_frac: float = 0.2, seed: int = SEED,
                     out: str = "is_test", bucket_bits: int = 16) -> DataFrame:
    """Exactly ceil(frac * n_class) rows per class go to test if ``key`` (one
    column or several) names a row; rows that share a key go together.  Rows
    are chosen by a seeded hash of the key, so the split is repeatable.  Null
    labels are a class of their own and no row is lost.

    The class's cutoff hash comes from prefix sums over ``2**bucket_bits``
    hash-range buckets; rows are then only compared with it (one small row
    per class), not joined back.
    """
    keys = [key] if isinstance(key, str) else list(key)
    h = df.withColumn("__h", F.xxhash64(*[F.col(k).cast("string") for k in keys], F.lit(seed)))
    h = h.withColumn("__l", F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("")))
    cnt = h.groupBy("__l", "__h").agg(F.count(F.lit(1)).alias("__c"))
    ps = ordered_prefix_sums(cnt, ["__l"], "__h", ["__c"], F.shiftright(F.col("__h"), 64 - bucket_bits))
    n = cnt.groupBy("__l").agg(F.sum("__c").alias("__n"))
    cut = (ps.join(n, "__l").where(F.col("__c_cum") < F.ceil(F.col("__n") * F.lit(test_frac)))
           .groupBy("__l").agg(F.max("__h").alias("__cut")))
    return (h.join(cut, "__l", "left").withColumn(out, F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False)))
            .select(*[F.col(f"`{c}`") for c in df.columns], out))


# M5 ------------------------------------------------------------------------
@dataclass
class Binned:
    """A classifier fitted on bin numbers, and the upper ends of each feature's bins but the last."""
    clf: object
    cuts: list

    def numbers(self, df: DataFrame, features: str, out: str) -> DataFrame:
        """``out``: the bin number of every feature (how many ends lie below it)."""
        def number(i: int, ends: list):
            x = F.col("__values")[i]
            if len(ends) <= 2:
                return sum(((x > end).cast("int") for end in ends), F.lit(0)).cast("double")
            # one small expression for all ends: generated code of a comparison each is too long to be compiled
            return F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends]), lambda e: e < x)).cast("double")
        numbers = [number(i, c) for i, c in enumerate(self.cuts)]
        return df.withColumn("__values", vector_to_array(features)).withColumn(out, F.array(*numbers)).drop("__values")


def bin_ends(rows: DataFrame, max_bins: int, weight: str | None = None, seed: int = SEED) -> list[list[float]]:
    """The candidate thresholds of each feature as Spark's tree learners choose
    them: halfway between neighbouring values, all of them if there are fewer
    than ``max_bins`` values, else those nearest to equal weights.  They come
    from a bounded sample (all rows of a small table); only its distinct values
    reach the driver."""
    n = rows.count()
    need = max(max_bins * max_bins, BIN_SAMPLE)
    some = rows.sample(need / n, seed) if n > need else rows
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    values = (some.select(w.alias("w"), F.posexplode(vector_to_array("features")).alias("i", "v"))
              .groupBy("i", "v").agg(F.sum("w").alias("w")).collect())
    by: dict[int, list] = {}
    for r in values:
        by.setdefault(r["i"], []).append((r["v"], r["w"]))
    n_cuts = min(max_bins, n) - 1
    return [_ends(sorted(by[i]), n_cuts) for i in sorted(by)]


def _ends(values: list[tuple[float, float]], n_cuts: int) -> list[float]:
    mid = [(a[0] + b[0]) / 2 for a, b in zip(values, values[1:])]
    if len(mid) <= n_cuts:
        return mid
    stride = sum(w for _, w in values) / (n_cuts + 1)
    out, seen, target = [], values[0][1], stride
    for at, (_, w) in zip(mid, values[1:]):
        if abs(seen - target) < abs(seen + w - target):
            out.append(at)
            target += stride
        seen += w
    return out


@dataclass
class Pooled:
    """How many rows share their bins, label and weight (and fold), written once:
    ``__bins, label, __w, __n`` (and ``__fold``)."""
    cuts: list
    table: DataFrame
    settings: tuple

    def part(self, cond) -> Pooled:
        return replace(self, table=self.table.where(cond))


def _pool_settings(estimator) -> tuple | None:
    """What the bins of the estimator's rows depend on; None if its fit sees more
    of the rows than how many there are of each label and weight in the bins:
    rows drawn one by one without replacement, a least number of rows."""
    if isinstance(estimator, GBTClassifier):
        ok = estimator.getSubsamplingRate() == 1 and not estimator.isDefined(estimator.validationIndicatorCol)
    else:
        ok = isinstance(estimator, RandomForestClassifier) and estimator.getBootstrap() and estimator.getMinWeightFractionPerNode() == 0
    if not ok or estimator.getMinInstancesPerNode() > 1:
        return None
    weight = estimator.getWeightCol() if estimator.isDefined(estimator.weightCol) else None
    return estimator.getMaxBins(), estimator.getSeed(), estimator.getLabelCol(), weight


def pool(rows: DataFrame, estimator) -> Pooled | None:
    """The rows counted by their bins, if there are many and the fit allows it."""
    from vireo.session import cut_lineage
    settings = _pool_settings(estimator)
    if settings is None or rows.count() <= POOL_FROM:
        return None
    max_bins, seed, label, weight = settings
    cuts = bin_ends(rows, max_bins, weight, seed)
    if len(cuts) > MAX_BINNED:
        return None
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    fold = ["__fold"] if "__fold" in rows.columns else []
    counted = Binned(None, cuts).numbers(rows.withColumn("__w", w), "features", "__bins").groupBy("__bins", label, "__w", *fold)
    return Pooled(cuts, cut_lineage(counted.agg(F.count(F.lit(1)).alias("__n"))), settings)


def fit_classifier(estimator, rows: DataFrame, pooled: Pooled | None = None):
    """Fit on (features, label, weight).  Trees see of a feature only its bin.
    In boosted trees, rows with the same bins and label have the same residual in
    every round, so they are fitted on one row per such combination with the sum
    of the weights: the same trees (but for which of several equally good splits
    is taken: rounding decides), in work bounded by the combinations rather than
    the rows.  A forest draws each row a Poisson number of times for every tree
    (mean: the subsampling rate); such draws of n rows add up to a Poisson number
    of mean n times as large, so combinations of ``FOREST_POOL`` rows or more on
    average are drawn at once: the same distribution of forests.  A small table is
    fitted as it is.  ``pooled`` holds the same rows, counted."""
    from vireo.session import cut_lineage
    pooled = pooled if pooled and pooled.settings == _pool_settings(estimator) else pool(rows, estimator)
    label = estimator.getLabelCol()
    if pooled:
        n, top = pooled.table.agg(F.sum("__n"), F.max(label)).first()
        pooled = pooled if (n or 0) > POOL_FROM else None
    if pooled and isinstance(estimator, GBTClassifier):
        sums = pooled.table.groupBy("__bins", label).agg(F.sum(F.col("__w") * F.col("__n")).alias("__weight"))
        sums = cut_lineage(sums.select(array_to_vector("__bins").alias("features"), label, "__weight"))
        few = sums.coalesce(1 + sums.count() // ROWS_PER_TASK)
        return Binned(estimator.copy({estimator.weightCol: "__weight", estimator.featuresCol: "features"}).fit(few), pooled.cuts)
    if pooled:
        counts = cut_lineage(pooled.table.groupBy("__bins", label, "__w").agg(F.sum("__n").alias("__n")))
        kinds = counts.count()
        if kinds * FOREST_POOL <= n:
            return Binned(_fit_forest(estimator, counts, kinds, int(top) + 1), pooled.cuts)
    if isinstance(estimator, RandomForestClassifier):
        n = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_TASK)
        return estimator.copy().fit(rows.repartition(n) if n > rows.rdd.getNumPartitions() else rows)
    return estimator.copy().fit(rows)


def poisson_draws(counts: DataFrame, trees: int, rate: float, seed: int, label: str) -> DataFrame:
    """``__t0 ...``: how often each combination's rows are drawn for a tree.  The
    draws come from the seed and the combination, wherever its row lies."""
    names = [f"__t{k}" for k in range(trees)]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            drawn = np.empty((len(b), trees), dtype=np.int64)
            for i, (key, n) in enumerate(zip(b["__key"], b["__n"])):
                drawn[i] = np.random.default_rng([seed % 2**63, key % 2**64]).poisson(rate * n, trees)
            yield pd.concat([b.reset_index(drop=True), pd.DataFrame(drawn, columns=names)], axis=1)
    keyed = counts.withColumn("__key", F.xxhash64("__bins", label, "__w"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema] + [f"{c} bigint" for c in names])
    return keyed.mapInPandas(draw, schema).drop("__key")


def _fit_forest(estimator, counts: DataFrame, kinds: int, classes: int) -> RandomForestClassificationModel:
    """A forest of trees that are fitted one by one, each on its own draw of the
    combinations, several at a time.  Every tree takes the features of a node as
    the forest's do."""
    from vireo.session import cut_lineage
    spark, trees, label = counts.sparkSession, estimator.getNumTrees(), estimator.getLabelCol()
    cores = spark.sparkContext.defaultParallelism
    drawn = cut_lineage(poisson_draws(counts.repartition(min(cores, 1 + kinds // POOL_FROM)), trees, estimator.getSubsamplingRate(),
                                      estimator.getSeed(), label))
    features = estimator.getFeatureSubsetStrategy()
    features = "sqrt" if features == "auto" and trees > 1 else features
    classes_known = {"ml_attr": {"type": "nominal", "num_vals": classes}}  # a tree may draw none of a class
    seeds = np.random.SeedSequence(estimator.getSeed() % 2**63).generate_state(trees).tolist()
    alone = estimator.copy({estimator.numTrees: 1, estimator.bootstrap: False, estimator.subsamplingRate: 1.0, estimator.weightCol: "__weight",
                            estimator.featureSubsetStrategy: features, estimator.featuresCol: "features"})

    def one(k: int):
        n = F.col(f"__t{k}")
        rows = drawn.where(n > 0).select(array_to_vector("__bins").alias("features"), (n * F.col("__w")).alias("__weight"),
                                         F.col(label).alias(label, metadata=classes_known))
        return alone.copy({alone.seed: seeds[k]}).fit(rows.coalesce(1 + kinds // ROWS_PER_TASK))

    fitted = _parallel_map(one, list(range(trees)), min(TREES_AT_ONCE, 2 * cores))
    kind = spark._jvm.org.apache.spark.ml.classification
    each = spark.sparkContext._gateway.new_array(kind.DecisionTreeClassificationModel, trees)
    for k, m in enumerate(fitted):
        each[k] = m._java_obj.trees()[0]
    java = kind.RandomForestClassificationModel(estimator.uid, each, fitted[0].numFeatures, classes)
    model = estimator._copyValues(RandomForestClassificationModel(java))
    model._transfer_params_to_java()
    return model


@dataclass
class ScoringModel:
    """A fitted preprocessor and an ensemble of (classifier, calibrator) pairs."""
    prep: PipelineModel | None = None
    members: list = field(default_factory=list)   # [(classification model, calibrator or None)]
    name: str = "model"

    def transform(self, df: DataFrame, out: str = "risk_score") -> DataFrame:
        """Mean of the members' calibrated probabilities; the features are made once."""
        return self.score_features(self.prep.transform(df), df.columns, out)

    def cuts(self) -> list | None:
        """The bins that all members were fitted on."""
        all_cuts = [clf.cuts if isinstance(clf, Binned) else None for clf, _ in self.members]
        return all_cuts[0] if all(c == all_cuts[0] for c in all_cuts) else None

    def score_counted(self, counted: DataFrame, keep: list[str], out: str = "risk_score") -> DataFrame:
        """The scores of rows counted (``__n``) by ``keep`` and the members' bins, a row for each."""
        s = self.score_features(counted, [*keep, "__n"], out, bins="__bins")
        part = s.withColumn("__p", F.explode(F.sequence(F.lit(0), F.col("__n") - 1, F.lit(REPEAT).cast("bigint"))))
        each = F.explode(F.sequence(F.lit(1), F.least(F.lit(REPEAT), F.col("__n") - F.col("__p"))))
        return part.withColumn("__p", each).drop("__p", "__n")

    def score_features(self, made: DataFrame, keep: list[str], out: str = "risk_score", bins: str | None = None) -> DataFrame:
        """``bins``: the column that has the bin numbers already."""
        acc = made.select(*[f"`{c}`" for c in keep], F.col(bins or "features").alias("__x"))
        scores = []
        for i, (clf, cal) in enumerate(self.members):
            x = "__x"
            if isinstance(clf, Binned):
                acc = (acc.withColumn("__b", F.col("__x")) if bins else clf.numbers(acc, "__x", "__b")).withColumn("__b", array_to_vector("__b"))
                clf, x = clf.clf, "__b"
            one = clf.copy({clf.featuresCol: x, clf.probabilityCol: f"__v{i}", clf.rawPredictionCol: "", clf.predictionCol: ""})
            acc = one.transform(acc).withColumn(f"__r{i}", vector_to_array(f"__v{i}")[1]).drop(f"__v{i}", "__b")
            if isinstance(cal, IsotonicRegressionModel):
                acc = cal.copy({cal.featuresCol: f"__r{i}", cal.predictionCol: f"__p{i}"}).transform(acc)
                scores.append(F.col(f"__p{i}"))
            elif cal is not None:
                z = F.col(f"__r{i}") * F.lit(float(cal.coefficients[0])) + F.lit(float(cal.intercept))
                scores.append(1 / (1 + F.exp(-z)))
            else:
                scores.append(F.col(f"__r{i}"))
        mean = sum(scores, F.lit(0.0)) / F.lit(len(scores))
        return acc.select(*[f"`{c}`" for c in keep], mean.alias(out))


def fit_calibrator(held: DataFrame, method: str, label: str = "label", raw: str = "__raw", digits: int = 6, count: str | None = None):
    """A calibrator of raw scores (``count``: of how many rows): ``sigmoid`` (logistic regression on the score)
    or ``isotonic`` (pool adjacent violators).  For the latter equal scores, to
    ``digits`` places, are first pooled to one weighted row, so at most
    10**digits rows are left; Spark pools violators inside ranges of the score
    before it joins the ranges."""
    if method == "sigmoid":
        rows = held.select(raw, F.col(label).alias("label"), *([F.col(count).cast("double").alias("__count")] if count else []))
        lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0, maxIter=100, **{"weightCol": "__count"} if count else {})
        return lr.fit(VectorAssembler(inputCols=[raw], outputCol="features").transform(rows))
    if method != "isotonic":
        raise ValueError(f"unknown calibration {method!r}")
    y, n = F.col(label).cast("double"), F.col(count) if count else F.lit(1)
    mean = F.sum(y * n) / F.sum(F.when(y.isNotNull(), n)) if count else F.avg(y)
    pooled = held.groupBy(F.round(raw, digits).alias("__score")).agg(mean.alias("__mean"), F.sum(n).cast("double").alias("__n"))
    return IsotonicRegression(featuresCol="__score", labelCol="__mean", weightCol="__n", isotonic=True).fit(pooled)


def made_features(df: DataFrame, numeric: list[str], categorical: list[str], folds: int = 3, key: str = "ra",
                  seed: int = SEED) -> tuple[PipelineModel, DataFrame]:
    """The fitted preprocessor and the training rows as features with their
    fold (by a hash of the key), written once for every fit that reads them."""
    from vireo.session import cut_lineage
    prep = fit_preprocessor(df, numeric, categorical)
    fold = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed + 1)), F.lit(folds)).alias("__fold")
    keep = [c for c in ("label", "weight") if c in df.columns]
    return prep, cut_lineage(prep.transform(df).select("features", *keep, fold))


def fit(df: DataFrame, numeric: list[str], categorical: list[str], estimator, calibration: str | None = "sigmoid",
        folds: int = 3, key: str = "ra", seed: int = SEED, label: str = "label",
        parallelism: int = 3, made: tuple[PipelineModel, DataFrame] | None = None, pooled: Pooled | None = None) -> ScoringModel:
    """Fit; with ``calibration`` ``'sigmoid'`` or ``'isotonic'`` cross-fit
    ``folds`` models, each with a calibrator fitted on its held-out fold,
    averaged at scoring.  ``made`` (from ``made_features``) shares one table of
    features between candidates, ``pooled`` one of its rows counted by bins; the
    preprocessor and the bins learn from all training rows.

    The folds are independent Spark jobs submitted from ``parallelism``
    threads (as Spark ML's own tuning does), so small fits overlap; a forest
    holds every row's draw and node of every tree, so its folds take turns."""
    from vireo.session import cut_lineage
    if label != "label":
        df = df.withColumnRenamed(label, "label")
        estimator = estimator.copy({estimator.labelCol: "label"})
    prep, rows = made or made_features(df, numeric, categorical, folds, key, seed)
    if not calibration:
        return ScoringModel(prep, [(fit_classifier(estimator, rows, pooled), None)], type(estimator).__name__)

    forest = isinstance(estimator, RandomForestClassifier)
    if not pooled or pooled.settings != _pool_settings(estimator):
        pooled = pool(rows, estimator)

    def one(k: int):
        out, own = F.col("__fold") != k, F.col("__fold") == k
        clf = fit_classifier(estimator, rows.where(out), pooled and pooled.part(out))
        alone = ScoringModel(None, [(clf, None)])
        # written: the calibrator reads the scores more than once
        if isinstance(clf, Binned) and pooled:
            held = cut_lineage(alone.score_features(pooled.part(own).table, ["label", "__n"], "__raw", bins="__bins"))
            return clf, fit_calibrator(held, calibration, count="__n")
        held = cut_lineage(alone.score_features(rows.where(own), ["label"], "__raw"))
        return clf, fit_calibrator(held, calibration)

    return ScoringModel(prep, _parallel_map(one, list(range(folds)), 1 if forest else parallelism), type(estimator).__name__)


def _parallel_map(fn, items: list, parallelism: int) -> list:
    """Run independent Spark fits from a small thread pool, keeping order."""
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


# M6 / M9 -------------------------------------------------------------------
def train_and_select(df: DataFrame, numeric: list[str], categorical: list[str], key: str = "ra",
                     label: str = "label", calibration: str | None = "sigmoid", min_recall: float = 0.75,
                     names: list[str] | None = None, seed: int = SEED):
    """Outer split (test), inner split (validation), fit each candidate,
    choose its threshold on validation, pick the best by (recall, pr_auc),
    evaluate it once on test.  Returns (best model, threshold, report)."""
    from vireo.operators.evaluate import ranking_metrics, select_threshold
    from vireo.session import cut_lineage
    # The splits are reused by every fit and evaluation: materialise them once
    # (reliable checkpoint in the shared folder) instead of recomputing the plan;
    # a split reads its rows several times, so they are written before the first.
    df = cut_lineage(df)
    s1 = cut_lineage(stratified_split(df, label, key, 0.2, seed, "__test"))
    test = s1.where(F.col("__test")).drop("__test")
    rest = cut_lineage(stratified_split(s1.where(~F.col("__test")).drop("__test"), label, key, 0.2, seed + 7, "__val"))
    val = rest.where(F.col("__val")).drop("__val")
    train = cut_lineage(balanced_weights(rest.where(~F.col("__val")).drop("__val"), label))
    n_train = train.count()
    cands = [(n, e) for n, e in candidates(n_train, seed, label).items() if not names or n in names]
    if label != "label":
        raise ValueError("the target is named label")
    # one preprocessor and one table of features for all candidates
    made = made_features(train, numeric, categorical, key=key, seed=seed)
    trees = [e for _, e in cands if _pool_settings(e)]
    pooled = pool(made[1], trees[0]) if trees else None
    fitted = _parallel_map(lambda ne: fit(train, numeric, categorical, ne[1], calibration, key=key, seed=seed,
                                          parallelism=3, made=made, pooled=pooled), cands, len(cands))
    counted: dict[str, list] = {}

    def scores(m: ScoringModel, part: str, name: str) -> DataFrame:
        """Written: they are read twice.  Models on the same bins share one count of the rows by them."""
        cuts = m.cuts()
        if cuts is None:
            s = m.transform(parts[part]).select(label, "risk_score")
        else:
            have = next((t for c, t in counted.setdefault(part, []) if c == cuts), None)
            if have is None:
                of = Binned(None, cuts).numbers(made[0].transform(parts[part]), "features", "__bins").groupBy(label, "__bins")
                have = cut_lineage(of.agg(F.count(F.lit(1)).alias("__n")))
                counted[part].append((cuts, have))
            s = m.score_counted(have, [label])
        return cut_lineage(s).withColumn("__m", F.lit(name))

    parts = {"validation": val, "test": test}
    rows, models = [], {}
    for (name, _), m in zip(cands, fitted):
        sv = scores(m, "validation", name)
        thr = select_threshold(sv, ["__m"], label, "risk_score", "max_recall", min_recall=min_recall).first()
        rk = ranking_metrics(sv, ["__m"], label, "risk_score").first()
        rows.append((name, "validation", float(thr["threshold"]), thr["recall"], thr["precision"], thr["f2"],
                     rk["pr_auc"], rk["roc_auc"], rk["brier_score"]))
        models[name] = (m, float(thr["threshold"]))
    best = max(rows, key=lambda r: (r[3], r[6] or 0.0))
    bm, bthr = models[best[0]]
    st = scores(bm, "test", best[0])
    from vireo.operators.evaluate import classification_metrics
    cm = classification_metrics(st, ["__m"], label, "risk_score", bthr).first()
    rk = ranking_metrics(st, ["__m"], label, "risk_score").first()
    rows.append((best[0], "test", bthr, cm["recall"], cm["precision"], cm["f2"], rk["pr_auc"], rk["roc_auc"],
                 rk["brier_score"]))
    report = df.sparkSession.createDataFrame(
        rows, "model string, split string, threshold double, recall double, precision double, f2 double, "
              "pr_auc double, roc_auc double, brier_score double")
    return bm, bthr, report


# M8 ------------------------------------------------------------------------
def score(df: DataFrame, model: ScoringModel, threshold: float, version: str,
          signature: dict[str, str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Align to the signature, score, round to 6 places, label, version."""
    keep = [c for c in (keep or []) if c in df.columns]
    base = df
    if signature is not None:
        # absent features become typed nulls (imputed by the pipeline); extras are dropped
        base = df.select(*keep, *[(F.col(n).cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n)
                                  for n, t in signature.items() if n not in keep])
    s = model.transform(base)
    return s.select(*keep, F.round("risk_score", 6).alias("risk_score"),
                    (F.round("risk_score", 6) >= threshold).cast("int").alias("risk_label"),
                    F.lit(version).alias("model_version"))


def save(model: ScoringModel, path: str) -> None:
    model.prep.write().overwrite().save(f"{path}/preprocessor")
    for i, (clf, cal) in enumerate(model.members):
        cuts = clf.cuts if isinstance(clf, Binned) else []
        clf = clf.clf if isinstance(clf, Binned) else clf
        clf.write().overwrite().save(f"{path}/member_{i}/classifier")
        if isinstance(clf, _BINNED):
            spark = SparkSession.active()
            spark.createDataFrame(list(enumerate(cuts)), _BINS).coalesce(1).write.mode("overwrite").parquet(f"{path}/member_{i}/bins")
        if cal is not None:
            cal.write().overwrite().save(f"{path}/member_{i}/calibrator")


_BINS, _BINNED = "feature int, ends array<double>", (GBTClassificationModel, RandomForestClassificationModel)


def _load_classifier(kind, path: str):
    clf = kind.load(f"{path}/classifier")
    if kind not in _BINNED:
        return clf
    try:
        cuts = [list(r["ends"]) for r in SparkSession.active().read.schema(_BINS).parquet(f"{path}/bins").orderBy("feature").collect()]
    except AnalysisException:  # saved before trees were fitted on bins
        cuts = []
    return Binned(clf, cuts) if cuts else clf


def load(path: str, n_members: int, calibration: str | None = "sigmoid", kind=LogisticRegressionModel) -> ScoringModel:
    """A saved model: ``kind`` is the class of its classifiers."""
    read = {"sigmoid": LogisticRegressionModel, "isotonic": IsotonicRegressionModel}
    return ScoringModel(PipelineModel.load(f"{path}/preprocessor"), [
        (_load_classifier(kind, f"{path}/member_{i}"), read[calibration].load(f"{path}/member_{i}/calibrator") if calibration else None)
        for i in range(n_members)])
