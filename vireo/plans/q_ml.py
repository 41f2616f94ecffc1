"""Registered queries: Spark ML fit and score."""

from pyspark.sql import functions as F

from vireo.operators import ml as M
from vireo.plans.bindings import subject_year, table, with_views
from vireo.plans.catalog import query
from vireo.plans.modeling import MODELING_SQL, modeling_long

NUMERIC = ["fase", "ian", "ida", "ieg", "ano_ingresso"]
CATEGORICAL = ["c_mktsegment"]


def training_table(spark, d):
    """Features at t with the outcome at t+1, plus the customer segment."""
    m = modeling_long(subject_year(spark, d))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("ra"), "c_mktsegment")
    return m.join(c, "ra", "left").withColumnRenamed("em_risco", "label")


@query("m2_class_weights", with_views("""
SELECT em_risco AS label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM m GROUP BY em_risco""", "v1", ctes=[MODELING_SQL]))
def m2_class_weights(spark, d):
    w = M.balanced_weights(training_table(spark, d), "label")
    return w.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.first("weight"), 6).alias("weight"))


@query("m4_stratified_split_counts", with_views("""
SELECT is_test, label, CASE WHEN is_test THEN t ELSE n - t END AS n
FROM (SELECT em_risco AS label, count(*) AS n, CAST((count(*) + 4) // 5 AS BIGINT) AS t FROM m GROUP BY em_risco),
  (VALUES (true), (false)) s(is_test)""", "v1", ctes=[MODELING_SQL]))
def m4_stratified_split_counts(spark, d):
    """Exactly ceil(20%) of the rows per class in test, repeatable by seed."""
    s = M.stratified_split(training_table(spark, d), "label", ["ra", "ano"], 0.2)
    return s.groupBy("is_test", "label").agg(F.count(F.lit(1)).alias("n"))


_M1 = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM m" for c in NUMERIC)


@query("m1_preprocessor_summary", with_views(f"""
SELECT feature, round(median, 6) AS median, round(avg(coalesce(x, median)), 6) AS mean, round(stddev_pop(coalesce(x, median)), 6) AS std
FROM ({_M1}) JOIN (SELECT feature, quantile_cont(x, 0.5) AS median FROM ({_M1}) GROUP BY feature) USING (feature) GROUP BY feature, median""",
       "v1", ctes=[MODELING_SQL]))
def m1_preprocessor_summary(spark, d):
    """What the preprocessor learns from the numeric columns."""
    st = M.numeric_statistics(training_table(spark, d), NUMERIC)
    return st.select("feature", *[F.round(c, 6).alias(c) for c in ("median", "mean", "std")])


@query("m6_model_selection_report")
def m6_model_selection_report(spark, d):
    """Rows-only: three class-weighted candidates, sigmoid-calibrated by
    3-fold cross-fitting, threshold on validation, best tested once."""
    _, _, report = M.train_and_select(training_table(spark, d), NUMERIC, CATEGORICAL, key="ra")
    return report


@query("m8_batch_scoring")
def m8_batch_scoring(spark, d):
    """Rows-only: fit the linear candidate on periods before the last and
    score the rows of every period (aligned to the training signature)."""
    df = training_table(spark, d)
    last = df.agg(F.max("ano")).first()[0]
    train = M.balanced_weights(df.where(F.col("ano") < last), "label")
    est = M.candidates(train.count())["logreg"]
    model = M.fit(train, NUMERIC, CATEGORICAL, est, calibration="sigmoid", key="ra")
    sig = {**{c: "double" for c in NUMERIC}, "c_mktsegment": "string"}
    return M.score(df, model, 0.5, "v1", sig, keep=["ra", "ano"])


@query("m5_isotonic_calibration")
def m5_isotonic_calibration(spark, d):
    """Rows-only: Brier score of the linear candidate on held-out subjects,
    uncalibrated and under both calibrations."""
    from vireo.operators.evaluate import ranking_metrics
    df = training_table(spark, d)
    split = M.stratified_split(df, "label", "ra", 0.2)
    train, test = M.balanced_weights(split.where(~F.col("is_test")), "label"), split.where("is_test")
    made = M.made_features(train, NUMERIC, CATEGORICAL)
    est = M.candidates(train.count())["logreg"]
    out = None
    for how in (None, "sigmoid", "isotonic"):
        s = M.fit(train, NUMERIC, CATEGORICAL, est, how, made=made).transform(test)
        r = ranking_metrics(s.withColumn("calibration", F.lit(how or "none")), ["calibration"], "label", "risk_score")
        r = r.select("calibration", F.round("brier_score", 6).alias("brier_score"))
        out = r if out is None else out.unionByName(r)
    return out


@query("m8_score_prepared")
def m8_score_prepared(spark, d):
    """Rows-only: a model trained on the prepared snapshots (M7) scores them
    aligned to its signature (P12), flags and features by the decisions of the training."""
    from vireo.operators import jobs as J
    from vireo.plans.q_jobs import prepared
    from vireo.session import cut_lineage
    modeling = cut_lineage(prepared(spark, d).modeling)
    ready = J.load_and_prepare(modeling.drop("ano"), keep_ids=True)
    text = [c for c, t in ready.signature.items() if t == "string"]
    numeric = [c for c, t in ready.signature.items() if t != "string"]
    train = M.balanced_weights(ready.table, "label")
    model = M.fit(train, numeric, text, M.candidates(train.count())["logreg"], "sigmoid", key="ra")
    rows = J.prepare_for_scoring(modeling.drop("em_risco"), ready, ids=("ra", "ano"))
    return M.score(rows, model, 0.5, "v1", ready.signature, keep=["ra", "ano"])


_W6_RANGES = {"ian": (0.0, 10.0), "ida": (0.0, 10.0)}
_W6_REQUIRED = ["fase"]


def _w6_rows(spark, d):
    """Feature rows as a client might send them: some numbers are no numbers, some are missing."""
    df = training_table(spark, d)
    bad = F.when(F.col("ra") % 10 == 0, F.lit("n/a")).otherwise(F.col("ida").cast("string"))
    return df.withColumn("ida", bad).withColumn("fase", F.when(F.col("ra") % 17 != 0, F.col("fase")))


_W6_REASONS = """SELECT ano, ra % 10 = 0 AS bad_ida, ra % 17 = 0 AS no_fase,
  ida IS NOT NULL AND ra % 10 <> 0 AND NOT ida BETWEEN 0 AND 10 AS out_ida, NOT ian BETWEEN 0 AND 10 AS out_ian FROM m"""


def _w6_run(spark, d, replay: bool = False):
    from vireo.streaming import jobs as W
    df = training_table(spark, d)
    train = M.balanced_weights(df, "label")
    model = M.fit(train, NUMERIC, CATEGORICAL, M.candidates(train.count())["logreg"], calibration=None)
    src, out, ckpt = W.shared_path(spark, "w6-src"), W.shared_path(spark, "w6-out"), W.shared_path(spark, "w6-ckpt")
    rows = _w6_rows(spark, d).drop("label").withColumn("ts", F.make_timestamp(F.col("ano"), *[F.lit(x) for x in (1, 1, 0, 0, 0)]))
    rows.repartition("ano").write.parquet(src)
    sig = {**{c: "double" for c in NUMERIC}, "c_mktsegment": "string"}
    score = lambda b: M.score(b, model, 0.5, "v1", sig, keep=["ra", "ano", "ts"])
    # a second run under a new checkpoint gives every batch its number again, as a replay does
    for c in ([ckpt, ckpt + "-again"] if replay else [ckpt]):
        W.score_batches(W.file_stream(spark, f"{src}/*.parquet", max_files=1), score, sig, out, c, _W6_RANGES, _W6_REQUIRED)
    return out


@query("w6_streaming_score", with_views(f"""
SELECT ano, count(*) AS n_in, count(*) FILTER (WHERE NOT (bad_ida OR no_fase OR coalesce(out_ida, false) OR coalesce(out_ian, false))) AS n_scored,
  count(*) FILTER (WHERE bad_ida) AS n_not_a_number, count(*) FILTER (WHERE no_fase) AS n_missing
FROM ({_W6_REASONS}) GROUP BY ano""", "v1", ctes=[MODELING_SQL]))
def w6_streaming_score(spark, d):
    """The scoring function per micro-batch of a stream of feature rows, of
    which every row is scored once or rejected with its reasons, although all batches run twice."""
    out = _w6_run(spark, d, replay=True)
    done = spark.read.parquet(f"{out}/scored").groupBy("ano").agg(F.count(F.lit(1)).alias("n_scored"))
    why = lambda text: F.count_if(F.array_contains("reasons", text))
    gone = spark.read.parquet(f"{out}/rejected").groupBy("ano").agg(
        F.count(F.lit(1)).alias("n_bad"), why("ida: not a number").alias("n_not_a_number"), why("fase: missing").alias("n_missing"))
    both = done.join(gone, "ano", "full").na.fill(0)
    return both.select("ano", (F.col("n_scored") + F.col("n_bad")).alias("n_in"), "n_scored", "n_not_a_number", "n_missing")
