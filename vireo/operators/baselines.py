"""Stored baselines and daily counts for drift (A5, A10 over days).

A baseline is built once from its window and stored as small tables: profile,
edges and bin counts of the numeric features, categories of the others, score
bins.  Each day is then counted once on that baseline's bins and categories;
the counts of a day are a partition of a table with a bounded number of rows
per day.  A drift run over any days adds up those partitions and compares
them with the stored baseline: it reads neither window again.

A day counted again replaces its partition, so the daily job can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import config as C
from vireo.functions.stats import combine_one_row
from vireo.operators import drift as D
from vireo.operators.profile import _q, edge_bin, unit_edges

#: key of the count of rows, and of values outside the baseline's categories
ROWS, OTHER, SCORE = "__rows__", "__other__", "__score__"


def _long(df: DataFrame, cols: list[str], cast: str) -> DataFrame:
    return df.select(*[F.col(_q(c)).cast(cast).alias(c) for c in cols]).unpivot([], cols, "feature", "value")


def store_baseline(df: DataFrame, path: str, version: str, numeric: list[str], categorical: list[str], score: str | None = None,
                   top_k: int = 10) -> None:
    """Build the baseline of a window and write it below ``path/version``:
    ``numeric`` (profile, edges, bin counts, missing rate), ``categorical`` (value,
    frequency), ``missing`` and ``score`` (bin, frequency, mean)."""
    spark, at = df.sparkSession, f"{path}/{version}"
    absent = {c: F.nanvl(F.col(_q(c)).cast("double"), F.lit(None).cast("double")).isNull() for c in numeric} | {c: F.col(_q(c)).isNull() for c in categorical}
    missing = df.agg(*[F.coalesce(F.avg(x.cast("double")), F.lit(1.0)).alias(c) for c, x in absent.items()])
    missing.unpivot([], [*numeric, *categorical], "feature", "missing_rate").write.mode("overwrite").parquet(f"{at}/missing")
    if numeric:
        profile = D.numeric_profile_long(_long(df, numeric, "double"))
        profile.join(D.numeric_edges(profile), "feature").write.mode("overwrite").parquet(f"{at}/numeric")
    if categorical:
        D.categorical_profile_long(_long(df, categorical, "string"), top_k).write.mode("overwrite").parquet(f"{at}/categorical")
    else:
        spark.createDataFrame([], "feature string, value string, cnt bigint, freq double").write.mode("overwrite").parquet(f"{at}/categorical")
    # the window on its own bins
    counts = window_counts(df, read_baseline(spark, path, version), score)
    counts.write.mode("overwrite").parquet(f"{at}/counts")


class Baseline:
    """A stored baseline.  What is fetched is bounded by the schema: edges per
    numeric feature and the top categories of the others."""

    def __init__(self, spark: SparkSession, path: str, version: str):
        self.at, self.version = f"{path}/{version}", version
        read = spark.read.parquet
        self.missing, self.categorical = read(f"{self.at}/missing"), read(f"{self.at}/categorical")
        named = [r["feature"] for r in self.missing.select("feature").collect()]
        cats: dict[str, list] = {}
        for r in self.categorical.collect():
            cats.setdefault(r["feature"], []).append(r["value"])
        try:
            self.numeric = read(f"{self.at}/numeric")
            self.edges = {r["feature"]: [float(e) for e in r["edges"] if e is not None] for r in self.numeric.select("feature", "edges").collect()}
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            self.numeric, self.edges = None, {}
        self.categories = {f: cats.get(f, []) for f in named if f not in self.edges}

    @property
    def counts(self) -> DataFrame:
        return self.missing.sparkSession.read.parquet(f"{self.at}/counts")


def read_baseline(spark: SparkSession, path: str, version: str) -> Baseline:
    return Baseline(spark, path, version)


def window_counts(df: DataFrame, baseline: Baseline, score: str | None = None, by: list | None = None) -> DataFrame:
    """(by..., feature, key, cnt, total) of a window on the baseline's bins and
    categories, in one scan and one aggregation.  ``key`` is the bin number or
    the category (``__other__`` beyond the stored ones), null for a missing
    value; ``__rows__`` counts the rows, ``__score__`` has the score's bins and
    sums (null: out of range).  At most bins x features rows per group."""
    def cell(feature, key, amount=F.lit(0.0)):
        return F.struct(F.lit(feature).alias("feature"), key.cast("string").alias("key"), amount.alias("amount"))

    cells = [cell(ROWS, F.lit(""))]
    for f, edges in baseline.edges.items():
        v = F.nanvl(F.col(_q(f)).cast("double"), F.lit(None).cast("double"))
        b = sum(((v >= e).cast("int") for e in edges), F.lit(0))
        cells.append(cell(f, F.when(v.isNotNull(), b)))
    for f, values in baseline.categories.items():
        v = F.col(_q(f)).cast("string")
        known = [x for x in values if x != OTHER]
        cells.append(cell(f, F.when(v.isNull() | v.isin(known), v).otherwise(F.lit(OTHER))))
    if score:
        s = F.nanvl(F.col(_q(score)).cast("double"), F.lit(None).cast("double"))
        # a row without a score has no cell
        cells.append(F.when(s.isNotNull(), cell(SCORE, edge_bin(s, unit_edges(C.SCORE_BINS)), s)))
    by = list(by or [])
    names = [c if isinstance(c, str) else f"__by{i}" for i, c in enumerate(by)]
    keyed = df.select(*[F.col(c) if isinstance(c, str) else c.alias(n) for c, n in zip(by, names)], F.explode(F.array(*cells)).alias("c"))
    return (keyed.where(F.col("c").isNotNull()).groupBy(*names, F.col("c.feature").alias("feature"), F.col("c.key").alias("key"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("c.amount").alias("total")))


def write_day_counts(df: DataFrame, ts: str, baseline: Baseline, store: str, score: str | None = None, dt: str = "dt") -> None:
    """Count every day of ``df`` on the baseline and write its partition; a day
    that is there already is replaced.  ``df`` must hold its days whole."""
    day = df.withColumn(dt, F.to_date(F.col(ts)))
    (window_counts(day, baseline, score, [dt]).withColumn("version", F.lit(baseline.version))
     .repartition(dt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", dt).parquet(store))


def read_day_counts(spark: SparkSession, store: str, baseline: Baseline, start=None, end=None, dt: str = "dt") -> DataFrame:
    """The counts of the days from ``start`` to ``end`` (both included), added up;
    only their partitions are read."""
    days = spark.read.parquet(store).where(F.col("version") == F.lit(baseline.version))
    if start is not None:
        days = days.where(F.col(dt) >= F.lit(str(start)).cast("date"))
    if end is not None:
        days = days.where(F.col(dt) <= F.lit(str(end)).cast("date"))
    return days.groupBy("feature", "key").agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))


def drift_from_counts(counts: DataFrame, baseline: Baseline, digits: int = 4) -> DataFrame:
    """The rows of A10 (psi, missing rates, status per feature) from the counts
    of a window; see ``feature_drift`` for the rules."""
    spark = counts.sparkSession
    own = counts.where(~F.col("feature").isin(ROWS, SCORE))
    rows = counts.where(F.col("feature") == ROWS).agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"))
    valued = own.where(F.col("key").isNotNull())
    totals = valued.groupBy("feature").agg(F.sum("cnt").alias("ct"))
    parts = []
    if baseline.edges:
        cells = [(f, str(i)) for f, e in baseline.edges.items() for i in range(len(e) + 1)]
        grid = spark.createDataFrame(cells, "feature string, key string")
        base = baseline.counts.where(F.col("key").isNotNull()).select("feature", "key", F.col("cnt").alias("bc"))
        btot = base.groupBy("feature").agg(F.sum("bc").alias("bt"))
        parts.append(F.broadcast(grid).join(base, ["feature", "key"], "left").join(btot, "feature", "left")
                     .select("feature", "key", (F.coalesce("bc", F.lit(0)) / F.col("bt")).alias("b_freq")))
    parts.append(baseline.categorical.select("feature", F.col("value").alias("key"), F.col("freq").alias("b_freq")))
    bins = parts[0]
    for p in parts[1:]:
        bins = bins.unionByName(p)
    g = (bins.join(valued.select("feature", "key", "cnt"), ["feature", "key"], "left").join(totals, "feature")
         .withColumn("c_freq", F.coalesce("cnt", F.lit(0)) / F.col("ct")))
    psi = D.psi(g, ["feature"])
    kinds = spark.createDataFrame([(f, "numeric") for f in baseline.edges] + [(f, "categorical") for f in baseline.categories],
                                  "feature string, type string")
    n = rows.first()["n"]
    j = (F.broadcast(kinds).join(psi, "feature", "left").join(totals, "feature", "left").join(baseline.missing, "feature", "left")
         .select("feature", "type", F.coalesce("psi", F.lit(0.0)).alias("psi"),
                 F.coalesce("missing_rate", F.lit(0.0)).alias("baseline_missing_rate"),
                 (1 - F.coalesce("ct", F.lit(0)) / F.lit(n) if n else F.lit(0.0)).alias("current_missing_rate")))
    delta = F.col("current_missing_rate") - F.col("baseline_missing_rate")
    st = D.with_missing_override(D.status("psi", C.PSI_WARN, C.PSI_ALERT), delta)
    return j.select("feature", "type", F.round("psi", digits).alias("psi"), F.round("baseline_missing_rate", digits).alias("baseline_missing_rate"),
                    F.round("current_missing_rate", digits).alias("current_missing_rate"), F.round(delta, digits).alias("missing_delta"),
                    st.alias("status"))


def score_drift_from_counts(counts: DataFrame, baseline: Baseline, digits: int = 4) -> DataFrame:
    """A13 from the counts of a window: one row."""
    def side(c, name):
        s = c.where(F.col("feature") == SCORE)
        t = s.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias(f"n_{name}"), F.sum("total").alias(f"sum_{name}"))
        return s.where(F.col("key").isNotNull()).select("key", F.col("cnt").alias(f"cnt_{name}")), t

    b, bt = side(baseline.counts, "b")
    c, ct = side(counts, "c")
    t = combine_one_row(bt, ct).first()
    grid = counts.sparkSession.range(C.SCORE_BINS).select(F.col("id").cast("string").alias("key"))
    g = grid.join(b, "key", "left").join(c, "key", "left").select(
        "key", *[(F.coalesce(f"cnt_{x}", F.lit(0)) / F.lit(max(t[f"n_{x}"] or 0, 1))).alias(f"{x}_freq") for x in "bc"])
    psi = D.psi(g, [])
    mean = {x: (t[f"sum_{x}"] / t[f"n_{x}"] if t[f"n_{x}"] else None) for x in "bc"}
    some = bool(t["n_c"])
    st = D.status("psi", C.PSI_WARN, C.PSI_ALERT) if some else F.lit("no_data")
    delta = mean["c"] - mean["b"] if some and mean["b"] is not None else 0.0
    return psi.select(F.round(F.col("psi") if some else F.lit(0.0), digits).alias("psi"),
                      F.round(F.lit(mean["b"]).cast("double"), digits).alias("baseline_mean"), F.round(F.lit(mean["c"] or 0.0), digits).alias("current_mean"),
                      F.round(F.lit(float(delta)), digits).alias("delta_mean"), st.alias("status"))


def global_status_from_counts(counts: DataFrame, baseline: Baseline) -> DataFrame:
    """A10's verdict over all features and the score."""
    n = counts.where(F.col("feature") == ROWS).agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
    return D.global_status(drift_from_counts(counts, baseline), score_drift_from_counts(counts, baseline), n)
