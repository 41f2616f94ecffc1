"""Joins (J1-J6).

Equi-joins are declared and left to AQE: it broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
keeps the sort-merge join, splitting skewed partitions.  Where we force a
broadcast, the side is bounded by construction (one row per feature or per
file) and that is stated next to the hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _q(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


# J1 ------------------------------------------------------------------------
def join_next_period(features: DataFrame, labels: DataFrame, key: str = "ra", period: str | None = None,
                     null_safe: bool = False, how: str = "inner") -> DataFrame:
    """Features at period t joined to labels at t+1 on the subject key.

    With ``period`` set, both sides are long tables and the join is on
    ``(key, labels.period = features.period + 1)``: every consecutive pair in
    one equi-join.  Duplicate keys multiply (no de-duplication), as in the
    original; null keys never match unless ``null_safe``.
    """
    if period is None:
        if null_safe:
            cond = features[key].eqNullSafe(labels[key])
            return features.join(labels, cond, how).drop(labels[key])
        return features.join(labels, key, how)
    lab = labels.withColumnRenamed(period, "__lp").withColumn("__fp", F.col("__lp") - 1)
    if null_safe:
        lab = lab.withColumnRenamed(key, "__lk")
        cond = features[key].eqNullSafe(lab["__lk"]) & (features[period] == lab["__fp"])
        return features.join(lab, cond, how).drop("__lk", "__lp", "__fp")
    lab = lab.withColumnRenamed("__fp", period)
    return features.join(lab, [key, period], how).drop("__lp")


# J2 ------------------------------------------------------------------------
def join_labels(predictions: DataFrame, labels: DataFrame, keys=("request_id",),
                label_col: str = "label") -> DataFrame:
    """Predictions with ground truth; one label fans out to every instance."""
    lab = labels.select(*keys, label_col)
    return predictions.join(lab, list(keys), "inner")


# J3 ------------------------------------------------------------------------
def key_overlap(a: DataFrame, b: DataFrame, key_a, key_b=None) -> DataFrame:
    """Distinct-key overlap: common / only-a / only-b counts and a pass flag.

    Keys may be one column or a list (compared as a struct); null keys are
    left out.
    """
    ka_cols = [key_a] if isinstance(key_a, str) else list(key_a)
    kb_cols = ka_cols if key_b is None else ([key_b] if isinstance(key_b, str) else list(key_b))

    def keys(df, cols, flag):
        k = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)]) if len(cols) > 1 else F.col(cols[0])
        notnull = None
        for c in cols:
            e = F.col(c).isNotNull()
            notnull = e if notnull is None else notnull & e
        return df.where(notnull).select(k.alias("__k")).distinct().withColumn(flag, F.lit(1))

    j = keys(a, ka_cols, "__a").join(keys(b, kb_cols, "__b"), "__k", "full_outer")
    return j.agg(
        F.count_if(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("n_common"),
        F.count_if(F.col("__b").isNull()).alias("n_only_a"),
        F.count_if(F.col("__a").isNull()).alias("n_only_b"),
    ).withColumn("passed", F.col("n_common") > 0)


# J4 ------------------------------------------------------------------------
def matched(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "left_semi")


def unmatched(a: DataFrame, b: DataFrame, on) -> DataFrame:
    return a.join(b, on, "left_anti")


def match_split_summary(a: DataFrame, b: DataFrame, key_a: str, key_b: str | None = None) -> DataFrame:
    """Rows of ``a`` with / without a partner in ``b`` and the share lost."""
    key_b = key_b or key_a
    keys = b.select(F.col(key_b).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    j = a.join(keys, a[key_a] == keys["__k"], "left")
    return j.agg(F.count_if(F.col("__hit").isNotNull()).alias("n_matched"),
                 F.count_if(F.col("__hit").isNull()).alias("n_unmatched"),
                 F.count(F.lit(1)).alias("n_rows")) \
            .withColumn("pct_lost", F.round(F.col("n_unmatched") * 100.0 / F.col("n_rows"), 4))


# J5 ------------------------------------------------------------------------
def profile_join(baseline: DataFrame, current: DataFrame, on: str = "feature") -> DataFrame:
    """Baseline drives: a feature absent from the current profile keeps a row.

    The current profile has one row per feature (bounded by the schema width),
    so broadcasting it is safe at any data size.
    """
    return baseline.join(F.broadcast(current), on, "left")


# J6 ------------------------------------------------------------------------
def verify_hashes(expected: DataFrame, actual: DataFrame, name: str = "name",
                  hash_col: str = "sha256") -> DataFrame:
    """Expected hashes vs actual ones by file name; absent = mismatch."""
    act = actual.select(F.col(name), F.col(hash_col).alias("__actual"))
    j = expected.join(act, name, "left")
    return j.select(name, F.col(hash_col).alias("expected"), F.col("__actual").alias("actual"),
                    F.coalesce(F.col(hash_col) == F.col("__actual"), F.lit(False)).alias("ok"))
