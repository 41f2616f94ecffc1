"""Operators specified in the documentation (D1-D11, D13-D16) and the audit /
latest-state queries (W10, W11).

Windows here run over already-aggregated tables (one row per subject and
period, per day, per hour) whose partitions are bounded by the number of
periods; per-key "latest" logic uses aggregates or the salted top-k, never a
window over a raw key that could hold a third of the data.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo import config as C
from vireo.functions.expr import risk_band
from vireo.functions.stats import combine_one_row, join_groups, ordered_prefix_sums, quantiles, top_k_per_group

# FIXED VALUES: decision matrix (band, modifier) -> decision, SLA in days.
ACTION_RULES = [
    ("high", "none", "immediate_action", 7),
    ("high", "repeat", "escalation", 5),
    ("medium", "none", "active_monitoring", 14),
    ("medium", "rising", "prevention", 10),
    ("low", "none", "standard_followup", None),
]


# D1 ------------------------------------------------------------------------
def action_matrix(scores: DataFrame, subject: str, period: str, score: str) -> DataFrame:
    """Band per (subject, period) plus repeat-high / rising-trend modifiers,
    mapped through the decision rules (a 5-row table, broadcast)."""
    w = Window.partitionBy(subject).orderBy(period)
    band = risk_band(score)
    prev_score = F.lag(score).over(w)
    s = scores.select(subject, period, score, band.alias("band"), prev_score.alias("prev_score"))
    prev_band = risk_band("prev_score")
    mod = (F.when((F.col("band") == "high") & (prev_band == "high"), F.lit("repeat"))
            .when((F.col("band") == "medium") & (F.col(score) > F.col("prev_score")), F.lit("rising"))
            .otherwise(F.lit("none")))
    s = s.withColumn("modifier", mod)
    rules = scores.sparkSession.createDataFrame(ACTION_RULES, "band string, modifier string, decision string, sla_days int")
    return s.join(F.broadcast(rules), ["band", "modifier"], "left")


# D2 ------------------------------------------------------------------------
def validate_outcomes(outcomes: DataFrame, history: DataFrame, key: str, outcome_date: str, score_date: str,
                      value: str, lo: float, hi: float, label: str) -> DataFrame:
    """Per-outcome validity flags: key known, outcome after score, value in
    range, binary label."""
    h = history.select(key, score_date).groupBy(key).agg(F.min(score_date).alias("__sd"))
    j = outcomes.join(h, key, "left")
    return j.select("*",
                    F.col("__sd").isNotNull().alias("key_ok"),
                    F.coalesce(F.col(outcome_date) > F.col("__sd"), F.lit(False)).alias("date_ok"),
                    F.coalesce(F.col(value).between(lo, hi), F.lit(False)).alias("value_ok"),
                    F.coalesce(F.col(label).isin(0, 1), F.lit(False)).alias("label_ok")).drop("__sd")


def outcome_validation_summary(flags: DataFrame) -> DataFrame:
    ok = F.col("key_ok") & F.col("date_ok") & F.col("value_ok") & F.col("label_ok")
    return flags.agg(F.count(F.lit(1)).alias("n"), F.count_if("key_ok").alias("n_key_ok"),
                     F.count_if("date_ok").alias("n_date_ok"), F.count_if("value_ok").alias("n_value_ok"),
                     F.count_if("label_ok").alias("n_label_ok"), F.count_if(ok).alias("n_valid"))


# D3 ------------------------------------------------------------------------
def feedback_quality(scores: DataFrame, outcomes: DataFrame, key: str, score: str, score_date: str,
                     outcome_date: str, label: str, period: str, high: float = C.BAND_HIGH,
                     min_coverage: float = 0.3, max_lag_days: int = 90) -> DataFrame:
    """Coverage of high-risk keys, outcome lag, class balance, duplicates."""
    first = outcomes.groupBy(key).agg(F.min(outcome_date).alias("__od"), F.max(label).alias("__lab"))
    hi = scores.where(F.col(score) >= high).select(key, score_date)
    cov = hi.join(first, key, "left")
    c = cov.agg(F.count(F.lit(1)).alias("n_high"), F.count_if(F.col("__od").isNotNull()).alias("n_with_outcome"),
                F.avg(F.datediff(F.col("__od"), F.col(score_date))).alias("mean_lag_days"),
                F.count_if(F.datediff(F.col("__od"), F.col(score_date)) < max_lag_days).alias("n_lag_ok"),
                F.avg(F.col("__lab").cast("double")).alias("positive_share"))
    dups = outcomes.groupBy(key, period).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1) \
                   .agg(F.count(F.lit(1)).alias("n_duplicate_keys"))
    c = combine_one_row(c, dups).withColumn("n_duplicate_keys", F.col("n_duplicate_keys").cast("bigint")) \
        .withColumn("n_high", F.col("n_high").cast("bigint")) \
        .withColumn("n_with_outcome", F.col("n_with_outcome").cast("bigint")) \
        .withColumn("n_lag_ok", F.col("n_lag_ok").cast("bigint"))
    cov_r = F.try_divide(F.col("n_with_outcome"), F.col("n_high"))
    return c.select("n_high", "n_with_outcome", F.round(cov_r, 6).alias("coverage"),
                    F.round("mean_lag_days", 6).alias("mean_lag_days"), "n_lag_ok",
                    F.round("positive_share", 6).alias("positive_share"), "n_duplicate_keys",
                    (cov_r >= min_coverage).alias("coverage_ok"),
                    (F.col("n_lag_ok") == F.col("n_with_outcome")).alias("lag_ok"),
                    F.col("positive_share").between(0.2, 0.8).alias("balance_ok"),
                    (F.col("n_duplicate_keys") == 0).alias("consistency_ok"))


# D4 ------------------------------------------------------------------------
def kpis_by_segment(df: DataFrame, sets: list[list[str]], lag_col: str = "defasagem", ian: str = "ian",
                    digits: int = 6) -> DataFrame:
    """Lag rate (share with lag > 0, the KPI rule) and mean IAN for several
    groupings in one pass (GROUPING SETS)."""
    cols = sorted({c for s in sets for c in s})
    g = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    return g.agg(F.grouping_id().alias("grouping_id"), F.count(F.lit(1)).alias("n"),
                 F.round(F.avg((F.col(lag_col) > 0).cast("double")), digits).alias("lag_rate"),
                 F.round(F.avg(ian), digits).alias("mean_ian"))


# D5 ------------------------------------------------------------------------
def relative_change(rates: DataFrame, by: list[str], period: str, value: str, lag: int = 1,
                    digits: int = 6) -> DataFrame:
    """(value - value ``lag`` periods before) / before, on a per-period table.

    The base is the row of period - ``lag``, not the ``lag``-th row before: after
    a gap in the periods there is none, and baseline and change are null."""
    before = rates.select(*by, (F.col(period) + F.lit(lag)).alias(period), F.col(value).alias("baseline"))
    j = join_groups(rates, before, [*by, period], "left")
    base = F.col("baseline")
    return j.select("*", F.round(F.try_divide(F.col(value) - base, base), digits).alias("relative_change"))


# D6 ------------------------------------------------------------------------
def process_kpis(scores: DataFrame, actions: DataFrame, key: str, score: str, score_date: str,
                 action_date: str, by: list[str] | None = None, high: float = C.BAND_HIGH) -> DataFrame:
    """Share of high-risk keys acted on after the score and mean days to the
    first such action."""
    by = list(by or [])
    s = scores.where(F.col(score) >= high).select(*by, key, score_date)
    a = actions.select(key, action_date)
    j = s.join(a, key, "left").where(F.col(action_date).isNull() | (F.col(action_date) >= F.col(score_date)))
    first = j.groupBy(*by, key, score_date).agg(F.min(action_date).alias("__first"))
    allhi = s.groupBy(*by).agg(F.count(F.lit(1)).alias("n_high"))
    acted = first.groupBy(*by).agg(F.count_if(F.col("__first").isNotNull()).alias("n_acted"),
                                   F.avg(F.datediff("__first", score_date)).alias("mean_days_to_action"))
    out = allhi.join(acted, by, "left") if by else combine_one_row(allhi, acted)
    return out.select(*by, "n_high", F.coalesce("n_acted", F.lit(0)).alias("n_acted"),
                      F.round(F.try_divide(F.col("n_acted"), F.col("n_high")), 6).alias("intervention_rate"),
                      F.round("mean_days_to_action", 6).alias("mean_days_to_action"))


# D7 ------------------------------------------------------------------------
def two_sample_t(df: DataFrame, group: str, value: str) -> DataFrame:
    """Pooled two-sample t statistic between ``group`` true / false (one
    conditional aggregation)."""
    g, v = F.col(group), F.col(value)
    j = df.agg(F.count(F.when(g, v)).alias("n_1"), F.avg(F.when(g, v)).alias("mean_1"),
               F.var_samp(F.when(g, v)).alias("var_1"), F.count(F.when(~g, v)).alias("n_0"),
               F.avg(F.when(~g, v)).alias("mean_0"), F.var_samp(F.when(~g, v)).alias("var_0"))
    dof = F.col("n_1") + F.col("n_0") - 2
    sp2 = ((F.col("n_1") - 1) * F.col("var_1") + (F.col("n_0") - 1) * F.col("var_0")) / dof
    t = (F.col("mean_1") - F.col("mean_0")) / F.sqrt(sp2 * (1.0 / F.col("n_1") + 1.0 / F.col("n_0")))
    return j.select("n_1", "n_0", F.round("mean_1", 6).alias("mean_1"), F.round("mean_0", 6).alias("mean_0"),
                    F.round(t, 6).alias("t"), dof.alias("dof"))


# D8 ------------------------------------------------------------------------
def missing_target_association(df: DataFrame, features: list[str], target: str, gap: float = 0.1,
                               digits: int = 6) -> DataFrame:
    sel = df.select(F.col(target).cast("double").alias("__y"),
                    *[F.col(c).isNull().alias(c) for c in features])
    lv = sel.unpivot(["__y"], features, "feature", "is_missing")
    g = lv.groupBy("feature").agg(F.avg(F.when(F.col("is_missing"), F.col("__y"))).alias("rate_missing"),
                                  F.avg(F.when(~F.col("is_missing"), F.col("__y"))).alias("rate_present"),
                                  F.count_if("is_missing").alias("n_missing"))
    d = F.col("rate_missing") - F.col("rate_present")
    return g.select("feature", "n_missing", F.round("rate_missing", digits).alias("rate_missing"),
                    F.round("rate_present", digits).alias("rate_present"), F.round(d, digits).alias("gap"),
                    F.coalesce(F.abs(d) > gap, F.lit(False)).alias("informative"))


# D9 ------------------------------------------------------------------------
def ordinal_target(col: str):
    """>= 0 adequate/ahead, -1 mild, <= -2 severe (the first of the two specs)."""
    c = F.col(col)
    return (F.when(c >= 0, F.lit("adequado_avancado")).when(c == -1, F.lit("defasagem_leve"))
             .when(c <= -2, F.lit("defasagem_severa")))


# D10 -----------------------------------------------------------------------
def temporal_consistency(df: DataFrame, key: str, period: str, tenure: str | None = None) -> DataFrame:
    """Counts of duplicated (key, period), period gaps, and tenure decreases.

    One aggregation to (key, period), then a lag window over that table -
    each key's partition is bounded by its number of periods - then one
    global count.
    """
    aggs = [F.count(F.lit(1)).alias("__n")]
    if tenure:
        aggs.append(F.max(tenure).alias("__t"))
    per = df.groupBy(key, period).agg(*aggs)
    w = Window.partitionBy(key).orderBy(period)
    cols = [F.col("__n"), F.col(period), F.lag(period).over(w).alias("__prev")]
    if tenure:
        cols += [F.col("__t"), F.lag("__t").over(w).alias("__pt")]
    seq = per.select(*cols)
    out = [F.count_if(F.col("__n") > 1).alias("n_duplicate_keys"),
           F.count_if(F.col("__prev").isNotNull() & (F.col(period) - F.col("__prev") > 1)).alias("n_gaps")]
    if tenure:
        out.append(F.count_if(F.col("__t") < F.col("__pt")).alias("n_tenure_decreases"))
    return seq.agg(*out)


# D11 -----------------------------------------------------------------------
def subject_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Fold by a hash of the subject key: no subject on both sides."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", (bits % k).cast("int"))


def balanced_folds(df: DataFrame, key: str, label: str, k: int = 5) -> DataFrame:
    """(key, n_rows, n_pos, fold): whole subjects dealt to folds of equal size
    and class share.

    Subjects are put in the order of their rows, their positives and the MD5 of
    their key and dealt out in turn.  So folds differ by at most one subject,
    and by at most the rows of the largest one; among subjects of n rows
    positives differ by at most n, so in all by at most the sum of the sizes
    that occur.  The place in the order is a prefix sum over the histogram of
    (rows, positives, first MD5 digits), not a window over all subjects."""
    md5 = F.md5(F.col(key).cast("string"))
    subjects = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(label) == 1).alias("n_pos"))
    s = subjects.withColumn("__o", F.struct((-F.col("n_rows")).alias("r"), (-F.col("n_pos")).alias("p"), F.coalesce(md5, F.lit("")).alias("m")))
    s = s.withColumn("__one", F.lit(1))
    cell = F.struct(F.col("__o.r").alias("r"), F.col("__o.p").alias("p"), F.substring("__o.m", 1, 3).alias("m"))
    dealt = ordered_prefix_sums(s, [], "__o", ["__one"], cell)
    return dealt.select(key, "n_rows", "n_pos", F.pmod("__one_cum", F.lit(k)).cast("int").alias("fold"))


def temporal_folds(df: DataFrame, period: str, test_periods: list[int], gap: int = 0) -> DataFrame:
    """Every row once per fold it has a part in, with ``fold`` (the test period)
    and ``role``: test in its own period, train in those that end more than
    ``gap`` periods before it; the periods of the gap are left out."""
    p = F.col(period)
    parts = [F.when(p == t, F.struct(F.lit(t).alias("fold"), F.lit("test").alias("role")))
             .when(p < t - gap, F.struct(F.lit(t).alias("fold"), F.lit("train").alias("role"))) for t in test_periods]
    out = df.withColumn("__part", F.explode(F.array_compact(F.array(*parts))))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "__part.fold", "__part.role")


# D13 -----------------------------------------------------------------------
def retrain_triggers(daily_psi: DataFrame, perf: DataFrame | None, n_new_labels: DataFrame | None,
                     psi_alert: float = 0.25, red_days: int = 7, recall_min: float = 0.65,
                     label_min: int = 500) -> DataFrame:
    """One row of trigger flags: PSI alert, red streak length, recall floor,
    new label volume."""
    from vireo.operators.drift import status_streaks
    streak = status_streaks(daily_psi).agg(F.coalesce(F.max("n_days"), F.lit(0)).alias("max_red_streak"))
    p = daily_psi.agg(F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"))
    parts = [p, streak]
    if perf is not None:
        parts.append(perf.agg(F.min("recall").alias("min_recall")))
    if n_new_labels is not None:
        parts.append(n_new_labels.select(F.col("n").alias("n_new_labels")))
    out = combine_one_row(*parts)
    if perf is None:
        out = out.withColumn("min_recall", F.lit(None).cast("double"))
    if n_new_labels is None:
        out = out.withColumn("n_new_labels", F.lit(0))
    out = out.withColumn("max_red_streak", F.col("max_red_streak").cast("bigint")) \
             .withColumn("n_new_labels", F.col("n_new_labels").cast("bigint"))
    flags = [(F.col("max_psi") >= psi_alert).alias("psi_trigger"),
             (F.col("max_red_streak") > red_days).alias("streak_trigger"),
             F.coalesce(F.col("min_recall") < recall_min, F.lit(False)).alias("recall_trigger"),
             (F.col("n_new_labels") > label_min).alias("label_trigger")]
    out = out.select(F.round("max_psi", 4).alias("max_psi"), "max_red_streak",
                     F.round("min_recall", 6).alias("min_recall"), "n_new_labels", *flags)
    return out.withColumn("retrain", F.col("psi_trigger") | F.col("streak_trigger") | F.col("recall_trigger")
                          | F.col("label_trigger"))


# D14 -----------------------------------------------------------------------
def ops_dashboard(log: DataFrame, ts: str, latency: str, status: str, unit: str = "hour",
                  method: str = "bracket") -> DataFrame:
    """Traffic, error rate and p95 latency per time bucket."""
    b = log.withColumn("bucket", F.date_trunc(unit, F.col(ts)))
    j = quantiles(b, latency, [0.95], ["bucket"], method=method, names=["p95_latency"], also=[
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) >= 500).alias("n_errors")])
    return j.select(
        "bucket", "n", "n_errors", F.round(F.col("n_errors") / F.col("n"), 6).alias("error_rate"),
        F.round("p95_latency", 6).alias("p95_latency"))


# D15 -----------------------------------------------------------------------
def error_bursts(log: DataFrame, ts: str, status: str, length: str = "5 minutes", slide: str = "1 minute",
                 max_rate: float = 0.01) -> DataFrame:
    """Sliding windows where the 5xx share exceeds ``max_rate``."""
    w = log.groupBy(F.window(F.col(ts), length, slide).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) >= 500).alias("n_errors"))
    return w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "n_errors",
                    F.round(F.col("n_errors") / F.col("n"), 6).alias("error_rate"),
                    (F.col("n_errors") / F.col("n") > max_rate).alias("incident"))


def volume_anomalies(log: DataFrame, ts: str, by: list[str] | None = None, trailing: int = 24,
                     tolerance: float = 0.2) -> DataFrame:
    """Hourly volume against the mean of the previous ``trailing`` hours.

    Hours without traffic between a group's first and the log's last hour count
    as 0, so an outage is an anomaly.  The grid has one row per group and hour."""
    by = list(by or [])
    seen = log.groupBy(*by, F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n")).where("hour IS NOT NULL")
    last = seen.agg(F.max("hour")).scalar()
    first = seen.groupBy(*by).agg(F.min("hour").alias("__first"))
    grid = first.select(*by, F.explode(F.sequence("__first", last, F.expr("interval 1 hour"))).alias("hour"))
    there = seen.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("hour").alias("__hour"), F.col("n").alias("__n"))
    same = F.col("hour") == F.col("__hour")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    h = grid.join(there, same, "left").select(*by, "hour", F.coalesce("__n", F.lit(0)).cast("long").alias("n"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("hour").rowsBetween(-trailing, -1)
    e = h.withColumn("expected", F.avg("n").over(w))
    return e.select(*by, "hour", "n", F.round("expected", 6).alias("expected"),
                    F.coalesce(F.abs(F.col("n") - F.col("expected")) <= tolerance * F.col("expected"), F.lit(True))
                    .alias("within_tolerance"))


# D16 -----------------------------------------------------------------------
def winsorize(df: DataFrame, cols: list[str], lower: float = 0.01, upper: float = 0.99,
              method: str = "bracket") -> DataFrame:
    """Clip each column to its own [lower, upper] percentiles.

    One grouped quantile job over all columns (unpivoted); the bounds are two
    numbers per column, applied as literals."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    q = quantiles(long, "value", [lower, upper], ["column"], method=method, names=["lo", "hi"], few_groups=True)
    bounds = {r["column"]: (r["lo"], r["hi"]) for r in q.collect()}
    # least and greatest skip nulls: a null stays null, and so does NaN
    return df.select(*[F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")),
                              F.least(F.greatest(F.col(c), F.lit(bounds[c][0])), F.lit(bounds[c][1]))).alias(c)
                       if c in bounds and bounds[c][0] is not None else F.col(c) for c in df.columns])


# W10 -----------------------------------------------------------------------
def audit_newest(log: DataFrame, ts: str, action_col: str | None = None, action: str | None = None,
                 n: int = 100, oldest_quirk: bool = False) -> DataFrame:
    """Newest ``n`` records (a top-k, not a full sort); ``oldest_quirk``
    returns the oldest ``n`` like the original."""
    d = log.where(F.col(action_col) == action) if action is not None else log
    order = F.col(ts).asc() if oldest_quirk else F.col(ts).desc()
    return d.orderBy(order, *[F.col(c) for c in d.columns if c != ts]).limit(n)


def audit_counts(log: DataFrame, action_col: str) -> DataFrame:
    return log.groupBy(action_col).agg(F.count(F.lit(1)).alias("n"))


# W11 -----------------------------------------------------------------------
def latest_per_key(log: DataFrame, key: str, ts: str, value: str, tie: str | None = None) -> DataFrame:
    """Latest and previous value per key from an append-only log.

    Uses the salted two-stage top-k (k=2), so a key holding a large share
    of the log is split over many tasks.
    """
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    top2 = top_k_per_group(log.select(key, ts, value, *([tie] if tie else [])), [key], order, 2)
    at = lambda rank, c: F.max(F.when(F.col("rank") == rank, F.col(c)))
    return top2.groupBy(key).agg(at(1, ts).alias("latest_ts"), at(1, value).alias("current"), at(2, value).alias("previous"))
