"""Distributed building blocks shared by several operators.

* ``ordered_prefix_sums``: running sums in value order inside each group,
  without a one-partition window.  Rows are first cut into ordered buckets;
  bucket totals (a table of groups x buckets) give each bucket its offset, and
  the running sum is then a window over (group, bucket) only.
* ``quantiles``: exact linear-interpolated quantiles (same as Spark
  ``percentile`` and DuckDB ``quantile_cont``) by bracketing: a sketch gives
  an interval per probability, a second pass counts below and between and
  shuffles only the values inside.  An approximate mode
  (``percentile_approx``) and the plain aggregate mode (for groups known to
  be small) are available.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: accuracy of the sketch (its ranks are off by at most a row in this many), and
#: how many times that error the brackets reach to each side
SKETCH_ACCURACY, BRACKET = 2000, 2
#: values of a group below which all of them are counted
SMALL_GROUP = 10 * SKETCH_ACCURACY


def join_groups(left: DataFrame, right: DataFrame, group_cols: list[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, a null being a group like any other."""
    other = right.withColumnsRenamed({c: f"__r{i}" for i, c in enumerate(group_cols)})
    cond = None
    for i, c in enumerate(group_cols):
        same = F.col(c).eqNullSafe(F.col(f"__r{i}"))
        cond = same if cond is None else cond & same
    return left.join(other, cond, how).drop(*[f"__r{i}" for i in range(len(group_cols))])


def ordered_prefix_sums(df: DataFrame, group_cols: list[str], order_col: str, sum_cols: list[str],
                        bucket: Column, descending: bool = False, suffix: str = "_cum") -> DataFrame:
    """Add ``{c}{suffix}`` = sum of ``c`` over rows strictly before this one.

    ``df`` must have one row per (group, order value) - e.g. the output of a
    ``groupBy(group + [order_col])``.  ``bucket`` must be non-decreasing in
    ``order_col``; ``descending`` sums over larger values instead.
    """
    b = df.withColumn("__bkt", bucket)
    tot = b.groupBy(*group_cols, "__bkt").agg(*[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    order = F.col("__bkt").desc() if descending else F.col("__bkt").asc()
    # One row per (group, bucket): bounded by groups x buckets.
    wb = Window.partitionBy(*group_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*group_cols, "__bkt",
                     *[F.coalesce(F.sum(f"__t_{c}").over(wb), F.lit(0)).alias(f"__o_{c}") for c in sum_cols])
    j = join_groups(b, off, [*group_cols, "__bkt"])
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(*group_cols, "__bkt").orderBy(oc).rowsBetween(Window.unboundedPreceding, -1)
    return j.select(*[F.col(c) for c in df.columns],
                    *[(F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0))).alias(f"{c}{suffix}")
                      for c in sum_cols])


def quantiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str] | None = None,
              method: str = "bracket", names: list[str] | None = None, also: list[Column] | None = None, few_groups: bool = False) -> DataFrame:
    """One row per group with a column per probability (null for empty groups).

    method: ``bracket`` (exact, two passes, see below), ``aggregate`` (exact
    Spark ``percentile``; a whole group's value counts meet in one task - use
    for groups known to be bounded), ``approx`` (``percentile_approx``,
    accuracy 10000).  The default is the same at every size.

    ``bracket``: the first pass takes a bounded sketch per group, which gives
    an interval for every probability that is sure to hold its rank; ``also``
    (aggregates over the group's rows, nulls included) rides on that pass.  The
    second pass counts: values inside an interval are counted one by one, all
    others only by the gap between intervals they lie in, so a group costs a
    few rows plus the values inside, whatever its size.  The wanted ranks are
    then read from the running count over that table.  ``few_groups`` says that
    the groups are bounded by the schema (one per column): their sketch rows
    then pass through the driver instead of a small table.
    """
    g = list(group_cols or [])
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    v = F.col(value_col).cast("double")
    base = df.withColumn("__v", F.when(~F.isnan(v), v))
    extra = list(also or [])
    if method in ("aggregate", "approx"):
        at = F.array(*[F.lit(float(p)) for p in probs])
        arr = F.percentile("__v", at) if method == "aggregate" else F.percentile_approx("__v", at, 10000)
        out = base.groupBy(*g).agg(*extra, F.count("__v").alias("__n"), arr.alias("__q"))
        out = out if extra else out.where("__n > 0")
        return out.drop("__n").withColumns({n: F.col("__q")[i] for i, n in enumerate(names)}).drop("__q")
    if method != "bracket":
        raise ValueError(method)

    # pass 1: for every probability two cut points whose ranks enclose its own
    low = [max(0.0, p - BRACKET / SKETCH_ACCURACY) for p in probs]
    high = [min(1.0, p + BRACKET / SKETCH_ACCURACY) for p in probs]
    sketch = F.percentile_approx("__v", F.array(*[F.lit(float(p)) for p in low + high]), SKETCH_ACCURACY)
    # the ends are the extremes themselves: a sketch may fall short of them
    ends = [F.min("__v").alias("__min"), F.max("__v").alias("__max")]
    stats = base.groupBy(*g).agg(*extra, F.count("__v").alias("__n"), sketch.alias("__s"), *ends)
    own = [c for c in stats.columns if c not in {*g, "__n", "__s", "__min", "__max"}]
    k = len(probs)
    # small groups are counted whole: their sketch may be off by a rank or two
    small = F.col("__n") < SMALL_GROUP
    lo = [F.when(small | F.lit(low[i] == 0), F.col("__min")).otherwise(F.col("__s")[i]).alias(f"__l{i}") for i in range(k)]
    hi = [F.when(small | F.lit(high[i] == 1), F.col("__max")).otherwise(F.col("__s")[k + i]).alias(f"__h{i}") for i in range(k)]
    stats = stats.select(*g, *own, "__n", *lo, *hi)
    bounds = [f"__{x}{i}" for i in range(k) for x in "lh"]
    rows = base.select(*g, "__v").where(F.col("__v").isNotNull())
    if g:
        # one row per group, written once: the join then knows its size and
        # broadcasts it below Spark's threshold
        from vireo.session import cut_lineage
        stats = F.broadcast(df.sparkSession.createDataFrame(stats.collect(), stats.schema)) if few_groups else cut_lineage(stats)
        rows = join_groups(rows, stats.where("__n > 0").select(*g, *bounds), g)
    else:
        one = stats.first()
        rows = rows.select("__v", *[F.lit(one[c]).cast("double").alias(c) for c in bounds])
    # pass 2: the gap a value lies in, and the value itself inside an interval
    inside = F.lit(False)
    gap = F.lit(0)
    for i in range(k):
        inside = inside | ((F.col("__v") >= F.col(f"__l{i}")) & (F.col("__v") <= F.col(f"__h{i}")))
        gap = gap + (F.col("__v") >= F.col(f"__l{i}")).cast("int") + (F.col("__v") > F.col(f"__h{i}")).cast("int")
    counts = (rows.groupBy(*g, gap.alias("__g"), F.when(inside, F.col("__v")).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
              .withColumn("__o", F.struct("__g", F.col("__v").isNull().alias("miss"), F.col("__v"))))
    ps = ordered_prefix_sums(counts, g, "__o", ["__c"], F.col("__g"))
    picked = join_groups(ps, stats.select(*g, "__n"), g) if g else ps.withColumn("__n", F.lit(int(one["__n"])))
    picked = picked.groupBy(*g).agg(*_pick(picked, probs, F.col("__n")))
    outs = []
    for i, n in enumerate(names):
        a, b, fr = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__f{i}")
        # a rank outside its interval would be a fault of the sketch: never answer wrongly
        sure = F.when(fr.isNotNull() & (a.isNull() | b.isNull()), F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))
        outs.append(F.coalesce(sure, F.when(fr == 0, a).otherwise(a + fr * (b - a))).alias(n))
    picked = picked.select(*g, *outs)
    if not extra:
        return picked
    if not g:
        return picked.select(*[F.lit(one[c]).cast(t).alias(c) for c, t in stats.select(*own).dtypes], *names)
    return join_groups(stats.select(*g, *own), F.broadcast(picked) if few_groups else picked, g, "left")


def _pick(ps: DataFrame, probs: list[float], n) -> list:
    aggs = []
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        start_, end_ = F.col("__c_cum"), F.col("__c_cum") + F.col("__c")
        aggs.append(F.max(F.when((lo >= start_) & (lo < end_), F.col("__v"))).alias(f"__lo{i}"))
        aggs.append(F.max(F.when((hi >= start_) & (hi < end_), F.col("__v"))).alias(f"__hi{i}"))
        aggs.append(F.max(h - lo).alias(f"__f{i}"))
    return aggs


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list, k: int,
                    salt_col: str | None = None, salt_buckets: int = 64, rank_name: str = "rank") -> DataFrame:
    """Exact top-k rows per group, ranked 1..k by ``order_cols`` (a total order).

    Stage 1 keeps the top k inside each (group, hash bucket) - the window
    partitions are bounded by bucket size, so a group holding a third of the
    data is split over ``salt_buckets`` tasks.  The global top k of a group
    is inside the union of its bucket winners, so stage 2 ranks at most
    ``salt_buckets * k`` rows per group.
    """
    salt_src = F.col(salt_col) if salt_col else F.xxhash64(*[F.col(c) for c in df.columns])
    b = df.withColumn("__salt", F.pmod(salt_src, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order_cols)
    cand = b.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k).drop("__r1", "__salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return cand.withColumn(rank_name, F.row_number().over(w2)).where(F.col(rank_name) <= k)


def combine_one_row(*dfs: DataFrame) -> DataFrame:
    """Place the columns of several one-row results side by side without a
    join: each row is melted to (name, value), the parts are unioned and
    pivoted back.  Values come back as doubles."""
    names, parts = [], []
    for d in dfs:
        names += d.columns
        kv = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))
                                 for c in d.columns]))
        parts.append(d.select(kv.alias("kv")).select("kv.k", "kv.v"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy().pivot("k", names).agg(F.first("v"))


COLUMNS_PER_AGGREGATE = 100


def null_counts(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Long table ``(by..., column, n_missing, n_rows)``: one wide aggregate
    per ``COLUMNS_PER_AGGREGATE`` columns, so generated code stays bounded."""
    by = list(by or [])
    out = None
    for at in range(0, max(1, len(cols)), COLUMNS_PER_AGGREGATE):
        part = cols[at:at + COLUMNS_PER_AGGREGATE]
        agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                                  *[F.count_if(F.col("`" + c.replace("`", "``") + "`").isNull()).alias(f"__m{i}") for i, c in enumerate(part)])
        long = agg.select(*by, "n_rows", F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("n_missing")) for i, c in enumerate(part)])))
        long = long.select(*by, "column", F.col("n_missing").cast("bigint").alias("n_missing"), "n_rows")
        out = long if out is None else out.unionByName(long)
    return out
