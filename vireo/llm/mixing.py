"""Mixing sources to target weights by entropy balancing (DataFrame operations only).

Every source s gets a token target T_s.  The document rates closest (in
relative entropy of a bounded rate) to the common base rate that meet the
token constraints are exponentially tilted in document size,

    r(size) = limit * e^z / (1 + e^z),   z = logit(base / limit) + lambda_s * size / scale_s,

and lambda_s minimises a convex dual.  Its gradient (tokens taken minus target)
and curvature are sums over documents, so a Newton iteration is one
pre-aggregated sum per source over the table of distinct (source, size) counts;
each step is kept inside a bracket that the gradient's sign narrows.  The rates
are rounded into whole copies along documents ordered by size, so a source's
total is off by at most about one document, and a last exchange step moves single copies
to close what is left.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import WORD_PATTERN, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
ROUNDS = 40
TOLERANCE = 1e-7
#: rates are whole multiples of 1 / RATE_UNIT, so that sums are exact
RATE_UNIT = 1_000_000
SIZE_BUCKETS = 64
EXCHANGES = 3
#: tables of one row per source are broadcast up to this many sources, beyond it joined by key
BROADCAST_SOURCES = 10_000


def word_count(text):
    """Number of words; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The table of sources (one row each, pre-aggregated) is ranked by code
    point, null last, and weighted in turn.  A target above ``limit`` times the source's size stops
    there and the excess is shared again by weight: with sources ordered by
    limit per weight, the level is fixed by the first source below it.  A
    source without words has target 0."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.lit(float(limit)) * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
           .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open_weight", F.sum("weight").over(after))
           .withColumn("water", (F.col("total") - F.col("capped")) / F.col("open_weight"))
           .withColumn("water", F.max(F.when(F.col("water") <= F.col("level"), F.col("water"))).over(everything)))
    return per.select("source", "source_size",
                      F.least("cap", F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))).alias("target"))


def _tilted(lam, x, base: float, limit: float):
    z = F.lit(math.log(base / (limit - base))) + lam * x
    return F.lit(float(limit)) / (F.lit(1.0) + F.exp(-z))


def _beside(per_source: DataFrame, few: bool) -> DataFrame:
    """A table of one row per source as the small side of a join, so that a
    source with a third of all rows stays spread over its tasks."""
    return F.broadcast(per_source) if few else per_source


def solve_tilts(counts: DataFrame, targets: DataFrame, base: float = SHARE, limit: float = LIMIT,
                rounds: int = ROUNDS, tolerance: float = TOLERANCE, few: bool = False) -> DataFrame:
    """(key, lam, scale) per source by safeguarded Newton steps on the dual.

    ``counts`` has (key, size, n); ``targets`` has (key, source_size, docs,
    target).  One aggregate of the counts per step; the state (one row per
    source) is written after each so that the plan stays short."""
    scale = F.greatest(F.lit(1.0), F.col("source_size") / F.greatest(F.lit(1), F.col("docs")))
    state = stage(targets.select("key", "target", scale.alias("scale"), F.lit(0.0).alias("lam"),
                                 F.lit(-1.0).alias("lo"), F.lit(1.0).alias("hi"),
                                 F.lit(False).alias("lo_fixed"), F.lit(False).alias("hi_fixed"),
                                 (F.col("target") >= limit * F.col("source_size")).alias("done")), "tilts")
    for _ in range(rounds):
        x = F.col("size") / F.col("scale")
        r = _tilted(F.col("lam"), x, base, limit)
        sums = (counts.join(_beside(state.where("NOT done").select("key", "lam", "scale"), few), "key")
                .groupBy("key").agg(F.sum(F.col("n") * F.col("size") * r).alias("taken"),
                                    F.sum(F.col("n") * F.col("size") * x * r * (1 - r / limit)).alias("slope")))
        off = F.col("taken") - F.col("target")
        s = state.join(sums, "key", "left")
        # the gradient's sign narrows the bracket; an unproven end moves outwards
        s = (s.withColumn("done", F.col("done") | F.col("taken").isNull() | (F.abs(off) <= tolerance * F.col("target")))
             .withColumn("hi_fixed", F.col("hi_fixed") | (off > 0)).withColumn("lo_fixed", F.col("lo_fixed") | (off < 0))
             .withColumn("hi", F.when(off > 0, F.col("lam")).when(~F.col("hi_fixed"), F.col("hi") * 4).otherwise(F.col("hi")))
             .withColumn("lo", F.when(off < 0, F.col("lam")).when(~F.col("lo_fixed"), F.col("lo") * 4).otherwise(F.col("lo")))
             .withColumn("step", F.when(F.col("slope") > 0, F.col("lam") - off / F.col("slope"))))
        inside = (F.col("step") > F.col("lo")) & (F.col("step") < F.col("hi"))
        s = s.withColumn("lam", F.when(F.col("done"), F.col("lam")).when(inside, F.col("step")).otherwise((F.col("lo") + F.col("hi")) / 2))
        state = stage(s.select(*state.columns), "tilts")
        if state.where("NOT done").isEmpty():
            break
    # sums of doubles may differ in their last bits between runs
    return state.select("key", "scale", F.round("lam", 9).alias("lam"))


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """Whole copies along documents ordered by size: the running sum of rates,
    rounded, minus the same before the document.  Prefix sums are taken in two
    levels (size buckets of a source, then inside a bucket), so no source is
    one task."""
    rows = rows.withColumn("bucket", F.floor(F.log2(F.col("size") + 1.0) * 4).cast("int"))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id", "size", "n_row"), F.lit(SIZE_BUCKETS)))
    sums = rows.groupBy("key", "bucket", "slot").agg(F.sum("rate").alias("rate_sum"))
    up = Window.partitionBy("key").orderBy("bucket", "slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("key", "bucket", "slot", F.coalesce(F.sum("rate_sum").over(up), F.lit(0)).alias("before"))
    inner = (Window.partitionBy("key", "bucket", "slot").orderBy("size", "doc_id", "n_row")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.join(sums, ["key", "bucket", "slot"]).withColumn("upto", F.col("before") + F.sum("rate").over(inner))
    half = RATE_UNIT // 2
    copies = F.floor((F.col("upto") + half) / RATE_UNIT) - F.floor((F.col("upto") - F.col("rate") + half) / RATE_UNIT)
    return rows.select("doc_id", "key", "size", "n_row", F.least(F.lit(limit), copies).cast("long").alias("copies"))


def _moved(taken: DataFrame, moves: DataFrame) -> DataFrame:
    """Apply one change of copies per source (``moves`` has at most one row per source)."""
    m = moves.select(F.col("key").alias("k2"), F.col("doc_id").alias("d2"), F.col("size").alias("s2"), F.col("n_row").alias("r2"), "change")
    same = ((F.col("key") == F.col("k2")) & F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("size") == F.col("s2")) & (F.col("n_row") == F.col("r2")))
    return (taken.join(m, same, "left")
            .select("doc_id", "key", "size", "n_row", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """One row per input row: id, ``source``, ``size``, ``source_size``,
    ``target``, ``copies`` (0 to ``limit``) and ``taken`` = copies * size.

    Null text has size 0 and is taken zero times; a null source is a source of
    its own, last in order.  Rows that repeat an id are rounded each on its own.
    A table without words gives targets and copies 0; an empty table gives an
    empty result; other columns are ignored.  Results depend on the rows alone,
    so reruns agree."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(F.col(text_col)).alias("size"))
    # repeated (id, source, size) rows are one row with a multiplicity, told apart again at the end
    rows = stage(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
                 .select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("n_row")), "sizes")
    counts = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    counts = stage(counts, "size_counts")
    sized = counts.select("source", (F.col("size") * F.col("n")).alias("size"))
    targets = source_targets(sized, weights, share, limit)
    docs_per = counts.groupBy("source").agg(F.sum("n").alias("docs"))
    targets = targets.join(docs_per.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    targets = stage(targets.withColumn("key", key), "targets")
    counts = counts.select(key.alias("key"), "size", "n").where("size > 0")
    few = targets.count() <= BROADCAST_SOURCES
    tilts = solve_tilts(counts, targets, share, limit, few=few)
    x = F.col("size") / F.col("scale")
    full = F.col("target") >= limit * F.col("source_size")
    rate = F.when(full, F.lit(float(limit))).otherwise(_tilted(F.col("lam"), x, share, limit))
    rated = (rows.withColumn("key", key)
             .join(_beside(targets.join(tilts, "key").select("key", "source_size", "target", "lam", "scale"), few), "key")
             .select("doc_id", "key", "size", "n_row",
                     F.when(F.col("size") > 0, F.round(rate * RATE_UNIT)).otherwise(0).cast("long").alias("rate")))
    taken = stage(_copies(rated, limit), "copies")
    # move single copies where that brings a source nearer its target
    for _ in range(EXCHANGES):
        gap = (taken.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).join(targets, "key")
               .select("key", (F.col("target") - F.col("got")).alias("gap")))
        sign = F.when(F.col("gap") > 0, 1).otherwise(-1)
        after = F.abs(F.col("gap") - sign * F.col("size"))
        best = (taken.join(_beside(gap, few), "key").where((F.col("copies") + sign).between(0, limit) & (F.col("size") > 0) & (after < F.abs(F.col("gap"))))
                .groupBy("key").agg(F.min(F.struct(after.alias("after"), F.col("doc_id"), F.col("size"), F.col("n_row"),
                                                   sign.cast("long").alias("change"))).alias("b")))
        taken = _moved(taken, _beside(stage(best.select("key", "b.doc_id", "b.size", "b.n_row", "b.change"), "moves"), few))
    return (taken.join(_beside(targets.select("key", "source", "source_size", "target"), few), "key")
            .select(F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "n_row", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kw) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    m = (mix_sources(docs, id_col, text_col, source_col, **kw).where("copies > 0")
         .select(F.col(id_col).alias("__id"), F.col(source_col).alias("__src"), F.col("size").alias("__size"),
                 F.col("n_row").alias("__nth"), F.col("copies").cast("int").alias("__n")))
    rows = docs.select("*", F.col(id_col).cast("long").alias("__k1"), F.col(source_col).cast("string").alias("__k2"),
                       word_count(F.col(text_col)).alias("__k3"))
    # rows that repeat id, source and size are told apart by a number
    nth = Window.partitionBy("__k1", "__k2", "__k3").orderBy(F.xxhash64(text_col))
    rows = rows.withColumn("__k4", F.row_number().over(nth))
    same = (F.col("__k1").eqNullSafe(F.col("__id")) & F.col("__k2").eqNullSafe(F.col("__src"))
            & (F.col("__k3") == F.col("__size")) & (F.col("__k4") == F.col("__nth")))
    return (rows.join(m.hint("merge"), same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
