"""The composed jobs: from yearly snapshots to a modeling table, and from a
modeling table to a training set (M7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import config as C
from vireo.functions.expr import repair_serial_age, standardize_category
from vireo.operators import features as FE
from vireo.operators import prepare as P
from vireo.operators import quality as Q
from vireo.operators.joins import join_next_period
from vireo.operators.profile import data_card_target
from vireo.sources.tables import read_snapshots, write_snapshots


@dataclass
class Prepared:
    """Outputs of the prepare job."""
    snapshots: DataFrame   # repaired rows of every period, as written
    modeling: DataFrame    # features at t with the outcome at t+1
    checks: DataFrame      # results of every check (Q8) and of the leakage gate (Q5)
    card: DataFrame        # target shares per period (A20)
    schemas: DataFrame     # one schema record per period (A21)


def prepare_snapshots(spark: SparkSession, paths: dict[int, str], out: str, key: str = "ra", period: str = "ano",
                      lag: str = "defasagem", age: str = "idade", categories: list[str] | None = None,
                      fmt: str = "csv") -> Prepared:
    """Read one folder per period, standardise the names (P1, P2), repair the
    ages (P5) and categories (P6), coerce mixed text (P3), write the snapshots
    by period (IO6), check them (Q8), keep the allowed features (P8, P9),
    derive the target (P7) and join it from the next period (J1).

    Text is read once without inference; the types come from one aggregation
    over the union.  The features pass the leakage gate (Q5) or the job raises.
    Personal data other than the key never leaves the snapshots.
    """
    raw = {y: read_snapshots(spark, {y: p}, period, normalize=P.normalize_columns, fmt=fmt, infer=False)
           for y, p in sorted(paths.items())}
    snaps = None
    for df in raw.values():
        snaps = df if snaps is None else snaps.unionByName(df, allowMissingColumns=True)
    if age in snaps.columns:
        snaps = snaps.withColumn(age, repair_serial_age(age))
    for c in categories or []:
        if c in snaps.columns:
            snaps = snaps.withColumn(c, standardize_category(c))
    write_snapshots(P.coerce_mixed(snaps, exclude=[key]), out, period)
    written = spark.read.parquet(out)

    named = [c for c in C.ALLOWED_FEATURE_COLUMNS if c in written.columns and c not in C.PII_FIELDS]
    features = written.select(key, period, *named)
    Q.assert_no_leakage(features)
    labels = P.add_binary_target(written.select(key, period, lag)).drop(lag)
    checks = (Q.run_all_checks(written, [key, period], critical=named).withColumn("table", F.lit("snapshots"))
              .unionByName(Q.check_leakage(written).withColumn("table", F.lit("snapshots")))
              .unionByName(Q.check_leakage(features).withColumn("table", F.lit("features"))))
    records = None
    for y, df in raw.items():
        r = P.schema_record(df, y)
        records = r if records is None else records.unionByName(r)
    return Prepared(written, join_next_period(features, labels, key, period), checks,
                    data_card_target(P.add_binary_target(written, lag), period, "em_risco"), records)


@dataclass
class TrainingSet:
    """A training table and what scoring needs to repeat it."""
    table: DataFrame
    missing_columns: list[str]
    signature: dict[str, str]


def load_and_prepare(df: DataFrame, target: str = "em_risco", ids: tuple = ("ra",), target_year: int | None = None,
                     indicators: list[str] | None = None, min_ratio: float = 0.7,
                     missing_columns: list[str] | None = None, keep_ids: bool = False) -> TrainingSet:
    """M7: coerce mixed text under the training rule (P3), add the features
    (F6), drop ids and refuse leaking columns (P11).  The list of missing flags
    is decided once here and returned; scoring passes it back in.  With
    ``keep_ids`` the ids stay in the table, for folds by subject, but are no
    part of the signature."""
    coerced = P.coerce_mixed(df, min_ratio, require_non_null=True, exclude=list(ids))
    indicators = indicators or [c for c in FE.INDICATOR_PREFIXES if c in coerced.columns]
    if missing_columns is None:
        missing_columns = FE.missing_flag_columns(coerced, indicators)
    made = FE.make_features(coerced, composite_cols=indicators, missing_columns=missing_columns)
    table = P.split_xy(made, target, list(ids), target_year)
    sig = P.schema_signature(table)
    sig.pop("label")
    if keep_ids:
        table = made.select(*ids, *[F.col(f"`{c}`") for c in sig], F.col(target).alias("label"))
    return TrainingSet(table, missing_columns, sig)


def prepare_for_scoring(df: DataFrame, like: TrainingSet, ids: tuple = ("ra",), indicators: list[str] | None = None,
                        extra_policy: str = "ignore") -> DataFrame:
    """The features of unlabelled rows by the decisions taken in training,
    aligned to its signature (P12); ids stay in front."""
    indicators = indicators or [c for c in FE.INDICATOR_PREFIXES if c in df.columns]
    made = FE.make_features(df, composite_cols=indicators, missing_columns=like.missing_columns)
    keep = {i: dict(made.dtypes)[i] for i in ids}
    return P.align_to_signature(made, keep | like.signature, extra_policy, id_fields=ids)
