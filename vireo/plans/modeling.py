"""The longitudinal modeling table: features at t, outcome at t+1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.operators.features import add_row_composites
from vireo.operators.joins import join_next_period
from vireo.operators.prepare import add_binary_target
from vireo.plans.bindings import subject_year

FEATURES = ["fase", "ian", "ida", "ieg", "ano_ingresso"]
INDICATORS = ["ian", "ida", "ieg"]


def modeling_long(v1: DataFrame, key: str = "ra", period: str = "ano") -> DataFrame:
    """All consecutive period pairs in one equi-join on (key, period+1)."""
    feat = v1.select(key, period, *FEATURES)
    lab = add_binary_target(v1.select(key, period, "defasagem"), name="em_risco") \
        .select(key, period, "em_risco")
    return join_next_period(feat, lab, key, period)


def modeling_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_row_composites(modeling_long(subject_year(spark, sf_dir)), INDICATORS)


MODELING_SQL = """
m AS (
  SELECT f.ra, f.ano, f.fase, f.ian, f.ida, f.ieg, f.ano_ingresso,
         coalesce(CAST(l.defasagem < 0 AS INTEGER), 0) AS em_risco
  FROM v1 f JOIN v1 l ON f.ra = l.ra AND l.ano = f.ano + 1
),
mc AS (
  SELECT *,
    (CAST(ian IS NOT NULL AS INTEGER) + CAST(ida IS NOT NULL AS INTEGER) + CAST(ieg IS NOT NULL AS INTEGER)) AS nn,
    CASE WHEN (CAST(ian IS NOT NULL AS INTEGER) + CAST(ida IS NOT NULL AS INTEGER) + CAST(ieg IS NOT NULL AS INTEGER)) > 0
         THEN (coalesce(ian, 0.0) + coalesce(ida, 0.0) + coalesce(ieg, 0.0))
              / (CAST(ian IS NOT NULL AS INTEGER) + CAST(ida IS NOT NULL AS INTEGER) + CAST(ieg IS NOT NULL AS INTEGER))
    END AS media_indicadores,
    least(ian, ida, ieg) AS min_indicador,
    greatest(ian, ida, ieg) AS max_indicador
  FROM m
)"""


def composite_sql_std() -> str:
    return """
    CASE WHEN nn > 1 THEN sqrt((coalesce(pow(ian - media_indicadores, 2), 0.0)
                               + coalesce(pow(ida - media_indicadores, 2), 0.0)
                               + coalesce(pow(ieg - media_indicadores, 2), 0.0)) / (nn - 1)) END"""
