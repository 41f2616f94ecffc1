"""Registered queries: modeling table and features (slice 0, F1-F6, J1)."""

from pyspark.sql import functions as F

from vireo.operators import features as FE
from vireo.operators.explore import rate_by_group
from vireo.operators.prepare import periods, to_wide
from vireo.plans.bindings import subject_year, with_views
from vireo.plans.catalog import query
from vireo.plans.modeling import MODELING_SQL, composite_sql_std, modeling_long, modeling_table

FLAGSHIP_SQL = with_views("""
SELECT ano, fase, count(*) AS n, CAST(sum(em_risco) AS BIGINT) AS n_risk,
       round(avg(em_risco) * 100, 4) AS rate_pct,
       round(avg(media_indicadores), 4) AS mean_composite
FROM mc GROUP BY ano, fase
""", "v1", ctes=[MODELING_SQL])


@query("target_rate_by_phase", FLAGSHIP_SQL)
def target_rate_by_phase(spark, d):
    """Slice 0: V1 -> target t+1 -> join -> composites -> rate by (period, phase)."""
    m = modeling_table(spark, d)
    return rate_by_group(m, ["ano", "fase"], "em_risco",
                         extra=[F.round(F.avg("media_indicadores"), 4).alias("mean_composite")])


@query("j1_modeling_table", with_views("""
SELECT ra, ano, fase, round(ian, 6) AS ian, round(ida, 6) AS ida, round(ieg, 6) AS ieg, ano_ingresso, em_risco
FROM m""", "v1", ctes=[MODELING_SQL]))
def j1_modeling_table(spark, d):
    m = modeling_long(subject_year(spark, d))
    return m.select("ra", "ano", "fase", *[F.round(c, 6).alias(c) for c in ["ian", "ida", "ieg"]],
                    "ano_ingresso", "em_risco")


@query("f1_missing_flags", with_views("""
SELECT ra, ano,
  CASE WHEN (SELECT avg(CAST(ida IS NULL AS DOUBLE)) FROM m) >= 0.05 THEN CAST(ida IS NULL AS INTEGER) END AS ida_missing
FROM m""", "v1", ctes=[MODELING_SQL]))
def f1_missing_flags(spark, d):
    m = modeling_long(subject_year(spark, d))
    out = FE.add_missing_flags(m, ["ida", "ieg"], 0.05)
    return out.select("ra", "ano", *[c for c in out.columns if c.endswith("_missing")])


@query("f2_tenure", with_views("""
SELECT ra, ano, CASE WHEN ano - ano_ingresso IS NOT NULL THEN least(greatest(ano - ano_ingresso, 0), 15) END AS anos_pm
FROM m""", "v1", ctes=[MODELING_SQL]))
def f2_tenure(spark, d):
    m = modeling_long(subject_year(spark, d))
    return FE.add_tenure_col(m, "ano", "ano_ingresso").select("ra", "ano", "anos_pm")


@query("f3_lag_deltas", with_views("""
SELECT ra, ano,
  CASE WHEN lag(ano) OVER w = ano - 1 THEN round(ian - lag(ian) OVER w, 6) END AS delta_ian,
  CASE WHEN lag(ano) OVER w = ano - 1 THEN round(ida - lag(ida) OVER w, 6) END AS delta_ida,
  CASE WHEN lag(ano) OVER w = ano - 1 THEN round(ieg - lag(ieg) OVER w, 6) END AS delta_ieg
FROM v1 WINDOW w AS (PARTITION BY ra ORDER BY ano)""", "v1"))
def f3_lag_deltas(spark, d):
    v1 = subject_year(spark, d)
    out = FE.add_lag_deltas(v1, "ra", "ano", ["ian", "ida", "ieg"])
    return out.select("ra", "ano", *[F.round(f"delta_{c}", 6).alias(f"delta_{c}") for c in ["ian", "ida", "ieg"]])


@query("f3_wide_period_deltas", with_views("""
SELECT ra, round(max(CASE WHEN ano = 2000 THEN ian END) - max(CASE WHEN ano = 1999 THEN ian END), 6) AS delta_ian_99_00,
  round(max(CASE WHEN ano = 2000 THEN ida END) - max(CASE WHEN ano = 1999 THEN ida END), 6) AS delta_ida_99_00,
  round(max(CASE WHEN ano = 2000 THEN ieg END) - max(CASE WHEN ano = 1999 THEN ieg END), 6) AS delta_ieg_99_00
FROM v1 GROUP BY ra""", "v1"))
def f3_wide_period_deltas(spark, d):
    v1 = subject_year(spark, d)
    wide = to_wide(v1, "ra", "ano", ["ian", "ida", "ieg"], periods(v1, "ano"))
    out = FE.add_period_deltas(wide, ["ian", "ida", "ieg"], "1999", "2000")
    return out.select("ra", *[F.round(c, 6).alias(c) for c in out.columns if c.startswith("delta_")])


@query("f4_row_composites", with_views(f"""
SELECT ra, ano, round(media_indicadores, 6) AS media_indicadores, round(min_indicador, 6) AS min_indicador,
  round(max_indicador, 6) AS max_indicador, round({composite_sql_std()}, 6) AS std_indicadores,
  round(max_indicador - min_indicador, 6) AS range_indicadores
FROM mc""", "v1", ctes=[MODELING_SQL]))
def f4_row_composites(spark, d):
    m = modeling_table(spark, d)
    cols = ["media_indicadores", "min_indicador", "max_indicador", "std_indicadores", "range_indicadores"]
    return m.select("ra", "ano", *[F.round(c, 6).alias(c) for c in cols])


@query("f5_phase_interaction", with_views("""
SELECT ra, ano, round(fase * media_indicadores, 6) AS fase_x_media FROM mc""", "v1", ctes=[MODELING_SQL]))
def f5_phase_interaction(spark, d):
    m = FE.add_interactions(modeling_table(spark, d), ["fase"])
    return m.select("ra", "ano", F.round("fase_x_media", 6).alias("fase_x_media"))


def _wide_9899_sql():
    cols = ", ".join(f"max(CASE WHEN ano = {y} THEN {c} END) AS {c}_{y}"
                     for y in (1998, 1999) for c in ("fase", "ian", "ida", "ieg"))
    return f"w AS (SELECT ra, {cols}, min(ano_ingresso) AS ano_ingresso FROM v1 GROUP BY ra)"


_FLAG = ("CASE WHEN (SELECT avg(CAST({c} IS NULL AS DOUBLE)) FROM w) >= 0.05 "
         "THEN CAST({c} IS NULL AS INTEGER) END AS {c}_missing")
_IND = ["ian_1999", "ida_1999", "ieg_1999"]
_NN = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _IND)
_SUM = " + ".join(f"coalesce({c}, 0.0)" for c in _IND)
_MEAN = f"CASE WHEN ({_NN}) > 0 THEN ({_SUM}) / ({_NN}) END"
_SS = " + ".join(f"coalesce(pow({c} - ({_MEAN}), 2), 0.0)" for c in _IND)


@query("f6_make_features", with_views(f"""
SELECT ra, {', '.join(_FLAG.format(c=c) for c in ['ida_1998', 'ida_1999', 'ieg_1998', 'ieg_1999'])},
  round(ian_1999 - ian_1998, 6) AS delta_ian_98_99, round(ida_1999 - ida_1998, 6) AS delta_ida_98_99,
  round(ieg_1999 - ieg_1998, 6) AS delta_ieg_98_99,
  CASE WHEN 1999 - ano_ingresso IS NOT NULL THEN least(greatest(1999 - ano_ingresso, 0), 15) END AS anos_pm_1999,
  round({_MEAN}, 6) AS media_indicadores,
  round(least({', '.join(_IND)}), 6) AS min_indicador, round(greatest({', '.join(_IND)}), 6) AS max_indicador,
  round(CASE WHEN ({_NN}) > 1 THEN sqrt(({_SS}) / (({_NN}) - 1)) END, 6) AS std_indicadores,
  round(greatest({', '.join(_IND)}) - least({', '.join(_IND)}), 6) AS range_indicadores,
  round(fase_1998 * ({_MEAN}), 6) AS fase_1998_x_media, round(fase_1999 * ({_MEAN}), 6) AS fase_1999_x_media
FROM w""", "v1", ctes=[_wide_9899_sql()]))
def f6_make_features(spark, d):
    v1 = subject_year(spark, d)
    wide = to_wide(v1, "ra", "ano", ["fase", "ian", "ida", "ieg"], [1998, 1999])
    first = v1.groupBy("ra").agg(F.min("ano_ingresso").alias("ano_ingresso"))
    wide = wide.join(first, "ra")
    out = FE.make_features(wide, y0="1998", y1="1999", ref_year=1999, missing_prefixes=["ida", "ieg"])
    keep = [c for c in out.columns if c.endswith("_missing")] + \
           ["delta_ian_98_99", "delta_ida_98_99", "delta_ieg_98_99", "anos_pm_1999", "media_indicadores",
            "min_indicador", "max_indicador", "std_indicadores", "range_indicadores",
            "fase_1998_x_media", "fase_1999_x_media"]
    return out.select("ra", *[F.round(c, 6).alias(c) if not (c.endswith("_missing") or c == "anos_pm_1999")
                              else F.col(c) for c in keep])
