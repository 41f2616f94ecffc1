"""Registered queries: the composed jobs (prepare, M7 load and prepare) over
yearly CSV snapshots with differing headers, made from orders and customer."""

from pyspark.sql import functions as F

from vireo.operators import jobs as J
from vireo.operators.prepare import periods
from vireo.plans.bindings import subject_year, with_views
from vireo.plans.catalog import query
from vireo.streaming.jobs import shared_path

# Headers of the two layouts, by the parity of the year; the odd layout holds
# the gender under two names, of which the first stays.
_EVEN = {"ra": "RA", "idade": "Idade", "genero": "Gênero", "instituicao": "Instituição de Ensino", "fase": "FASE",
         "ano_ingresso": "Ano ingresso", "ian": "IAN", "ida": " Ida", "ieg": "IEG", "pedra": "Pedra", "defasagem": "Defas"}
_ODD = {"ra": "ra", "idade": "IDADE", "genero": "Sexo", "genero2": "gênero", "instituicao": "instituição_de_ensino",
        "fase": "Fase", "ano_ingresso": "ano_ingresso", "ian": "ian", "ida": "IDA ", "ieg": "Ieg", "pedra": "PEDRA",
        "defasagem": "Defasagem"}


def _messy(spark, d):
    """V1 as text a spreadsheet export might hold."""
    k = F.col("ra") % 5
    age = (F.when(k == 0, F.concat(F.lit("1900-01-"), F.lpad((F.col("ra") % 28 + 1).cast("string"), 2, "0")))
            .when(k == 1, F.lit("texto")).otherwise(F.concat((F.col("ra") % 40).cast("string"), F.lit(".5"))))
    return subject_year(spark, d).select(
        "ra", "ano", age.alias("idade"), F.when(F.col("ra") % 2 == 0, "F").otherwise("M").alias("genero"),
        F.lit("?").alias("genero2"), F.when(F.col("ra") % 3 == 0, "Escola Pública").when(F.col("ra") % 3 == 1, "Privada")
        .alias("instituicao"), "fase", "ano_ingresso", "ian", "ida", "ieg",
        F.when(F.col("ian") > 4, "Ametista").otherwise("Quartzo").alias("pedra"), "defasagem")


def prepared(spark, d) -> J.Prepared:
    base = shared_path(spark, "exports")
    raw = _messy(spark, d)
    for name, parity, heads in (("even", 0, _EVEN), ("odd", 1, _ODD)):
        (raw.where(F.col("ano") % 2 == parity).select("ano", *[F.col(c).alias(h) for c, h in heads.items()])
            .write.partitionBy("ano").option("header", "true").option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false").csv(f"{base}/{name}"))
    paths = {y: f"{base}/{'odd' if y % 2 else 'even'}/ano={y}" for y in periods(raw, "ano")}
    return J.prepare_snapshots(spark, paths, shared_path(spark, "snapshots"), categories=["instituicao"])


PREPARED_SQL = """
snap AS (
  SELECT ra, ano, ano_ingresso, fase, ian, ida, ieg, defasagem,
    CASE WHEN ra % 5 = 0 AND ra % 28 + 1 BETWEEN 5 AND 30 THEN ra % 28 + 1
         WHEN ra % 5 > 1 AND ra % 40 BETWEEN 5 AND 30 THEN ra % 40 END AS idade,
    CASE WHEN ra % 2 = 0 THEN 'F' ELSE 'M' END AS genero,
    CASE ra % 3 WHEN 0 THEN 'Publica' WHEN 1 THEN 'Privada' ELSE 'Desconhecido' END AS instituicao
  FROM v1),
pj AS (
  SELECT f.ra, f.ano, f.instituicao, CAST(f.idade AS BIGINT) AS idade, f.genero, CAST(f.fase AS DOUBLE) AS fase,
    CAST(f.ano_ingresso AS DOUBLE) AS ano_ingresso, f.ian, f.ida, f.ieg,
    coalesce(CAST(l.defasagem < 0 AS INTEGER), 0) AS em_risco
  FROM snap f JOIN snap l ON f.ra = l.ra AND l.ano = f.ano + 1)"""


@query("prepare_job_modeling_table", with_views("""
SELECT ra, ano, instituicao, idade, genero, fase, ano_ingresso, round(ian, 6) AS ian, round(ida, 6) AS ida,
  round(ieg, 6) AS ieg, em_risco FROM pj""", "v1", ctes=[PREPARED_SQL]))
def prepare_job_modeling_table(spark, d):
    m = prepared(spark, d).modeling
    return m.select(F.col("ra").cast("bigint").alias("ra"), "ano", "instituicao", "idade", "genero", "fase", "ano_ingresso",
                    *[F.round(c, 6).alias(c) for c in ("ian", "ida", "ieg")], "em_risco")


@query("prepare_job_checks", with_views("""
SELECT 'snapshots' AS "table", 'duplicates' AS check_name, true AS passed
UNION ALL SELECT 'snapshots', 'ranges', (SELECT count(*) = 0 FROM snap WHERE
  NOT (ian BETWEEN 0 AND 10) OR NOT (ida BETWEEN 0 AND 10) OR NOT (ieg BETWEEN 0 AND 10) OR NOT (fase BETWEEN 0 AND 10)
  OR NOT (defasagem BETWEEN -10 AND 10))
UNION ALL SELECT 'snapshots', 'missing', (SELECT greatest(avg(CAST(idade IS NULL AS DOUBLE)), avg(CAST(ida IS NULL AS DOUBLE))) <= 0.3 FROM snap)
UNION ALL SELECT 'snapshots', 'dtypes', true
UNION ALL SELECT 'snapshots', 'leakage', false
UNION ALL SELECT 'features', 'leakage', true""", "v1", ctes=[PREPARED_SQL]))
def prepare_job_checks(spark, d):
    c = prepared(spark, d).checks
    return c.groupBy("table", "check_name").agg(F.bool_and("passed").alias("passed"))


@query("prepare_job_data_card", with_views("""
SELECT s.ano, count(*) AS n_rows, count(*) FILTER (WHERE defasagem < 0) AS n_pos,
  count(*) FILTER (WHERE NOT coalesce(defasagem < 0, false)) AS n_neg,
  round(avg(coalesce(CAST(defasagem < 0 AS INTEGER), 0)), 4) AS pos_ratio, 12 AS n_columns
FROM snap s GROUP BY s.ano""", "v1", ctes=[PREPARED_SQL]))
def prepare_job_data_card(spark, d):
    """Target shares and the schema record of every period."""
    p = prepared(spark, d)
    return p.card.join(p.schemas.select(F.col("year").alias("ano"), "n_columns"), "ano")


_NN = "(CAST(ian IS NOT NULL AS INTEGER) + CAST(ida IS NOT NULL AS INTEGER) + CAST(ieg IS NOT NULL AS INTEGER))"
_MEAN = f"(coalesce(ian, 0.0) + coalesce(ida, 0.0) + coalesce(ieg, 0.0)) / nullif({_NN}, 0)"


@query("m7_load_and_prepare", with_views(f"""
SELECT label, count(*) AS n, count(ida) AS n_ida, CAST(sum(ida_missing) AS BIGINT) AS n_flagged, round(avg(media), 6) AS mean_media,
  round(avg(fase * media), 6) AS mean_product, round(avg(tenure), 6) AS mean_tenure
FROM (SELECT em_risco AS label, ida, fase, {_MEAN} AS media,
        CASE WHEN (SELECT avg(CAST(ida IS NULL AS DOUBLE)) FROM pj) >= 0.05 THEN CAST(ida IS NULL AS INTEGER) END AS ida_missing,
        least(greatest(2023 - ano_ingresso, 0), 15) AS tenure FROM pj) GROUP BY label""", "v1", ctes=[PREPARED_SQL]))
def m7_load_and_prepare(spark, d):
    """The training set made from the prepared snapshots, per class."""
    t = J.load_and_prepare(prepared(spark, d).modeling.drop("ano")).table
    mean = lambda c, name: F.round(F.avg(c), 6).alias(name)
    return t.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count("ida").alias("n_ida"), F.sum("ida_missing").alias("n_flagged"),
                                  mean("media_indicadores", "mean_media"), mean("fase_x_media", "mean_product"),
                                  mean("anos_pm_2023", "mean_tenure"))
