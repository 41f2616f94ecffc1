"""Registered queries: drift on the events table (A6-A13, W7 batch twin, D13).

Baseline window: the first three weeks (ts < 2024-01-22); current window:
the rest.  Numeric features: ``value`` and ``k`` (from the JSON props);
categorical: ``event_type`` and ``user_id``; score = value / (value + 50).
"""

from pyspark.sql import functions as F

from vireo.operators import baselines as B
from vireo.operators import drift as D
from vireo.plans.bindings import table
from vireo.plans.catalog import REGISTRY, query
from vireo.plans.sqlgen import edge_bin_sql
from vireo.streaming.jobs import shared_path

SPLIT = "2024-01-22"
NUM = ["k", "value"]
CAT = ["event_type", "user_id"]
TOPK = 3


def _events(spark, d):
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("request_id"), F.col("ts"),
                    F.get_json_object("props", "$.k").cast("double").alias("k"), "value", "event_type",
                    F.col("user_id").cast("string").alias("user_id"),
                    (F.col("value") / (F.col("value") + 50)).alias("score"))


def _windows(spark, d):
    ev = _events(spark, d)
    return ev.where(F.col("ts") < F.lit(SPLIT)), ev.where(F.col("ts") >= F.lit(SPLIT))


def _long(df, cols, cast):
    return df.select(*[F.col(c).cast(cast).alias(c) for c in cols]).unpivot([], cols, "feature", "value")


EV_SQL = f"""ev AS (SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value, event_type,
  CAST(user_id AS VARCHAR) AS user_id, value / (value + 50) AS score FROM events),
base AS (SELECT * FROM ev WHERE ts < TIMESTAMP '{SPLIT}'),
cur AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '{SPLIT}'),
bl AS (SELECT feature, value FROM (SELECT k, value FROM base) UNPIVOT INCLUDE NULLS (value FOR feature IN (k, value))),
cl AS (SELECT feature, value FROM (SELECT k, value FROM cur) UNPIVOT INCLUDE NULLS (value FOR feature IN (k, value))),
blc AS (SELECT feature, value FROM (SELECT event_type, user_id FROM base)
        UNPIVOT INCLUDE NULLS (value FOR feature IN (event_type, user_id))),
clc AS (SELECT feature, value FROM (SELECT event_type, user_id FROM cur)
        UNPIVOT INCLUDE NULLS (value FOR feature IN (event_type, user_id)))"""


def _psi_sql(g: str) -> str:
    return f"""(SELECT feature, sum((c2 - b2) * ln(c2 / b2)) AS psi FROM (
  SELECT feature, (b + 1e-6) / sum(b + 1e-6) OVER (PARTITION BY feature) AS b2,
         (c + 1e-6) / sum(c + 1e-6) OVER (PARTITION BY feature) AS c2 FROM {g}) GROUP BY feature)"""


def _num_psi_ctes(mode: str) -> str:
    base_b = ("1.0 / (len(ed.edges) + 1)" if mode == "equal"
              else "coalesce(bb.cnt, 0) / bt.tot")
    return f"""
prof AS (SELECT feature, round(quantile_cont(value, 0.05), 4) AS p05, round(quantile_cont(value, 0.25), 4) AS p25,
  round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75,
  round(quantile_cont(value, 0.95), 4) AS p95, round(min(value), 4) AS mn, round(max(value), 4) AS mx,
  CASE WHEN count(value) = 0 THEN 1.0 ELSE 1 - count(value) / count(*) END AS missing_rate FROM bl GROUP BY feature),
ed AS (SELECT feature, CASE WHEN len(e) >= 2 THEN e ELSE [mn, mx] END AS edges FROM (
  SELECT feature, mn, mx, list_sort(list_distinct(list_filter([p05, p25, p50, p75, p95], lambda x: x IS NOT NULL))) AS e
  FROM prof)),
grid AS (SELECT feature, UNNEST(range(0, len(edges) + 1)) AS bin FROM ed),
cb AS (SELECT cl.feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS cnt
       FROM cl JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY ALL),
bb AS (SELECT bl.feature, len(list_filter(edges, lambda e: value >= e)) AS bin, count(*) AS cnt
       FROM bl JOIN ed USING (feature) WHERE value IS NOT NULL GROUP BY ALL),
ct AS (SELECT feature, sum(cnt) AS tot FROM cb GROUP BY feature),
bt AS (SELECT feature, sum(cnt) AS tot FROM bb GROUP BY feature),
ng AS (SELECT grid.feature, grid.bin, {base_b} AS b, coalesce(cb.cnt, 0) / ct.tot AS c
       FROM grid JOIN ed USING (feature) LEFT JOIN cb USING (feature, bin) LEFT JOIN bb USING (feature, bin)
       JOIN ct USING (feature) LEFT JOIN bt USING (feature)),
npsi AS {_psi_sql('ng')}"""


CAT_PSI_CTES = f"""
bc AS (SELECT feature, value, count(*) AS cnt FROM blc WHERE value IS NOT NULL GROUP BY ALL),
btot AS (SELECT feature, sum(cnt) AS tot FROM bc GROUP BY feature),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value) AS rk FROM bc)
        WHERE rk <= {TOPK}),
oth AS (SELECT t.feature, '__other__' AS value, tot - s AS cnt FROM btot t
        JOIN (SELECT feature, sum(cnt) AS s FROM top GROUP BY feature) x USING (feature) WHERE tot > s),
cats AS (SELECT feature, value, round(cnt / tot, 4) AS b FROM (SELECT feature, value, cnt FROM top UNION ALL
         SELECT * FROM oth) JOIN btot USING (feature)),
cc AS (SELECT feature, value, count(*) AS cnt FROM clc WHERE value IS NOT NULL GROUP BY ALL),
ctot AS (SELECT feature, sum(cnt) AS tot FROM cc GROUP BY feature),
ho AS (SELECT DISTINCT feature FROM cats WHERE value = '__other__'),
mp AS (SELECT cc.feature, CASE WHEN k.value IS NOT NULL THEN cc.value WHEN ho.feature IS NOT NULL THEN '__other__' END
              AS value, cnt
       FROM cc LEFT JOIN cats k ON cc.feature = k.feature AND cc.value = k.value LEFT JOIN ho ON cc.feature = ho.feature),
m AS (SELECT feature, value, sum(cnt) AS cnt FROM mp WHERE value IS NOT NULL GROUP BY ALL),
cg AS (SELECT cats.feature, cats.value, cats.b, coalesce(coalesce(m.cnt, 0) / ctot.tot, 0.0) AS c
       FROM cats LEFT JOIN m USING (feature, value) LEFT JOIN ctot USING (feature)),
cpsi AS {_psi_sql('cg')}"""


@query("a7_numeric_psi_events", f"WITH {EV_SQL}, {_num_psi_ctes('quantile')}\n"
                                "SELECT feature, round(psi, 6) AS psi FROM npsi")
def a7_numeric_psi_events(spark, d):
    b, c = _windows(spark, d)
    out = D.numeric_psi(_long(b, NUM, "double"), _long(c, NUM, "double"))
    return out.select("feature", F.round("psi", 6).alias("psi"))


@query("a7_numeric_psi_equal_share", f"WITH {EV_SQL}, {_num_psi_ctes('equal')}\n"
                                     "SELECT feature, round(psi, 6) AS psi FROM npsi")
def a7_numeric_psi_equal_share(spark, d):
    b, c = _windows(spark, d)
    out = D.numeric_psi(_long(b, NUM, "double"), _long(c, NUM, "double"), baseline="equal")
    return out.select("feature", F.round("psi", 6).alias("psi"))


@query("a8_categorical_psi_events", f"WITH {EV_SQL}, {CAT_PSI_CTES}\nSELECT feature, round(psi, 6) AS psi FROM cpsi")
def a8_categorical_psi_events(spark, d):
    b, c = _windows(spark, d)
    top = D.categorical_profile_long(_long(b, CAT, "string"), TOPK)
    out = D.categorical_psi(_long(c, CAT, "string"), top)
    return out.select("feature", F.round("psi", 6).alias("psi"))


_STATUS = """CASE WHEN abs(md) >= 0.1 THEN 'red' WHEN abs(md) >= 0.05 AND st = 'green' THEN 'yellow' ELSE st END"""
DRIFT_SQL = f"""WITH {EV_SQL}, {_num_psi_ctes('quantile')}, {CAT_PSI_CTES},
nce AS (SELECT count(*) AS n FROM cur),
rows_ AS (
  SELECT p.feature, 'numeric' AS type, p.psi, prof.missing_rate AS bm,
    CASE WHEN nce.n > 0 THEN 1 - coalesce(v.nv, 0) / nce.n ELSE 0.0 END AS cm
  FROM npsi p JOIN prof USING (feature) LEFT JOIN (SELECT feature, count(value) AS nv FROM cl GROUP BY feature) v
    USING (feature), nce
  UNION ALL
  SELECT p.feature, 'categorical', p.psi, bmc.missing_rate,
    CASE WHEN nce.n > 0 THEN 1 - coalesce(v.nv, 0) / nce.n ELSE 0.0 END
  FROM cpsi p JOIN (SELECT feature, 1 - count(value) / count(*) AS missing_rate FROM blc GROUP BY feature) bmc
    USING (feature) LEFT JOIN (SELECT feature, count(value) AS nv FROM clc GROUP BY feature) v USING (feature), nce),
st_ AS (SELECT *, cm - bm AS md, CASE WHEN psi >= 0.25 THEN 'red' WHEN psi >= 0.1 THEN 'yellow' ELSE 'green' END AS st
        FROM rows_)"""


@query("a10_feature_drift_events", DRIFT_SQL + f"""
SELECT feature, type, round(psi, 4) AS psi, round(bm, 4) AS baseline_missing_rate, round(cm, 4) AS current_missing_rate,
  round(md, 4) AS missing_delta, {_STATUS} AS status FROM st_""")
def a10_feature_drift_events(spark, d):
    return _feature_drift(spark, d)


def _from_days(spark, d):
    """The baseline window stored once; the days after it counted once each."""
    b, c = _windows(spark, d)
    base, store = shared_path(spark, "baseline"), shared_path(spark, "day-counts")
    B.store_baseline(b, base, "v1", NUM, CAT, "score", TOPK)
    stored = B.read_baseline(spark, base, "v1")
    B.write_day_counts(c, "ts", stored, store, "score")
    return B.read_day_counts(spark, store, stored, SPLIT), stored


@query("a10_feature_drift_from_days", DRIFT_SQL + f"""
SELECT feature, type, round(psi, 4) AS psi, round(bm, 4) AS baseline_missing_rate, round(cm, 4) AS current_missing_rate,
  round(md, 4) AS missing_delta, {_STATUS} AS status FROM st_""")
def a10_feature_drift_from_days(spark, d):
    """The rows of a10_feature_drift_events from stored counts alone."""
    return B.drift_from_counts(*_from_days(spark, d))


def _feature_drift(spark, d):
    b, c = _windows(spark, d)
    n_cur = c.count()
    return D.feature_drift(_long(b, NUM, "double"), _long(c, NUM, "double"), _long(b, CAT, "string"),
                           _long(c, CAT, "string"), n_cur, NUM, CAT, top_k=TOPK)


SCORE_CTES = f"""
sbb AS (SELECT {edge_bin_sql('score')} AS bin, count(*) AS cnt FROM base WHERE score IS NOT NULL GROUP BY ALL),
scb AS (SELECT {edge_bin_sql('score')} AS bin, count(*) AS cnt FROM cur WHERE score IS NOT NULL GROUP BY ALL),
sg AS (SELECT 0 AS feature, r.bin, coalesce(x.cnt, 0) / (SELECT count(*) FROM base WHERE score IS NOT NULL) AS b,
         coalesce(y.cnt, 0) / (SELECT count(*) FROM cur WHERE score IS NOT NULL) AS c
       FROM range(20) r(bin) LEFT JOIN sbb x ON x.bin = r.bin LEFT JOIN scb y ON y.bin = r.bin),
spsi AS {_psi_sql('sg')},
sd AS (SELECT round(psi, 4) AS psi, round((SELECT avg(score) FROM base), 4) AS baseline_mean,
  round((SELECT avg(score) FROM cur), 4) AS current_mean,
  round((SELECT avg(score) FROM cur) - (SELECT avg(score) FROM base), 4) AS delta_mean,
  CASE WHEN psi >= 0.25 THEN 'red' WHEN psi >= 0.1 THEN 'yellow' ELSE 'green' END AS status FROM spsi)"""


@query("a13_score_drift_events", f"WITH {EV_SQL}, {SCORE_CTES}\nSELECT * FROM sd")
def a13_score_drift_events(spark, d):
    b, c = _windows(spark, d)
    return D.score_drift(b.select("score"), c.select("score"))


@query("a10_global_drift_status", DRIFT_SQL + f""", {SCORE_CTES},
fs AS (SELECT {_STATUS} AS status FROM st_)
SELECT CASE WHEN (SELECT n FROM nce) = 0 THEN 'no_data'
            WHEN count(*) FILTER (WHERE status = 'red') > 0 OR (SELECT status FROM sd) = 'red' THEN 'red'
            WHEN count(*) > 0 AND count(*) FILTER (WHERE status = 'yellow') / count(*) > 0.2 THEN 'yellow'
            WHEN (SELECT status FROM sd) = 'yellow' THEN 'yellow' ELSE 'green' END AS global_status,
  count(*) AS n_features, count(*) FILTER (WHERE status = 'red') AS n_red,
  count(*) FILTER (WHERE status = 'yellow') AS n_yellow,
  count(*) - count(*) FILTER (WHERE status = 'red') - count(*) FILTER (WHERE status = 'yellow') AS n_green,
  (SELECT status FROM sd) AS score_status, (SELECT n FROM nce) AS n_requests
FROM fs""")
def a10_global_drift_status(spark, d):
    b, c = _windows(spark, d)
    fd = _feature_drift(spark, d)
    sd = D.score_drift(b.select("score"), c.select("score"))
    return D.global_status(fd, sd, c.count())


@query("a10_global_status_from_days", REGISTRY["a10_global_drift_status"][1])
def a10_global_status_from_days(spark, d):
    return B.global_status_from_counts(*_from_days(spark, d))


@query("a13_score_drift_from_days", REGISTRY["a13_score_drift_events"][1])
def a13_score_drift_from_days(spark, d):
    return B.score_drift_from_counts(*_from_days(spark, d))


@query("a11_extract_feature_values", """
SELECT event_id AS request_id, 'k' AS feature, json_extract_string(props, '$.k') AS value FROM events""")
def a11_extract_feature_values(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("request_id"), F.col("props").alias("features_sanitized"))
    return D.extract_feature_values(e)


@query("w7_daily_score_psi_batch", f"""WITH {EV_SQL},
sbb AS (SELECT {edge_bin_sql('score')} AS bin, count(*) AS cnt FROM base WHERE score IS NOT NULL GROUP BY ALL),
bf AS (SELECT r.bin, coalesce(x.cnt, 0) / (SELECT count(*) FROM base WHERE score IS NOT NULL) AS b
       FROM range(20) r(bin) LEFT JOIN sbb x ON x.bin = r.bin),
dn AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM cur WHERE score IS NOT NULL GROUP BY ALL),
dc AS (SELECT CAST(ts AS DATE) AS day, {edge_bin_sql('score')} AS bin, count(*) AS cnt FROM cur
       WHERE score IS NOT NULL GROUP BY ALL),
g AS (SELECT dn.day AS feature, bf.bin, bf.b, coalesce(dc.cnt, 0) / dn.n AS c FROM dn, bf
      LEFT JOIN dc ON dc.day = dn.day AND dc.bin = bf.bin),
p AS {_psi_sql('g')}
SELECT feature AS day, round(psi, 4) AS psi,
  CASE WHEN psi >= 0.25 THEN 'red' WHEN psi >= 0.1 THEN 'yellow' ELSE 'green' END AS status FROM p""")
def w7_daily_score_psi_batch(spark, d):
    b, c = _windows(spark, d)
    return D.daily_score_psi(b.select("score"), c.select("ts", "score"))
