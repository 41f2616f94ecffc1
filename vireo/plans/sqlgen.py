"""SQL text builders for the DuckDB oracle of the generic checks.

They emit the same long result rows as ``vireo.operators.quality`` so that a
check over any table can be compared with an independent engine.
"""

from __future__ import annotations


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def row(check, passed, column, metric, value, detail="NULL") -> str:
    return (f"SELECT {lit(check)} AS check_name, CAST({passed} AS BOOLEAN) AS passed, "
            f"CAST({lit(column)} AS VARCHAR) AS \"column\", {lit(metric)} AS metric, "
            f"CAST({value} AS DOUBLE) AS value, CAST({detail} AS VARCHAR) AS detail")


def duplicates(src: str, keys: list[str], sample: int = 10) -> str:
    k = ", ".join(keys)
    name = ",".join(keys)
    kstr = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in keys)
    return f"""
SELECT * FROM (
  WITH d AS (SELECT {k}, count(*) AS n FROM ({src}) t GROUP BY {k} HAVING count(*) > 1),
  s AS (SELECT coalesce(sum(n), 0) AS rows_, count(*) AS nkeys FROM d),
  f AS (SELECT coalesce(string_agg({kstr}, ',' ORDER BY {k}), '') AS keys
        FROM (SELECT {k} FROM d ORDER BY {k} LIMIT {sample}) x)
  {row('duplicates', 'rows_ = 0', name, 'n_duplicate_rows', 'rows_')} FROM s
  UNION ALL {row('duplicates', 'rows_ = 0', name, 'n_duplicate_keys', 'nkeys')} FROM s
  UNION ALL {row('duplicates', "keys = ''", name, 'sample_keys', 'NULL', 'keys')} FROM f
)"""


def ranges(src: str, rng: dict[str, tuple[float, float]]) -> str:
    parts = []
    for c, (lo, hi) in rng.items():
        det = lit(f"[{lo}, {hi}]")
        v = f"CAST({c} AS DOUBLE)"
        agg = (f"(SELECT count(*) FILTER (WHERE {v} IS NOT NULL AND ({v} < {lo} OR {v} > {hi})) AS nv, "
               f"min({v}) AS mn, max({v}) AS mx FROM ({src}) t) a")
        for metric, val in (("n_violations", "nv"), ("min", "mn"), ("max", "mx")):
            parts.append(f"{row('ranges', 'nv = 0', c, metric, val, det)} FROM {agg}")
    return "\nUNION ALL ".join(parts)


def missing(src: str, cols: list[str], critical: list[str], max_ratio: float) -> str:
    parts = []
    for c in cols:
        crit = c in critical
        det = lit("critical") if crit else "NULL"
        agg = (f"(SELECT count(*) FILTER (WHERE {c} IS NULL) AS m, count(*) AS n FROM ({src}) t) a")
        ratio = "round(coalesce(CAST(m AS DOUBLE) / nullif(n, 0), 0.0), 4)"
        ok = "m = 0" if crit else f"{ratio} <= {max_ratio}"
        parts.append(f"{row('missing', ok, c, 'n_missing', 'm', det)} FROM {agg}")
        parts.append(f"{row('missing', ok, c, 'missing_ratio', ratio, det)} FROM {agg}")
    return "\nUNION ALL ".join(parts)


SPARK_TYPE = ("CASE typeof({c}) WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' "
              "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' "
              "ELSE lower(typeof({c})) END")


def dtypes(src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        t = SPARK_TYPE.format(c=c)
        ok = f"({t}) IN ('int', 'bigint', 'double', 'float', 'smallint', 'tinyint')"
        parts.append(f"{row('dtypes', ok, c, 'numeric', f'CASE WHEN {ok} THEN 1.0 ELSE 0.0 END', t)} "
                     f"FROM (SELECT * FROM ({src}) t LIMIT 1) a")
    return "\nUNION ALL ".join(parts)


def unpivot(src: str, cols: list[str], cast: str = "DOUBLE", include_nulls: bool = True) -> str:
    sel = ", ".join(f"CAST({c} AS {cast}) AS {c}" for c in cols)
    inc = " INCLUDE NULLS" if include_nulls else ""
    return (f"(SELECT feature, value FROM (SELECT {sel} FROM ({src}) s0) s "
            f"UNPIVOT{inc} (value FOR feature IN ({', '.join(cols)})))")


def numeric_profile(src: str, cols: list[str], digits: int = 4) -> str:
    qs = [("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95)]
    qsel = ", ".join(f"round(quantile_cont(value, {p}), {digits}) AS {n}" for n, p in qs)
    return f"""
SELECT feature, 'numeric' AS type, CAST(CASE WHEN count(value) = 0 THEN 0 ELSE count(*) END AS BIGINT) AS count,
  CASE WHEN count(value) = 0 THEN 1.0 ELSE round(1 - count(value) / count(*), {digits}) END AS missing_rate,
  {qsel}, round(avg(value), {digits}) AS mean,
  CASE WHEN count(value) > 1 THEN round(stddev_samp(value), {digits}) WHEN count(value) = 1 THEN 0.0 END AS std,
  round(min(value), {digits}) AS min, round(max(value), {digits}) AS max
FROM {unpivot(src, cols)} u GROUP BY feature"""


def categorical_profile(src: str, cols: list[str], top_k: int = 10, digits: int = 4) -> str:
    return f"""
SELECT * FROM (
WITH vc AS (SELECT feature, value, count(*) AS cnt FROM {unpivot(src, cols, 'VARCHAR', False)} u GROUP BY ALL),
tot AS (SELECT feature, sum(cnt) AS tot FROM vc GROUP BY feature),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, value ASC) AS rank
                       FROM vc) WHERE rank <= {top_k}),
oth AS (SELECT t.feature, '__other__' AS value, tot - s AS cnt, {top_k + 1} AS rank
        FROM tot t JOIN (SELECT feature, sum(cnt) AS s FROM top GROUP BY feature) x USING (feature) WHERE tot > s)
SELECT feature, value, CAST(cnt AS BIGINT) AS cnt, round(cnt / tot, {digits}) AS freq, CAST(rank AS INTEGER) AS rank
FROM (SELECT feature, value, cnt, rank FROM top UNION ALL SELECT * FROM oth) a JOIN tot USING (feature))"""


def unit_edges_sql(bins: int = 20) -> str:
    return "CAST([" + ", ".join(repr(round(i / bins, 4)) for i in range(bins + 1)) + "] AS DOUBLE[])"


def edge_bin_sql(v: str, bins: int = 20) -> str:
    return (f"CASE WHEN {v} >= 0.0 AND {v} <= 1.0 THEN least(len(list_filter({unit_edges_sql(bins)}, "
            f"lambda e: {v} >= e)) - 1, {bins - 1}) END")


def _split_top_level(s: str) -> list[str]:
    parts, depth, cur, quote = [], 0, [], False
    for ch in s:
        if ch == "'":
            quote = not quote
        if not quote:
            if ch == "(" or ch == "[":
                depth += 1
            elif ch == ")" or ch == "]":
                depth -= 1
            elif ch == "," and depth == 0:
                parts.append("".join(cur))
                cur = []
                continue
        cur.append(ch)
    parts.append("".join(cur))
    return parts


def decimal_rounding(sql: str) -> str:
    """Rewrite ``round(x, d)`` as decimal half-up rounding.

    Spark rounds a double by its shortest decimal form, half-up; DuckDB
    rounds the binary value (1.005 -> 1.0 there, 1.01 in Spark).  Rounding
    the shortest decimal text through DECIMAL makes the oracle round like
    Spark.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        # find matching paren
        depth, k, quote = 0, j + 5, False
        while k < len(sql):
            ch = sql[k]
            if ch == "'":
                quote = not quote
            elif not quote:
                if ch == "(":
                    depth += 1
                elif ch == ")":
                    depth -= 1
                    if depth == 0:
                        break
            k += 1
        inner = sql[j + 6:k]
        args = _split_top_level(inner)
        out.append(sql[i:j])
        if len(args) == 2 and args[1].strip().isdigit():
            x = decimal_rounding(args[0])
            out.append(f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), "
                       f"{args[1].strip()}) AS DOUBLE)")
        else:
            out.append("round(" + decimal_rounding(inner) + ")")
        i = k + 1
