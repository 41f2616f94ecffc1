"""Registered queries: personal data, audit and retention."""

from pyspark.sql import functions as F

from vireo import config as C
from vireo.operators import privacy as S
from vireo.operators.joins import verify_hashes
from vireo.plans.bindings import req_log, table, with_views
from vireo.plans.catalog import query
from vireo.sources.tables import append_events
from vireo.streaming.jobs import shared_path


def _scan_sql(tbl: str, col: str, by: str) -> str:
    # one aggregation per pattern, grouped by the source column
    sel = "\nUNION ALL ".join(
        f"""SELECT {by}, count(*) AS n_rows, '{col}' AS "column", '{name}' AS pattern,
  count(*) FILTER (WHERE len(regexp_extract_all({col}, '{pat.replace("'", "''")}')) > 0) AS rows_matched,
  CAST(coalesce(sum(len(regexp_extract_all({col}, '{pat.replace("'", "''")}'))), 0) AS BIGINT) AS n_matches
FROM {tbl} GROUP BY {by}""" for name, pat in C.PII_PATTERNS)
    return sel


@query("s1_pii_scan_documents", _scan_sql("documents", "text", "source"))
def s1_pii_scan_documents(spark, d):
    return S.pii_scan(table(spark, d, "documents"), ["text"], ["source"])


@query("s1_pii_scan_conversations", _scan_sql("conversations", "text", "role"))
def s1_pii_scan_conversations(spark, d):
    return S.pii_scan(table(spark, d, "conversations"), ["text"], ["role"])


@query("s1_pii_scan_pages", _scan_sql("(SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, html FROM pages)",
                                      "html", "host"))
def s1_pii_scan_pages(spark, d):
    p = table(spark, d, "pages").select(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"), "html")
    return S.pii_scan(p, ["html"], ["host"])


def _redact_sql(col: str) -> str:
    e = col
    for _, pat in C.PII_PATTERNS:
        e = f"regexp_replace({e}, '{pat.replace(chr(39), chr(39) * 2)}', '[REDACTED]', 'g')"
    return e


@query("s2_redact_documents", f"SELECT doc_id, {_redact_sql('text')} AS text FROM documents")
def s2_redact_documents(spark, d):
    return S.redact_columns(table(spark, d, "documents").select("doc_id", "text"), ["text"])


@query("s2_redact_conversations", f"SELECT conv_id, turn, {_redact_sql('text')} AS text FROM conversations")
def s2_redact_conversations(spark, d):
    return S.redact_columns(table(spark, d, "conversations").select("conv_id", "turn", "text"), ["text"])


def _any_pii_sql(col: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({col}, '{p.replace(chr(39), chr(39) * 2)}')"
                             for _, p in C.PII_PATTERNS) + ")"


@query("s3_sanitize_nested_documents", f"""
SELECT doc_id, '[REDACTED]' AS name, lang AS meta_lang, '[REDACTED]' AS meta_email, n_chars AS meta_n_chars,
  CASE WHEN {_any_pii_sql('text')} THEN {_redact_sql('text')} ELSE text END AS text
FROM documents""")
def s3_sanitize_nested_documents(spark, d):
    doc = table(spark, d, "documents")
    nested = doc.select("doc_id", F.col("source").alias("name"),
                        F.struct("lang", F.col("source").alias("email"), "n_chars").alias("meta"), "text")
    s = S.sanitize(nested)
    return s.select("doc_id", "name", F.col("meta.lang").alias("meta_lang"), F.col("meta.email").alias("meta_email"),
                    F.col("meta.n_chars").alias("meta_n_chars"), "text")


@query("s3_sanitize_map", f"""
SELECT doc_id, '[REDACTED]' AS email, CASE WHEN {_any_pii_sql('text')} THEN {_redact_sql('text')} ELSE text END AS note,
  CASE WHEN {_any_pii_sql('text')} THEN {_redact_sql('text')} ELSE text END AS first
FROM documents""")
def s3_sanitize_map(spark, d):
    doc = table(spark, d, "documents")
    nested = doc.select("doc_id", F.create_map(F.lit("Email"), F.col("source"), F.lit("note"), F.col("text")).alias("m"),
                        F.array("text", "lang").alias("a"))
    s = S.sanitize(nested)
    return s.select("doc_id", F.col("m")["Email"].alias("email"), F.col("m")["note"].alias("note"), F.col("a")[0].alias("first"))


@query("s4_safe_view_conversations", f"""
SELECT turn, CASE WHEN NOT {_any_pii_sql('text')} AND length(text) < 50 THEN text END AS text
FROM conversations""")
def s4_safe_view_conversations(spark, d):
    return S.safe_aggregate_view(table(spark, d, "conversations"), ["turn", "text"])


@query("s5_pseudonymize_customer", """
SELECT substr(sha256('cohort-a:' || CAST(c_custkey AS VARCHAR)), 1, 16) AS c_custkey, c_nationkey, c_mktsegment
FROM customer""")
def s5_pseudonymize_customer(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return S.pseudonymize_columns(c, ["c_custkey"], salt="cohort-a")


@query("s6_audit_fingerprints", with_views("""
SELECT 'predict' AS action, substr(sha256(concat_ws(',', 'api_key=' || CAST(api_key AS VARCHAR),
    'endpoint=' || endpoint, 'status_code=' || CAST(status_code AS VARCHAR))), 1, 16) AS data_hash,
  3 AS field_count, request_id
FROM v3""", "v3"))
def s6_audit_fingerprints(spark, d):
    v3 = req_log(spark, d)
    cols = ["api_key", "endpoint", "status_code"]
    return v3.select(F.lit("predict").alias("action"), S.row_fingerprint(v3, cols).alias("data_hash"),
                     F.lit(len(cols)).alias("field_count"), "request_id")


@query("s6_audit_records", """
SELECT event_id AS request_id, substr(sha256(concat_ws(',', 'event_type=' || event_type, 'props=' || props)), 1, 16) AS input_hash,
  2 AS field_count, round(value / (value + 50), 6) AS probability, 'v1' AS model_version, round(value, 2) AS latency_ms,
  event_type <> 'error' AS success
FROM events""")
def s6_audit_records(spark, d):
    """An audit record per request: hashes and rounded numbers, no inputs."""
    e = table(spark, d, "events").withColumn("probability", F.col("value") / (F.col("value") + 50))
    return S.audit_records(e, "event_id", ["event_type", "props"], "probability", "value", F.col("event_type") != "error", "v1") \
        .withColumnRenamed("event_id", "request_id")


@query("s7_drop_pii_fields", """
SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def s7_drop_pii_fields(spark, d):
    c = table(spark, d, "customer").withColumnRenamed("c_name", "nome").withColumnRenamed("c_custkey", "ra")
    return S.drop_pii_fields(c)


@query("s7_drop_pii_keys_in_map", """
SELECT event_id, json_extract_string(props, '$.k') AS k, 2 AS n_keys_before, 1 AS n_keys_after FROM events""")
def s7_drop_pii_keys_in_map(spark, d):
    e = table(spark, d, "events")
    m = F.map_concat(F.from_json("props", "map<string,string>"),
                     F.create_map(F.lit("email"), F.col("user_id").cast("string")))
    clean = S.drop_pii_keys(m)
    return e.select("event_id", clean["k"].alias("k"), F.size(m).alias("n_keys_before"),
                    F.size(clean).alias("n_keys_after"))


@query("s8_retention_report_events", """
SELECT event_type, count(*) AS total, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) AS removed,
  count(*) FILTER (WHERE NOT (ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY) OR ts IS NULL) AS retained
FROM events GROUP BY event_type""")
def s8_retention_report_events(spark, d):
    return S.retention_report(table(spark, d, "events"), "ts", "2024-01-31", 14, ["event_type"])


_KEEP = "(ts IS NULL OR ts >= TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 14 DAY)"


@query("s8_retention_run", f"""
SELECT dt, count(*) AS total, count(*) FILTER (WHERE NOT {_KEEP}) AS removed, count(*) FILTER (WHERE {_KEEP}) AS retained,
  CASE WHEN count(*) FILTER (WHERE NOT {_KEEP}) = 0 THEN 'keep' WHEN count(*) FILTER (WHERE {_KEEP}) = 0 THEN 'drop'
       ELSE 'rewrite' END AS action, count(*) FILTER (WHERE {_KEEP}) AS n_after
FROM (SELECT ts, CAST(ts AS DATE) AS dt FROM events) GROUP BY dt""")
def s8_retention_run(spark, d):
    """A store by date cleaned in earnest: the rows found in it afterwards."""
    store = shared_path(spark, "retention")
    append_events(table(spark, d, "events"), store)
    plan = S.run_retention(spark, store, "2024-01-31 06:00:00", 14, dry_run=False)
    left = spark.read.parquet(store).groupBy("dt").agg(F.count(F.lit(1)).alias("n_after"))
    return plan.join(left, "dt", "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))


@query("s9_file_ages", "SELECT ts < TIMESTAMP '2024-01-15' AS expired, count(*) AS n_rows FROM events GROUP BY ALL")
def s9_file_ages(spark, d):
    """Rows in files older than a cutoff that lies between two appends."""
    e = table(spark, d, "events")
    store = shared_path(spark, "ages")
    cut = F.lit("2024-01-15")
    append_events(e.where(F.col("ts") < cut), store)
    first = spark.read.parquet(store).agg(F.max("_metadata.file_modification_time") + F.expr("INTERVAL 1 MILLISECOND")).first()[0]
    append_events(e.where(F.col("ts") >= cut), store)
    return S.rows_by_file_age(spark.read.parquet(store), first)


# every column as text, in a format that both engines write alike, with its length before it
_TEXTS = ["CAST(event_id AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", "CAST(user_id AS VARCHAR)", "event_type",
          "CAST(CAST(value AS DECIMAL(30, 9)) AS VARCHAR)", "props"]
_ROW = " || ".join(f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '-')" for t in _TEXTS)


def _hashed(df):
    """The event table with all of its columns as text."""
    return df.select("dt", F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                     F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("value").cast("decimal(30,9)").cast("string").alias("value"), "props")


@query("s10_file_hashes_verified", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS name,
  sha256(CAST(sum(CAST('0x' || substr(md5({_ROW}), 1, 15) AS BIGINT)) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)) AS expected,
  CAST(ts AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-12', DATE '2024-01-15') AS ok
FROM events GROUP BY CAST(ts AS DATE)""")
def s10_file_hashes_verified(spark, d):
    """Hashes of all columns of the event table by day against a store of it by
    day, in which the users of one day, the values of another and the times
    within a third have been changed."""
    e = table(spark, d, "events")
    store = shared_path(spark, "hashes")
    on = lambda day: F.to_date("ts") == F.lit(day)
    append_events(e.select("event_id", F.when(on("2024-01-15"), F.date_trunc("second", "ts")).otherwise(F.col("ts")).cast(e.schema["ts"].dataType).alias("ts"),
                           F.when(on("2024-01-10"), F.col("user_id") + 1).otherwise(F.col("user_id")).alias("user_id"), "event_type",
                           F.when(on("2024-01-12"), F.col("value") + 0.25).otherwise(F.col("value")).alias("value"), "props"), store)
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    checked = verify_hashes(S.content_hashes(_hashed(e.withColumn("dt", F.to_date("ts"))), "dt", cols),
                            S.content_hashes(_hashed(spark.read.parquet(store)), "dt", cols))
    return checked.select("name", "expected", "ok")


@query("s10_stored_files_verified", """
SELECT count(DISTINCT CAST(ts AS DATE)) AS n_files, 1 AS n_changed, 1 AS n_absent, 1 AS n_changed_by_block, false AS verified FROM events""")
def s10_stored_files_verified(spark, d):
    """The files of a store by day, hashed as files and by blocks; then one file
    gets more rows and one is lost."""
    e = table(spark, d, "events").withColumn("dt", F.to_date("ts"))
    store, changed = shared_path(spark, "files"), shared_path(spark, "files-changed")

    def write(df, path):
        # a text file per day, named by it
        df.select("dt", F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props")).alias("line")) \
          .repartition("dt").sortWithinPartitions("dt", "line").write.partitionBy("dt").text(path)

    def by_day(hashes, path):
        day = F.regexp_extract("path", r"dt=([0-9-]+)", 1)
        return hashes(spark, path).withColumn("name", day).drop("path")

    write(e, store)
    # a day's events once more under other ids
    more = e.where(F.col("dt") == "2024-01-09").withColumn("event_id", -1 - F.col("event_id"))
    write(e.where(F.col("dt") != "2024-01-20").unionByName(more), changed)
    before, after = by_day(S.file_hashes, store), by_day(S.file_hashes, changed)
    checked = verify_hashes(before, after).withColumn("absent", F.col("actual").isNull())
    blocks = S.changed_blocks(by_day(S.file_block_hashes, store), by_day(S.file_block_hashes, changed))
    counts = checked.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(~F.col("ok") & ~F.col("absent")).alias("n_changed"),
                         F.count_if("absent").alias("n_absent"), F.bool_and("ok").alias("verified"))
    named = blocks.join(after.select("name").distinct(), "name").agg(F.countDistinct("name").alias("n_changed_by_block"))
    one = named.first()["n_changed_by_block"]
    return counts.select("n_files", "n_changed", "n_absent", F.lit(one).alias("n_changed_by_block"), "verified")
