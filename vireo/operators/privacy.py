"""Privacy, audit and retention jobs.

All text work is column expressions (``rlike``, ``regexp_extract_all``,
``regexp_replace``) over whole texts; field-name rules are applied by
walking the schema once on the driver and emitting one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo import config as C
from vireo.functions.expr import has_pii, pii_match_count, pii_redact, pseudonymize
from vireo.functions.stats import ordered_prefix_sums
from vireo.sources.tables import path_exists


def _q(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


# S1 ------------------------------------------------------------------------
def pii_scan(df: DataFrame, cols: list[str], by: list[str] | None = None,
             patterns=C.PII_PATTERNS) -> DataFrame:
    """Census per (group, column, pattern): rows with a match and match count.

    Each text is scanned once per pattern (the match count is projected
    first, then aggregated with partial aggregation per group)."""
    by = list(by or [])
    keys, counts = [], []
    for c in cols:
        for name, pat in patterns:
            counts.append(pii_match_count(F.col(_q(c)), pat).alias(f"__m{len(keys)}"))
            keys.append((c, name))
    m = df.select(*by, *counts)
    aggs = []
    for k in range(len(keys)):
        aggs += [F.count_if(F.col(f"__m{k}") > 0).alias(f"__r{k}"), F.sum(f"__m{k}").alias(f"__s{k}")]
    a = m.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(p).alias("pattern"),
                              F.col(f"__r{k}").alias("rows_matched"),
                              F.coalesce(F.col(f"__s{k}"), F.lit(0)).cast("bigint").alias("n_matches"))
                     for k, (c, p) in enumerate(keys)])
    return a.select(*by, "n_rows", F.inline(rows))


# S2 ------------------------------------------------------------------------
def redact_columns(df: DataFrame, cols: list[str], replacement: str = C.REDACTED) -> DataFrame:
    return df.select(*[pii_redact(F.col(_q(c)), replacement=replacement).alias(c) if c in cols else F.col(_q(c))
                       for c in df.columns])


# S3 ------------------------------------------------------------------------
def _sanitize_field(col: Column, dtype: T.DataType, redact_fields: bool, safe_only: bool,
                    pii: set[str], safe: set[str]) -> Column | None:
    if isinstance(dtype, T.StructType):
        parts = []
        for f in dtype.fields:
            low = f.name.lower()
            if safe_only and low not in safe:
                continue
            if redact_fields and low in pii:
                parts.append(F.lit(C.REDACTED).alias(f.name))
                continue
            e = _sanitize_field(col[f.name], f.dataType, redact_fields, safe_only, pii, safe)
            parts.append(e.alias(f.name))
        return F.struct(*parts) if parts else F.lit(None)
    if isinstance(dtype, T.StringType):
        return F.when(has_pii(col), pii_redact(col)).otherwise(col)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _sanitize_field(x, dtype.elementType, redact_fields, safe_only, pii, safe))
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        named = lambda k, names: F.lower(k).isin(sorted(names))
        if safe_only:
            col = F.map_filter(col, lambda k, v: named(k, safe))
        return F.transform_values(col, lambda k, v: _sanitize_value(k, v, dtype.valueType, redact_fields, safe_only, pii, safe, named))
    return col


def _sanitize_value(k: Column, v: Column, dtype: T.DataType, redact_fields: bool, safe_only: bool, pii: set[str], safe: set[str],
                    named) -> Column:
    """A map value: redacted by its key's name, else like any field.  A value
    that isn't text can't hold the mark and becomes null."""
    inner = _sanitize_field(v, dtype, redact_fields, safe_only, pii, safe)
    if not redact_fields:
        return inner
    mark = F.lit(C.REDACTED) if isinstance(dtype, T.StringType) else F.lit(None).cast(dtype)
    return F.when(named(k, pii), mark).otherwise(inner)


def sanitize(df: DataFrame, redact_fields: bool = True, safe_only: bool = False,
             pii: list[str] = C.PII_FIELDS, safe: list[str] = C.SAFE_FIELDS) -> DataFrame:
    """PII-named fields -> ``[REDACTED]`` (at any depth); strings with
    personal data are redacted; ``safe_only`` keeps only allow-listed names."""
    pset, sset = {p.lower() for p in pii}, {s.lower() for s in safe}
    out = []
    for f in df.schema.fields:
        low = f.name.lower()
        if safe_only and low not in sset:
            continue
        if redact_fields and low in pset:
            out.append(F.lit(C.REDACTED).alias(f.name))
            continue
        out.append(_sanitize_field(F.col(_q(f.name)), f.dataType, redact_fields, safe_only, pset, sset)
                   .alias(f.name))
    return df.select(*out)


# S4 ------------------------------------------------------------------------
def safe_aggregate_view(df: DataFrame, allowed: list[str] = C.SAFE_FIELDS, max_len: int = 50) -> DataFrame:
    """Allow-listed columns only; text kept only without personal data and
    shorter than ``max_len`` (else null)."""
    allow = {a.lower() for a in allowed}
    out = []
    for f in df.schema.fields:
        if f.name.lower() not in allow:
            continue
        c = F.col(_q(f.name))
        if isinstance(f.dataType, T.StringType):
            c = F.when(~has_pii(c) & (F.length(c) < max_len), c)
        elif not isinstance(f.dataType, T.NumericType):
            continue
        out.append(c.alias(f.name))
    return df.select(*out)


# S5 ------------------------------------------------------------------------
def pseudonymize_columns(df: DataFrame, cols: list[str], salt: str = "") -> DataFrame:
    return df.select(*[pseudonymize(F.col(_q(c)), salt).alias(c) if c in cols else F.col(_q(c))
                       for c in df.columns])


# S6 ------------------------------------------------------------------------
def row_fingerprint(df: DataFrame, cols: list[str] | None = None, length: int = 16) -> Column:
    """sha256 over ``name=value`` pairs in name order (our canonical form)."""
    cols = sorted(cols or df.columns)
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(_q(c)).cast("string"), F.lit("null"))) for c in cols]
    return F.substring(F.sha2(F.concat_ws(",", *parts), 256), 1, length)


def audit_records(log: DataFrame, request: str, inputs: list[str], probability: str, latency: str, success: Column,
                  version: str, ts: str | None = None) -> DataFrame:
    """One audit record per prediction, without personal data: the hash of its
    inputs and how many they are, the rounded probability, the model version,
    the rounded latency and whether it succeeded."""
    return log.select(*([F.col(ts).alias("timestamp")] if ts else []), F.col(request).alias("request_id"),
                      row_fingerprint(log, inputs).alias("input_hash"), F.lit(len(inputs)).alias("field_count"),
                      F.round(probability, 6).alias("probability"), F.lit(version).alias("model_version"),
                      F.round(latency, 2).alias("latency_ms"), success.alias("success"))


# S7 ------------------------------------------------------------------------
def drop_pii_fields(df: DataFrame, allowed: list[str] | None = None, pii: list[str] = C.PII_FIELDS) -> DataFrame:
    """Case-insensitive drop of PII-named columns, then an optional allow-list."""
    pset = {p.lower() for p in pii}
    keep = [c for c in df.columns if c.lower() not in pset]
    if allowed is not None:
        aset = {a.lower() for a in allowed}
        keep = [c for c in keep if c.lower() in aset]
    return df.select(*[_q(c) for c in keep])


def drop_pii_keys(map_col, pii: list[str] = C.PII_FIELDS) -> Column:
    """The same rule for a JSON feature map."""
    pset = [p.lower() for p in pii]
    return F.map_filter(map_col, lambda k, v: ~F.lower(k).isin(pset))


# S8 ------------------------------------------------------------------------
def parse_ts(col, strip_offset: bool = False) -> Column:
    """ISO timestamps to UTC; ``strip_offset`` drops the offset instead of
    converting (the original rule).  Unparseable -> null."""
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    if strip_offset:
        s = F.regexp_replace(s, r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.coalesce(F.try_to_timestamp(s), F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")))


def retention_report(df: DataFrame, ts: str, as_of: str, days: int, by: list[str] | None = None,
                     strip_offset: bool = False) -> DataFrame:
    """Counts per target: total, removed (ts before the cutoff), retained.
    Rows whose timestamp is missing or unparseable are kept."""
    by = list(by or [])
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    t = parse_ts(ts, strip_offset) if not isinstance(df.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType)) \
        else F.col(ts).cast("timestamp")
    old = t.isNotNull() & (t < cutoff)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(old).alias("removed"),
                               F.count_if(~old).alias("retained"))


def retained_rows(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """The rows a retention run keeps (to be written to a new location)."""
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    t = F.col(ts).cast("timestamp")
    return df.where(t.isNull() | (t >= cutoff))


def run_retention(spark, store: str, as_of: str, days: int, ts: str = "ts", dt: str = "dt",
                  dry_run: bool = True) -> DataFrame:
    """S8 over a store partitioned by date: one row per partition with its
    rows (total, removed, retained) and what is done with it.

    A partition whose rows are all older than the cutoff is dropped as a
    folder; one that the cutoff cuts through is rewritten; all others stay
    untouched.  Rows without a time stay.  Nothing changes unless
    ``dry_run=False``.  The plan holds one row per partition, so it is bounded
    by the calendar.

    A run that fails is finished by the next one.  Beside the store it first
    writes the rows to keep of the partitions it will rewrite, then the plan;
    only then does it change the store, by steps that may be repeated, and
    at last it removes both.  A run that finds such a plan carries it out before
    its own; rows written without a plan are from a run that changed nothing."""
    if not dry_run:
        _finish_retention(spark, store, dt)
    df = spark.read.option("basePath", store).parquet(store)
    rep = retention_report(df, ts, as_of, days, [dt])
    rep = rep.withColumn("action", F.when(F.col("removed") == 0, "keep").when(F.col("retained") == 0, "drop").otherwise("rewrite"))
    plan = spark.createDataFrame([tuple(r) for r in rep.orderBy(dt).collect()], rep.schema)
    if not dry_run:
        kept = retained_rows(df.join(F.broadcast(plan.where("action = 'rewrite'").select(dt)), dt, "left_semi"), ts, as_of, days)
        _stage_retained(kept, store, dt)
        _record_plan(plan, store)
        _finish_retention(spark, store, dt)
    return plan


def _beside(store: str, name: str) -> str:
    return f"{store.rstrip('/')}__retention/{name}"


def _stage_retained(kept: DataFrame, store: str, dt: str) -> None:
    kept.repartition(dt).write.mode("overwrite").partitionBy(dt).parquet(_beside(store, "retained"))


def _record_plan(plan: DataFrame, store: str) -> None:
    plan.coalesce(1).write.mode("overwrite").parquet(_beside(store, "plan"))


def _finish_retention(spark, store: str, dt: str) -> None:
    """Carry out the recorded plan, if there is one (written whole)."""
    if path_exists(spark, _beside(store, "plan") + "/_SUCCESS"):
        rows = spark.read.parquet(_beside(store, "plan")).select(dt, "action").collect()
        if any(r["action"] == "rewrite" for r in rows):
            _swap(spark, store, dt)
        _drop_folders(spark, store, dt, [r[dt] for r in rows if r["action"] == "drop"])
        _delete(spark, _beside(store, "plan"))
    _delete(spark, _beside(store, "").rstrip("/"))


def _swap(spark, store: str, dt: str) -> None:
    """Put the rows to keep in the place of their partitions."""
    staged = _beside(store, "retained")
    (spark.read.option("basePath", staged).parquet(staged)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(dt).parquet(store))


def _drop_folders(spark, store: str, dt: str, values: list) -> None:
    for v in values:
        _delete(spark, f"{store.rstrip('/')}/{dt}={v}")


def _delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# S9 / S10 ------------------------------------------------------------------
def rows_by_file_age(df: DataFrame, as_of, days: int = 0) -> DataFrame:
    """Rows in files last written before the cutoff and in newer ones (report
    only); ``df`` is read from files and not transformed further."""
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    return (df.select((F.col("_metadata.file_modification_time") < cutoff).alias("expired"))
            .groupBy("expired").agg(F.count(F.lit(1)).alias("n_rows")))


def file_hashes(spark, path: str) -> DataFrame:
    """(path, name, sha256, length) per file, computed by the executors that read
    it (a file is one value there: at most 2 GB; larger ones by ``file_block_hashes``)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), "length")


def _digest_sum(bits_of):
    """A sum of 60 bits of an MD5 per row: rows combine before the shuffle, in any order."""
    return F.sum(F.conv(F.substring(F.md5(bits_of), 1, 15), 16, 10).cast("decimal(38,0)"))


def content_hashes(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """(name, sha256) per value of column ``name``: the digest of the rows in
    it whatever their order or their files, of any size.  Every row gives 60
    bits of the MD5 of its values as text, each with its length before it
    (so that no two rows read alike) and nulls marked; their sum and the
    number of rows are hashed, so rows combine before the shuffle."""
    texts = [F.col(_q(c)).cast("string") for c in cols]
    row = F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])
    g = df.groupBy(F.col(_q(name)).cast("string").alias("name")).agg(_digest_sum(row).alias("s"), F.count(F.lit(1)).alias("n"))
    return g.select("name", F.sha2(F.concat_ws(":", F.col("s").cast("string"), F.col("n").cast("string")), 256).alias("sha256"))


#: bytes of a block of the hash tree
HASH_BLOCK = 128 << 20


def file_block_hashes(spark, path: str, block_bytes: int = HASH_BLOCK) -> DataFrame:
    """(path, name, block, sha256) for files of any size and kind: a digest of every
    block of about ``block_bytes``.

    The files are read in byte ranges by all tasks, as pieces that end at a
    newline byte (no byte is changed or lost).  A running sum over the ranges
    gives each piece its offset in the file; it belongs to the block in which
    it begins, and enters that block's digest with its offset.  So blocks do
    not depend on how the ranges were cut.  Only a piece of 2 GB without a
    newline byte cannot be read."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"),
                        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("i"),
                        (F.octet_length("value") + 1).cast("bigint").alias("bytes"), F.md5(F.col("value").cast("binary")).alias("h"))
    placed = ordered_prefix_sums(pieces, ["path"], "i", ["bytes"], F.col("range"))
    g = (placed.groupBy("path", "size", F.floor(F.col("bytes_cum") / F.lit(block_bytes)).alias("block"))
         .agg(_digest_sum(F.concat_ws(":", "bytes_cum", "h")).alias("s"), F.sum("bytes").alias("n")))
    digest = F.sha2(F.concat_ws(":", F.col("s").cast("string"), "n", "size"), 256)
    return g.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "block", digest.alias("sha256"))


def file_tree_hashes(blocks: DataFrame) -> DataFrame:
    """(name, sha256, n_blocks): the root over the block digests of a file."""
    parts = F.array_sort(F.collect_list(F.struct("block", "sha256")))
    return blocks.groupBy("name").agg(F.sha2(F.array_join(F.transform(parts, lambda x: x["sha256"]), ""), 256).alias("sha256"),
                                      F.count(F.lit(1)).alias("n_blocks"))


def changed_blocks(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, block) of the blocks that differ, are missing or were added."""
    a = expected.select("name", "block", F.col("sha256").alias("e"))
    b = actual.select("name", "block", F.col("sha256").alias("a"))
    return a.join(b, ["name", "block"], "full").where(~F.col("e").eqNullSafe(F.col("a"))).select("name", "block")
