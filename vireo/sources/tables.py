"""Sources and sinks (IO1-IO9).

All readers return lazy DataFrames; all writers are partitioned appends or
overwrites.  Nothing is read through the driver.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("label", T.IntegerType()),
])


def _suffix(path: str) -> str:
    p = path.rstrip("/").lower()
    for s in (".parquet", ".csv", ".jsonl", ".json"):
        if p.endswith(s):
            return s
    return ""


# IO1 ---------------------------------------------------------------------
def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None, infer: bool = True) -> DataFrame:
    """Parquet or CSV by suffix (or ``fmt`` for suffix-less folders);
    anything else raises ``ValueError``.  A CSV without a schema is read twice
    to infer one, or once as text with ``infer=False``."""
    s = f".{fmt}" if fmt else _suffix(path)
    if s == ".parquet":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    if s == ".csv":
        r = spark.read.option("header", "true")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", str(infer).lower())
        return r.csv(path)
    raise ValueError(f"unsupported table format: {path}")


# IO2 ---------------------------------------------------------------------
def read_snapshots(spark: SparkSession, paths: dict[int, str], period_col: str = "ano",
                   normalize=None, fmt: str | None = None, infer: bool = True) -> DataFrame:
    """One table per period, unioned by name into one long table.

    ``normalize`` (e.g. ``normalize_columns``) runs per snapshot before the
    union so that the differently named yearly columns line up.
    """
    out = None
    for year, path in sorted(paths.items()):
        df = read_table(spark, path, fmt=fmt, infer=infer)
        if normalize is not None:
            df = normalize(df)
        df = df.withColumn(period_col, F.lit(int(year)))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no snapshots given")
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, URI or glob matches anything in its own file system."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


# IO3 ---------------------------------------------------------------------
def read_labels(spark: SparkSession, path: str | None, schema: T.StructType = LABEL_SCHEMA) -> DataFrame:
    """Labels from Parquet / CSV / JSONL; absent path or unknown suffix -> empty.

    ``path`` may be a URI or a glob; it is looked up in its own file system,
    and every failure but "not found" is raised."""
    if not path or not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    s = _suffix(path)
    if s == ".parquet":
        return spark.read.schema(schema).parquet(path)
    if s == ".csv":
        return spark.read.option("header", "true").schema(schema).csv(path)
    if s in (".jsonl", ".json"):
        return spark.read.schema(schema).json(path)
    return spark.createDataFrame([], schema)


# IO4 ---------------------------------------------------------------------
def read_events(spark: SparkSession, store: str, start=None, end=None, limit: int | None = None,
                ts_col: str = "ts", fmt: str = "parquet", strict: bool = True) -> DataFrame:
    """Events from one table partitioned by ``dt`` (yyyy-MM-dd).

    The date range is a filter on the partition column, so Spark prunes
    whole directories.  An unreadable file raises; with ``strict=False`` the
    unreadable files of this read alone are skipped, and ``unread_files`` names
    them.  ``limit`` keeps the earliest rows by timestamp, which is
    deterministic, unlike file order.  A CSV store has the types that
    inference finds over all its files.
    """
    skip = "false" if strict else "true"
    # the schema then comes from all footers, as the first one may be a broken file's
    r = spark.read.option("basePath", store).option("ignoreCorruptFiles", skip).option("mergeSchema", skip)
    if fmt == "both":
        # a store holding Parquet and CSV files side by side: read each by its
        # own reader (glob per format) and union by name
        pq = r.parquet(f"{store}/*/*.parquet")
        cs = spark.read.option("basePath", store).option("ignoreCorruptFiles", skip).option("header", "true").schema(pq.schema) \
            .csv(f"{store}/*/*.csv")
        df = pq.unionByName(cs)
    else:
        df = r.parquet(store) if fmt == "parquet" else r.option("header", "true").option("inferSchema", "true").csv(store)
    if start is not None:
        df = df.where(F.col("dt") >= F.to_date(F.lit(str(start)[:10])))
    if end is not None:
        df = df.where(F.col("dt") <= F.to_date(F.lit(str(end)[:10])))
    if limit is not None:
        df = df.orderBy(ts_col).limit(limit)
    return df


def unread_files(spark: SparkSession, store: str) -> DataFrame:
    """(path, length) of the Parquet files of a store that give no row: those that
    cannot be read, and empty ones.  Only listings and footers are read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(store)
             .select("path", "length"))
    read = (spark.read.option("basePath", store).option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(store)
            .select(F.col("_metadata.file_path").alias("path")).distinct())
    return files.join(read, "path", "left_anti")


# IO5 ---------------------------------------------------------------------
def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, limit: int | None = None,
               ts_col: str | None = None) -> DataFrame:
    """Tolerant JSONL: bad lines are dropped; recency is by timestamp."""
    corrupt = "_corrupt_record"
    full = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    df = (spark.read.schema(full).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", corrupt).json(path))
    df = df.where(F.col(corrupt).isNull()).drop(corrupt)
    if limit is not None and ts_col:
        df = df.orderBy(F.col(ts_col).desc()).limit(limit)
    return df


def parse_json_map(col, value_type: str = "double"):
    """A JSON object column as ``map<string, value_type>``; bad JSON -> empty map."""
    return F.coalesce(F.from_json(col, f"map<string,{value_type}>"),
                      F.create_map().cast(f"map<string,{value_type}>"))


# IO6 ---------------------------------------------------------------------
def write_snapshots(df: DataFrame, path: str, period_col: str = "ano", mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(period_col).parquet(path)


# IO7 ---------------------------------------------------------------------
def append_events(df: DataFrame, path: str, ts_col: str = "ts", fmt: str = "parquet",
                  first_record_date: bool = False) -> None:
    """Append; each row lands in the partition of its own date.

    ``first_record_date`` reproduces the original rule (the whole batch goes
    to the date of its earliest record), which misfiles batches that cross
    midnight."""
    if first_record_date:
        first = df.agg(F.min(F.to_date(F.col(ts_col)))).first()[0]
        dt = F.lit(first).cast("date")
    else:
        dt = F.to_date(F.col(ts_col))
    w = df.withColumn("dt", dt).write.mode("append").partitionBy("dt")
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("header", "true").csv(path)


# IO8 ---------------------------------------------------------------------
def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


# IO9 ---------------------------------------------------------------------
def write_report_tables(tables: dict[str, DataFrame], base: str, json_copy: bool = False) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        if json_copy:
            df.write.mode("overwrite").json(f"{base}/{name}_json")
