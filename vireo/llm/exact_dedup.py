"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their leading bytes, then by the next ones, until a
group has one member or its members have ended.  Every round is one
pre-aggregated count per (group, next bytes) and one join of the documents
still open with the groups that have several members, so equality is decided
by the bytes themselves, not by a digest.  The digits grow from round to round,
so a text of n bytes takes O(log n) rounds and its bytes are moved once.  A
group that holds a third of all rows is one row per task after the partial
aggregation; in the join Spark splits its rows (AQE skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import SPACE_CHARS, keep_one, scratch_path, write_table

FIRST_DIGIT = 64
GROWTH = 8
MAX_DIGIT = 1 << 20


def _digit(rest, width: int):
    return F.substring(rest, 1, width)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 first_digit: int = FIRST_DIGIT, growth: int = GROWTH, max_digit: int = MAX_DIGIT) -> DataFrame:
    """One row per input row: id, ``n_chars`` (code points of the text),
    ``text_sha256`` (of the normalised text), ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when identical without ASCII white space.  Null text counts
    as empty; all empty texts are one group.  The longest original text stays,
    ties go to the smallest id (a null id is the smallest); of rows that repeat id and length all
    carry the same ``keep_id`` and count in ``group_size``, and each is kept.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "radix")
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, SPACE_CHARS, "")
    open_rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.length(text).cast("long").alias("n_chars"), norm.alias("norm"))
                 .select("id", "n_chars", F.unhex(F.sha2("norm", 256)).alias("sha"),
                         F.lit(0).cast("long").alias("grp"), F.col("norm").cast("binary").alias("rest")))
    schema = "id long, n_chars long, sha binary, keep_id long, group_size long, grp long, rest binary, open boolean"
    width, level = first_digit, 0
    while True:
        digit = _digit(F.col("rest"), width)
        groups = (open_rows.groupBy("grp", digit.alias("digit"))
                  .agg(F.count("*").alias("n"), F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("id"))).alias("best"))
                  .where("n > 1"))
        # ids of the split groups are fixed by writing them
        groups = groups.select(F.col("grp").alias("g0"), F.col("digit").alias("d0"), "n", F.col("best.id").alias("best_id"),
                               F.monotonically_increasing_id().alias("new_grp"))
        write_table(groups, f"{base}/groups-{level}")
        groups = spark.read.schema(groups.schema).parquet(f"{base}/groups-{level}")
        ended = F.length("d0") < width
        rows = (open_rows.withColumn("digit", digit)
                # the same join at every size: groups grow with the rows and are never broadcast
                .join(groups.hint("merge"), (F.col("grp") == F.col("g0")) & (F.col("digit") == F.col("d0")), "left")
                .select("id", "n_chars", "sha",
                        F.when(F.col("n").isNull(), F.col("id")).when(ended, F.col("best_id")).alias("keep_id"),
                        F.when(F.col("n").isNull(), F.lit(1).cast("long")).when(ended, F.col("n")).alias("group_size"),
                        F.col("new_grp").alias("grp"),
                        F.when(F.col("n").isNotNull() & ~ended, F.expr(f"substring(rest, {width + 1}, 2147483647)")).alias("rest"),
                        (F.col("n").isNotNull() & ~ended).alias("open")))
        write_table(rows, f"{base}/rows/level={level}", "open")
        left = spark.read.schema(schema).parquet(f"{base}/rows/level={level}").where("open")
        level += 1
        if left.select("id").isEmpty():
            break
        open_rows = left.select("id", "n_chars", "sha", "grp", "rest")
        width = min(width * growth, max_digit)
    done = spark.read.schema(f"{schema}, level int").parquet(f"{base}/rows").where("NOT open")
    return done.select(F.col("id").alias(id_col), "n_chars", F.lower(F.hex("sha")).alias("text_sha256"), "keep_id", "group_size",
                       F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of every
    group, the longest text, then the smallest id (null first).  Rows are told
    apart by id, length and normalised text; equal ones are copies."""
    found = exact_groups(docs, id_col, text_col)
    rank = F.struct((-F.col("n_chars")).alias("c"), F.col(id_col).alias("id"))
    members = found.select(F.col(id_col).alias("k_id"), F.col("n_chars").alias("k_chars"), F.col("text_sha256").alias("k_sha"),
                           F.col("text_sha256").alias("grp"), rank.alias("rank"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return keep_one(docs, {"k_id": F.col(id_col).cast("long"), "k_chars": F.length(text).cast("long"),
                           "k_sha": F.sha2(F.translate(text, SPACE_CHARS, ""), 256)}, members)
