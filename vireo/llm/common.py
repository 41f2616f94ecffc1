"""Helpers shared by the operators of this subpackage: staged tables in the
shared folder, connected components, and hashed word sequences."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.session import ensure_checkpoint_dir

#: The white space that separates words and that exact comparison ignores.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (as ``--py-files`` would), unless
    their path has it.  Once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_vireo_shipped", False) or _PACKAGE_ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = os.path.basename(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    # built beside the driver, from which every executor fetches it
    tmp = tempfile.mkdtemp(prefix=f"{name}-package-")
    atexit.register(shutil.rmtree, tmp, ignore_errors=True)
    src = os.path.join(tmp, "src")
    shutil.copytree(os.path.join(_PACKAGE_ROOT, name), os.path.join(src, name), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(tmp, f"{name}_package"), "zip", src))
    sc._vireo_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vireo-llm/{uuid.uuid4().hex}/{name}"


#: Spark 4.1: shuffle files go when the query that wrote them has ended
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write Parquet and let the shuffle files of the write go with it."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        w = df.write.mode("overwrite")
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage
    and survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table by alternating large
    and small stars: (id, component) for every node with an edge to another,
    ``component`` the smallest id reachable.  Rows with a null or equal ends
    are ignored.  Every round is two pre-aggregated minima and two joins over
    at most as many edges as before; the rounds grow with the logarithm of
    the longest path."""
    e = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .where("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stage(small, "stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            ends = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return ends.unionByName(ends.select(F.col("component").alias("id"), "component").distinct())
        mark = now


def keep_one(docs: DataFrame, keys: dict, members: DataFrame) -> DataFrame:
    """``docs`` with one row of every group, all columns.

    ``members`` has a row per row of ``docs``: the columns named in ``keys``
    (which give them for ``docs``; rows alike in all of them are copies),
    ``grp`` (null: the row stays) and ``rank``; the lowest rank of a group
    stays.  Only the keys of rows that go, and of copies among those that
    stay, are joined with ``docs``; copies meet after a partial aggregation."""
    names = list(keys)
    grouped = members.where("grp IS NOT NULL").groupBy("grp", "rank", *names).agg(F.count("*").alias("n"))
    best = grouped.groupBy(F.col("grp").alias("g")).agg(F.min("rank").alias("best"))
    status = stage(grouped.join(best, F.col("grp") == F.col("g"))
                   .select(*names, (F.col("rank") == F.col("best")).alias("stays"), "n").where("n > 1 OR NOT stays"), "copies")
    marked = docs.select("*", *[c.alias(f"__{n}") for n, c in keys.items()])

    def same(table):
        cond = None
        for n in names:
            c = marked[f"__{n}"].eqNullSafe(table[n])
            cond = c if cond is None else cond & c
        return cond

    gone, copies = status.where("NOT stays").distinct(), status.where("stays").distinct()
    left = marked.join(gone, same(gone), "left_anti")
    single, several = left.join(copies, same(copies), "left_anti"), left.join(copies, same(copies), "left_semi")
    return single.unionByName(several.dropDuplicates([f"__{n}" for n in names])).select(*[F.col(f"`{c}`") for c in docs.columns])


# --- hashed word sequences (numpy, inside tasks) ---------------------------

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (xor-shift and multiply rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: bytes hashed at once; bounds the memory of the byte-level arrays
CHUNK_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=_U)
    p[0] = 1
    return np.multiply.accumulate(p)


class WordHasher:
    """64-bit hashes of the words of UTF-8 texts; words are split at ASCII
    white space, A-Z optionally lower-cased."""

    def __init__(self, lower: bool = False):
        self.code = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
        if lower:
            self.code[65:91] = self.code[97:123]
        self.space = np.zeros(256, dtype=bool)
        self.space[list(SPACE_BYTES)] = True
        self.code[self.space] = 0
        self.up = self.down = np.zeros(0, dtype=_U)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, CHUNK_BYTES + 1)
            self.up, self.down = _powers(_BASE, n), _powers(_BASE_INV, n)

    def _chunk(self, data: bytes):
        a = np.frombuffer(data, dtype=np.uint8)
        edge = np.empty(len(a) + 2, dtype=bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = self.space[a]
        step = np.diff(edge.view(np.int8))
        start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        self._grow(len(a) + 1)
        run = np.zeros(len(a) + 1, dtype=_U)
        np.cumsum(self.code[a] * self.up[: len(a)], out=run[1:])
        h = (run[end] - run[start]) * self.down[start]
        return mix(h ^ (end - start).astype(_U)), start, end

    def words(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, words per text); None counts as empty."""
        out, counts = [], []
        group, size = [], 0

        def flush():
            data = b"\n".join(group)
            h, start, _ = self._chunk(data)
            ends = np.cumsum([len(x) + 1 for x in group])
            counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
            out.append(h)

        for t in texts:
            x = t.encode("utf-8", "surrogatepass") if t else b""
            group.append(x)
            size += len(x) + 1
            if size >= CHUNK_BYTES:
                flush()
                group, size = [], 0
        if group:
            flush()
        if not out:
            return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
        return np.concatenate(out), np.concatenate(counts).astype(np.int64)


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes (across texts:
    the caller drops runs that leave a text)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    up, down = _powers(_BASE, len(h) + 1), _powers(_BASE_INV, len(h) + 1)
    run = np.zeros(len(h) + 1, dtype=_U)
    np.cumsum(h * up[: len(h)], out=run[1:])
    return mix((run[width:] - run[:n]) * down[:n] + _U(width))


def split_buckets(h: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (bucket, 32-bit fingerprint) codes of hashes, sorted, and the
    start of every bucket in them."""
    code = ((h >> _U(32)) % _U(n_buckets)) << _U(32) | (h & _U(0xFFFFFFFF))
    code = np.unique(code)
    return code, np.searchsorted(code, np.arange(n_buckets + 1, dtype=_U) << _U(32))


def bucket_codes(h: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((h >> _U(32)) % _U(n_buckets)) << _U(32) | (h & _U(0xFFFFFFFF))


def batch_plan(docs: DataFrame, chars: int, column: str = "text") -> int:
    """Number of batches so that one holds about ``chars`` characters."""
    total = docs.agg(F.sum(F.length(column).cast("long"))).first()[0] or 0
    return max(1, -(-total // chars))
