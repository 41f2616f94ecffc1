"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Centres are fitted by spherical k-means on a bounded sample; every vector is
assigned to its nearest centre, and also compared as a guest in cells whose
border it is near.  Two unit vectors with cosine t are at most d = sqrt(2 - 2t)
apart, so of a pair x, y in cells i, j the distances to the border between them,
(x.c_i - x.c_j) / |c_i - c_j| and (y.c_j - y.c_i) / |c_i - c_j|, add up to at most d,
and one of them is at most d / 2.  Each vector is therefore a guest in every cell
whose border is within d / 2, and no link is lost; a pair in which each is the
other's guest counts in the lower cell.  Equal vectors are one row with a
multiplicity; rows travel in packed chunks; cells above the block size are cut
into blocks joined pairwise by matrix products.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import components, keep_one, ship_package, stage

COSINE = 0.95
#: vectors the centres are fitted on (bounded), their number, and the iterations
FIT_ROWS = 20_000
VECTORS_PER_CELL = 2048
MAX_CELLS = 1024
FIT_ROUNDS = 8
BLOCK_ROWS = 16_384
#: None searches all of d, which loses no link; a number, that many times d / sqrt(dimensions)
MARGIN = None
#: rows placed, and rows multiplied, at once
PLACE_ROWS = 500
PRODUCT_ROWS = 512
LINKS = "key long, n_links long, label long"
#: rows of one cell, all at home or all guests: their first key and number, the
#: keys, multiplicities, own cells and components, and (at home) where each is a guest
CHUNKS = "first long, n long, cell long, home boolean, keys binary, ms binary, owns binary, vs binary, guests binary"


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = FIT_ROUNDS, seed: int = 7) -> np.ndarray:
    """k unit centres of unit vectors; an empty cell keeps its centre."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-12, total / np.maximum(norm, 1e-12)[:, None], c)
    return c


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector_hash, v): vectors in double precision, scaled to length 1; ``v`` is
    null for vectors that are null, empty, zero or hold a null or non-finite component."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    top = F.array_max(F.transform(v, lambda e: F.abs(e)))
    # scaled by the largest component first, so that squares neither overflow nor vanish
    scaled = F.transform(v, lambda e: e / top)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.xxhash64(F.col(vector_col)).alias("vector_hash"),
                          F.when(v.isNotNull() & (F.size(v) > 0) & ~bad & (top > 0), scaled).alias("s"))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda a, e: a + e * e))
    return rows.select("vec_id", "vector_hash", F.transform("s", lambda e: e / norm).alias("v"))


def fit_centres(units: DataFrame, fit_rows: int = FIT_ROWS, per_cell: int = VECTORS_PER_CELL, max_cells: int = MAX_CELLS) -> np.ndarray | None:
    """Centres from the ``fit_rows`` vectors with the smallest hashes (a bounded,
    repeatable sample); None without vectors.  Vectors of another length than
    the commonest one are compared only with their like."""
    n = units.count()
    if not n:
        return None
    sample = units.orderBy(F.xxhash64("v"), "v").limit(fit_rows).toPandas()["v"]
    width = sample.map(len).mode().iloc[0]
    x = np.array([v for v in sample if len(v) == width])
    return spherical_kmeans(x, max(1, min(max_cells, -(-n // per_cell), len(x))))


def assign_cells(rows: DataFrame, centres: np.ndarray, cosine: float, margin: float | None = MARGIN) -> DataFrame:
    """Chunks (see ``CHUNKS``) of the rows in their nearest cells and, as guests,
    in each other cell whose border is within half the reach."""
    ship_package(rows.sparkSession)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    if margin is not None:
        reach *= min(1.0, margin / math.sqrt(centres.shape[1]))
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T)))

    def chunk(key, m, own, x, cell, home, guests=None):
        return (int(key[0]), len(key), int(cell), home, key.tobytes(), m.tobytes(), own.tobytes(), x.tobytes(),
                None if guests is None else np.packbits(guests, axis=1).tobytes())

    def cells(frames):
        for f in (g.iloc[at:at + PLACE_ROWS] for g in frames for at in range(0, len(g), PLACE_ROWS)):
            out = []
            width = f["v"].map(len)
            for w, part in f.groupby(width):
                key, m = part["key"].to_numpy(dtype=np.int64), part["m"].to_numpy(dtype=np.int64)
                x = np.stack(part["v"].to_numpy())
                if w != centres.shape[1]:  # vectors of another length: a cell per length
                    out.append(chunk(key, m, np.full(len(key), -w, dtype=np.int64), x, -w, True))
                    continue
                dots = x @ centres.T
                own = dots.argmax(axis=1)
                gap = dots[np.arange(len(x)), own][:, None] - dots
                guest = 2 * gap <= reach * apart[own] + 1e-9
                guest[np.arange(len(x)), own] = False
                for cell in np.unique(own):
                    at = own == cell
                    out.append(chunk(key[at], m[at], own[at], x[at], cell, True, guest[at]))
                for cell in np.flatnonzero(guest.any(axis=0)):
                    at = guest[:, cell]
                    out.append(chunk(key[at], m[at], own[at], x[at], cell, False))
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in CHUNKS.split(", ")])

    return rows.mapInPandas(cells, CHUNKS)


def _join_block(f: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between the rows of two sides (or of one), by products of
    ``PRODUCT_ROWS`` rows at a time.  Two guests are not compared here: they
    meet in a cell where one of them is at home."""
    cell, i, j = (int(f[c].iloc[0]) for c in ("cell", "i", "j"))
    key, many, own = (np.concatenate([np.frombuffer(b, dtype=np.int64) for b in f[c]]) for c in ("keys", "ms", "owns"))
    order = np.argsort(key)
    key, many, own = key[order], many[order], own[order]
    x = np.concatenate([np.frombuffer(b, dtype=np.float64) for b in f["vs"]]).reshape(len(key), -1)[order]
    home, side = np.repeat(f["home"].to_numpy(dtype=bool), f["n"])[order], np.repeat(f["side"].to_numpy(), f["n"])[order]
    # bits of the cells where a row at home is a guest
    bits = [None if b is None else np.frombuffer(b, dtype=np.uint8).reshape(n, -1) for b, n in zip(f["guests"], f["n"])]
    wide = max((b.shape[1] for b in bits if b is not None), default=1)
    bits = np.concatenate([np.zeros((n, wide), dtype=np.uint8) if b is None else b for b, n in zip(bits, f["n"])])[order]
    links = np.zeros(len(key), dtype=np.int64)
    label = np.arange(len(key))
    at_i, at_j = side == i, side == j
    hits = []

    def join(a, b, guests):
        if not len(a) or not len(b):
            return
        other = x[b].T
        for at in range(0, len(a), PRODUCT_ROWS):
            part = a[at:at + PRODUCT_ROWS]
            hit = x[part] @ other >= cosine
            if not hit.any():
                continue
            p, q = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            hit, p, q = hit[np.ix_(p, q)], part[p], b[q]
            if guests:  # each the other's guest: counts in the lower cell
                mutual = (bits[q][:, own[p] >> 3] >> (7 - (own[p] & 7)).astype(np.uint8)) & 1
                hit &= (mutual.T == 0) | (cell < own[p])[:, None]
            hit &= p[:, None] != q[None, :]
            links[p] += hit @ many[q]
            if a is not b:
                links[q] += many[p] @ hit
            hits.append((p, q, np.packbits(hit, axis=1)))

    rows = np.flatnonzero
    if i == j:
        at_home = rows(home)
        join(at_home, at_home, False)
        join(rows(~home), at_home, True)
    else:
        join(rows(home & at_i), rows(home & at_j), False)
        join(rows(~home & at_i), rows(home & at_j), True)
        join(rows(~home & at_j), rows(home & at_i), True)
    changed = bool(hits)
    while changed:  # labels fall to the smallest row reachable inside the block
        before = label.copy()
        for p, q, packed in hits:
            hit = np.unpackbits(packed, axis=1, count=len(q)).astype(bool)
            label[p] = np.minimum(label[p], np.where(hit, label[q][None, :], len(key)).min(axis=1))
            label[q] = np.minimum(label[q], np.where(hit, label[p][:, None], len(key)).min(axis=0))
        changed = bool((label != before).any())
    some = links > 0
    return pd.DataFrame({"key": key[some], "n_links": links[some], "label": key[label[some]]})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 block_rows: int = BLOCK_ROWS, margin: float | None = MARGIN, **fit) -> DataFrame:
    """One row per vector: id, ``n_links`` (other rows at ``cosine`` or more),
    ``component_id`` (smallest id reachable, itself included) and ``kept``.

    Cosines are in double precision.  Null, empty and zero vectors and those
    with null or non-finite components link with nothing; equal vectors link
    with each other; vectors of different length never do.  Rows that repeat an
    id are rows of their own.  A row with a null id never names a component.  An
    empty table gives an empty result; other columns are ignored.
    """
    return _linked(vectors, id_col, vector_col, cosine, block_rows, margin, **fit).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id", "kept")


def _linked(vectors: DataFrame, id_col: str, vector_col: str, cosine: float = COSINE, block_rows: int = BLOCK_ROWS,
            margin: float | None = MARGIN, **fit) -> DataFrame:
    """The links of every row with ``vector_hash`` (of its vector as given) and
    the ``root`` of its component (null if the row can link with nothing)."""
    units = stage(unit_vectors(vectors, id_col, vector_col), "units")
    good = units.where("v IS NOT NULL")
    # equal vectors: one row with a multiplicity (pre-aggregated)
    same = stage(good.groupBy("v").agg(F.count("*").alias("m"), F.min("vec_id").alias("rep"))
                 .select("v", "m", "rep", F.monotonically_increasing_id().alias("key")), "distinct")
    centres = fit_centres(same, **fit)
    if centres is None:
        return units.select("vec_id", "vector_hash", F.lit(None).cast("long").alias("root"), F.lit(0).cast("long").alias("n_links"),
                            F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    placed = stage(assign_cells(same.select("key", "m", "v"), centres, cosine, margin), "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.sum("n") / block_rows).cast("int").alias("cuts"))
    sides = (placed.join(sizes, "cell").withColumn("side", F.pmod(F.xxhash64("first"), F.col("cuts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
             .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")))
    links = stage(sides.select("cell", "i", "j", "side", "n", "home", "keys", "ms", "owns", "vs", "guests").groupBy("cell", "i", "j")
                  .applyInPandas(lambda f: _join_block(f, cosine), LINKS), "links")
    counted = links.groupBy("key").agg(F.sum("n_links").alias("n"))
    roots = components(links.select(F.col("key").alias("a"), F.col("label").alias("b")))
    reps = same.select("key", "rep")
    lowest = roots.join(reps, F.col("id") == F.col("key")).groupBy("component").agg(F.min("rep").alias("low"))
    named = roots.join(lowest, "component").select(F.col("id").alias("key"), "low", F.col("component").alias("root"))
    per = (same.join(named, "key", "left").join(counted, "key", "left")
           .select(F.col("v").alias("v2"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("low", "rep").alias("low"),
                   F.coalesce("root", "key").alias("root")))
    return (units.join(per, F.col("v") == F.col("v2"), "left")
            .select("vec_id", "vector_hash", "root", F.coalesce("links", F.lit(0)).alias("n_links"),
                    F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("low")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **kw) -> DataFrame:
    """The rows of ``vectors`` that stay, with all their columns: of each
    component the smallest id (null ids last), once if equal rows repeat it.
    Rows are told apart by id and vector; those that link with nothing stay."""
    rank = F.struct(F.col("vec_id").isNull().alias("n"), "vec_id", "vector_hash")
    members = _linked(vectors, id_col, vector_col, **kw).select(
        F.col("vec_id").alias("k_id"), F.col("vector_hash").alias("k_vector"), F.col("root").alias("grp"), rank.alias("rank"))
    return keep_one(vectors, {"k_id": F.col(id_col).cast("long"), "k_vector": F.xxhash64(F.col(vector_col))}, members)
