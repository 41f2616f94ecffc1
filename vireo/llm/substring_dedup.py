"""Removal of repeated passages, found by fixed-block anchors.

Every document is a reference and a probe.  As a reference it is cut into
non-overlapping blocks of ``block`` words; as a probe it offers the window at
every word.  A passage of ``window`` words holds at least one whole block
(window >= 2 * block - 1), so two places that share such a passage share an
anchor: a block that equals a window elsewhere.  Anchors are then extended:
the passages around them are compared as whole windows, and every word that a
repeated window covers belongs to a maximal exact repeat.

Documents are dealt to batches.  A batch sends each distinct fingerprint once,
however often it holds it, so a passage that a third of all documents share
is one entry per batch; a bucket of the fingerprint space answers with one bit
per entry.  Both rounds read the same shuffled batches (Spark reuses the
exchange); no fingerprint reaches the driver and nothing grows with the square
of a group.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import SPACE_CHARS, WordHasher, batch_plan, bucket_codes, rolling, ship_package

WINDOW = 35
BLOCK = 18
#: characters of text per batch, and batches' worth of fingerprints per bucket
BATCH_CHARS = 8_000_000
BATCHES_PER_BUCKET = 2

REQUEST = "batch int, bucket int, entries binary, flags binary"
REPLY = "batch int, bucket int, hits binary"


def _spans(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of each window of ``width`` words inside one text, word index in its text)."""
    first = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(doc)) - first[doc] if len(doc) else np.zeros(0, dtype=np.int64)
    inside = np.flatnonzero(at + width <= counts[doc]) if len(doc) else np.zeros(0, dtype=np.int64)
    return inside, at[inside]


def _pack(codes: np.ndarray, flags: np.ndarray, batch: int, n_buckets: int, wide: np.ndarray | None) -> pd.DataFrame:
    """One row per bucket that has entries.  codes are sorted (bucket, low bits)."""
    cut = np.searchsorted(codes, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
    keys = codes.astype("<u4") if wide is None else wide
    rows = [(batch, b, keys[cut[b]:cut[b + 1]].tobytes(), flags[cut[b]:cut[b + 1]].tobytes())
            for b in range(n_buckets) if cut[b + 1] > cut[b]]
    return pd.DataFrame(rows, columns=["batch", "bucket", "entries", "flags"])


def _answers(frame: pd.DataFrame, width: str, anchored: bool) -> pd.DataFrame:
    """For every entry: does it occur at another place too (and, for anchors,
    is one of its places a block)?  Flag bits: 1 occurs several times in its
    batch, 2 is a block there."""
    keys = [np.frombuffer(x, dtype=width) for x in frame["entries"]]
    flags = [np.frombuffer(x, dtype=np.uint8) for x in frame["flags"]]
    every, bits = np.concatenate(keys), np.concatenate(flags)
    order = np.argsort(every, kind="stable")
    s, f = every[order], bits[order]
    start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    size = np.diff(np.append(start, len(s)))
    any_bits = np.bitwise_or.reduceat(f, start)
    hit = (size > 1) | (any_bits & 1 > 0)
    if anchored:
        hit &= any_bits & 2 > 0
    back = np.empty(len(s), dtype=bool)
    back[order] = np.repeat(hit, size)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"batch": frame["batch"].astype("int32"), "bucket": frame["bucket"].astype("int32"),
                         "hits": [np.packbits(x).tobytes() for x in np.split(back, cuts)]})


class _Batch:
    """The hashed words of a batch's texts."""

    def __init__(self, texts: list, window: int, block: int):
        self.hashes, self.counts = WordHasher().words(texts)
        self.window, self.block = window, block

    def anchors(self, n_buckets: int):
        """(distinct codes, flags, code index of every rolling window, window starts)."""
        starts, at = _spans(self.counts, self.block)
        code = bucket_codes(rolling(self.hashes, self.block)[starts], n_buckets)
        codes, inverse, times = np.unique(code, return_inverse=True, return_counts=True)
        flags = (times > 1).astype(np.uint8)
        flags[inverse[at % self.block == 0]] |= 2
        return codes, flags, inverse, starts

    def candidates(self, hit_starts: np.ndarray):
        """Starts of the windows that hold a hit anchor, and their hashes."""
        starts, _ = _spans(self.counts, self.window)
        seen = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        seen[hit_starts + 1] = 1
        np.cumsum(seen, out=seen)
        held = seen[starts + self.window - self.block + 1] > seen[starts]
        starts = starts[held]
        return starts, rolling(self.hashes, self.window)[starts]


def _hits(replies: pd.DataFrame, codes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The answers to a batch's entries, in the order of its codes."""
    cut = np.searchsorted(codes, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
    out = np.zeros(len(codes), dtype=bool)
    for b, bits in zip(replies["bucket"].tolist(), replies["hits"].tolist()):
        n = cut[b + 1] - cut[b]
        out[cut[b]:cut[b + 1]] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)
    return out


def _wide_codes(h: np.ndarray, n_buckets: int):
    """Windows are told apart by all 64 bits: distinct hashes in bucket order."""
    values, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
    bucket = (values >> np.uint64(32)) % np.uint64(n_buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return values[order], bucket[order] << np.uint64(32), (times[order] > 1).astype(np.uint8), rank[inverse]


def _kept_words(text: str | None, removed: np.ndarray) -> str:
    words = (text or "").translate(_TO_SPACE).split(" ")
    words = [w for w in words if w]
    return " ".join(w for w, gone in zip(words, removed.tolist()) if not gone) if removed.any() else " ".join(words)


_TO_SPACE = {ord(c): " " for c in SPACE_CHARS}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK,
                   batch_chars: int = BATCH_CHARS, batches_per_bucket: int = BATCHES_PER_BUCKET) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_text``.

    A word goes if a window of ``window`` consecutive words of its document
    covers it whose words also start at another place, in any document or in
    the same one; all copies of a repeat go.  Windows are judged on the input.
    Words are kept apart by ASCII white space and joined by one space.  Null or
    empty text has no words and ``kept_text`` ''; texts shorter than a window
    stay whole; every row counts, also one that repeats an id; an empty table
    gives an empty result; other columns are ignored.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block: window >= 2 * block - 1")
    ship_package(docs.sparkSession)
    n_batches = batch_plan(docs, batch_chars, text_col)
    n_buckets = max(1, -(-n_batches // batches_per_bucket))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).cast("int"))

    def in_order(frame: pd.DataFrame) -> pd.DataFrame:
        # every round must see a batch in the same order
        return frame.sort_values(["doc_id", "text"], kind="stable", na_position="first")

    def offer(frame: pd.DataFrame) -> pd.DataFrame:
        codes, flags, _, _ = _Batch(in_order(frame)["text"].tolist(), window, block).anchors(n_buckets)
        return _pack(codes, flags, int(frame["batch"].iloc[0]), n_buckets, None)

    def extend(frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["batch", "bucket", "entries", "flags"])
        b = _Batch(in_order(frame)["text"].tolist(), window, block)
        codes, _, inverse, starts = b.anchors(n_buckets)
        _, h = b.candidates(starts[_hits(replies, codes, n_buckets)[inverse]])
        values, bucket, flags, _ = _wide_codes(h, n_buckets)
        return _pack(bucket, flags, int(frame["batch"].iloc[0]), n_buckets, values.astype("<u8"))

    def cut(frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "n_words", "n_removed", "kept_text"]
        if not len(frame):
            return pd.DataFrame(columns=names)
        frame = in_order(frame)
        texts = frame["text"].tolist()
        b = _Batch(texts, window, block)
        codes, _, inverse, starts = b.anchors(n_buckets)
        first = replies[replies["round"] == 1]
        starts, h = b.candidates(starts[_hits(first, codes, n_buckets)[inverse]])
        _, bucket, _, back = _wide_codes(h, n_buckets)
        repeated = starts[_hits(replies[replies["round"] == 2], bucket, n_buckets)[back]]
        cover = np.zeros(len(b.hashes) + 1, dtype=np.int32)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + window, -1)
        gone = np.cumsum(cover[:-1]) > 0
        ends = np.cumsum(b.counts)
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.append(0, ends[:-1])) * (b.counts > 0) if len(ends) else ends
        kept = [_kept_words(t, gone[e - n:e]) for t, e, n in zip(texts, ends.tolist(), b.counts.tolist())]
        return pd.DataFrame({"doc_id": pd.array([None if pd.isna(x) else int(x) for x in frame["doc_id"]], dtype="Int64"),
                             "n_words": b.counts, "n_removed": removed, "kept_text": kept})

    by_batch = rows.groupBy("batch")
    first = (by_batch.applyInPandas(offer, REQUEST).groupBy("bucket")
             .applyInPandas(lambda f: _answers(f, "<u4", True), REPLY))
    second = (by_batch.cogroup(first.groupBy("batch")).applyInPandas(extend, REQUEST).groupBy("bucket")
              .applyInPandas(lambda f: _answers(f, "<u8", False), REPLY))
    replies = first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))
    return (by_batch.cogroup(replies.groupBy("batch"))
            .applyInPandas(cut, "doc_id long, n_words long, n_removed long, kept_text string")
            .withColumnRenamed("doc_id", id_col))
