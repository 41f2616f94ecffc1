"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

One pass tokenises the documents and keeps, per document, its length and the
counts of those terms that an item asks for; corpus statistics are sums over
that table.  Every task then holds a shard of the documents as postings by
term and answers every item: terms are taken rarest first, documents met get
an accumulator, and once the bounds of the terms to come cannot lift a
document without accumulator to the partial score of the k-th best, no
accumulators are made any more; the survivors are updated exactly.  A shard's
best k hold all of its documents that can be among the best k of the corpus,
so merging the shards' lists is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vireo.llm.common import ship_package, stage

TOP = 10
#: items answered in one pass over the documents: bounds of their number and characters
BLOCK_ITEMS, BLOCK_CHARS = 2_000, 4_000_000
#: documents and postings of a shard
SHARD_DOCS, SHARD_POSTINGS = 32_768, 4_000_000
#: share of a mean document's length in the norm, in percent
LENGTH_SHARE = 90

_SEPARATORS = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: lower-cases A-Z and makes every separator a space, byte by byte
_TABLE = bytes(0x20 if chr(b) in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: maximal runs of digits, letters A-Z
    (lower-cased) and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norms(lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """A document's length norm in percent of a mean one, 64-bit integers."""
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // max(1, total)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, length, terms, counts) of every document that has a term."""
    def scan(frames):
        for frame in frames:
            lengths, terms, counts = [], [], []
            for text in frame["text"].tolist():
                words = terms_of(text)
                lengths.append(len(words))
                known = np.fromiter((t for t in map(vocabulary.get, words) if t is not None), dtype=np.int32)
                t, c = np.unique(known, return_counts=True)
                terms.append(t)
                counts.append(c)
            some = np.array(lengths, dtype=np.int64) > 0
            yield pd.DataFrame({"doc_id": pd.array(frame["doc_id"], dtype="Int64")[some], "length": np.array(lengths, dtype=np.int64)[some],
                                "terms": [t for t, s in zip(terms, some) if s], "counts": [c for c, s in zip(counts, some) if s]})

    return docs.mapInPandas(scan, "doc_id long, length long, terms array<int>, counts array<long>")


class Shard:
    """Documents as postings by term, each with its contribution to a score."""

    def __init__(self, lengths, sizes, terms, counts, weights, n_docs, total):
        doc = np.repeat(np.arange(len(lengths)), sizes)
        order = np.argsort(terms, kind="stable")
        self.doc, term = doc[order], terms[order]
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))
        m = norms(lengths, n_docs, total)[self.doc]
        tf = counts[order]
        self.gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        self.bound = np.zeros(len(weights), dtype=np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.bound[held] = np.maximum.reduceat(self.gain, self.starts[held])
        self.n = len(lengths)

    def search(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all that can be among the best ``k``;
        ``terms`` rarest first."""
        remaining = np.append(np.cumsum(self.bound[terms][::-1])[::-1], 0)
        score, met = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=bool)
        survivors = None
        for i, t in enumerate(terms.tolist()):
            doc, gain = self.doc[self.starts[t]:self.starts[t + 1]], self.gain[self.starts[t]:self.starts[t + 1]]
            if survivors is None:
                holders = np.flatnonzero(met)
                # a document not met yet can tie at best if the bounds equal the k-th score
                if len(holders) >= k and remaining[i] < np.partition(score[holders], len(holders) - k)[len(holders) - k]:
                    survivors = holders
            if survivors is None:
                score[doc] += gain
                met[doc] = True
            elif len(survivors) * 16 < len(doc):
                at = np.searchsorted(doc, survivors)
                at[at == len(doc)] = 0
                hit = doc[at] == survivors
                score[survivors[hit]] += gain[at[hit]]
            else:
                hit = met[doc]
                score[doc[hit]] += gain[hit]
        found = np.flatnonzero(met & (score > 0))
        if len(found) > k:
            least = np.partition(score[found], len(found) - k)[len(found) - k]
            found = found[score[found] >= least]
        return found, score[found]


def _best(docs: np.ndarray, missing: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best: highest score, then smallest id, nulls last."""
    return np.lexsort((docs, missing, -scores))[:k]


def _pieces(batch):
    """A batch, halved until a piece has no more postings than a shard."""
    if batch.num_rows > 1 and len(batch.column("terms").flatten()) > SHARD_POSTINGS:
        half = batch.num_rows // 2
        yield from _pieces(batch.slice(0, half))
        yield from _pieces(batch.slice(half))
    else:
        yield batch


def _search(items: list[np.ndarray], weights: np.ndarray, n_docs: int, total: int, k: int):
    def answer(parts):
        ids = pa.concat_arrays([p.column("doc_id") for p in parts])
        missing = np.asarray(ids.is_null())
        ids = np.asarray(ids.fill_null(0))
        lists = [p.column("terms") for p in parts]
        shard = Shard(np.concatenate([np.asarray(p.column("length")) for p in parts]),
                      np.concatenate([np.asarray(x.value_lengths()) for x in lists]),
                      np.concatenate([np.asarray(x.flatten()) for x in lists]),
                      np.concatenate([np.asarray(p.column("counts").flatten()) for p in parts]), weights, n_docs, total)
        out = ([], [], [], [])
        for i, terms in enumerate(items):
            docs, scores = shard.search(terms, k)
            best = _best(ids[docs], missing[docs], scores, k)
            out[0].append(np.full(len(best), i))
            out[1].append(ids[docs][best])
            out[2].append(missing[docs][best])
            out[3].append(scores[best])
        item, doc, null, score = map(np.concatenate, out)
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=null), pa.array(score, pa.int64())],
                                          ["item", "doc_id", "score"])

    def run(batches):
        parts, docs, postings = [], 0, 0
        for b in (piece for batch in batches for piece in _pieces(batch)):
            parts.append(b)
            docs, postings = docs + b.num_rows, postings + len(b.column("terms").flatten())
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield answer(parts)
                parts, docs, postings = [], 0, 0
        if docs:
            yield answer(parts)

    return run


def _blocks(items: DataFrame):
    """Lists of (item_id, text) rows, each list within the bounds."""
    block, chars = [], 0
    for r in items.toLocalIterator():
        block.append((r["item_id"], r["text"]))
        chars += len(r["text"] or "")
        if len(block) >= BLOCK_ITEMS or chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def search_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` documents of the highest score above 0 for each item, equal
    scores by ascending id: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    A term of an item counts once.  A null text has no term; an item without
    terms, or whose terms no document holds, has no row.  Rows of documents with
    a repeated or null id count each for itself (null ids after the others);
    items are told apart by id and text, and equal rows of items are one.  An
    empty table on either side gives an empty result; other columns are ignored.

    Items are read in blocks of at most ``BLOCK_ITEMS`` rows or about
    ``BLOCK_CHARS`` characters, each answered by a pass over all documents.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).distinct()
    out = None
    for block in _blocks(asked):
        part = _answer_block(rows, block, k)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _answer_block(rows: DataFrame, block: list, k: int) -> DataFrame:
    spark = rows.sparkSession
    vocabulary: dict[bytes, int] = {}
    asked = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms_of(text))] for _, text in block]
    postings = stage(_postings(rows, vocabulary), "postings")
    n_docs, total = postings.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    # a row per term of the block at most
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weights = np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64)
    items = [np.array(sorted((t for t in terms if df[t]), key=lambda t: (df[t], t)), dtype=np.int64) for terms in asked]
    best = postings.mapInArrow(_search(items, weights, n_docs, total, k), "item int, doc_id long, score long")
    # the lists of the shards: k rows per item and shard, cut to k per task before the shuffle
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(block)], "item int, item_id long")
    return stage(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), "ranked")


def search_sql(k: int = TOP) -> str:
    """The same ranking in DuckDB SQL over ``documents`` and ``benchmark``."""
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({low}, '{word}') AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM w WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({low}, '{word}')) AS term FROM benchmark),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM w),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM u WHERE term IN (SELECT term FROM q) GROUP BY ALL),
d AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY term, n_docs),
g AS (SELECT term, doc_id, weight * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - LENGTH_SHARE} + ({LENGTH_SHARE} * n * n_docs) // total))) AS gain
      FROM p JOIN d USING (term), s),
r AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM q JOIN g USING (term) GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= {k}"""
