"""Ranked search against a full scoring of every document, and the accumulator limit."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vireo.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def terms(t):
    return [x.translate(LOWER) for x in TERM.findall(t or "")]


def brute(docs, items, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if c[t])
            if s:
                scored.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def got(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_terms():
    for t in ["", None, "A-b c1\x00d", "Éa ÉA", "x_y[z]`q{r}~s\x7f", "İK日本 ", "a" * 10_000, "\n\t "]:
        assert [x.decode() for x in ls.terms_of(t)] == terms(t)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(4)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(200)]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < .8 else rng.choice(rare).upper() for _ in range(n))

    docs = [(i, text(rng.choice([0, 1, 5, 30, 60]))) for i in range(700)]
    docs += [(9000 + i, "same words r1 c1") for i in range(40)] + [(5, "r1 r1 r1"), (5, "r1 r1 r1"), (None, "r1 r2"), (None, None), (701, None), (702, "r3 " * 50_000)]
    items = [(i, text(rng.choice([1, 4, 12]))) for i in range(40)] + [(100, None), (101, ""), (102, "unknownword"), (103, "same words same"), (None, "r1"),
                                                                      (104, "r3 c1"), (104, "r3 c1"), (105, " ".join(common + rare))]
    return docs, items


@pytest.mark.parametrize("shard,block", [(32_768, 2_000), (50, 7)])
def test_search_against_full_scoring(spark, tables, monkeypatch, shard, block):
    docs, items = tables
    monkeypatch.setattr(ls, "BLOCK_ITEMS", block)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    for c in ("item", "rank", "score", "length", "terms", "counts", "t"):
        d, i = d.withColumn(c, F.lit("extra")), i.withColumn(c, F.lit("extra"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(shard, 10_000)))
    try:
        assert got(ls.search_documents(d, i)) == brute(docs, items)
        assert got(ls.search_documents(d, i, k=3)) == brute(docs, items, 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_accumulators_are_limited_and_scores_exact():
    rng = np.random.default_rng(0)
    n = 5_000
    holders = [np.sort(rng.choice(n, size, replace=False)) for size in (12, 40, 4_500, 4_900, 5_000)]
    sizes = np.bincount(np.concatenate(holders), minlength=n)
    docs = np.concatenate(holders)
    order = np.argsort(docs, kind="stable")
    t = np.concatenate([np.full(len(h), i) for i, h in enumerate(holders)])[order]
    weights = np.array([ls.weight(n, len(h)) for h in holders])
    shard = ls.Shard(rng.integers(5, 50, n), sizes, t, rng.integers(1, 4, len(t)), weights, n, 27 * n)
    found, scores = shard.search(np.arange(5), 10)
    full = np.zeros(n, dtype=np.int64)
    for i in range(5):
        full[shard.doc[shard.starts[i]:shard.starts[i + 1]]] += shard.gain[shard.starts[i]:shard.starts[i + 1]]
    assert (full[found] == scores).all()
    assert sorted(full)[-10:] == sorted(scores)[-10:] and len(found) < 100
    # the frequent terms made no accumulators: only documents of the two rare terms have one
    assert set(found) <= set(holders[0]) | set(holders[1])


def test_empty_and_given_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ls.search_documents(docs.limit(0), items).count() == 0
    assert ls.search_documents(docs, items.limit(0)).count() == 0
    assert got(ls.search_documents(docs, items)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                                          [tuple(r) for r in items.select("item_id", "text").collect()])
