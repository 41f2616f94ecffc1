"""Retention that survives failures, hash trees of files, strict reads, scoring batches, label pruning, folds."""
import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from vireo.operators import kpi as K
from vireo.operators import privacy as S
from vireo.operators import quality as Q
from vireo.sources import tables as IO
from vireo.streaming import jobs as W

AS_OF, DAYS = "2024-01-20 12:00:00", 10


def event_store(spark):
    store = W.shared_path(spark, "retain")
    rows = [(i, dt.datetime(2024, 1, 5 + i % 12, i % 24)) for i in range(240)]
    IO.append_events(spark.createDataFrame(rows, "id long, ts timestamp"), store)
    return store


def held(spark, store):
    return sorted(r.id for r in spark.read.option("basePath", store).parquet(store).select("id").collect())


STEPS = ["_stage_retained", "_record_plan", "_swap", "_drop_folders", "_delete"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_retention_is_finished_by_the_next_run(spark, monkeypatch, step, when):
    store = event_store(spark)
    cutoff = dt.datetime(2024, 1, 10, 12)
    want = [i for i in range(240) if dt.datetime(2024, 1, 5 + i % 12, i % 24) >= cutoff]
    real, calls = getattr(S, step), []

    def broken(*args):
        calls.append(args)
        # of the deletions, fail at the one of the plan, which ends the run
        if step == "_delete" and not str(args[1]).endswith("plan"):
            return real(*args)
        if when == "after":
            real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, step, broken)
        with pytest.raises(RuntimeError):
            S.run_retention(spark, store, AS_OF, DAYS, dry_run=False)
    assert calls
    # a run for an older cutoff, which by itself removes nothing, ends what was begun if its plan was recorded
    S.run_retention(spark, store, "2024-01-05 00:00:00", DAYS, dry_run=False)
    begun = (step, when) not in (("_stage_retained", "before"), ("_stage_retained", "after"), ("_record_plan", "before"))
    assert held(spark, store) == (want if begun else list(range(240)))
    S.run_retention(spark, store, AS_OF, DAYS, dry_run=False)
    assert held(spark, store) == want
    assert not os.path.exists(S._beside(store, "plan").replace("file:", ""))


def test_block_hashes_name_the_changed_block(spark):
    rng = random.Random(1)
    base = W.shared_path(spark, "blocks").replace("file:", "")
    os.makedirs(base)
    data = bytearray(rng.randbytes(300_000))
    data[1000:60_000] = b"x" * 59_000  # a long stretch without a newline

    def write(name, content):
        with open(f"{base}/{name}", "wb") as f:
            f.write(content)

    write("a.bin", bytes(data))
    write("empty.bin", b"")
    write("b.bin", b"no newline at the end")
    block = 10_000
    before = S.file_block_hashes(spark, base, block).select("name", "block", "sha256")
    before = spark.createDataFrame(before.collect(), before.schema)
    # the blocks do not depend on how the file is split
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        assert S.changed_blocks(before, S.file_block_hashes(spark, base, block)).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert before.where("name = 'a.bin'").count() > 20
    data[200_005] ^= 1
    write("a.bin", bytes(data))
    changed = [(r.name, r.block) for r in S.changed_blocks(before, S.file_block_hashes(spark, base, block)).collect()]
    # a piece belongs to the block it begins in
    assert all(n == "a.bin" and 18 <= b <= 21 for n, b in changed) and 1 <= len(changed) <= 2
    write("b.bin", b"no newline at the end\n")
    assert ("b.bin", 0) in {(r.name, r.block) for r in S.changed_blocks(before, S.file_block_hashes(spark, base, block)).collect()}
    roots = {r.name: r.n_blocks for r in S.file_tree_hashes(before).collect()}
    assert roots["b.bin"] == 1 and roots["a.bin"] == before.where("name = 'a.bin'").count()


def test_content_hashes_tell_rows_apart(spark):
    rows = [("x", "a|b", "c"), ("y", "a", "b|c"), ("z", "a", None), ("w", "a", "-"), ("v", "1:a", ""), ("u", "1", ":a")]
    h = {r.name: r.sha256 for r in S.content_hashes(spark.createDataFrame(rows, "n string, p string, q string"), "n", ["p", "q"]).collect()}
    assert len(set(h.values())) == len(rows)


def test_read_events_is_strict_and_names_unread_files(spark):
    store = event_store(spark)
    folder = store.replace("file:", "") + "/dt=2024-01-05"
    with open(f"{folder}/broken.parquet", "wb") as f:
        f.write(b"no parquet")
    with pytest.raises(Exception, match="broken.parquet"):
        IO.read_events(spark, store).count()
    assert IO.read_events(spark, store, strict=False).count() == 240
    assert [os.path.basename(r.path) for r in IO.unread_files(spark, store).collect()] == ["broken.parquet"]


def test_score_batches_scores_or_rejects_every_row_once(spark):
    src, out = W.shared_path(spark, "sb-src"), W.shared_path(spark, "sb")
    rows = [(i, str(i) if i % 4 else "bad", float(i) if i % 5 else None, float("nan") if i == 7 else 1.0) for i in range(100)]
    spark.createDataFrame(rows, "id long, a string, b double, c double").repartition(4).write.parquet(src)
    sig = {"a": "double", "b": "double", "c": "double"}
    half = {"n": 0}

    def score(batch):
        half["n"] += 1
        if half["n"] == 3:
            raise RuntimeError("lost")
        return batch.select("id", (F.col("a").cast("double") * 2).alias("risk_score"))

    stream = lambda: W.file_stream(spark, f"{src}/*.parquet", max_files=1)
    ckpt = W.shared_path(spark, "sb-ckpt")
    run = lambda: W.score_batches(stream(), score, sig, out, ckpt, {"a": (0, 90)}, ["b"])
    with pytest.raises(Exception):
        run()
    run()  # the same checkpoint goes on with the batch that failed
    run()
    scored, rejected = spark.read.parquet(f"{out}/scored"), spark.read.parquet(f"{out}/rejected")
    bad = {i for i in range(100) if i % 4 == 0 or i % 5 == 0 or i == 7 or (i % 4 and i > 90)}
    assert sorted(r.id for r in rejected.collect()) == sorted(bad)
    assert sorted(r.id for r in scored.collect()) == sorted(set(range(100)) - bad)
    account = spark.read.parquet(f"{out}/account").agg(F.sum("n_in"), F.sum("n_scored"), F.sum("n_rejected")).first()
    assert tuple(account) == (100, 100 - len(bad), len(bad))
    reasons = {r.id: r.reasons for r in rejected.collect()}
    assert reasons[20] == ["a: not a number", "b: missing"] and reasons[7] == ["c: not finite"] and reasons[91] == ["a: outside [0, 90]"]


def test_row_reasons_of_absent_columns(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert Q.row_reasons(df, {"a": "double", "z": "double"}, required=["z"]).first().reasons == ["z: absent"]
    assert Q.row_reasons(df, {"a": "double", "z": "double"}).first().reasons == []


def test_label_join_reads_only_the_partitions_named(spark):
    path = W.shared_path(spark, "preds")
    spark.range(1000).select(F.col("id").alias("request_id"), (F.col("id") % 10 + 2010).cast("int").alias("period"), (F.col("id") / 1000).alias("risk_score")) \
        .write.partitionBy("period").parquet(path)
    labels = spark.createDataFrame([(13, 2013, 1), (23, 2013, 0), (27, 2017, 1), (5, None, 0)], "request_id long, period int, label int")
    joined = W.label_join(labels, spark.read.parquet(path), ("request_id", "period"), partition="period")
    assert sorted((r.request_id, r.label) for r in joined.collect()) == [(13, 1), (23, 0), (27, 1)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*period#\d+ IN \(2013,2017\)", plan), plan
    assert "GreaterThanOrEqual(request_id,5)" in plan and "LessThanOrEqual(request_id,27)" in plan


def test_balanced_folds_bounds(spark):
    rng = random.Random(2)
    rows = [(f"s{i}", int(rng.random() < .3)) for i in range(200) for _ in range(rng.choice([1, 1, 2, 3, 9]))] + [("hot", 1)] * 40
    f = K.balanced_folds(spark.createDataFrame(rows, "k string, y int"), "k", "y", 4).collect()
    assert len(f) == 201 and {r.fold for r in f} == {0, 1, 2, 3}
    per = {i: [sum(r[c] for r in f if r.fold == i) for c in ("n_rows", "n_pos")] + [sum(r.fold == i for r in f)] for i in range(4)}
    sizes = {r.n_rows for r in f}
    spread = lambda j: max(v[j] for v in per.values()) - min(v[j] for v in per.values())
    assert spread(2) <= 1 and spread(0) <= max(sizes) and spread(1) <= sum(sizes)


def test_temporal_folds_leave_a_gap(spark):
    df = spark.createDataFrame([(y,) for y in range(2000, 2006)], "y int")
    got = {(r.fold, r.role): set() for r in K.temporal_folds(df, "y", [2002, 2005], 1).collect()}
    for r in K.temporal_folds(df, "y", [2002, 2005], 1).collect():
        got[r.fold, r.role].add(r.y)
    assert got == {(2002, "test"): {2002}, (2002, "train"): {2000}, (2005, "test"): {2005}, (2005, "train"): {2000, 2001, 2002, 2003}}


def test_relative_change_after_a_gap(spark):
    df = spark.createDataFrame([(2000, 1.0), (2001, 2.0), (2004, 3.0), (2005, 6.0)], "y int, v double")
    got = {r.y: (r.baseline, r.relative_change) for r in K.relative_change(df, [], "y", "v").collect()}
    assert got == {2000: (None, None), 2001: (1.0, 1.0), 2004: (None, None), 2005: (3.0, 1.0)}
