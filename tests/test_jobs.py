"""The composed jobs, retention runs, hashes and the account of late rows."""
import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from vireo.operators import jobs as J
from vireo.operators import prepare as P
from vireo.operators import privacy as S
from vireo.sources import tables as IO
from vireo.streaming import jobs as W


def _exports(tmp_path):
    for year, text in ((2021, "RA,Idade,Fase,IAN,Pedra,Defas,Nome\nr1,1900-01-12,1,5.5,Agata,-1,Ana\nr2,9,2,,Topazio,0,Bia\n"),
                       (2022, "ra,IDADE,FASE,ian,Defasagem\nr1,13,2,x,1\nr2,texto,3,7,-2\nr3,40,1,8,0\n")):
        (tmp_path / str(year)).mkdir()
        (tmp_path / str(year) / "a.csv").write_text(text)
    return {y: str(tmp_path / str(y)) for y in (2021, 2022)}


def test_prepare_job(spark, tmp_path):
    p = J.prepare_snapshots(spark, _exports(tmp_path), str(tmp_path / "out"))
    got = {r.ra: (r.ano, r.idade, r.fase, r.ian, r.em_risco) for r in p.modeling.collect()}
    assert got == {"r1": (2021, 12, 1.0, "5.5", 0), "r2": (2021, 9, 2.0, None, 1)}  # 3 of 4 numbers: text stays
    assert not {"pedra", "defasagem", "nome"} & set(p.modeling.columns)
    leak = {r["table"]: (r.passed, r.detail) for r in p.checks.where("check_name = 'leakage'").collect()}
    assert leak == {"snapshots": (False, "pedra,defasagem"), "features": (True, "")}
    assert {r.year: r.n_rows for r in p.schemas.collect()} == {2021: 2, 2022: 3}


def test_training_decisions_are_repeated_in_scoring(spark):
    df = spark.createDataFrame([("a", 1.0, None, 2020, 0), ("b", 2.0, 4.0, 2019, 1)],
                               "ra string, fase double, ida double, ano_ingresso int, em_risco int")
    t = J.load_and_prepare(df)
    assert t.missing_columns == ["ida"] and "ida_missing" in t.signature and "ra" not in t.table.columns
    full = df.drop("em_risco").fillna(3.0, ["ida"])
    s = J.prepare_for_scoring(full, t)
    assert s.columns == ["ra", *t.signature] and {r.ida_missing for r in s.collect()} == {0}
    with pytest.raises(ValueError):
        J.load_and_prepare(df.withColumn("ida_2024", F.lit(1.0)), target_year=2024)


def test_periods_come_from_the_data(spark):
    df = spark.createDataFrame([("a", 1990, 1.0), ("a", 2030, 2.0), ("b", None, 3.0)], "ra string, ano int, x double")
    assert P.periods(df, "ano") == [1990, 2030]
    assert P.to_wide(df, "ra", "ano", ["x"], P.periods(df, "ano")).columns == ["ra", "x_1990", "x_2030"]


def test_retention_run(spark, tmp_path):
    days = [dt.datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (3, 9)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate([*days, None])], "ts timestamp, v int")
    store = str(tmp_path / "store")
    IO.append_events(df, store)
    plan = S.run_retention(spark, store, "2024-01-03 06:00:00", 1)
    assert spark.read.parquet(store).count() == 7
    assert {str(r.dt): r.action for r in plan.collect()} == {"None": "keep", "2024-01-01": "drop", "2024-01-02": "rewrite", "2024-01-03": "keep"}
    S.run_retention(spark, store, "2024-01-03 06:00:00", 1, dry_run=False)
    assert sorted(r.v for r in spark.read.parquet(store).collect()) == [3, 4, 5, 6]
    assert sorted(f for f in os.listdir(tmp_path)) == ["store"]


def test_file_and_content_hashes(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc" * 1000)
    assert S.file_hashes(spark, f"{tmp_path}/*.bin").first().sha256 == hashlib.sha256(b"abc" * 1000).hexdigest()
    rows = [("p", 1, None), ("p", 2, "x"), ("q", None, "y")]
    df = spark.createDataFrame(rows, "k string, a int, b string")
    got = {r.name: r.sha256 for r in S.content_hashes(df.repartition(3), "k", ["a", "b"]).collect()}

    def digest(texts):
        total = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts)
        return hashlib.sha256(f"{total}:{len(texts)}".encode()).hexdigest()
    # every value with its length before it, nulls as a dash
    assert got == {"p": digest(["1:1-", "1:21:x"]), "q": digest(["-1:y"])}


def test_every_late_row_is_accounted_for(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    late = [(t0 + dt.timedelta(minutes=m),) for m in range(30)]
    early = [(t0 + dt.timedelta(hours=5, minutes=m),) for m in range(180)] + [(None,)]
    progress = []
    for name, rows in (("a", early), ("b", late)):
        spark.createDataFrame(rows, "ts timestamp").write.parquet(f"{src}/{name}")
        s = W.file_stream(spark, f"{src}/*/*.parquet", schema=spark.read.parquet(f"{src}/a").schema)
        g = s.withWatermark("ts", "30 minutes").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
        progress += W.run_available_now(g.select("n"), out, checkpoint=ckpt)
    r = W.watermark_account(spark.read.parquet(f"{src}/*"), spark.read.parquet(out), "ts", W.final_watermark(progress), "1 hour").first()
    assert (r.rows_in_windows, r.rows_open, r.rows_without_time, r.rows_dropped_late) == (120, 60, 1, 30)
