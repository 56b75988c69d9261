"""Loaders (S1-S7) on temporary files, and stream scoring."""

import json
import os

import pytest
from pyspark.sql import functions as F

from nearrate.operators import predictors as pr
from nearrate.sources import load_item_names, load_personal, load_ratings, write_report
from nearrate.sources import dedupe, report_row
from nearrate.streaming import fit_baseline, score_stream


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return str(path)


@pytest.mark.parametrize("sep,text", [
    ("\t", "1\t10\t4\t881250949\n2\t10\t3\t0\n\n"),
    ("::", "1::10::4::978300760\n2::10::3::1\n"),
    (",", "userId,movieId,rating,timestamp\n1, 10 ,4.0,5\n2,10,3.0,6\n"),
])
def test_load_ratings(spark, tmp_path, sep, text):
    p = _write(tmp_path / "r.txt", text)
    rows = sorted(tuple(r) for r in load_ratings(spark, p, sep).collect())
    assert rows == [(1, 10, 4.0), (2, 10, 3.0)]
    assert load_ratings(spark, p, sep).dtypes == [("user_id", "bigint"), ("item_id", "bigint"),
                                                  ("rating", "double")]


def test_bad_item_field_fails(spark, tmp_path):
    p = _write(tmp_path / "bad.txt", "1\tx\t4\n")
    with pytest.raises(Exception):
        load_ratings(spark, p).collect()


def test_personal_and_names(spark, tmp_path):
    p = _write(tmp_path / "personal.csv",
               'id,name,rating\n1,Toy Story (1995),5\n2,"Heat, the movie",\n3,GoldenEye,0\n4,Babe,2\n')
    got = sorted(tuple(r) for r in load_personal(spark, p, 944).collect())
    assert got == [(944, 1, 5.0), (944, 4, 2.0)]
    names = {r.item_id: r.name for r in load_item_names(spark, p).collect()}
    assert names[2] == "Heat, the movie"


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 1, 5.0), (1, 2, 1.0)],
                               "user_id bigint, item_id bigint, rating double")
    assert sorted(tuple(r) for r in dedupe(df).collect()) == [(1, 1, 5.0), (1, 2, 1.0)]


def test_report_sink(spark, tmp_path):
    df = spark.range(1).select(report_row(mae=F.lit(0.5), n=F.lit(3)).alias("report"))
    write_report(df, str(tmp_path / "rep"))
    files = [f for f in os.listdir(tmp_path / "rep") if f.endswith(".json")]
    line = json.loads(open(tmp_path / "rep" / files[0]).read().strip())
    assert json.loads(line["report"]) == {"mae": 0.5, "n": 3}


def test_stream_scoring_matches_batch(spark, tiny, tmp_path):
    tr, te, test = tiny
    src = str(tmp_path / "requests")
    te.write.parquet(src)
    model = fit_baseline(tr, table_dir=str(tmp_path / "model"))
    stream = spark.readStream.schema(te.schema).parquet(src)
    q = (score_stream(stream, model).writeStream.format("memory").queryName("scored")
         .option("checkpointLocation", str(tmp_path / "ckpt")).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = {(r.user_id, r.item_id): r.pred for r in spark.sql("SELECT * FROM scored").collect()}
    want = {(r.user_id, r.item_id): r.pred for r in pr.predict_baseline(tr, te).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_load_ratings_dedupe(spark, tmp_path):
    p = _write(tmp_path / "dup.txt", "1\t10\t4\n1\t10\t2\n2\t10\t3\n")
    assert load_ratings(spark, p).count() == 3
    rows = sorted(tuple(r) for r in load_ratings(spark, p, dedupe_pairs=True).collect())
    assert rows == [(1, 10, 4.0), (2, 10, 3.0)]


def test_stream_scoring_without_table_dir(spark, tiny, tmp_path):
    tr, te, _ = tiny
    src = str(tmp_path / "req")
    te.write.parquet(src)
    model = fit_baseline(tr)
    q = (score_stream(spark.readStream.schema(te.schema).parquet(src), model)
         .writeStream.format("memory").queryName("scored_nodir")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) FROM scored_nodir").first()[0] == te.count()


def test_scoring_without_training_data(spark, tiny):
    from nearrate.streaming.scoring import fit_baseline, score_stream
    tr, te, _ = tiny
    scored = score_stream(te, fit_baseline(tr.limit(0))).collect()
    assert len(scored) == te.count() and all(r["pred"] is None for r in scored)
