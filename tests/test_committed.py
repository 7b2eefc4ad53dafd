"""Committed sinks and reuse of the first pipeline step."""

import os

import pytest
from fixtures import hand_invoices
from pyspark.sql import functions as F

from arrears.plans import pipeline as P
from arrears.sources import commit, current_folder, manifest, read_predictions, vacuum_sink, write_labelled_predictions, write_predictions
from arrears.sources.io import read_training_set, write_training_set


def rows(spark, n, bad=False):
    df = spark.range(n).selectExpr("id as invoice_id", "cast(id % 5 as int) as predicted_bucket", "date'2021-01-01' + cast(id % 900 as int) as invoice_date")
    if bad:
        df = df.withColumn("predicted_bucket", F.when(F.col("invoice_id") < n - 1, F.col("predicted_bucket")).otherwise(F.raise_error(F.lit("killed")).cast("int")))
    return df


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_write_killed_half_way_leaves_the_old_rows(spark, tmp_path, fmt):
    path = str(tmp_path / "predictions")
    write_predictions(rows(spark, 40), path, fmt)
    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            write_predictions(rows(spark, 5000, bad=True).repartition(8), path, fmt)
        assert read_predictions(spark, path, fmt).count() == 40
    write_predictions(rows(spark, 70), path, fmt)
    assert read_predictions(spark, path, fmt).count() == 70


def test_training_set_and_labels_are_committed(spark, tmp_path):
    path = str(tmp_path / "train")
    write_training_set(rows(spark, 90), path)
    with pytest.raises(Exception, match="killed"):
        write_training_set(rows(spark, 500, bad=True), path)
    assert read_training_set(spark, path).count() == 90
    write_training_set(rows(spark, 10), path, mode="append")
    assert read_training_set(spark, path).count() == 100
    write_labelled_predictions(rows(spark, 12), str(tmp_path / "labels"))
    write_labelled_predictions(rows(spark, 5), str(tmp_path / "labels"))
    assert read_predictions(spark, str(tmp_path / "labels"), "csv").count() == 5


def test_two_writers_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "sink")

    def slow(folder):  # another writer commits while this one writes
        write_predictions(rows(spark, 3), path)
        rows(spark, 9).write.parquet(folder)

    with pytest.raises(RuntimeError, match="another writer"):
        commit(spark, path, slow)
    assert read_predictions(spark, path).count() == 3
    for n in (4, 5, 6):
        write_predictions(rows(spark, n), path)
    gone = vacuum_sink(spark, path, keep=2)
    left = [x for x in os.listdir(path) if x.startswith("data-")]
    assert len(gone) == 3 and len(left) == 2 and read_predictions(spark, path).count() == 6
    assert current_folder(spark, str(tmp_path)) == str(tmp_path) and manifest(spark, str(tmp_path)) is None


def test_second_run_reuses_the_first_step(spark, tmp_path, monkeypatch):
    source, folder = str(tmp_path / "inv"), str(tmp_path / "train")
    hand_invoices(spark).write.parquet(source)
    made = []
    monkeypatch.setattr(P, "preprocess", lambda inv, as_of: (made.append(as_of), inv)[1])
    monkeypatch.setattr(P, "train", lambda ts, estimator, as_of: type("R", (), {"predictions": ts})())

    def run(as_of=None, **more):
        P.run_pipeline(spark, spark.read.parquet(source), folder, str(tmp_path / "pred"), as_of=as_of, **more)
        return len(made)

    assert [run(), run(), run()] == [1, 1, 1]
    group = "reuse"
    spark.sparkContext.setJobGroup(group, "fingerprint")
    P.step_fingerprint(spark.read.schema(hand_invoices(spark).schema).parquet(source), as_of=None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert run(as_of="2021-06-01") == 2 and run(as_of="2021-06-01") == 2
    hand_invoices(spark).withColumn("invoice_id", F.col("invoice_id") + 100).write.mode("append").parquet(source)
    assert run(as_of="2021-06-01") == 3 and run(as_of="2021-06-01", reuse=False) == 4
