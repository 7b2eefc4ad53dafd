"""Streaming scoring: all rows once, a restart with the same checkpoint adds nothing,
new files are picked up on the next run."""

import os
import tempfile

from pyspark.sql import functions as F

from arrears.operators import ml
from arrears.operators.split import split_test, split_train
from arrears.plans.preprocess import preprocess
from arrears.plans.train import train
from arrears.sources.invoices import invoices_table
from arrears.sources.io import write_training_set
from arrears.streaming.scoring import run_stream_predictions
from fixtures import SF001


def test_stream_exactly_once_across_restarts(spark):
    ts = preprocess(invoices_table(spark, SF001))
    model = train(ts, ml.random_forest(5, 4)).model
    root = tempfile.mkdtemp(prefix="arrears-stream-")
    source, sink, ckpt = (os.path.join(root, d) for d in ("source", "sink", "ckpt"))
    first = split_test(ts)
    write_training_set(first, source)
    run_stream_predictions(spark, source, model, sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count() > 0
    run_stream_predictions(spark, source, model, sink, ckpt)  # restart: nothing new
    assert spark.read.parquet(sink).count() == n1
    more = split_train(ts).filter(F.year("invoice_date") == 2022)
    write_training_set(more, source, mode="append")
    run_stream_predictions(spark, source, model, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == n1 + more.count()
    assert out.select("invoice_id").distinct().count() == out.count()
