"""Training and scoring rows that lie in one file are dealt over the tasks."""

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import functions as F

from arrears.operators import ml


class _Seen(Estimator):
    """Counts the rows of every task that it is given to fit on."""

    def __init__(self, found):
        super().__init__()
        self.found = found

    def copy(self, extra=None):
        return self

    def _fit(self, df):
        self.found += [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        return _None()


class _None(Model):
    def copy(self, extra=None):
        return self

    def _transform(self, df):
        return df.withColumns({"prediction": F.lit(0.0), "task": F.spark_partition_id()})


def _one_file(spark, n):
    return spark.range(n).coalesce(1).selectExpr("id AS invoice_id", "cast(id as double) AS a", "cast(id % 5 as int) AS payment_bucket")


def test_training_rows_of_one_file_are_shared_by_tasks(spark):
    found = []
    rows = _one_file(spark, 20_000)
    ml.fit(rows, _Seen(found), ["a"])
    assert sum(found) == 20_000 and len(found) > 1 and max(found) < 20_000 / len(found) * 1.5
    assert ml.spread(rows, task_rows=1000).rdd.getNumPartitions() == 20
    assert ml.spread(rows.filter("false")).count() == 0


def test_scored_rows_of_one_file_are_shared_by_tasks(spark):
    rows = _one_file(spark, 400_000)
    model = ml.fit(rows.limit(10), _Seen([]), ["a"])
    out = ml.predict(model, rows)
    assert out.count() == 400_000 and out.select("task").distinct().count() > 1
    assert out.agg(F.sum("invoice_id")).first()[0] == sum(range(400_000))


def test_forest_tasks_are_few_and_node_ids_not_checkpointed(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(60_000 * cores).selectExpr("id AS invoice_id", "cast(id as double) AS a", "cast(id % 5 as int) AS payment_bucket", "1.0 AS weight")
    tasks = []
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (tasks.append(df.rdd.getNumPartitions()), _None())[1])
    ml.fit(rows, ml.random_forest(), ["a"])

    class Seen(Exception):
        pass

    def stop(self, df):
        tasks.append(df.rdd.getNumPartitions())
        raise Seen

    monkeypatch.setattr(TrainValidationSplit, "fit", stop)
    try:
        ml.tune(rows, ["a"])
    except Seen:
        pass
    assert tasks == [cores, cores]
    assert ml.random_forest().getCheckpointInterval() == -1
