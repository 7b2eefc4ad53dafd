"""Confusion matrix (A11) and classification metrics (M8, M9).

Everything is computed from the (label, prediction) counts: a grouped
aggregate of at most classes^2 rows, so no per-row work reaches the driver.
Averages are macro (unweighted over classes) unless named weighted; a
metric with a zero denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import LABEL
from ..session import materialize


def confusion_counts(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """(actual, predicted, n), computed once.

    The counts feed several branches (per-class, accuracy); the scored input
    is therefore aggregated a single time and the at most classes^2 cells are
    written, so predictions are not recomputed per branch.
    """
    counts = df.groupBy(F.col(label).cast("int").alias("actual"),
                        F.col(prediction).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts, "confusion")


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = "prediction", classes=range(5)) -> DataFrame:
    """Rows = actual class, columns ``pred_<k>`` = counts."""
    return matrix_from_counts(confusion_counts(df, label, prediction), classes)


def matrix_from_counts(counts: DataFrame, classes=range(5)) -> DataFrame:
    classes = list(classes)
    wide = counts.groupBy("actual").pivot("predicted", classes).agg(F.sum("n"))
    return wide.select("actual", *[F.coalesce(F.col(str(k)), F.lit(0)).cast("long").alias(f"pred_{k}") for k in classes])


def per_class_counts(counts: DataFrame) -> DataFrame:
    """(class, tp, fp, fn, support) over every class seen as label or prediction."""
    n = F.col("n")
    as_actual = counts.groupBy(F.col("actual").alias("class")).agg(
        F.sum(F.when(F.col("actual") == F.col("predicted"), n).otherwise(0)).alias("tp"),
        F.sum(n).alias("support"),
    )
    as_pred = counts.groupBy(F.col("predicted").alias("class")).agg(F.sum(n).alias("predicted_n"))
    c = as_actual.join(as_pred, "class", "full").fillna(0, ["tp", "support", "predicted_n"])
    return c.select(
        "class", "tp", (F.col("predicted_n") - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"), "support",
    )


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def per_class_metrics_from_counts(counts: DataFrame) -> DataFrame:
    pc = per_class_counts(counts)
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    m = pc.withColumns({"precision": p, "recall": r})
    m = m.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    rows = m.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    macro = m.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    sw = F.col("support").cast("double")
    weighted = m.agg(
        F.lit("weighted avg").alias("class"),
        *[_ratio(F.sum(F.col(k) * sw), F.sum(sw)).alias(k) for k in ("precision", "recall", "f1")],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(macro).unionByName(weighted)


def per_class_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / F1 / support plus macro and weighted rows (M9)."""
    return per_class_metrics_from_counts(confusion_counts(df, label, prediction))


def metrics_from_counts(counts: DataFrame, digits: int | None = None) -> DataFrame:
    """Accuracy (sum of true positives over all rows) and the macro averages, one aggregate."""
    pc = per_class_counts(counts)
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    m = pc.withColumns({"precision": p, "recall": r})
    m = m.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    out = m.agg(_ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def classification_metrics(df: DataFrame, label: str = LABEL, prediction: str = "prediction",
                           digits: int | None = None) -> DataFrame:
    """One row: accuracy, macro precision, macro recall, macro F1 (M8); ``digits`` rounds (C14)."""
    return metrics_from_counts(confusion_counts(df, label, prediction), digits)


def counts_from_matrix(spark, matrix) -> DataFrame:
    """(actual, predicted, n) from a nested list (rows = actual)."""
    rows = [(i, j, int(v)) for i, row in enumerate(matrix) for j, v in enumerate(row)]
    return spark.createDataFrame(rows, "actual int, predicted int, n long")
