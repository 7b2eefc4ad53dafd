"""Year split (F13), open-invoice split (F14), projection (F10) and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import LABEL, NON_FEATURE_COLUMNS, PRODUCTION_TRAIN_FROM_YEAR, SplitParams
from ..session import materialize


def _invoice_year(df: DataFrame):
    """The stored partition column where the training set still has it (files of other years are
    then skipped), else the year of the invoice date."""
    return F.col("invoice_year") if "invoice_year" in df.columns else F.year("invoice_date")


def split_train(df: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    y = _invoice_year(df)
    return df.filter((y >= params.train_from) & (y < params.train_until))


def split_test(df: DataFrame, params: SplitParams = SplitParams()) -> DataFrame:
    return df.filter(_invoice_year(df) >= params.test_from)


def split_open_invoices(df: DataFrame) -> DataFrame:
    """Open invoices to score: no payment date and not complete."""
    return df.filter(F.col("payment_date").isNull() & (F.col("payment_complete") == "N"))


def split_production_train(df: DataFrame, from_year: int = PRODUCTION_TRAIN_FROM_YEAR) -> DataFrame:
    """Production training rows: invoiced from ``from_year`` and paid."""
    return df.filter((_invoice_year(df) >= from_year) & F.col("payment_date").isNotNull())


def training_projection(df: DataFrame, drop=NON_FEATURE_COLUMNS) -> DataFrame:
    """Drop the date columns, the raw delay and the stored year (F10); the label is kept."""
    return df.drop(*drop, "invoice_year").withColumn(LABEL, F.col(LABEL).cast("int"))


def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, weight = N / n)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0  # one scalar from the per-class table
    return counts.select(label, "n", (F.lit(total) / F.col("n")).alias("weight"))


def add_class_weight(df: DataFrame, weights: DataFrame, label: str = LABEL, out: str = "weight") -> DataFrame:
    """Join the per-class weight onto every row (J2); classes unseen in training get 1.0.

    The weights (one row per class) are written first, so Spark picks the join by their size.
    """
    w = materialize(weights.select(label, F.col("weight").alias(out)), "class-weights")
    return df.join(w, label, "left").withColumn(out, F.coalesce(F.col(out), F.lit(1.0)))
