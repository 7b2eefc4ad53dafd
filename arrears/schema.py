"""Declared schemas of the raw invoices, the training set and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .params import TRAINING_SET_COLUMNS

INVOICE_SCHEMA = T.StructType([
    T.StructField("invoice_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("company_id", T.LongType()),
    T.StructField("invoice_date", T.DateType()),
    T.StructField("create_date", T.DateType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("due_discount_date", T.DateType()),
    T.StructField("payment_date", T.DateType()),
    T.StructField("payment_amount", T.DoubleType()),
    T.StructField("payment_complete", T.StringType()),
    T.StructField("net_amount", T.DoubleType()),
    T.StructField("region_level1", T.StringType()),
    T.StructField("region_level2", T.StringType()),
    T.StructField("region_level3", T.StringType()),
])

# CSV carries dates as text; parse them in the cleaning step
INVOICE_CSV_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
    for f in INVOICE_SCHEMA.fields
])

_INT_COLUMNS = {
    "discount_offered", "delay_days", "previous_delay_days", "number_of_previous_invoices",
    "has_delayed_payment_last_3", "has_early_payment_last_3", "maximum_delay_days",
    "due_date_month", "due_date_quarter", "due_date_dayofweek", "due_date_is_year_end",
    "due_date_is_year_start", "due_date_is_summer", "delay_days_trend_acceleration",
    "region_level1", "region_level2", "region_level3", "payment_bucket",
}
_LONG_COLUMNS = {"invoice_id", "customer_id", "company_id", "frequency_of_transactions"}
_DATE_COLUMNS = {"invoice_date", "create_date", "due_date", "payment_date"}


def _training_type(name: str) -> T.DataType:
    if name in _LONG_COLUMNS:
        return T.LongType()
    if name in _INT_COLUMNS:
        return T.IntegerType()
    if name in _DATE_COLUMNS:
        return T.DateType()
    return T.DoubleType()


TRAINING_SET_SCHEMA = T.StructType([T.StructField(c, _training_type(c)) for c in TRAINING_SET_COLUMNS])


def require_columns(df: DataFrame, columns) -> DataFrame:
    """Fail fast on a missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
