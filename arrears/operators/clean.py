"""Cleaning filters F1-F8 and the anomaly slices F12.

All filters are plain ``filter`` calls, so Catalyst merges them into one
predicate and pushes the simple ones (``payment_complete = 'Y'``,
``company_id <> -1``, ``payment_date IS NOT NULL``) into the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import in_year_range, not_true
from ..params import DATE_COLUMNS, MIN_YEAR
from ..schema import require_columns

CLEANING_COLUMNS = ("invoice_id", "customer_id", "company_id", "invoice_date", "due_date", "create_date",
                    "payment_date", "payment_amount", "payment_complete", "net_amount")


def as_of_column(as_of=None) -> Column:
    """The reference date: ``current_date()`` unless a date is given (repeatable runs)."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date")


def pin_as_of(spark: SparkSession, as_of=None):
    """``as_of``, or the session's current date read once, so that all jobs of a plan share it."""
    return as_of if as_of is not None else spark.range(1).select(F.current_date()).first()[0]


def parse_dates(df: DataFrame, columns=DATE_COLUMNS, fmt: str | None = None, lenient: bool = False) -> DataFrame:
    """Date columns to ``date`` (F1). Text is parsed; timestamps drop their time of day.

    ``lenient=True`` turns unparseable text into NULL instead of failing.
    """
    out = {}
    for c in columns:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, T.DateType):
            continue
        if isinstance(dtype, T.StringType):
            if lenient:
                ts = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
                out[c] = ts.cast("date")
            else:
                out[c] = F.to_date(F.col(c), fmt) if fmt else F.to_date(F.col(c))
        else:
            out[c] = F.col(c).cast("date")
    return df.withColumns(out) if out else df


def filter_year_range(df: DataFrame, as_of=None, columns=DATE_COLUMNS, min_year: int = MIN_YEAR) -> DataFrame:
    """Every date column in [min_year, year(as_of)] or NULL (F2)."""
    max_year = F.year(as_of_column(as_of))
    conds = [in_year_range(c, max_year, min_year) for c in columns if c in df.columns]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def filter_paid(df: DataFrame) -> DataFrame:
    """Paid invoices only (F3): payment date present, no open amount, complete = 'Y'."""
    return df.filter(
        F.col("payment_date").isNotNull()
        & not_true(F.col("payment_amount") > 0)
        & (F.col("payment_complete") == "Y")
    )


def filter_stale_open(df: DataFrame, as_of=None) -> DataFrame:
    """Drop unpaid invoices created or invoiced over a year before ``as_of``."""
    year_ago = F.add_months(as_of_column(as_of), -12)
    stale = F.col("payment_date").isNull() & (
        F.coalesce(F.col("create_date") < year_ago, F.lit(False))
        | F.coalesce(F.col("invoice_date") < year_ago, F.lit(False))
    )
    return df.filter(~stale)


def filter_company_amount(df: DataFrame) -> DataFrame:
    """Known company and a non-negative (or missing) amount.

    Rows without customer or company are dropped too: they cannot form a
    pair history (SURVEY §1.4).
    """
    return df.filter(
        (F.col("company_id") != -1)
        & F.col("customer_id").isNotNull()
        & not_true(F.col("net_amount") < 0)
    )


def filter_invoice_before_payment(df: DataFrame) -> DataFrame:
    """F6."""
    return df.filter(F.col("invoice_date") < F.col("payment_date"))


def filter_invoice_before_due(df: DataFrame) -> DataFrame:
    """F7."""
    return df.filter(F.col("invoice_date") < F.col("due_date"))


def clean_invoices(df: DataFrame, as_of=None, drop_settlement_columns: bool = True) -> DataFrame:
    """The whole cleaning chain (F8): F1, F2, F3, F4, F5, F6, F7. The reference date is read once."""
    require_columns(df, CLEANING_COLUMNS)
    as_of = pin_as_of(df.sparkSession, as_of)
    out = (
        parse_dates(df)
        .transform(lambda d: filter_year_range(d, as_of))
        .transform(filter_paid)
        .transform(lambda d: filter_stale_open(d, as_of))
        .transform(filter_company_amount)
    )
    if drop_settlement_columns:
        out = out.drop("payment_amount", "payment_complete")
    return out.transform(filter_invoice_before_payment).transform(filter_invoice_before_due)


ANOMALIES = (
    ("missing_payment_date", lambda: F.col("payment_date").isNull()),
    ("closed_with_open_amount", lambda: (F.col("payment_complete") == "Y") & (F.col("payment_amount") > 0)),
    ("missing_company", lambda: F.col("company_id") == -1),
    ("negative_amount", lambda: F.col("net_amount") < 0),
    ("paid_before_invoiced", lambda: F.col("payment_date") < F.col("invoice_date")),
    ("due_before_invoiced", lambda: F.col("due_date") < F.col("invoice_date")),
)


def anomaly_rows(df: DataFrame) -> DataFrame:
    """One row per (invoice, anomaly) for the six profiling slices.

    A row matching several slices appears once per slice; no shuffle.
    """
    tags = F.array(*[F.when(cond(), F.lit(name)) for name, cond in ANOMALIES])
    return (
        df.withColumn("anomaly", F.explode(F.filter(tags, lambda t: t.isNotNull())))
    )
