"""Feature groups: behaviour (C1-C3, W1-W11, A13), season and trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import discount_offered, delay_days
from ..params import HistoryParams
from .history import history_features


def add_delay_columns(df: DataFrame) -> DataFrame:
    """``discount_offered`` replaces ``due_discount_date``; ``delay_days`` in days."""
    out = df.withColumns({
        "discount_offered": discount_offered("due_discount_date"),
        "delay_days": delay_days("payment_date", "due_date"),
    })
    return out.drop("due_discount_date")


def due_date_parts(df: DataFrame, c: str = "due_date") -> DataFrame:
    """Month, quarter, weekday (Monday = 0) and three 0/1 season flags."""
    m = F.month(c)
    return df.withColumns({
        "due_date_month": m,
        "due_date_quarter": F.quarter(c),
        "due_date_dayofweek": F.weekday(c),
        "due_date_is_year_end": (m == 12).cast("int"),
        "due_date_is_year_start": (m == 1).cast("int"),
        "due_date_is_summer": m.isin(6, 7, 8).cast("int"),
    })


def invoice_features(clean: DataFrame, params: HistoryParams = HistoryParams()) -> DataFrame:
    """All 22 engineered features plus ``delay_days`` and ``frequency_of_transactions``."""
    return (
        clean.transform(add_delay_columns)
        .transform(lambda d: history_features(d, params))
        .transform(due_date_parts)
    )
