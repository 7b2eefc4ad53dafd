"""Open invoices: the as-of state, plain and with hot pairs split into chunks."""

import pytest
from pyspark.sql import functions as F

from arrears.operators.open_invoices import open_invoice_features, open_invoice_rows
from arrears.params import HistoryParams
from arrears.plans.preprocess import features_table
from arrears.sources.invoices import invoices_table
from fixtures import SF01

COLS = ["previous_delay_days", "average_delay_days", "number_of_previous_invoices",
        "overall_delay_days_trend", "payment_deviation", "invoice_deviation", "maximum_delay_days",
        "has_delayed_payment_last_3", "frequency_of_transactions"]


@pytest.mark.parametrize("max_rows", [2])
def test_chunked_as_of_equals_plain(spark, max_rows):
    inv = invoices_table(spark, SF01)
    feats = features_table(inv)
    rows = open_invoice_rows(inv)
    plain = open_invoice_features(feats, rows).select("invoice_id", *COLS)
    split = open_invoice_features(feats, rows, HistoryParams(max_chunk_rows=max_rows)).select(
        "invoice_id", *[F.col(c).alias(f"s_{c}") for c in COLS])
    j = plain.join(split, "invoice_id", "full")
    assert j.count() == plain.count() == rows.count() > 0
    for c in COLS:
        bad = j.filter(~F.coalesce(F.abs(F.col(c) - F.col(f"s_{c}")) <= 1e-9, F.lit(False))).count()
        assert bad == 0, c


def test_open_rows_have_no_delay_and_known_history(spark):
    inv = invoices_table(spark, SF01)
    f = open_invoice_features(features_table(inv), open_invoice_rows(inv))
    assert f.filter(F.col("delay_days").isNotNull()).count() == 0
    assert f.filter(F.col("number_of_previous_invoices") > 0).count() > 0
