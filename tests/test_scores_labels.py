"""Scores (FIXTURES.md §5 table), bucket edges, labels and score properties."""

import pytest
from pyspark.sql import functions as F

from arrears.functions.columns import bucket_label, payment_bucket
from arrears.operators.label import region_codes
from arrears.plans.preprocess import features_table, preprocess, scored_table
from fixtures import hand_invoices

# invoice -> (recency, frequency, risk, value, cash flow, historical, global)
EXPECTED = {
    1: (142, 8, 3.5193, 2.1579, 5.8105, 9.6667, 9.5046),
    2: (111, 8, 5.2284, 4.7603, 5.4942, 7.3829, 9.3888),
    3: (83, 8, 7.2001, 5.7205, 4.7071, 6.6667, 9.5958),
    4: (52, 8, 7.0771, 6.9006, 3.6537, 1.6108, 6.2708),
    5: (22, 8, 7.7564, 8.1112, 4.4915, 2.3591, 7.6553),
    6: (132, 8, 4.6226, 2.1408, 6.0000, 10.0000, 9.9324),
    7: (101, 8, 5.0193, 3.3608, 5.6035, 8.6571, 9.5898),
    8: (73, 8, 5.3349, 4.0466, 5.7028, 8.6418, 10.0000),
    9: (0, 1, 2.0000, 5.0000, 7.0000, 7.5000, 9.2284),
}
COLS = ["recency_days", "frequency_of_transactions", "risk_tolerance_score", "customer_value_score",
        "cash_flow_score", "historical_score", "global_score"]


def test_hand_scores(spark):
    s = scored_table(features_table(hand_invoices(spark), as_of="2026-01-01"))
    got = {r["invoice_id"]: tuple(r[c] for c in COLS) for r in s.select("invoice_id", *COLS).collect()}
    for iid, exp in EXPECTED.items():
        assert got[iid] == pytest.approx(exp, abs=1e-4), iid


def test_bucket_edges(spark):
    delays = [15, 16, 30, 31, 45, 46, 60, 61, -3, None]
    df = spark.createDataFrame([(d,) for d in delays], "d int")
    got = [r[0] for r in df.select(payment_bucket("d")).collect()]
    assert got == [0, 1, 1, 2, 2, 3, 3, 4, 0, None]
    labels = [r[0] for r in spark.range(6).select(bucket_label(F.col("id"))).collect()]
    assert labels == ["0-15days", "15-30days", "30-45days", "45-60days", "60days", "5"]


def test_region_codes_sorted_null_last_minus_one(spark):
    df = spark.createDataFrame([(1, "b", "x", None), (2, "a", None, "z"), (3, "b", "y", "z")],
                               "invoice_id long, region_level1 string, region_level2 string, region_level3 string")
    got = {r[0]: tuple(r[1:]) for r in region_codes(df).select("invoice_id", "region_level1", "region_level2",
                                                                "region_level3").collect()}
    assert got == {1: (1, 0, -1), 2: (0, -1, 0), 3: (1, 1, 0)}


def test_score_properties(spark):
    from fixtures import SF001
    from arrears.sources.invoices import invoices_table

    s = scored_table(features_table(invoices_table(spark, SF001)))
    five = ["risk_tolerance_score", "customer_value_score", "cash_flow_score", "historical_score", "global_score"]
    # -1 together or not at all
    mixed = s.filter(
        (F.greatest(*[(F.col(c) == -1).cast("int") for c in five]) == 1)
        & (F.least(*[(F.col(c) == -1).cast("int") for c in five]) == 0)
    ).count()
    assert mixed == 0
    assert s.filter("is_scorable").agg(F.max("global_score")).first()[0] == pytest.approx(10.0)
    assert s.filter((F.col("has_early_payment_last_3") == 1) & (F.col("has_delayed_payment_last_3") == 1)).count() == 0


def test_constant_column_empties_training_set(spark):
    inv = hand_invoices(spark).withColumn("net_amount", F.lit(100.0))
    with pytest.warns(UserWarning):
        ts = preprocess(inv, as_of="2026-01-01")
    assert ts.count() == 0
