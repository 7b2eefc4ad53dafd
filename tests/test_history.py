"""Ordered pair history: hand-worked values and the hot-pair split path."""

import pytest
from pyspark.sql import functions as F

from arrears.operators.clean import clean_invoices
from arrears.operators.features import invoice_features
from arrears.operators.history import HISTORY_COLUMNS
from arrears.params import HistoryParams
from arrears.sources.invoices import invoices_from_tables
from arrears.schema import INVOICE_SCHEMA
from fixtures import SF01, hand_invoices

PAIR_A = {
    "previous_delay_days": [0, 5, -3, 20, 40],
    "average_delay_days": [5, 1, 7.3333, 15.5, 14.4],
    "number_of_previous_invoices": [0, 1, 2, 3, 4],
    "total_amount_of_previous_invoices": [100, 300, 600, 1000, 1500],
    "average_invoice_amount": [0, 300, 300, 333.3333, 375],
    "payment_deviation": [0, 5.6569, 11.6762, 18.9121, 16.562],
    "delay_days_variance": [0, 5.6569, 11.6762, 18.9121, 16.562],
    "invoice_deviation": [0, 70.7107, 100, 129.0994, 158.1139],
    "has_delayed_payment_last_3": [0, 0, 1, 1, 1],
    "has_early_payment_last_3": [0, 0, 0, 0, 0],
    "delay_days_trend": [0, 0, 0, 11.6667, 4.3333],
    "invoice_amount_trend": [0, 0, 0, 100, 100],
    "maximum_delay_days": [5, 5, 20, 40, 40],
    "overall_delay_days_trend": [5.3] * 5,
    "delay_days_trend_acceleration": [0, 0, 31, -3, -50],
}


def _by_id(df, cols):
    return {r["invoice_id"]: r for r in df.select("invoice_id", *cols).collect()}


@pytest.mark.parametrize("max_rows", [None, 1, 2])
def test_hand_pairs(spark, max_rows):
    params = HistoryParams(max_chunk_rows=max_rows) if max_rows else HistoryParams()
    feats = invoice_features(clean_invoices(hand_invoices(spark), as_of="2026-01-01"), params)
    rows = _by_id(feats, list(PAIR_A) + ["frequency_of_transactions"])
    for col, expected in PAIR_A.items():
        got = [rows[i][col] for i in range(1, 6)]
        assert got == pytest.approx(expected, abs=1e-4), col
    b = [rows[i] for i in (6, 7, 8)]
    assert [r["has_early_payment_last_3"] for r in b] == [0, 0, 1]
    assert [r["has_delayed_payment_last_3"] for r in b] == [0, 0, 0]
    assert [r["maximum_delay_days"] for r in b] == [-5, -2, -1]
    assert [r["overall_delay_days_trend"] for r in b] == pytest.approx([2, 2, 2])
    assert [r["delay_days_trend_acceleration"] for r in b] == [0, 0, -2]
    assert [r["payment_deviation"] for r in b] == pytest.approx([0, 2.1213, 2.0817], abs=1e-4)
    assert [r["invoice_deviation"] for r in b] == pytest.approx([0, 0, 17.3205], abs=1e-4)
    c = rows[9]
    assert c["overall_delay_days_trend"] == 0
    assert c["payment_deviation"] == 0 and c["invoice_deviation"] == 0
    assert c["average_invoice_amount"] == 0 and c["maximum_delay_days"] == 70
    assert [rows[i]["frequency_of_transactions"] for i in range(1, 10)] == [8] * 8 + [1]


@pytest.mark.parametrize("max_rows", [1, 3])
def test_split_pairs_equal_plain_windows(spark, max_rows):
    """Hot pairs cut into day / id-range chunks give the plain-window values."""
    clean = clean_invoices(invoices_from_tables(spark, SF01))
    cols = list(HISTORY_COLUMNS)
    plain = invoice_features(clean, HistoryParams()).select("invoice_id", *cols)
    split = invoice_features(clean, HistoryParams(max_chunk_rows=max_rows)).select(
        "invoice_id", *[F.col(c).alias(f"s_{c}") for c in cols]
    )
    j = plain.join(split, "invoice_id", "full")
    assert j.count() == plain.count() == split.count()
    bad = []
    for c in cols:
        diff = j.filter(
            ~F.coalesce(F.abs(F.col(c) - F.col(f"s_{c}")) <= 1e-6 * (1 + F.abs(F.col(c))), F.lit(False))
            & ~(F.col(c).isNull() & F.col(f"s_{c}").isNull())
        ).count()
        if diff:
            bad.append((c, diff))
    assert not bad


def test_leak_free_history_uses_earlier_rows_only(spark):
    params = HistoryParams(include_current=False)
    feats = invoice_features(clean_invoices(hand_invoices(spark), as_of="2026-01-01"), params)
    rows = _by_id(feats, ["previous_delay_days", "average_delay_days", "maximum_delay_days",
                          "number_of_previous_invoices", "delay_days", "overall_delay_days_trend"])
    # pair A delays 5, -3, 20, 40, 10: each row sees the delays before it only
    assert [rows[i]["average_delay_days"] for i in range(1, 6)] == pytest.approx([0, 5, 1, 22 / 3, 15.5])
    assert [rows[i]["maximum_delay_days"] for i in range(1, 6)] == [0, 5, 5, 20, 40]
    assert [rows[i]["number_of_previous_invoices"] for i in range(1, 6)] == [0, 1, 2, 3, 4]
    assert [rows[i]["previous_delay_days"] for i in range(1, 6)] == [0, 5, -3, 20, 40]
    assert [rows[i]["delay_days"] for i in range(1, 6)] == [5, -3, 20, 40, 10]
    # slope over the first three delays (5, -3, 20) only
    assert rows[4]["overall_delay_days_trend"] == pytest.approx(7.5)


def test_amount_sums_do_not_depend_on_chunks(spark):
    """Equal to the last bit, and to exact decimals, however a pair is cut and its rows arrive."""
    import datetime as dt
    import random
    from decimal import Decimal, getcontext

    from arrears.operators.features import invoice_features
    from arrears.params import HistoryParams

    getcontext().prec = 60
    pick = random.Random(2)
    amounts = [round(pick.uniform(0, 10 ** pick.randrange(1, 8)), 2) for _ in range(400)]
    amounts[50:60] = [None] * 10
    rows = [(i, 1, 1, dt.date(2021, 1, 1) + dt.timedelta(days=i // 7), i % 40 - 10, a) for i, a in enumerate(amounts)]
    pick.shuffle(rows)
    frame = spark.createDataFrame([(i, c, k, d, d, d + dt.timedelta(30), None, d + dt.timedelta(30 + y), 0.0, "Y", a, "EU", "DE", "A")
                                   for i, c, k, d, y, a in rows], INVOICE_SCHEMA)
    columns = ("invoice_id", "total_amount_of_previous_invoices", "average_invoice_amount", "invoice_deviation")
    runs = [sorted(map(tuple, invoice_features(frame.repartition(p), HistoryParams(max_chunk_rows=m)).select(*columns).collect()))
            for p, m in ((1, 10_000), (5, 13), (3, 64))]
    assert runs[0] == runs[1] == runs[2]
    known = [Decimal(str(a)) for a in amounts if a is not None]
    n, s, q = len(known), sum(known), sum(a * a for a in known)
    assert runs[0][-1][1] == float(s) and abs(Decimal(runs[0][-1][3]) / ((n * q - s * s) / (n * (n - 1))).sqrt() - 1) < Decimal("1e-15")
