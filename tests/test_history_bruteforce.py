"""Pair history vs a brute-force pandas computation on random pairs.

The brute force follows the definitions literally (expanding / rolling over
each pair's ordered rows, a least-squares fit for the overall trend); Spark
runs the plain path and the chunked path with every pair split.
"""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from arrears.operators.clean import clean_invoices
from arrears.operators.features import invoice_features
from arrears.params import HistoryParams
from arrears.schema import INVOICE_SCHEMA

COLS = ["previous_delay_days", "average_delay_days", "number_of_previous_invoices",
        "total_amount_of_previous_invoices", "average_invoice_amount", "payment_deviation",
        "invoice_deviation", "has_delayed_payment_last_3", "has_early_payment_last_3", "delay_days_trend",
        "invoice_amount_trend", "maximum_delay_days", "overall_delay_days_trend",
        "delay_days_trend_acceleration", "delay_days_variance", "frequency_of_transactions",
        "running_delay_days_trend"]


def random_invoices(seed=7, n=600):
    rng = np.random.default_rng(seed)
    rows = []
    base = dt.date(2021, 1, 1)
    for iid in range(1, n + 1):
        cust = int(rng.integers(1, 25))
        comp = int(rng.integers(0, 3))
        inv = base + dt.timedelta(days=int(rng.integers(0, 40)))  # many same-day invoices
        due = inv + dt.timedelta(days=30)
        pay = due + dt.timedelta(days=int(rng.integers(-25, 90)))
        amount = None if rng.random() < 0.12 else float(np.round(rng.uniform(10, 5000), 2))
        rows.append((iid, cust, comp, inv, inv, due, None, pay, 0.0, "Y", amount, "R", "N", "S"))
    return rows


def brute_force(rows, rolling=3):
    df = pd.DataFrame(rows, columns=[f.name for f in INVOICE_SCHEMA.fields])
    df["y"] = [(p - d).days for p, d in zip(df.payment_date, df.due_date)]
    df = df.sort_values(["customer_id", "company_id", "invoice_date", "invoice_id"])
    out = []
    for _, g in df.groupby(["customer_id", "company_id"], sort=False):
        y, a = g["y"].astype(float), g["net_amount"].astype(float)
        n = len(g)
        r = pd.DataFrame({"invoice_id": g["invoice_id"].values})
        r["previous_delay_days"] = y.shift().fillna(0).values
        r["average_delay_days"] = y.expanding().mean().values
        r["number_of_previous_invoices"] = np.arange(n)
        tot = a.expanding().sum().values
        r["total_amount_of_previous_invoices"] = tot
        r["average_invoice_amount"] = [0.0 if i == 0 else tot[i] / i for i in range(n)]
        r["payment_deviation"] = y.expanding().std().fillna(0).values
        r["invoice_deviation"] = a.expanding().std().fillna(0).values
        latest = y.rolling(rolling).max()
        r["has_delayed_payment_last_3"] = (latest > 0).astype(int).values
        r["has_early_payment_last_3"] = (latest < 0).astype(int).values
        r["delay_days_trend"] = y.rolling(rolling).mean().diff().fillna(0).values
        r["invoice_amount_trend"] = a.rolling(rolling).mean().diff().fillna(0).values
        r["maximum_delay_days"] = y.expanding().max().values
        r["overall_delay_days_trend"] = np.polyfit(np.arange(n), y.values, 1)[0] if n > 1 else 0.0
        r["running_delay_days_trend"] = [
            np.polyfit(np.arange(i + 1), y.values[: i + 1], 1)[0] if i > 0 else 0.0 for i in range(n)]
        r["delay_days_trend_acceleration"] = y.diff().diff().fillna(0).values
        r["delay_days_variance"] = r["payment_deviation"]
        out.append(r)
    res = pd.concat(out)
    freq = df.groupby("customer_id")["invoice_id"].count()
    res["frequency_of_transactions"] = df.set_index("invoice_id").loc[res.invoice_id, "customer_id"].map(freq).values
    return res.set_index("invoice_id")


@pytest.mark.parametrize("max_rows, rolling", [(None, 3), (1, 3), (4, 3), (None, 5), (1, 5), (4, 1), (3, 2)])
def test_history_matches_brute_force(spark, max_rows, rolling):
    rows = random_invoices()
    params = HistoryParams(max_chunk_rows=max_rows, rolling_rows=rolling)
    inv = spark.createDataFrame(rows, INVOICE_SCHEMA)
    got = invoice_features(clean_invoices(inv, as_of="2026-01-01"), params).select("invoice_id", *COLS).toPandas()
    got = got.set_index("invoice_id").sort_index()
    exp = brute_force(rows, rolling).sort_index()
    assert len(got) == len(exp) == len(rows)
    for c in COLS:
        a, b = got[c].astype(float).values, exp[c].astype(float).values
        both_nan = np.isnan(a) & np.isnan(b)
        ok = both_nan | np.isclose(a, b, rtol=1e-9, atol=1e-7)
        assert ok.all(), (c, got.index[~ok][:5].tolist(), a[~ok][:5], b[~ok][:5])


@pytest.mark.parametrize("max_rows, rolling", [(None, 4), (1, 4), (2, 1)])
def test_leak_free_rolling_is_the_row_before(spark, max_rows, rolling):
    inv = clean_invoices(spark.createDataFrame(random_invoices(), INVOICE_SCHEMA), as_of="2026-01-01")
    cols = ["delay_days_trend", "invoice_amount_trend", "has_delayed_payment_last_3", "has_early_payment_last_3", "delay_days_trend_acceleration"]
    keys = ["customer_id", "company_id", "invoice_date", "invoice_id"]
    whole = invoice_features(inv, HistoryParams(rolling_rows=rolling)).select(*keys, *cols).toPandas().sort_values(keys)
    want = whole.groupby(keys[:2])[cols].shift().fillna(0).astype(float)
    free = invoice_features(inv, HistoryParams(include_current=False, rolling_rows=rolling, max_chunk_rows=max_rows))
    got = free.select(*keys, *cols).toPandas().sort_values(keys)[cols].fillna(0).astype(float)
    assert np.allclose(got.values, want.values)
