"""Folders of the generated tables and the hand-worked pairs of FIXTURES.md §5 as a Spark DataFrame."""

from __future__ import annotations

import datetime as dt

from arrears.schema import INVOICE_SCHEMA

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# (invoice_id, customer, company, invoice_date, delay, amount)
HAND_ROWS = [
    (1, 1, 1, "2021-01-10", 5, 100.0),
    (2, 1, 1, "2021-02-10", -3, 200.0),
    (3, 1, 1, "2021-03-10", 20, 300.0),
    (4, 1, 1, "2021-04-10", 40, 400.0),
    (5, 1, 1, "2021-05-10", 10, 500.0),
    (6, 1, 2, "2021-01-20", -5, 50.0),
    (7, 1, 2, "2021-02-20", -2, 50.0),
    (8, 1, 2, "2021-03-20", -1, 80.0),
    (9, 2, 1, "2021-06-01", 70, 1000.0),
]


def hand_invoices(spark):
    rows = []
    for iid, cust, comp, d, delay, amount in HAND_ROWS:
        inv = dt.date.fromisoformat(d)
        due = inv + dt.timedelta(days=30)
        pay = due + dt.timedelta(days=delay)
        rows.append((iid, cust, comp, inv, inv, due, None, pay, 0.0, "Y", amount, "EU", "DE", "A"))
    return spark.createDataFrame(rows, INVOICE_SCHEMA)
