
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from arrears.operators.clean import clean_invoices
from arrears.operators.evaluate import counts_from_matrix, metrics_from_counts
from arrears.operators.features import invoice_features
from arrears.operators.history import HISTORY_COLUMNS
from arrears.operators.split import split_test, split_train
from arrears.plans.preprocess import preprocess
from arrears.sources.invoices import invoices_table
from fixtures import SF001

PAIR = ["customer_id", "company_id"]


@pytest.fixture(scope="module")
def feats(spark):
    return invoice_features(clean_invoices(invoices_table(spark, SF001))).cache()


def test_repartitioning_the_input_changes_nothing(spark, feats):
    inv = invoices_table(spark, SF001)
    again = invoice_features(clean_invoices(inv.repartition(7, "invoice_id").sortWithinPartitions(F.rand(3))))
    cols = ["invoice_id", *HISTORY_COLUMNS]
    a = sorted(tuple(r) for r in feats.select(*cols).collect())
    b = sorted(tuple(r) for r in again.select(*cols).collect())
    assert a == b


def test_positions_and_running_max(feats):
    w = Window.partitionBy(*PAIR).orderBy("invoice_date", "invoice_id")
    chk = feats.select(
        (F.col("number_of_previous_invoices") == F.row_number().over(w) - 1).alias("pos_ok"),
        (F.col("maximum_delay_days") >= F.coalesce(F.lag("maximum_delay_days").over(w),
                                                     F.col("maximum_delay_days"))).alias("max_ok"),
        (F.col("maximum_delay_days") >= F.col("delay_days")).alias("max_ge"),
    )
    assert chk.filter(~F.col("pos_ok") | ~F.col("max_ok") | ~F.col("max_ge")).count() == 0


def test_flags_exclusive_and_binary(feats):
    assert feats.filter((F.col("has_early_payment_last_3") + F.col("has_delayed_payment_last_3")) > 1).count() == 0
    assert feats.filter(F.col("payment_deviation") < 0).count() == 0


def test_splits_disjoint_by_year(spark):
    ts = preprocess(invoices_table(spark, SF001))
    tr, te = split_train(ts), split_test(ts)
    assert tr.join(te, "invoice_id").count() == 0
    assert tr.agg(F.max(F.year("invoice_date"))).first()[0] < te.agg(F.min(F.year("invoice_date"))).first()[0]


def _macro(matrix):
    m = np.array(matrix, dtype=float)
    tp = np.diag(m)
    labels = [k for k in range(len(m)) if m[k].sum() > 0 or m[:, k].sum() > 0]
    p = np.array([tp[k] / m[:, k].sum() if m[:, k].sum() else 0.0 for k in labels])
    r = np.array([tp[k] / m[k].sum() if m[k].sum() else 0.0 for k in labels])
    f = np.array([2 * a * b / (a + b) if a + b else 0.0 for a, b in zip(p, r)])
    return tp.sum() / m.sum(), p.mean(), r.mean(), f.mean()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), min_size=4, max_size=4), min_size=4, max_size=4))
def test_macro_metrics_random(spark, matrix):
    if sum(map(sum, matrix)) == 0:
        return
    got = metrics_from_counts(counts_from_matrix(spark, matrix).filter("n > 0")).first()
    acc, p, r, f = _macro(matrix)
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"]) == pytest.approx((acc, p, r, f))
