
import pytest

from arrears.operators.evaluate import counts_from_matrix, metrics_from_counts, per_class_metrics_from_counts

MATRIX = [
    [140619, 2794, 128, 45, 78],
    [2394, 10141, 750, 79, 75],
    [210, 868, 2863, 319, 111],
    [58, 79, 276, 898, 273],
    [38, 14, 25, 100, 1040],
]


def test_macro_metrics_match_published(spark):
    m = metrics_from_counts(counts_from_matrix(spark, MATRIX)).first()
    assert m["accuracy"] == pytest.approx(0.946955, abs=1e-6)
    assert m["precision"] == pytest.approx(0.740382, abs=1e-6)
    assert m["recall"] == pytest.approx(0.761976, abs=1e-6)
    assert m["f1"] == pytest.approx(0.748149, abs=1e-6)
    r = metrics_from_counts(counts_from_matrix(spark, MATRIX), digits=2).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.95, 0.74, 0.76, 0.75)


def test_per_class_metrics(spark):
    rows = {r["class"]: r for r in per_class_metrics_from_counts(counts_from_matrix(spark, MATRIX)).collect()}
    expected = {
        "0": (0.981161, 0.978805, 0.979981, 143664),
        "1": (0.729778, 0.754595, 0.741979, 13439),
        "2": (0.708313, 0.654999, 0.680613, 4371),
        "3": (0.623178, 0.566919, 0.593719, 1584),
        "4": (0.659480, 0.854560, 0.744452, 1217),
    }
    for k, (p, r, f, n) in expected.items():
        row = rows[k]
        assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((p, r, f), abs=1e-6)
        assert row["support"] == n
    assert rows["macro avg"]["support"] == 164275
    assert rows["weighted avg"]["recall"] == pytest.approx(0.946955, abs=1e-6)


def test_zero_denominator_is_zero(spark):
    m = metrics_from_counts(counts_from_matrix(spark, [[5, 0], [3, 0]])).first()
    assert m["precision"] == pytest.approx((5 / 8 + 0) / 2)
