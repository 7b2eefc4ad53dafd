"""Sources/sinks round trips and the distributed order statistics."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from arrears.operators.clean import parse_dates
from arrears.operators.profile import describe_numeric, exact_quantiles, global_index
from arrears.sources.invoices import invoices_table
from arrears.sources.io import normalize_columns, read_invoices_csv, write_invoices_csv
from fixtures import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_round_trip(spark):
    inv = invoices_table(spark, SF001)
    path = os.path.join(tempfile.mkdtemp(prefix="arrears-test-"), "inv")
    write_invoices_csv(inv.toDF(*[c.upper() for c in inv.columns]), path)
    back = parse_dates(read_invoices_csv(spark, path))
    assert back.columns == inv.columns
    assert _rows(back) == _rows(inv)


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Invoice_ID long, CUSTOMER_id long")
    assert normalize_columns(df).columns == ["invoice_id", "customer_id"]


def test_quantiles_match_pandas_linear(spark):
    inv = invoices_table(spark, SF001).repartition(5)
    cols = ["net_amount", "invoice_id"]
    got = {(r["column_name"], r["p"]): r["value"] for r in exact_quantiles(inv, cols).collect()}
    pdf = inv.select(*cols).toPandas()
    for c in cols:
        for p in (0.25, 0.5, 0.75):
            assert got[(c, p)] == pytest.approx(pdf[c].dropna().quantile(p), rel=1e-12)
    d = {r["column_name"]: r for r in describe_numeric(inv, cols).collect()}
    assert d["net_amount"]["count"] == pdf["net_amount"].count()
    assert d["net_amount"]["std"] == pytest.approx(pdf["net_amount"].std(), rel=1e-9)


def test_global_index_is_a_permutation_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).withColumn("k", (F.col("id") * 7919) % 5003)
    idx = global_index(df, ["k", "id"], "pos").toPandas().sort_values("pos")
    assert list(idx["pos"]) == list(range(5000))
    assert list(idx["k"]) == sorted(idx["k"])


def test_correlation_matches_pandas_with_and_without_nulls(spark):
    from arrears.operators.profile import correlation_long

    inv = invoices_table(spark, SF001).select("invoice_id", "customer_id", "net_amount", "payment_amount")
    pdf = inv.toPandas()
    for frame, cols in ((inv.na.drop(), ["invoice_id", "customer_id", "net_amount"]),
                        (inv, ["invoice_id", "customer_id", "net_amount", "payment_amount"])):
        got = {(r["column_a"], r["column_b"]): r["corr"] for r in correlation_long(frame, cols).collect()}
        ref = (pdf.dropna() if frame is not inv else pdf)[cols].corr()
        for (a, b), v in got.items():
            assert v == pytest.approx(ref.loc[a, b], abs=1e-9), (a, b)


def test_parquet_and_table_scans(spark):
    from arrears.sources.io import read_invoices_parquet

    inv = invoices_table(spark, SF001)
    path = os.path.join(tempfile.mkdtemp(prefix="arrears-test-"), "inv.parquet")
    inv.toDF(*[c.upper() for c in inv.columns]).write.parquet(path)
    by_path = read_invoices_parquet(spark, path)
    assert by_path.columns == inv.columns and by_path.count() == inv.count()
    inv.createOrReplaceTempView("payment_data")
    assert read_invoices_parquet(spark, "payment_data").count() == inv.count()


def test_radix_selected_quantiles_of_hard_columns(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    a = np.round(rng.normal(size=997) * 10.0 ** rng.integers(-300, 300, 997), 3)
    a[::5] = -0.0
    b = np.where(np.arange(997) % 3 == 0, 7.5, rng.integers(-5, 5, 997))  # a third of the rows has one value
    rows = [(float(x), float(y) if i % 4 else None, float("inf") if i % 2 else float("-inf"), None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r["column_name"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b", "c", "d"], (0.0, 0.1, 0.5, 0.99, 1.0)).collect()}
    kept = b[np.arange(997) % 4 > 0]
    for p in (0.0, 0.1, 0.5, 0.99, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(a, p)) and got["b", p] == pytest.approx(np.quantile(kept, p))
    assert got["c", 0.0] == float("-inf") and got["c", 1.0] == float("inf") and not any(c == "d" for c, _ in got)


def test_quantiles_and_correlation_move_no_values(spark):
    from arrears.operators.profile import correlation_long, select_ranks

    df = spark.range(5000).selectExpr("id * 1.0 as a", "cast(id % 7 as double) as b")
    found, counts = select_ranks(df, ["a", "b"], lambda n: {0, n // 2, n - 1})
    assert counts == {0: 5000, 1: 5000} and found[0, 2500] == 2500.0 and found[1, 4999] == 6.0
    one = correlation_long(df.repartition(7), ["a", "b"], groups=3).first()["corr"]
    assert one == pytest.approx(df.corr("a", "b"), abs=1e-12)
    nan = spark.createDataFrame([(1.0, 2.0), (2.0, float("nan")), (3.0, 7.0), (4.0, 1.0)], "a double, b double")
    assert correlation_long(nan, ["a", "b"]).first()["corr"] == pytest.approx(nan.filter("not isnan(b)").corr("a", "b"))


def test_dependency_violations(spark):
    from arrears.operators.profile import dependency_violations

    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "b"), (3, None)], "x int, y string")
    assert dependency_violations(one, "x", "y").count() == 0
    rows = one.unionAll(spark.createDataFrame([(2, "c"), (4, "a")], "x int, y string"))
    got = sorted(map(tuple, dependency_violations(rows, "x", "y").collect()))
    assert got == [("x->y", "2", 2, "b", "c"), ("y->x", "a", 3, "1", "4")]
    assert dependency_violations(rows.filter("false"), "x", "y").count() == 0


def test_types_of_unknown_csv_columns(spark, tmp_path):
    from arrears.operators import ml
    from arrears.sources import infer_types, rejected_rows

    texts = spark.createDataFrame([("1", "1.5", "true", "2021-02-03", "7", None, "9" * 30), (" 22 ", "3", "FALSE", "2021-12-31", "x", "", "1"),
                                   ("", None, "", "", "8", None, "2")], "a string, b string, c string, d string, e string, f string, g string")
    assert infer_types(texts, texts.columns) == {"a": "bigint", "b": "double", "c": "boolean", "d": "date", "e": "string", "f": "string", "g": "double"}
    path = str(tmp_path / "inv.csv")
    inv = invoices_table(spark, SF001).limit(50)
    write_invoices_csv(inv.withColumn("Credit Limit", (F.col("invoice_id") * 1.5).cast("string")).withColumn("memo", F.lit("n/a")), path)
    back = read_invoices_csv(spark, path)
    kinds = dict(back.dtypes)
    assert kinds["credit limit"] == "double" and kinds["memo"] == "string"
    assert "credit limit" in ml.feature_columns(back) and "memo" not in ml.feature_columns(back)
    assert back.filter(F.col("`credit limit`") != F.col("invoice_id") * 1.5).count() == 0
    assert dict(read_invoices_csv(spark, path, infer=False).dtypes)["credit limit"] == "string"
    assert rejected_rows(spark, path).count() == 0
    bad = tmp_path / "bad.csv"
    bad.write_text("INVOICE_ID,customer_id,net_amount,memo\n1,2,3.5,a\nx1,2,3.5,b\n3,,much,c\n")
    got = [tuple(r["reasons"]) for r in rejected_rows(spark, str(bad)).collect()]
    assert got == [("invoice_id: x1",), ("net_amount: much",)]
