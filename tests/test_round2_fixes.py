"""CSV by name, caller columns kept by the scores, shared checkpoint folder on clusters."""

import pytest
from pyspark.sql import functions as F

from arrears import session
from arrears.operators.scoring import finish_scores
from arrears.sources.io import read_invoices_csv


def test_csv_by_name_with_extra_column(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("Extra,COMPANY_ID,invoice_id\nx,7,1\n")
    row = read_invoices_csv(spark, str(path)).first()
    assert (row["extra"], row["company_id"], row["invoice_id"]) == ("x", 7, 1)


def test_finish_scores_keeps_caller_columns(spark):
    from arrears.params import ScoreParams

    names = [c for c, _ in ScoreParams().global_weights]
    df = spark.range(1).withColumns({c: F.lit(1.0) for c in names} | {
        "_g": F.lit(1.0), "is_scorable": F.lit(True), "max_credit": F.lit(9), "min_terms": F.lit(3), "max_invoice_date": F.lit(None)})
    out = finish_scores(df, 2.0)
    assert {"max_credit", "min_terms"} <= set(out.columns) and "max_invoice_date" not in out.columns


def test_no_local_folder_on_a_cluster():
    class Context:
        master, applicationId = "spark://host:7077", "app-none"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_no_chunk_above_twice_its_size(spark):
    """Uneven ids on one day, ids repeated across days, null ids and a day beside it."""
    from arrears.operators.history import CHUNK, assign_chunks, pair_stats

    day = F.date_add(F.lit("2021-01-01").cast("date"), F.when(F.col("i") < 15000, 0).otherwise(F.col("i") % 40).cast("int"))
    df = spark.range(20000).withColumnRenamed("id", "i").select(
        F.lit(1).cast("long").alias("customer_id"), F.lit(1).cast("long").alias("company_id"), day.alias("invoice_date"),
        F.when(F.col("i") % 1000 != 7, F.col("i") * F.col("i") * F.col("i")).alias("invoice_id"))
    chunked, n_hot = assign_chunks(df, pair_stats(df), 1000)
    sizes = [r["count"] for r in chunked.groupBy(*CHUNK).count().collect()]
    assert n_hot == 1 and sum(sizes) == 20000 and max(sizes) <= 2000 and len(sizes) <= 25
    spans = chunked.where("invoice_id is not null").groupBy(*CHUNK).agg(
        F.min(F.struct("invoice_date", "invoice_id")).alias("lo"), F.max(F.struct("invoice_date", "invoice_id")).alias("hi"))
    rows = spans.orderBy("_cday", "_csub").collect()
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(rows, rows[1:]))


def test_block_search_over_many_bounds(spark):
    from arrears.operators.history import BOUND_STEP, _block

    bounds = list(range(10, 10 * (5 * BOUND_STEP + 4), 10))
    df = spark.range(-3, 10 * (5 * BOUND_STEP + 9)).select(
        F.col("id").alias("invoice_id"), F.array(*map(F.lit, bounds)).alias("b"),
        F.array(*map(F.lit, bounds[::BOUND_STEP])).alias("s"))
    for r in df.select("invoice_id", _block("b", "s").alias("block")).collect():
        assert r["block"] == sum(b <= r["invoice_id"] for b in bounds)


def test_quantiles_write_nothing(spark, monkeypatch):
    """Equal and spread values alike are selected by counters alone; no copy of them is written."""
    from arrears.operators import profile

    kept = {}
    write = profile.materialize

    def spy(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(profile, "materialize", spy)
    df = spark.range(5000).select(F.lit(3.0).alias("same"), F.col("id").cast("double").alias("spread"))
    got = {(r["column_name"], r["p"]): r["value"] for r in profile.exact_quantiles(df, ["same", "spread"]).collect()}
    assert got[("same", 0.25)] == got[("same", 0.75)] == 3.0 and got[("spread", 0.5)] == 2499.5
    assert kept == {}


def test_quantiles_and_correlation_of_empty_and_null_columns(spark):
    from arrears.operators.profile import correlation_long, describe_numeric

    none = spark.createDataFrame([], "a double, b double")
    assert [r["count"] for r in describe_numeric(none, ["a", "b"]).collect()] == [0, 0]
    assert correlation_long(none, ["a", "b"]).first()["corr"] is None
    nulls = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, 1.0)], "a double, b double")
    assert correlation_long(nulls, ["a", "b"]).first()["corr"] is None


def test_year_split_prunes_files(spark, tmp_path):
    from arrears.operators.split import split_train
    from arrears.sources.io import read_training_set, write_training_set

    path = str(tmp_path / "ts")
    write_training_set(spark.range(4000).withColumn(
        "invoice_date", F.date_add(F.lit("2017-06-01").cast("date"), (F.col("id") % 3000).cast("int"))), path)
    train = split_train(read_training_set(spark, path))
    filters = [line for line in _plan(train).splitlines() if "PartitionFilters" in line]
    assert filters and all("invoice_year" in line for line in filters)
    assert train.count() == spark.read.parquet(path).where("year(invoice_date) between 2019 and 2022").count()


def test_leak_free_is_one_exchange_without_union(spark):
    from arrears.operators.clean import clean_invoices
    from arrears.operators.features import invoice_features
    from arrears.params import HistoryParams
    from arrears.sources.invoices import invoices_table
    from fixtures import SF001

    out = invoice_features(clean_invoices(invoices_table(spark, SF001)), HistoryParams(include_current=False))
    plan = _plan(out)
    assert plan.count("REPARTITION_BY_COL") == 1 and "Union" not in plan


def test_run_folder_is_cleared(tmp_path):
    """Only this application's own folder goes."""
    import os

    class Conf:
        def get(self, *_):
            return str(tmp_path)

    class Context:
        master, applicationId = "local[1]", "app-clear"

        def getCheckpointDir(self):
            return str(tmp_path)

    class Session:
        sparkContext, conf = Context(), Conf()

    assert session.run_folder(Session()) == os.path.join(str(tmp_path), "run-app-clear")


def test_missing_column_fails_at_once(spark):
    from arrears.operators.clean import clean_invoices

    with pytest.raises(ValueError, match="missing columns"):
        clean_invoices(spark.range(1))


def test_caller_columns_reach_the_training_set(spark, tmp_path):
    from pyspark.sql.types import StructType

    from arrears.operators import ml
    from arrears.operators.open_invoices import open_invoice_rows
    from arrears.plans.preprocess import preprocess
    from arrears.sources.io import read_training_set, write_training_set
    from arrears.params import TRAINING_SET_COLUMNS
    from fixtures import hand_invoices

    invoices = hand_invoices(spark).withColumns({
        "credit_limit": F.col("invoice_id") * 1.5, "note": F.concat(F.lit("n"), "invoice_id"), "global_score": F.lit("own")})
    out = preprocess(invoices, as_of="2026-01-01", drop_unscorable=False)
    assert out.columns == [*TRAINING_SET_COLUMNS, "credit_limit", "note"]
    rows = out.select("invoice_id", "credit_limit", "note", "global_score").collect()
    assert all((r[1], r[2]) == (r[0] * 1.5, f"n{r[0]}") and isinstance(r[3], float) for r in rows) and len(rows) == 9
    features = ml.feature_columns(out)
    assert "credit_limit" in features and "note" not in features and "invoice_date" not in features
    assert {"credit_limit", "note"} <= set(open_invoice_rows(invoices, "2026-01-01").columns)
    write_training_set(out, str(tmp_path / "csv"), "csv")
    back = read_training_set(spark, str(tmp_path / "csv"), "csv", StructType().add("credit_limit", "double"))
    kinds = dict(back.dtypes)
    assert (kinds["credit_limit"], kinds["note"], kinds["payment_bucket"], kinds["due_date"]) == ("double", "string", "int", "date")
    assert sorted(map(tuple, back.select("invoice_id", "credit_limit", "note", "global_score").collect())) == sorted(map(tuple, rows))
