"""Plan shape: one exchange for the history, filters pushed to the scan, no Python UDFs."""

from arrears.operators.clean import clean_invoices
from arrears.params import HistoryParams
from arrears.plans.preprocess import features_table
from arrears.sources.invoices import invoices_table
from fixtures import SF001


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_history_single_exchange_and_no_python(spark):
    inv = invoices_table(spark, SF001)
    plan = _plan(features_table(inv, persist=False))
    exchanges = [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 1, plan
    assert "SinglePartition" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_hot_path_shuffles_fact_rows_once(spark):
    inv = invoices_table(spark, SF001)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(features_table(inv, history=HistoryParams(max_chunk_rows=2), persist=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    repartitions = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    # the same exchange appears in both branches and is reused at run time
    assert 1 <= len(repartitions) <= 2
    assert "SinglePartition" not in plan


def test_cleaning_filters_reach_the_scan(spark):
    inv = invoices_table(spark, SF001)
    plan = _plan(clean_invoices(inv))
    assert "PushedFilters: [" in plan and "EqualTo(payment_complete,Y)" in plan
