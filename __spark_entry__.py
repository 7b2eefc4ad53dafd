"""

Every query reads the generated tables under ``sf_dir`` (or tables Spark
derives from them) and returns a DataFrame whose columns are brought to a
canonical form (integers as bigint, doubles rounded to 4 places, or to 6
significant digits for long chunked sums, dates as date) so they hash
identically to the DuckDB twin in ``oracle.py``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from itertools import combinations

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle as O  # noqa: E402
from arrears.functions.columns import bucket_label, minmax, payment_bucket  # noqa: E402
from arrears.operators import clean as C  # noqa: E402
from arrears.operators import ml  # noqa: E402
from arrears.operators.clean import parse_dates  # noqa: E402
from arrears.operators.evaluate import classification_metrics, confusion_matrix, per_class_metrics  # noqa: E402
from arrears.operators.features import invoice_features  # noqa: E402
from arrears.operators.history import HISTORY_COLUMNS  # noqa: E402
from arrears.operators.label import add_payment_bucket, region_codes  # noqa: E402
from arrears.operators.open_invoices import open_invoice_features, open_invoice_rows  # noqa: E402
from arrears.operators.profile import (  # noqa: E402
    correlation_long,
    dependency_violations,
    describe_numeric,
    head_invoices,
    invoices_per_year,
    null_counts,
    pair_sizes,
    sorted_invoices,
    table_info,
    value_counts,
)
from arrears.operators.scoring import add_recency, bounds_row, filter_scorable, score_bounds, with_bounds  # noqa: E402
from arrears.operators.search import search_boosting  # noqa: E402
from arrears.operators.split import (  # noqa: E402
    add_class_weight,
    class_weights,
    split_open_invoices,
    split_production_train,
    split_test,
    split_train,
    training_projection,
)
from arrears.params import (  # noqa: E402
    BUCKET_LABELS,
    DATE_COLUMNS,
    NON_FEATURE_COLUMNS,
    TRAINING_SET_COLUMNS,
    HistoryParams,
)
from arrears.plans.pipeline import run_pipeline  # noqa: E402
from arrears.plans.preprocess import features_table, scored_table  # noqa: E402
from arrears.plans.serve import fit_scoring_context, score_open_invoices  # noqa: E402
from arrears.plans.train import prepare_splits, train  # noqa: E402
from arrears.schema import INVOICE_SCHEMA, TRAINING_SET_SCHEMA  # noqa: E402
from arrears.session import ensure_checkpoint_dir  # noqa: E402
from arrears.sources.invoices import invoices_table, with_hot_day, with_hot_pair  # noqa: E402
from arrears.sources.io import (  # noqa: E402
    normalize_columns,
    read_invoices_csv,
    read_predictions,
    read_training_set,
    write_invoices_csv,
    write_labelled_predictions,
    write_predictions,
    write_training_set,
)
from arrears.streaming.scoring import run_stream_predictions  # noqa: E402

I, D, T, S, B, G = O.I, O.D, O.T, O.S, O.B, O.G
FLAGSHIP_SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------
# canonical output
# ---------------------------------------------------------------------------


def canon(df: DataFrame, spec) -> DataFrame:
    cols = []
    for name, kind in spec:
        c = F.col(name)
        if kind == I:
            c = c.cast("bigint")
        elif kind == D:
            y = c.cast("double") * F.lit(10000.0)
            c = F.round(y + F.abs(y) * F.lit(1e-11)) / F.lit(10000.0) + F.lit(0.0)
        elif kind == G:
            x = c.cast("double")
            k = F.lit(5) - F.floor(F.log10(F.abs(x)))
            c = F.when(x.isNull() | (x == 0), x).when(
                k >= 0, F.round(x * F.pow(F.lit(10.0), k)) / F.pow(F.lit(10.0), k)
            ).otherwise(F.round(x / F.pow(F.lit(10.0), -k)) * F.pow(F.lit(10.0), -k)) + F.lit(0.0)
        elif kind == T:
            c = c.cast("date")
        elif kind == B:
            c = c.cast("boolean")
        else:
            c = c.cast("string")
        cols.append(c.alias(name))
    return df.select(*cols)


def _kind(dtype) -> str:
    name = dtype.typeName()
    if name in ("integer", "long", "short", "byte"):
        return I
    if name in ("double", "float", "decimal"):
        return D
    if name == "date":
        return T
    if name == "boolean":
        return B
    return S


INVOICE_SPEC = [(f.name, _kind(f.dataType)) for f in INVOICE_SCHEMA.fields]
CLEAN_SPEC = [(n, k) for n, k in INVOICE_SPEC if n not in ("payment_amount", "payment_complete")]
TRAINING_SPEC = [(f.name, _kind(f.dataType)) for f in TRAINING_SET_SCHEMA.fields]

# ---------------------------------------------------------------------------
# shared derived tables (memoised per session and folder)
# ---------------------------------------------------------------------------
_MEMO: dict = {}


def _memo(spark: SparkSession, sf_dir: str, key: str, build):
    k = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def invoices(spark, sf):
    ensure_checkpoint_dir(spark)
    return _memo(spark, sf, "invoices", lambda: invoices_table(spark, sf))


def cleaned(spark, sf):
    return C.clean_invoices(invoices(spark, sf))


def features(spark, sf):
    ensure_checkpoint_dir(spark)
    return _memo(spark, sf, "features", lambda: features_table(invoices(spark, sf)))


def scored(spark, sf):
    return _memo(spark, sf, "scored", lambda: scored_table(features(spark, sf)))


def training_set(spark, sf):
    """X1's output, written once (as the original writes it for the training step)."""
    def build():
        kept = filter_scorable(scored(spark, sf))
        ts = kept.transform(region_codes).transform(add_payment_bucket).select(*TRAINING_SET_COLUMNS)
        path = _scratch(spark, "training-set")
        write_training_set(ts, path)
        return read_training_set(spark, path)

    return _memo(spark, sf, "training_set", build)


# ---------------------------------------------------------------------------
# registry: name -> (spark builder, canonical spec, oracle SELECT or None)
# ---------------------------------------------------------------------------
REGISTRY: dict[str, tuple[Callable, list, str | None]] = {}


def register(name: str, spec, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, spec, sql)
        return fn

    return deco


@register("training_set", TRAINING_SPEC, "SELECT * FROM ts")
def q_training_set(spark, sf):
    return training_set(spark, sf)


@register("bucket_summary", [("payment_bucket", I), ("n_invoices", I), ("avg_delay_days", D)],
          "SELECT payment_bucket, count(*) AS n_invoices, avg(average_delay_days) AS avg_delay_days "
          "FROM ts GROUP BY payment_bucket")
def q_bucket_summary(spark, sf):
    return training_set(spark, sf).groupBy("payment_bucket").agg(
        F.count(F.lit(1)).alias("n_invoices"), F.avg("average_delay_days").alias("avg_delay_days")
    )


@register("clean_invoices", CLEAN_SPEC, "SELECT * FROM clean")
def q_clean(spark, sf):
    return cleaned(spark, sf)


FEATURE_KINDS = {
    "discount_offered": I, "delay_days": I, "previous_delay_days": I, "average_delay_days": D,
    "number_of_previous_invoices": I, "total_amount_of_previous_invoices": D, "average_invoice_amount": D,
    "payment_deviation": D, "invoice_deviation": D, "has_delayed_payment_last_3": I,
    "has_early_payment_last_3": I, "delay_days_trend": D, "invoice_amount_trend": D,
    "maximum_delay_days": I, "overall_delay_days_trend": D, "delay_days_trend_acceleration": I,
    "delay_days_variance": D, "frequency_of_transactions": I, "running_delay_days_trend": D,
}


def _feature_query(col: str, kind: str):
    def fn(spark, sf):
        return features(spark, sf).select("invoice_id", col)

    register(col, [("invoice_id", I), (col, kind)], f"SELECT invoice_id, {col} FROM feat")(fn)


for _c, _k in FEATURE_KINDS.items():
    _feature_query(_c, _k)


# --- scans and sources (IO1-IO4) ---------------------------------------------


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@register("scan_invoices", INVOICE_SPEC, "SELECT * FROM inv")
def q_scan_invoices(spark, sf):
    return normalize_columns(invoices(spark, sf))


@register("normalize_columns", INVOICE_SPEC, "SELECT * FROM inv")
def q_normalize_columns(spark, sf):
    upper = invoices(spark, sf)
    return normalize_columns(upper.toDF(*[c.upper() for c in upper.columns]))


@register("scan_invoices_csv", INVOICE_SPEC, "SELECT * FROM inv")
def q_scan_invoices_csv(spark, sf):
    def build():
        path = _scratch(spark, "invoices-csv")
        write_invoices_csv(invoices(spark, sf), path)
        return path

    path = _memo(spark, sf, "invoices_csv", build)
    return parse_dates(read_invoices_csv(spark, path))


@register("csv_extra_column_types", [("invoice_id", I), ("credit_limit", D), ("flagged", B), ("is_feature", B)],
          "SELECT invoice_id, invoice_id * 1.5 AS credit_limit, invoice_id % 2 = 0 AS flagged, true AS is_feature FROM inv")
def q_csv_extra_column_types(spark, sf):
    """IO1: columns that the schema does not know get their type from their values and become features."""
    path = _scratch(spark, "inv-extra-csv")
    extra = {"credit_limit": (F.col("invoice_id") * 1.5).cast("string"), "flagged": (F.col("invoice_id") % 2 == 0).cast("string")}
    write_invoices_csv(invoices(spark, sf).withColumns(extra), path)
    rows = read_invoices_csv(spark, path)
    return rows.withColumn("is_feature", F.lit({"credit_limit", "flagged"} <= set(ml.feature_columns(rows))))


@register("parse_dates", INVOICE_SPEC, "SELECT * FROM inv")
def q_parse_dates(spark, sf):
    inv = invoices(spark, sf)
    as_text = inv.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in DATE_COLUMNS})
    return parse_dates(as_text)


@register("write_training_set", TRAINING_SPEC, "SELECT * FROM ts")
def q_write_training_set(spark, sf):
    path = _scratch(spark, "training-set")
    write_training_set(training_set(spark, sf), path)
    return read_training_set(spark, path).drop("invoice_year")


@register("scan_training_set_csv", TRAINING_SPEC, "SELECT * FROM ts")
def q_scan_training_set_csv(spark, sf):
    path = _scratch(spark, "training-set-csv")
    write_training_set(training_set(spark, sf), path, fmt="csv")
    return read_training_set(spark, path, fmt="csv")


# --- filters (F2-F7, F12) ------------------------------------------------------
def _filter_query(name, fn, where):
    register(name, INVOICE_SPEC, f"SELECT * FROM inv WHERE {where}")(lambda spark, sf: fn(invoices(spark, sf)))


_filter_query("filter_year_range", C.filter_year_range, O.YEAR_OK)
_filter_query("filter_paid", C.filter_paid, O.PAID_OK)
_filter_query("filter_stale_open", C.filter_stale_open, f"NOT ({O.STALE})")
_filter_query("filter_company_amount", C.filter_company_amount, O.COMPANY_OK)
_filter_query("filter_invoice_before_payment", C.filter_invoice_before_payment, "invoice_date < payment_date")
_filter_query("filter_invoice_before_due", C.filter_invoice_before_due, "invoice_date < due_date")

ANOMALY_SQL = " UNION ALL ".join(
    f"SELECT invoice_id, '{name}' AS anomaly FROM inv WHERE {cond}" for name, cond in (
        ("missing_payment_date", "payment_date IS NULL"),
        ("closed_with_open_amount", "payment_complete = 'Y' AND payment_amount > 0"),
        ("missing_company", "company_id = -1"),
        ("negative_amount", "net_amount < 0"),
        ("paid_before_invoiced", "payment_date < invoice_date"),
        ("due_before_invoiced", "due_date < invoice_date"),
    )
)


@register("anomaly_rows", [("invoice_id", I), ("anomaly", S)], ANOMALY_SQL)
def q_anomaly_rows(spark, sf):
    return C.anomaly_rows(invoices(spark, sf)).select("invoice_id", "anomaly")


# --- column features (C4-C8) ---------------------------------------------------
@register("due_date_parts", [("invoice_id", I), ("due_date_month", I), ("due_date_quarter", I),
                             ("due_date_dayofweek", I)],
          "SELECT invoice_id, due_date_month, due_date_quarter, due_date_dayofweek FROM feat")
def q_due_date_parts(spark, sf):
    return features(spark, sf)


@register("due_date_flags", [("invoice_id", I), ("due_date_is_year_end", I), ("due_date_is_year_start", I),
                             ("due_date_is_summer", I)],
          "SELECT invoice_id, due_date_is_year_end, due_date_is_year_start, due_date_is_summer FROM feat")
def q_due_date_flags(spark, sf):
    return features(spark, sf)


@register("weighted_trend", [("invoice_id", I), ("weighted_delay_days_trend", D)],
          "SELECT invoice_id, weighted_delay_days_trend FROM feat")
def q_weighted_trend(spark, sf):
    return features(spark, sf)


@register("weighted_variance", [("invoice_id", I), ("weighted_delay_days_variance", D)],
          "SELECT invoice_id, weighted_delay_days_variance FROM feat")
def q_weighted_variance(spark, sf):
    return features(spark, sf)


@register("recency_days", [("invoice_id", I), ("recency_days", I)], "SELECT invoice_id, recency_days FROM sc")
def q_recency_days(spark, sf):
    return scored(spark, sf)


# --- bounds and scores (A7, N1-N7, F9) -------------------------------------------
NORM_KINDS = [("average_delay_days", D), ("maximum_delay_days", I), ("overall_delay_days_trend", D),
              ("invoice_deviation", D), ("number_of_previous_invoices", I), ("net_amount", D),
              ("average_invoice_amount", D), ("frequency_of_transactions", I), ("delay_days_variance", D),
              ("weighted_delay_days_trend", D), ("weighted_delay_days_variance", D)]
BOUNDS_SPEC = [("max_invoice_date", T), ("min_invoice_date", T)] + [
    (f"{m}_{c}", k) for c, k in NORM_KINDS for m in ("min", "max")] + [("min_recency_days", I), ("max_recency_days", I)]


@register("score_bounds", BOUNDS_SPEC,
          "SELECT b.*, 0 AS min_recency_days, CAST(max_invoice_date - min_invoice_date AS BIGINT) AS max_recency_days "
          "FROM b")
def q_score_bounds(spark, sf):
    return score_bounds(features(spark, sf))


MINMAX_SPEC = [("invoice_id", I)] + [(f"m_{c}", D) for c, _ in NORM_KINDS] + [("m_recency_days", D)]


@register("minmax_scaled", MINMAX_SPEC,
          "SELECT f.invoice_id, " + ", ".join(f"{O._m(c)} AS m_{c}" for c, _ in NORM_KINDS)
          + f", {O.RECENCY_M} AS m_recency_days FROM feat f CROSS JOIN b")
def q_minmax_scaled(spark, sf):
    feats = features(spark, sf)
    df = with_bounds(feats, bounds_row(score_bounds(feats))).transform(add_recency)
    cols = [c for c, _ in NORM_KINDS] + ["recency_days"]
    return df.select("invoice_id", *[minmax(c, F.col(f"min_{c}"), F.col(f"max_{c}")).alias(f"m_{c}") for c in cols])


for _score in ("risk_tolerance_score", "customer_value_score", "cash_flow_score", "historical_score",
               "global_score"):
    register(_score, [("invoice_id", I), (_score, D)], f"SELECT invoice_id, {_score} FROM scored")(
        lambda spark, sf: scored(spark, sf))


@register("score_validity", [("invoice_id", I), ("is_scorable", B)], "SELECT invoice_id, is_scorable FROM scored")
def q_score_validity(spark, sf):
    return scored(spark, sf)


@register("filter_scorable", [("invoice_id", I), ("global_score", D)], "SELECT invoice_id, global_score FROM kept")
def q_filter_scorable(spark, sf):
    return filter_scorable(scored(spark, sf))


# --- labels (C11-C13) ------------------------------------------------------------
@register("region_codes", [("invoice_id", I), ("region_level1", I), ("region_level2", I), ("region_level3", I)],
          "SELECT invoice_id, region_level1, region_level2, region_level3 FROM ts")
def q_region_codes(spark, sf):
    return training_set(spark, sf)


BUCKET_SQL = ("CASE WHEN delay_days <= 15 THEN 0 WHEN delay_days <= 30 THEN 1 WHEN delay_days <= 45 THEN 2 "
              "WHEN delay_days <= 60 THEN 3 ELSE 4 END")


@register("payment_bucket", [("invoice_id", I), ("delay_days", I), ("payment_bucket", I)],
          f"SELECT invoice_id, delay_days, {BUCKET_SQL} AS payment_bucket FROM feat")
def q_payment_bucket(spark, sf):
    return add_payment_bucket(features(spark, sf))


LABEL_SQL = "CASE payment_bucket " + " ".join(
    f"WHEN {i} THEN '{t}'" for i, t in enumerate(BUCKET_LABELS)) + " END"


@register("bucket_label", [("invoice_id", I), ("bucket_label", S)],
          f"SELECT invoice_id, {LABEL_SQL} AS bucket_label FROM ts")
def q_bucket_label(spark, sf):
    return training_set(spark, sf).withColumn("bucket_label", bucket_label("payment_bucket"))


# --- split, projection, weights (F10, F13, F14, A8) --------------------------------
PROJ_SPEC = [(n, k) for n, k in TRAINING_SPEC if n not in NON_FEATURE_COLUMNS]
PROJ_SQL = f"SELECT * EXCLUDE ({', '.join(NON_FEATURE_COLUMNS)}) FROM ts"


@register("training_projection", PROJ_SPEC, PROJ_SQL)
def q_training_projection(spark, sf):
    return training_projection(training_set(spark, sf))


@register("split_train", PROJ_SPEC,
          PROJ_SQL + " WHERE year(invoice_date) >= 2019 AND year(invoice_date) < 2023")
def q_split_train(spark, sf):
    return training_projection(split_train(training_set(spark, sf)))


@register("split_test", PROJ_SPEC,
          PROJ_SQL + " WHERE year(invoice_date) >= 2023")
def q_split_test(spark, sf):
    return training_projection(split_test(training_set(spark, sf)))


@register("split_open_invoices", INVOICE_SPEC,
          f"SELECT * FROM inv WHERE {O.YEAR_OK} AND payment_date IS NULL AND payment_complete = 'N'")
def q_split_open_invoices(spark, sf):
    return split_open_invoices(C.filter_year_range(invoices(spark, sf)))


@register("split_production_train", PROJ_SPEC,
          PROJ_SQL + " WHERE year(invoice_date) >= 2020 AND payment_date IS NOT NULL")
def q_split_production_train(spark, sf):
    return training_projection(split_production_train(training_set(spark, sf)))


@register("class_weights", [("payment_bucket", I), ("n", I), ("weight", D)],
          "SELECT payment_bucket, count(*) AS n, (SELECT count(*) FROM ts WHERE year(invoice_date) BETWEEN 2019 AND 2022)"
          " / count(*) AS weight FROM ts WHERE year(invoice_date) BETWEEN 2019 AND 2022 GROUP BY payment_bucket")
def q_class_weights(spark, sf):
    return class_weights(split_train(training_set(spark, sf)))


@register("weighted_rows", [("invoice_id", I), ("payment_bucket", I), ("weight", D)],
          "SELECT invoice_id, payment_bucket, (count(*) OVER ())::DOUBLE / count(*) OVER (PARTITION BY payment_bucket)"
          " AS weight FROM ts WHERE year(invoice_date) BETWEEN 2019 AND 2022")
def q_weighted_rows(spark, sf):
    rows = split_train(training_set(spark, sf))
    return add_class_weight(rows, class_weights(rows))


# --- profiling (A1-A6, A12, O1, O3) ---------------------------------------------------
YEAR_ROWS = f"(SELECT * FROM inv WHERE {O.YEAR_OK})"
PAID_ROWS = f"(SELECT * FROM inv WHERE {O.YEAR_OK} AND {O.PAID_OK})"


@register("null_counts", [("column_name", S), ("null_count", I)], " UNION ALL ".join(
    f"SELECT '{f.name}' AS column_name, count(*) - count({f.name}) AS null_count FROM {YEAR_ROWS}"
    for f in INVOICE_SCHEMA.fields))
def q_null_counts(spark, sf):
    return null_counts(C.filter_year_range(invoices(spark, sf)))


@register("value_counts", [("value", S), ("count", I)],
          f"SELECT payment_complete AS value, count(*) AS count FROM {YEAR_ROWS} "
          "WHERE payment_date IS NULL AND payment_complete IS NOT NULL GROUP BY payment_complete")
def q_value_counts(spark, sf):
    rows = C.filter_year_range(invoices(spark, sf)).filter(F.col("payment_date").isNull())
    return value_counts(rows, "payment_complete")


@register("value_counts_negative_region", [("value", S), ("count", I)],
          f"SELECT region_level3 AS value, count(*) AS count FROM {PAID_ROWS} "
          "WHERE net_amount < 0 AND region_level3 IS NOT NULL GROUP BY region_level3")
def q_value_counts_negative_region(spark, sf):
    rows = C.filter_paid(C.filter_year_range(invoices(spark, sf))).filter(F.col("net_amount") < 0)
    return value_counts(rows, "region_level3")


DESCRIBE_COLUMNS = ("invoice_id", "customer_id", "company_id", "payment_amount", "net_amount")
DESCRIBE_SPEC = [("column_name", S), ("count", I), ("mean", D), ("std", D), ("min", D), ("p25", D), ("p50", D),
                 ("p75", D), ("max", D)]


@register("describe_numeric", DESCRIBE_SPEC, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
    f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM {PAID_ROWS}" for c in DESCRIBE_COLUMNS))
def q_describe_numeric(spark, sf):
    return describe_numeric(C.filter_paid(C.filter_year_range(invoices(spark, sf))), DESCRIBE_COLUMNS)


@register("table_info", [("position", I), ("column_name", S), ("data_type", S), ("non_null", I)], " UNION ALL ".join(
    f"SELECT {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
    f"count({f.name}) AS non_null FROM inv" for i, f in enumerate(INVOICE_SCHEMA.fields)))
def q_table_info(spark, sf):
    return table_info(invoices(spark, sf))


@register("pair_sizes", [("customer_id", I), ("company_id", I), ("count", I)],
          "SELECT customer_id, company_id, count(*) AS count FROM clean GROUP BY customer_id, company_id")
def q_pair_sizes(spark, sf):
    return pair_sizes(cleaned(spark, sf))


DEPENDENCY_SPEC = [("direction", S), ("key", S), ("n", I), ("low", S), ("high", S)]


def _dependency_sql(a, b, source):
    return (f"SELECT '{a}->{b}' AS direction, CAST({a} AS VARCHAR) AS key, count(*) AS n, CAST(min({b}) AS VARCHAR) AS low, "
            f"CAST(max({b}) AS VARCHAR) AS high FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a} HAVING count(DISTINCT {b}) > 1")


@register("customer_company_violations", DEPENDENCY_SPEC, _dependency_sql("customer_id", "company_id", "clean")
          + " UNION ALL " + _dependency_sql("company_id", "customer_id", "clean"))
def q_customer_company_violations(spark, sf):
    return dependency_violations(cleaned(spark, sf), "customer_id", "company_id")


# planted: a twin column that breaks the 1:1 relation for one invoice in 500 only
PLANTED_SQL = "(SELECT invoice_id, CASE WHEN invoice_id % 500 = 0 THEN invoice_id + 1 ELSE invoice_id END AS twin_id FROM clean)"


@register("planted_dependency_violations", DEPENDENCY_SPEC, _dependency_sql("invoice_id", "twin_id", PLANTED_SQL)
          + " UNION ALL " + _dependency_sql("twin_id", "invoice_id", PLANTED_SQL))
def q_planted_dependency_violations(spark, sf):
    twin = F.when(F.col("invoice_id") % 500 == 0, F.col("invoice_id") + 1).otherwise(F.col("invoice_id"))
    return dependency_violations(cleaned(spark, sf).withColumn("twin_id", twin), "invoice_id", "twin_id")


@register("invoices_per_year", [("invoice_year", I), ("count", I)],
          "SELECT year(invoice_date) AS invoice_year, count(*) AS count FROM clean GROUP BY year(invoice_date)")
def q_invoices_per_year(spark, sf):
    return invoices_per_year(cleaned(spark, sf))


CORR_COLUMNS = [n for n, k in TRAINING_SPEC if k in (I, D)]
CORR_PAIRS = list(combinations(CORR_COLUMNS, 2))
CORR_SQL = (
    "SELECT n.column_a, n.column_b, CASE WHEN isnan(u.corr) THEN NULL ELSE u.corr END AS corr FROM (SELECT "
    + ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "c{i}"' for i, (a, b) in enumerate(CORR_PAIRS))
    + " FROM ts) UNPIVOT (corr FOR k IN (" + ", ".join(f'"c{i}"' for i in range(len(CORR_PAIRS)))
    + ")) AS u JOIN (VALUES " + ", ".join(f"('c{i}', '{a}', '{b}')" for i, (a, b) in enumerate(CORR_PAIRS))
    + ") AS n(k, column_a, column_b) ON u.k = n.k"
)


@register("correlation_long", [("column_a", S), ("column_b", S), ("corr", D)], CORR_SQL)
def q_correlation_long(spark, sf):
    out = correlation_long(training_set(spark, sf), CORR_COLUMNS)
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


@register("sorted_invoices", [("invoice_id", I), ("customer_id", I), ("company_id", I), ("invoice_date", T),
                              ("position", I)],
          "SELECT invoice_id, customer_id, company_id, invoice_date, row_number() OVER "
          "(ORDER BY customer_id, company_id, invoice_date, invoice_id) - 1 AS position FROM clean")
def q_sorted_invoices(spark, sf):
    return sorted_invoices(cleaned(spark, sf))


@register("head_invoices", INVOICE_SPEC, "SELECT * FROM inv ORDER BY invoice_id LIMIT 10")
def q_head_invoices(spark, sf):
    return head_invoices(invoices(spark, sf))


# --- evaluation on a deterministic stand-in prediction (A11, M8, M9) ----------------
STANDIN_SQL = ("(SELECT payment_bucket AS actual, CASE WHEN previous_delay_days <= 15 THEN 0 "
               "WHEN previous_delay_days <= 30 THEN 1 WHEN previous_delay_days <= 45 THEN 2 "
               "WHEN previous_delay_days <= 60 THEN 3 ELSE 4 END AS predicted FROM ts "
               "WHERE year(invoice_date) >= 2023)")
COUNTS_SQL = f"(SELECT actual, predicted, count(*) AS n FROM {STANDIN_SQL} GROUP BY actual, predicted)"
PER_CLASS_SQL = f"""(
  SELECT class, tp, predicted_n - tp AS fp, support - tp AS fn, support,
    coalesce(tp / nullif(predicted_n, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall
  FROM (
    SELECT coalesce(a.class, p.class) AS class, coalesce(a.tp, 0) AS tp, coalesce(a.support, 0) AS support,
           coalesce(p.predicted_n, 0) AS predicted_n
    FROM (SELECT actual AS class, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp, sum(n) AS support
          FROM {COUNTS_SQL} GROUP BY actual) a
    FULL JOIN (SELECT predicted AS class, sum(n) AS predicted_n FROM {COUNTS_SQL} GROUP BY predicted) p
      ON a.class = p.class
  )
)"""
PER_CLASS_F1 = (f"(SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 "
                f"FROM {PER_CLASS_SQL})")


def _standin(spark, sf):
    test = split_test(training_set(spark, sf))
    return test.withColumn("prediction", payment_bucket("previous_delay_days"))


@register("confusion_matrix", [("actual", I)] + [(f"pred_{k}", I) for k in range(5)],
          "SELECT actual, " + ", ".join(f"sum(CASE WHEN predicted = {k} THEN 1 ELSE 0 END) AS pred_{k}"
                                        for k in range(5)) + f" FROM {STANDIN_SQL} GROUP BY actual")
def q_confusion_matrix(spark, sf):
    return confusion_matrix(_standin(spark, sf))


@register("classification_metrics", [("accuracy", D), ("precision", D), ("recall", D), ("f1", D)],
          f"SELECT (SELECT sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) FROM {COUNTS_SQL}) "
          f"AS accuracy, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1 FROM {PER_CLASS_F1}")
def q_classification_metrics(spark, sf):
    return classification_metrics(_standin(spark, sf))


@register("per_class_metrics", [("class", S), ("precision", D), ("recall", D), ("f1", D), ("support", I)],
          f"SELECT CAST(class AS VARCHAR) AS class, precision, recall, f1, support FROM {PER_CLASS_F1} "
          f"UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM {PER_CLASS_F1} "
          f"UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), "
          f"sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM {PER_CLASS_F1}")
def q_per_class_metrics(spark, sf):
    return per_class_metrics(_standin(spark, sf))


# --- Spark ML (M1-M7, M10, M11, IO5-IO7, X2, X3) ------------------
# Fitted trees have no SQL form: each query returns what must hold of its rows (every row there, buckets
# in range, better than any constant, probabilities, reloaded model equal), which SQL can state.
TEST_ROWS = "FROM ts WHERE year(invoice_date) >= 2023"


def _valid():
    return F.col("predicted_bucket").between(0, 4)


def _splits(spark, sf):
    return _memo(spark, sf, "splits", lambda: prepare_splits(training_set(spark, sf)))


def _fitted(spark, sf, name, estimator_fn):
    def build():
        train_df, _, _ = _splits(spark, sf)
        cols = ml.feature_columns(train_df)
        return ml.fit(train_df, estimator_fn(), cols), cols

    return _memo(spark, sf, f"model-{name}", build)


def _rf(spark, sf):
    """The training step's default model: class-weighted random forest."""
    return _fitted(spark, sf, "rf", lambda: ml.random_forest())


# a constant predictor is right for at most the share of the commonest bucket, and then ``beats_majority`` is false
PRED_SPEC = [("invoice_id", I), ("payment_bucket", I), ("valid_bucket", B), ("beats_majority", B)]
PRED_SQL = f"SELECT invoice_id, payment_bucket, true AS valid_bucket, true AS beats_majority {TEST_ROWS}"
ID_SPEC = [("invoice_id", I), ("valid_bucket", B)]
ID_SQL = f"SELECT invoice_id, true AS valid_bucket {TEST_ROWS}"


def _predictions(spark, sf, model):
    _, test_df, _ = _splits(spark, sf)
    return ml.predict(model, test_df).withColumn("valid_bucket", _valid())


def _judged_predictions(spark, sf, model):
    rows = _predictions(spark, sf, model)
    counts = rows.groupBy("payment_bucket").agg(F.count("*").alias("n"), F.count_if(F.col("predicted_bucket") == F.col("payment_bucket")).alias("hit"))
    seen = counts.agg(F.max("n").alias("most"), F.sum("hit").alias("hit")).first()
    return rows.withColumn("beats_majority", F.lit(bool((seen["hit"] or 0) > (seen["most"] or 0))))


@register("feature_vector", [("invoice_id", I), ("n_features", I), ("payment_bucket", I)],
          f"SELECT invoice_id, {len([n for n, _ in PROJ_SPEC if n != 'payment_bucket'])} AS n_features, payment_bucket "
          "FROM ts WHERE year(invoice_date) BETWEEN 2019 AND 2022")
def q_feature_vector(spark, sf):
    train_df, _, _ = _splits(spark, sf)
    v = ml.feature_vector(train_df, ml.feature_columns(train_df))
    return v.withColumn("n_features", F.size(vector_to_array("features")))


@register("rf_predictions", PRED_SPEC, PRED_SQL)
def q_rf_predictions(spark, sf):
    """M2: library defaults (100 trees, no depth limit, no class weights)."""
    model, _ = _fitted(spark, sf, "rf-default", lambda: ml.deep_forest())
    return _judged_predictions(spark, sf, model)


@register("gbt_predictions", PRED_SPEC, PRED_SQL)
def q_gbt_predictions(spark, sf):
    """M3 with the depth-wise libraries' default sizes: depth 6, 100 rounds."""
    model, _ = _fitted(spark, sf, "gbt", lambda: ml.boosted_trees())
    return _judged_predictions(spark, sf, model)


@register("gbt_leafwise_predictions", PRED_SPEC, PRED_SQL)
def q_gbt_leafwise_predictions(spark, sf):
    """M3 with the leaf-wise libraries' default sizes: 31 leaves a tree, 100 rounds."""
    model, _ = _fitted(spark, sf, "gbt-leafwise", lambda: ml.boosted_trees(ml.BoostingParams()))
    return _judged_predictions(spark, sf, model)


@register("lr_predictions", PRED_SPEC, PRED_SQL)
def q_lr_predictions(spark, sf):
    model, _ = _fitted(spark, sf, "lr", lambda: ml.logistic_regression(weighted=False))
    return _judged_predictions(spark, sf, model)


@register("weighted_gbt_predictions", PRED_SPEC, PRED_SQL)
def q_weighted_gbt_predictions(spark, sf):
    """M5: class-weighted boosting by the tuned preset, all its rounds and leaves."""
    model, _ = _fitted(spark, sf, "wgbt", lambda: ml.tuned_boosting())
    return _judged_predictions(spark, sf, model)


PROB_SPEC = [("invoice_id", I), ("sums_to_one", B), ("predicted_is_likeliest", B)]
PROB_SQL = f"SELECT invoice_id, true AS sums_to_one, true AS predicted_is_likeliest {TEST_ROWS}"


def _probability_checks(df):
    ps = [F.col(f"p_{k}") for k in range(5)]
    # sums in another order may differ in the last bits
    top = F.greatest(*ps) - F.lit(1e-12)
    return df.select("invoice_id", (F.abs(sum(ps) - 1) < 1e-9).alias("sums_to_one"),
                     (F.get(F.array(*ps), F.col("predicted_bucket")) >= top).alias("predicted_is_likeliest"))


@register("class_probabilities", PROB_SPEC, PROB_SQL)
def q_class_probabilities(spark, sf):
    _, test_df, _ = _splits(spark, sf)
    return _probability_checks(ml.class_probabilities(_rf(spark, sf)[0], test_df))


@register("boosted_probabilities", PROB_SPEC, PROB_SQL)
def q_boosted_probabilities(spark, sf):
    _, test_df, _ = _splits(spark, sf)
    model, _ = _fitted(spark, sf, "gbt", lambda: ml.boosted_trees())
    return _probability_checks(ml.class_probabilities(model, test_df))


@register("feature_importance_top10", [("place", I), ("known_feature", B), ("in_order", B)],
          "SELECT range AS place, true AS known_feature, true AS in_order FROM range(1, 11)")
def q_feature_importance_top10(spark, sf):
    model, cols = _rf(spark, sf)
    top = ml.feature_importance_top(spark, model, cols, 10)
    order = Window.orderBy(F.desc("splits"), "feature")  # ten rows
    return top.select(F.row_number().over(order).alias("place"), F.col("feature").isin(cols).alias("known_feature"),
                      F.coalesce(F.lag("splits").over(order) >= F.col("splits"), F.col("splits") > 0).alias("in_order"))


@register("tuned_params", [("params", S), ("f1_in_range", B)],
          "SELECT 'maxDepth=' || d || ', numTrees=' || t AS params, true AS f1_in_range "
          "FROM (VALUES (6), (10)) a(d), (VALUES (20), (50)) b(t)")
def q_tuned_params(spark, sf):
    train_df, _, _ = _splits(spark, sf)
    _, table = ml.tune(train_df, ml.feature_columns(train_df))
    return table.withColumn("f1_in_range", F.col("macro_f1").between(0, 1))


@register("searched_params", [("trial", I), ("rounds", I), ("f1_in_range", B), ("beats_one_class", B)],
          "SELECT range AS trial, CASE WHEN range < 27 THEN 10 WHEN range < 36 THEN 30 WHEN range < 39 THEN 90 ELSE 270 END "
          "AS rounds, true AS f1_in_range, true AS beats_one_class FROM range(40)")
def q_searched_params(spark, sf):
    """Surrogate proposals and successive halving over the tuned space, the search's own 27 points from 10 to 270 rounds;
    a constant predictor has a macro F1 of at most 0.2."""
    train_df, _, _ = _splits(spark, sf)
    _, table = search_boosting(train_df, ml.feature_columns(train_df))
    best = table.orderBy(F.desc("rounds"), F.desc("macro_f1")).first()
    return table.withColumns({"f1_in_range": F.col("macro_f1").between(0, 1), "beats_one_class": F.lit(best["macro_f1"] > 0.2)})


@register("model_roundtrip", ID_SPEC + [("reloaded_equal", B)],
          f"SELECT invoice_id, true AS valid_bucket, true AS reloaded_equal {TEST_ROWS}")
def q_model_roundtrip(spark, sf):
    model, _ = _rf(spark, sf)
    path = _scratch(spark, "model")
    ml.save_model(model, path)
    _, test_df, _ = _splits(spark, sf)
    again = ml.predict(ml.load_model(path), test_df).select("invoice_id", F.col("predicted_bucket").alias("reloaded_bucket"))
    return _predictions(spark, sf, model).join(again, "invoice_id").withColumn(
        "reloaded_equal", F.col("predicted_bucket") == F.col("reloaded_bucket"))


@register("predictions", ID_SPEC, ID_SQL)
def q_predictions(spark, sf):
    res = train(training_set(spark, sf), ml.random_forest())
    return res.predictions.withColumn("valid_bucket", _valid())


READ_BACK_SPEC = [("invoice_id", I), ("equal_in_memory", B)]
READ_BACK_SQL = f"SELECT invoice_id, true AS equal_in_memory {TEST_ROWS}"


@register("write_predictions", READ_BACK_SPEC, READ_BACK_SQL)
def q_write_predictions(spark, sf):
    path = _scratch(spark, "predictions")
    rows = _predictions(spark, sf, _rf(spark, sf)[0])
    write_predictions(rows.drop("payment_bucket", "valid_bucket"), path)
    back = read_predictions(spark, path).select("invoice_id", F.col("predicted_bucket").alias("_read"))
    return rows.join(back, "invoice_id", "full").withColumn(
        "equal_in_memory", F.col("_read").eqNullSafe(F.col("predicted_bucket")))


@register("write_labelled_predictions", READ_BACK_SPEC, READ_BACK_SQL)
def q_write_labelled_predictions(spark, sf):
    path = _scratch(spark, "labelled")
    rows = _predictions(spark, sf, _rf(spark, sf)[0])
    write_labelled_predictions(rows.drop("payment_bucket", "valid_bucket"), path)
    back = read_predictions(spark, path, "csv").select(
        F.col("invoice_id").cast("long").alias("invoice_id"), F.col("prediction").alias("_read"))
    return rows.join(back, "invoice_id", "full").withColumn(
        "equal_in_memory", F.col("_read").eqNullSafe(F.get(F.array(*map(F.lit, BUCKET_LABELS)), F.col("predicted_bucket"))))


@register("train_pipeline", [("payment_bucket", I), ("n", I), ("metrics_in_range", B)],
          f"SELECT payment_bucket, count(*) AS n, true AS metrics_in_range {TEST_ROWS} GROUP BY payment_bucket")
def q_train_pipeline(spark, sf):
    res = run_pipeline(spark, invoices(spark, sf), _scratch(spark, "train"), _scratch(spark, "pred"),
                       ml.random_forest())
    cells = sum(F.col(f"pred_{k}") for k in range(5))
    in_range = all(0 <= v <= 1 for v in res.metrics.first())
    return res.confusion.select(F.col("actual").alias("payment_bucket"), cells.alias("n"),
                                F.lit(in_range).alias("metrics_in_range"))


@register("stream_predictions", ID_SPEC, ID_SQL)
def q_stream_predictions(spark, sf):
    source = _scratch(spark, "stream-source")
    write_training_set(split_test(training_set(spark, sf)), source)
    model, _ = _rf(spark, sf)
    return spark.read.parquet(run_stream_predictions(spark, source, model, _scratch(spark, "stream-sink"))).withColumn(
        "valid_bucket", _valid())


# --- open invoices (F14): as-of features and predictions ------------------------------
OPEN_COLS = [("invoice_id", I), ("previous_delay_days", I), ("average_delay_days", D),
             ("number_of_previous_invoices", I), ("overall_delay_days_trend", D), ("payment_deviation", D),
             ("maximum_delay_days", I), ("has_delayed_payment_last_3", I), ("has_early_payment_last_3", I),
             ("invoice_deviation", D), ("total_amount_of_previous_invoices", D), ("delay_days_trend", D),
             ("frequency_of_transactions", I), ("discount_offered", I), ("due_date_month", I)]
ORDER_KEY = "CAST(date_diff('day', DATE '1970-01-01', invoice_date) AS BIGINT) * 100000000 + invoice_id"
OPEN_SQL = (
    "SELECT o.invoice_id, coalesce(f.delay_days, 0) AS previous_delay_days, "
    "coalesce(f.average_delay_days, 0) AS average_delay_days, "
    "coalesce(f.number_of_previous_invoices + 1, 0) AS number_of_previous_invoices, "
    "coalesce(f.running_delay_days_trend, 0) AS overall_delay_days_trend, "
    "coalesce(f.payment_deviation, 0) AS payment_deviation, "
    "coalesce(f.maximum_delay_days, 0) AS maximum_delay_days, "
    "coalesce(f.has_delayed_payment_last_3, 0) AS has_delayed_payment_last_3, "
    "coalesce(f.has_early_payment_last_3, 0) AS has_early_payment_last_3, "
    "coalesce(f.invoice_deviation, 0) AS invoice_deviation, "
    "coalesce(f.total_amount_of_previous_invoices, 0) AS total_amount_of_previous_invoices, "
    "coalesce(f.delay_days_trend, 0) AS delay_days_trend, "
    "coalesce(f.frequency_of_transactions, 0) AS frequency_of_transactions, "
    "CASE WHEN o.due_discount_date IS NULL THEN 0 ELSE 1 END AS discount_offered, "
    "month(o.due_date) AS due_date_month "
    f"FROM (SELECT *, {ORDER_KEY} AS ok FROM inv WHERE {O.YEAR_OK} AND payment_date IS NULL "
    f"AND payment_complete = 'N' AND {O.COMPANY_OK}) o "
    f"ASOF LEFT JOIN (SELECT *, {ORDER_KEY} AS ok FROM feat) f "
    "ON o.customer_id = f.customer_id AND o.company_id = f.company_id AND o.ok > f.ok"
)


@register("open_invoice_features", OPEN_COLS, OPEN_SQL)
def q_open_invoice_features(spark, sf):
    return open_invoice_features(features(spark, sf), open_invoice_rows(invoices(spark, sf)))


@register("open_invoice_predictions", ID_SPEC,
          f"SELECT invoice_id, true AS valid_bucket FROM inv WHERE {O.YEAR_OK} AND payment_date IS NULL "
          f"AND payment_complete = 'N' AND {O.COMPANY_OK}")
def q_open_invoice_predictions(spark, sf):
    ctx = _memo(spark, sf, "scoring-context", lambda: fit_scoring_context(features(spark, sf)))
    return score_open_invoices(invoices(spark, sf), features(spark, sf), _rf(spark, sf)[0], ctx
                               ).withColumn("valid_bucket", _valid())


# --- leak-free history (earlier invoices only) -------------------------------------------
LEAK_FREE_COLS = [("invoice_id", I), ("delay_days", I), ("previous_delay_days", I),
                  ("average_delay_days", D), ("number_of_previous_invoices", I),
                  ("overall_delay_days_trend", D), ("payment_deviation", D), ("maximum_delay_days", I),
                  ("has_delayed_payment_last_3", I), ("delay_days_trend", D), ("invoice_deviation", D),
                  ("total_amount_of_previous_invoices", D), ("frequency_of_transactions", I)]
WP = "OVER (PARTITION BY customer_id, company_id ORDER BY invoice_date, invoice_id)"
LEAK_FREE_SQL = (
    "SELECT invoice_id, delay_days, "
    f"coalesce(lag(delay_days) {WP}, 0) AS previous_delay_days, "
    f"coalesce(lag(average_delay_days) {WP}, 0) AS average_delay_days, "
    "number_of_previous_invoices, "
    f"coalesce(lag(running_delay_days_trend) {WP}, 0) AS overall_delay_days_trend, "
    f"coalesce(lag(payment_deviation) {WP}, 0) AS payment_deviation, "
    f"coalesce(lag(maximum_delay_days) {WP}, 0) AS maximum_delay_days, "
    f"coalesce(lag(has_delayed_payment_last_3) {WP}, 0) AS has_delayed_payment_last_3, "
    f"coalesce(lag(delay_days_trend) {WP}, 0) AS delay_days_trend, "
    f"coalesce(lag(invoice_deviation) {WP}, 0) AS invoice_deviation, "
    f"coalesce(lag(total_amount_of_previous_invoices) {WP}, 0) AS total_amount_of_previous_invoices, "
    f"coalesce(lag(frequency_of_transactions) {WP}, 0) AS frequency_of_transactions "
    "FROM feat"
)


@register("leak_free_history", LEAK_FREE_COLS, LEAK_FREE_SQL)
def q_leak_free_history(spark, sf):
    return invoice_features(cleaned(spark, sf), HistoryParams(include_current=False))


# --- skew check: a third of all invoices on one pair, history in chunks ----------------
HOT_CHUNK_ROWS = 1000
HOT_SPEC = [("invoice_id", I), ("customer_id", I), ("company_id", I)] + [(c, FEATURE_KINDS[c]) for c in HISTORY_COLUMNS]


@register("history_hot_pair", HOT_SPEC, "SELECT * FROM feat")
def q_history_hot_pair(spark, sf):
    clean = C.clean_invoices(with_hot_pair(invoices(spark, sf)))
    return invoice_features(clean, HistoryParams(max_chunk_rows=HOT_CHUNK_ROWS))


# --- the same third of all invoices on one day, with uneven ids: days cut into blocks ---------
@register("history_hot_day", HOT_SPEC, "SELECT * FROM feat")
def q_history_hot_day(spark, sf):
    clean = C.clean_invoices(with_hot_day(invoices(spark, sf)))
    return invoice_features(clean, HistoryParams(max_chunk_rows=HOT_CHUNK_ROWS))


@register("leak_free_history_hot", LEAK_FREE_COLS, LEAK_FREE_SQL)
def q_leak_free_history_hot(spark, sf):
    clean = C.clean_invoices(with_hot_pair(invoices(spark, sf)))
    return invoice_features(clean, HistoryParams(include_current=False, max_chunk_rows=HOT_CHUNK_ROWS))


@register("open_invoice_features_hot", OPEN_COLS,
          OPEN_SQL.replace("FROM inv ", "FROM inv_hot "))
def q_open_invoice_features_hot(spark, sf):
    inv = with_hot_pair(invoices(spark, sf))
    params = HistoryParams(max_chunk_rows=HOT_CHUNK_ROWS)
    return open_invoice_features(features_table(inv, history=params), open_invoice_rows(inv), params)


# ---------------------------------------------------------------------------
# driver functions
# ---------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the training set built from sf0.001, summarised per delay bucket."""
    return queries()["bucket_summary"](spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn, spec):
        return lambda spark, sf_dir: canon(fn(spark, sf_dir), spec)

    return {name: wrap(fn, spec) for name, (fn, spec, _) in REGISTRY.items()} | _text_operators()[0]


def _text_operators() -> tuple[dict, dict]:
    """Queries and SQL of the text operators, or none where that subpackage is not there."""
    try:
        import corpus_pipeline
        from arrears.llm import queries as text
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "arrears.llm"):
            raise
        return {}, {}
    sql = dict(text.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return text.QUERIES | {"pipeline": corpus_pipeline.run}, sql


CHAINS = {"history_hot_pair": O.with_hot_chain, "leak_free_history_hot": O.with_hot_chain,
          "open_invoice_features_hot": O.with_hot_chain,
          "history_hot_day": O.with_hot_day_chain}


def oracle_sql() -> dict[str, str]:
    return {name: O.canon_sql(CHAINS.get(name, O.with_chain)(sql), spec)
            for name, (_, spec, sql) in REGISTRY.items() if sql is not None} | _text_operators()[1]
