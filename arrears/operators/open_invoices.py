"""Open invoices (F14): features from the paid invoices strictly before a row.

The training features include each paid invoice's own delay (parity with the
original). An open invoice has no delay yet, so its history features are the
*as-of* state of the pair: the values at the latest paid invoice that comes
before it in (invoice date, invoice id) order, with

* ``previous_delay_days`` = that paid invoice's delay,
* ``number_of_previous_invoices`` = number of earlier paid invoices,
* ``overall_delay_days_trend`` = slope over the earlier paid invoices only,

and zeros when the pair has no earlier paid invoice. Season features and
``discount_offered`` come from the open invoice itself.

The as-of lookup is one ordered window over paid and open rows together
(``last(state, ignorenulls)`` over the preceding rows). Hot pairs use the same
chunks as the history; each chunk's carry is the last paid
state of earlier chunks, found on a table of one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import HistoryParams
from ..session import default_partitions, materialize
from .clean import filter_company_amount, filter_year_range, parse_dates
from .features import due_date_parts
from .history import CHUNK, ORDER, PAIR, assign_chunks, pair_stats, resolve_chunk_rows
from .split import split_open_invoices

STATE_COLUMNS = (
    "delay_days",
    "average_delay_days",
    "number_of_previous_invoices",
    "total_amount_of_previous_invoices",
    "average_invoice_amount",
    "payment_deviation",
    "invoice_deviation",
    "has_delayed_payment_last_3",
    "has_early_payment_last_3",
    "delay_days_trend",
    "invoice_amount_trend",
    "maximum_delay_days",
    "running_delay_days_trend",
    "delay_days_trend_acceleration",
    "delay_days_variance",
    "frequency_of_transactions",
)


def open_invoice_rows(invoices: DataFrame, as_of=None) -> DataFrame:
    """Open invoices with a usable pair key and amount, dates parsed and year-filtered."""
    d = filter_company_amount(split_open_invoices(filter_year_range(parse_dates(invoices), as_of)))
    return d.drop("payment_amount", "payment_complete")


def _as_of_state(paid: DataFrame, open_rows: DataFrame, params: HistoryParams) -> DataFrame:
    """Each row of ``open_rows`` with ``_s``: the state of the last paid row strictly before it.

    A row that is also in ``paid`` (same invoice id) never sees its own state:
    at equal (date, id) the query row sorts first.
    """
    state_type = paid.select(F.struct(*STATE_COLUMNS).alias("s")).schema["s"].dataType
    open_cols = [c for c in open_rows.columns if c not in PAIR + ORDER]
    open_type = open_rows.select(F.struct(*open_cols).alias("o")).schema["o"].dataType
    events = paid.select(*PAIR, *ORDER, F.struct(*STATE_COLUMNS).alias("_state"),
                         F.lit(None).cast(open_type).alias("_orow"), F.lit(1).alias("_kind")).unionByName(
        open_rows.select(*PAIR, *ORDER, F.lit(None).cast(state_type).alias("_state"),
                         F.struct(*open_cols).alias("_orow"), F.lit(0).alias("_kind")))
    spark = events.sparkSession
    stats = materialize(pair_stats(events), "asof-pair-stats")
    total, largest = stats.agg(F.sum("_pair_rows"), F.max("_pair_rows")).first()
    max_rows = resolve_chunk_rows(total or 0, params, params.num_partitions or default_partitions(spark))
    chunked, n_hot = assign_chunks(events, stats, max_rows, largest or 0)
    w = Window.partitionBy(*CHUNK).orderBy(*ORDER, "_kind")
    local = chunked.withColumn(
        "_last", F.last("_state", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    )
    if n_hot:
        hot = chunked.filter(F.col("_hot"))
        last_paid = hot.where(F.col("_state").isNotNull()).groupBy(*CHUNK).agg(
            F.max_by("_state", F.struct(*ORDER)).alias("_cstate"))
        with_open = hot.where(F.col("_orow").isNotNull()).select(*CHUNK).distinct()
        chunks = last_paid.join(with_open, CHUNK, "full")
        carry = chunks.withColumn("_carry", F.last("_cstate", ignorenulls=True).over(
            Window.partitionBy(*PAIR).orderBy("_cday", "_csub").rowsBetween(Window.unboundedPreceding, -1)
        )).select(*CHUNK, "_carry")
        local = local.join(carry, CHUNK, "left").withColumn("_last", F.coalesce("_last", "_carry"))
    opened = local.where(F.col("_orow").isNotNull())
    return opened.select(*PAIR, *ORDER, "_orow.*", F.col("_last").alias("_s"))


def as_of_features(paid_features: DataFrame, rows: DataFrame, params: HistoryParams = HistoryParams()) -> DataFrame:
    """``rows`` plus the history columns taken from the paid invoices strictly before each row."""
    # only pairs with a row to look up take part: their keys are written, so that Spark knows the size
    wanted = materialize(rows.select(*PAIR).distinct(), "asof-pairs")
    st = _as_of_state(paid_features.join(wanted, PAIR, "left_semi"), rows.drop(*[c for c in STATE_COLUMNS if c != "delay_days"]), params)
    s = lambda c: F.col(f"_s.{c}")
    zero = {c: F.coalesce(s(c), F.lit(0)) for c in STATE_COLUMNS}
    return st.withColumns({
        "delay_days": F.lit(None).cast("int"),
        "previous_delay_days": F.coalesce(s("delay_days"), F.lit(0)),
        "number_of_previous_invoices": F.coalesce(s("number_of_previous_invoices") + 1, F.lit(0)),
        "overall_delay_days_trend": F.coalesce(s("running_delay_days_trend"), F.lit(0.0)),
        **{c: zero[c] for c in STATE_COLUMNS
           if c not in ("delay_days", "number_of_previous_invoices", "running_delay_days_trend")},
    }).drop("_s")


def open_invoice_features(paid_features: DataFrame, open_rows: DataFrame,
                          params: HistoryParams = HistoryParams(), alpha: float = 0.1) -> DataFrame:
    """Feature rows for open invoices, same columns as the paid feature table (no delay, no label)."""
    from ..params import ScoreParams
    from .scoring import add_score_helpers

    rows = open_rows.withColumn("delay_days", F.lit(None).cast("int"))
    out = as_of_features(paid_features, rows, params).withColumn(
        "discount_offered", F.col("due_discount_date").isNotNull().cast("int")).drop("due_discount_date")
    return add_score_helpers(out.transform(due_date_parts), ScoreParams(alpha=alpha))
