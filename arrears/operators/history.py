"""Ordered per-pair payment history: W1-W13, A13, A14 and C3.

Definitions (pair = (customer_id, company_id), order = (invoice_date,
invoice_id), ``y`` = days of delay, ``a`` = net amount):

* running statistics include the current invoice (mean, sum, sample std,
  max), ``number_of_previous_invoices`` is the 0-based position;
* the rolling flags and trends over ``rolling_rows`` rows (three) need that
  many rows (one more for the trend);
* ``overall_delay_days_trend`` is the least-squares slope of ``y`` against
  the position over the whole pair (0 for a single invoice);
* ``frequency_of_transactions`` counts the customer's invoices (all companies).

Skew: a window partition cannot be split by Spark, so a very large pair would
land in one task. Pairs with more rows than ``max_chunk_rows`` are cut into
contiguous *chunks* of at most twice that size: following invoice days are
taken together, and a day that is itself too large is cut at every
``max_chunk_rows``-th row of its sorted ids. (Rows that share day and id stay
together; null ids sort first.) Windows run per chunk; a small per-chunk summary
gives each chunk the exact carry of all earlier chunks (count, sums, sums of
squares, max, last ``rolling_rows`` + 1 values). Delays are merged with the
parallel-variance formula. Amounts are added as whole millionths (decimals of
38 digits, and what is left of an amount below that as a double), so their sums
and squares do not depend on order or chunks. Pairs below the threshold
form a single chunk and take exactly the plain window path.

Shuffles of the fact rows: exactly one (hash on pair + chunk). The chunk
summaries and the per-pair table are joined on the same four keys, so that
join only moves the small side, and the fact side is already sorted. With hot
pairs, the chunk summaries come from the hot rows alone: one extra exchange of
those rows with only the key, order, delay and amount columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import HistoryParams
from ..session import default_partitions, materialize
from .profile import global_index

PAIR = ["customer_id", "company_id"]
CHUNK = PAIR + ["_cday", "_csub"]
ORDER = ["invoice_date", "invoice_id"]
# block bounds of a large day are searched in two steps of this width
BOUND_STEP = 64

HISTORY_COLUMNS = (
    "previous_delay_days",
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
    "overall_delay_days_trend",
    "delay_days_trend_acceleration",
    "delay_days_variance",
    "frequency_of_transactions",
    "running_delay_days_trend",
)


def _empty(dtype: str) -> Column:
    return F.array().cast(f"array<{dtype}>")


def pair_stats(df: DataFrame) -> DataFrame:
    """Rows per pair and invoices per customer (A14), one row per pair.

    Grouped aggregates with map-side combine; the per-customer total is
    joined back to the pair rows (AQE splits a customer with very many
    companies), never a window over the facts.
    """
    per_pair = df.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("_pair_rows"), F.count("invoice_id").alias("_pair_ids")
    )
    per_customer = per_pair.groupBy("customer_id").agg(F.sum("_pair_ids").alias("frequency_of_transactions"))
    return per_pair.join(per_customer, "customer_id")


def assign_chunks(df: DataFrame, stats: DataFrame, max_chunk_rows: int, largest_pair: int | None = None):
    """Add ``_hot``/``_cday``/``_csub``; return (frame, number of hot pairs).

    Without hot pairs the chunk columns are constants, the window partitions
    on the pair alone and the explicit exchange is on the pair.
    """
    no_hot = df.withColumns({"_hot": F.lit(False), "_cday": F.lit(0), "_csub": F.lit(0).cast("long")})
    if largest_pair is not None and largest_pair <= max_chunk_rows:
        return no_hot.repartition(*PAIR), 0
    hot = materialize(stats.filter(F.col("_pair_rows") > max_chunk_rows).select(*PAIR), "hot-pairs")
    n_hot = hot.count()
    if n_hot == 0:
        return no_hot.repartition(*PAIR), 0
    # days of hot pairs, grouped to chunks by the rows before them; written, so
    # that Spark picks the joins with them by their size
    days = Window.partitionBy(*PAIR).orderBy("invoice_date")
    before = F.coalesce(F.sum("_cell_rows").over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = df.join(hot, PAIR, "left_semi").groupBy(*PAIR, "invoice_date").agg(F.count(F.lit(1)).alias("_cell_rows"))
    cells = materialize(cells.withColumn("_cday", F.floor(before / F.lit(max_chunk_rows)).cast("int")), "hot-days")
    large = cells.filter(F.col("_cell_rows") > max_chunk_rows)
    if large.isEmpty():
        marked = df.join(cells.drop("_cell_rows"), PAIR + ["invoice_date"], "left").withColumn("_csub", F.lit(0).cast("long"))
    else:
        cells = materialize(
            cells.drop("_cell_rows").join(_block_bounds(df, large, max_chunk_rows), PAIR + ["invoice_date"], "left"),
            "hot-blocks")
        marked = df.join(cells, PAIR + ["invoice_date"], "left").withColumn("_csub", _block("_bounds", "_steps"))
        marked = marked.drop("_bounds", "_steps")
    out = marked.withColumns({"_hot": F.col("_cday").isNotNull(), "_cday": F.coalesce("_cday", F.lit(0))})
    # explicit exchange on pair + chunk: a hot pair is spread over many tasks
    return out.repartition(*CHUNK), n_hot


def _block_bounds(df: DataFrame, large: DataFrame, max_chunk_rows: int) -> DataFrame:
    """(pair, day, ``_bounds``, ``_steps``): first ids of a large day's blocks after the first, in order.

    The ids of large days are sorted by range and numbered; every
    ``max_chunk_rows``-th one starts a block. ``_steps`` is every
    ``BOUND_STEP``-th bound.
    """
    day = PAIR + ["invoice_date"]
    rows = df.select(*day, "invoice_id").join(large.select(*day), day, "left_semi")
    indexed = global_index(rows, PAIR + ORDER, "_pos")
    starts = indexed.groupBy(*day).agg(F.min("_pos").alias("_start"))
    within = F.col("_pos") - F.col("_start")
    firsts = indexed.join(starts, day).where((within > 0) & (within % max_chunk_rows == 0))
    bounds = firsts.groupBy(*day).agg(F.sort_array(F.collect_list("invoice_id")).alias("_bounds"))
    return bounds.withColumn("_steps", F.filter(
        "_bounds", lambda b, i: i % F.lit(BOUND_STEP) == F.lit(0)))


def _block(bounds: str, steps: str) -> Column:
    """Number of bounds at or below the row's id, by a search in two steps; 0 for null ids and small days."""
    def upto(array):
        return F.size(F.filter(array, lambda b: b <= F.col("invoice_id")))

    start = F.greatest(upto(F.col(steps)) - 1, F.lit(0)) * F.lit(BOUND_STEP)
    found = start + upto(F.slice(F.col(bounds), start + 1, F.lit(BOUND_STEP)))
    return F.when(F.col(bounds).isNotNull(), found).otherwise(F.lit(0)).cast("long")


def _kept(rolling: int) -> int:
    """Latest values of a pair that the features look at: a rolling window and the row before it, three at least."""
    return max(rolling, 2) + 1


#: amounts are added in units of a millionth
UNITS = 1e6
_WIDE = "decimal(38,0)"


def _units(a: Column) -> Column:
    """The amount in whole millionths; null for an amount that has none (NaN, infinite). Squares fit amounts up to 10**12."""
    return F.round(a * F.lit(UNITS)).try_cast(_WIDE)


def _below_units(a: Column) -> Column:
    """What whole millionths leave of an amount: 0 for up to six decimals."""
    return F.coalesce(a - F.round(a * F.lit(UNITS)) / F.lit(UNITS), a * 0)


def _total(units: Column, rest: Column) -> Column:
    return units.cast("double") / F.lit(UNITS) + rest


def _spread(n: Column, units: Column, squares: Column) -> Column:
    """Sample std from count, sum and sum of squares of whole millionths; 0 below two values.

    n * squares - units * units is exact up to 38 digits; beyond, doubles take over.
    """
    exact = F.try_subtract(F.try_multiply(n.cast(_WIDE), squares), F.try_multiply(units, units)).cast("double")
    wide = n.cast("double") * squares.cast("double") - F.pow(units.cast("double"), 2)
    m2 = F.greatest(F.coalesce(exact, wide), F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.try_divide(m2, n.cast("double") * (n.cast("double") - 1))) / F.lit(UNITS)).otherwise(F.lit(0.0))


def _local_windows(df: DataFrame, y: str, a: str, rolling: int) -> DataFrame:
    w = Window.partitionBy(*CHUNK).orderBy(*ORDER)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    Y, A = F.col(y), F.col(a)
    stage1 = df.withColumns({
        "_rn": F.row_number().over(w),
        "_lsy": F.sum(Y).over(run),
        "_lvy": F.var_pop(Y).over(run),
        "_lsdy": F.stddev_samp(Y).over(run),
        "_lmaxy": F.max(Y).over(run),
        "_lna": F.count(A).over(run),
        "_lsa": F.sum(_units(A)).over(run),
        "_lqa": F.sum((_units(A) * _units(A)).cast(_WIDE)).over(run),
        "_lra": F.sum(_below_units(A)).over(run),
        **{f"_y{k}": F.lag(Y, k).over(w) for k in range(1, _kept(rolling))},
        **{f"_a{k}": F.lag(A, k).over(w) for k in range(1, _kept(rolling))},
        "_cn": F.count(F.lit(1)).over(whole),
        "_csy": F.sum(Y).over(whole),
    })
    iy = (F.col("_rn") - 1).cast("double") * Y
    return stage1.withColumns({"_csiy": F.sum(iy).over(whole), "_lsiy": F.sum(iy).over(run)})


def _chunk_carries(local: DataFrame, y: str, a: str, rolling: int) -> DataFrame:
    """Exclusive carries of earlier chunks, for chunks of hot pairs only."""
    last = F.col("_rn") == F.col("_cn")
    kept = _kept(rolling)
    keep = F.least(F.col("_cn"), F.lit(kept)).cast("int")
    summary = local.filter(last & F.col("_hot")).select(
        *CHUNK,
        F.col("_cn").alias("n"),
        F.col("_lsy").alias("sy"),
        (F.col("_lvy") * F.col("_cn")).alias("m2y"),
        F.col("_lmaxy").alias("maxy"),
        F.col("_lna").alias("na"),
        *[F.col(f"_l{k}a").alias(f"{k}a") for k in "sqr"],
        F.col("_csiy").alias("siy"),
        F.reverse(F.slice(F.array(F.col(y), *[f"_y{k}" for k in range(1, kept)]), 1, keep)).alias("lasty"),
        F.reverse(F.slice(F.array(F.col(a), *[f"_a{k}" for k in range(1, kept)]), 1, keep)).alias("lasta"),
    )
    ws = Window.partitionBy(*PAIR).orderBy("_cday", "_csub")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    allc = ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = summary.withColumns({
        "_pn": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "_psy": F.coalesce(F.sum("sy").over(before), F.lit(0)),
        "_pmaxy": F.max("maxy").over(before),
        **{f"_p{k}a": F.sum(f"{k}a").over(before) for k in "sqr"},
        "_pna": F.coalesce(F.sum("na").over(before), F.lit(0)),
        "_pair_n": F.sum("n").over(allc),
        "_pair_sy": F.sum("sy").over(allc),
        "_py": F.reverse(F.concat(*[
            F.coalesce(F.lag("lasty", k).over(ws), _empty("int")) for k in range(kept, 0, -1)])),
        "_pa": F.reverse(F.concat(*[
            F.coalesce(F.lag("lasta", k).over(ws), _empty("double")) for k in range(kept, 0, -1)])),
    })
    mu_y = F.col("_pair_sy") / F.col("_pair_n")
    qy = F.col("m2y") + F.col("n") * F.pow(F.col("sy") / F.col("n") - mu_y, 2)
    s = s.withColumns({
        "_psiy": F.coalesce(F.sum(F.col("_pn") * F.col("sy") + F.col("siy")).over(before), F.lit(0.0)),
        "_pqy": F.coalesce(F.sum(qy).over(before), F.lit(0.0)),
        "_pair_siy": F.sum(F.col("_pn") * F.col("sy") + F.col("siy")).over(allc),
        "_mu_y": mu_y,
    })
    p1y = F.col("_psy") - F.col("_mu_y") * F.col("_pn")
    return s.select(
        *CHUNK, "_pn", "_psy", "_pmaxy", "_psa", "_pqa", "_pra", "_pna", "_py", "_pa",
        "_pair_n", "_pair_sy", "_pair_siy", "_psiy",
        F.when(F.col("_pn") > 0, F.greatest(F.col("_pqy") - p1y * p1y / F.col("_pn"), F.lit(0.0))).alias("_pm2y"),
    )


def _merged_std(pn: Column, pm2: Column, pmean: Column, ln: Column, lm2: Column, lmean: Column,
                local_std: Column) -> Column:
    """Sample std of (earlier chunks) + (this chunk up to the row); 0 below two values."""
    n = pn + ln
    m2 = F.when(ln == 0, pm2).otherwise(
        pm2 + lm2 + F.try_divide(F.pow(lmean - pmean, 2) * pn * ln, n)
    )
    merged = F.when(n > 1, F.sqrt(F.try_divide(m2, n - 1))).otherwise(F.lit(0.0))
    return F.when(pn == 0, F.coalesce(local_std, F.lit(0.0))).otherwise(merged)


def _back(local: str, carry: str, k: int) -> Column:
    """Value ``k`` rows back in the pair: local lag, or from the earlier chunks."""
    return F.when(F.col("_rn") > k, F.col(f"{local}{k}")).otherwise(
        F.get(F.col(carry), F.lit(k) - F.col("_rn"))
    )


def _slope(n: Column, sy: Column, siy: Column) -> Column:
    """Least-squares slope of y on positions 0..n-1 from n, sum(y), sum(i*y); 0 below two rows."""
    return F.when(
        n > 1, F.lit(6.0) * (F.lit(2.0) * siy - (n - 1) * sy) / (n * (n * n - 1))
    ).otherwise(F.lit(0.0))


def _largest(columns: list) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def _features(j: DataFrame, y: str, a: str, rolling: int) -> DataFrame:
    Y, A = F.col(y), F.col(a)
    pn = F.coalesce(F.col("_pn"), F.lit(0)).cast("long")
    pna = F.coalesce(F.col("_pna"), F.lit(0)).cast("long")
    rn = F.col("_rn").cast("long")
    pos = pn + rn - 1
    n = pn + rn
    back_y = [_back("_y", "_py", k) for k in range(1, _kept(rolling))]
    back_a = [_back("_a", "_pa", k) for k in range(1, rolling + 1)]
    y1, y2 = back_y[:2]
    whole_a = A.isNotNull()
    for earlier in back_a:
        whole_a = whole_a & earlier.isNotNull()
    na = pna + F.col("_lna")
    wide = F.lit(0).cast(_WIDE)
    sum_a, square_a = ((F.coalesce(F.col(f"_p{k}a"), wide) + F.coalesce(F.col(f"_l{k}a"), wide)).cast(_WIDE) for k in "sq")
    rest_a = F.coalesce(F.col("_pra"), F.lit(0.0)) + F.coalesce(F.col("_lra"), F.lit(0.0))
    total_a = F.when(na > 0, _total(sum_a, rest_a))
    pay_std = _merged_std(
        pn.cast("double"), F.col("_pm2y"), F.try_divide(F.col("_psy"), pn),
        rn.cast("double"), F.col("_lvy") * rn, F.col("_lsy") / rn, F.col("_lsdy"),
    )
    inv_std = _spread(na, sum_a, square_a)
    latest = _largest([Y, *back_y[:rolling - 1]])
    full, more = pos >= rolling - 1, pos >= rolling
    tn = F.coalesce(F.col("_pair_n"), F.col("_cn")).cast("double")
    tsy = F.coalesce(F.col("_pair_sy"), F.col("_csy")).cast("double")
    tsiy = F.coalesce(F.col("_pair_siy"), F.col("_csiy"))
    slope = _slope(tn, tsy, tsiy)
    # running slope over the rows up to this one (the as-of view used for open invoices)
    rsy = (F.coalesce(F.col("_psy"), F.lit(0)) + F.col("_lsy")).cast("double")
    rsiy = F.coalesce(F.col("_psiy"), F.lit(0.0)) + pn.cast("double") * F.col("_lsy") + F.col("_lsiy")
    running_slope = _slope(n.cast("double"), rsy, rsiy)
    n_prev = pos.cast("int")
    return j.withColumns({
        "previous_delay_days": F.coalesce(y1, F.lit(0)),
        "average_delay_days": (F.coalesce(F.col("_psy"), F.lit(0)) + F.col("_lsy")) / n,
        "number_of_previous_invoices": n_prev,
        "total_amount_of_previous_invoices": total_a,
        "average_invoice_amount": F.when(pos == 0, F.lit(0.0)).otherwise(F.try_divide(total_a, pos)),
        "payment_deviation": pay_std,
        "invoice_deviation": inv_std,
        "has_delayed_payment_last_3": (full & (latest > 0)).cast("int"),
        "has_early_payment_last_3": (full & (latest < 0)).cast("int"),
        "delay_days_trend": F.when(
            more, (Y - back_y[rolling - 1]) / F.lit(float(rolling))).otherwise(F.lit(0.0)),
        "invoice_amount_trend": F.when(
            more & whole_a, (A - back_a[-1]) / F.lit(float(rolling))).otherwise(F.lit(0.0)),
        "maximum_delay_days": F.greatest(F.col("_pmaxy"), F.col("_lmaxy")),
        "overall_delay_days_trend": slope,
        "delay_days_trend_acceleration": F.when(pos >= 2, Y - 2 * y1 + y2).otherwise(F.lit(0)),
        "delay_days_variance": pay_std,
        "running_delay_days_trend": running_slope,
    })


def resolve_chunk_rows(total_rows: int, params: HistoryParams, partitions: int) -> int:
    if params.max_chunk_rows:
        return int(params.max_chunk_rows)
    return max(params.min_chunk_rows, math.ceil(total_rows / max(partitions, 1)))


def history_features(df: DataFrame, params: HistoryParams = HistoryParams(),
                     y: str = "delay_days", a: str = "net_amount") -> DataFrame:
    """Add the ordered history columns (``HISTORY_COLUMNS``) to cleaned invoices.

    ``df`` must carry ``customer_id, company_id, invoice_date, invoice_id``
    and the delay column ``y`` (non-null after cleaning) and amount ``a``.
    """
    spark = df.sparkSession
    partitions = params.num_partitions or default_partitions(spark)
    stats = materialize(pair_stats(df), "pair-stats")
    total, largest = stats.agg(F.sum("_pair_rows"), F.max("_pair_rows")).first()
    max_rows = resolve_chunk_rows(total or 0, params, partitions)
    chunked, n_hot = assign_chunks(df, stats, max_rows, largest or 0)
    rolling = params.rolling_rows
    local = _local_windows(chunked, y, a, rolling)
    carry = stats.filter(F.col("_pair_rows") <= max_rows).select(
        *PAIR, "frequency_of_transactions", F.lit(0).alias("_cday"), F.lit(0).cast("long").alias("_csub")
    )
    if n_hot:
        # summaries from the hot rows only: the filter and column pruning reach
        # below the repartition, so this extra exchange moves hot rows with a
        # few narrow columns instead of re-sorting every row
        chunk_carry = _chunk_carries(_local_windows(chunked.filter(F.col("_hot")), y, a, rolling), y, a, rolling)
        freq = stats.filter(F.col("_pair_rows") > max_rows).select(*PAIR, "frequency_of_transactions")
        carry = carry.unionByName(chunk_carry.join(freq, PAIR), allowMissingColumns=True)
    else:
        for c, t in (("_pn", "long"), ("_psy", "long"), ("_pmaxy", "int"), ("_psa", _WIDE),
                     ("_pqa", _WIDE), ("_pra", "double"), ("_pna", "long"), ("_pm2y", "double"),
                     ("_pair_n", "long"), ("_pair_sy", "long"), ("_pair_siy", "double"), ("_psiy", "double")):
            carry = carry.withColumn(c, F.lit(None).cast(t))
        carry = carry.withColumns({"_py": F.lit(None).cast("array<int>"), "_pa": F.lit(None).cast("array<double>")})
    joined = local.join(carry, CHUNK, "left")
    out = _features(joined, y, a, rolling)
    if not params.include_current:
        out = _leak_free(out, rolling)
    helpers = [c for c in out.columns if c not in df.columns and c not in HISTORY_COLUMNS]
    return out.drop(*helpers)


def _leak_free(rows: DataFrame, rolling: int) -> DataFrame:
    """History from earlier invoices only: each row takes the values of the row before it in its pair.

    Inside a chunk that is a lag over the order the rows already have; the
    first row of a chunk takes the values from the carry of the earlier
    chunks. Rows without an earlier invoice get zeros.
    ``overall_delay_days_trend`` is the slope over the earlier rows.
    """
    pn, pna = F.col("_pn"), F.col("_pna")
    y = [F.get("_py", F.lit(k)) for k in range(_kept(rolling))]
    a = [F.get("_pa", F.lit(k)) for k in range(rolling + 1)]
    whole_a = pn > rolling
    for earlier in a:
        whole_a = whole_a & earlier.isNotNull()
    total = F.when(pna > 0, _total(F.col("_psa"), F.col("_pra")))
    latest, full, more = _largest(y[:rolling]), pn >= rolling, pn > rolling

    def std(n, m2):
        return F.when(n > 1, F.sqrt(F.try_divide(m2, n - 1))).otherwise(F.lit(0.0))

    carried = {
        "average_delay_days": F.try_divide(F.col("_psy"), pn),
        "total_amount_of_previous_invoices": total,
        "average_invoice_amount": F.when(pn > 1, F.try_divide(total, pn - 1)),
        "payment_deviation": std(pn, F.col("_pm2y")),
        "delay_days_variance": std(pn, F.col("_pm2y")),
        "invoice_deviation": _spread(pna, F.col("_psa"), F.col("_pqa")),
        "has_delayed_payment_last_3": (full & (latest > 0)).cast("int"),
        "has_early_payment_last_3": (full & (latest < 0)).cast("int"),
        "delay_days_trend": F.when(more, (y[0] - y[rolling]) / F.lit(float(rolling))),
        "invoice_amount_trend": F.when(whole_a, (a[0] - a[rolling]) / F.lit(float(rolling))),
        "maximum_delay_days": F.col("_pmaxy"),
        "overall_delay_days_trend": _slope(pn.cast("double"), F.col("_psy").cast("double"), F.col("_psiy")),
        "delay_days_trend_acceleration": F.when(pn >= 3, y[0] - 2 * y[1] + y[2]),
        "frequency_of_transactions": F.when(pn > 0, F.col("frequency_of_transactions")),
    }
    w = Window.partitionBy(*CHUNK).orderBy(*ORDER)
    source = {"overall_delay_days_trend": "running_delay_days_trend"}
    return rows.withColumns({
        c: F.coalesce(F.when(F.col("_rn") > 1, F.lag(source.get(c, c)).over(w)).otherwise(v), F.lit(0))
        for c, v in carried.items()
    }).drop("running_delay_days_trend")
