"""Profiling: A1-A6, A12, O1-O3.

The global renumbering uses a range-partitioned sort plus per-partition row
offsets (the DataFrame form of ``zipWithIndex``): one sort shuffle, a table of
one row per partition, and no single-task collection of values. The quartiles
of ``describe`` are selected by the bits of their values and the correlations
come from one pass of products; neither moves a value.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, null_count) per column (A1); one pass, then a 1-row unpivot."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) with nulls dropped, most frequent first (A2)."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")
    )


def table_info(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null) (A4)."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "non_null")
    types = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, data_type string",
    )
    return types.join(F.broadcast(long), "column_name").select("position", "column_name", "data_type", "non_null")


def pair_sizes(df: DataFrame) -> DataFrame:
    """Invoices per (customer, company), ordered by customer (A5, O2)."""
    return df.groupBy("customer_id", "company_id").agg(F.count(F.lit(1)).alias("count")).orderBy(
        "customer_id", "company_id"
    )


def invoices_per_year(df: DataFrame, date_col: str = "invoice_date") -> DataFrame:
    """Invoice count per year."""
    return df.groupBy(F.year(date_col).alias("invoice_year")).agg(F.count(F.lit(1)).alias("count"))


def global_index(df: DataFrame, order, name: str = "position") -> DataFrame:
    """0-based position of every row in the total order ``order`` (O1).

    The sorted rows are written once (so partition ids are stable), counted
    per partition, and each partition's offset is a running sum over the
    small per-partition table.
    """
    ordered = df.orderBy(*order).withColumns({
        "_pid": F.spark_partition_id(),
        "_mid": F.monotonically_increasing_id(),
    })
    ordered = materialize(ordered.withColumn("_li", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)),
                          "ordered")
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    # one row per partition of the sort: the running sum over it is tiny
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_pc").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("_pid", "_off")
    # written, so that Spark knows its size and broadcasts it by that
    return ordered.join(materialize(offsets, "offsets"), "_pid").withColumn(name, F.col("_off") + F.col("_li")).drop(
        "_pid", "_mid", "_li", "_off"
    )


def sorted_invoices(df: DataFrame) -> DataFrame:
    """Sort by customer, company, invoice date (invoice id breaks ties) and renumber (O1)."""
    return global_index(df, ["customer_id", "company_id", "invoice_date", "invoice_id"], "position")


def dependency_violations(df: DataFrame, left: str, right: str) -> DataFrame:
    """Where ``left`` and ``right`` are not one to one (A5): direction, key, n (rows), low, high.

    ``left->right`` has every value of ``left`` that stands with several of
    ``right``, the other direction likewise; ``low`` and ``high`` are the
    least and greatest of them. No rows: each determines the other. Rows with a
    null on either side say nothing. One mergeable summary a key, combined
    before the shuffle, so a frequent key is one row a task.
    """
    known = df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())

    def broken(a: str, b: str) -> DataFrame:
        seen = known.groupBy(F.col(a).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min(b).alias("low"), F.max(b).alias("high"))
        return seen.filter(F.col("low") < F.col("high")).select(
            F.lit(f"{a}->{b}").alias("direction"), *[F.col(c).cast("string").alias(c) if c != "n" else F.col(c) for c in ("key", "n", "low", "high")])

    return broken(left, right).unionByName(broken(right, left))


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles (both zeros alike, NaN last)."""
    x = np.where(np.isnan(x), np.nan, x + 0.0)
    bits = np.where(x == 0.0, 0.0, x).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _double_of(bits: int) -> float:
    raw = bits & ~(1 << 63) if bits >> 63 else ~bits & (2**64 - 1)
    return float(np.array([raw], np.uint64).view(float)[0])


def _arrow_doubles(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])


def select_ranks(df: DataFrame, columns, ranks_of, digit: int = 16) -> tuple[dict[tuple[int, int], float], dict[int, int]]:
    """({(column number, rank): value}, {column number: values}) for the wanted 0-based ranks of each column's non-null values.

    ``ranks_of`` maps a column's count to its ranks. By radix selection: a pass counts the next
    ``digit`` bits of the values that share a wanted value's bits so far, for all
    columns and ranks at once; only counters are shuffled and no value moves.
    """
    x = _arrow_doubles(df, columns)
    counts: dict[int, int] = {}
    wanted: dict[tuple[int, int], tuple[int, int]] = {}  # (column, rank) -> bits so far, rank among the values with these bits
    for done in range(0, 64, digit):
        starts = sorted({(c, bits) for (c, _), (bits, _) in wanted.items()}) if done else [(c, 0) for c in range(len(columns))]

        def count(batches, done=done, starts=starts):
            for b in batches:
                out = []
                cells = {}
                for k, (c, bits) in enumerate(starts):
                    if c not in cells:
                        column = b.column(c)
                        cells[c] = _ordered_bits(column.drop_null().to_numpy(zero_copy_only=False))
                    found = cells[c]
                    if done:
                        found = found[found >> np.uint64(64 - done) == np.uint64(bits)]
                    n = np.bincount((found >> np.uint64(64 - done - digit)).astype(np.int64) & ((1 << digit) - 1)) if len(found) else np.zeros(0, int)
                    d = np.flatnonzero(n)
                    out.append((np.full(len(d), k), d, n[d]))
                yield pa.record_batch([pa.array(np.concatenate(v), pa.int64()) for v in zip(*out)], names=["k", "digit", "n"])

        # at most 2 ** digit counters a start; its running sums stay in one small group
        counters = x.mapInArrow(count, "k long, digit long, n long").groupBy("k", "digit").agg(F.sum("n").alias("n"))
        upto = counters.withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("digit")))
        if not done:
            counts = {r["k"]: r["n"] for r in upto.groupBy("k").agg(F.max("upto").alias("n")).collect()}
            wanted = {(c, r): (0, r) for c, n in counts.items() for r in ranks_of(n)}
        place = {start: k for k, start in enumerate(starts)}
        asked = [(c, r, place[c, bits], rest) for (c, r), (bits, rest) in wanted.items()]
        if not asked:
            return {}, {}
        hit = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(r).cast("long").alias("r"), F.lit(k).cast("long").alias("at"), F.lit(rest).cast("long").alias("rest"))
                        for c, r, k, rest in asked])
        met = upto.withColumn("w", F.explode(F.filter(hit, lambda w: (w["at"] == F.col("k")) & (w["rest"] < F.col("upto")) & (w["rest"] >= F.col("upto") - F.col("n")))))
        wanted = {(m["c"], m["r"]): ((wanted[m["c"], m["r"]][0] << digit) | m["digit"], m["rest"]) for m in met.select(
            "w.c", "w.r", "digit", (F.col("w.rest") - F.col("upto") + F.col("n")).alias("rest")).collect()}
    return {key: _double_of(bits) for key, (bits, _) in wanted.items()}, counts


def exact_quantiles(df: DataFrame, columns, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, p, value): linear-interpolated quantiles, nulls ignored; a column without values has no row.

    The two ranks around each quantile are selected by their bits: the input is
    read once a pass, and what is shuffled and kept does not grow with it.
    """
    columns, rows = list(columns), []
    found, counts = select_ranks(df, columns, lambda n: {int(f((n - 1) * p)) for p in probs for f in (np.floor, np.ceil)})
    for c, n in sorted(counts.items()):
        for p in probs:
            h = (n - 1) * p
            lo, hi = found[c, int(np.floor(h))], found[c, int(np.ceil(h))]
            rows.append((columns[c], float(p), lo if lo == hi else float(lo + (hi - lo) * (h - np.floor(h)))))
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


def describe_numeric(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (exact, linear), max per column (A3)."""
    columns = list(columns)
    wide = df.agg(*[
        F.struct(F.lit(c).alias("column_name"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                 F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")).alias(f"_{i}")
        for i, c in enumerate(columns) for v in [F.col(c).cast("double")]
    ])
    moments = wide.select(F.inline(F.array(*[f"_{i}" for i in range(len(columns))])))
    q = exact_quantiles(df, columns).groupBy("column_name").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    q = q.toDF("column_name", "p25", "p50", "p75")
    return moments.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def correlation_long(df: DataFrame, columns, groups: int = 32) -> DataFrame:
    """Pearson correlation of every column pair (a < b by position), missing values (null, NaN) dropped per pair.

    One pass: a task adds up, for its rows less one row of the table, the
    products of value and value, value and presence, square and presence, and
    presence and presence of all pairs. These sums are added in ``groups``
    groups of tasks, so that only few of them reach the driver. A pair without
    spread in a column, or without common rows, gives NULL.
    """
    columns = list(columns)
    d, spark = len(columns), df.sparkSession
    schema = "column_a string, column_b string, corr double"
    x = _arrow_doubles(df, columns)
    one = x.first()
    if one is None:
        return spark.createDataFrame([(a, b, None) for a, b in combinations(columns, 2)], schema)
    shift = np.nan_to_num(np.array([0.0 if v is None else v for v in one], float))

    def products(batches):
        from pyspark import TaskContext

        total = np.zeros((4, d, d))
        for b in batches:
            v = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], axis=1) - shift
            there = ~np.isnan(v)
            v, there = np.where(there, v, 0.0), there.astype(float)
            total += np.stack([there.T @ there, v.T @ v, v.T @ there, (v * v).T @ there])
        yield pa.record_batch([pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def added(table: pa.Table) -> pa.Table:
        return pa.table({"sums": pa.array([sum(np.frombuffer(s) for s in table.column("sums").to_pylist()).tobytes()], pa.binary())})

    sums = x.mapInArrow(products, "part int, sums binary").groupBy("part").applyInArrow(added, "sums binary").collect()
    n, sxy, sx, sxx = sum(np.frombuffer(r["sums"]) for r in sums).reshape(4, d, d)
    spread_x, spread_y = n * sxx - sx * sx, n * sxx.T - sx.T * sx.T
    rows = []
    for i, j in combinations(range(d), 2):
        known = spread_x[i, j] > 1e-12 * n[i, j] * sxx[i, j] and spread_y[i, j] > 1e-12 * n[i, j] * sxx[j, i]
        corr = (n[i, j] * sxy[i, j] - sx[i, j] * sx[j, i]) / np.sqrt(spread_x[i, j] * spread_y[i, j]) if known else None
        rows.append((columns[i], columns[j], None if corr is None else float(corr)))
    return spark.createDataFrame(rows, schema)


def head_invoices(df: DataFrame, n: int = 10, order: str = "invoice_id") -> DataFrame:
    """First ``n`` rows in a total order (O3): a top-k, not a global sort."""
    return df.orderBy(order).limit(n)
