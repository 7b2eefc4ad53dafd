"""Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import BUCKET_EDGES, BUCKET_LABELS, DECAY_ALPHA, MIN_YEAR


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_true(cond: Column) -> Column:
    """``NOT cond`` that keeps rows where ``cond`` is NULL (pandas ``~(x > 0)`` semantics)."""
    return ~F.coalesce(cond, F.lit(False))


def in_year_range(c, max_year: Column, min_year: int = MIN_YEAR) -> Column:
    """Year in [min_year, max_year], or the value is NULL."""
    y = F.year(col(c))
    return y.between(F.lit(min_year), max_year) | col(c).isNull()


def discount_offered(c="due_discount_date") -> Column:
    """1 when a discount date exists, else 0."""
    return col(c).isNotNull().cast("int")


def delay_days(payment="payment_date", due="due_date") -> Column:
    """Calendar days from due date to payment date."""
    return F.datediff(col(payment), col(due))


def payment_bucket(delay="delay_days", edges=BUCKET_EDGES) -> Column:
    """Right-closed 15-day buckets 0..len(edges) (C12); NULL delay gives NULL."""
    d = col(delay)
    expr = None
    for i, edge in enumerate(edges):
        expr = F.when(d <= edge, F.lit(i)) if expr is None else expr.when(d <= edge, F.lit(i))
    return expr.when(d.isNotNull(), F.lit(len(edges)))


def bucket_label(code, labels=BUCKET_LABELS) -> Column:
    """Bucket code -> text label (C13); unknown codes stay as their text."""
    c = col(code)
    expr = None
    for i, label in enumerate(labels):
        cond = c == i
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(c.cast("string"))


def decay_weighted(c, alpha: float = DECAY_ALPHA) -> Column:
    """The value weighed by a geometric decay in itself: large values fade at rate ``alpha``."""
    x = col(c)
    return F.lit(alpha) * F.pow(F.lit(1 - alpha), x) * x


def minmax(c, lo: Column, hi: Column) -> Column:
    """``(x - lo) / (hi - lo)``; NULL when the column is constant."""
    return F.try_divide(col(c) - lo, hi - lo)
