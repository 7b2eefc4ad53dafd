"""Operator 3, mixing sources to target weights by pivotal dependent rounding.

Every document of a source is due the same number of copies, target / size of
the source. Its whole part is taken; its fraction is rounded so that the words
taken come out at the target, not only on average: two documents with fractions
p and q play for mass, one gains what the other loses in words, with chances
that keep both expectations, until one fraction is 0 or 1. The other plays on.

The games form a distributed reduction tree: documents are dealt by a hash of
doc_id into groups of one source (so a source with a third of all rows fills
many groups), each group leaves at most one open fraction, and the open ones of
``fan_in`` groups play the next round, until one is left per source, rounded by
itself. A source therefore misses its target by less than one document.
Draws are hashes of the players' ids, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrears.llm.common import documents, mix, word_counts
from arrears.session import materialize

GROUP_DOCS = 4096
FAN_IN = 64
_ROW = "doc_id long, source string, size long, source_size long, target double, whole long, slot long, part double, up long"


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of every whole text; null text has none."""

    def run(batches):
        for b in batches:
            yield pa.record_batch({"doc_id": b.column("doc_id"), "source": b.column("source"),
                                   "size": pa.array(word_counts(b.column("text")), pa.int64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, source string, size long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes dealt by weight, no source above ``cap`` times its size.

    Weights repeat over the sources in code point order, null last. With the
    sources in order of cap / weight, a source is capped when its share of what
    the earlier ones leave is still above its cap; the first that is not sets
    the level of all later ones.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") - 1) % len(weights) + 1))
    per = per.withColumn("top", F.col("source_size") * float(cap))
    by_ratio = Window.orderBy(F.col("top") / F.col("w"), "k")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("left", float(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
    per = per.withColumn("level", F.col("left") / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    per = per.withColumn("level", F.when(F.col("level") * F.col("w") <= F.col("top"), F.col("level")))
    per = per.withColumn("level", F.first("level", ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return per.select("source", "source_size", F.least("top", F.coalesce(F.col("level") * F.col("w"), F.col("top"))).alias("target"))


def _play(seed: int, last: bool):
    """One group's games; rows with a null ``up`` are open, at most one stays so (none if ``last``)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("doc_id", "ascending")])  # the last open fraction is a short text
        ids = np.array([0 if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
        size, part = table.column("size").to_numpy().tolist(), table.column("part").to_numpy().tolist()
        n = len(ids)
        salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(seed))
        draw = ((mix(ids.view(np.uint64) * np.uint64(3) + salt) >> np.uint64(11)) / 2.0**53).tolist()
        up: list[int | None] = [None] * n
        held = -1
        for i in range(n):
            if part[i] <= 1e-12 or part[i] >= 1 - 1e-12 or size[i] == 0:
                up[i] = int(part[i] >= 0.5 and size[i] > 0)
                continue
            if held < 0:
                held = i
                continue
            a, b, ratio = held, i, size[i] / size[held]
            p, q = part[a], part[b]
            gain, loss = min(1 - p, q * ratio), min(p, (1 - q) * ratio)
            if draw[i] * (gain + loss) < loss:
                p, q = (1.0, q - (1 - p) / ratio) if 1 - p <= q * ratio else (p + q * ratio, 0.0)
            else:
                p, q = (0.0, q + p / ratio) if p <= (1 - q) * ratio else (p - (1 - q) * ratio, 1.0)
            part[a], part[b] = p, q
            held = -1
            for x in (a, b):
                if part[x] <= 1e-12 or part[x] >= 1 - 1e-12:
                    up[x] = int(part[x] >= 0.5)
                else:
                    held = x
        if last and held >= 0:
            up[held] = int(draw[held] < part[held])
        at = table.schema.get_field_index
        table = table.set_column(at("part"), "part", pa.array(part, pa.float64()))
        return table.set_column(at("up"), "up", pa.array(up, pa.int64()))

    return run


def mix_copies(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 1,
               group_docs: int = GROUP_DOCS) -> DataFrame:
    """Copies of every document so that each source's words come to its target.

    ``docs`` needs doc_id, source and text; other columns are ignored. Returns
    one row per input row: doc_id, source, size (words), source_size, target
    (its source's), copies, taken (copies * size).

    Null or empty texts have size 0 and one copy per whole turn of their source.
    Null sources are one source, ordered last. Rows that share a doc_id are
    rounded separately. A corpus without words has targets 0 and takes nothing.
    Empty table: no rows.
    """
    sizes = materialize(document_sizes(docs), "sizes")
    slots = max(1, -(-sizes.count() // group_docs))
    targets = source_targets(sizes, weights, share, cap).withColumnRenamed("source", "its")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("its"))).withColumn("due", due).select(
        "doc_id", "source", "size", "source_size", "target", F.floor("due").cast("long").alias("whole"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).alias("slot"), (F.col("due") - F.floor("due")).alias("part"),
        F.lit(None).cast("long").alias("up"))
    settled, level = [], 0
    while True:
        done = materialize(rows.groupBy("source", "slot").applyInArrow(_play(seed + 7919 * level, slots == 1), _ROW), "mixed")
        settled.append(done.filter("up is not null"))
        if slots == 1:
            break
        slots, level = -(-slots // FAN_IN), level + 1
        rows = done.filter("up is null").withColumn("slot", F.floor(F.col("slot") / FAN_IN))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionAll(more)
    copies = F.col("whole") + F.col("up")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_copies(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
