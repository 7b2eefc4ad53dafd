"""Operator 5, URL allow and block rules by a sort-merge range join on reversed-host keys.

A host's key is its labels in reverse, each ended by a dot (``blog.example.net``
-> ``net.example.blog.``). A rule's host and all its subdomains are then one
interval of keys, all that start with the rule's key, and intervals nest or are
apart. Distinct hosts and rules are range-partitioned and sorted together; a
sweep over each range keeps a stack of the rules whose interval is open. Rules
that open before a range begins are the prefixes of its first key: they are
looked up by an equi-join (one row per range and label) and put in front.

Rules are never broadcast, and pages meet the sweep as distinct hosts only, so
a host with a third of all pages is one row there. Paths are compared per page
against the rules its host keeps open, the longest that fits decides.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import shuffle_partitions
from arrears.session import materialize

#: fixed rules of the query: (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE = "array<struct<rule:string,path:string,verdict:string>>"


def url_host(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.translate(F.regexp_extract(rest, "(?s)^[^/?#]*", 0), _UPPER, _LOWER)).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


def _sweep(table: pa.Table) -> pa.Table:
    """One range in key order: hosts with the rules open over them, from the widest to the narrowest."""
    table = table.sort_by([("key", "ascending"), ("is_host", "ascending")])
    hosts, found, stack = [], [], []
    for key, is_host, host, rules in zip(*(table.column(c).to_pylist() for c in ("key", "is_host", "host", "rules"))):
        while stack and not key.startswith(stack[-1][0]):
            stack.pop()
        if not is_host:
            stack.append((key, (stack[-1][1] if stack else []) + rules))
        elif stack:
            hosts.append(host)
            found.append(stack[-1][1])
    kind = pa.list_(pa.struct([("rule", pa.string()), ("path", pa.string()), ("verdict", pa.string())]))
    return pa.table({"host": pa.array(hosts, pa.string()), "rules": pa.array(found, kind)})


def rules_over_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each distinct host the rules (host, path, verdict) whose host it is or lies under."""
    keyed = rules.select(host_key(F.col("host")).alias("key"), F.struct(
        F.concat("host", "path").alias("rule"), "path", "verdict").alias("r"))
    keyed = keyed.groupBy("key").agg(F.sort_array(F.collect_set("r")).alias("rules"))
    both = hosts.select(host_key(F.col("host")).alias("key"), F.lit(True).alias("is_host"), "host", F.lit(None).cast(_RULE).alias("rules")).unionAll(
        keyed.select("key", F.lit(False), F.lit(None).cast("string"), "rules"))
    places = shuffle_partitions(hosts.sparkSession)
    ranged = materialize(both.repartitionByRange(places, "key").withColumn("range", F.spark_partition_id()), "hosts")
    first = ranged.groupBy("range").agg(F.min("key").alias("first"))
    labels = F.slice(F.split("first", "\\.", -1), F.lit(1), F.col("depth"))
    above = first.select("range", "first", F.explode(F.expr("sequence(1, size(split(first, '[.]', -1)))")).alias("depth"))
    above = above.select("range", "first", F.concat(F.array_join(labels, "."), F.lit(".")).alias("key")).filter("key < first")
    opened = above.join(keyed, "key").select("key", F.lit(False).alias("is_host"), F.lit(None).cast("string").alias("host"), "rules", "range")
    return ranged.unionAll(opened).groupBy("range").applyInArrow(_sweep, f"host string, rules {_RULE}")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", keys=("page_id",)) -> DataFrame:
    """Verdict for every url.

    ``rules`` has host, path and verdict; a rule fits its host and all
    subdomains where the url's path starts with its path. The longest
    fitting rule (host and path together) wins; of equally long ones the
    smallest text, then the smallest verdict. ``rule`` is host + path, null
    where none fits, and the verdict is then ``default``.

    Returns ``keys``, host, path, rule and verdict, one row per row of
    ``pages``; other columns are ignored. Null urls and urls without ``://``
    have empty host and path. Rules with a null host or path are ignored. Empty
    tables: no rows, or ``default`` for every page.
    """
    rules = rules.filter("host is not null and path is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
    link = F.coalesce(F.col(url).cast("string"), F.lit(""))
    cut = pages.select(*keys, url_host(link).alias("host"), url_path(link).alias("path"))
    over = rules_over_hosts(cut.select("host").distinct(), rules)
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    best = F.array_min(F.transform(fits, lambda r: F.struct((-F.length(r["rule"])).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return cut.join(over, "host", "left").withColumn("best", best).select(
        *keys, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op5_url_rules(spark, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


_REST = "substr(url, strpos(url, '://') + 3)"
_HAS = "coalesce(strpos(url, '://') > 0, false)"
OP5_SQL = f"""
WITH u AS (SELECT page_id,
    CASE WHEN {_HAS} THEN translate(regexp_extract({_REST}, '^[^/?#]*', 0, 's'), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
    CASE WHEN {_HAS} THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path FROM pages),
r AS (SELECT * FROM (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}) t(h, p, v)),
f AS (SELECT u.page_id, u.host, u.path, max_by(r.h || r.p, length(r.h || r.p)) AS rule, max_by(r.v, length(r.h || r.p)) AS v
      FROM u LEFT JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
      GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f
"""
