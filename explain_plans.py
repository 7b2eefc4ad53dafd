"""Write PLANS.md: formatted physical plans of the main jobs (operator tree,
exchanges, pushed filters, read schemas).

    python explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arrears.operators.clean import clean_invoices  # noqa: E402
from arrears.operators.features import invoice_features  # noqa: E402
from arrears.operators.open_invoices import open_invoice_features, open_invoice_rows  # noqa: E402
from arrears.params import HistoryParams  # noqa: E402
from arrears.plans.preprocess import features_table, preprocess  # noqa: E402
from arrears.session import build_session  # noqa: E402
from arrears.sources.invoices import invoices_table, with_hot_pair  # noqa: E402

KEEP = re.compile(r"^(Arguments: (hashpartitioning|rangepartitioning|HashedRelation|\[)|PushedFilters|ReadSchema)")


def formatted(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    keep = []
    node = None
    for line in details.splitlines():
        if re.match(r"^\(\d+\) ", line):
            node = line
        elif KEEP.match(line) and node:
            keep.append(f"{node}: {line[:220]}")
    return tree.strip() + "\n\n" + "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    inv = invoices_table(spark, sf)
    clean = clean_invoices(inv)
    out = ["# PLANS", "", f"Physical plans at `{sf}` (`explain_plans.py`). Trees are before AQE; "
           "exchanges that appear in two branches are reused at run time. The last two sections turn "
           "auto-broadcast off, which is the join shape when the per-pair tables are large.", ""]

    def section(title, df):
        out.extend([f"## {title}", "", "```", formatted(df), "```", ""])

    hot = lambda: invoice_features(clean_invoices(with_hot_pair(inv)), HistoryParams(max_chunk_rows=20_000))
    section("Cleaning: filters pushed into the Parquet scan", clean)
    section("Pair history, no hot pair: one exchange on the pair", features_table(inv, persist=False))
    section("Pair history with a hot pair (a third of all rows) split into day chunks", hot())
    section("Training set from the stored feature table (bounds and maximum folded in as literals)",
            preprocess(inv))
    section("Open invoices: as-of history state", open_invoice_features(features_table(inv), open_invoice_rows(inv)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    section("Pair history, no hot pair, auto-broadcast off", features_table(inv, persist=False))
    section("Pair history, hot pair, auto-broadcast off", hot())
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
