"""Print the physical plans of the registered queries (abridged), as Markdown.

    python tools/plans.py /root/testdata/sf0.1 > PLANS.md

Each section is the plan of ``QUERIES[name](spark, sf_dir)`` as it is run; the last one shows two
products of the eigenvector iteration with broadcasts off, as they run at scale.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from ledgerprofile.operators import graph  # noqa: E402
from ledgerprofile.plans.catalog import QUERIES, Inputs  # noqa: E402
from ledgerprofile.session import build_session  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|Scan|Union|Generate|Subquery|TakeOrdered")

SECTIONS = [
    ("taxpayer_monthly", "A1: invoices are read where they lie, with pruned columns, and aggregated per (taxpayer, "
     "month) before the registry join; line items meet orders in a join that Catalyst chooses."),
    ("pair_monthly_sales", "A3: one pass over the invoices."),
    ("growth_slope_ridge", "M2: from the stored monthly table, one exchange by taxpayer; window and aggregate share it."),
    ("monthly_autocorrelation", "M1: one exchange; the month index is a literal array."),
    ("industry_top_n", "G6: the industry months are counted and broadcast, so taxpayer months are not shuffled on "
     "(industry, month); partial WindowGroupLimit before the exchange."),
    ("tag_fast_growth_ranked", "T2, distributed cut: range partitioning, local positions, broadcast offsets."),
    ("trade_adjacency", "A8 from the invoices."),
]


def abridged(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            out.append(line[:170])
    return "\n".join(out)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print("# PLANS\n")
    print(f"Abridged physical plans of registered queries at `{sf_dir}` (local[8], 8 shuffle partitions, before AQE). "
          "Generated by `python tools/plans.py`; only exchanges, joins, aggregates, windows and scans are kept.\n")
    for name, note in SECTIONS:
        print(f"## {name}\n\n{note}\n\n```\n{abridged(QUERIES[name](spark, sf_dir))}\n```\n")
    layout = graph._layout(Inputs(spark, sf_dir).adjacency(), graph.DEFAULT_HOT_DEGREE, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    v = layout.nodes.select("hy_dm", "node", F.lit(1.0).alias("v"))
    half = graph._multiply(layout, v).withColumnRenamed("u", "v")
    two = graph._multiply(layout, half)
    print("## two products of trade_eigenvector (broadcast off, as at scale)\n\n"
          "Both edge scans are bucketed with no exchange; the second product joins the first "
          "product's aggregate in place; only partial sums are shuffled.\n")
    print(f"```\n{abridged(two)}\n```\n")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    layout.drop()


if __name__ == "__main__":
    main()
