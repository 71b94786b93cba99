"""Summarise the physical plans of the marts and of the fact load.

Usage: python tools/plans.py <warehouse out_dir> [sf_dir]
Prints, per query, the join strategies, the number of shuffle exchanges and
the scan filters/partition filters, from ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    return {
        "exchanges": len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", tree)),
        "partition_filters": sorted(set(re.findall(r"PartitionFilters: \[([^\]]+)\]", text))),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", text)),
    }


def main() -> None:
    from locastar.operators import facts as FL
    from locastar.plans.marts import MARTS
    from locastar.plans.nightly import read_warehouse
    from locastar.session import get_session
    from locastar.sources.analogue import AS_OF
    out_dir = sys.argv[1]
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    dw = read_warehouse(spark, out_dir)
    for name, fn in MARTS.items():
        print(name, summary(fn(dw, AS_OF)))
    conf = spark.read.parquet(os.path.join(out_dir, "conformed", "stg_conf_locacao"))
    fact, _ = FL.split_rental(FL.resolve_rental(conf, dw))
    print("fl2_rental_fact_load", summary(fact))


if __name__ == "__main__":
    main()
