"""Tabulate the physical plan of every registered query (markdown to stdout).

For each key: shuffle exchanges, broadcast exchanges, single-partition
exchanges, parquet scans, whether flat filters were pushed to a scan and
whether partition filters pruned one.  Keys that materialise an intermediate
(landed pages, written reports) show the plan that reads
it back.  Usage: python tools/plan_report.py [sf_dir] [--markdown > PLANS.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dealspark import build_session  # noqa: E402
from dealspark.plans.keys import QUERIES  # noqa: E402


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def single_partition_consumers(txt: str) -> tuple[int, int]:
    """Count single-partition exchanges that move aggregated rows (partial
    aggregates, per-partition counts, per-query totals: bounded by partitions
    or queries) and those that move data rows."""
    single_ids = set()
    for block in re.split(r"\n\s*\n", txt):
        m = re.match(r"\((\d+)\) Exchange\b", block.strip())
        if m and re.search(r"^Arguments: SinglePartition", block, re.M):
            single_ids.add(int(m.group(1)))
    tree = [(len(m.group(1)), m.group(2), int(m.group(3)))
            for m in re.finditer(r"^([ :|+\-]*?)(?:\+- |:- )?(\w+)(?: \w+)* \((\d+)\)$", txt, re.M)]
    to_agg = to_rows = 0
    seen: set[int] = set()
    for k, (indent, name, node_id) in enumerate(tree):
        if name != "Exchange" or node_id not in single_ids or node_id in seen:
            continue
        seen.add(node_id)  # a reused subquery lists the same nodes again
        parent = next((t for t in reversed(tree[:k]) if t[0] < indent), None)
        child = tree[k + 1] if k + 1 < len(tree) and tree[k + 1][0] > indent else None
        if parent and parent[1] in AGGS:
            to_agg += 1          # partial rows of a global aggregate: one per partition
        elif child and child[1] in AGGS:
            to_agg += 1          # a window over aggregated rows (per-partition counts, per-query totals)
        else:
            to_rows += 1
    return to_agg, to_rows


AGGS = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")


def _real_filters(details: str) -> bool:
    """Whether a scan takes a filter other than ``IsNotNull``, which every comparison brings along."""
    lists = re.findall(r"PushedFilters: \[([^\]]*)\]", details)
    return any(f and not f.startswith("IsNotNull(") for x in lists for f in re.split(r", (?=[A-Z])", x))


def table(spark, sf_dir: str) -> list[str]:
    lines = ["| key | shuffles | broadcasts | to one partition: data rows / aggregated rows | parquet scans "
             "| pushed filters | partition filters |",
             "|---|---:|---:|---:|---:|---|---|"]
    for key, fn in QUERIES.items():
        txt = plan_of(fn(spark, sf_dir))
        details = txt.split("\n\n", 1)[1] if "\n\n" in txt else txt
        nodes = set(re.findall(r"^\((\d+)\) (\w+)(?: (\w+))?", details, re.M))  # unique by node id
        shuffles = sum(1 for n in nodes if n[1] == "Exchange")
        bcasts = sum(1 for n in nodes if n[1] == "BroadcastExchange")
        to_agg, to_rows = single_partition_consumers(txt)
        single = f"{to_rows} rows / {to_agg} agg" if (to_rows or to_agg) else "0"
        scans = sum(1 for n in nodes if n[1] == "Scan" and n[2] == "parquet")
        pushed = "yes" if _real_filters(details) else "-"
        pruned = "yes" if re.search(r"PartitionFilters: \[[^\]]", details) else "-"
        lines.append(f"| `{key}` | {shuffles} | {bcasts} | {single} | {scans} | {pushed} | {pruned} |")
    return lines


def main() -> None:
    args = sys.argv[1:]
    sf_dir = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.1")
    spark = build_session("local[8]", 16)
    if "--markdown" in args:
        head, as_run, tail = open(os.path.join(os.path.dirname(__file__), "plans_template.md")).read().split("@@")
        print("\n".join([head.rstrip("\n"), "", *table(spark, sf_dir), "", as_run.strip("\n"), tail.rstrip("\n")]).rstrip("\n"))
    else:
        print("\n".join(table(spark, sf_dir)))
    spark.stop()


if __name__ == "__main__":
    main()
