"""Summarize the physical plan of every registered query (writes PLANS.md).

    python scripts/show_plans.py [--sf-dir DIR] [--out PLANS.md]

For each query: exchanges (shuffles), broadcast exchanges, sorts, window and
aggregate operators, joins, scans with their read schema, and how many
operators run inside whole-stage codegen. The plan is the one Spark would
run before AQE re-optimizes at runtime.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideline.plans.queries import QUERIES  # noqa: E402
from tideline.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    lines = plan.splitlines()

    def count(pat):
        return sum(1 for line in lines if re.search(pat, line))
    scans = [re.search(r"ReadSchema: (struct<[^>]*>)", line) for line in lines if "FileScan" in line]
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition"),
        "broadcasts": count(r"BroadcastExchange"),
        "sorts": count(r"\bSort \["),
        "windows": count(r"\bWindow \["),
        "hash_aggs": count(r"\bHashAggregate\("),
        "sort_aggs": count(r"\bSortAggregate\("),
        "joins": sorted({m.group(0) for line in lines for m in [re.search(r"\w+Join\b", line)] if m}),
        "codegen_ops": count(r"^\s*[:+\- ]*\*\(\d+\)"),
        "scans": [s.group(1) for s in scans if s],
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    a = ap.parse_args()
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `scripts/show_plans.py` at `{a.sf_dir}` with AQE off (the static plan; at runtime AQE",
           "may coalesce partitions or turn a sort-merge join into a broadcast join). Counts are operators in the",
           "executed plan; `codegen ops` counts operators inside whole-stage codegen.", "",
           "| query | shuffles | broadcasts | sorts | windows | hash aggs | sort aggs | joins | codegen ops | scans (read schema) |",
           "|---|---|---|---|---|---|---|---|---|---|"]
    full = []
    for name, q in QUERIES.items():
        df = q(spark, a.sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        out.append(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['sorts']} | {s['windows']} | {s['hash_aggs']} | "
                   f"{s['sort_aggs']} | {', '.join(s['joins']) or '-'} | {s['codegen_ops']} | "
                   f"{'<br>'.join('`' + x + '`' for x in s['scans'])} |")
        if name in ("price_signals", "session_stats", "session_native", "sliding_avg", "dedup_expiring", "word_count"):
            full += ["", f"## `{name}`", "", "```", plan.rstrip(), "```"]
    # The same operators with the hot-key split active (every user above 50 rows is split): one plan per written step.
    from pyspark.sql import functions as F

    from tideline.operators import ordered
    from tideline.operators.dedup import dedup_expiring
    from tideline.operators.signals import price_signals
    from tideline.operators.windows import sessionize
    from tideline.sources.tables import events
    steps: list[tuple[str, str]] = []
    write = ordered.written

    def recorded(df, name):
        steps.append((name, df._jdf.queryExecution().executedPlan().toString().rstrip()))
        return write(df, name)
    ordered.written = recorded
    ev = events(spark, a.sf_dir)
    split = {"rows_per_split": 50}
    for name, run in (
            ("price_signals", lambda: price_signals(ev, "user_id", "value", "ts", tie="event_id", **split)),
            ("session_stats", lambda: sessionize(ev, ["user_id"], "ts", "6 hours", [F.count(F.lit(1)).alias("n")], tie="event_id", **split)),
            ("dedup_expiring", lambda: dedup_expiring(ev, "user_id", "ts", "10 minutes", tie="event_id", **split))):
        steps.clear()
        final = run()._jdf.queryExecution().executedPlan().toString().rstrip()
        full += ["", f"## `{name}` with hot keys split (`rows_per_split=50`)", "",
                 "`hot-keys` and `cut-points` are the statistics. `scanned` shuffles the raw rows, once; `received` reads",
                 "the last row of each bucket from it; the result joins what each bucket receives to its rows."]
        for step, plan in [*steps, ("result", final)]:
            raw = len(re.findall(r"Exchange hashpartitioning\(.*__b#", plan)) if step == "scanned" else 0
            note = f" ({raw} exchange of raw rows, {plan.count('FileScan')} file scans)" if step == "scanned" else ""
            full += ["", f"### {step}{note}", "", "```", plan, "```"]
    ordered.written = write
    spark.stop()
    with open(a.out, "w") as f:
        f.write("\n".join(out + full) + "\n")
    print(f"wrote {a.out}")


if __name__ == "__main__":
    main()
