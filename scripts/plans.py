"""Write PLANS.md: the final (adaptive) physical plan of every batch query.

Usage: python scripts/plans.py [sf_dir]   (default /root/testdata/sf0.01)
Each query is executed once (noop sink) so the plan shown is the one AQE
settled on; lines are trimmed to the operator and its key arguments.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def condensed(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if "Initial Plan" in line:  # the final plan comes first; drop the initial one
            break
        if not line.strip() or line.lstrip().startswith(("+- ==", "== ")):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "FileScan" in line or "Scan parquet" in line:
            m = re.search(r"(.*?(FileScan \w+|Scan parquet\s*\S*))", line)
            keep = [m.group(1) if m else line[:60]]
            for key in ("PushedFilters", "ReadSchema"):
                hit = re.search(key + r": (\[[^\]]*\]|struct<[^>]*>)", line)
                if hit:
                    keep.append(f"{key}: {hit.group(1)[:90]}")
            line = "  ".join(keep)
        out.append(line[:150])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    parts = ["# Physical plans (final adaptive plans, local[8], sf0.01)\n",
             "Generated by `python scripts/plans.py`. Streaming queries are omitted (their plans",
             "are per micro-batch); see README for their shape.\n"]
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        physical = fn(spark, sf_dir)._jdf.queryExecution().executedPlan()
        physical.execute().count()  # run this very plan so AQE settles its final form
        plan = physical.toString()
        parts.append(f"## {name}\n\n```\n" + "\n".join(condensed(plan)) + "\n```\n")
    with open("PLANS.md", "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
