"""Write PLANS.md: the executed physical plan of each headline query.

Automatic broadcast is switched off (static and adaptive thresholds) so the
plans show the strategy a large input gets: at 100 TB no fact-side table or
aggregate over it fits a broadcast threshold.  Broadcasts that remain come
from ``broadcast_checked``'s measurement of bytes, or from tables
whose size is bounded by the partition count.

usage: python scripts/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from quarry.plans import registry  # noqa: E402
from quarry.session import build_session  # noqa: E402


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue().split("\n\n")[0]
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        shuffle_partitions=16,
        extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
    )
    qs = registry.queries()
    print("# Executed plans of the headline queries\n")
    print(f"Generated by `scripts/plans.py` at `{sf_dir}` with automatic broadcast off, AQE on.\n")
    print(
        "Each plan is the final query only. Steps that write an intermediate table run as jobs of their own\n"
        "and appear here as a scan, like the written inputs of the sink and versioned queries. The samples and\n"
        "border totals of the ordered windows, and the key sketches of the skew joins, are small jobs before;\n"
        "their results are literals here. Broadcasts left in the plans are size-checked dimensions or tables\n"
        "bounded by the partition count.\n"
    )
    for name in HEADLINE:
        df = qs[name](spark, sf_dir)
        t = tree(df)
        exchanges = t.count("Exchange") - t.count("BroadcastExchange") - t.count("ReusedExchange")
        print(f"## `{name}`\n")
        print(f"Shuffle exchanges: {exchanges}; broadcasts: {t.count('BroadcastExchange')}\n")
        print("```")
        print(t.strip())
        print("```\n")


if __name__ == "__main__":
    main()
