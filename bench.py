"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query is planned
and run once; results go to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path
from time import monotonic

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plumbline.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "check_completeness",
    "check_uniqueness",
    "check_uniqueness_text",
    "check_range",
    "check_domain",
    "check_date_not_in_future",
    "check_referential_integrity",
    "check_referential_integrity_documents",
    "check_freshness",
    "run_ruleset",
    "run_all",
    "bad_samples",
    "violations_uniqueness",
    "violations_referential_integrity",
    "report_digest",
    "profile_table",
    "profile_top_values",
    "profile_lineitem",
    "profile_documents",
    "key_candidates",
    "propose_rules",
    "proposal_guardrails",
    "merge_rules",
    "suggest_rulesets",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    names = sys.argv[1:] or HEADLINE
    for name in names:
        started = monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(monotonic() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
