"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query runs in full (all columns, written to
the no-op sink); the best of two runs after one warm-up of the session is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxledger.session import build_session  # noqa: E402
from boxledger.showcase import QUERIES  # noqa: E402

HEADLINE = [
    "conform", "latest_per_key", "apply_dq", "dq_results", "upsert", "delete_insert", "assign_surrogate_keys", "scd2_patron",
    "point_in_time_join", "append_xref", "golden_record", "fact_ticket_sales", "performance_sell_through", "donor_status_by_fy",
    "donor_retention", "subscriber_renewal", "audience_mix", "income_statement", "budget_vs_actual", "cash_flow_monthly", "build_recon",
    "room_utilisation", "email_campaign_performance", "ad_spend_by_series", "gold_integrity", "finance_integrity", "finance_periods",
    "statement_of_activities", "measures_ticketing", "measures_fundraising",
]


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, sf_dir, "grouped")
    seconds = {name: round(min(timed(spark, sf_dir, name) for _ in range(2)), 3) for name in HEADLINE}
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
