"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query is planned and
run in full into a sink that discards rows; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starledger.bindings.catalog import QUERIES  # noqa: E402
from starledger.session import build_session  # noqa: E402

HEADLINE = [
    "q1_stores_by_country",
    "q2_stores_by_locality",
    "q3_sales_by_month",
    "q4_online_vs_offline",
    "q5_sales_by_store_type",
    "q6_sales_by_year_month",
    "q7_staff_by_country",
    "q8_german_store_types",
    "q9_sale_frequency",
    "customer_sales_ranked_view",
    "store_sales_breakdown_germany",
    "store_sales_breakdown",
    "store_view",
    "clean_users",
    "clean_stores",
    "clean_cards",
    "clean_products",
    "clean_date_times",
    "clean_orders",
    "resolve_fk_date",
    "resolve_fk_store",
    "lookup_scalar_country",
    "audit_fk",
    "fact_order_key",
    "lead_event_gap",
    "src_html_table",
    "warehouse_end_to_end",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["q1_stores_by_country"](spark, sf_dir).collect()
    seconds = {
        name: round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
        for name in names or HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
