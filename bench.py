"""Times the headline queries and prints one JSON line.

Settings come from the environment: BENCH_SF_DIR (folder of the test tables),
BENCH_CPUS (local cores) and BENCH_RUNS (timed runs of each query; the median
counts). Each query runs once before the timed runs. Inputs that are not part of
what is measured - dimension tables and reseller drops - are set up before.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import queries as Q
from ticketmart.plans import loads
from ticketmart.plans.mart import Mart
from ticketmart.plans.refresh import third_party_step
from ticketmart.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Steps that only read: computed in full and thrown away.
STEPS = (
    "own_sales",
    "own_sales_event",
    "own_sales_reseller",
    "own_sales_channel",
    "own_sales_partnership",
    "own_sales_customer",
    "own_sales_in_force",
    "incremental_filter",
    "third_party_normalised",
    "third_party_partnership",
    "third_party_event",
    "third_party_enriched",
    "third_party_in_force",
    "third_party_day",
    "sales_union",
)


def compute(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def measured(run: Callable[[], None], runs: int = RUNS + 1) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:] or times), 3)


def prepared_mart(spark: SparkSession) -> Mart:
    mart = Q.new_mart(spark, SF_DIR, Q.shared_drops(spark, SF_DIR))
    loads.refresh_dimensions(mart)
    return mart


def daily_loads(spark: SparkSession) -> dict[str, float]:
    """The two daily ways to load drops, once each; the drops are delivered before the clock starts."""
    last, created = Q._last_drop_day(spark, SF_DIR), F.to_date("created")
    times = {}
    for name, streamed in (("third_party_daily", False), ("third_party_stream", True)):
        mart = Q.new_mart(spark, SF_DIR, streamed=streamed)
        loads.refresh_dimensions(mart)
        # The stream gets the older drops last: it finds late ones as well.
        first, second = (created >= last, created < last) if streamed else (created < last, created >= last)
        Q.deliver_drops(spark, SF_DIR, mart.drops, first)
        third_party_step(mart)
        Q.deliver_drops(spark, SF_DIR, mart.drops, second)
        times[name] = measured(lambda: third_party_step(mart), runs=1)  # noqa: B023
    return times


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": "UTC",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = Q.all_queries()
    times = {name: measured(lambda: compute(registered[name](spark, SF_DIR))) for name in STEPS}

    mart = prepared_mart(spark)
    times["dimension_refresh"] = measured(lambda: loads.refresh_dimensions(mart))
    times["third_party_initial"] = measured(lambda: loads.load_third_party(mart))
    times["sales_initial"] = measured(lambda: loads.load_sales(mart))
    times["sales_incremental"] = measured(lambda: loads.load_sales_daily(mart))

    times.update(daily_loads(spark))

    rows = {
        "own_sales": registered["own_sales"](spark, SF_DIR).count(),
        "sales_csv": mart.table("sales_csv").count(),
        "sales": mart.table("sales").count(),
    }
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "runs": RUNS,
                "rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
