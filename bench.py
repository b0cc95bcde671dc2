"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of given tables, BENCH_CPUS the number of local threads. Each query
is run to the end into a sink that drops the rows; nothing is kept between queries, so every
ledger query pays for its whole run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from gainledger.queries import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "q_date_range_scan",
    "q_quote_bounds",
    "q_universe_list",
    "q_invest_class",
    "q_sse_trade",
    "q_sse_margin",
    "q_sse_transfer",
    "q_sse_ipo",
    "q_sse_dividend",
    "q_sse_conversion",
    "q_szse_trade",
    "q_szse_followon",
    "q_szse_conversion",
    "q_holding_asof",
    "q_top10_holder",
    "q_flag_lockup",
    "q_sse_gap",
    "q_ledger_all",
    "q_final_report",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("gainledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    spark = session()
    run(spark, "q_universe_all")  # start of the JVM and of code generation, not measured
    seconds = {name: round(run(spark, name), 3) for name in HEADLINE}
    spark.stop()
    sf = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
