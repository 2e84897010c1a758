"""Times the headline steps and prints one JSON line.

The minute table is derived from the supplier table once, before the clock starts, and read
back as Parquet text like any raw input. At sf0.1 it has 20 million rows. Every entry computes
all result tables of its step. e0 reads a tenth of the minutes from CSV, with their order.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import workload
from pulsegrid.config import MINUTE_COLUMNS, Cohort
from pulsegrid.plans import cohort, steps
from pulsegrid.sources.minutes import read_minutes
from pulsegrid.sources.session import local_session
from pulsegrid.sources.settle import settle, shared_folder
from pulsegrid.sources.tables import write_table


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def computed(df):
    compute(df)
    return df


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=2 * cpus)
    spark.sparkContext.setLogLevel("ERROR")
    raw = settle(workload.dense(spark, sf_dir))
    activity, resting, sleep, daily_hr, keys = [
        settle(workload.daily(spark, sf_dir, name)) for name in ("activity", "resting", "sleep", "daily_hr", "keys")
    ]
    cleaned = settle(steps.remove_outliers(raw).minutes)
    daily = settle(steps.find_valid_days(cleaned).daily)

    csv = f"{shared_folder(spark)}/minutes-csv"
    write_table(raw.where("pmod(xxhash64(subject_id), 10) = 0").select(*MINUTE_COLUMNS), csv, "csv")

    def duplicates():
        result = steps.remove_duplicates(raw)
        compute(result.minutes)
        compute(result.summary)

    def outliers():
        compute(steps.remove_outliers(raw, store=computed).summary)

    def valid_days():
        result = steps.find_valid_days(cleaned)
        compute(result.daily)
        compute(result.summary)

    def participants():
        result = steps.find_valid_participants(daily)
        for table in result:
            compute(table)

    def heart_rate():
        result = steps.daily_heart_rate(daily, cleaned)
        compute(result.daily)
        compute(result.summary)

    def coverage():
        result = steps.metric_coverage(keys, activity, resting, daily_hr, sleep)
        compute(result.merged)
        compute(result.report)

    def compliance():
        result = steps.wear_compliance(cleaned)
        compute(result.daily)
        compute(result.summary)
        compute(result.histogram)

    def combined():
        for table in cohort.run(cohort.Sources(raw, activity, resting, sleep), Cohort()).values():
            compute(table)

    queries = {
        "e0_csv_scan": lambda: compute(read_minutes(spark, csv)),
        "e1_collected_days": lambda: compute(steps.count_collected_days(raw)),
        "e2_duplicates": duplicates,
        "e3_outliers": outliers,
        "e4_valid_days": valid_days,
        "e5_participants": participants,
        "e6_heart_rate": heart_rate,
        "e7_missingness": coverage,
        "e8_compliance": compliance,
        "e9_combined": combined,
    }
    seconds = {}
    for name, query in queries.items():
        began = time.perf_counter()
        query()
        seconds[name] = round(time.perf_counter() - began, 2)
    rows, csv_rows = raw.count(), read_minutes(spark, csv, ordered=False, layout="lines").count()
    print(
        json.dumps(
            {
                "metric": "total seconds of steps e1 to e9 over all minutes (e0 scans a tenth of them and is left out)",
                "value": round(sum(s for name, s in seconds.items() if name != "e0_csv_scan"), 2),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "minute_rows": rows,
                "csv_rows": csv_rows,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
