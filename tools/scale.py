"""Time the daily run on a synthetic portfolio with a hot customer.

    python tools/scale.py [--loans 2000000] [--cpus 8] [--share 0.33] [--out FILE]

Prints one JSON line with the seconds of each stage and loans per second.
"""

from __future__ import annotations

import argparse
import json
import pathlib
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from keelstone.operators import aggregates  # noqa: E402
from keelstone.operators import detail, joins, standardise  # noqa: E402
from keelstone.plans import daily  # noqa: E402
from keelstone.sources import generator  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--loans", type=int, default=2_000_000)
    parser.add_argument("--cpus", type=int, default=8)
    parser.add_argument("--share", type=float, default=0.33)
    parser.add_argument("--out", help="file to which the line is appended as well")
    args = parser.parse_args()
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{args.cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(4 * args.cpus))
        .config("spark.checkpoint.dir", f"{root}/shared")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action):
        start = time.perf_counter()
        out = action()
        seconds[name] = round(time.perf_counter() - start, 2)
        return out

    frames = generator.generate_portfolio(
        spark, args.loans, max(args.loans // 20, 100), args.loans // 4,
        skew_share=args.share, heavy=1,
    )

    def store():
        for name, frame in frames.items():
            frame.write.parquet(f"{root}/raw/{name}")

    timed("generate_and_store", store)
    raw = {name: spark.read.parquet(f"{root}/raw/{name}") for name in frames}
    day = generator.BASE_DATE
    wide = 10**12
    plan = daily.Plan(
        f"{root}/out", strict=False,
        row_ranges={"loan_rows": (1, wide), "collateral_rows": (1, wide), "rating_rows": (1, wide)},
    )
    timed("validate", lambda: daily.validate_sources(
        {k: raw[k] for k in ("loans", "collateral", "ratings")}, plan, day))
    staged = timed("standardise", lambda: daily.standardise_all(raw, plan, day))
    fact, _ = timed("calculate", lambda: daily.calculate(staged, plan, day))
    reports = timed("aggregate", lambda: daily.aggregate(fact, plan, day))
    timed("export", lambda: daily.export(fact, reports["rwa_summary"], plan, day))
    run = sum(v for k, v in seconds.items() if k != "generate_and_store")

    def noop(frame):
        frame.write.format("noop").mode("overwrite").save()

    loans, cpty = staged["loans"], standardise.standardise_counterparty(raw["counterparty"])
    timed("counterparty_join_salted", lambda: noop(joins.attach_counterparty(loans, cpty)))
    timed("counterparty_join_plain", lambda: noop(joins.attach_counterparty(loans, cpty, skew=False)))
    timed("detail_without_write", lambda: noop(detail.detail(
        staged["loans"], staged["ratings"], staged["collateral"], staged["fx"], day)))
    timed("multi_level_report", lambda: noop(aggregates.multi_level(fact)))
    line = json.dumps({
        "loans": args.loans, "cpus": args.cpus, "driver_memory_gb": 16,
        "hot_customer_share": args.share,
        "run_seconds": round(run, 2), "loans_per_second": round(args.loans / run),
        "seconds": seconds,
    })
    print(line)
    if args.out:
        with open(args.out, "a") as file:
            file.write(line + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
