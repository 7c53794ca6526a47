"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the test-data folder, BENCH_CPUS the number of local cores. After a few queries to warm up the JVM each runs once to warm up and then
BENCH_RUNS times (3 by default); the median counts. A query's time includes building its DataFrame, with all the
tables it writes on the way, and writing the result to the ``noop`` sink.
"""

import json
import os
import statistics
import sys
import time

HEADLINE = (
    "fact_message_content_daily",
    "fact_message_conversation_daily",
    "fact_conversation_sm_daily",
    "merge_message_content",
    "merge_message_conversation",
    "merge_conversation_sm",
    "dim_agent_daily",
    "dim_content_type_daily",
    "scd_agent",
    "acc_users_daily_roll",
    "uau_daily",
    "uau_monthly",
    "uau_total",
    "uau_cross_natco",
    "backfill_dims",
    "backfill_facts",
    "backfill_average_duration",
    "backfill_users",
    "run_daily_all",
)


def main() -> None:
    from checks.catalog import QUERIES
    from checks.compare import session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names[:4]:  # the first queries would pay for starting the JVM's compiler
        run(name)
    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{seconds[name]:8.2f}s {name}", file=sys.stderr, flush=True)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
