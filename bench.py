"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clicksieve.plans.catalogue import QUERIES  # noqa: E402
from clicksieve.session import build_session  # noqa: E402

HEADLINE = [
    "labelled_samples",
    "decode_wire",
    "distinct_rows_in_window",
    "first_per_user_ttl",
    "negatives_window_1d",
    "negatives_interval_6h",
    "negatives_two_stream",
    "multi_window_negatives",
    "lookup_features",
    "evolve_append",
    "orc_roundtrip",
    "stream_negatives_window",
    "stream_two_stream",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    # The first Python worker and the first compiled stages are not any query's own.
    warm = spark.read.parquet(os.path.join(folder, "events.parquet")).groupBy("event_type").count()
    warm.mapInPandas(lambda frames: frames, warm.schema).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
