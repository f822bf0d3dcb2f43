"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs once to warm up and is then timed, plan building included; every row of
the result is computed (noop sink).
"""

from __future__ import annotations

import json
import os
import time

from goldweft.queries import QUERIES
from goldweft.session import build_session

HEADLINE = (
    "decode_envelope",
    "class_counts",
    "latest_by_key",
    "consolidate",
    "consolidation_stats",
    "golden_upsert",
    "bronze_remaining",
    "load_tables",
    "load_strict_person",
    "assign_surrogate_ids",
    "resolve_person_fk",
    "flat_person_dataset",
    "dump",
    "throughput_blocks",
    "stream_ingest",
    "stream_consolidate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    messages = QUERIES["class_counts"](spark, sf_dir).first().total_raw_messages
    golden = QUERIES["consolidate"](spark, sf_dir).count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "messages": messages,
                "golden_records": golden,
                "golden_records_per_minute": round(golden / times["consolidate"] * 60),
            }
        )
    )


if __name__ == "__main__":
    main()
