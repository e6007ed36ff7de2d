"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8) and
``BENCH_REPEATS`` (default 3).  Each query runs once to warm up, then the median
of the repeats counts.  File queries export their files during the warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from slabwise import build_session
from slabwise.plans import QUERIES

HEADLINE = (
    "count_cells avg_all subarray stdev_by_dim stats_by_dim subarray_stdev slab_subarray_stdev unroll linearize "
    "pack_slabs unpack_slabs slab_grid chunk_plan dense_check array_holes cell_to_slab split_attrs vlen_unwrap "
    "type_int decode_bytes number_text dump_records dump_frames align_frames frame_time frame_window_avg "
    "fits_scan hdf5_scan hyperslab_read attr_read hdf5_catalog fits_catalog store_array frame_stream"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for attempt in range(repeats + 1):
            started = time.perf_counter()
            # Every row is computed; a count would let Spark skip the columns.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:
                taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken), 4)
    spark.stop()
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
