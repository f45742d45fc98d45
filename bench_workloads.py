"""

Usage: python bench_workloads.py [rows]. Prints one line per workload and way.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brindle.operators import grouped as g  # noqa: E402
from brindle.session import local_session, settle  # noqa: E402
from brindle.sources.synthetic import sensor_readings  # noqa: E402
from brindle.sources.tables import noop_sink  # noqa: E402

ROWS = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
KEYS, COL = ["device_id", "trip_id"], "sensor_reading"


def plain_pandas(df):
    """One Python call per group, without any check: the usual notebook form."""

    def normalize(pdf):
        return pdf.assign(normalized=pdf[COL].mean() / pdf[COL].std())

    return df.groupBy(*KEYS).applyInPandas(normalize, "device_id int, trip_id int, sensor_reading double, normalized double")


def plain_lists(df):
    def gather(pdf):
        return pdf.groupby("device_id", as_index=False).agg({"trip_id": list, COL: "mean", "sqrt_reading": "mean"})

    return df.groupBy("device_id").applyInPandas(
        gather, "device_id int, trip_id array<int>, sensor_reading double, sqrt_reading double"
    )


def main() -> None:
    spark = local_session("workloads", os.environ.get("BENCH_CPUS", "8"))
    grouped = settle(sensor_readings(spark, ROWS, 100, 1000), "readings")
    kinds = settle(sensor_readings(spark, ROWS, 10_000, 50), "readings")
    rooted = g.sqrt_reading(kinds, COL)
    ways = {
        "normalise by device and trip: plain grouped pandas": lambda: plain_pandas(grouped),
        "normalise by device and trip: coarse grouped pandas": lambda: g.normalize_coarse(grouped, KEYS[:1], KEYS[1:], COL),
        "normalise by device and trip: native": lambda: g.normalize_group(grouped, KEYS, COL),
        "square root: scalar pandas": lambda: g.sqrt_reading_pandas(kinds, COL),
        "square root: native": lambda: g.sqrt_reading(kinds, COL),
        "lists per device: plain grouped pandas": lambda: plain_lists(rooted),
        "lists per device: checked grouped pandas": lambda: g.denormalize_pandas(rooted, "device_id", "trip_id", [COL, "sqrt_reading"]),
        "lists per device: native": lambda: g.denormalize(rooted, "device_id", "trip_id", [COL, "sqrt_reading"]),
    }
    noop_sink(g.sqrt_reading_pandas(kinds, COL))  # start JVM and workers
    for name, way in ways.items():
        started = time.perf_counter()
        noop_sink(way())
        print(f"{name:55s} {time.perf_counter() - started:7.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
