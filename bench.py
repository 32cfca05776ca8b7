"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Every query
runs whole, from raw rows to its last row, into a sink that discards them; intermediate
relations a query stores on the way are inside its time. The raw weather rows, which are derived
from the verification tables, are written once before, and the time that takes is reported as
``fixture``; ``whole`` adds it once for every query that reads them, as if each derived its own. Each
query first runs once, untimed, on the smallest tables beside, to load classes and generate
code; nothing computed there is reused.
``BENCH_QUERIES`` picks queries by name, ``all`` takes every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pampero.session import build_session  # noqa: E402
from pampero.sources import adapter  # noqa: E402
from pampero.workspace import new_path  # noqa: E402
from verification.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "stg_weather_daily",
    "weather_dedup",
    "weather_daily_base",
    "heat_index",
    "vpd",
    "weather_daily_quality",
    "dim_location",
    "dim_province",
    "fct_weather_daily",
    "yield_province_campaign",
    "weather_by_campaign",
    "mart_province_campaign",
    "location_snapshot",
    "legacy_daily",
    "incremental_upsert",
    "export_manifest",
    "check_relationships",
]


class StoredWeather:
    """Stands in for the adapter's raw weather: written at first use, then read back."""

    def __init__(self, derive):
        self.derive, self.paths, self.seconds, self.uses = derive, {}, {}, {}

    def __call__(self, spark, sf_dir, form="struct"):
        key = (sf_dir, form)
        if key not in self.paths:
            start, path = time.perf_counter(), new_path(spark, f"raw-{form}")
            self.derive(spark, sf_dir, form).write.parquet(path)
            self.paths[key], self.seconds[key] = path, time.perf_counter() - start
        self.uses[key] = self.uses.get(key, 0) + 1
        return spark.read.parquet(self.paths[key])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    picked = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if picked == "all" else picked.split(",") if picked else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    stored = adapter.raw_weather = StoredWeather(adapter.raw_weather)
    for form in ("struct", "json", "flat"):
        stored(spark, sf_dir, form)
    stored.uses.clear()

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    smallest = Path(sf_dir).parent / "sf0.001"
    warm_up = str(smallest) if smallest.is_dir() else sf_dir
    timings = {}
    for name in names:
        run(name, warm_up)
        timings[name] = run(name, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "fixture": round(sum(v for (d, _), v in stored.seconds.items() if d == sf_dir), 3),
                "whole": round(
                    sum(timings.values())
                    + sum(stored.seconds[k] * n for k, n in stored.uses.items() if k[0] == sf_dir),
                    3,
                ),
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
