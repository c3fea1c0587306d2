"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads. Storing the feeds (`land_feeds`) and building the
event table that the reports read (`build_delay_events`) are timed apart; `delay_events` and the steps
before it run from the feeds every time.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from punctual.checks import catalog, landing  # noqa: E402
from punctual.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = get_session(
        "punctual-bench",
        f"local[{CPUS}]",
        int(CPUS),
        **{
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="punctual-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        started = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - started, 3)

    timed("land_feeds", lambda: (landing.raw_timetable(spark, SF_DIR), landing.positions(spark, SF_DIR)))
    timed("build_delay_events", lambda: landing.all_events(spark, SF_DIR))
    names = sys.argv[1:] or list(catalog.QUERIES)
    for name in names:
        build = catalog.QUERIES[name]
        timed(name, lambda: build(spark, SF_DIR).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
