"""Time every registered query once and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.  Results go to Spark's
``noop`` sink, so every row and column is computed and nothing is gathered on the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402
from drayage import registry  # noqa: E402
from drayage.scratch import new_path, release  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM, the code generator and the Python workers before the clock runs.
    warm = spark.range(100_000).selectExpr("id % 10 AS k", "id").groupBy("k").count()
    warm.mapInPandas(lambda frames: frames, "k long, count long").write.format("noop").mode("overwrite").save()
    path = new_path(spark, "warm")
    registry.write(spark.range(1000), "arrow", path=path)
    registry.read(spark, "arrow", path=path).count()

    only = sys.argv[1:]
    seconds = {}
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    release(spark)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
