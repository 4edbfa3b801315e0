"""Scale and skew experiment on a multiplied copy of ``events``.

    python tools/scale_check.py [copies] [--hot]

Builds ``copies`` shifted copies of the sf0.1 events (so copies=30 gives 3 million catalogue
lines), optionally rewrites a third of them into one repeated line (one event key holding a
third of all rows), runs the fact build plus a gold model through the ``noop`` sink and
reports wall time and the per-task time spread of every stage from Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tectonic.plans import bronze, gold, silver  # noqa: E402
from tectonic.queries import dim  # noqa: E402
from tectonic.session import build_session  # noqa: E402
from tectonic.sources.fixtures import seed_lines  # noqa: E402


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 and sys.argv[1].isdigit() else 10
    hot = "--hot" in sys.argv
    log_dir = tempfile.mkdtemp(prefix="tectonic-evlog-")
    spark = build_session("local[8]", shuffle_partitions=64, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    base = spark.read.parquet("/root/testdata/sf0.1/events.parquet").select("event_id", "user_id")
    many = base.select(F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"),
                       "event_id", "user_id") \
        .select((F.col("event_id") + F.col("c") * 1_000_000).alias("event_id"), "user_id") \
        .repartition(64, "event_id")
    if hot:
        many = many.select(F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("event_id"))
                           .alias("event_id"), "user_id")
    lines = seed_lines(spark, many)
    typed = silver.typed_events(bronze.sliced_records(lines, keep=("line_id",)))
    fact = silver.fact_events(typed, dim(spark))
    spark.sparkContext.setJobGroup("run", "run")
    t0 = time.perf_counter()
    gold.quakes_by_province(fact, dim(spark)).write.format("noop").mode("overwrite").save()
    fact.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()

    events = []
    for f in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.inprogress")):
        with open(f, encoding="utf-8", errors="replace") as fh:
            events += [json.loads(x) for x in fh if x.strip()]
    tasks: dict[int, list[int]] = {}
    names = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
        elif e["Event"] == "SparkListenerStageCompleted":
            names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    print(json.dumps({"copies": copies, "lines": copies * 100_000, "hot_key": hot,
                      "wall_sec": round(wall, 2)}))
    for sid in sorted(tasks):
        t = tasks[sid]
        if len(t) > 1 and max(t) > 200:
            print(f"  stage {sid:3d} tasks={len(t):3d} median={statistics.median(t):6.0f}ms "
                  f"max={max(t):6.0f}ms  {names.get(sid, '')}")


if __name__ == "__main__":
    main()
