"""Times the layer stages and the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` how often each step runs after a first run
that is not counted; the median counts and ``spread`` has the least and the most. ``BENCH_COMPARE=1`` adds the plans the
stages were chosen over, run in turn with them, under ``compare``. Landing the raw files is preparation and not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from meterline import build_session
from meterline.checks import queries
from meterline.operators import quality, summaries
from meterline.plans import analytics, stages
from meterline.sources import sinks, tables
from meterline.sources.workspace import fresh_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# Operators timed from the given tables; results are computed in full and thrown away.
FROM_TABLES = (
    "dq_metrics", "dq_status", "daily_trip_summary", "top_revenue_days", "monthly_revenue", "payment_breakdown",
    "validate_files", "audit_status_counts", "route_events", "render_notification", "alarm_task_failures",
)


SPREAD: dict[str, tuple[float, float]] = {}


def timed_in_turn(steps: dict[str, Callable[[], object]]) -> dict[str, float]:
    """Median seconds of each step; the steps take turns, so that a slow minute of the machine hits all of them."""
    times: dict[str, list[float]] = {name: [] for name in steps}
    for run in range(RUNS + 1):
        for name, step in steps.items():
            start = time.perf_counter()
            step()
            if run:
                times[name].append(time.perf_counter() - start)
    for name, values in times.items():
        SPREAD[name] = round(min(values), 3), round(max(values), 3)
    return {name: round(statistics.median(values), 3) for name, values in times.items()}


def best(name: str, step: Callable[[], object]) -> float:
    return timed_in_turn({name: step})[name]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def compare(spark, layout) -> dict[str, float]:
    """The obvious plans: counting by separate actions, and a scan and a full sort per summary."""
    bronze = tables.scan_bronze(spark, layout.bronze)
    folder = fresh_folder(spark, "compare")

    def silver_by_actions() -> None:
        tagged = quality.tag_quality(bronze)
        bronze.count()
        quality.valid_rows(tagged).count()
        quality.rejected_rows(tagged).count()
        sinks.write_table(quality.rejected_rows(tagged), f"{folder}/reject", (quality.REASON,))
        sinks.write_table(stages.to_silver(bronze), f"{folder}/silver", sinks.SILVER_PARTITIONS)

    def gold_by_scans() -> None:
        silver = tables.scan_silver(spark, layout.silver)
        silver.count()
        for summary in summaries.SUMMARIES:
            frame = summaries.summarise(silver, summary).orderBy(*summary.keys)
            sinks.write_table(frame, f"{folder}/{summary.name}", summary.stored_by)

    return timed_in_turn(
        {
            "silver": lambda: stages.silver_stage(spark, layout), "silver_by_actions": silver_by_actions,
            "gold": lambda: stages.gold_stage(spark, layout), "gold_by_scans": gold_by_scans,
        }
    )


def main() -> None:
    spark = build_session(
        "meterline-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    layout = queries.landed(spark, SF_DIR)
    timed = {
        "bronze_stage": best("bronze_stage", lambda: stages.bronze_stage(spark, layout)),
        "silver_stage": best("silver_stage", lambda: stages.silver_stage(spark, layout)),
        "gold_stage": best("gold_stage", lambda: stages.gold_stage(spark, layout)),
    }
    gold = {one.name: spark.read.parquet(layout.gold_table(one.name)) for one in summaries.SUMMARIES}
    for name, question in analytics.QUESTIONS.items():
        timed[f"gold.{name}"] = best(f"gold.{name}", lambda question=question: question(gold).collect())
    for name in FROM_TABLES:
        timed[name] = best(name, lambda name=name: consume(queries.QUERIES[name](spark, SF_DIR)))

    report = {
        "metric": "stages and headline queries, total of median times",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE"):
        report["compare"] = compare(spark, layout)
    report["spread"] = SPREAD
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
