"""Runs one stage, a whole run, a refresh of gold, table registration or the analytic questions, as a Spark application.

    spark-submit --py-files meterline.zip meterline/__main__.py run --base s3://lake
"""

from __future__ import annotations

import argparse
import dataclasses
from collections.abc import Sequence

from pyspark.sql import SparkSession

from meterline.config import Layout, build_session
from meterline.operators.summaries import SUMMARIES
from meterline.plans import analytics, stages
from meterline.sources import sinks

STAGES = {name: (lambda options, place=place: options.stages()[place]) for place, name in enumerate(("bronze", "silver", "gold"))}


def _month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="meterline", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=[*STAGES, "run", "refresh", "register", "questions"])
    parser.add_argument("--base", required=True, help="folder of the lake; each layer has its place below it")
    for layer in (field.name for field in dataclasses.fields(Layout)):
        parser.add_argument(f"--{layer}", help=f"path of the {layer} layer, if it is elsewhere")
    parser.add_argument("--run-name", help="name of the run; made from the time by default")
    parser.add_argument("--sender", help="address notices come from")
    parser.add_argument("--recipient", help="address notices go to")
    parser.add_argument("--database", help="catalog database: of register (trips by default), and of a run that registers its tables")
    parser.add_argument("--validate", metavar="BUCKET", help="bronze from the files that pass validation only; names their bucket")
    parser.add_argument("--rebalance", action="store_true", help="bring the silver rows of a month together before writing")
    parser.add_argument("--dynamic", action="store_true", help="replace only the silver months at hand")
    parser.add_argument("--replace-rejects", action="store_true", help="write rejects even if there are none")
    parser.add_argument("--states", action="store_true", help="gold stores what each month adds, for later refreshes")
    parser.add_argument("--months", nargs="+", type=_month, metavar="YYYY-MM", help="months of silver that refresh brings into gold; all by default")
    parser.add_argument("--results", help="folder for the answers to the questions")
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = _arguments().parse_args(arguments)
    spark = spark or build_session()
    moved = {field.name: getattr(options, field.name) for field in dataclasses.fields(Layout)}
    layout = dataclasses.replace(Layout.under(options.base), **{name: path for name, path in moved.items() if path})

    chosen = stages.RunOptions(
        options.validate, options.rebalance, options.dynamic, options.replace_rejects, options.database, options.states
    )
    if options.job in STAGES:
        STAGES[options.job](chosen)(spark, layout)
    elif options.job == "run":
        run = stages.Run(layout, sender=options.sender, recipient=options.recipient)
        if options.run_name:
            run.name = options.run_name
        stages.run_stages(spark, run, options=chosen)
    elif options.job == "refresh":
        stages.refresh_gold(spark, layout, options.months)
    elif options.job == "register":
        stages.register_tables(spark, layout, options.database or "trips").show(truncate=False)
    else:
        gold = {one.name: spark.read.parquet(layout.gold_table(one.name)) for one in SUMMARIES}
        for name, question in analytics.QUESTIONS.items():
            sinks.save_query_result(spark, name, question(gold), options.results or f"{layout.gold}-results")


if __name__ == "__main__":
    main()
