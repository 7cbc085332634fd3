"""Run the pipeline or some of its layers: ``python -m starlift`` or ``spark-submit starlift/__main__.py``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from starlift.config import LakeConfig
from starlift.plans import run_layers
from starlift.plans.pipeline import STEPS
from starlift.session import apply_settings
from starlift.sources.tables import Lake


def parse(arguments: list[str] | None) -> argparse.Namespace:
    default = LakeConfig(root="-")
    parser = argparse.ArgumentParser(prog="starlift", description="CSV extracts to a star schema")
    parser.add_argument("--source", default=None, help="folder with the *.csv extracts, which landing needs")
    parser.add_argument("--layers", default=",".join(STEPS), help="which of them to run, all if left out; a run goes on where one failed")
    parser.add_argument("--root", required=True, help="shared folder of the lake")
    parser.add_argument("--landing", default=None, help="folder of the landing files, ROOT/landing if left out")
    parser.add_argument("--prefix", default="", help="put before each database name")
    parser.add_argument("--format", default=default.table_format, help="table format")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None, help="load day, today if left out")
    parser.add_argument("--parity", action="store_true", help="strict rules instead of the re-runnable ones")
    parser.add_argument("--late-days", type=int, default=0, help="also take unseen rows up to so many days late")
    parser.add_argument("--multiline", action="store_true", help="one task reads each file from end to end")
    parser.add_argument("--null-marker", default=None, help="text that stands for NULL in the extracts")
    parser.add_argument("--calendar-start", type=date.fromisoformat, default=default.calendar_start)
    parser.add_argument("--calendar-end", type=date.fromisoformat, default=default.calendar_end)
    parser.add_argument("--item-key", default=",".join(default.item_key), help="columns that identify an order line")
    parser.add_argument("--name-separator", default=default.name_separator, help="between first and last name")
    parser.add_argument("--reload", action="store_true", help="read extracts again that have not changed")
    given = parser.parse_args(arguments)
    given.layers = given.layers.split(",")
    if strange := set(given.layers) - set(STEPS):
        parser.error(f"no such layer: {', '.join(sorted(strange))}")
    if "landing" in given.layers and given.source is None:
        parser.error("landing needs --source")
    return given


def main(arguments: list[str] | None = None) -> None:
    given = parse(arguments)
    config = LakeConfig(
        root=given.root,
        landing=given.landing,
        prefix=given.prefix,
        table_format=given.format,
        late_days=given.late_days,
        multiline=given.multiline,
        null_marker=given.null_marker,
        calendar_start=given.calendar_start,
        calendar_end=given.calendar_end,
        item_key=tuple(given.item_key.split(",")),
        name_separator=given.name_separator,
        skip_unchanged=not given.reload,
    )
    spark = SparkSession.builder.appName("starlift").getOrCreate()
    apply_settings(spark)
    as_of = given.as_of or spark.sql("SELECT current_date() AS today").first()["today"]
    run_layers(Lake(spark, config.parity() if given.parity else config), given.layers, given.source, as_of)


if __name__ == "__main__":
    main()
