"""Run one layer, or all, as a Spark job: ``python -m fleetpulse gold --mode append``."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from fleetpulse.params import Params
from fleetpulse.plans.pipeline import Layers, run_all, run_bronze, run_gold, run_silver


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fleetpulse")
    parser.add_argument("layer", choices=("bronze", "silver", "gold", "all"))
    parser.add_argument("--raw", help="folder of the raw CSV files (bronze, all)")
    parser.add_argument("--format", default="parquet", help="table format")
    parser.add_argument("--root", help="folder for external tables")
    parser.add_argument("--catalog", help="catalog to make current first")
    parser.add_argument("--mode", default="overwrite", choices=("overwrite", "append"),
                        help="how gold tables are written")
    parser.add_argument("--run-id", help="keep gold tables by run; saving a run again replaces it")
    parser.add_argument("--config", type=json.loads, default={},
                        help='parameters as JSON, e.g. {"zscore_threshold": 3.0}')
    chosen = parser.parse_args(arguments)
    if chosen.layer in ("bronze", "all") and not chosen.raw:
        parser.error("--raw is needed to read raw files")
    return chosen


def main(arguments: Sequence[str] | None = None) -> None:
    chosen = parse(arguments)
    logging.basicConfig(
        stream=sys.stdout,
        level=logging.INFO,
        format="%(asctime)s %(levelname)s %(name)s: %(message)s",
    )
    logging.getLogger("py4j").setLevel(logging.WARNING)
    # Summary windows are UTC days, so timestamps are read and shown as UTC.
    spark = (
        SparkSession.builder.appName(f"fleetpulse-{chosen.layer}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    params = Params.from_config(chosen.config)
    layers = Layers(fmt=chosen.format, root=chosen.root, catalog=chosen.catalog)
    if chosen.layer == "bronze":
        run_bronze(spark, chosen.raw, layers)
    elif chosen.layer == "silver":
        run_silver(spark, params, layers)
    elif chosen.layer == "gold":
        run_gold(spark, params, layers, chosen.mode, run_id=chosen.run_id)
    else:
        run_all(spark, chosen.raw, params, layers, chosen.mode, run_id=chosen.run_id)


if __name__ == "__main__":
    main()
