"""``python -m fieldsignal BASE OUT [standard|abnormal]``: run the whole flow on a folder."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fieldsignal.plans import flow
from fieldsignal.spec import SeriesSpec


def main() -> None:
    parser = argparse.ArgumentParser(prog="fieldsignal")
    parser.add_argument("base", help="folder with the raw tables")
    parser.add_argument("out", help="folder for tables, reports and the model")
    parser.add_argument("mode", nargs="?", choices=("standard", "abnormal"), default="standard")
    parser.add_argument("--series", nargs="+", default=["station_id"], help="columns that identify a series")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("fieldsignal").getOrCreate()
    spec = SeriesSpec(series=tuple(args.series))
    run = flow.run_abnormal if args.mode == "abnormal" else flow.run_standard
    result = run(spark, args.base, spec)
    flow.save(result, args.out, spec)
    result.summary.show(truncate=False)
    result.metrics.orderBy(F.col("split")).show(truncate=False)


if __name__ == "__main__":
    main()
