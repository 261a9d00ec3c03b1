"""Run the lake route from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from agrometry.plans import medallion
from agrometry.plans.ingest import ingest_source


def main() -> None:
    options = argparse.ArgumentParser(prog="agrometry", description=__doc__)
    options.add_argument("--clima", required=True, help="raw weather: a CSV file, a folder of them, or a raw Parquet tree")
    options.add_argument("--culturas", required=True, nargs="+", help="raw crop and soil tables")
    options.add_argument("--lake", required=True, help="folder for the bronze, silver and gold tables")
    options.add_argument("--raw", help="judge CSV files first and keep the clean ones as raw Parquet in this folder")
    given = options.parse_args()
    spark = SparkSession.builder.appName("agrometry").getOrCreate()
    try:
        if given.raw:
            for source, root in zip(("clima", "agricultura", "solos"), (given.clima, *given.culturas)):
                ingest_source(spark, source, root, f"{given.raw}/{source}").show(truncate=False)
            given.clima = f"{given.raw}/clima"
            given.culturas = [f"{given.raw}/{source}" for source, _ in zip(("agricultura", "solos"), given.culturas)]
        for name, answer in medallion.run(spark, given.clima, given.culturas, given.lake).items():
            print(name)
            answer.show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
