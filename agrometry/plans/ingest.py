"""CSV files to gated raw Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrometry.operators.bronze import SOURCE_FILE
from agrometry.operators.metrics import ingest_metrics, require_ingested
from agrometry.quality import rulesets
from agrometry.quality.rules import Rule
from agrometry.quality.runner import file_status, split_by_file, stored_summary
from agrometry.sources.readers import (
    NO_HEADER, FileCondition, list_files, of_year, read_reference_csv, read_weather_csv, with_year_folder,
)
from agrometry.sources.session import compiled_methods
from agrometry.sources.writers import write_raw

# The sources by name, with their rules.
SOURCES = {"clima": rulesets.CLIMATE, "agricultura": rulesets.AGRICULTURE, "solos": rulesets.SOILS}


def ingest(
    spark: SparkSession, rows: DataFrame, root: str, raw_path: str, rules: Iterable[Rule], files: FileCondition | None = None
) -> DataFrame:
    """Write the clean files of ``root`` as raw Parquet; returns the run's metrics.

    ``rows`` is a CSV scan of those files of ``root`` that fit ``files``.  One bad row rejects its whole file, so rows
    are read twice: once to judge the files, once to write the clean ones.  What earlier runs wrote of other files stays.
    """
    dated = with_year_folder(rows, root)
    summary = stored_summary(dated.drop("year"), rules, SOURCE_FILE)
    clean, _bad = split_by_file(dated, summary, SOURCE_FILE)
    write_raw(clean, raw_path)
    listing = list_files(spark, root)
    if files is not None:
        listing = listing.where(F.coalesce(files(F.col(SOURCE_FILE)), F.lit(False)))
    return require_ingested(ingest_metrics(file_status(listing, summary, SOURCE_FILE)))


def ingest_source(
    spark: SparkSession,
    source: str,
    root: str,
    raw_path: str,
    year: str | None = None,
    file_filter: FileCondition | None = None,
    **options,
) -> DataFrame:
    """Read, judge and write the CSV files of one source: ``clima``, ``agricultura`` or ``solos``.

    ``year`` and ``file_filter`` (a condition on the file's path) choose files from the listing; no other file is opened.
    Weather text is scanned once: its cells go to the scratch folder, where files are judged and clean ones taken from.
    A weather file without a header line is rejected like one with bad rows.
    """
    compiled_methods(spark)
    files = of_year(root, year, file_filter)
    if source == "clima":
        rows = read_weather_csv(spark, root, strict=False, files=files, scan_once=True, **options).drop(NO_HEADER)
    else:
        rows = read_reference_csv(spark, root, files=files, **options)
    return ingest(spark, rows, root, raw_path, SOURCES[source], files)
