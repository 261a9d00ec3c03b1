"""File and table scans."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from agrometry.functions import text
from agrometry.operators.bronze import SOURCE_FILE, union_sources
from agrometry.operators.joins import join_checked
from agrometry.sources.raw_store import read_store, store_columns
from agrometry.sources.scratch import kept_in_scratch

# A condition on the decoded path of a file.
FileCondition = Callable[[Column], Column]

# A weather header starts with a date column followed by an hour column.
WEATHER_HEADER = r'(?i)^\ufeff?"?data[^;:]*;\s*"?hora'
# Rows of a file that has no header line carry this in place of their cells.
NO_HEADER = "_sem_cabecalho"
MULTILINE_OVERFLOW = "_extra"
# Headers of so many files are broadcast to their lines, if they also fit the bound on bytes.
HEADER_FILES = 200_000


def year_folder(path: Column, root: str) -> Column:
    """Year folder of a file; ``raw`` for files right under ``root``.

    The folder is cut out by its slashes: a pattern tried at every sign of a long path takes most of an ingest.
    """
    folder = F.when(~path.contains("/"), "").otherwise(F.substring_index(F.substring_index(path, "/", -2), "/", 1))
    top = root.rstrip("/").rsplit("/", 1)[-1]
    return F.when(folder == top, "raw").when(folder.startswith("year="), F.substr(folder, F.lit(6))).otherwise(folder)


def with_year_folder(df: DataFrame, root: str) -> DataFrame:
    return df.withColumn("year", year_folder(F.col(SOURCE_FILE), root))


def of_year(root: str, year: str | None, also: FileCondition | None = None) -> FileCondition | None:
    """The files in a year's folder under ``root`` that fit another condition as well."""
    if year is None:
        return also
    here = lambda path: year_folder(path, root) == str(year)
    return here if also is None else lambda path: here(path) & also(path)


def _chosen(df: DataFrame, files: FileCondition | None) -> DataFrame:
    """Rows of the files that fit.  The listing alone tells them, so no byte of another file is read."""
    if files is None:
        return df
    return df.where(F.coalesce(files(text.decoded_path(F.col("_metadata.file_path"))), F.lit(False)))


def list_files(spark: SparkSession, root: str, glob: str = "*", year: str | None = None) -> DataFrame:
    """Files under ``root``: name column, bytes and year folder.

    Only the listing is read, never the content.  A file that lies directly
    in ``root`` gets the year ``raw``.  Narrow the result with ``where``.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
        .select(text.decoded_path(F.col("path")).alias(SOURCE_FILE), F.col("length").alias("bytes"))
    )
    found = with_year_folder(found, root)
    return found if year is None else found.where(F.col("year") == str(year))


def _lines(spark: SparkSession, paths: str | list[str], encoding: str, files: FileCondition | None) -> DataFrame:
    """Text lines with their file and their place in it.

    Valid UTF-8 is taken as it is, and only lines with a carriage return meet the pattern.
    """
    decoded = F.decode(F.col("value").cast("binary"), encoding)
    if encoding.upper() in ("UTF-8", "UTF8"):
        decoded = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(decoded)
    return _chosen(spark.read.option("recursiveFileLookup", True).text(paths), files).select(
        F.when(decoded.contains("\r"), F.regexp_replace(decoded, "\r$", "")).otherwise(decoded).alias("line"),
        text.decoded_path(F.col("_metadata.file_path")).alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("place"),
    )


def _is_header(line: Column) -> Column:
    """Is it a weather header?  The pattern is tried only where its first word can stand."""
    return F.lower(F.left(line, F.lit(6))).contains("data") & line.rlike(WEATHER_HEADER)


def _split(line: Column, sep: str) -> Column:
    """Cells of a line; a separator inside quotes does not count."""
    bare = F.split(line, f"{sep}(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)", -1)
    inner = F.transform(bare, lambda c: F.regexp_extract(c, r'(?s)^\s*"(.*)"\s*$', 1))
    cells = F.zip_with(bare, inner, lambda c, q: F.when(c.rlike(r'(?s)^\s*".*"\s*$'), F.replace(q, F.lit('""'), F.lit('"'))).otherwise(c))
    return F.when(line.contains('"'), cells).otherwise(F.split(line, sep, -1))


def _named(header: Column) -> Column:
    """Header cells as column names: blanks and repeats get a position."""
    plain = F.transform(header, lambda c: F.trim(F.regexp_replace(c, "^\ufeff", "")))
    filled = F.transform(plain, lambda c, i: F.when((c == "") | c.isNull(), F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(c))
    return F.transform(
        filled,
        lambda c, i: F.when(F.array_position(filled, c) <= i, F.concat(c, F.lit("."), i.cast("string"))).otherwise(c),
    )


def _by_header(rows: DataFrame, headers: DataFrame, paths, fixed: Sequence[str] | None = None) -> DataFrame:
    """Cells of each row under the names of its own file's header, in one table.

    ``rows`` has file, place and cells; ``headers`` file, begin (its place) and names.  Where each name stands is worked
    out once a file.  Rows up to the header are dropped by place.  Only distinct column names come to the driver.  Rows
    of a file without a header keep nothing but their file, with ``NO_HEADER`` set.
    """
    headers = kept_in_scratch(headers, "cabecalhos")
    if fixed is None:
        names = [r[0] for r in headers.select(F.explode("names")).distinct().collect()]
        if not names:
            raise ValueError(f"nenhum cabeçalho em {paths}")
        first = headers.agg(F.min_by("names", "file")).first()[0]
        names = [*first, *sorted(set(names) - set(first))]
    else:
        names = list(fixed)
    known = headers.select("file", "begin", F.size("names").alias("width"), "names")
    at = F.transform(F.array(*map(F.lit, names)), lambda n: (F.nullif(F.array_position("names", n), F.lit(0)) - 1).cast("int"))
    known = known.withColumn("at", at).drop("names")
    joined = join_checked(rows, known, "file", "left", max_rows=HEADER_FILES)
    if fixed is not None:
        order = F.array(*(F.lit(k) for k in range(len(names))))
        joined = joined.withColumn("at", order).withColumn("width", F.lit(len(names)))
    below = joined.where(F.col("begin").isNull() | (F.col("place") > F.col("begin")))
    fits = below.where(F.col("width").isNull() | (F.size("cells") <= F.col("width")))
    return fits.select(
        *[text.missing_to_null(F.get("cells", F.get("at", F.lit(k)))).alias(n) for k, n in enumerate(names)],
        F.col("width").isNull().alias(NO_HEADER),
        F.col("file").alias(SOURCE_FILE),
    )


def _checked(rows: DataFrame, strict: bool) -> DataFrame:
    """Raise at run time for a file without a header, or leave its rows marked."""
    if not strict:
        return rows
    told = F.concat(F.lit("nenhum cabeçalho em "), F.col(SOURCE_FILE))
    # The error stands in for a column, so that no filter can be moved away from it.
    stop = F.when(F.col(NO_HEADER), F.raise_error(told).cast("string")).otherwise(F.col(SOURCE_FILE))
    return rows.withColumn(SOURCE_FILE, stop).where(F.col(SOURCE_FILE).isNotNull()).drop(NO_HEADER)


def read_weather_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Sequence[str] | None = None,
    encoding: str = "ISO-8859-1",
    strict: bool = True,
    files: FileCondition | None = None,
    scan_once: bool = False,
) -> DataFrame:
    """Hourly weather files: ``;``-separated, with a preamble above the header.

    All columns are strings, plus the source file name.  Each file is read under its own header line, wherever it
    stands; rows with too many cells are dropped, short ones padded.  With ``columns`` these names count, by position,
    in every file, with a header or without.  Else a file without a header is an error, or, unless ``strict``, rows with ``NO_HEADER`` set.
    Only ``files`` that fit are opened.  Text is read twice, for headers and for rows; with ``scan_once`` it is read once
    and its cells are kept in the scratch folder, which pays if the rows are used more than once.
    """
    lines = _lines(spark, paths, encoding, files).where(F.trim("line") != "")
    rows = lines.select("file", "place", _is_header(F.col("line")).alias("top"), _split(F.col("line"), ";").alias("cells"))
    if scan_once:
        rows = kept_in_scratch(rows, "linhas")
    found = rows.where("top").groupBy("file").agg(F.min(F.struct("place", "cells")).alias("h"))
    headers = found.select("file", F.col("h.place").alias("begin"), _named(F.col("h.cells")).alias("names"))
    return _checked(_by_header(rows.drop("top"), headers, paths, columns), strict)


def read_reference_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Sequence[str] | None = None,
    encoding: str = "UTF-8",
    files: FileCondition | None = None,
) -> DataFrame:
    """Crop and soil files: ``,``-separated with a header line, all strings.

    Quoted cells may hold separators and line breaks.  Every file is read whole by one task, as its records may span
    lines, and under its own header.
    """
    first = _lines(spark, paths, encoding, files).where((F.col("place.start") == 0) & (F.trim("line") != ""))
    first = first.groupBy("file").agg(F.min(F.struct("place", "line")).alias("h"))
    width = first.agg(F.max(F.size(_split(F.col("h.line"), ",")))).first()[0] or 0
    width = max(width, len(columns or ()))
    if not width:
        raise ValueError(f"nenhum cabeçalho em {paths}")
    fields = [f"c{k}" for k in range(width)]
    records = (
        spark.read.option("recursiveFileLookup", True)
        .option("encoding", encoding)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .schema(StructType([StructField(n, StringType()) for n in [*fields, MULTILINE_OVERFLOW]]))
        .csv(paths)
    )
    filled = F.array(*fields, MULTILINE_OVERFLOW)
    held = F.array_max(F.transform(filled, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(0)))
    rows = _chosen(records, files).select(
        text.decoded_path(F.col("_metadata.file_path")).alias("file"),
        F.monotonically_increasing_id().alias("place"),
        F.slice(filled, F.lit(1), held).alias("cells"),
    )
    top = rows.groupBy("file").agg(F.min(F.struct("place", "cells")).alias("h"))
    headers = top.select("file", F.col("h.place").alias("begin"), _named(F.col("h.cells")).alias("names"))
    return _by_header(rows, headers, paths, columns).drop(NO_HEADER)


def read_raw(spark: SparkSession, root: str, year: str | None = None) -> DataFrame:
    """Raw Parquet under ``root/year=*/``, keeping ``year`` as a string.

    A year filter prunes partitions at planning time.  Columns that only some files have are kept.  A store of
    ``write_raw`` tells its columns, so no file is opened for them; of other trees all files' schemas are merged.
    """
    if store_columns(spark, root):
        df = read_store(spark, root)
    else:
        df = spark.read.option("basePath", root).option("mergeSchema", True).parquet(root)
    if "year" in df.columns:
        df = df.withColumn("year", F.col("year").cast("string"))
        if year is not None:
            df = df.where(F.col("year") == str(year))
    return df


def read_raw_many(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    return union_sources([read_raw(spark, r) for r in roots])


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_relation(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name, such as ``silver.stg_clima``."""
    return spark.table(name)
