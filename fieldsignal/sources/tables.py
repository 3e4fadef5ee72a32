"""Reading raw station tables: discovery by file name, one table per sheet, tagging."""

from __future__ import annotations

import csv
import logging
import re
from collections import Counter
from collections.abc import Callable, Mapping
from functools import partial, reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.sources.naming import (
    canonical_places, first_of, is_environmental, looks_environmental, to_canonical,
)

log = logging.getLogger(__name__)

# Columns mirrored from the air channel when the soil channel is absent.
MIRRORED = {"earth_humidity": "air_humidity", "earth_temperature": "air_temperature"}

ABNORMAL_LABEL = "Abnormal_Test"


def read_table(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """CSV (all columns as text) or Parquet, by the file ending of path or pattern."""
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if (pattern or path).lower().rstrip("/").endswith(".csv"):
        return reader.option("header", True).csv(path)
    return reader.parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag(df: DataFrame, sheet: str, label: str) -> DataFrame:
    return df.withColumns({"source_sheet": F.lit(sheet), "source_year": F.lit(label)})


def _kept_tables(tables: Mapping[str, DataFrame | Callable[[], DataFrame]], label: str) -> list[DataFrame]:
    """The environmental tables, canonicalised and tagged; one that cannot be read is skipped with a warning."""
    kept = []
    for name, table in tables.items():
        try:
            table = table() if callable(table) else table
            if is_environmental(table):
                kept.append(tag(to_canonical(table), name, label))
            else:
                log.info("table %s holds no environmental readings", name)
        except (PySparkException, Py4JJavaError) as problem:
            log.warning("table %s could not be read: %s", name, problem)
    return kept


def _stacked(kept: list[DataFrame], label: str) -> DataFrame:
    if not kept:
        raise ValueError(f"no environmental table in dataset {label}")
    return union_all(kept)


def stack_tables(tables: Mapping[str, DataFrame | Callable[[], DataFrame]], label: str) -> DataFrame:
    """Canonicalise, tag and stack the environmental tables of one dataset, given as they are or by readers.

    Other tables are left out; a table that cannot be read is skipped with a warning.
    """
    return _stacked(_kept_tables(tables, label), label)


def _children(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(name, full path) of the entries of a folder on any file system Spark can read."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    return sorted((s.getPath().getName(), s.getPath().toString()) for s in files.listStatus(root))


def _first_lines(spark: SparkSession, file: str, count: int = 2) -> list[str]:
    """The first lines of a file that are not blank."""
    jvm, found = spark._jvm, []
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        while len(found) < count and (line := lines.readLine()) is not None:
            if line.strip():
                found.append(line.removeprefix("\ufeff"))
    finally:
        stream.close()
    return found


def _header_names(line: str) -> list[str]:
    """The column names Spark gives to a header: blank ones by position, repeated ones with their position."""
    names = next(csv.reader([line], skipinitialspace=False))
    repeated = {n for n, k in Counter(x.lower() for x in names).items() if k > 1}
    return [f"_c{i}" if not x else f"{x}{i}" if x.lower() in repeated else x for i, x in enumerate(names)]


def _file_key(path: Column) -> Column:
    """A file's URI without scheme and with one leading slash, as listings and scans spell these differently."""
    return F.regexp_replace(path, "^[A-Za-z0-9+.-]+:/*", "/")


def stack_csv_sheets(spark: SparkSession, sheets: Mapping[str, str], label: str) -> DataFrame | None:
    """Canonicalise, tag and stack CSV sheets (files, or folders of files) by one scan of all of them.

    Only the first lines of a file are read here. Columns are read by position and take their
    meaning from the header of their file: the plan grows with the different headers, not with the
    sheets. Sheets without readings or rows are left out, unreadable ones skipped with a warning;
    None if nothing is left.
    """
    headers: dict[tuple[str, ...], int] = {}
    files, known = [], []
    for sheet, path in sheets.items():
        try:
            inside = [x for name, x in _children(spark, path) if not name.startswith(("_", "."))]
            for file in inside:
                lines = _first_lines(spark, file)
                if len(lines) < 2 or not looks_environmental(names := _header_names(lines[0])):
                    log.info("file %s holds no environmental readings", file)
                    continue
                group = headers.setdefault(tuple(names), len(headers))
                uri = spark._jvm.org.apache.hadoop.fs.Path(file).toUri().toString()
                files.append(file)
                known.append((uri, sheet, group))
        except (PySparkException, Py4JJavaError, StopIteration) as problem:
            log.warning("table %s could not be read: %s", sheet, problem)
    if not files:
        return None
    # As an Arrow table it has a measured size, by which Spark chooses the join.
    rows = pa.table({"_uri": [x[0] for x in known], "source_sheet": [x[1] for x in known], "_header": [x[2] for x in known]})
    named = spark.createDataFrame(rows).select(_file_key(F.col("_uri")).alias("_file"), "source_sheet", "_header")
    width = max(map(len, headers))
    schema = ", ".join(f"_{i} string" for i in range(width))
    # Files are named, not globbed: a name may hold characters of a pattern.
    escaped = [re.sub(r"([\[\]{}*?\\])", r"\\\1", x) for x in files]
    scan = spark.read.schema(schema).option("header", True).csv(escaped)
    scan = scan.withColumn("_file", _file_key(F.col("_metadata.file_path"))).join(named, "_file")
    meanings: dict[str, list[tuple[int, list[int]]]] = {}
    for names, group in headers.items():
        for canonical, places in canonical_places(list(names)).items():
            meanings.setdefault(canonical, []).append((group, places))
    columns = []
    for canonical, cases in meanings.items():
        value = F.lit(None).cast("string")
        for group, places in reversed(cases):
            value = F.when(F.col("_header") == group, first_of([F.col(f"_{i}") for i in places])).otherwise(value)
        columns.append(value.alias(canonical))
    return scan.select(*columns, "source_sheet", F.lit(label).alias("source_year"))


def find_datasets(
    spark: SparkSession, base: str, labels: tuple[str, ...] = ("2024", "2025")
) -> dict[str, str]:
    """Per label, the first entry whose name contains it; ``data/raw`` goes before the root.

    An entry is a CSV or Parquet table, or a folder with one table per sheet.
    """
    found: dict[str, str] = {}
    for folder in (f"{base}/data/raw", base):
        for name, path in _children(spark, folder):
            label = next((x for x in labels if x in name), None)
            if label and label not in found:
                found[label] = path
    return found


def load_dataset(spark: SparkSession, path: str, label: str) -> DataFrame:
    """A dataset at ``path``: either one table, or a folder of one table per sheet. CSV sheets share one scan."""
    kinds = (".csv", ".parquet")
    sheets = {n.rsplit(".", 1)[0]: x for n, x in _children(spark, path) if n.lower().endswith(kinds)}
    if path.lower().rstrip("/").endswith(kinds) or not sheets:
        name = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
        return stack_tables({name: partial(read_table, spark, path)}, label)
    texts = {name: x for name, x in sheets.items() if x.lower().endswith(".csv")}
    others = {name: partial(read_table, spark, x) for name, x in sheets.items() if name not in texts}
    stacked = stack_csv_sheets(spark, texts, label)
    return _stacked([*([] if stacked is None else [stacked]), *_kept_tables(others, label)], label)


def load_pair(
    spark: SparkSession, base: str, labels: tuple[str, str] = ("2024", "2025")
) -> tuple[DataFrame, DataFrame]:
    """The two labelled datasets below ``base``."""
    found = find_datasets(spark, base, labels)
    for label in labels:
        if label not in found:
            raise FileNotFoundError(f"no dataset with {label} in its name below {base}")
    first, second = (load_dataset(spark, found[label], label) for label in labels)
    return first, second


def find_abnormal(spark: SparkSession, base: str) -> str | None:
    for folder in (f"{base}/data/raw", base):
        for name, path in _children(spark, folder):
            if "abnormal" in name and name.lower().endswith((".csv", ".parquet")):
                return path
    return None


def mirror_missing_channels(df: DataFrame) -> DataFrame:
    """Absent soil columns are taken from the air column of the same quantity."""
    absent = {
        soil: F.col(air) for soil, air in MIRRORED.items() if soil not in df.columns and air in df.columns
    }
    return df.withColumns(absent) if absent else df


def load_abnormal(spark: SparkSession, path: str | None = None, base: str | None = None) -> DataFrame:
    """A single test table, tagged, with absent soil channels mirrored."""
    path = path or (find_abnormal(spark, base) if base else None)
    if path is None:
        raise FileNotFoundError("no table with 'abnormal' in its name")
    name = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    table = tag(to_canonical(read_table(spark, path)), name, ABNORMAL_LABEL)
    return mirror_missing_channels(table)
