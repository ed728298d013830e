"""Readers for the Parquet tables, on any path Spark can reach."""

import datetime as dt
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from navlake.schema import FEED_ORDER, LABEL_COLUMNS, MASTER_COLUMNS, NAV_COLUMNS, NAV_SCHEMA
from navlake.sources.layers import find_history, find_table


def require_tables(spark: SparkSession, *paths: str) -> None:
    """Fail early and by name when a lake is not there, as after a mistyped path."""
    missing = [p for p in paths if find_history(spark, p) is None]
    if missing:
        raise FileNotFoundError(f"no Parquet data at {', '.join(missing)}")


def read_scheme_master(spark: SparkSession, path: str) -> DataFrame:
    """The label table: its newest version where ``write_scheme_master`` wrote it."""
    found = find_scheme_master(spark, path)
    return as_scheme_master(spark.read.parquet(path) if found is None else found)


def versions_of(path: str) -> str:
    """Where the versions that replace a plain Parquet master lie."""
    return f"{path.rstrip('/')}_versions"


def find_scheme_master(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that holds the current labels: versions beside a plain one come first."""
    later = find_table(spark, versions_of(path))
    return find_table(spark, path) if later is None else later


def as_scheme_master(table: DataFrame) -> DataFrame:
    if "version" in table.columns:
        newest = table.agg(F.max("version")).first()[0]
        table = table.where(F.col("version") == newest)
    return table.select(*[F.col(c).cast("string").alias(c) for c in MASTER_COLUMNS])


def read_nav_history(spark: SparkSession, path: str, bucketed: bool = False) -> DataFrame:
    """Processed NAV rows, with the partition column ``year`` kept for pruning.

    ``bucketed`` is for questions per scheme: they then need no shuffle of the history.
    """
    found = find_history(spark, path, bucketed)
    return as_nav_history(spark.read.parquet(path) if found is None else found)


def as_nav_history(table: DataFrame) -> DataFrame:
    """The fixed columns of a stored history; a flat copy gets its ``year`` computed."""
    if "year" not in table.columns:
        table = table.withColumn("year", F.year("nav_date"))
    return table.select(
        F.col("scheme_code").cast("string").alias("scheme_code"),
        F.col("nav_date").cast("date").alias("nav_date"),
        F.col("nav").cast("double").alias("nav"),
        F.col("year").cast("int").alias("year"),
    )


def read_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year partition; no rows where the table or the year is missing."""
    table = find_history(spark, path)
    if table is None:
        return spark.createDataFrame([], NAV_SCHEMA).withColumn("year", F.lit(year))
    return as_nav_history(table).where(F.col("year") == year)


def between_dates(
    nav: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Rows in a date range, with the year condition that lets the scan skip partitions."""
    for bound, compare in ((first, Column.__ge__), (last, Column.__le__)):
        if bound is not None:
            nav = nav.where(compare(F.col("nav_date"), F.lit(bound)))
            if "year" in nav.columns:
                nav = nav.where(compare(F.col("year"), F.lit(bound.year)))
    return nav


def read_raw_nav(spark: SparkSession, path: str) -> DataFrame:
    """All raw files as one table: columns by name, codes as strings, absent columns null.

    Spark merges the file footers on executors. Where files disagree on a column's type, tasks
    read the footers of the files, and the files are grouped by the types in them: one
    job for that, and one scan for each group of types that agree, however many loads there are.
    The driver sees the types there have been, and the list of files that any scan holds.
    """
    tables = [_raw_columns(table) for table in _agreeing_tables(spark, path)]
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union


def _agreeing_tables(spark: SparkSession, root: str) -> list[DataFrame]:
    reader = spark.read.option("mergeSchema", "true").option("basePath", root)
    whole = _merged(reader, [root])
    if whole is not None:
        return [whole]
    groups: list[tuple[dict, list[str]]] = []
    for row in file_types(spark, root).collect():
        types = dict(pair.split(" ", 1) for pair in row["types"])
        for held, paths in groups:
            if all(held.get(name, kind) == kind for name, kind in types.items()):
                held.update(types)
                paths += row["paths"]
                break
        else:
            groups.append((types, list(row["paths"])))
    return [reader.parquet(*paths) for _, paths in groups]


def file_types(spark: SparkSession, root: str) -> DataFrame:
    """``types, paths``: the files below ``root`` by the columns and types in their footers.

    The files are listed by Spark and their footers read by its tasks, not their content.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(root).select("path")
    )
    typed = files.mapInPandas(_footers, "path string, types array<string>")
    # Names and types of a file are one short list; files of equal lists meet.
    return typed.groupBy("types").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("types")


def _footers(batches: Iterator) -> Iterator:
    """Columns and types of each file, on any store that pyarrow opens."""
    import pyarrow.fs
    import pyarrow.parquet

    for batch in batches:
        types = []
        for path in batch["path"]:
            if path.startswith("file:"):
                store, place = pyarrow.fs.LocalFileSystem(), path[len("file:"):]
            else:
                store, place = pyarrow.fs.FileSystem.from_uri(path)
            schema = pyarrow.parquet.read_schema(place, filesystem=store)
            types.append(sorted(f"{field.name} {field.type}" for field in schema))
        yield batch.assign(types=types)


def _merged(reader, paths: list[str]) -> DataFrame | None:
    """The files as one table, or None where a column's types cannot be merged."""
    try:
        return reader.parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _raw_columns(table: DataFrame) -> DataFrame:
    types = {"nav_date": "date", "nav": "double"} | dict.fromkeys(
        ["scheme_code", *LABEL_COLUMNS], "string"
    )
    kept = [c for c in [*NAV_COLUMNS, *LABEL_COLUMNS] if c in table.columns]
    ingest = [c for c in ("year", "ingest_date", "source", *FEED_ORDER) if c in table.columns]
    return table.select(*[F.col(c).cast(types[c]).alias(c) for c in kept], *ingest)
