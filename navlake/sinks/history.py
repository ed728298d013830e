"""NAV tables by year: full write, loads beside the base, compaction, raw layer, re-layout, retention.

A writer of the base replaces only the years its rows fall into. A replaced partition is
staged aside and put in place when the whole job commits, so lost executors and retried
tasks leave the old data readable until then. A merge writes its own rows only, as a load
beside the base; they count from the moment its log entry is written (``sources.layers``).
"""

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from navlake.functions.periods import as_of_date
from navlake.operators.dedupe import dedupe_nav
from navlake.operators.labels import filter_universe
from navlake.schema import FEED_ORDER, KEY, NAV_COLUMNS
from navlake.sources.layers import (
    LOG_SCHEMA, bucketed_table, find_history, layers, live_entries, loads_of, log_of, read_log)
from navlake.sources.tables import as_nav_history, find_table, read_raw_nav

# Fixed value: years of raw files kept by default.
RETENTION_YEARS = 5

# Raw rows that a task and a bucket of a rebuild take, so that the memory of a task stays the same
# as the history grows.
TASK_ROWS, BUCKET_ROWS = 250_000, 1_000_000
SPLIT_BYTES = "16m"


def _replace_partitions(rows: DataFrame, path: str, partitions: list[str]) -> None:
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )


def _seen_years(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and the calendar years that are in them once they are written."""
    seen = Observation()
    return rows.observe(seen, F.collect_set("year").alias("years")), seen


def _append_log(spark: SparkSession, path: str, written: DataFrame, load: int, buckets: int | None) -> None:
    """Log entries for the written rows of a load, or of the base where ``buckets`` is given."""
    entries = written.groupBy("year").agg(
        F.count(F.lit(1)).alias("nav_rows"), F.min("nav_date").alias("first_date"),
        F.max("nav_date").alias("last_date"),
    ).select(
        F.lit(load).alias("load"), F.col("year").cast("int").alias("year"),
        F.lit(buckets is not None).alias("is_base"), F.lit(buckets).cast("int").alias("buckets"),
        "nav_rows", "first_date", "last_date")
    entries.to(spark.createDataFrame([], LOG_SCHEMA).schema).coalesce(1).write.mode("append").parquet(log_of(path))


def _write_base(unique: DataFrame, path: str, buckets: int | None = None) -> None:
    """Replace the years of ``unique`` in the base, bucketed by scheme and sorted by scheme and date.

    All years of a scheme share a bucket, so that what is asked per scheme needs no shuffle, and a
    filter on a scheme reads one bucket. The number of buckets is that of the base there is, else the
    one given, else the session's shuffle partitions.
    """
    spark = unique.sparkSession
    found = layers(spark, path)
    buckets = found.buckets or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = bucketed_table(spark, path, buckets)
    rows, seen = _seen_years(unique.select(*NAV_COLUMNS, F.year("nav_date").alias("year")))
    # The bucket of a row is its partition here, so each task writes one file a year.
    placed = rows.repartition(buckets, "scheme_code").sortWithinPartitions("year", *KEY)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # insertInto takes it from the session only
    try:
        placed.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    years = seen.get["years"]
    if years:
        written = spark.table(table).where(F.col("year").isin(years))
        _append_log(spark, path, written, found.newest + 1, buckets)


def write_nav_history(
    nav: DataFrame, path: str, order_by: list[str | Column] = (), buckets: int | None = None
) -> None:
    """Deduplicate and write; years that ``nav`` does not touch stay as they are."""
    _write_base(dedupe_nav(nav, order_by), path, buckets)


def merge_nav_history(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    order_by: list[str | Column] = (),
    stored_wins: bool = False,
    order_is_unique: bool = False,
) -> int:
    """Add a batch to the history as a load beside it; batch rows replace stored ones of a key.

    The batch is made unique and written; nothing that is stored is read or written again, but for
    ``stored_wins``, which looks up the batch's keys in the years it touches and writes those not there.
    Returns the load's number.
    """
    fresh = dedupe_nav(batch, order_by, order_is_unique)
    if stored_wins:
        stored = find_history(spark, path)
        if stored is not None:
            # A handful of calendar years, whatever the size of the batch.
            years = [r[0] for r in batch.select(F.year("nav_date")).distinct().collect()]
            held = as_nav_history(stored).where(F.col("year").isin(years))
            fresh = fresh.join(held.select(*KEY), KEY, "left_anti")
    load = layers(spark, path).newest + 1
    rows, seen = _seen_years(fresh.select(*NAV_COLUMNS, F.year("nav_date").alias("year")))
    placed = rows.withColumn("load", F.lit(load)).hint("rebalance", F.col("year")).sortWithinPartitions("year", *KEY)
    _replace_partitions(placed, loads_of(path), ["year", "load"])
    years = seen.get["years"]
    if years:
        places = [f"{loads_of(path)}/year={year}/load={load}" for year in sorted(years)]
        written = spark.read.option("basePath", loads_of(path)).parquet(*places)
        _append_log(spark, path, written, load, None)
    return load


def compact_nav_history(spark: SparkSession, path: str) -> list[int]:
    """Write the years that loads lie over into the base; returns them.

    The loads stop counting when the new base's entries are in the log, and until then say what
    the base says already; ``drop_compacted`` removes their files.
    """
    years = layers(spark, path).years
    if years:
        whole = as_nav_history(find_history(spark, path)).where(F.col("year").isin(years))
        _write_base(whole, path)
    return years


def remove_directories(spark: SparkSession, paths: list[str]) -> None:
    """Delete directories with all that is in them, on whatever store they lie."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        at = place(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_compacted(spark: SparkSession, path: str) -> int:
    """Remove the files of loads that no longer count, and those of loads that failed."""
    loads = find_table(spark, loads_of(path))
    if loads is None:
        return 0
    live = set(layers(spark, path).loads)
    there = loads.select("year", "load").distinct().collect()  # a directory each
    gone = [f"{loads_of(path)}/year={y}/load={n}" for y, n in there if (y, n) not in live]
    remove_directories(spark, gone)
    return len(gone)


def backfill_funds(
    spark: SparkSession, rows: DataFrame, path: str, order_by: list[str | Column] = ()
) -> None:
    """Add the history of late-listed funds; rows already stored win over the backfill."""
    merge_nav_history(spark, rows, path, order_by, stored_wins=True)


def stored_span(spark: SparkSession, path: str) -> DataFrame:
    """``date_from, latest``: first and last date of a stored history, from its log alone."""
    return live_entries(read_log(spark, path)).agg(
        F.min("first_date").alias("date_from"), F.max("last_date").alias("latest"))


def write_raw(
    rows: DataFrame, path: str, source: str, ingest_date: dt.date | str | None = None
) -> None:
    """Add rows to the audit layer; a rerun of the same source and day replaces itself.

    Rows are rebalanced by year: adaptive execution joins small years and splits large
    ones into files of the advisory partition size.
    """
    if not re.fullmatch(r"[\w.-]+", source):
        raise ValueError(f"source '{source}' must serve as a directory name")
    placed = rows.withColumns({
        "year": F.year("nav_date"),
        "ingest_date": as_of_date(ingest_date),
        "source": F.lit(source),
    }).hint("rebalance", F.col("year"))
    _replace_partitions(placed, path, ["year", "ingest_date", "source"])


def read_load(
    spark: SparkSession, path: str, source: str, ingest_date: dt.date | str, years: list[int]
) -> DataFrame:
    """The raw rows of one load, read from its own directories only."""
    places = [f"{path}/year={y}/ingest_date={ingest_date}/source={source}" for y in sorted(years)]
    return spark.read.option("basePath", path).parquet(*places)


def write_flat(rows: DataFrame, path: str) -> None:
    """An unpartitioned copy for inspection."""
    rows.write.mode("overwrite").parquet(path)


def rebuild_nav_history(
    spark: SparkSession, raw_path: str, path: str, order_by: list[str | Column] = ()
) -> None:
    """Derive the history again from every raw file, latest ingest first."""
    raw = read_raw_nav(spark, raw_path)
    ingest = [c for c in ("ingest_date", *FEED_ORDER) if c in raw.columns]
    count, merging = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    split = "spark.sql.files.maxPartitionBytes"
    before = {c: spark.conf.get(c) for c in (count, merging, split)}
    rows, few = raw.count(), int(before[count])  # counted by the footers of the files
    if rows > few * TASK_ROWS:  # scans and shuffles take these from the session only
        spark.conf.set(count, -(-rows // TASK_ROWS))
        spark.conf.set(merging, "false")
        spark.conf.set(split, SPLIT_BYTES)  # a task first reduces the rows of its own split
    try:
        write_nav_history(raw, path, list(order_by) or ingest, max(few, -(-rows // BUCKET_ROWS)))
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)


def relayout_scoped(nav: DataFrame, universe: DataFrame, path: str) -> None:
    """Write the rows of the universe's schemes, laid out by year."""
    _write_base(filter_universe(nav, universe), path)


def relayout_raw_scoped(raw: DataFrame, universe: DataFrame, path: str) -> None:
    """The same for raw rows, which keep their own partitions; empty ones are not written."""
    partitions = [c for c in ("year", "ingest_date", "source") if c in raw.columns]
    _replace_partitions(filter_universe(raw, universe), path, partitions)


def retain_years(
    rows: DataFrame, as_of: dt.date | str | None = None, years: int = RETENTION_YEARS
) -> DataFrame:
    """Rows of the last ``years`` years; a condition on the partition column alone."""
    return rows.where(F.col("year") >= F.year(as_of_date(as_of)) - years)


def expired_raw(
    spark: SparkSession, path: str, as_of: dt.date | str | None = None, years: int = RETENTION_YEARS
) -> DataFrame:
    """Raw partitions older than ``years`` years, by their directory names, with their rows.

    They are listed, not removed; ``drop_expired_raw`` does that.
    """
    raw = spark.read.option("mergeSchema", "false").parquet(path)
    return (
        raw.where(F.col("year") < F.year(as_of_date(as_of)) - years)
        .groupBy("year", "ingest_date", "source").agg(F.count(F.lit(1)).alias("raw_rows"))
    )


def drop_expired_raw(
    spark: SparkSession, path: str, as_of: dt.date | str | None = None, years: int = RETENTION_YEARS,
    dry_run: bool = True,
) -> list[int]:
    """The years of the raw layer older than ``years`` years; removed unless ``dry_run``.

    Whole year directories go; nothing else is read or written.
    """
    expired = expired_raw(spark, path, as_of, years).select("year").distinct().orderBy("year")
    gone = [r["year"] for r in expired.collect()]  # calendar years
    if not dry_run:
        remove_directories(spark, [f"{path}/year={year}" for year in gone])
    return gone


def already_loaded(spark: SparkSession, path: str, nav_date: dt.date | None) -> bool:
    """Whether a date is in the history; reads one partition, up to the first match.

    A date outside the span that the log names is not looked for.
    """
    if nav_date is None:
        return False
    span = stored_span(spark, path).first()
    if span["latest"] is not None and not span["date_from"] <= nav_date <= span["latest"]:
        return False
    table = find_history(spark, path)
    if table is None:
        return False
    held = as_nav_history(table).where(
        (F.col("year") == nav_date.year) & (F.col("nav_date") == F.lit(nav_date))
    )
    return not held.isEmpty()
