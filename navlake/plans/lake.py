"""The tables of one asset class and the jobs that keep them current."""

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from navlake.operators.labels import deep_history_universe
from navlake.schema import FEED_ORDER, LABEL_COLUMNS
from navlake.session import cut_lineage
from navlake.sinks import history, master as master_table
from navlake.sources import feeds, tables


@dataclass(frozen=True)
class Lake:
    """Paths below one root, on whatever file system its scheme names."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/nav"

    @property
    def history(self) -> str:
        return f"{self.root}/processed/nav_history"

    @property
    def master(self) -> str:
        return f"{self.root}/processed/scheme_master"

    @property
    def steps(self) -> str:
        return f"{self.root}/processed/load_steps"


# What a load has done; each is recorded when it is complete.
RAW, HISTORY, LABELS = 1, 2, 3
STEP_SCHEMA = "load_id string, source string, ingest_date string, years array<int>, step int, at timestamp"


@dataclass(frozen=True)
class Load:
    """One load of a source on a day, by the directories of the raw layer it wrote."""

    load_id: str
    source: str
    ingest_date: str
    years: tuple[int, ...]


def record_step(spark: SparkSession, lake: Lake, load: Load, step: int) -> None:
    row = (load.load_id, load.source, load.ingest_date, list(load.years), step, dt.datetime.now())
    spark.createDataFrame([row], STEP_SCHEMA).coalesce(1).write.mode("append").parquet(lake.steps)


def unfinished_loads(spark: SparkSession, lake: Lake) -> list[tuple[Load, int]]:
    """Loads that stopped before their labels, in order, and the last step each has done."""
    steps = tables.find_table(spark, lake.steps)
    if steps is None:
        return []
    last = steps.groupBy("load_id", "source", "ingest_date", "years").agg(
        F.max("step").alias("step"), F.min("at").alias("at"))
    # A handful: each run ends those it finds.
    rows = last.where(F.col("step") < LABELS).orderBy("at").collect()
    return [(Load(r["load_id"], r["source"], r["ingest_date"], tuple(r["years"])), r["step"]) for r in rows]


def _finish(spark: SparkSession, lake: Lake, load: Load, done: int) -> None:
    """The steps of a load after ``done``, from its own rows of the raw layer."""
    stored = history.read_load(spark, lake.raw, load.source, load.ingest_date, list(load.years))
    if done < HISTORY:
        history.merge_nav_history(spark, stored, lake.history, FEED_ORDER, order_is_unique=True)
        record_step(spark, lake, load, HISTORY)
    if set(LABEL_COLUMNS) <= set(stored.columns):
        master_table.refresh_scheme_master(spark, stored, lake.master, FEED_ORDER)
    record_step(spark, lake, load, LABELS)


def resume_loads(spark: SparkSession, lake: Lake) -> int:
    """Do what loads that failed have left undone; returns how many there were.

    A step that was done but not recorded is done again, which changes nothing.
    """
    stopped = unfinished_loads(spark, lake)
    for load, done in stopped:
        _finish(spark, lake, load, done)
    return len(stopped)


def load_rows(
    spark: SparkSession,
    rows: DataFrame,
    lake: Lake,
    source: str,
    ingest_date: dt.date | str | None = None,
    force: bool = False,
    day_of_feed: bool = False,
) -> bool:
    """Load parsed feed rows: guard, raw layer, history, labels. False when skipped.

    The parsed rows are written once before anything looks at them, so the feed text is
    scanned and parsed once; history and labels read the raw layer back, so a lost executor
    costs no more than re-reading that table. Each step is recorded: what an earlier load left
    undone is done first, so a failure between the steps never leaves half a load behind.
    ``day_of_feed`` takes the day of the newest feed file as the ingest date.
    """
    resume_loads(spark, lake)
    rows = cut_lineage(rows)
    # One row for the driver: the last date, a handful of calendar years, the feed's day.
    feed_day = F.max(F.to_date("feed_time")) if day_of_feed else F.lit(None)
    last, years, newest = rows.agg(
        F.max("nav_date"), F.collect_set(F.year("nav_date")), feed_day).first()
    if last is None:
        return False
    if not force and history.already_loaded(spark, lake.history, last):
        return False
    day = ingest_date or newest or dt.date.today()
    history.write_raw(rows, lake.raw, source, day)
    load = Load(uuid.uuid4().hex, source, str(day), tuple(sorted(years)))
    record_step(spark, lake, load, RAW)
    _finish(spark, lake, load, RAW)
    return True


def daily_update(spark: SparkSession, landing: str, lake: Lake, **options) -> bool:
    """Load a daily feed, limited to the schemes of the master."""
    universe = tables.read_scheme_master(spark, lake.master)
    rows = feeds.parse_daily_feed(feeds.read_feed(spark, landing), universe)
    return load_rows(spark, rows, lake, options.pop("source", "daily"), **options)


def labelled_daily_update(spark: SparkSession, landing: str, lake: Lake, **options) -> bool:
    """Load a labelled daily feed; schemes new to it join the master."""
    rows = feeds.parse_labelled_feed(
        feeds.read_feed(spark, landing), feeds.LABELLED_DAILY
    )
    return load_rows(spark, rows, lake, options.pop("source", "daily"), **options)


def backfill_history(spark: SparkSession, landing: str, lake: Lake, **options) -> bool:
    """Load history feeds, limited to the schemes of the master."""
    universe = tables.read_scheme_master(spark, lake.master)
    rows = feeds.parse_history_feed(feeds.read_feed(spark, landing), universe)
    return load_rows(
        spark, rows, lake, options.pop("source", "bulk"), force=True, **options
    )


def labelled_backfill_history(spark: SparkSession, landing: str, lake: Lake, **options) -> bool:
    """Load labelled history feeds."""
    rows = feeds.parse_labelled_feed(
        feeds.read_feed(spark, landing), feeds.LABELLED_HISTORY
    )
    return load_rows(
        spark, rows, lake, options.pop("source", "history"), force=True, **options
    )


def migrate_scoped(
    spark: SparkSession, source: Lake, target: Lake, cutoff: str = "2025-01-01"
) -> None:
    """Copy master, history and raw rows of the labelled schemes with a deep history."""
    master = tables.read_scheme_master(spark, source.master)
    nav = tables.read_nav_history(spark, source.history)
    universe = deep_history_universe(master, nav, cutoff)
    scoped = master.join(universe.select("scheme_code"), "scheme_code", "left_semi")
    master_table.write_scheme_master(spark, scoped, target.master)
    written = tables.read_scheme_master(spark, target.master)
    history.relayout_scoped(nav, written, target.history)
    if tables.find_table(spark, source.raw) is not None:
        history.relayout_raw_scoped(
            tables.read_raw_nav(spark, source.raw), written, target.raw
        )
