"""Coverage, freshness and backfill reports."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from navlake.functions.arithmetic import percent
from navlake.functions.periods import as_of_date
from navlake.operators.summary import scheme_stats

UNCATEGORISED = "(uncategorised)"


def coverage_detail(master: DataFrame, nav: DataFrame) -> DataFrame:
    """Every labelled scheme with its presence, row count and date range."""
    return (
        master.join(scheme_stats(nav), "scheme_code", "left")
        .withColumn("is_present", F.col("nav_rows").isNotNull())
        .withColumn("nav_rows", F.coalesce("nav_rows", F.lit(0)))
    )


def coverage_report(master: DataFrame, nav: DataFrame) -> DataFrame:
    """Total, present and missing schemes per category, and a grand total row."""
    present = nav.select("scheme_code").distinct().withColumn("is_present", F.lit(1))
    flagged = (
        master.select("scheme_code", F.coalesce("category", F.lit(UNCATEGORISED)).alias("category"))
        .join(present, "scheme_code", "left")
    )
    return (
        flagged.rollup("category")
        .agg(
            F.grouping("category").cast("int").alias("is_total"),
            F.count(F.lit(1)).alias("total"),
            F.count("is_present").alias("present"),
        )
        .select(
            F.when(F.col("is_total") == 1, F.lit("TOTAL")).otherwise(F.col("category"))
            .alias("category"),
            "is_total", "total", "present",
            (F.col("total") - F.col("present")).alias("missing"),
            percent(F.col("present"), F.col("total")).alias("coverage_pct"),
        )
        .withColumn("status", F.when(F.col("missing") == 0, F.lit("OK")).otherwise(
            F.concat(F.lit("MISSING "), F.col("missing").cast("string"))))
        .orderBy("is_total", "category")
    )


def freshness_report(
    nav: DataFrame, as_of: dt.date | str | None = None, year: int | None = None, span: DataFrame | None = None
) -> DataFrame:
    """Rows, schemes, date range, rows on the last date, and whether that is today.

    ``year`` restricts the check to one partition. ``span`` is what the log of a stored history
    says of its dates (``stored_span``): the dates are then not looked for in the rows, and those on
    the last date only in its own partition.
    """
    if span is not None:
        return _freshness_by_span(nav, as_of_date(as_of), span)
    rows = nav if year is None else nav.where(F.col("year") == year)
    # The last date comes from a scan of the date column alone; what is shuffled then is
    # one partial row per scheme and task.
    latest = rows.agg(F.max("nav_date")).scalar()
    per_scheme = rows.withColumn("on_latest", F.col("nav_date") == latest).groupBy(
        "scheme_code"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("on_latest").alias("n_latest"),
        F.min("nav_date").alias("date_from"),
        F.max("nav_date").alias("date_to"),
    )
    today = as_of_date(as_of)
    return per_scheme.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nav_rows"),
        F.count(F.lit(1)).alias("schemes"),
        F.min("date_from").alias("date_from"),
        F.max("date_to").alias("latest"),
        F.coalesce(F.sum("n_latest"), F.lit(0)).alias("rows_on_latest"),
    ).select(
        "*", today.alias("today"),
        F.when(F.col("latest") == today, F.lit("MATCH"))
        .otherwise(F.lit("latest is older than today")).alias("status"),
    )


def _freshness_by_span(nav: DataFrame, today: Column, span: DataFrame) -> DataFrame:
    latest = span.select("latest").scalar()
    on_latest = nav.where((F.col("year") == F.year(latest)) & (F.col("nav_date") == latest))
    per_scheme = nav.groupBy("scheme_code").agg(F.count(F.lit(1)).alias("n"))
    return per_scheme.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("nav_rows"), F.count(F.lit(1)).alias("schemes"),
    ).select(
        "nav_rows", "schemes", span.select("date_from").scalar().alias("date_from"), latest.alias("latest"),
        on_latest.agg(F.count(F.lit(1))).scalar().alias("rows_on_latest"),
        today.alias("today"),
        F.when(latest == today, F.lit("MATCH")).otherwise(F.lit("latest is older than today")).alias("status"),
    )


def table_totals(nav: DataFrame) -> DataFrame:
    """Rows, schemes and date range of a table; adds up per-scheme aggregates."""
    return scheme_stats(nav).agg(
        F.coalesce(F.sum("nav_rows"), F.lit(0)).alias("nav_rows"),
        F.count(F.lit(1)).alias("schemes"),
        F.min("date_from").alias("date_from"),
        F.max("date_to").alias("date_to"),
    )


def feed_match_report(feed: DataFrame, universe: DataFrame) -> DataFrame:
    """Feed rows against the universe: matched and missing schemes, last date."""
    codes = universe.select("scheme_code").distinct()
    per_code = feed.groupBy("scheme_code").agg(
        F.count(F.lit(1)).alias("n"), F.max("nav_date").alias("last")
    )
    return codes.join(per_code, "scheme_code", "left").agg(
        F.count(F.lit(1)).alias("universe"),
        F.count("n").alias("found"),
        (F.count(F.lit(1)) - F.count("n")).alias("missing"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("feed_rows"),
        F.max("last").alias("nav_date"),
    )


def load_status(nav: DataFrame, feed: DataFrame) -> DataFrame:
    """The feed's last date and whether the history already holds that date."""
    last = feed.agg(F.max("nav_date").alias("nav_date"))
    day = last.scalar()
    same = F.col("nav_date") == day
    if "year" in nav.columns:
        same = same & (F.col("year") == F.year(day))
    # One row at most is looked for, in the date's own partition.
    held = nav.where(same).limit(1).agg((F.count(F.lit(1)) > 0).alias("held")).scalar()
    return last.withColumn("already_loaded", held)


def date_chunks(spark: SparkSession, first: Column, last: Column, days: int) -> DataFrame:
    """Consecutive chunks of at most ``days`` days over [first, last], the last one clipped."""
    return spark.range(1).select(
        F.posexplode(F.sequence(first, last, F.make_dt_interval(F.lit(days))))
        .alias("chunk", "chunk_start")
    ).withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), last))


def chunk_coverage(
    nav: DataFrame, as_of: dt.date | str | None = None, years: int = 5, days: int = 180
) -> DataFrame:
    """Rows and schemes in each chunk of the backfill span; empty chunks are gaps."""
    last = as_of_date(as_of)
    first = F.add_months(last, -12 * years)
    in_span = nav.where(F.col("nav_date").between(first, last))
    if "year" in nav.columns:
        in_span = in_span.where(F.col("year").between(F.year(first), F.year(last)))
    counted = (
        in_span
        .withColumn("chunk", F.floor(F.datediff("nav_date", first) / days).cast("int"))
        .groupBy("chunk", "scheme_code").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("chunk").agg(
            F.sum("n").alias("nav_rows"), F.count(F.lit(1)).alias("schemes")
        )
    )
    return (
        date_chunks(nav.sparkSession, first, last, days).join(counted, "chunk", "left")
        .select(
            "chunk", "chunk_start", "chunk_end",
            F.coalesce("nav_rows", F.lit(0)).alias("nav_rows"),
            F.coalesce("schemes", F.lit(0)).alias("schemes"),
        )
        .orderBy("chunk")
    )
