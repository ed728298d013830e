"""The registered queries: each operator over the whole given tables."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from navlake.operators import (
    asof, companies, dedupe, labels, quality, returns, summary,
)
from navlake.plans import fixtures as fx, lake as jobs, views
from navlake.schema import MASTER_COLUMNS, NAV_COLUMNS, UNIVERSE_TYPE
from navlake.session import scratch_path
from navlake.sinks import history, master as master_table
from navlake.sources import feeds, tables, universe
from navlake.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Unique rows and duplicates.

@query
def dedupe_nav(spark, d):
    return fx.nav(spark, d)


@query
def dedupe_nav_events(spark, d):
    return fx.nav_events(spark, d)


@query
def duplicate_stats(spark, d):
    return dedupe.duplicate_stats(fx.nav_raw(spark, d))


@query
def duplicate_master_codes(spark, d):
    per_line = fx.table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("scheme_code")
    )
    return labels.duplicate_master_codes(per_line)


# Labels and universe.

@query
def label_nav(spark, d):
    return labels.label_nav(fx.nav(spark, d), fx.master(spark, d))


@query
def filter_universe(spark, d):
    return labels.filter_universe(fx.nav(spark, d), fx.master(spark, d))


@query
def missing_schemes(spark, d):
    return labels.missing_schemes(fx.master(spark, d), fx.nav_events_raw(spark, d))


@query
def deep_history_universe(spark, d):
    return labels.deep_history_universe(
        fx.master(spark, d), fx.nav_raw(spark, d), cutoff="1995-02-01"
    )


@query
def flatten_universe(spark, d):
    pieces = fx.master(spark, d).select(
        F.create_map(
            F.coalesce("category", F.lit("PROMO")), F.array(F.struct("scheme_code", "fund_house", "scheme_name"))
        ).cast(UNIVERSE_TYPE).alias("universe")
    )
    return universe.flatten_universe(pieces)


@query
def universe_codes(spark, d):
    return universe.universe_codes(fx.nav_raw(spark, d))


@query
def upsert_scheme_master(spark, d):
    fresh = fx.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("scheme_code"),
        F.col("event_type").alias("fund_house"),
        F.nullif(F.col("event_type"), F.lit("click")).alias("category"),
        F.col("props").alias("scheme_name"),
        "ts", "event_id",
    )
    return dedupe.upsert_scheme_master(fx.master(spark, d), fresh, ["ts", "event_id"])


# Latest prices and summaries.

@query
def latest_nav(spark, d):
    return summary.latest_nav(fx.nav(spark, d), fx.master(spark, d))


@query
def latest_nav_with_ties(spark, d):
    return summary.latest_nav_with_ties(fx.nav_events_raw(spark, d), fx.master(spark, d))


@query
def category_summary(spark, d):
    return summary.category_summary(summary.latest_nav(fx.nav(spark, d), fx.master(spark, d)))


@query
def fund_house_summary(spark, d):
    return summary.fund_house_summary(summary.latest_nav(fx.nav(spark, d), fx.master(spark, d)))


@query
def schemes_per_category(spark, d):
    return summary.schemes_per_category(fx.master(spark, d))


@query
def scheme_span(spark, d):
    return summary.scheme_span(fx.nav_raw(spark, d))


@query
def scheme_stats(spark, d):
    return summary.scheme_stats(fx.nav_raw(spark, d))


@query
def recent_navs(spark, d):
    return summary.recent_navs(fx.nav(spark, d), 10, fx.master(spark, d))


@query
def scheme_detail(spark, d):
    detail = summary.scheme_detail(
        fx.nav_events(spark, d), fx.master(spark, d), fx.customer_codes(spark, d)
    )
    recent = F.array_join(F.transform("recent", lambda r: r["nav_date"].cast("string")), ",")
    return detail.withColumn("latest_nav", F.get("recent", F.lit(0))["nav"]).withColumn(
        "recent", recent
    )


@query
def list_categories(spark, d):
    return summary.list_categories(fx.master(spark, d))


@query
def list_funds_in_category(spark, d):
    return summary.list_funds_in_category(fx.master(spark, d), "economy")


VIEW_QUESTION = """
    SELECT l.scheme_code, l.nav_date, l.nav, c.category, c.total_schemes,
           f.fund_house, f.categories_present
    FROM latest_nav l
    JOIN category_summary c ON l.category = c.category
    JOIN fund_house_summary f ON l.fund_house = f.fund_house
    WHERE l.nav >= c.avg_latest_nav
"""


@query
def sql_views(spark, d):
    views.create_views(fx.master(spark, d), fx.nav(spark, d))
    return spark.sql(VIEW_QUESTION)


# As-of lookups and returns.

@query
def nav_asof_backward(spark, d):
    return asof.nav_asof(fx.nav(spark, d), "1998-06-15", asof.BACKWARD)


@query
def nav_asof_forward(spark, d):
    return asof.nav_asof(fx.nav(spark, d), "1998-06-15", asof.FORWARD, exclusive=True)


@query
def nav_asof_join_backward(spark, d):
    return asof.nav_asof_join(fx.order_targets(spark, d), fx.nav(spark, d), asof.BACKWARD)


@query
def nav_asof_join_forward(spark, d):
    return asof.nav_asof_join(
        fx.order_targets(spark, d), fx.nav(spark, d), asof.FORWARD, exclusive=True
    )


@query
def period_windows(spark, d):
    return returns.period_windows(fx.nav_raw(spark, d))


def _single_period(period: str, convention: str, name: str) -> None:
    def run(spark, d):
        return returns.fund_returns(
            fx.nav_zero(spark, d), fx.master(spark, d), period, convention,
            as_of=fx.AS_OF,
        )
    QUERIES[f"returns_{period.lower()}_{name}"] = run


for _period in ("1W", "1M", "1Y", "YTD", "MTD", "SI"):
    _single_period(_period, returns.AS_OF, "asof")
    _single_period(_period, returns.LAST_NAV, "last_nav")


@query
def returns_errors_asof(spark, d):
    return returns.fund_returns(
        fx.nav(spark, d), fx.master(spark, d), ["1Y", "SI"], returns.AS_OF,
        as_of=fx.AS_OF_EARLY, codes=fx.all_codes(spark, d),
    )


@query
def returns_errors_last_nav(spark, d):
    return returns.fund_returns(
        fx.nav_events(spark, d), fx.master(spark, d), ["1W", "0M", "YTD"], returns.LAST_NAV,
        codes=fx.customer_codes(spark, d),
    )


@query
def returns_full_window(spark, d):
    return returns.fund_returns(
        fx.nav(spark, d), fx.master(spark, d), ["1Y", "5Y"], returns.LAST_NAV,
        require_full_window=True,
    )


@query
def returns_grid_asof(spark, d):
    return returns.returns_grid(
        fx.nav_zero(spark, d), fx.master(spark, d), convention=returns.AS_OF, as_of=fx.AS_OF
    )


@query
def returns_grid_last_nav(spark, d):
    return returns.returns_grid(
        fx.nav_zero(spark, d), fx.master(spark, d), convention=returns.LAST_NAV
    )


@query
def returns_grid_broadcast(spark, d):
    return returns.returns_grid(
        fx.nav_zero(spark, d), fx.master(spark, d), convention=returns.LAST_NAV
    )


@query
def category_returns(spark, d):
    return returns.category_returns(
        fx.nav_zero(spark, d), fx.master(spark, d), "economy", "1Y",
        convention=returns.AS_OF, as_of=fx.AS_OF,
    )


@query
def category_returns_summary(spark, d):
    return returns.category_returns_summary(returns_grid_last_nav(spark, d))


@query
def one_category_summary(spark, d):
    return returns.one_category_summary(category_returns(spark, d), "economy")


@query
def unknown_category_summary(spark, d):
    found = returns.category_returns(
        fx.nav_zero(spark, d), fx.master(spark, d), "NO SUCH", "1Y",
        convention=returns.AS_OF, as_of=fx.AS_OF,
    )
    return returns.one_category_summary(found, "no such")


# Quality reports.

@query
def coverage_report(spark, d):
    return quality.coverage_report(fx.master(spark, d), fx.nav_events_raw(spark, d))


@query
def coverage_detail(spark, d):
    return quality.coverage_detail(fx.master(spark, d), fx.nav_events_raw(spark, d))


@query
def freshness_report(spark, d):
    return quality.freshness_report(fx.nav_raw(spark, d), as_of=fx.AS_OF)


@query
def table_totals(spark, d):
    return quality.table_totals(fx.nav_raw(spark, d))


@query
def feed_match_report(spark, d):
    return quality.feed_match_report(fx.nav_events_raw(spark, d), fx.master(spark, d))


@query
def load_status(spark, d):
    return quality.load_status(fx.nav_raw(spark, d), fx.nav_events_raw(spark, d))


@query
def chunk_coverage(spark, d):
    return quality.chunk_coverage(fx.nav_raw(spark, d), "2003-06-30")


# Company names.

def _companies(spark, d):
    customers = fx.table(spark, d, "customer")
    full_name = F.concat("c_name", F.lit(" Mutual Fund"))
    return (
        customers.select(full_name.alias("name"), F.col("c_custkey").alias("code")),
        customers.select(
            F.concat(F.lit("Client "), F.col("c_custkey").cast("string")).alias("alias"),
            full_name.alias("name"),
        ),
    )


def _company_names(spark, d):
    orders = fx.table(spark, d, "orders")
    number = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    short = F.concat(F.lit("Customer#"), number)
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(short, F.lit(" Mutual Fund")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit(" "), F.upper(short)))
        .when(F.col("o_orderpriority") == "3-MEDIUM",
              F.when(F.col("o_orderstatus") == "F", F.concat(short, F.lit(" Mut")))
              .otherwise(F.substring(short, 1, 17)))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
              F.concat(F.lit("Client "), F.col("o_custkey").cast("string")))
        .otherwise(F.concat("o_orderstatus", short))
    )
    return orders.select(name.alias("name"))


@query
def resolve_company(spark, d):
    return companies.resolve_company(_company_names(spark, d), *_companies(spark, d))


@query
def company_candidates(spark, d):
    return companies.company_candidates(_company_names(spark, d), *_companies(spark, d))


@query
def unresolved_companies(spark, d):
    houses = fx.table(spark, d, "part").select(
        F.when(F.col("p_type") == "PROMO", F.lit("Customer#00000"))
        .otherwise(F.concat(
            F.lit("Customer#"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")))
        .alias("fund_house")
    )
    return companies.unresolved_companies(houses, *_companies(spark, d))


# Feeds: text is rendered from the tables, written, and parsed back.

def _landed(spark, text: DataFrame, purpose: str) -> str:
    path = scratch_path(spark, purpose)
    text.write.text(path)
    return path


@query
def parse_daily_feed(spark, d):
    landing = _landed(spark, fx.daily_feed_text(spark, d), "daily-feed")
    rows = feeds.parse_daily_feed(feeds.read_feed(spark, landing), fx.master(spark, d))
    return rows.select(*NAV_COLUMNS)


@query
def parse_history_feed(spark, d):
    landing = _landed(spark, fx.history_feed_text(fx.nav(spark, d)), "history-feed")
    return feeds.parse_history_feed(feeds.read_feed(spark, landing)).select(*NAV_COLUMNS)


@query
def parse_labelled_feed(spark, d):
    text = fx.labelled_feed_text(fx.nav(spark, d), fx.master(spark, d))
    landing = _landed(spark, text, "labelled-feed")
    rows = feeds.parse_labelled_feed(feeds.read_feed(spark, landing), feeds.LABELLED_DAILY)
    return rows.select(*NAV_COLUMNS, "fund_house", "category", "scheme_name")


# Writers: the table is written and read back.

def _stored_batch(spark, d):
    """The first order halves as stored rows, the rest as a batch; both with duplicates."""
    rows = fx.nav_raw(spark, d)
    return rows.where("l_linenumber <= 3"), rows.where("l_linenumber > 3")


@query
def write_nav_history(spark, d):
    path = scratch_path(spark, "nav-history")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return tables.read_nav_history(spark, path)


@query
def merge_nav_history(spark, d):
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "merge")
    history.merge_nav_history(spark, stored, path, fx.INGEST)
    history.merge_nav_history(spark, batch, path, fx.INGEST)
    return tables.read_nav_history(spark, path)


@query
def backfill_funds(spark, d):
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "backfill")
    history.write_nav_history(stored, path, fx.INGEST)
    history.backfill_funds(spark, batch, path, fx.INGEST)
    return tables.read_nav_history(spark, path)


@query
def write_raw(spark, d):
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "raw")
    history.write_raw(stored.select(*NAV_COLUMNS), path, "daily", fx.AS_OF)
    history.write_raw(batch.select(*NAV_COLUMNS), path, "bulk", fx.AS_OF)
    history.write_raw(batch.select(*NAV_COLUMNS), path, "bulk", fx.AS_OF)
    return tables.read_raw_nav(spark, path).select(*NAV_COLUMNS, "year", "ingest_date", "source")


@query
def read_raw_nav(spark, d):
    """Old files hold integer codes, new ones string codes and a label column."""
    old, new = _stored_batch(spark, d)
    path = scratch_path(spark, "mixed-raw")
    year = F.year("nav_date").alias("year")
    (old.select(F.col("scheme_code").cast("long").alias("scheme_code"), "nav_date", "nav", year)
     .write.partitionBy("year").parquet(path))
    (new.select(*NAV_COLUMNS, F.lit("house").alias("fund_house"), year)
     .write.mode("append").partitionBy("year").parquet(path))
    return tables.read_raw_nav(spark, path).select(*NAV_COLUMNS, "fund_house", "year")


@query
def rebuild_nav_history(spark, d):
    stored, batch = _stored_batch(spark, d)
    raw, path = scratch_path(spark, "rebuild-raw"), scratch_path(spark, "rebuild")
    history.write_raw(stored.select(*NAV_COLUMNS), raw, "daily", "2001-11-04")
    history.write_raw(batch.select(*NAV_COLUMNS), raw, "daily", "2001-11-05")
    history.rebuild_nav_history(spark, raw, path)
    return tables.read_nav_history(spark, path)


@query
def relayout_scoped(spark, d):
    path = scratch_path(spark, "relayout")
    history.relayout_scoped(fx.nav(spark, d), fx.master(spark, d), path)
    return tables.read_nav_history(spark, path)


@query
def migrate_scoped(spark, d):
    source, target = (jobs.Lake(scratch_path(spark, p)) for p in ("source", "target"))
    master_table.write_scheme_master(spark, fx.master(spark, d), source.master)
    history.write_nav_history(fx.nav_raw(spark, d), source.history, fx.INGEST)
    jobs.migrate_scoped(spark, source, target, cutoff="1995-02-01")
    return labels.label_nav(
        tables.read_nav_history(spark, target.history),
        tables.read_scheme_master(spark, target.master),
    )


@query
def retain_years(spark, d):
    path = scratch_path(spark, "retain")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return history.retain_years(tables.read_nav_history(spark, path), fx.AS_OF)


@query
def between_dates(spark, d):
    path = scratch_path(spark, "between")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return tables.between_dates(
        tables.read_nav_history(spark, path), dt.date(1997, 6, 1), dt.date(1999, 5, 31)
    )


@query
def write_flat(spark, d):
    path = scratch_path(spark, "flat")
    history.write_flat(fx.nav(spark, d), path)
    return spark.read.parquet(path)


@query
def write_scheme_master(spark, d):
    path = scratch_path(spark, "master")
    master_table.write_scheme_master(spark, fx.master(spark, d), path)
    renamed = fx.master(spark, d).withColumn("scheme_name", F.upper("scheme_name"))
    master_table.write_scheme_master(spark, renamed, path)
    return tables.read_scheme_master(spark, path)


@query
def replace_plain_master(spark, d):
    """A master that is plain Parquet, with repeated codes, replaced by a later one."""
    path = scratch_path(spark, "plain-master")
    fx.master(spark, d).write.parquet(path)
    renamed = fx.master(spark, d).withColumn("scheme_name", F.upper("scheme_name"))
    master_table.write_scheme_master(spark, fx.master(spark, d), path)
    master_table.write_scheme_master(spark, renamed.unionByName(renamed), path)
    return tables.read_scheme_master(spark, path)


@query
def read_year(spark, d):
    path = scratch_path(spark, "read-year")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return tables.read_year(spark, path, 1997)


@query
def freshness_of_year(spark, d):
    path = scratch_path(spark, "freshness-year")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return quality.freshness_report(tables.read_nav_history(spark, path), fx.AS_OF, year=1997)


@query
def lake_views(spark, d):
    """The views over a stored lake, asked as ``sql_views`` asks those over tables."""
    home = jobs.Lake(scratch_path(spark, "views"))
    master_table.write_scheme_master(spark, fx.master(spark, d), home.master)
    history.write_nav_history(fx.nav_raw(spark, d), home.history, fx.INGEST)
    views.register_views(spark, home)
    return spark.sql(VIEW_QUESTION)


@query
def backfill_update(spark, d):
    """History feeds loaded into a lake that has a master only."""
    home = jobs.Lake(scratch_path(spark, "bulk"))
    master_table.write_scheme_master(spark, fx.master(spark, d), home.master)
    landing = _landed(spark, fx.history_feed_text(fx.nav(spark, d)), "bulk-landing")
    jobs.backfill_history(spark, landing, home, ingest_date=fx.AS_OF)
    return tables.read_nav_history(spark, home.history)


@query
def migrate_raw_scoped(spark, d):
    source, target = (jobs.Lake(scratch_path(spark, p)) for p in ("raw-source", "raw-target"))
    master_table.write_scheme_master(spark, fx.master(spark, d), source.master)
    history.write_raw(fx.nav_raw(spark, d).select(*NAV_COLUMNS), source.raw, "daily", fx.AS_OF)
    history.write_nav_history(fx.nav_raw(spark, d), source.history, fx.INGEST)
    jobs.migrate_scoped(spark, source, target, cutoff="1995-02-01")
    return tables.read_raw_nav(spark, target.raw).select(*NAV_COLUMNS, "year", "ingest_date", "source")


@query
def retain_raw(spark, d):
    path = scratch_path(spark, "retain-raw")
    history.write_raw(fx.nav_raw(spark, d).select(*NAV_COLUMNS), path, "daily", fx.AS_OF)
    return history.expired_raw(spark, path, fx.AS_OF)


@query
def category_returns_by_name(spark, d):
    """Sorted by a column and direction chosen at run time; the position shows the order."""
    rows = returns.category_returns(
        fx.nav_zero(spark, d), fx.master(spark, d), "economy", "1Y", "scheme_name", True,
        convention=returns.AS_OF, as_of=fx.AS_OF,
    )
    # The rows of one category, numbered as the report sorts them.
    shown = Window.partitionBy("category").orderBy(F.asc_nulls_last("scheme_name"), "scheme_code")
    return rows.withColumn("position", F.row_number().over(shown))


@query
def daily_update(spark, d):
    """A daily feed loaded twice; the second load is skipped."""
    home = jobs.Lake(scratch_path(spark, "daily"))
    master_table.write_scheme_master(spark, fx.master(spark, d), home.master)
    landing = _landed(spark, fx.unique_daily_feed_text(fx.nav(spark, d)), "daily-landing")
    first = jobs.daily_update(spark, landing, home, ingest_date=fx.AS_OF)
    second = jobs.daily_update(spark, landing, home, ingest_date=fx.AS_OF)
    return tables.read_nav_history(spark, home.history).withColumns({
        "first_loaded": F.lit(first), "second_loaded": F.lit(second),
    })


@query
def labelled_update(spark, d):
    """A labelled feed loaded into an empty lake: the master comes from its headers."""
    home = jobs.Lake(scratch_path(spark, "labelled"))
    text = fx.labelled_feed_text(fx.nav(spark, d), fx.master(spark, d))
    jobs.labelled_daily_update(
        spark, _landed(spark, text, "labelled-landing"), home, ingest_date=fx.AS_OF
    )
    return tables.read_scheme_master(spark, home.master).select(*MASTER_COLUMNS)


@query
def labelled_history_update(spark, d):
    """A labelled history feed loaded into an empty lake, with the labels of its headers."""
    home = jobs.Lake(scratch_path(spark, "labelled-history"))
    text = fx.labelled_feed_text(fx.nav(spark, d), fx.master(spark, d), history=True)
    jobs.labelled_backfill_history(
        spark, _landed(spark, text, "labelled-history-landing"), home, ingest_date=fx.AS_OF
    )
    return labels.label_nav(
        tables.read_nav_history(spark, home.history).select(*NAV_COLUMNS),
        tables.read_scheme_master(spark, home.master),
    )


@query
def ingest_stream_daily(spark, d):
    home = jobs.Lake(scratch_path(spark, "stream"))
    landing = _landed(spark, fx.unique_daily_feed_text(fx.nav(spark, d)), "stream-landing")
    universe_rows = fx.master(spark, d)
    stream = ingest_stream(
        spark, landing, home, scratch_path(spark, "stream-checkpoint"),
        lambda lines: feeds.parse_daily_feed(lines, universe_rows),
    )
    stream.awaitTermination()
    return tables.read_nav_history(spark, home.history)


@query
def returns_from_lake(spark, d):
    """Returns over the stored history, read by its buckets."""
    path = scratch_path(spark, "returns-history")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return returns.returns_grid(tables.read_nav_history(spark, path, bucketed=True), fx.master(spark, d))


@query
def returns_over_loads(spark, d):
    """As-of returns over a base and a load that lies over it."""
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "returns-loads")
    history.write_nav_history(stored, path, fx.INGEST)
    history.merge_nav_history(spark, batch, path, fx.INGEST)
    nav = tables.read_nav_history(spark, path, bucketed=True)
    return returns.fund_returns(nav, fx.master(spark, d), ["1Y", "SI"], convention=returns.AS_OF, as_of=fx.AS_OF)


@query
def compact_nav_history(spark, d):
    """Two loads over a base, written into it; the loads' files are removed."""
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "compact")
    history.write_nav_history(stored, path, fx.INGEST)
    history.merge_nav_history(spark, batch.where("l_linenumber = 4"), path, fx.INGEST)
    history.merge_nav_history(spark, batch.where("l_linenumber > 4"), path, fx.INGEST)
    history.compact_nav_history(spark, path)
    history.drop_compacted(spark, path)
    return tables.read_nav_history(spark, path)


@query
def stored_order(spark, d):
    """Rows of each year's files, and how many of them come before the row above them."""
    path = scratch_path(spark, "order")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    rows = spark.read.parquet(path).select(
        "year", F.struct("scheme_code", "nav_date").alias("key"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    # A file holds one bucket of one year.
    above = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("above", above).groupBy("year").agg(
        F.count(F.lit(1)).alias("nav_rows"), F.count_if(F.col("above") >= F.col("key")).alias("out_of_order"))


@query
def scheme_from_lake(spark, d):
    """The history of one scheme, which lies in one bucket."""
    path = scratch_path(spark, "scheme-lake")
    history.write_nav_history(fx.nav_raw(spark, d), path, fx.INGEST)
    return tables.read_nav_history(spark, path, bucketed=True).where("scheme_code = '101'")


@query
def freshness_of_lake(spark, d):
    """The dates from the log of a history of a base and a load, the rest from its rows."""
    stored, batch = _stored_batch(spark, d)
    path = scratch_path(spark, "freshness-lake")
    history.write_nav_history(stored, path, fx.INGEST)
    history.merge_nav_history(spark, batch, path, fx.INGEST)
    return quality.freshness_report(
        tables.read_nav_history(spark, path), fx.AS_OF, span=history.stored_span(spark, path))


@query
def drop_expired_raw(spark, d):
    """What is left of the raw layer when the years beyond retention are removed."""
    path = scratch_path(spark, "drop-raw")
    history.write_raw(fx.nav_raw(spark, d).select(*NAV_COLUMNS), path, "daily", fx.AS_OF)
    history.drop_expired_raw(spark, path, fx.AS_OF, dry_run=False)
    return tables.read_raw_nav(spark, path).select(*NAV_COLUMNS, "year", "ingest_date", "source")


@query
def resumed_load(spark, d):
    """A labelled load that stopped behind its raw layer, ended by the next run."""
    home = jobs.Lake(scratch_path(spark, "resumed"))
    landing = _landed(spark, fx.labelled_feed_text(fx.nav(spark, d), fx.master(spark, d)), "resumed-landing")
    rows = feeds.parse_labelled_feed(feeds.read_feed(spark, landing), feeds.LABELLED_DAILY)
    history.write_raw(rows, home.raw, "daily", fx.AS_OF)
    years = [r[0] for r in fx.nav(spark, d).select(F.year("nav_date")).distinct().collect()]
    jobs.record_step(spark, home, jobs.Load("stopped", "daily", fx.AS_OF, tuple(sorted(years))), jobs.RAW)
    jobs.resume_loads(spark, home)
    return labels.label_nav(
        tables.read_nav_history(spark, home.history).select(*NAV_COLUMNS),
        tables.read_scheme_master(spark, home.master))


@query
def ingest_stream_batches(spark, d):
    """Three feeds in three batches: recent days, late ones, and all again with corrections."""
    home = jobs.Lake(scratch_path(spark, "batches"))
    nav, universe_rows = fx.nav(spark, d), fx.master(spark, d)
    corrected = nav.withColumn("nav", F.col("nav") + F.when(F.col("scheme_code").endswith("1"), 1).otherwise(0))
    landing, checkpoint = scratch_path(spark, "batches-landing"), scratch_path(spark, "batches-checkpoint")
    # A feed is at most so many files, which its batch takes at once.
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows in (nav.where("nav_date >= date'1996-01-01'"), nav.where("nav_date < date'1996-01-01'"), corrected):
        fx.unique_daily_feed_text(rows).coalesce(files).write.mode("append").text(landing)
        ingest_stream(
            spark, landing, home, checkpoint, lambda lines: feeds.parse_daily_feed(lines, universe_rows),
            files_per_batch=files).awaitTermination()
    return tables.read_nav_history(spark, home.history)
