"""Latest prices and the summaries over them."""

from pyspark.sql import DataFrame, Window, functions as F

from navlake.functions.arithmetic import mean_price
from navlake.operators.labels import label_nav
from navlake.schema import LABEL_COLUMNS


def latest_nav(nav: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """The row at each scheme's last date, labelled when a master is given.

    Takes a history unique on (scheme, date), as ``dedupe_nav`` and the writers make it:
    one hash aggregate, of which only one row per scheme and task is shuffled.
    """
    latest = nav.groupBy("scheme_code").agg(
        F.max("nav_date").alias("nav_date"), F.max_by("nav", "nav_date").alias("nav")
    )
    return latest if master is None else label_nav(latest, master)


def latest_nav_with_ties(nav: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """As ``latest_nav`` on a history that repeats keys: every row at the last date stays."""
    last = nav.groupBy("scheme_code").agg(F.max("nav_date").alias("nav_date"))
    latest = nav.select("scheme_code", "nav_date", "nav").join(
        last, ["scheme_code", "nav_date"], "left_semi"
    )
    return latest if master is None else label_nav(latest, master)


def category_summary(latest: DataFrame) -> DataFrame:
    """Per category: schemes, mean/min/max latest NAV, date of the data."""
    return (
        latest.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count_distinct("scheme_code").alias("total_schemes"),
            mean_price(F.col("nav")).alias("avg_latest_nav"),
            F.round(F.min("nav"), 4).alias("min_latest_nav"),
            F.round(F.max("nav"), 4).alias("max_latest_nav"),
            F.max("nav_date").alias("data_as_of"),
        )
        .orderBy("category")
    )


def fund_house_summary(latest: DataFrame) -> DataFrame:
    """Per fund house: categories, schemes, the category list, date of the data.

    Only the distinct categories of a house are gathered, not its rows.
    """
    return (
        latest.where(F.col("fund_house").isNotNull())
        .groupBy("fund_house")
        .agg(
            F.count_distinct("category").alias("categories_present"),
            F.count_distinct("scheme_code").alias("total_schemes"),
            F.array_join(F.array_sort(F.collect_set("category")), ", ").alias("categories"),
            F.max("nav_date").alias("data_as_of"),
        )
        .withColumn("categories", F.nullif("categories", F.lit("")))
        .orderBy("fund_house")
    )


def schemes_per_category(master: DataFrame) -> DataFrame:
    return (
        master.groupBy("category").agg(F.count(F.lit(1)).alias("schemes")).orderBy("category")
    )


def scheme_span(nav: DataFrame) -> DataFrame:
    """First and last NAV date of each scheme."""
    return nav.groupBy("scheme_code").agg(
        F.min("nav_date").alias("date_from"), F.max("nav_date").alias("date_to")
    )


def scheme_stats(nav: DataFrame) -> DataFrame:
    """Row count, first and last NAV date of each scheme."""
    return nav.groupBy("scheme_code").agg(
        F.count(F.lit(1)).alias("nav_rows"),
        F.min("nav_date").alias("date_from"),
        F.max("nav_date").alias("date_to"),
    )


def recent_navs(nav: DataFrame, n: int = 10, master: DataFrame | None = None) -> DataFrame:
    """The ``n`` most recent rows of every scheme, numbered from the newest.

    Spark applies the row-number limit inside each task before the shuffle, so at most
    ``n`` rows per scheme and task move.
    """
    newest = Window.partitionBy("scheme_code").orderBy(F.desc("nav_date"), F.desc("nav"))
    recent = (
        nav.select("scheme_code", "nav_date", "nav")
        .withColumn("recency", F.row_number().over(newest))
        .where(F.col("recency") <= n)
    )
    if master is None:
        return recent
    return recent.join(master, "scheme_code", "left").select(
        "scheme_code", "scheme_name", "category", "fund_house", "nav_date", "nav", "recency"
    )


def list_categories(master: DataFrame) -> DataFrame:
    return master.where(F.col("category").isNotNull()).select("category").distinct().orderBy(
        "category"
    )


def in_category(master: DataFrame, category: str) -> DataFrame:
    return master.where(F.upper("category") == F.upper(F.lit(category)))


def list_funds_in_category(master: DataFrame, category: str) -> DataFrame:
    """Schemes of a category in any letter case, by house and name."""
    return (
        in_category(master, category)
        .select("scheme_code", "scheme_name", "fund_house", "category")
        .orderBy("fund_house", "scheme_name", "scheme_code")
    )


def scheme_detail(nav: DataFrame, master: DataFrame, codes: DataFrame, n: int = 5) -> DataFrame:
    """For each asked code: labels or ``unmapped``, row count, date range, newest NAVs."""
    asked = codes.select("scheme_code").distinct()
    mine = nav.join(asked, "scheme_code", "left_semi")
    newest = (
        recent_navs(mine, n)
        .groupBy("scheme_code")
        .agg(F.sort_array(F.collect_list(F.struct("nav_date", "nav")), asc=False).alias("recent"))
    )
    mapped = master.select("scheme_code", *LABEL_COLUMNS, F.lit("mapped").alias("status"))
    return (
        asked.join(mapped, "scheme_code", "left")
        .join(scheme_stats(mine), "scheme_code", "left")
        .join(newest, "scheme_code", "left")
        .withColumns({
            "status": F.coalesce("status", F.lit("unmapped")),
            "nav_rows": F.coalesce("nav_rows", F.lit(0)),
        })
    )
