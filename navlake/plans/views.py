"""The five SQL views over a lake."""

from pyspark.sql import DataFrame, SparkSession

from navlake.operators.labels import label_nav
from navlake.operators.summary import category_summary, fund_house_summary, latest_nav
from navlake.plans.lake import Lake
from navlake.sources.tables import read_nav_history, read_scheme_master, require_tables


def register_views(spark: SparkSession, lake: Lake) -> None:
    """Create temp views over the lake's tables; fails when a table is missing."""
    require_tables(spark, lake.master, lake.history)
    create_views(
        read_scheme_master(spark, lake.master), read_nav_history(spark, lake.history)
    )


def create_views(master: DataFrame, nav: DataFrame) -> None:
    """The views scheme_master, nav_history, latest_nav, category_summary, fund_house_summary.

    ``nav`` must be unique on (scheme, date), as the lake's history is.
    """
    latest = latest_nav(nav, master)
    views = {
        "scheme_master": master,
        "nav_history": label_nav(nav, master),
        "latest_nav": latest,
        "category_summary": category_summary(latest),
        "fund_house_summary": fund_house_summary(latest),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
