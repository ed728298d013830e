"""Joins between NAV rows and the scheme master.

No join carries a broadcast hint. Spark broadcasts the master while its size is under
``spark.sql.autoBroadcastJoinThreshold``, and otherwise runs a sort-merge join whose
skewed NAV side adaptive execution splits.
"""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from navlake.schema import LABEL_COLUMNS, NAV_COLUMNS
from navlake.sources.universe import universe_codes


def label_nav(nav: DataFrame, master: DataFrame) -> DataFrame:
    """NAV rows with labels; rows of unlabelled schemes keep null labels."""
    return nav.join(master, "scheme_code", "left").select(*NAV_COLUMNS, *LABEL_COLUMNS)


def filter_universe(nav: DataFrame, master: DataFrame) -> DataFrame:
    """NAV rows of labelled schemes only."""
    return nav.join(universe_codes(master), "scheme_code", "left_semi")


def missing_schemes(master: DataFrame, nav: DataFrame) -> DataFrame:
    """Labelled schemes without a single NAV row, by code."""
    present = nav.select("scheme_code").distinct()
    return master.join(present, "scheme_code", "left_anti").orderBy("scheme_code")


def deep_history_universe(
    master: DataFrame, nav: DataFrame, cutoff: dt.date | str = "2025-01-01"
) -> DataFrame:
    """Labelled schemes whose first NAV lies on or before ``cutoff``."""
    first = nav.groupBy("scheme_code").agg(F.min("nav_date").alias("first_nav_date"))
    deep = first.where(F.col("first_nav_date") <= F.lit(cutoff).cast("date"))
    return deep.join(universe_codes(master), "scheme_code", "left_semi")


def duplicate_master_codes(master: DataFrame) -> DataFrame:
    """Codes the master holds more than once; any row here would multiply NAV rows."""
    return (
        master.groupBy("scheme_code").agg(F.count(F.lit(1)).alias("label_rows"))
        .where("label_rows > 1")
    )
