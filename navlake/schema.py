"""Column names and fixed schemas of the lake's tables."""

from pyspark.sql import types as T

KEY = ["scheme_code", "nav_date"]
NAV_COLUMNS = ["scheme_code", "nav_date", "nav"]
LABEL_COLUMNS = ["fund_house", "category", "scheme_name"]
MASTER_COLUMNS = ["scheme_code", *LABEL_COLUMNS]

# Where a feed row came from; comparing these columns left to right orders rows by ingest.
FEED_ORDER = ["feed_time", "feed_file", "feed_block", "feed_row"]

NAV_SCHEMA = T.StructType([
    T.StructField("scheme_code", T.StringType()),
    T.StructField("nav_date", T.DateType()),
    T.StructField("nav", T.DoubleType()),
])

MASTER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MASTER_COLUMNS])

UNIVERSE_TYPE = T.MapType(
    T.StringType(),
    T.ArrayType(T.StructType([
        T.StructField("scheme_code", T.StringType()),
        T.StructField("fund_house", T.StringType()),
        T.StructField("scheme_name", T.StringType()),
    ])),
)

RETURN_COLUMNS = [
    "scheme_code", "scheme_name", "fund_house", "category",
    "period", "period_start", "period_end",
    "start_nav_date", "start_nav", "end_nav_date", "end_nav",
    "return_pct", "error",
]
