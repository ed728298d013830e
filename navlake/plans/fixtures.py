"""NAV-shaped tables derived from the given tables.

A part is a scheme, a line item a NAV row; brand, type and name are the labels.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from navlake.functions.text import feed_date_text
from navlake.operators.dedupe import dedupe_nav

# Ingest order of ``nav_raw`` and ``nav_events``.
INGEST = ["l_orderkey", "l_linenumber"]
EVENT_INGEST = ["event_id"]

AS_OF = "2001-11-04"
AS_OF_EARLY = "1996-02-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nav_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("scheme_code"),
        F.col("l_shipdate").cast("date").alias("nav_date"),
        F.col("l_extendedprice").alias("nav"),
        *INGEST,
    )


def nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_nav(nav_raw(spark, sf_dir), INGEST, order_is_unique=True)


def nav_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``nav``, with zero prices among the rows."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("scheme_code"),
        F.col("l_shipdate").cast("date").alias("nav_date"),
        F.when(F.col("l_quantity") == 1, 0.0).otherwise(F.col("l_extendedprice")).alias("nav"),
        *INGEST,
    )
    return dedupe_nav(rows, INGEST, order_is_unique=True)


def nav_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few schemes with many rows on the same day; most of the master has none."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("scheme_code"),
        F.col("ts").cast("date").alias("nav_date"),
        F.col("value").alias("nav"),
        *EVENT_INGEST,
    )


def nav_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_nav(nav_events_raw(spark, sf_dir), EVENT_INGEST, order_is_unique=True)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every part; PROMO stands for no category.

    A part in five has a code that no NAV row has, so its own rows are unlabelled.
    """
    code = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") <= 40, code).otherwise(F.concat(F.lit("U"), code)).alias("scheme_code"),
        F.col("p_brand").alias("fund_house"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("category"),
        F.col("p_name").alias("scheme_name"),
    )


def all_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("scheme_code")
    )


def customer_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("scheme_code")
    )


def order_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates to look up: one per order."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey").cast("string").alias("scheme_code"),
        F.col("o_orderdate").cast("date").alias("target_date"),
    )


def daily_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as daily feed lines, with each kind of malformed line among them."""
    quantity = F.col("l_quantity")
    code = F.col("l_partkey").cast("string")
    price = (
        F.when(quantity == 2, "N.A.").when(quantity == 3, "1,000").when(quantity == 4, "NaN")
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    day = F.when(quantity == 5, "31-Feb-2026").otherwise(
        feed_date_text(F.col("l_shipdate").cast("date")))
    line = (
        F.when(quantity == 6, F.concat_ws(";", code, price, day))
        .when(quantity == 7, F.concat_ws(";", F.concat(F.lit("X"), code), F.lit(""), F.lit(""),
                                         F.lit("a scheme"), price, day))
        .otherwise(F.concat_ws(";", code, F.lit("isin"), F.lit(""), F.lit("a scheme"), price, day))
    )
    return table(spark, sf_dir, "lineitem").select(line.alias("value"))


def unique_daily_feed_text(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws(
        ";", "scheme_code", F.lit("isin"), F.lit(""), F.lit("a scheme"),
        F.col("nav").cast("string"), feed_date_text(F.col("nav_date")),
    ).alias("value"))


def history_feed_text(rows: DataFrame) -> DataFrame:
    """One block of history lines per scheme below a title line, in two column orders.

    A block holds a scheme's days, so its size is bounded by the calendar.
    """
    day, price = feed_date_text(F.col("nav_date")), F.col("nav").cast("string")
    swapped = F.col("scheme_code").endswith("1")
    return _blocks(
        rows,
        [F.when(swapped, "Scheme Code;Scheme Name;Plan;Option;Date;Net Asset Value;ISIN;ISIN")
         .otherwise("Scheme Code;Scheme Name;Plan;Option;ISIN;ISIN;Net Asset Value;Date")],
        F.when(swapped, F.concat_ws(";", "scheme_code", F.lit("n"), F.lit("p"), F.lit("o"),
                                    day, price, F.lit("i"), F.lit("i")))
        .otherwise(F.concat_ws(";", "scheme_code", F.lit("n"), F.lit("p"), F.lit("o"),
                               F.lit("i"), F.lit("i"), price, day)),
    )


def labelled_feed_text(rows: DataFrame, labels: DataFrame, history: bool = False) -> DataFrame:
    """One block of labelled lines per scheme below its section and house lines.

    Daily lines, or history lines, which have the name first and the date last.
    """
    code = F.concat(F.lit("SIF-"), F.col("scheme_code"))
    name = F.coalesce("scheme_name", F.lit("No Name"))
    price, day = F.col("nav").cast("string"), feed_date_text(F.col("nav_date"))
    blank = F.lit("i")
    if history:
        line = F.concat_ws(";", code, name, blank, blank, price, blank, blank, day)
        title = "Scheme Code;Scheme Name;ISIN;ISIN;NAV;Repurchase;Sale;Date"
    else:
        line = F.concat_ws(";", code, blank, blank, name, price, day)
        title = "Scheme Code;ISIN;ISIN;Scheme Name;NAV;Date"
    joined = rows.join(labels, "scheme_code", "left")
    section = F.coalesce(
        F.concat(F.lit("Equity Oriented Investment Strategies - "), F.col("category")),
        F.lit("Unlisted"),
    )
    return _blocks(
        joined,
        [
            F.concat(F.lit("Open Ended Schemes("), section, F.lit(")")),
            F.coalesce("fund_house", F.lit("No House")),
            F.lit(title),
        ],
        line,
        "section_line", "house_line", "title_line",
    )


def _blocks(rows: DataFrame, headers: list[Column], line: Column, *names: str) -> DataFrame:
    names = names or tuple(f"header_{i}" for i in range(len(headers)))
    lines = rows.select(
        "scheme_code", line.alias("line"), *[h.alias(n) for h, n in zip(headers, names)]
    )
    return (
        lines.groupBy("scheme_code", *names).agg(F.collect_list("line").alias("block"))
        .select(F.concat_ws("\n", *names, F.array_join("block", "\n")).alias("value"))
    )
