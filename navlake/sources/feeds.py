"""Parsers for the semicolon-delimited price feeds.

Lines come from the splittable text source, so a feed file of any size is read by as
many tasks as it has splits. Malformed rows are dropped; a history header that names no
NAV or date column fails the job.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from navlake.functions import text
from navlake.operators.carry import carry_forward
from navlake.schema import FEED_ORDER, LABEL_COLUMNS, NAV_COLUMNS


@dataclass(frozen=True)
class LabelledLayout:
    """0-based positions of the fields in a labelled feed."""

    name: int
    nav: int
    date: int


# Field positions of the two labelled feeds.
LABELLED_DAILY = LabelledLayout(name=3, nav=4, date=5)
LABELLED_HISTORY = LabelledLayout(name=1, nav=4, date=7)


def raw_lines(reader, path: str) -> DataFrame:
    """Lines of the feed files below ``path`` and where each lies; works for streams too."""
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_modification_time").alias("feed_time"),
        F.col("_metadata.file_path").alias("feed_file"),
        F.col("_metadata.file_block_start").alias("feed_block"),
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return raw_lines(spark.read, path)


def parse_daily_feed(feed: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Rows of the daily feed: code; isin; isin; name; nav; date."""
    texts = _lines(feed).select(
        F.size("parts").alias("fields"),
        text.field(F.col("parts"), 0).alias("scheme_code"),
        text.field(F.col("parts"), 4).alias("nav"),
        text.field(F.col("parts"), 5).alias("nav_date"),
        *FEED_ORDER[:-1],
    )
    rows = _numbered(
        _typed(texts),
        (F.col("fields") >= 6) & text.is_digits(F.col("scheme_code")) & F.expr(_SOUND),
    )
    return in_universe(rows.select(*NAV_COLUMNS, *FEED_ORDER), universe)


def parse_history_feed(feed: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Rows of the history feed, whose title line may move the NAV and date columns."""
    lines = _lines(feed).withColumn("scheme_code", text.field(F.col("parts"), 0))
    is_title = (F.col("scheme_code") == text.COLUMN_TITLE) & (F.size("parts") >= 8)
    labels = text.title_labels(F.col("line"))
    placed = _numbered(
        lines.select(
            "line", F.size("parts").alias("fields"), "scheme_code",
            F.when(is_title, _title_position(labels, text.NAV_TITLE)).alias("nav_at"),
            F.when(is_title, _title_position(labels, text.DATE_TITLE)).alias("date_at"),
            *FEED_ORDER[:-1],
        ),
        (F.col("fields") >= 8)
        & (F.col("nav_at").isNotNull() | text.is_digits(F.col("scheme_code"))),
    )
    # Lines are shorter than their fields; those of the carried ones are split again.
    carried = carry_forward(placed.drop("fields"), ["nav_at", "date_at"])
    data = carried.where(text.is_digits(F.col("scheme_code")))
    texts = data.withColumn("parts", F.split("line", text.FIELD_SEPARATOR)).select(
        "scheme_code",
        text.field(F.col("parts"), F.coalesce("nav_at", F.lit(6))).alias("nav"),
        text.field(F.col("parts"), F.coalesce("date_at", F.lit(7))).alias("nav_date"),
        *FEED_ORDER,
    )
    # A condition is not pushed below what a generator makes, which would compute the values twice.
    typed = texts.select(
        "scheme_code", *FEED_ORDER,
        F.inline(F.array(F.struct(
            text.feed_number(F.col("nav")).alias("nav"), text.feed_date(F.col("nav_date")).alias("nav_date")))),
    )
    return in_universe(
        typed.where(_SOUND).select("scheme_code", "nav", "nav_date", *FEED_ORDER), universe)


def parse_labelled_feed(feed: DataFrame, layout: LabelledLayout) -> DataFrame:
    """Labelled rows: category from the section line above, fund house from the line below it."""
    texts = _lines(feed).select(
        "line",
        text.field(F.col("parts"), 0).alias("scheme_code"),
        text.field(F.col("parts"), layout.nav).alias("nav"),
        text.field(F.col("parts"), layout.date).alias("nav_date"),
        text.field(F.col("parts"), layout.name).alias("scheme_name"),
        *FEED_ORDER[:-1],
    )
    line = F.col("line")
    is_data = text.is_labelled_code(F.col("scheme_code"))
    is_section = text.is_section_header(line)
    is_title = line.startswith(text.COLUMN_TITLE)
    labelled = _typed(texts.select(
        "*",
        is_data.alias("is_data"),
        F.when(~is_data & is_section, text.section_category(line)).alias("category"),
        F.when(~is_data & ~is_section & ~is_title, line).alias("fund_house"),
    )).drop("line")
    # Malformed rows do not touch the carried labels, so they are dropped before the shuffle.
    useful = F.expr(
        f"if(is_data, {_SOUND} and scheme_name is not null, "
        "category is not null or fund_house is not null)"
    )
    return (
        carry_forward(_numbered(labelled, useful), ["category", "fund_house"])
        .where("is_data")
        .select(*NAV_COLUMNS, *LABEL_COLUMNS, *FEED_ORDER)
    )


def in_universe(rows: DataFrame, universe: DataFrame | None) -> DataFrame:
    if universe is None:
        return rows
    return rows.join(universe.select("scheme_code").distinct(), "scheme_code", "left_semi")


_SOUND = "nav is not null and nav_date is not null"


def _lines(feed: DataFrame) -> DataFrame:
    """Stripped lines and their fields. Blank lines stay; no parser takes them for a row."""
    pieces = feed.select(
        F.explode(text.split_lines(F.col("value"))).alias("line"), *FEED_ORDER[:-1]
    )
    lines = pieces.withColumn("line", text.strip_line(F.col("line")))
    return lines.withColumn("parts", F.split("line", text.FIELD_SEPARATOR))


def _typed(texts: DataFrame) -> DataFrame:
    return texts.withColumns({
        "nav": text.feed_number(F.col("nav")), "nav_date": text.feed_date(F.col("nav_date")),
    })


def _numbered(rows: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet ``condition``, with their place in the split.

    A split is read by one task in file order, so (file, block start, row id) orders the
    lines of a file. A filter that names the row id stays above it, hence the columns
    computed so far are computed once per line, not again inside the condition.
    """
    numbered = rows.withColumn("feed_row", F.monotonically_increasing_id())
    return numbered.where((F.col("feed_row") >= 0) & condition)


def _title_position(labels: Column, title: str) -> Column:
    at = F.array_position(labels, title)
    lacking = F.raise_error(F.concat(
        F.lit(f"history feed header lacks '{title}': "), F.array_join(labels, ";")
    ))
    return F.when(at == 0, lacking.cast("int")).otherwise((at - 1).cast("int"))
