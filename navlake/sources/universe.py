"""The curated universe: which schemes are labelled, and how."""

from pyspark.sql import DataFrame, functions as F

from navlake.schema import MASTER_COLUMNS


def flatten_universe(universe: DataFrame, column: str = "universe") -> DataFrame:
    """One master row per scheme of a ``category -> [(code, house, name)]`` map column.

    The map may be spread over many rows, each a piece of the universe.
    """
    return (
        universe.select(F.explode(column).alias("category", "funds"))
        .select("category", F.inline("funds"))
        .select(*[F.col(c).cast("string").alias(c) for c in MASTER_COLUMNS])
    )


def universe_codes(master: DataFrame) -> DataFrame:
    return master.select(F.col("scheme_code").cast("string").alias("scheme_code")).distinct()
