"""Carry-forward of header values through the lines of feed files."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from navlake.session import cut_lineage


def carry_forward(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Fill each null in ``columns`` with the last non-null value above it in its file.

    ``feed_file``, ``feed_block`` and ``feed_row`` give the order. Windows run inside one
    block (one input split), so the largest task is a split however large a file grows.
    What a block inherits comes from one summary row per block, which also numbers it: the
    windows sort whole numbers, not file names. The lines are written once, as parsed, and
    both the windows and the summary read that, so the text is scanned and parsed once.
    """
    lines = cut_lineage(lines)
    block = ["feed_file", "feed_block"]
    # Only the lines that set a value are summed up.
    setting = reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])
    last = lines.where(setting).groupBy(*block).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("feed_row"))).alias(c) for c in columns
    ])
    above = (
        Window.partitionBy("feed_file").orderBy("feed_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = lines.select(*block).distinct().join(last, block, "left").select(
        *block, F.row_number().over(Window.orderBy(*block)).alias("block_number"),
        *[F.last(c, ignorenulls=True).over(above).alias(f"inherited_{c}") for c in columns],
    )
    inside = (
        Window.partitionBy("block_number").orderBy("feed_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # A row per split, sent to every task.
    return (
        lines.join(F.broadcast(blocks), block, "left")
        .withColumns({
            c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"inherited_{c}")) for c in columns
        })
        .drop("block_number", *[f"inherited_{c}" for c in columns])
    )
