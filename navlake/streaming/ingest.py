"""Feeds loaded from a landing folder as they arrive."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from navlake.plans.lake import Lake, load_rows
from navlake.sources.feeds import raw_lines


def ingest_stream(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    parse: Callable[[DataFrame], DataFrame],
    source: str = "stream",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load every feed file not seen before, then stop.

    ``parse`` turns raw feed lines into rows. The checkpoint remembers the files
    already taken. A batch that is retried replaces its own raw partition, and the merge
    gives the same history again; late rows go beside the years they belong to. The text of a
    batch is scanned once: its day comes from the parsed rows.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(feed: DataFrame, batch_id: int) -> None:
        load_rows(feed.sparkSession, parse(feed), lake, f"{source}-{batch_id}", force=True, day_of_feed=True)

    return (
        raw_lines(reader, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
