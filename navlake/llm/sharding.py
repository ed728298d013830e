"""Sharding: a reproducible shuffle of all rows into numbered shards and slots.

Every row has a global number; a keyed permutation of the numbers 0 .. N-1 gives its place in
the shuffled order. Place p lies in shard ``p mod shards`` at slot ``p div shards``, so shards
differ by one row at most, slots have no gaps, and either can be computed from the other.
"""

from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import number_rows

SEED = 20_011
ROUNDS = 4


def _round_trip(value: Column, width: Column, height: Column, seed: int) -> Column:
    """One pass of a Feistel network over ``width * height`` numbers.

    A number is a pair of halves, one below ``width`` and one below ``height``; the rounds
    alternate between the two moduli, so the network permutes exactly those numbers.
    """
    left, right = F.pmod(value, width), F.floor(value / width).cast("long")
    for turn in range(ROUNDS):
        size = width if turn % 2 == 0 else height
        keyed = F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), right), size)
        left, right = right, F.pmod(left + keyed, size)
    return right * width + left


def permuted(number: Column, total: Column, seed: int = SEED) -> Column:
    """The place of ``number`` in a shuffled order of 0 .. total-1.

    The network permutes a slightly larger range, of less than ``sqrt(total) + 1`` numbers
    more. A number that leaves 0 .. total-1 walks on through the network until it is back; it
    meets each surplus number once at most, which bounds the walk exactly.
    """
    width = F.ceil(F.sqrt(total)).cast("long")
    height = F.ceil(total / width).cast("long")
    first = _round_trip(number, width, height, seed)
    surplus = F.sequence(F.lit(1).cast("long"), F.greatest(width * height - total, F.lit(1)))
    walked = F.aggregate(
        surplus, first,
        lambda place, _: F.when(place < total, place)
        .otherwise(_round_trip(place, width, height, seed)),
    )
    return F.when(first < total, first).otherwise(walked)


def shard_rows(rows: DataFrame, order: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """``rows`` with ``row_number``, ``position``, ``shard`` and ``slot``.

    Rows are numbered by ``order``, nulls first; name enough columns that rows equal in all of
    them are interchangeable, and the result does not depend on files or partitions. Null keys
    and repeated rows get numbers of their own; an empty table gives no rows. Columns of the
    input with one of the four names are replaced.
    """
    names = ("row_number", "position", "shard", "slot")
    named = rows.drop(*names)
    numbered = number_rows(named, order, "row_number", "_total")
    place = permuted(F.col("row_number"), F.col("_total"), seed)
    return (
        numbered.withColumn("position", place)
        .withColumn("shard", F.pmod("position", F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("position") / shards).cast("long"))
        .drop("_total")
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One directory per shard, its rows in slot order over files of up to ``rows_per_file`` slots.

    Each file is a task's work, so a shard of any size is written by many. An empty table writes no
    shard; null columns are written as they are.
    """
    piece = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.repartition(F.col("shard"), piece).sortWithinPartitions("shard", "slot")
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    )


def shard_documents(documents: DataFrame, shards: int = 40, seed: int = SEED) -> DataFrame:
    """Digest of the shards of ``documents``: the rows that ``shard_rows`` deals out.

    Size is the text's UTF-8 bytes (none for a null) plus 16. Law ``rows``: counts of shards
    are at most one apart. The text itself is not moved, only its size and checksum.
    """
    digests = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    sharded = shard_rows(digests, ["doc_id", "size", "text_crc32"], shards, seed)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number", "position",
    )
