"""Helpers shared by the operators."""

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The most copies of one row that a single generated array lists.
RUN = 4096

#: Rows up to which a table of one row per source may be broadcast.
SMALL_ROWS = 100_000


#: Bytes of a batch that a Python worker gets at once. Results, and what a worker holds while
#: it makes them, are several times that; idle workers keep what they have had.
BATCH_BYTES = "2m"


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, and get small batches.

    Enough where that folder is shared or local; a cluster ships the package by ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", here)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, written to the shared checkpoint folder and read from there.

    Used where several branches must see the same rows (sort positions, samples) and where
    iterations would let the lineage grow. The folder is the one the cluster names in
    ``spark.checkpoint.dir``; only a local session without that setting gets a temporary one.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if not (context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="navlake-llm-"))
    return frame.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def number_rows(frame: DataFrame, order: list, number: str, total: str) -> DataFrame:
    """``frame`` with each row's place from 0 in the given order, and the count of all rows.

    A range sort places the rows; a row's number is its place inside its sorted partition
    plus the rows of the partitions before it. Only one count per partition is brought
    together. Rows equal in all of ``order`` are numbered in any order; a hot run of them is
    split over partitions, as the place in the input is the last sort key.
    """
    input_, at, part, before_ = (f"{name}_{uuid.uuid4().hex}" for name in ("input", "at", "part", "before"))
    spread = cut(frame.withColumn(input_, F.monotonically_increasing_id()))
    placed = cut(
        spread.sort(*order, input_).drop(input_)
        .withColumn(at, F.monotonically_increasing_id())
        .withColumn(part, F.shiftrightunsigned(at, 33).cast("int"))
    )
    every = Window.orderBy(part)
    before = (
        placed.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
        .select(
            part,
            (F.sum("rows").over(every) - F.col("rows")).alias(before_),
            F.sum("rows").over(Window.partitionBy()).alias(total),
        )
    )
    # One row per partition of the sort, however many rows those hold.
    return (
        placed.join(F.broadcast(before), part)
        .withColumn(number, F.col(before_) + F.col(at).bitwiseAND((1 << 33) - 1))
        .drop(part, at, before_)
    )


def repeat_rows(frame: DataFrame, copies: str, index: str) -> DataFrame:
    """Each row as often as ``copies`` says, with the copy's ``index`` from 0.

    The copies are listed run by run, so no array grows with a row's count.
    """
    starts = F.when(F.col(copies) > 0, F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(RUN).cast("long")))
    return (
        frame.withColumn("_start", F.explode(starts))
        .withColumn(index, F.explode(F.sequence(
            "_start", F.least(F.col("_start") + (RUN - 1), F.col(copies) - 1))))
        .drop("_start")
    )


def join_small(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Left join with a checkpointed table that is small as a rule.

    It is broadcast only when its counted rows are at most ``SMALL_ROWS``; otherwise a plain
    join is left to Spark, on the key and its hash, so that both sides are dealt out for this
    join and a hot key can be split.
    """
    if small.count() <= SMALL_ROWS:
        return large.join(F.broadcast(small), large[on].eqNullSafe(small[on]), "left").drop(small[on])
    left = large.withColumn("_spread", F.xxhash64(on))
    right = small.withColumn("_spread", F.xxhash64(on))
    return (
        left.join(right, left[on].eqNullSafe(right[on]) & (left["_spread"] == right["_spread"]), "left")
        .drop(right[on]).drop("_spread")
    )
