"""The scheme master as whole-table versions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from navlake.operators.dedupe import keep_greatest, upsert_scheme_master
from navlake.schema import MASTER_COLUMNS
from navlake.sources.tables import as_scheme_master, find_scheme_master, find_table, versions_of


def write_scheme_master(spark: SparkSession, master: DataFrame, path: str) -> int:
    """Replace the table by writing its next version beside the current one.

    Readers take the highest version, which appears only when its job commits, so the new
    table may be computed from the one it replaces. A plain Parquet master counts as version
    0 and stays; its versions go to a root of their own beside it. A code that occurs more
    than once is written once, with its greatest labels, as repeated codes would multiply the
    rows they are joined to.
    """
    current = find_table(spark, path)
    plain = current is not None and "version" not in current.columns
    root = versions_of(path) if plain else path
    held = find_table(spark, root) if plain else current
    version = 1 if held is None else 1 + held.agg(F.max("version")).first()[0]
    unique = keep_greatest(
        master.where("scheme_code is not null"), ["scheme_code"], [], MASTER_COLUMNS[1:])
    (
        unique.select(*MASTER_COLUMNS, F.lit(version).alias("version"))
        .write.mode("append").partitionBy("version").parquet(root)
    )
    return version


def refresh_scheme_master(
    spark: SparkSession, labelled: DataFrame, path: str, order_by: list = ()
) -> None:
    """Upsert labels seen in a feed; nothing is written when the feed holds none."""
    if labelled.isEmpty():
        return
    current = find_scheme_master(spark, path)
    existing = None if current is None else as_scheme_master(current)
    write_scheme_master(spark, upsert_scheme_master(existing, labelled, order_by), path)
