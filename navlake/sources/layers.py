"""A history in layers: a base, and loads appended beside it that newer readers lay over it.

    path/year=Y/                  base, unique on (scheme, date), bucketed by scheme and sorted
    path_loads/year=Y/load=N/     rows of load N, unique on (scheme, date)
    path_log/                     a row per load and year, written when its rows are complete

The log decides what counts: the newest base of a year, and the loads after it. Rows without an
entry, such as those of a load that failed, are not read. A history without a log is its base.
"""

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from navlake.schema import KEY, NAV_COLUMNS

LOG_SCHEMA = (
    "load int, year int, is_base boolean, buckets int, nav_rows long, first_date date, last_date date"
)


def loads_of(path: str) -> str:
    return f"{path.rstrip('/')}_loads"


def log_of(path: str) -> str:
    return f"{path.rstrip('/')}_log"


def find_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is no data."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the log; none where there is no log."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(log_of(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def live_entries(log: DataFrame) -> DataFrame:
    """The entries that count: one per year of the base, and one per load and year after it."""
    base = log.where("is_base").groupBy("year").agg(F.max("load").alias("base"))
    entries = log.join(F.broadcast(base), "year", "left")  # a row per calendar year
    live = (F.col("load") > F.coalesce("base", F.lit(-1))) | (F.col("is_base") & (F.col("load") == F.col("base")))
    return entries.where(live).select(*log.columns)


@dataclass(frozen=True)
class Layers:
    """What the log says: buckets of the base, and (year, load) of what lies over it."""

    buckets: int | None
    loads: tuple[tuple[int, int], ...]
    newest: int

    @property
    def years(self) -> list[int]:
        return sorted({year for year, _ in self.loads})


def layers(spark: SparkSession, path: str) -> Layers:
    """What counts, by the log's entries: they are fewer than the files that Spark lists for the table."""
    rows = read_log(spark, path).select("load", "year", "is_base", "buckets").distinct().collect()
    base: dict[int, tuple[int, int | None]] = {}
    for r in rows:
        if r["is_base"]:
            base[r["year"]] = max(base.get(r["year"], (-1, None)), (r["load"], r["buckets"]))
    buckets = {n for _, n in base.values()}
    return Layers(
        buckets.pop() if len(buckets) == 1 else None,
        tuple(sorted((r["year"], r["load"]) for r in rows
                     if not r["is_base"] and r["load"] > base.get(r["year"], (-1, None))[0])),
        max((r["load"] for r in rows), default=0),
    )


def bucketed_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The session's name for the base at ``path``, which tells Spark how it is bucketed."""
    name = f"nav_{hashlib.md5(path.encode()).hexdigest()}_{buckets}"
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (scheme_code STRING, nav_date DATE, nav DOUBLE, year INT)
        USING parquet PARTITIONED BY (year)
        CLUSTERED BY (scheme_code) SORTED BY (scheme_code, nav_date) INTO {int(buckets)} BUCKETS
        LOCATION '{path}'""")
    if find_table(spark, path) is not None:
        spark.catalog.recoverPartitions(name)
    return name


def read_loads(spark: SparkSession, path: str, found: Layers) -> DataFrame:
    """The newest row of each (scheme, date) among the loads over the base."""
    places = [f"{loads_of(path)}/year={year}/load={load}" for year, load in found.loads]
    rows = spark.read.option("basePath", loads_of(path)).parquet(*places).select(*NAV_COLUMNS, "year", "load")
    if len({load for _, load in found.loads}) > 1:
        rows = rows.groupBy(*KEY, "year").agg(F.max_by("nav", "load").alias("nav"))
    return rows.select(*NAV_COLUMNS, F.col("year").cast("int").alias("year"))


def find_history(spark: SparkSession, path: str, bucketed: bool = False) -> DataFrame | None:
    """The base with the loads laid over it, or None where there is neither.

    ``bucketed`` reads the base by its buckets, so that what is asked per scheme needs no
    shuffle of it; that fails where other writers put files of their own into the base. The
    base's rows that a load replaces are found by the load's keys, in the years it touches;
    other years pass as they are.
    """
    found = layers(spark, path)
    base = find_table(spark, path)
    by_bucket = base is not None and bucketed and found.buckets is not None
    if by_bucket:
        base = spark.table(bucketed_table(spark, path, found.buckets))
    if not found.loads:
        return base
    over = read_loads(spark, path, found)
    if base is None:
        return over
    if by_bucket:
        over = over.repartition(found.buckets, "scheme_code")
    if "year" not in base.columns:  # a flat copy
        base = base.withColumn("year", F.year("nav_date"))
    base = base.select(*NAV_COLUMNS, F.col("year").cast("int").alias("year"))
    touched = F.col("year").isin(found.years)
    kept = base.where(touched).join(over.select(*KEY), KEY, "left_anti")
    return base.where(~touched).unionByName(kept.select(*base.columns)).unionByName(over)
