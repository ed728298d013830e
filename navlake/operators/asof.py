"""As-of lookups: the NAV in force before or after a date."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

BACKWARD, FORWARD = "backward", "forward"


def reaches(day: Column, target: Column, direction: str, exclusive: bool = False) -> Column:
    """Whether a row's date qualifies for a target date."""
    if direction == BACKWARD:
        return day < target if exclusive else day <= target
    if direction == FORWARD:
        return day > target if exclusive else day >= target
    raise ValueError(f"direction must be '{BACKWARD}' or '{FORWARD}', not '{direction}'")


def nav_asof(
    nav: DataFrame, target: dt.date | str | Column, direction: str = BACKWARD,
    exclusive: bool = False,
) -> DataFrame:
    """Each scheme's nearest NAV at one target date; schemes without one are left out.

    The qualifying rows are filtered at the scan; one hash aggregate then keeps one row
    per scheme and task.
    """
    day = F.col("nav_date")
    when = target if isinstance(target, Column) else F.lit(target).cast("date")
    near = nav.where(reaches(day, when, direction, exclusive))
    if "year" in nav.columns:
        year = F.col("year")
        near = near.where(year <= F.year(when) if direction == BACKWARD else year >= F.year(when))
    edge, pick = (F.max, F.max_by) if direction == BACKWARD else (F.min, F.min_by)
    return near.groupBy("scheme_code").agg(
        edge("nav_date").alias("nav_date"), pick("nav", "nav_date").alias("nav")
    )


def nav_asof_join(
    targets: DataFrame, nav: DataFrame, direction: str = BACKWARD, exclusive: bool = False
) -> DataFrame:
    """``targets`` (scheme_code, target_date, ...) with the nearest NAV of each row.

    Distinct targets and history rows are merged into one date-ordered stream per scheme
    and the NAV carried along it. Both are unique on (scheme, date), so a scheme's stream
    is no longer than twice the days of the calendar, however many target rows ask for
    it; those get their answer through an equi-join that adaptive execution can split.
    """
    asked = targets.select("scheme_code", F.col("target_date").alias("at")).distinct()
    # Only asked schemes can match, and only up to the last target (or from the first one).
    edge = F.max if direction == BACKWARD else F.min
    bound = targets.agg(edge("target_date")).scalar()
    near = nav.join(asked.select("scheme_code").distinct(), "scheme_code", "left_semi").where(
        reaches(F.col("nav_date"), bound, direction, exclusive))
    if "year" in nav.columns:
        year = F.col("year")
        near = near.where(year <= F.year(bound) if direction == BACKWARD else year >= F.year(bound))
    stream = (
        near.select(
            "scheme_code", F.col("nav_date").alias("at"),
            F.struct("nav_date", "nav").alias("found"), F.lit(False).alias("is_target"),
        )
        .unionByName(asked.select(
            "scheme_code", "at",
            F.lit(None).cast("struct<nav_date:date,nav:double>").alias("found"),
            F.lit(True).alias("is_target"),
        ))
    )
    # A target follows the row of its own date, or precedes it when that day is excluded.
    order = [
        F.asc("at") if direction == BACKWARD else F.desc("at"),
        F.desc("is_target") if exclusive else F.asc("is_target"),
    ]
    so_far = (
        Window.partitionBy("scheme_code").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        stream.withColumn("found", F.last("found", ignorenulls=True).over(so_far))
        .where("is_target")
        .select(
            "scheme_code", F.col("at").alias("target_date"),
            F.col("found.nav_date").alias("nav_date"), F.col("found.nav").alias("nav"),
        )
    )
    return targets.join(answers, ["scheme_code", "target_date"], "left")
