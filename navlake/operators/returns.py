"""Point-to-point returns for every fund and period in one job.

Two conventions, one per asset class:

``asof_backward``
    The window ends today (``as_of``); both ends take the last NAV on or before their
    date. A fund without NAV at the start is an error row.
``last_nav_forward``
    The window ends at each fund's own last NAV. A trailing window starts at the first
    NAV after (last date - period); YTD, MTD and SI start on or after their boundary.

``nav`` must be unique on (scheme_code, nav_date); see ``dedupe_nav``.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from navlake.functions.arithmetic import mean_of_rounded, point_to_point_return
from navlake.functions.periods import PERIODS, Period, as_of_date, parse_period
from navlake.operators.summary import in_category
from navlake.schema import RETURN_COLUMNS

AS_OF, LAST_NAV = "asof_backward", "last_nav_forward"

# Days a first NAV may lie after the start boundary under require_full_window, by default.
FULL_WINDOW_SLACK = 10

# The columns that may sort a category's returns.
SORT_COLUMNS = ("return_pct", "scheme_name", "fund_house", "start_nav", "end_nav")


def fund_returns(
    nav: DataFrame,
    master: DataFrame,
    periods: str | list[str] = PERIODS,
    convention: str = LAST_NAV,
    as_of: dt.date | str | None = None,
    codes: str | list[str] | DataFrame | None = None,
    require_full_window: bool = False,
    full_window_slack: int = FULL_WINDOW_SLACK,
) -> DataFrame:
    """One row per asked scheme and period; failures are an ``error`` text, not an exception.

    ``codes`` is a code, a short list, a DataFrame of ``scheme_code``, or None for the
    whole master. ``require_full_window`` turns a window that starts more than
    ``full_window_slack`` days before the first NAV into an error row.
    """
    wanted = [parse_period(p) for p in ([periods] if isinstance(periods, str) else periods)]
    codes = [codes] if isinstance(codes, str) else codes
    requested = _requested(master, codes)
    mine = _rows_of(nav, codes, requested)
    known = master.withColumn("in_master", F.lit(True))
    asked = known if codes is None else requested.join(known, "scheme_code", "left")
    if convention == AS_OF:
        today = as_of_date(as_of)
        wide = _wide_as_of(mine, wanted, today)
    elif convention == LAST_NAV:
        today = None
        if all(p.since_inception for p in wanted):
            # No window starts from the last date. Where the whole master is asked, the join below
            # restricts the schemes, which spares a sort of the history.
            wide = _wide_last_nav(nav if codes is None else mine, wanted)
        else:
            wide = _wide_last_nav(_with_anchor(mine), wanted)
    else:
        raise ValueError(f"convention must be '{AS_OF}' or '{LAST_NAV}', not '{convention}'")

    long = asked.join(wide, "scheme_code", "left").select(
        "scheme_code", "scheme_name", "fund_house", "category", "in_master",
        "first_date", "end_date", "end_nav",
        F.inline(F.array(*[_period_struct(i, p, today) for i, p in enumerate(wanted)])),
    )
    return _finish(long, today, full_window_slack if require_full_window else None)


def returns_grid(nav: DataFrame, master: DataFrame, **options) -> DataFrame:
    """Returns of every fund for all named periods."""
    return fund_returns(nav, master, PERIODS, **options)


def category_returns(
    nav: DataFrame,
    master: DataFrame,
    category: str,
    period: str,
    sort_by: str = "return_pct",
    ascending: bool = False,
    **options,
) -> DataFrame:
    """Returns of a category's funds, sorted with nulls last and ties by name."""
    funds = in_category(master, category)
    codes = funds.select("scheme_code")
    return sort_returns(
        fund_returns(nav, funds, period, codes=codes, **options), sort_by, ascending
    )


def sort_returns(
    returns: DataFrame, sort_by: str = "return_pct", ascending: bool = False
) -> DataFrame:
    column = F.col(sort_by if sort_by in SORT_COLUMNS else "return_pct")
    first = column.asc_nulls_last() if ascending else column.desc_nulls_last()
    return returns.orderBy(first, "scheme_name", "scheme_code")


def category_returns_summary(returns: DataFrame) -> DataFrame:
    """Per category and period: funds, computed returns and their mean."""
    return returns.groupBy("category", "period").agg(*_totals())


def one_category_summary(returns: DataFrame, category: str) -> DataFrame:
    """The same for one asked category: always one row, an unknown name is an error text."""
    # Fixed value: error text.
    unknown = (
        f"No funds found for category '{category}'. Use list_categories() to see valid names."
    )
    return returns.agg(*_totals()).select(
        F.lit(category.upper()).alias("category"), "*",
        F.when(F.col("total_funds") == 0, F.lit(unknown)).alias("error"),
    )


def period_windows(nav: DataFrame, periods: list[str] = PERIODS) -> DataFrame:
    """Start and end boundary of each period, anchored at each scheme's last NAV."""
    wanted = [parse_period(p) for p in periods]
    spans = nav.groupBy("scheme_code").agg(
        F.min("nav_date").alias("first_date"), F.max("nav_date").alias("end_date")
    )
    return spans.select(
        "scheme_code",
        F.inline(F.array(*[
            F.struct(
                F.lit(p.label).alias("period"),
                (F.col("first_date") if p.since_inception else p.start(F.col("end_date")))
                .alias("start_date"),
                F.col("end_date").alias("end_date"),
            )
            for p in wanted
        ])),
    )


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_funds"),
        F.count("return_pct").alias("computed"),
        mean_of_rounded(F.col("return_pct")).alias("avg_return_pct"),
    ]


def _requested(master: DataFrame, codes: list[str] | DataFrame | None) -> DataFrame:
    """The asked codes as rows."""
    if codes is None:
        return master.select("scheme_code")
    if isinstance(codes, DataFrame):
        return codes.select("scheme_code")
    return master.sparkSession.createDataFrame([(c,) for c in codes], "scheme_code string")


def _rows_of(nav: DataFrame, codes: list[str] | DataFrame | None, requested: DataFrame) -> DataFrame:
    """History rows of the asked schemes, restricted before anything is aggregated.

    A short list becomes a condition that the scan can use to skip row groups.
    """
    if isinstance(codes, list):
        return nav.where(F.col("scheme_code").isin(codes))
    return nav.join(requested.distinct(), "scheme_code", "left_semi")


def _wide_as_of(nav: DataFrame, periods: list[Period], today: Column) -> DataFrame:
    """One row per scheme: first NAV, NAV in force today and at each period's start."""
    day = F.col("nav_date")
    rows = nav
    if not any(p.since_inception for p in periods):
        # Only inception looks past today, so the scan can stop there.
        rows = rows.where(day <= today)
        if "year" in nav.columns:
            rows = rows.where(F.col("year") <= F.year(today))
    up_to_today = F.when(day <= today, day)
    columns = [
        F.min(day).alias("first_date"),
        F.min_by("nav", day).alias("first_nav"),
        F.max(up_to_today).alias("end_date"),
        F.max_by("nav", up_to_today).alias("end_nav"),
    ]
    for i, period in enumerate(periods):
        if not period.since_inception:
            up_to_start = F.when(day <= period.start(today), day)
            columns += [
                F.max(up_to_start).alias(f"date_{i}"), F.max_by("nav", up_to_start).alias(f"nav_{i}")
            ]
    return rows.groupBy("scheme_code").agg(*columns)


def _with_anchor(nav: DataFrame) -> DataFrame:
    """History rows with their scheme's last date.

    The last date is a hash aggregate and comes back by a plain join, which Spark broadcasts
    when the schemes turn out few and otherwise does on the key.
    """
    last = nav.groupBy("scheme_code").agg(F.max("nav_date").alias("anchor"))
    return nav.join(last, "scheme_code")


def _wide_last_nav(anchored: DataFrame, periods: list[Period]) -> DataFrame:
    """One row per scheme: first and last NAV and the NAV each period starts from."""
    day = F.col("nav_date")
    columns = [
        F.min(day).alias("first_date"),
        F.min_by("nav", day).alias("first_nav"),
        F.max(day).alias("end_date"),
        F.max_by("nav", day).alias("end_nav"),
    ]
    for i, period in enumerate(periods):
        if not period.since_inception:
            boundary = period.start(F.col("anchor"))
            inside = F.when(day > boundary if period.trailing else day >= boundary, day)
            columns += [F.min(inside).alias(f"date_{i}"), F.min_by("nav", inside).alias(f"nav_{i}")]
    return anchored.groupBy("scheme_code").agg(*columns)


def _period_struct(i: int, period: Period, today: Column | None) -> Column:
    """The period's slice of a wide row."""
    anchor = F.col("end_date") if today is None else today
    inception = period.since_inception
    if inception:
        start, end = F.lit("fund-inception"), F.lit("per-fund-last-nav")
    else:
        start, end = F.lit("per-fund-last-nav-minus-period"), F.lit("per-fund-last-nav")
    if today is not None:
        end = today.cast("string")
        start = start if inception else period.start(today).cast("string")
    return F.struct(
        F.lit(period.label).alias("period"),
        start.alias("period_start"),
        end.alias("period_end"),
        (F.col("first_date") if inception else period.start(anchor)).alias("boundary"),
        F.col("first_date" if inception else f"date_{i}").alias("start_nav_date"),
        F.col("first_nav" if inception else f"nav_{i}").alias("start_nav"),
    )


def _finish(long: DataFrame, today: Column | None, slack: int | None) -> DataFrame:
    """Error texts in their fixed order, then the return of the rows without one."""
    lacks_start = F.col("start_nav_date").isNull()
    # Error texts.
    unknown = F.concat(
        F.lit("scheme_code '"), F.col("scheme_code"), F.lit("' not found in scheme_master")
    )
    error = F.when(F.col("in_master").isNull(), unknown)
    if today is None:
        error = (
            error.when(F.col("end_date").isNull(), F.lit("No NAV data for this scheme"))
            .when(lacks_start, F.concat(
                F.lit("No NAV data on or after "), F.col("boundary").cast("string")))
        )
        # A fund without a start still shows its end.
        end_shown = F.col("in_master").isNotNull()
    else:
        boundary = F.coalesce(F.col("boundary").cast("string"), F.lit("0001-01-01"))
        error = (
            error.when(lacks_start, F.concat(F.lit("No NAV data on or before "), boundary))
            .when(F.col("end_date").isNull(), F.concat(
                F.lit("No NAV data on or before "), today.cast("string")))
        )
        end_shown = F.col("in_master").isNotNull() & ~lacks_start
    if slack is not None:
        late = F.col("first_date") > F.date_add("boundary", slack)
        error = error.when(late, F.concat(
            F.lit("History starts only on "), F.col("first_date").cast("string")))
    start_shown = F.col("in_master").isNotNull()
    return (
        long.withColumn("error", error)
        .withColumn("end_nav_date", F.when(end_shown, F.col("end_date")))
        .withColumn("end_nav", F.when(end_shown, F.col("end_nav")))
        .withColumn("start_nav_date", F.when(start_shown, F.col("start_nav_date")))
        .withColumn("start_nav", F.when(start_shown, F.col("start_nav")))
        .withColumn("return_pct", F.when(
            F.col("error").isNull(),
            point_to_point_return(F.col("start_nav"), F.col("end_nav"))))
        .select(*RETURN_COLUMNS)
    )
