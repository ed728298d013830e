import calendar
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from navlake.functions.periods import PERIODS, parse_period
from navlake.operators import returns

AS_OF, LAST_NAV = returns.AS_OF, returns.LAST_NAV


def day(text):
    return dt.date.fromisoformat(text)


def back(anchor, label):
    """The boundary date of a period, by the calendar."""
    if label == "YTD":
        return anchor.replace(month=1, day=1)
    if label == "MTD":
        return anchor.replace(day=1)
    count, unit = int(label[:-1]), label[-1]
    if unit == "W":
        return anchor - dt.timedelta(weeks=count)
    months = anchor.year * 12 + anchor.month - 1 - count * (12 if unit == "Y" else 1)
    year, month = divmod(months, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(anchor.day, last))


def by_hand(history, label, convention, today):
    """(start date, start, end date, end, return, error) of one fund from its {date: nav}."""
    dates = sorted(history)
    if convention == AS_OF:
        start_at = back(today, label) if label != "SI" else (dates[0] if dates else dt.date.min)
        starts = [d for d in dates if d <= start_at]
        ends = [d for d in dates if d <= today]
        if not starts:
            return None, None, None, None, None, f"No NAV data on or before {start_at}"
        start = starts[-1]
        if not ends:
            return start, history[start], None, None, None, f"No NAV data on or before {today}"
        end = ends[-1]
    else:
        if not dates:
            return None, None, None, None, None, "No NAV data for this scheme"
        end = dates[-1]
        if label == "SI":
            starts = dates
        else:
            boundary = back(end, label)
            open_ended = label not in ("YTD", "MTD")
            starts = [d for d in dates if d > boundary or (d == boundary and not open_ended)]
            if not starts:
                return None, None, end, history[end], None, f"No NAV data on or after {boundary}"
        start = starts[0]
    first, last = history[start], history[end]
    value = None if first == 0 else round((last - first) / first * 100, 4)
    return start, first, end, last, value, None


@pytest.fixture(scope="module")
def market(spark):
    """Random histories: long, short, empty, starting late, with zero prices."""
    dice = random.Random(11)
    last = day("2024-03-31")
    histories = {}
    for i in range(30):
        length, step = dice.choice([(2200, 9), (400, 3), (40, 1), (1, 1)]), None
        days, step = length
        end = last - dt.timedelta(days=dice.choice([0, 0, 1, 5, 31, 90]))
        histories[f"f{i:02d}"] = {
            end - dt.timedelta(days=k): float(dice.choice([0, 10, 12.5, 99.99, 7.3333]))
            for k in range(0, days, step) if k == 0 or dice.random() < 0.8
        }
    histories["future"] = {day("2024-06-01"): 5.0, day("2024-06-02"): 6.0}
    histories["empty"] = {}
    nav = spark.createDataFrame(
        [(c, d, n) for c, h in histories.items() for d, n in h.items()],
        "scheme_code string, nav_date date, nav double",
    ).cache()
    master = spark.createDataFrame(
        [(c, "House", "Even" if i % 2 else "ODD", f"Fund {c}") for i, c in enumerate(histories)],
        "scheme_code string, fund_house string, category string, scheme_name string",
    ).cache()
    return histories, nav, master


@pytest.mark.parametrize("convention, today", [
    (AS_OF, "2024-03-31"), (AS_OF, "2024-02-29"), (AS_OF, "2018-06-30"), (LAST_NAV, "2024-03-31"),
])
def test_grid_equals_the_fund_by_fund_loop(market, convention, today):
    histories, nav, master = market
    labels = [*PERIODS, "7Y", "0M", "13M"]
    rows = returns.fund_returns(nav, master, labels, convention, as_of=today)
    got = {
        (r["scheme_code"], r["period"]): (
            r["start_nav_date"], r["start_nav"], r["end_nav_date"], r["end_nav"],
            r["return_pct"], r["error"])
        for r in rows.collect()
    }
    want = {
        (code, label): by_hand(history, label, convention, day(today))
        for code, history in histories.items() for label in labels
    }
    assert got == want


def test_single_period_skips_rows_after_today(market):
    histories, nav, master = market
    rows = returns.fund_returns(nav, master, "1Y", AS_OF, as_of="2024-03-31")
    got = {r["scheme_code"]: r["return_pct"] for r in rows.collect()}
    assert got == {
        c: by_hand(h, "1Y", AS_OF, day("2024-03-31"))[4] for c, h in histories.items()
    }


def test_conventions_agree_since_inception(market):
    _, nav, master = market
    one = returns.fund_returns(nav, master, "SI", AS_OF, as_of="2024-12-31")
    two = returns.fund_returns(nav, master, "SI", LAST_NAV)
    columns = ["scheme_code", "start_nav", "end_nav", "return_pct"]
    assert one.select(columns).exceptAll(two.select(columns)).count() == 0


def test_codes_as_list_and_frame(spark, market):
    _, nav, master = market
    asked = ["f01", "nobody", "empty", "f01"]
    rows = returns.fund_returns(nav, master, ["1M", "SI"], LAST_NAV, codes=asked).collect()
    assert len(rows) == 8
    unknown = [r for r in rows if r["scheme_code"] == "nobody"]
    assert {r["error"] for r in unknown} == {"scheme_code 'nobody' not found in scheme_master"}
    frame = spark.createDataFrame([(c,) for c in asked], "scheme_code string")
    same = returns.fund_returns(nav, master, ["1M", "SI"], LAST_NAV, codes=frame).collect()
    assert sorted(map(str, rows)) == sorted(map(str, same))
    (one,) = returns.fund_returns(nav, master, "SI", LAST_NAV, codes="f01").collect()
    assert str(one) in map(str, rows)


def test_unlabelled_code_hides_its_prices(market, nav_of):
    _, nav, master = market
    extra = nav.unionByName(nav_of(("stray", "2024-01-01", 1), ("stray", "2024-02-01", 2)))
    (row,) = returns.fund_returns(extra, master, "SI", LAST_NAV, codes=["stray"]).collect()
    assert row["error"].startswith("scheme_code 'stray'")
    assert (row["start_nav"], row["end_nav"], row["return_pct"]) == (None, None, None)


def test_period_labels(market):
    _, nav, master = market
    row = returns.fund_returns(nav, master, " 1y ", AS_OF, as_of="2024-03-31").first()
    assert (row["period"], row["period_start"], row["period_end"]) == (
        "1Y", "2023-03-31", "2024-03-31")
    row = returns.fund_returns(nav, master, "SI", AS_OF, as_of="2024-03-31").first()
    assert (row["period_start"], row["period_end"]) == ("fund-inception", "2024-03-31")
    row = returns.fund_returns(nav, master, "1Y", LAST_NAV).first()
    assert (row["period_start"], row["period_end"]) == (
        "per-fund-last-nav-minus-period", "per-fund-last-nav")


@pytest.mark.parametrize("text", ["XYZ", "", "M", "1D", "-1M", "1.5Y", "Y1"])
def test_unknown_period_is_refused_up_front(market, text):
    _, nav, master = market
    with pytest.raises(ValueError, match="Unrecognised period"):
        returns.fund_returns(nav, master, text)


@pytest.mark.parametrize("anchor", ["2024-03-31", "2024-02-29", "2023-03-01", "2024-12-31"])
def test_boundaries_follow_the_calendar(spark, anchor):
    labels = [p for p in PERIODS if p != "SI"] + ["7Y", "0M", "11W"]
    start = spark.range(1).select(*[
        parse_period(p).start(F.lit(day(anchor))).alias(p) for p in labels
    ]).first()
    assert start.asDict() == {p: back(day(anchor), p) for p in labels}


def test_category_returns_sorting(market, nav_of, master_of):
    nav = nav_of(
        *[(c, "2024-01-01", 100) for c in "abcd"], ("e", "2024-01-01", 0),
        *[(c, "2024-02-01", v) for c, v in zip("abcde", (110, 120, 110, 90, 50))],
    )
    master = master_of(*[(c, f"H{c}", "Large Cap", n) for c, n in zip("abcde", "zyxwv")],
                       ("f", "Hf", "LARGE CAP", "u"), ("g", "Hg", "Small", "t"))

    def order(**options):
        rows = returns.category_returns(nav, master, "large cap", "SI", **options)
        return "".join(r["scheme_code"] for r in rows.collect())

    # e has a zero start and f no prices: no return, so last either way, by name.
    assert order() == "bcadfe"
    assert order(ascending=True) == "dcabfe"
    assert order(sort_by="no such column") == "bcadfe"
    assert order(sort_by="scheme_name", ascending=True) == "fedcba"
    assert order(sort_by="fund_house") == "fedcba"

    found = returns.category_returns(nav, master, "large cap", "SI")
    total = returns.one_category_summary(found, "large cap").first()
    assert (total["category"], total["total_funds"], total["computed"]) == ("LARGE CAP", 6, 4)
    assert total["avg_return_pct"] == 7.5 and total["error"] is None
    nothing = returns.category_returns(nav, master, "bogus", "SI")
    total = returns.one_category_summary(nothing, "bogus").first()
    assert (total["total_funds"], total["avg_return_pct"]) == (0, None)
    assert total["error"].startswith("No funds found for category 'bogus'")


def test_full_window_policy(nav_of, master_of):
    nav = nav_of(("old", "2020-01-01", 1), ("old", "2024-01-01", 2),
                 ("new", "2023-12-01", 1), ("new", "2024-01-01", 2))
    master = master_of(("old", "H", "C", "o"), ("new", "H", "C", "n"))
    loose = returns.fund_returns(nav, master, "1Y", LAST_NAV).collect()
    assert all(r["error"] is None for r in loose)
    strict = {r["scheme_code"]: r for r in returns.fund_returns(
        nav, master, "1Y", LAST_NAV, require_full_window=True).collect()}
    assert strict["old"]["error"] is None
    assert strict["new"]["return_pct"] is None
    assert "2023-12-01" in strict["new"]["error"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_returns_plan(market):
    _, nav, master = market
    for options in ({"convention": AS_OF, "as_of": "2024-03-31"}, {"convention": LAST_NAV}):
        plan = plan_of(returns.returns_grid(nav, master, **options))
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        assert "Python" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_unknown_convention(market):
    _, nav, master = market
    with pytest.raises(ValueError):
        returns.fund_returns(nav, master, "1Y", "other")


def test_since_inception_needs_no_anchor(spark, nav_of, master_of):
    nav, master = nav_of(("a", "2023-01-01", 10), ("a", "2024-01-01", 20)), master_of(("a", "H", "C", "A"))
    rows = returns.fund_returns(nav, master, "SI")
    assert [r["return_pct"] for r in rows.collect()] == [100.0]
    assert "anchor" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert "anchor" in returns.fund_returns(nav, master, ["SI", "1Y"])._jdf.queryExecution().optimizedPlan().toString()
