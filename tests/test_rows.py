"""Unique rows, labels, latest prices, as-of lookups, companies."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from navlake.operators import asof, companies, dedupe, labels, quality, summary
from navlake.sources import universe
from navlake.schema import UNIVERSE_TYPE


def day(text):
    return dt.date.fromisoformat(text)


def test_dedupe_prefers_latest_ingest_then_highest_nav(spark):
    rows = spark.createDataFrame(
        [("a", day("2024-01-01"), 1.0, 1), ("a", day("2024-01-01"), 2.0, 3),
         ("a", day("2024-01-01"), 9.0, 2), ("a", day("2024-01-01"), 5.0, 3),
         ("b", day("2024-01-01"), 7.0, 0)],
        "scheme_code string, nav_date date, nav double, ingest int",
    )
    assert sorted(map(tuple, dedupe.dedupe_nav(rows, ["ingest"]).collect())) == [
        ("a", day("2024-01-01"), 5.0), ("b", day("2024-01-01"), 7.0)
    ]
    stats = dedupe.duplicate_stats(rows).first()
    assert tuple(stats) == (5, 2, 3)


def test_dedupe_reduces_a_hot_key_before_the_shuffle(spark):
    """A third of all rows share one key; each task sends at most one row of it on."""
    rows = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as scheme_code",
        "date'2024-01-01' as nav_date", "cast(id as double) as nav", "id as ingest",
    )
    unique = dedupe.dedupe_nav(rows, ["ingest"])
    assert unique.count() == 20001
    assert unique.where("scheme_code = 'hot'").first()["nav"] == 29997.0
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_unique_ingest_numbers_dedupe_without_a_sort(spark):
    rows = spark.range(3000).selectExpr(
        "cast(id % 700 as string) as scheme_code", "date'2024-01-01' as nav_date",
        "cast((id * 7919) % 3000 as double) as nav",
        "if(id % 11 = 0, null, -id) as batch", "cast(id as int) as line",
    )
    fast = dedupe.dedupe_nav(rows, ["batch", "line"], order_is_unique=True)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert sorted(map(tuple, fast.collect())) == sorted(
        map(tuple, dedupe.dedupe_nav(rows, ["batch", "line"]).collect()))
    # Orders that are no whole numbers fall back to the struct.
    text = rows.withColumn("line", rows["line"].cast("string"))
    assert dedupe.dedupe_nav(text, ["batch", "line"], order_is_unique=True).count() == 700


def test_latest_nav_and_ties(nav_of, master_of):
    nav = nav_of(("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", "2024-01-01", 3))
    master = master_of(("a", "H", "C", "A fund"))
    latest = {r["scheme_code"]: r for r in summary.latest_nav(nav, master).collect()}
    assert latest["a"]["nav"] == 2.0 and latest["a"]["category"] == "C"
    assert latest["b"]["category"] is None
    doubled = nav.unionByName(nav_of(("a", "2024-01-02", 5)))
    ties = summary.latest_nav_with_ties(doubled).where("scheme_code = 'a'")
    assert sorted(r["nav"] for r in ties.collect()) == [2.0, 5.0]


def test_summaries_leave_out_null_labels(nav_of, master_of):
    nav = nav_of(("a", "2024-01-02", 1), ("b", "2024-01-03", 3), ("c", "2024-01-04", 9))
    master = master_of(("a", "H1", "C", "A"), ("b", "H1", None, "B"), ("c", None, "C", "Cc"))
    latest = summary.latest_nav(nav, master)
    assert [tuple(r) for r in summary.category_summary(latest).collect()] == [
        ("C", 2, 5.0, 1.0, 9.0, day("2024-01-04"))
    ]
    assert [tuple(r) for r in summary.fund_house_summary(latest).collect()] == [
        ("H1", 1, 2, "C", day("2024-01-03"))
    ]
    only_null = summary.fund_house_summary(latest.where("scheme_code = 'b'")).first()
    assert only_null["categories"] is None and only_null["categories_present"] == 0


def test_recent_navs_limit_runs_before_the_shuffle(nav_of):
    nav = nav_of(*[("a", f"2024-01-{d:02d}", d) for d in range(1, 21)], ("b", "2024-01-01", 1))
    recent = summary.recent_navs(nav, 3)
    assert sorted((r["scheme_code"], r["nav"], r["recency"]) for r in recent.collect()) == [
        ("a", 18.0, 3), ("a", 19.0, 2), ("a", 20.0, 1), ("b", 1.0, 1)
    ]
    assert "WindowGroupLimit" in recent._jdf.queryExecution().executedPlan().toString()


def test_scheme_detail(spark, nav_of, master_of):
    nav = nav_of(*[("a", f"2024-01-{d:02d}", d) for d in range(1, 8)], ("x", "2024-01-01", 1))
    master = master_of(("a", "H", "C", "A"), ("b", "H", "C", "B"))
    codes = spark.createDataFrame([("a",), ("b",), ("x",), ("z",), ("a",)], "scheme_code string")
    detail = {r["scheme_code"]: r for r in
              summary.scheme_detail(nav, master, codes).collect()}
    assert [r["nav"] for r in detail["a"]["recent"]] == [7.0, 6.0, 5.0, 4.0, 3.0]
    assert (detail["a"]["status"], detail["a"]["nav_rows"]) == ("mapped", 7)
    assert (detail["b"]["status"], detail["b"]["nav_rows"]) == ("mapped", 0)
    assert (detail["x"]["status"], detail["x"]["nav_rows"]) == ("unmapped", 1)
    assert (detail["z"]["status"], detail["z"]["nav_rows"]) == ("unmapped", 0)


@pytest.mark.parametrize("direction", [asof.BACKWARD, asof.FORWARD])
@pytest.mark.parametrize("exclusive", [False, True])
def test_asof_join_equals_brute_force(spark, nav_of, direction, exclusive):
    """Random rows; a third of the targets ask for one and the same day."""
    dice = random.Random(7)
    start = day("2024-01-01")
    prices = {
        (code, start + dt.timedelta(days=dice.randrange(60))): float(dice.randrange(1000))
        for code in "abc" for _ in range(25)
    }
    nav = nav_of(*[(c, str(d), n) for (c, d), n in prices.items()])
    asked = [("a", start + dt.timedelta(days=30))] * 40 + [
        (dice.choice("abcd"), start + dt.timedelta(days=dice.randrange(-5, 65))) for _ in range(80)
    ]
    targets = spark.createDataFrame(
        [(i, c, d) for i, (c, d) in enumerate(asked)], "id int, scheme_code string, target_date date"
    )

    def expected(code, target):
        def seen(d):
            if exclusive and d == target:
                return False
            return d <= target if direction == asof.BACKWARD else d >= target
        dates = [d for c, d in prices if c == code and seen(d)]
        if not dates:
            return None, None
        best = max(dates) if direction == asof.BACKWARD else min(dates)
        return best, prices[code, best]

    got = {r["id"]: (r["nav_date"], r["nav"]) for r in
           asof.nav_asof_join(targets, nav, direction, exclusive).collect()}
    assert got == {i: expected(c, d) for i, (c, d) in enumerate(asked)}

    one = asof.nav_asof(nav, "2024-01-31", direction, exclusive)
    assert {r["scheme_code"]: (r["nav_date"], r["nav"]) for r in one.collect()} == {
        c: expected(c, day("2024-01-31")) for c in "abc"
        if expected(c, day("2024-01-31"))[0] is not None
    }


def test_asof_rejects_unknown_direction(nav_of):
    with pytest.raises(ValueError):
        asof.nav_asof(nav_of(("a", "2024-01-01", 1)), "2024-01-01", "sideways")


def test_universe_and_upsert(spark, master_of):
    pieces = spark.createDataFrame(
        [({"C1": [("1", "H", "One"), ("2", "H", "Two")], "C2": []},), ({"C3": [("3", "G", "T")]},)],
        "universe map<string, array<struct<scheme_code: string, fund_house: string, "
        "scheme_name: string>>>",
    )
    assert pieces.schema["universe"].dataType.simpleString() == UNIVERSE_TYPE.simpleString()
    flat = universe.flatten_universe(pieces)
    assert sorted(map(tuple, flat.collect())) == [
        ("1", "H", "C1", "One"), ("2", "H", "C1", "Two"), ("3", "G", "C3", "T")
    ]
    fresh = spark.createDataFrame(
        [("2", "H", "C9", "Renamed", 2), ("2", "H", "C9", "Stale", 1), ("4", "N", None, "New", 1)],
        "scheme_code string, fund_house string, category string, scheme_name string, line int",
    )
    merged = dedupe.upsert_scheme_master(flat, fresh, ["line"])
    assert sorted(map(tuple, merged.collect())) == [
        ("1", "H", "C1", "One"), ("2", "H", "C9", "Renamed"), ("3", "G", "C3", "T"),
        ("4", "N", None, "New"),
    ]
    assert dedupe.upsert_scheme_master(None, fresh, ["line"]).count() == 2
    assert dedupe.upsert_scheme_master(flat, fresh.limit(0)).count() == 3
    assert labels.duplicate_master_codes(fresh).collect()[0]["label_rows"] == 2


def test_missing_and_deep_history(nav_of, master_of):
    nav = nav_of(("a", "2024-12-31", 1), ("a", "2025-06-01", 1), ("b", "2025-01-02", 1),
                 ("x", "2020-01-01", 1))
    master = master_of(("a", "H", "C", "A"), ("b", "H", "C", "B"), ("c", "H", "C", "Cc"))
    assert [r["scheme_code"] for r in labels.missing_schemes(master, nav).collect()] == ["c"]
    assert [tuple(r) for r in labels.deep_history_universe(master, nav).collect()] == [
        ("a", day("2024-12-31"))
    ]


def test_coverage_report(nav_of, master_of):
    nav = nav_of(("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("c", "2024-01-01", 1))
    master = master_of(("a", "H", "C1", "A"), ("b", "H", "C1", "B"), ("c", "H", None, "Cc"))
    report = [tuple(r) for r in quality.coverage_report(master, nav).collect()]
    assert report == [
        ("(uncategorised)", 0, 1, 1, 0, 100.0, "OK"),
        ("C1", 0, 2, 1, 1, 50.0, "MISSING 1"),
        ("TOTAL", 1, 3, 2, 1, 66.7, "MISSING 1"),
    ]


def test_freshness_and_load_status(nav_of):
    nav = nav_of(("a", "2024-01-01", 1), ("a", "2024-01-03", 1), ("b", "2024-01-03", 1),
                 ("c", "2024-01-02", 1))
    report = quality.freshness_report(nav, as_of="2024-01-04").first()
    assert (report["nav_rows"], report["schemes"], report["rows_on_latest"]) == (4, 3, 2)
    assert report["status"] == "latest is older than today"
    assert quality.freshness_report(nav, as_of="2024-01-03").first()["status"] == "MATCH"
    empty = quality.freshness_report(nav.limit(0), as_of="2024-01-03").first()
    assert (empty["nav_rows"], empty["latest"]) == (0, None)
    assert quality.load_status(nav, nav_of(("z", "2024-01-02", 1))).first()["already_loaded"]
    assert not quality.load_status(nav, nav_of(("z", "2024-02-02", 1))).first()["already_loaded"]
    assert not quality.load_status(nav, nav.limit(0)).first()["already_loaded"]


def test_chunks_cover_the_span_without_gaps(spark, nav_of):
    nav = nav_of(("a", "2024-02-29", 1), ("a", "2019-02-28", 1), ("b", "2023-06-15", 1),
                 ("b", "2018-01-01", 1))
    chunks = quality.chunk_coverage(nav, as_of="2024-02-29", days=180).collect()
    assert chunks[0]["chunk_start"] == day("2019-02-28")
    assert chunks[-1]["chunk_end"] == day("2024-02-29")
    for before, after in zip(chunks, chunks[1:]):
        assert before["chunk_end"] + dt.timedelta(days=1) == after["chunk_start"]
        assert (before["chunk_end"] - before["chunk_start"]).days == 179
    assert sum(c["nav_rows"] for c in chunks) == 3


CATALOGUE = [("Harbor Mutual Fund", 9), ("quill Mutual Fund", 13), ("Quillon Mutual Fund", 41),
             ("Aspen Mutual Fund", 53), ("The Garden Company Mutual Fund", 83)]


@pytest.mark.parametrize("name, code, error", [
    ("Harbor", 9, None), (" harbor mutual FUND ", 9, None), ("quill", 13, None),
    ("Quillon", 41, None), ("quillo", 41, None), ("qui", None, "ambiguous"),
    ("Nobody", None, "unknown"), ("The Garden Co.", 83, None), ("the garden co.", None, "unknown"),
    ("", None, "ambiguous"), ("Aspen M", 53, None),
])
def test_resolve_company(spark, name, code, error):
    catalogue = spark.createDataFrame(CATALOGUE, "name string, code long")
    aliases = spark.createDataFrame(
        [("The Garden Co.", "The Garden Company Mutual Fund")], "alias string, name string"
    )
    names = spark.createDataFrame([(name,), (name,)], "name string")
    (row,) = companies.resolve_company(names, catalogue, aliases).collect()
    assert (row["code"], row["error"]) == (code, error)


def test_company_candidates_and_unresolved(spark, master_of):
    catalogue = spark.createDataFrame(CATALOGUE, "name string, code long")
    names = spark.createDataFrame([("qui",), ("Harbor",)], "name string")
    assert sorted(r["code"] for r in
                  companies.company_candidates(names, catalogue).collect()) == [13, 41]
    master = master_of(("1", "Harbor", "C", "x"), ("2", "Nobody", "C", "x"), ("3", None, "C", "x"))
    assert [(r["fund_house"], r["error"]) for r in
            companies.unresolved_companies(master, catalogue).collect()] == [("Nobody", "unknown")]


def test_only_prefixes_of_asked_lengths_are_made(spark, conf):
    """A catalogue of one split is dealt out, and its names are cut to the lengths that keys have."""
    catalogue = spark.createDataFrame([(f"Fund {i:04d}", i) for i in range(60)], "name string, code long").coalesce(1)
    asked = spark.createDataFrame([("fund 00",), ("zzz",), ("fund 003",)], "key string")
    made = companies._prefixes(catalogue.withColumn("lower_name", F.lower("name")), asked)
    assert {len(r["key"]) for r in made.collect()} == {3, 7, 8}
    assert made.count() == 180
    assert "Exchange hashpartitioning" in made._jdf.queryExecution().executedPlan().toString()
    names = spark.createDataFrame([("Fund 003",), ("fund 0031",), ("",), ("Fund 00310",)], "name string")
    found = {r["name"]: (r["candidates"], r["error"]) for r in companies.resolve_company(names, catalogue).collect()}
    assert found == {"Fund 003": (10, "ambiguous"), "fund 0031": (1, None), "": (60, "ambiguous"), "Fund 00310": (0, "unknown")}
