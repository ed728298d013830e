import datetime as dt

import pytest
from pyspark.sql import functions as F

from navlake.functions import text
from navlake.operators.carry import carry_forward
from navlake.sources import feeds


@pytest.fixture
def landed(tmp_path):
    """Write feed files and give back their folder."""

    def write(**files):
        folder = tmp_path / "landing"
        folder.mkdir(exist_ok=True)
        for name, content in files.items():
            (folder / f"{name}.txt").write_bytes(content.encode())
        return str(folder)

    return write


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def day(text):
    return dt.date.fromisoformat(text)


def test_daily_feed_drops_malformed_rows(spark, landed):
    good = "\r\n".join([
        "Scheme Code;ISIN;ISIN;Scheme Name;Net Asset Value;Date",
        "",
        "Open Ended Schemes(Debt)",
        " 101 ; i ;; A fund ; 12.5 ; 01-Feb-2026 ",
        "102;i;;B;1e2;1-FEB-2026",
        "103;i;;C;.5;02-Feb-2026;one field more",
        "104;i;;D;0.0;02-Feb-2026",
    ])
    bad = "\n".join([
        "201;i;;x;N.A.;01-Feb-2026", "202;i;;x;1,000;01-Feb-2026", "203;i;;x;1.0d;01-Feb-2026",
        "204;i;;x;nan;01-Feb-2026", "205;i;;x;inf;01-Feb-2026", "206;i;;x;1e999;01-Feb-2026",
        "207;i;;x;1;31-Feb-2026", "208;i;;x;1;2026-02-01", "209;i;;x;1;01-Feb-26",
        "20x;i;;x;1;01-Feb-2026", "210;i;x;1;01-Feb-2026", ";i;;x;1;01-Feb-2026",
        "211;i;;x;1;01-Feb-0000",
    ])
    feed = feeds.read_feed(spark, landed(good=good, bad=bad))
    assert rows_of(feeds.parse_daily_feed(feed), "scheme_code", "nav_date", "nav") == [
        ("101", day("2026-02-01"), 12.5),
        ("102", day("2026-02-01"), 100.0),
        ("103", day("2026-02-02"), 0.5),
        ("104", day("2026-02-02"), 0.0),
    ]


def test_daily_feed_line_ends_and_universe(spark, landed):
    feed = feeds.read_feed(spark, landed(
        a="1;;;n;1;01-Feb-2026\r2;;;n;2;01-Feb-2026\x0b3;;;n;3;01-Feb-2026 4;;;n;4;01-Feb-2026"
    ))
    assert rows_of(feeds.parse_daily_feed(feed), "scheme_code") == [("1",), ("2",), ("3",), ("4",)]
    universe = spark.createDataFrame([("2",), ("2",), ("9",)], "scheme_code string")
    assert rows_of(feeds.parse_daily_feed(feed, universe), "scheme_code") == [("2",)]


def test_conditions_do_not_parse_a_line_again(spark, landed):
    feed = feeds.read_feed(spark, landed(a="1;;;n;1;01-Feb-2026"))
    for rows in (feeds.parse_daily_feed(feed),
                 feeds.parse_labelled_feed(feed, feeds.LABELLED_DAILY)):
        plan = rows.select("scheme_code", "nav")._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter" in line]
        assert filters and not any("split(" in line for line in filters)
        assert "Python" not in plan


def test_daily_feed_empty_result_is_typed(spark, landed):
    empty = feeds.parse_daily_feed(feeds.read_feed(spark, landed(a="nothing here\n")))
    assert empty.collect() == []
    assert dict(empty.dtypes)["nav_date"] == "date" and dict(empty.dtypes)["nav"] == "double"


HISTORY_TITLE = "Scheme Code;Scheme Name;Plan;Option;ISIN A;ISIN B;Net Asset Value;Date"


def test_history_feed_follows_its_title_lines(spark, landed):
    plain = "\n".join([
        "1;n;p;o;i;i;10;01-Feb-2026",          # before any title: default positions
        HISTORY_TITLE,
        "Some Fund House",
        "2;n;p;o;i;i;20;01-Feb-2026",
        "Scheme Code; Scheme Name;Plan;Option; NET ASSET VALUE ; date ;ISIN A;ISIN B",
        "3;n;p;o;30;02-Feb-2026;i;i",
        "4;n;p;o;i;i;40;01-Feb-2026",          # no longer where the title says
        "5;n;p;o;50;02-Feb-2026",              # too few fields
    ])
    other = "6;n;p;o;i;i;60;03-Feb-2026"       # a new file starts from the defaults
    feed = feeds.read_feed(spark, landed(plain=plain, other=other))
    assert rows_of(feeds.parse_history_feed(feed), "scheme_code", "nav") == [
        ("1", 10.0), ("2", 20.0), ("3", 30.0), ("6", 60.0)
    ]


@pytest.mark.parametrize("title", [
    HISTORY_TITLE.replace("Net Asset Value", "Price"), HISTORY_TITLE.replace(";Date", ";Day"),
])
def test_history_feed_fails_on_unknown_title(spark, landed, title):
    feed = feeds.read_feed(spark, landed(a=f"{title}\n1;n;p;o;i;i;10;01-Feb-2026"))
    with pytest.raises(Exception, match="header lacks"):
        feeds.parse_history_feed(feed).collect()


LABELLED = "\n".join([
    "sif-7;i;i;Early;1.0;01-Feb-2026",
    "Scheme Code;ISIN;ISIN;Scheme Name;NAV;Date",
    "Open Ended Schemes(Equity Oriented Investment Strategies - Long-Short Fund - Ex (Top) 100)",
    "First House SIF",
    "SIF-1;i;i;One;10.0;01-Feb-2026",
    "SIF-2;i;i;Two;bad;01-Feb-2026",
    "Second House",
    "SIF-3;i;i;Three;30.0;01-Feb-2026",
    "Open Ended Schemes(Hybrid)",
    "SIF-4;i;i;Four;40.0;01-Feb-2026",
    "Open Ended Schemes without brackets",
    "SIF-5;i;i;Five;50.0;01-Feb-2026",
])
LABELLED_ROWS = [
    ("SIF-1", "First House SIF", "Long-Short Fund - Ex (Top) 100", "One"),
    ("SIF-3", "Second House", "Long-Short Fund - Ex (Top) 100", "Three"),
    ("SIF-4", "Second House", "Hybrid", "Four"),
    ("SIF-5", "Open Ended Schemes without brackets", "Hybrid", "Five"),
    ("sif-7", None, None, "Early"),
]


def test_labelled_feed_carries_labels(spark, landed):
    feed = feeds.read_feed(spark, landed(a=LABELLED, b="SIF-9;i;i;Nine;9.0;01-Feb-2026"))
    parsed = feeds.parse_labelled_feed(feed, feeds.LABELLED_DAILY)
    assert rows_of(parsed, "scheme_code", "fund_house", "category", "scheme_name") == sorted(
        [*LABELLED_ROWS, ("SIF-9", None, None, "Nine")], key=lambda r: r[0]
    )


def test_labelled_history_layout(spark, landed):
    feed = feeds.read_feed(spark, landed(
        a="Open Ended Schemes(X - Y)\nHouse\nSIF-1;Name;i;i;5.5;0;0;03-Mar-2026"
    ))
    parsed = feeds.parse_labelled_feed(feed, feeds.LABELLED_HISTORY)
    assert rows_of(parsed, "scheme_code", "nav", "nav_date", "scheme_name", "category") == [
        ("SIF-1", 5.5, day("2026-03-03"), "Name", "Y")
    ]


def brute_force_labels(content):
    """The labelled rules applied line by line."""
    house = category = None
    out = []
    for line in content.split("\n"):
        parts = line.split(";")
        if parts[0].startswith("SIF-"):
            out.append((parts[0], house, category))
        elif line.startswith("Open Ended Schemes("):
            category = line[len("Open Ended Schemes("):-1]
        else:
            house = line
    return sorted(out)


def test_labels_cross_the_splits_of_one_large_file(spark, landed, conf):
    """One file holds nearly all rows and is read in many splits."""
    lines = []
    for i in range(6000):
        if i % 997 == 0:
            lines.append(f"Open Ended Schemes(Category {i})")
        if i % 641 == 0:
            lines.append(f"House {i}")
        lines.append(f"SIF-{i:05d};i;i;Name {i};{i}.5;01-Feb-2026")
    content = "\n".join(lines)
    conf("spark.sql.files.maxPartitionBytes", "4096")
    conf("spark.sql.files.openCostInBytes", "0")
    feed = feeds.read_feed(spark, landed(big=content, small="SIF-x;i;i;n;1;01-Feb-2026"))
    assert feed.select("feed_block").distinct().count() > 20
    parsed = feeds.parse_labelled_feed(feed, feeds.LABELLED_DAILY)
    assert rows_of(parsed, "scheme_code", "fund_house", "category") == sorted(
        brute_force_labels(content) + [("SIF-x", None, None)], key=lambda r: r[0]
    )


def test_history_titles_cross_splits(spark, landed, conf):
    blocks = []
    for b in range(6):
        blocks.append(HISTORY_TITLE if b % 2 == 0 else
                      "Scheme Code;Scheme Name;Plan;Option;Date;Net Asset Value;ISIN A;ISIN B")
        for i in range(300):
            code = b * 1000 + i
            blocks.append(f"{code};n;p;o;i;i;{code};01-Feb-2026" if b % 2 == 0 else
                          f"{code};n;p;o;01-Feb-2026;{code};i;i")
    conf("spark.sql.files.maxPartitionBytes", "2048")
    conf("spark.sql.files.openCostInBytes", "0")
    feed = feeds.read_feed(spark, landed(big="\n".join(blocks)))
    parsed = feeds.parse_history_feed(feed)
    assert parsed.count() == 1800
    assert parsed.where("cast(scheme_code as double) <> nav").count() == 0


def test_dates_of_every_month_and_none_of_a_part(spark):
    texts = [f"{d}-{m}-2024" for d in ("1", "09", "29") for m in "Jan FEB mar Apr May jun Jul Aug Sep Oct Nov Dec".split()]
    odd = ["31-Feb-2024", "29-Feb-2023", "00-Jan-2024", "32-Jan-2024", "1-Anf-2024", "1-abc-2024", "1-Feb-0000",
           "1-Feb-24", "Feb-2024", "1--2024", "001-Feb-2024", "", None, "1-Feb-0001", "31-Dec-9999"]
    rows = spark.createDataFrame([(t,) for t in texts + odd], "t string").select(
        "t", text.feed_date(F.col("t")).alias("day"),
        F.when(F.col("t").rlike(text._DATE), F.try_to_date("t", "d-MMM-yyyy")).alias("by_pattern"))
    found = rows.collect()
    assert all(r["day"] == r["by_pattern"] for r in found)
    assert sum(r["day"] is not None for r in found) == len(texts) + 2
    plan = rows.select("day")._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower()


def test_lines_pass_or_are_stripped(spark):
    texts = ["a", "", " ", " a", "a\t", "a b", "　a", "a ", "éaé", "a\n", "a\x85b", "a\x85", "a;\x1c", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert all(r[0] == r[1] for r in rows.select(text.strip_line(F.col("t")), text.strip(F.col("t"))).collect())
    split = rows.select(text.split_lines(F.col("t")), F.split("t", text.OTHER_LINE_ENDS), "t").collect()
    assert all(r[0] == r[1] for r in split if r[2] is not None)


def test_lines_are_written_as_parquet_and_blocks_by_number(spark, tmp_path):
    """A file of two splits; what the first names is carried into the second, not into the next file."""
    parts = [("f", 0, 0, None), ("f", 0, 1, "x"), ("f", 0, 2, None), ("f", 9, 5, None), ("f", 9, 6, "y"), ("f", 9, 7, None),
             ("g", 0, 0, None), ("g", 3, 1, None)]
    lines = spark.createDataFrame(parts, "feed_file string, feed_block long, feed_row long, v string")
    carried = carry_forward(lines, ["v"])
    got = {tuple(r[:3]): r[3] for r in carried.select("feed_file", "feed_block", "feed_row", "v").collect()}
    assert [got[p[:3]] for p in parts] == [None, "x", "x", "x", "y", "y", None, None]
    plan = carried._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "LogicalRDD" not in plan
    assert "windowspecdefinition(block_number" in plan


def test_history_values_are_parsed_once(spark, tmp_path):
    (tmp_path / "feed.txt").write_text("Scheme Code;n;p;o;Date;Net Asset Value;i;i\n7;n;p;o;01-Feb-2024;5;i;i\n8;n;p;o;x;5;i;i\n")
    rows = feeds.parse_history_feed(feeds.read_feed(spark, str(tmp_path)))
    assert [(r["scheme_code"], r["nav"]) for r in rows.collect()] == [("7", 5.0)]
    conditions = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert not any("cast" in line.lower() and "rlike" in line.lower() for line in conditions)
