"""Writers, readers, whole jobs, views and the stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from navlake.plans import lake as jobs, views
from navlake.session import scratch_path
from navlake.sinks import history, master as master_table
from navlake.sources import feeds, tables
from navlake.streaming.ingest import ingest_stream


def day(text):
    return dt.date.fromisoformat(text)


def stored(spark, path):
    return sorted(
        (r["scheme_code"], str(r["nav_date"]), r["nav"])
        for r in tables.read_nav_history(spark, path).collect()
    )


def files_below(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "nav_history")


def test_compaction_touches_only_the_years_of_the_loads(spark, nav_of, path):
    history.write_nav_history(nav_of(
        ("a", "2022-05-01", 1), ("a", "2023-05-01", 2), ("b", "2023-06-01", 3),
        ("a", "2024-05-01", 4)), path)
    before = files_below(path)
    batch = nav_of(("a", "2023-05-01", 20), ("c", "2024-01-01", 9), ("c", "2024-01-01", 8))
    history.merge_nav_history(spark, batch, path)
    want = [("a", "2022-05-01", 1.0), ("a", "2023-05-01", 20.0), ("a", "2024-05-01", 4.0),
            ("b", "2023-06-01", 3.0), ("c", "2024-01-01", 9.0)]
    assert stored(spark, path) == want and files_below(path) == before
    history.merge_nav_history(spark, batch, path)
    assert stored(spark, path) == want
    assert history.compact_nav_history(spark, path) == [2023, 2024]
    assert stored(spark, path) == want
    after = files_below(path)
    old_year = {k: v for k, v in before.items() if "year=2022" in k}
    assert old_year and old_year == {k: v for k, v in after.items() if "year=2022" in k}


def test_merge_order_within_a_batch(spark, path):
    rows = spark.createDataFrame(
        [("a", day("2024-01-01"), 5.0, 2), ("a", day("2024-01-01"), 9.0, 1)],
        "scheme_code string, nav_date date, nav double, line int")
    history.merge_nav_history(spark, rows, path, ["line"])
    assert stored(spark, path) == [("a", "2024-01-01", 5.0)]


def test_merge_keeps_rows_of_sidecar_files(spark, nav_of, path):
    history.write_nav_history(nav_of(("a", "2024-01-01", 1)), path)
    nav_of(("late", "2024-02-01", 7)).coalesce(1).write.mode("append").parquet(f"{path}/year=2024")
    history.merge_nav_history(spark, nav_of(("b", "2024-03-01", 2)), path)
    assert [r[0] for r in stored(spark, path)] == ["a", "b", "late"]


def test_loads_are_laid_over_the_base_without_a_shuffle_of_it(spark, nav_of, path):
    history.write_nav_history(nav_of(("a", "2023-01-01", 1), ("a", "2024-01-01", 1), ("b", "2024-01-01", 1)), path)
    history.merge_nav_history(spark, nav_of(("a", "2024-01-01", 2)), path)
    plan = tables.read_nav_history(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1
    assert plan.count("PartitionFilters: [") == plan.count("FileScan parquet")


def test_raw_rows_of_a_large_year_are_split(spark, tmp_path, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    rows = spark.range(20000).selectExpr(
        "cast(id as string) as scheme_code",
        "if(id = 0, date'2023-01-01', date'2024-01-01') as nav_date", "rand(1) as nav")
    raw = str(tmp_path / "raw")
    history.write_raw(rows.repartition(8), raw, "bulk", "2024-01-02")
    names = list(files_below(raw))
    assert len([n for n in names if "year=2024" in n]) > 1
    assert len([n for n in names if "year=2023" in n]) == 1
    assert tables.read_raw_nav(spark, raw).count() == 20000


def test_backfill_never_overwrites(spark, nav_of, path):
    history.write_nav_history(nav_of(("a", "2024-01-01", 1)), path)
    history.backfill_funds(
        spark, nav_of(("a", "2024-01-01", 99), ("n", "2023-01-01", 2), ("n", "2024-01-01", 3)), path)
    assert stored(spark, path) == [
        ("a", "2024-01-01", 1.0), ("n", "2023-01-01", 2.0), ("n", "2024-01-01", 3.0)]


def test_files_are_sorted_and_a_scheme_is_in_one_of_a_year(spark, path):
    rows = spark.range(4000).selectExpr(
        "lpad(cast(id % 40 as string), 3, '0') as scheme_code",
        "date_add(date'2023-06-01', cast(id / 40 as int)) as nav_date",
        "cast(id as double) as nav")
    history.write_nav_history(rows, path)
    held = []
    for name in files_below(path):
        codes = [tuple(r) for r in spark.read.parquet(name).select(
            "scheme_code", "nav_date").collect()]
        assert codes == sorted(codes)
        held += {code for code, _ in codes}
    assert len(files_below(path)) > 1 and sorted(held) == sorted(set(held))


def test_partition_pruning(spark, nav_of, path):
    history.write_nav_history(
        nav_of(*[("a", f"{y}-05-01", y) for y in range(2018, 2025)]), path)
    some = tables.between_dates(
        tables.read_nav_history(spark, path), day("2020-01-01"), day("2021-12-31"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len(some.inputFiles()) >= 2 and some.count() == 2
    kept = history.retain_years(tables.read_nav_history(spark, path), "2024-06-01")
    assert kept.agg(F.min("year")).first()[0] == 2019
    assert tables.read_year(spark, path, 2019).count() == 1
    assert tables.read_year(spark, path, 1999).count() == 0
    assert tables.read_year(spark, path + "-absent", 2019).count() == 0


def test_already_loaded(spark, nav_of, path):
    assert not history.already_loaded(spark, path, day("2024-01-01"))
    history.write_nav_history(nav_of(("a", "2024-01-01", 1)), path)
    assert history.already_loaded(spark, path, day("2024-01-01"))
    assert not history.already_loaded(spark, path, day("2024-01-02"))
    assert not history.already_loaded(spark, path, None)


def test_raw_rerun_replaces_itself_only(spark, nav_of, tmp_path):
    raw = str(tmp_path / "raw")
    history.write_raw(nav_of(("a", "2024-01-01", 1), ("a", "2023-01-01", 1)), raw, "daily", "2024-01-02")
    history.write_raw(nav_of(("b", "2024-01-02", 2)), raw, "daily", "2024-01-03")
    history.write_raw(nav_of(("c", "2024-01-01", 3)), raw, "bulk", "2024-01-02")
    history.write_raw(nav_of(("a", "2024-01-01", 9)), raw, "daily", "2024-01-02")
    rows = tables.read_raw_nav(spark, raw).select("scheme_code", "nav").collect()
    assert sorted(map(tuple, rows)) == [("a", 1.0), ("a", 9.0), ("b", 2.0), ("c", 3.0)]


def test_raw_source_must_be_a_directory_name(nav_of, tmp_path):
    with pytest.raises(ValueError):
        history.write_raw(nav_of(("a", "2024-01-01", 1)), str(tmp_path), "a/b")


def test_raw_files_of_different_schemas(spark, nav_of, tmp_path):
    raw = str(tmp_path / "raw")

    def put(rows, year):
        rows.coalesce(1).write.mode("append").parquet(f"{raw}/year={year}")

    put(nav_of(("1", "2023-01-01", 1)).withColumn("scheme_code", F.col("scheme_code").cast("int")), 2023)
    put(nav_of(("2", "2023-01-02", 2)), 2023)
    put(nav_of(("3", "2024-01-01", 3)).withColumn("scheme_code", F.col("scheme_code").cast("long")), 2024)
    put(nav_of(("S-4", "2024-01-02", 4)).withColumn("category", F.lit("C")), 2024)
    put(nav_of(("5", "2024-01-03", 5)).withColumn("nav", F.col("nav").cast("float")), 2024)
    rows = tables.read_raw_nav(spark, raw)
    assert dict(rows.dtypes)["scheme_code"] == "string"
    assert sorted(map(tuple, rows.select("scheme_code", "nav", "category", "year").collect())) == [
        ("1", 1.0, None, 2023), ("2", 2.0, None, 2023), ("3", 3.0, None, 2024),
        ("5", 5.0, None, 2024), ("S-4", 4.0, "C", 2024)]


def test_rebuild_equals_what_the_merges_made(spark, nav_of, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    for i, rows in enumerate([
        nav_of(("a", "2024-01-01", 1), ("b", "2024-01-01", 2)), nav_of(("a", "2024-01-01", 5)),
    ]):
        history.write_raw(rows, home.raw, "daily", f"2024-01-0{i + 2}")
        history.merge_nav_history(spark, rows, home.history)
    rebuilt = str(tmp_path / "rebuilt")
    history.rebuild_nav_history(spark, home.raw, rebuilt)
    assert stored(spark, rebuilt) == stored(spark, home.history) == [
        ("a", "2024-01-01", 5.0), ("b", "2024-01-01", 2.0)]


def test_master_versions(spark, master_of, tmp_path):
    path = str(tmp_path / "master")
    assert master_table.write_scheme_master(spark, master_of(("1", "H", "C", "One")), path) == 1
    current = tables.read_scheme_master(spark, path)
    grown = current.unionByName(master_of(("2", "H", "C", "Two")))
    assert master_table.write_scheme_master(spark, grown, path) == 2
    assert tables.read_scheme_master(spark, path).count() == 2
    master_table.refresh_scheme_master(spark, grown.limit(0), path)
    assert tables.read_scheme_master(spark, path).count() == 2
    flat = str(tmp_path / "flat")
    history.write_flat(grown, flat)
    assert tables.read_scheme_master(spark, flat).count() == 2


def test_flat_history_reads_like_the_partitioned_one(spark, nav_of, tmp_path):
    rows = nav_of(("a", "2024-01-01", 1), ("a", "2023-01-02", 2))
    history.write_flat(rows, str(tmp_path / "flat"))
    history.write_nav_history(rows, str(tmp_path / "parts"))
    flat, parts = (tables.read_nav_history(spark, str(tmp_path / n)) for n in ("flat", "parts"))
    assert flat.schema.names == parts.schema.names
    assert sorted(flat.collect()) == sorted(parts.collect())


def test_views_and_missing_lake(spark, nav_of, master_of, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    with pytest.raises(FileNotFoundError):
        views.register_views(spark, home)
    history.write_nav_history(nav_of(("a", "2024-01-01", 1), ("a", "2024-01-02", 2)), home.history)
    master_table.write_scheme_master(spark, master_of(("a", "H", "C", "A")), home.master)
    views.register_views(spark, home)
    assert spark.sql("SELECT nav, category FROM latest_nav").collect()[0] == (2.0, "C")
    assert spark.sql("SELECT total_schemes FROM category_summary").first()[0] == 1
    assert spark.sql("SELECT categories FROM fund_house_summary").first()[0] == "C"
    assert spark.sql("SELECT * FROM nav_history").columns == [
        "scheme_code", "nav_date", "nav", "fund_house", "category", "scheme_name"]
    assert spark.sql("SELECT * FROM scheme_master").count() == 1


LABELLED_1 = """Scheme Code;ISIN;ISIN;Scheme Name;NAV;Date
Open Ended Schemes(X - Long Short)
House A
SIF-1;i;i;One;10;01-Feb-2026
SIF-2;i;i;Two;20;01-Feb-2026
"""
LABELLED_2 = LABELLED_1.replace("01-Feb", "02-Feb").replace("One", "One Renamed").replace(
    "SIF-2;i;i;Two;20", "SIF-3;i;i;Three;30")


def test_labelled_daily_update_grows_the_master(spark, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    for name, content in (("d1", LABELLED_1), ("d2", LABELLED_2)):
        (landing / name).mkdir(parents=True)
        (landing / name / "feed.txt").write_text(content)
    first = str(landing / "d1")
    assert jobs.labelled_daily_update(spark, first, home, ingest_date="2026-02-01")
    assert not jobs.labelled_daily_update(spark, first, home, ingest_date="2026-02-01")
    assert jobs.labelled_daily_update(spark, first, home, ingest_date="2026-02-01", force=True)
    assert jobs.labelled_daily_update(spark, str(landing / "d2"), home, ingest_date="2026-02-02")
    assert stored(spark, home.history) == [
        ("SIF-1", "2026-02-01", 10.0), ("SIF-1", "2026-02-02", 10.0),
        ("SIF-2", "2026-02-01", 20.0), ("SIF-3", "2026-02-02", 30.0)]
    names = tables.read_scheme_master(spark, home.master).select("scheme_code", "scheme_name")
    assert sorted(map(tuple, names.collect())) == [
        ("SIF-1", "One Renamed"), ("SIF-2", "Two"), ("SIF-3", "Three")]


def test_update_without_rows_does_nothing(spark, master_of, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    master_table.write_scheme_master(spark, master_of(("1", "H", "C", "One")), home.master)
    (tmp_path / "feed.txt").write_text("9;;;not in the universe;1;01-Feb-2026\n")
    assert not jobs.daily_update(spark, str(tmp_path / "feed.txt"), home)
    assert tables.find_table(spark, home.history) is None


def test_backfill_and_migrate(spark, master_of, tmp_path):
    home, target = jobs.Lake(str(tmp_path / "lake")), jobs.Lake(str(tmp_path / "target"))
    master_table.write_scheme_master(
        spark, master_of(("1", "H", "C", "One"), ("2", "H", "C", "Two")), home.master)
    (tmp_path / "h.txt").write_text("\n".join([
        "1;n;p;o;i;i;10;01-Feb-2020", "1;n;p;o;i;i;11;01-Feb-2026",
        "2;n;p;o;i;i;20;01-Feb-2026", "3;n;p;o;i;i;30;01-Feb-2020"]))
    assert jobs.backfill_history(spark, str(tmp_path / "h.txt"), home)
    assert [r[0] for r in stored(spark, home.history)] == ["1", "1", "2"]
    jobs.migrate_scoped(spark, home, target)
    assert [r[0] for r in stored(spark, target.history)] == ["1", "1"]
    assert tables.read_scheme_master(spark, target.master).count() == 1
    assert tables.read_raw_nav(spark, target.raw).count() == 2


def test_labelled_backfill(spark, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    (tmp_path / "h.txt").write_text(
        "Open Ended Schemes(A - B)\nHouse\nSIF-1;Name;i;i;5.5;0;0;03-Mar-2026\n")
    assert jobs.labelled_backfill_history(spark, str(tmp_path / "h.txt"), home)
    assert stored(spark, home.history) == [("SIF-1", "2026-03-03", 5.5)]
    assert tables.read_scheme_master(spark, home.master).first()["category"] == "B"


def test_stream_takes_each_file_once_and_late_rows_rewrite_their_year(spark, tmp_path):
    home = jobs.Lake(str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    landing.mkdir()

    def run():
        ingest_stream(
            spark, str(landing), home, str(tmp_path / "checkpoint"),
            lambda feed: feeds.parse_labelled_feed(feed, feeds.LABELLED_DAILY), files_per_batch=1,
        ).awaitTermination()

    (landing / "1.txt").write_text(LABELLED_1)
    (landing / "2.txt").write_text(LABELLED_2)
    os.utime(landing / "1.txt", (1_000_000_000, 1_000_000_000))
    run()
    assert len(stored(spark, home.history)) == 4
    run()
    assert tables.read_raw_nav(spark, home.raw).count() == 4
    (landing / "3.txt").write_text("SIF-1;i;i;One;99;01-Feb-2025\nSIF-1;i;i;One;11;02-Feb-2026\n")
    run()
    assert ("SIF-1", "2025-02-01", 99.0) in stored(spark, home.history)
    assert ("SIF-1", "2026-02-02", 11.0) in stored(spark, home.history)
    assert len(stored(spark, home.history)) == 5


class FakeSession:
    """Stands in for a session: the setting can only be given when one starts."""

    def __init__(self, folder, master):
        self.folder = folder
        self.conf = self
        self.sparkContext = self
        self.master = master

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_scratch_path_follows_the_session():
    shared = FakeSession("hdfs://shared/folder/", "yarn")
    assert scratch_path(shared, "x").startswith("hdfs://shared/folder/navlake/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert "/navlake/x-" in scratch_path(FakeSession(None, "local[2]"), "x")
    with pytest.raises(RuntimeError):
        scratch_path(FakeSession(None, "yarn"), "x")


@pytest.mark.parametrize("one_folder", [False, True])
def test_alternating_types_are_one_scan_per_type(spark, tmp_path, one_folder):
    raw = str(tmp_path / "raw")
    for i in range(6):
        code = F.lit(i).cast("long" if i % 2 else "string").alias("scheme_code")
        day = 1 if one_folder else i + 1
        (spark.range(1).select(code, F.lit("2024-01-01").cast("date").alias("nav_date"), F.lit(1.0).alias("nav"))
         .coalesce(1).write.mode("append").parquet(f"{raw}/year=2024/ingest_date=2024-01-0{day}/source=s"))
    rows = tables.read_raw_nav(spark, raw)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert sorted(r["scheme_code"] for r in rows.collect()) == list("012345")
