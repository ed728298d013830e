"""For each registered query the SQL that gives the same rows on the same tables."""

from navlake.functions.periods import PERIODS, parse_period
from navlake.plans.fixtures import AS_OF, AS_OF_EARLY

ORACLES: dict[str, str] = {}

NAV_RAW = """nav_raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS scheme_code, CAST(l_shipdate AS DATE) AS nav_date,
         l_extendedprice AS nav, l_orderkey, l_linenumber, l_quantity
  FROM lineitem)"""


def _unique(source: str, order: str, name: str, value: str = "nav") -> str:
    return f"""{name} AS (
  SELECT scheme_code, nav_date, nav FROM (
    SELECT scheme_code, nav_date, {value} AS nav, row_number() OVER (
      PARTITION BY scheme_code, nav_date ORDER BY {order}, {value} DESC) AS rn
    FROM {source}) WHERE rn = 1)"""


INGEST = "l_orderkey DESC, l_linenumber DESC"
NAV = f"{NAV_RAW}, {_unique('nav_raw', INGEST, 'nav')}"
NAV_ZERO = f"""{NAV_RAW}, {_unique(
    'nav_raw', INGEST, 'nav', 'CASE WHEN l_quantity = 1 THEN 0.0 ELSE nav END')}"""
EVENTS_RAW = """events_raw AS (
  SELECT CAST(user_id AS VARCHAR) AS scheme_code, CAST(ts AS DATE) AS nav_date,
         value AS nav, event_id FROM events)"""
NAV_EVENTS = f"{EVENTS_RAW}, {_unique('events_raw', 'event_id DESC', 'nav')}"
MASTER = """master AS (
  SELECT CASE WHEN p_size <= 40 THEN '' ELSE 'U' END || CAST(p_partkey AS VARCHAR) AS scheme_code,
         p_brand AS fund_house, nullif(p_type, 'PROMO') AS category, p_name AS scheme_name
  FROM part)"""
LATEST = """latest AS (
  SELECT d.*, fund_house, category, scheme_name
  FROM (SELECT scheme_code, nav_date, nav FROM nav
        QUALIFY rank() OVER (PARTITION BY scheme_code ORDER BY nav_date DESC) = 1) d
  NATURAL LEFT JOIN master)"""


def _add(name: str, ctes: list[str], select: str) -> None:
    once = [c.replace("nav AS (", "nav AS MATERIALIZED (", 1) if c.startswith(("nav_raw", "events_raw")) else c for c in ctes]
    ORACLES[name] = f"WITH {', '.join(once)} {select}" if ctes else select


# Unique rows and duplicates.

_add("dedupe_nav", [NAV], "SELECT * FROM nav")
_add("dedupe_nav_events", [NAV_EVENTS], "SELECT * FROM nav")
_add("duplicate_stats", [NAV_RAW], """
  SELECT count(*) AS rows_before,
         (SELECT count(*) FROM (SELECT DISTINCT scheme_code, nav_date FROM nav_raw)) AS rows_after,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT scheme_code, nav_date FROM nav_raw))
           AS duplicates_dropped
  FROM nav_raw""")
_add("duplicate_master_codes", [], """
  SELECT CAST(o_custkey AS VARCHAR) AS scheme_code, count(*) AS label_rows
  FROM orders GROUP BY 1 HAVING count(*) > 1""")

# Labels and universe.

_add("label_nav", [NAV, MASTER], """
  SELECT n.scheme_code, n.nav_date, n.nav, m.fund_house, m.category, m.scheme_name
  FROM nav n LEFT JOIN master m USING (scheme_code)""")
_add("filter_universe", [NAV, MASTER],
     "SELECT * FROM nav WHERE scheme_code IN (SELECT scheme_code FROM master)")
_add("missing_schemes", [EVENTS_RAW, MASTER], """
  SELECT * FROM master m WHERE NOT EXISTS (
    SELECT 1 FROM events_raw e WHERE e.scheme_code = m.scheme_code)""")
_add("deep_history_universe", [NAV_RAW, MASTER], """
  SELECT scheme_code, min(nav_date) AS first_nav_date FROM nav_raw
  WHERE scheme_code IN (SELECT scheme_code FROM master)
  GROUP BY 1 HAVING min(nav_date) <= DATE '1995-02-01'""")
_add("flatten_universe", [MASTER], "SELECT * REPLACE (coalesce(category, 'PROMO') AS category) FROM master")
_add("universe_codes", [NAV_RAW], "SELECT DISTINCT scheme_code FROM nav_raw")
_add("upsert_scheme_master", [MASTER], """
  SELECT scheme_code, fund_house, category, scheme_name FROM (
    SELECT *, row_number() OVER (PARTITION BY scheme_code ORDER BY fresh DESC, ts DESC,
      event_id DESC) AS rn FROM (
      SELECT scheme_code, fund_house, category, scheme_name, 0 AS fresh,
             NULL AS ts, NULL AS event_id FROM master
      UNION ALL
      SELECT CAST(user_id AS VARCHAR), event_type, nullif(event_type, 'click'), props,
             1, ts, event_id FROM events))
  WHERE rn = 1""")

# Latest prices and summaries.

_add("latest_nav", [NAV, MASTER, LATEST], "SELECT * FROM latest")
_add("latest_nav_with_ties", [EVENTS_RAW, MASTER, LATEST.replace("FROM nav\n", "FROM events_raw\n")],
     "SELECT * FROM latest")
_add("category_summary", [NAV, MASTER, LATEST], """
  SELECT category, len(list_distinct(list(scheme_code))) AS total_schemes,
         round(CAST(sum(CAST(nav AS DECIMAL(28, 8))) AS DOUBLE) / count(nav), 4) AS avg_latest_nav,
         round(list_min(list(nav)), 4) AS min_latest_nav,
         round(list_max(list(nav)), 4) AS max_latest_nav, max(nav_date) AS data_as_of
  FROM latest GROUP BY ALL HAVING category IS NOT NULL""")
_add("fund_house_summary", [NAV, MASTER, LATEST], """
  SELECT fund_house, len(kinds) AS categories_present, total_schemes,
         nullif(array_to_string(kinds, ', '), '') AS categories, data_as_of
  FROM (SELECT fund_house, coalesce(list_sort(list_distinct(list(category))), []) AS kinds,
               len(list_distinct(list(scheme_code))) AS total_schemes, max(nav_date) AS data_as_of
        FROM latest GROUP BY ALL)
  WHERE fund_house IS NOT NULL""")
_add("schemes_per_category", [MASTER],
     "SELECT category, count(*) AS schemes FROM master GROUP BY 1")
_add("scheme_span", [NAV_RAW], """
  SELECT scheme_code, min(nav_date) AS date_from, max(nav_date) AS date_to
  FROM nav_raw GROUP BY 1""")
_add("scheme_stats", [NAV_RAW], """
  SELECT scheme_code, count(*) AS nav_rows, min(nav_date) AS date_from, max(nav_date) AS date_to
  FROM nav_raw GROUP BY 1""")
_add("recent_navs", [NAV, MASTER], """
  SELECT scheme_code, m.scheme_name, m.category, m.fund_house, nav_date, nav, recency FROM (
    SELECT *, row_number() OVER (PARTITION BY scheme_code ORDER BY nav_date DESC) AS recency
    FROM nav) LEFT JOIN master m USING (scheme_code) WHERE recency <= 10""")
_add("scheme_detail", [NAV_EVENTS, MASTER], """
  SELECT scheme_code, m.fund_house, m.category, m.scheme_name,
         CASE WHEN m.scheme_code IS NULL THEN 'unmapped' ELSE 'mapped' END AS status,
         coalesce(s.nav_rows, 0) AS nav_rows, s.date_from, s.date_to, r.recent, s.latest_nav
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS scheme_code FROM customer)
  LEFT JOIN master m USING (scheme_code)
  LEFT JOIN (SELECT scheme_code, count(*) AS nav_rows, min(nav_date) AS date_from,
                    max(nav_date) AS date_to, arg_max(nav, nav_date) AS latest_nav
             FROM nav GROUP BY 1) s USING (scheme_code)
  LEFT JOIN (SELECT scheme_code,
                    string_agg(CAST(nav_date AS VARCHAR), ',' ORDER BY nav_date DESC) AS recent
             FROM (SELECT *, row_number() OVER (PARTITION BY scheme_code
                     ORDER BY nav_date DESC) AS rn FROM nav) WHERE rn <= 5 GROUP BY 1) r
    USING (scheme_code)""")
_add("list_categories", [MASTER],
     "SELECT DISTINCT category FROM master WHERE category IS NOT NULL")
_add("list_funds_in_category", [MASTER], """
  SELECT scheme_code, scheme_name, fund_house, category FROM master
  WHERE upper(category) = 'ECONOMY'""")
_add("sql_views", [NAV, MASTER, LATEST], """
  SELECT l.scheme_code, l.nav_date, l.nav, c.category, c.total_schemes, f.fund_house,
         f.categories_present
  FROM latest l
  JOIN (SELECT category, count(DISTINCT scheme_code) AS total_schemes, round(CAST(sum(CAST(nav AS DECIMAL(28, 8))) AS DOUBLE) / count(nav), 4) AS a
        FROM latest WHERE category IS NOT NULL GROUP BY 1) c ON l.category = c.category
  JOIN (SELECT fund_house, count(DISTINCT category) AS categories_present
        FROM latest WHERE fund_house IS NOT NULL GROUP BY 1) f ON l.fund_house = f.fund_house
  WHERE l.nav >= c.a""")

# As-of lookups and returns.

_add("nav_asof_backward", [NAV], """
  SELECT scheme_code, max(nav_date) AS nav_date, arg_max(nav, nav_date) AS nav
  FROM nav WHERE nav_date <= DATE '1998-06-15' GROUP BY 1""")
_add("nav_asof_forward", [NAV], """
  SELECT scheme_code, min(nav_date) AS nav_date, arg_min(nav, nav_date) AS nav
  FROM nav WHERE nav_date > DATE '1998-06-15' GROUP BY 1""")
TARGETS = """targets AS (
  SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS scheme_code,
         CAST(o_orderdate AS DATE) AS target_date FROM orders)"""
for _name, _compare in (("nav_asof_join_backward", ">="), ("nav_asof_join_forward", "<")):
    _add(_name, [NAV, TARGETS], f"""
      SELECT t.scheme_code, t.target_date, t.o_orderkey, n.nav_date, n.nav
      FROM targets t ASOF LEFT JOIN nav n
        ON t.scheme_code = n.scheme_code AND t.target_date {_compare} n.nav_date""")


def _start(period: str, anchor: str) -> str:
    """The period's boundary in SQL."""
    p = parse_period(period)
    if p.unit in ("YTD", "MTD"):
        return f"CAST(date_trunc('{'year' if p.unit == 'YTD' else 'month'}', {anchor}) AS DATE)"
    if p.unit == "SI":
        return "first_date"
    unit = {"W": "WEEK", "M": "MONTH", "Y": "YEAR"}[p.unit]
    return f"CAST({anchor} - INTERVAL {p.count} {unit} AS DATE)"


SPANS = """spans AS (
  SELECT scheme_code, min(nav_date) AS first_date, max(nav_date) AS last_date
  FROM nav GROUP BY 1)"""

_add("period_windows", [NAV_RAW, SPANS.replace("FROM nav ", "FROM nav_raw ")], " UNION ALL ".join(
    f"SELECT scheme_code, '{p}' AS period, {_start(p, 'last_date')} AS start_date, "
    "last_date AS end_date FROM spans" for p in PERIODS))

ASKED_MASTER = "asked AS (SELECT scheme_code FROM master)"
ASKED_PARTS = "asked AS (SELECT CAST(p_partkey AS VARCHAR) AS scheme_code FROM part)"
ASKED_CUSTOMERS = "asked AS (SELECT CAST(c_custkey AS VARCHAR) AS scheme_code FROM customer)"

_RETURN = """CASE WHEN start_nav <> 0
  THEN round_even((end_nav - start_nav) / start_nav * 100, 4) END"""


def _last_nav_returns(periods, full_window: bool = False) -> list[str]:
    """CTEs up to ``returns`` in the last-NAV convention."""
    targets = " UNION ALL ".join(
        f"SELECT *, '{p}' AS period, {_start(p, 'last_date')} AS boundary, "
        f"{str(parse_period(p).trailing).lower()} AS trailing FROM spans" for p in periods)
    late = """WHEN x.first_date > x.boundary + 10
           THEN 'History starts only on ' || CAST(x.first_date AS VARCHAR)""" if full_window else ""
    after = [f"nav_date {'>' if parse_period(p).trailing else '>='} {_start(p, 'last_date')}" for p in periods]
    firsts = ", ".join(
        f"min(nav_date) FILTER ({c}) AS date_{i}, arg_min(nav, nav_date) FILTER ({c}) AS nav_{i}"
        for i, c in enumerate(after))
    each = " UNION ALL ".join(
        f"SELECT scheme_code, '{p}' AS period, date_{i} AS start_nav_date, nav_{i} AS start_nav FROM firsts "
        f"WHERE date_{i} IS NOT NULL" for i, p in enumerate(periods))
    return [
        SPANS.replace("AS (", "AS MATERIALIZED (", 1),
        f"targets AS MATERIALIZED ({targets})",
        f"firsts AS MATERIALIZED (SELECT scheme_code, {firsts} FROM nav JOIN spans USING (scheme_code) GROUP BY 1)",
        f"starts AS ({each})",
        "ends AS (SELECT scheme_code, arg_max(nav, nav_date) AS end_nav FROM nav GROUP BY 1)",
        f"periods AS (SELECT unnest({list(periods)}) AS period)",
        f"""found AS (
          SELECT a.scheme_code, m.scheme_name, m.fund_house, m.category, p.period,
                 CASE WHEN p.period = 'SI' THEN 'fund-inception'
                      ELSE 'per-fund-last-nav-minus-period' END AS period_start,
                 'per-fund-last-nav' AS period_end,
                 CASE WHEN m.scheme_code IS NOT NULL THEN s.start_nav_date END AS start_nav_date,
                 CASE WHEN m.scheme_code IS NOT NULL THEN s.start_nav END AS start_nav,
                 CASE WHEN m.scheme_code IS NOT NULL THEN x.last_date END AS end_nav_date,
                 CASE WHEN m.scheme_code IS NOT NULL THEN e.end_nav END AS end_nav,
                 CASE WHEN m.scheme_code IS NULL
                      THEN 'scheme_code ''' || a.scheme_code || ''' not found in scheme_master'
                      WHEN x.last_date IS NULL THEN 'No NAV data for this scheme'
                      WHEN s.start_nav_date IS NULL
                      THEN 'No NAV data on or after ' || CAST(x.boundary AS VARCHAR)
                      {late} END AS error
          FROM asked a CROSS JOIN periods p
          LEFT JOIN master m ON m.scheme_code = a.scheme_code
          LEFT JOIN targets x ON x.scheme_code = a.scheme_code AND x.period = p.period
          LEFT JOIN starts s ON s.scheme_code = a.scheme_code AND s.period = p.period
          LEFT JOIN ends e ON e.scheme_code = a.scheme_code)""",
        f"returns AS (SELECT *, CASE WHEN error IS NULL THEN {_RETURN} END AS return_pct FROM found)",
    ]


def _as_of_returns(periods, as_of: str) -> list[str]:
    """CTEs up to ``returns`` in the as-of convention."""
    today = f"DATE '{as_of}'"
    targets = " UNION ALL ".join(
        f"SELECT a.scheme_code, '{p}' AS period, "
        + ("(SELECT first_date FROM spans s WHERE s.scheme_code = a.scheme_code)"
           if p == "SI" else _start(p, today))
        + " AS boundary FROM asked a" for p in periods)
    return [
        SPANS,
        f"targets AS ({targets})",
        """starts AS (
          SELECT t.scheme_code, t.period, max(n.nav_date) AS start_nav_date,
                 arg_max(n.nav, n.nav_date) AS start_nav
          FROM targets t JOIN nav n
            ON n.scheme_code = t.scheme_code AND n.nav_date <= t.boundary
          GROUP BY 1, 2)""",
        f"""ends AS (
          SELECT scheme_code, max(nav_date) AS end_nav_date, arg_max(nav, nav_date) AS end_nav
          FROM nav WHERE nav_date <= {today} GROUP BY 1)""",
        f"""found AS (
          SELECT t.scheme_code, m.scheme_name, m.fund_house, m.category, t.period,
                 CASE WHEN t.period = 'SI' THEN 'fund-inception'
                      ELSE CAST(t.boundary AS VARCHAR) END AS period_start,
                 CAST({today} AS VARCHAR) AS period_end,
                 CASE WHEN m.scheme_code IS NOT NULL THEN s.start_nav_date END AS start_nav_date,
                 CASE WHEN m.scheme_code IS NOT NULL THEN s.start_nav END AS start_nav,
                 CASE WHEN m.scheme_code IS NOT NULL AND s.start_nav_date IS NOT NULL
                      THEN e.end_nav_date END AS end_nav_date,
                 CASE WHEN m.scheme_code IS NOT NULL AND s.start_nav_date IS NOT NULL
                      THEN e.end_nav END AS end_nav,
                 CASE WHEN m.scheme_code IS NULL
                      THEN 'scheme_code ''' || t.scheme_code || ''' not found in scheme_master'
                      WHEN s.start_nav_date IS NULL THEN 'No NAV data on or before '
                           || coalesce(CAST(t.boundary AS VARCHAR), '0001-01-01')
                      WHEN e.end_nav_date IS NULL
                      THEN 'No NAV data on or before ' || CAST({today} AS VARCHAR) END AS error
          FROM targets t
          LEFT JOIN master m ON m.scheme_code = t.scheme_code
          LEFT JOIN starts s ON s.scheme_code = t.scheme_code AND s.period = t.period
          LEFT JOIN ends e ON e.scheme_code = t.scheme_code)""",
        f"returns AS (SELECT *, CASE WHEN error IS NULL THEN {_RETURN} END AS return_pct FROM found)",
    ]


for _period in ("1W", "1M", "1Y", "YTD", "MTD", "SI"):
    _add(f"returns_{_period.lower()}_asof",
         [NAV_ZERO, MASTER, ASKED_MASTER, *_as_of_returns([_period], AS_OF)],
         "SELECT * FROM returns")
    _add(f"returns_{_period.lower()}_last_nav",
         [NAV_ZERO, MASTER, ASKED_MASTER, *_last_nav_returns([_period])],
         "SELECT * FROM returns")
_add("returns_errors_asof",
     [NAV, MASTER, ASKED_PARTS, *_as_of_returns(["1Y", "SI"], AS_OF_EARLY)],
     "SELECT * FROM returns")
_add("returns_errors_last_nav",
     [NAV_EVENTS, MASTER, ASKED_CUSTOMERS, *_last_nav_returns(["1W", "0M", "YTD"])],
     "SELECT * FROM returns")
_add("returns_full_window",
     [NAV, MASTER, ASKED_MASTER, *_last_nav_returns(["1Y", "5Y"], full_window=True)],
     "SELECT * FROM returns")
_add("returns_grid_asof", [NAV_ZERO, MASTER, ASKED_MASTER, *_as_of_returns(PERIODS, AS_OF)],
     "SELECT * FROM returns")
for _name in ("returns_grid_last_nav", "returns_grid_broadcast"):
    _add(_name, [NAV_ZERO, MASTER, ASKED_MASTER, *_last_nav_returns(PERIODS)],
         "SELECT * FROM returns")
_add("returns_from_lake", [NAV, MASTER, ASKED_MASTER, *_last_nav_returns(PERIODS)],
     "SELECT * FROM returns")
_ONE_YEAR = [NAV_ZERO, MASTER, ASKED_MASTER, *_as_of_returns(["1Y"], AS_OF)]
_TOTALS = """count(*) AS total_funds, count(return_pct) AS computed,
  round_even(CAST(sum(CAST(return_pct AS DECIMAL(28, 4))) AS DOUBLE)
             / nullif(count(return_pct), 0), 4) AS avg_return_pct"""
_add("category_returns", _ONE_YEAR, "SELECT * FROM returns WHERE upper(category) = 'ECONOMY'")
_add("category_returns_summary",
     [NAV_ZERO, MASTER, ASKED_MASTER, *_last_nav_returns(PERIODS)],
     f"SELECT category, period, {_TOTALS} FROM returns GROUP BY 1, 2")
_add("one_category_summary", _ONE_YEAR, f"""
  SELECT 'ECONOMY' AS category, {_TOTALS}, CAST(NULL AS VARCHAR) AS error
  FROM returns WHERE upper(category) = 'ECONOMY'""")
_add("unknown_category_summary", _ONE_YEAR, f"""
  SELECT 'NO SUCH' AS category, {_TOTALS}, 'No funds found for category ''no such''. '
    || 'Use list_categories() to see valid names.' AS error
  FROM returns WHERE upper(category) = 'NO SUCH'""")

# Quality reports.

_add("coverage_report", [EVENTS_RAW, MASTER], """
  SELECT CASE WHEN g = 1 THEN 'TOTAL' ELSE category END AS category, g AS is_total, total,
         present, total - present AS missing,
         round_even(present / total * 100, 1) AS coverage_pct,
         CASE WHEN total = present THEN 'OK'
              ELSE 'MISSING ' || CAST(total - present AS VARCHAR) END AS status
  FROM (SELECT category, CAST(grouping(category) AS INTEGER) AS g, count(*) AS total,
               count(e.scheme_code) AS present
        FROM (SELECT scheme_code, coalesce(category, '(uncategorised)') AS category FROM master) m
        LEFT JOIN (SELECT DISTINCT scheme_code FROM events_raw) e USING (scheme_code)
        GROUP BY ROLLUP (category))""")
_add("coverage_detail", [EVENTS_RAW, MASTER], """
  SELECT m.*, coalesce(s.nav_rows, 0) AS nav_rows, s.date_from, s.date_to,
         s.nav_rows IS NOT NULL AS is_present
  FROM master m LEFT JOIN (
    SELECT scheme_code, count(*) AS nav_rows, min(nav_date) AS date_from,
           max(nav_date) AS date_to FROM events_raw GROUP BY 1) s USING (scheme_code)""")
_add("freshness_report", [NAV_RAW], f"""
  SELECT count(*) AS nav_rows, count(DISTINCT scheme_code) AS schemes, min(nav_date) AS date_from,
         max(nav_date) AS latest,
         count(*) FILTER (WHERE nav_date = (SELECT max(nav_date) FROM nav_raw)) AS rows_on_latest,
         DATE '{AS_OF}' AS today,
         CASE WHEN max(nav_date) = DATE '{AS_OF}' THEN 'MATCH'
              ELSE 'latest is older than today' END AS status
  FROM nav_raw""")
_add("table_totals", [NAV_RAW], """
  SELECT count(*) AS nav_rows, count(DISTINCT scheme_code) AS schemes, min(nav_date) AS date_from,
         max(nav_date) AS date_to FROM nav_raw""")
_add("feed_match_report", [EVENTS_RAW, MASTER], """
  SELECT (SELECT count(*) FROM master) AS universe, count(DISTINCT scheme_code) AS found,
         (SELECT count(*) FROM master) - count(DISTINCT scheme_code) AS missing,
         count(*) AS feed_rows, max(nav_date) AS nav_date
  FROM events_raw WHERE scheme_code IN (SELECT scheme_code FROM master)""")
_add("load_status", [NAV_RAW, EVENTS_RAW], """
  SELECT max(nav_date) AS nav_date,
         max(nav_date) IN (SELECT nav_date FROM nav_raw) AS already_loaded FROM events_raw""")
_add("chunk_coverage", [NAV_RAW], """
  SELECT CAST(c.chunk AS INTEGER) AS chunk, c.chunk_start, c.chunk_end,
         count(n.scheme_code) AS nav_rows, count(DISTINCT n.scheme_code) AS schemes
  FROM (SELECT i AS chunk, DATE '1998-06-30' + CAST(180 * i AS INTEGER) AS chunk_start,
               least(DATE '1998-06-30' + CAST(180 * i + 179 AS INTEGER), DATE '2003-06-30')
                 AS chunk_end
        FROM generate_series(0, 10) t(i)) c
  LEFT JOIN nav_raw n ON n.nav_date BETWEEN c.chunk_start AND c.chunk_end
  GROUP BY 1, 2, 3""")

# Company names.

COMPANIES = """companies AS (
  SELECT c_name || ' Mutual Fund' AS company, c_custkey AS code,
         lower(c_name) AS short_name, lower(c_name) || ' mutual fund' AS full_name
  FROM customer)"""
_NUMBER = "lpad(CAST(o_custkey AS VARCHAR), 9, '0')"
NAMES = f"""names AS (
  SELECT DISTINCT CASE o_orderpriority
    WHEN '1-URGENT' THEN 'Customer#' || {_NUMBER} || ' Mutual Fund'
    WHEN '2-HIGH' THEN ' ' || upper('Customer#' || {_NUMBER})
    WHEN '3-MEDIUM' THEN CASE WHEN o_orderstatus = 'F' THEN 'Customer#' || {_NUMBER} || ' Mut'
                              ELSE substr('Customer#' || {_NUMBER}, 1, 17) END
    WHEN '4-NOT SPECIFIED' THEN 'Client ' || CAST(o_custkey AS VARCHAR)
    ELSE o_orderstatus || 'Customer#' || {_NUMBER} END AS name
  FROM orders)"""
HOUSES = """names AS (
  SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN 'Customer#00000'
    ELSE 'Customer#' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS name
  FROM part)"""
RESOLVED = """keyed AS (
  SELECT n.name, lower(coalesce(a.c_name || ' Mutual Fund', trim(n.name))) AS key
  FROM names n LEFT JOIN customer a ON trim(n.name) = 'Client ' || CAST(a.c_custkey AS VARCHAR)),
exact AS (
  SELECT k.name, min(c.code) AS code FROM keyed k
  JOIN (SELECT code, full_name AS key FROM companies
        UNION ALL SELECT code, short_name FROM companies) c ON c.key = k.key GROUP BY 1),
prefixed AS (
  SELECT k.name, c.company, c.code FROM keyed k JOIN companies c ON starts_with(c.full_name, k.key)
  WHERE k.name NOT IN (SELECT name FROM exact)),
counted AS (
  SELECT k.name, k.key, CASE WHEN e.code IS NOT NULL THEN 1 ELSE coalesce(p.n, 0) END AS candidates,
         coalesce(e.code, CASE WHEN p.n = 1 THEN p.code END) AS code
  FROM keyed k LEFT JOIN exact e USING (name)
  LEFT JOIN (SELECT name, count(*) AS n, min(code) AS code FROM prefixed GROUP BY 1) p
    USING (name)),
resolved AS (
  SELECT name, key, c.company, code, CAST(candidates AS BIGINT) AS candidates,
         CASE WHEN candidates > 1 THEN 'ambiguous' WHEN candidates = 0 THEN 'unknown' END AS error
  FROM counted LEFT JOIN companies c USING (code))"""
_add("resolve_company", [COMPANIES, NAMES, RESOLVED], "SELECT * FROM resolved")
_add("company_candidates", [COMPANIES, NAMES, RESOLVED], """
  SELECT DISTINCT r.key, p.company, p.code FROM prefixed p JOIN resolved r USING (name)
  WHERE r.error = 'ambiguous'""")
_add("unresolved_companies", [COMPANIES, HOUSES, RESOLVED], """
  SELECT name AS fund_house, candidates, error FROM resolved WHERE error IS NOT NULL""")

# Feeds.

_add("parse_daily_feed", [NAV_RAW, MASTER], """
  SELECT scheme_code, nav_date, nav FROM nav_raw
  WHERE l_quantity NOT IN (2, 3, 4, 5, 6, 7)
    AND scheme_code IN (SELECT scheme_code FROM master)""")
_add("parse_history_feed", [NAV], "SELECT * FROM nav")
_add("parse_labelled_feed", [NAV, MASTER], """
  SELECT 'SIF-' || n.scheme_code AS scheme_code, nav_date, nav,
         coalesce(m.fund_house, 'No House') AS fund_house,
         coalesce(m.category, 'Unlisted') AS category,
         coalesce(m.scheme_name, 'No Name') AS scheme_name
  FROM nav n LEFT JOIN master m USING (scheme_code)""")

# Writers.

_STORED = "SELECT scheme_code, nav_date, nav, CAST(year(nav_date) AS INTEGER) AS year FROM nav"
_add("write_nav_history", [NAV], _STORED)
_add("merge_nav_history",
     [NAV_RAW, _unique("nav_raw", f"l_linenumber > 3 DESC, {INGEST}", "nav")], _STORED)
_add("backfill_funds",
     [NAV_RAW, _unique("nav_raw", f"l_linenumber > 3, {INGEST}", "nav")], _STORED)
_add("rebuild_nav_history",
     [NAV_RAW, _unique("nav_raw", "l_linenumber > 3 DESC", "nav")], _STORED)
_add("write_raw", [NAV_RAW], f"""
  SELECT scheme_code, nav_date, nav, CAST(year(nav_date) AS INTEGER) AS year,
         DATE '{AS_OF}' AS ingest_date,
         CASE WHEN l_linenumber <= 3 THEN 'daily' ELSE 'bulk' END AS source
  FROM nav_raw""")
_add("read_raw_nav", [NAV_RAW], """
  SELECT scheme_code, nav_date, nav, CASE WHEN l_linenumber > 3 THEN 'house' END AS fund_house,
         CAST(year(nav_date) AS INTEGER) AS year FROM nav_raw""")
_add("relayout_scoped", [NAV, MASTER],
     f"{_STORED} WHERE scheme_code IN (SELECT scheme_code FROM master)")
_add("migrate_scoped", [NAV, MASTER], """
  SELECT n.scheme_code, n.nav_date, n.nav, m.fund_house, m.category, m.scheme_name
  FROM nav n JOIN master m USING (scheme_code)
  WHERE n.scheme_code IN (
    SELECT scheme_code FROM nav GROUP BY 1 HAVING min(nav_date) <= DATE '1995-02-01')""")
_add("retain_years", [NAV], f"{_STORED} WHERE year(nav_date) >= 1996")
_add("between_dates", [NAV],
     f"{_STORED} WHERE nav_date BETWEEN DATE '1997-06-01' AND DATE '1999-05-31'")
_add("write_flat", [NAV], "SELECT * FROM nav")
_add("write_scheme_master", [MASTER],
     "SELECT scheme_code, fund_house, category, upper(scheme_name) AS scheme_name FROM master")
ORACLES["labelled_history_update"] = ORACLES["parse_labelled_feed"]
ORACLES["replace_plain_master"] = ORACLES["write_scheme_master"]
ORACLES["lake_views"] = ORACLES["sql_views"]
_add("read_year", [NAV], f"{_STORED} WHERE year(nav_date) = 1997")
_add("freshness_of_year", [NAV], f"""
  SELECT count(*) AS nav_rows, count(DISTINCT scheme_code) AS schemes, min(nav_date) AS date_from,
         max(nav_date) AS latest, count(*) FILTER (nav_date = (
           SELECT max(nav_date) FROM nav WHERE year(nav_date) = 1997)) AS rows_on_latest,
         DATE '{AS_OF}' AS today, 'latest is older than today' AS status
  FROM nav WHERE year(nav_date) = 1997""")
_add("backfill_update", [NAV, MASTER],
     f"{_STORED} WHERE scheme_code IN (SELECT scheme_code FROM master)")
_add("migrate_raw_scoped", [NAV_RAW, MASTER], f"""
  SELECT scheme_code, nav_date, nav, CAST(year(nav_date) AS INTEGER) AS year,
         DATE '{AS_OF}' AS ingest_date, 'daily' AS source
  FROM nav_raw WHERE scheme_code IN (SELECT scheme_code FROM master) AND scheme_code IN (
    SELECT scheme_code FROM nav_raw GROUP BY 1 HAVING min(nav_date) <= DATE '1995-02-01')""")
_add("retain_raw", [NAV_RAW], f"""
  SELECT CAST(year(nav_date) AS INTEGER) AS year, DATE '{AS_OF}' AS ingest_date,
         'daily' AS source, count(*) AS raw_rows
  FROM nav_raw WHERE year(nav_date) < 1996 GROUP BY ALL""")
_add("category_returns_by_name", _ONE_YEAR, """
  SELECT *, CAST(row_number() OVER (ORDER BY scheme_name, scheme_code) AS INTEGER) AS position
  FROM returns WHERE upper(category) = 'ECONOMY'""")
_add("daily_update", [NAV, MASTER], f"""
  SELECT *, true AS first_loaded, false AS second_loaded
  FROM ({_STORED}) WHERE scheme_code IN (SELECT scheme_code FROM master)""")
_add("labelled_update", [NAV, MASTER], """
  SELECT DISTINCT 'SIF-' || n.scheme_code AS scheme_code,
         coalesce(m.fund_house, 'No House') AS fund_house,
         coalesce(m.category, 'Unlisted') AS category,
         coalesce(m.scheme_name, 'No Name') AS scheme_name
  FROM nav n LEFT JOIN master m USING (scheme_code)""")
_add("ingest_stream_daily", [NAV, MASTER],
     f"{_STORED} WHERE scheme_code IN (SELECT scheme_code FROM master)")
_add("returns_over_loads",
     [NAV_RAW, _unique("nav_raw", f"l_linenumber > 3 DESC, {INGEST}", "nav"), MASTER, ASKED_MASTER,
      *_as_of_returns(["1Y", "SI"], AS_OF)], "SELECT * FROM returns")
_add("compact_nav_history",
     [NAV_RAW, _unique("nav_raw", f"least(greatest(l_linenumber, 3), 5) DESC, {INGEST}", "nav")], _STORED)
_add("stored_order", [NAV], """
  SELECT CAST(year(nav_date) AS INTEGER) AS year, count(*) AS nav_rows, CAST(0 AS BIGINT) AS out_of_order
  FROM nav GROUP BY 1""")
_add("scheme_from_lake", [NAV], f"{_STORED} WHERE scheme_code = '101'")
_add("freshness_of_lake", [NAV], f"""
  SELECT count(*) AS nav_rows, count(DISTINCT scheme_code) AS schemes, min(nav_date) AS date_from,
         max(nav_date) AS latest, count(*) FILTER (nav_date = (SELECT max(nav_date) FROM nav)) AS rows_on_latest,
         DATE '{AS_OF}' AS today,
         CASE WHEN max(nav_date) = DATE '{AS_OF}' THEN 'MATCH' ELSE 'latest is older than today' END AS status
  FROM nav""")
_add("drop_expired_raw", [NAV_RAW], f"""
  SELECT scheme_code, nav_date, nav, CAST(year(nav_date) AS INTEGER) AS year,
         DATE '{AS_OF}' AS ingest_date, 'daily' AS source
  FROM nav_raw WHERE year(nav_date) >= 1996""")
ORACLES["resumed_load"] = ORACLES["parse_labelled_feed"]
_add("ingest_stream_batches", [NAV, MASTER], """
  SELECT scheme_code, nav_date, nav + CASE WHEN scheme_code LIKE '%1' THEN 1 ELSE 0 END AS nav,
         CAST(year(nav_date) AS INTEGER) AS year
  FROM nav WHERE scheme_code IN (SELECT scheme_code FROM master)""")
