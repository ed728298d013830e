"""Row selection by key: unique NAV rows, last-write labels, duplicate counts."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from navlake.schema import KEY, MASTER_COLUMNS


def keep_greatest(
    rows: DataFrame, keys: list[str], order_by: list[str | Column], columns: list[str]
) -> DataFrame:
    """One row per key: the one greatest by ``order_by``, ties settled by ``columns``.

    An aggregate rather than a window: each task first reduces its own rows to one per
    key, so a key that holds a large share of the table never meets in one task.
    """
    order = [c if isinstance(c, Column) else F.col(c) for c in order_by]
    ranked = F.struct(
        *[c.alias(f"order_{i}") for i, c in enumerate(order)], *[F.col(c) for c in columns]
    )
    best = rows.groupBy(*keys).agg(F.max(ranked).alias("best"))
    return best.select(*keys, *[F.col("best")[c].alias(c) for c in columns])


def dedupe_nav(
    nav: DataFrame, order_by: list[str | Column] = (), order_is_unique: bool = False
) -> DataFrame:
    """Unique rows by (scheme, date): latest ingest wins, then the highest NAV.

    ``order_by`` lists the ingest order, most significant first. Columns that are neither
    key, ``nav`` nor order are dropped.

    The order becomes one whole number (``with_ingest_number``), by which hash aggregates keep
    a NAV without sorting the table. ``order_is_unique`` says that no two rows share an order, as
    with the number of an ingest; otherwise a first aggregate leaves the highest NAV of each
    order. Orders that no decimal holds take an aggregate over a struct.
    """
    if not order_by:
        return nav.groupBy(*KEY).agg(F.max("nav").alias("nav"))
    numbered = with_ingest_number(nav, list(order_by))
    if numbered is None:
        return keep_greatest(nav, KEY, list(order_by), ["nav"])
    if not order_is_unique:
        numbered = numbered.groupBy(*KEY, "ingest").agg(F.max("nav").alias("nav"))
    return numbered.groupBy(*KEY).agg(F.max_by("nav", "ingest").alias("nav"))


#: Decimal digits of a decimal, and of the rank that stands for columns which are no numbers. Only
#: names of feed files are ranked, as there are few; other texts may be as many as the rows.
_ALL_DIGITS, _RANK_DIGITS, _RANKED = 38, 15, "feed_file"

# Digits of a place in a feed. A split's first byte, and a row of one task, whose
# upper bits name the task and are the same for a split.
_PLACE_DIGITS = {"feed_block": 13, "feed_row": 10}
_ROW_BITS = (1 << 33) - 1

# Fixed value: a row's place in its split takes this many values, with one for null.
_PLACES = 1 << 34

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20, T.DateType: 8, T.TimestampType: 20}


def _whole_number(column: Column, name: str, kind: T.DataType) -> tuple[Column, int] | None:
    """The value as a number from 1 up, a null as 0, with its decimal digits."""
    if name in _PLACE_DIGITS:
        value = column.bitwiseAND(_ROW_BITS) if name == "feed_row" else column
        digits, least = _PLACE_DIGITS[name], 0
    elif type(kind) not in _WHOLE:
        return None
    else:
        value = F.unix_date(column) if isinstance(kind, T.DateType) else (
            F.unix_micros(column) if isinstance(kind, T.TimestampType) else column)
        bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.DateType: 24}.get(type(kind), 63)
        digits, least = _WHOLE[type(kind)], -(1 << bits)
    shifted = value.cast(f"decimal({_ALL_DIGITS},0)") - F.lit(str(least - 1)).cast(f"decimal({_ALL_DIGITS},0)")
    return F.coalesce(shifted.cast(f"decimal({_ALL_DIGITS},0)"), _decimal(0)), digits


def _decimal(value: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({_ALL_DIGITS},0)")


def with_ingest_number(rows: DataFrame, order_by: list[str | Column]) -> DataFrame | None:
    """The keys and NAVs of ``rows`` with ``ingest``, a whole number that orders as the columns do.

    Whole numbers, dates and times go into a decimal as they are. The name of a feed file and the
    columns before it are replaced by the rank of what they hold together: a row per feed file is
    ranked, not per NAV. In the feed order the ranks are those of the splits, and the number is a
    long. The ranks are sent to every task: joined by a shuffle, the rows of a file would meet in
    one. None for other texts, and where the digits don't suffice.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    names = [c if isinstance(c, str) else "" for c in order_by]
    named = rows.select(*KEY, "nav", *[c.alias(f"order_{i}") for i, c in enumerate(order)])
    numbers = [
        _whole_number(F.col(f"order_{i}"), names[i], named.schema[f"order_{i}"].dataType) for i in range(len(order))]
    ranked = max((i + 1 for i, n in enumerate(numbers) if n is None), default=0)
    digits = [n[1] for n in numbers[ranked:]]
    if sum(digits) + (_RANK_DIGITS if ranked else 0) > _ALL_DIGITS or ranked and names[ranked - 1] != _RANKED:
        return None
    in_splits = ranked and names[ranked:] == list(_PLACE_DIGITS) and named.dtypes[-1][1] == "bigint"
    ranked += bool(in_splits)
    number = _decimal(0)
    if ranked:
        held = [f"order_{i}" for i in range(ranked)]
        ranks = named.select(*held).distinct().withColumn(
            "rank", F.row_number().over(Window.orderBy(*[F.asc_nulls_first(c) for c in held])))
        ranks = ranks.select(*[F.col(c).alias(f"of_{c}") for c in held], "rank")
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in held]
        named = named.join(F.broadcast(ranks), same)
        if in_splits:
            place = F.coalesce(F.col(f"order_{ranked}").bitwiseAND(_ROW_BITS) + 1, F.lit(0))
            return named.select(*KEY, "nav", (F.col("rank").cast("long") * _PLACES + place).alias("ingest"))
        number = F.col("rank").cast(f"decimal({_ALL_DIGITS},0)")
    for value, width in numbers[ranked:]:
        number = (number * _decimal(10 ** width) + value).cast(f"decimal({_ALL_DIGITS},0)")
    return named.select(*KEY, "nav", number.alias("ingest"))


def duplicate_stats(nav: DataFrame) -> DataFrame:
    """Rows before and after ``dedupe_nav`` and the difference, in one pass."""
    per_key = nav.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("duplicates_dropped", F.col("rows_before") - F.col("rows_after"))


def upsert_scheme_master(
    existing: DataFrame | None, fresh: DataFrame, order_by: list[str | Column] = ()
) -> DataFrame:
    """Labels by last write: fresh rows replace existing ones, absent schemes stay.

    Within ``fresh`` the row greatest by ``order_by`` (feed order) wins.
    """
    order = [c if isinstance(c, Column) else F.col(c) for c in order_by]
    new = fresh.select(
        *MASTER_COLUMNS, F.lit(1).alias("is_fresh"), F.struct(F.lit(0), *order).alias("written")
    )
    rows = new
    if existing is not None:
        old = existing.select(
            *MASTER_COLUMNS,
            F.lit(0).alias("is_fresh"),
            F.lit(None).cast(new.schema["written"].dataType).alias("written"),
        )
        rows = old.unionByName(new)
    return keep_greatest(
        rows, ["scheme_code"], ["is_fresh", "written"], MASTER_COLUMNS[1:]
    ).select(*MASTER_COLUMNS)
