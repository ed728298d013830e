"""Mixing sources to target weights by repeating documents.

Words are summed per source, the sources' targets give repetition rates, and every document is
emitted floor(rate) times plus one copy drawn by a hash of its id with the fraction's odds.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from navlake.llm.common import cut, join_small

SEED = "mix-1"
WEIGHTS = (3, 1, 2)

#: The mix's words against all words, as a ratio of whole numbers.
SHARE = (3, 2)

#: The most a source's words may be repeated.
CEILING = 2


def word_count(text: Column) -> Column:
    r"""Number of runs of ``[^\x20\x09-\x0D]``, 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """``source, source_size, target, rate`` per source.

    Sources by code point, null last, weigh 3, 1, 2 in turn. What a source would get above
    CEILING times its size is shared again by weight among the others until none is above:
    with sources in order of ceiling / weight, those up to some place get their ceiling and
    the rest share what remains by weight. This is a table of one row per source.
    """
    per_source = cut(sized.groupBy(source).agg(F.sum(size).alias("source_size")))
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(place - 1, F.lit(len(WEIGHTS))) + 1)
    weighed = per_source.withColumn("weight", weight.cast("long")).withColumn(
        "ceiling", F.col("source_size") * CEILING)
    # ceiling / weight in whole numbers: the product of the other weights orders alike.
    common = 1
    for w in WEIGHTS:
        common *= w
    fill = Window.orderBy((F.col("ceiling") * F.lit(common) / F.col("weight")).cast("long"),
                          F.col(source).asc_nulls_last())
    through = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    levels = (
        weighed.withColumn("full", F.sum("ceiling").over(through))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.sum("weight").over(through) + F.col("weight"))
        .withColumn("all_words", F.sum("source_size").over(everything))
        # Words left, times SHARE's divisor, when every source before this one is full.
        .withColumn("left", F.col("all_words") * SHARE[0] - (F.col("full") - F.col("ceiling")) * SHARE[1])
        .withColumn("is_full", F.col("left") * F.col("weight")
                    >= F.col("ceiling") * F.col("open_weight") * SHARE[1])
        .withColumn("rest", F.min(F.when(~F.col("is_full"), F.struct("full", "left", "open_weight"))).over(everything))
    )
    shared = (F.col("weight") * F.col("rest.left")).cast("double") / (F.col("rest.open_weight") * SHARE[1]).cast("double")
    target = F.when(F.col("is_full"), F.col("ceiling").cast("double")).otherwise(shared)
    return levels.select(
        source, "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies_of(rate: Column, key: Column, seed: str = SEED) -> Column:
    """floor(rate) plus one where the key's hash, read as a number below 1, is below the rest."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + "|"), key)), 1, 13)
    draw = F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def _planned(docs: DataFrame, seed: str) -> DataFrame:
    """``doc`` (all columns of ``docs``), ``size, source_size, target, copies``."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "source", word_count(F.col("text")).alias("size"))
    targets = cut(source_targets(sized))
    key = F.coalesce(F.col("doc.doc_id").cast("string"), F.md5(F.coalesce("doc.text", F.lit(""))))
    return join_small(sized, targets, "source").select(
        "doc", "size", "source_size", "target", copies_of(F.col("rate"), key, seed).alias("copies"))


def with_copies(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``.

    Nulls: a null text has size 0, a null source is a source of its own, and a row without
    doc_id draws by its text. Rows that repeat a doc_id share its draw. A source without words
    has target 0 and its documents are not taken. Input columns with one of the four names are
    replaced, all others kept whatever their names; an empty table gives no rows.
    """
    names = ["size", "source_size", "target", "copies"]
    own = [F.col("doc")[c].alias(c) for c in docs.columns if c not in names]
    return _planned(docs, seed).select(*own, *names)


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix: rows of ``docs`` with their own columns, each as often as it is taken.

    Nulls, repeated rows and empty tables as in ``with_copies``.
    """
    # At most CEILING copies of a row.
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return _planned(docs, seed).where("copies > 0").select("doc", each.alias("copy")).select("doc.*")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, text, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sized GROUP BY source),
levels AS (
  -- The level at which capped shares add up to 1.5 times all words: try each set of full sources.
  SELECT b.source AS edge,
         (SELECT sum(source_size) FROM sources) * 3 - 4 * coalesce(sum(s.source_size) FILTER (
             s.source_size * b.weight < b.source_size * s.weight), 0) AS rest,
         2 * sum(s.weight) FILTER (s.source_size * b.weight >= b.source_size * s.weight) AS open
  FROM sources b, sources s GROUP BY b.source, b.source_size, b.weight),
level AS (
  SELECT rest, open FROM levels l JOIN sources b ON l.edge IS NOT DISTINCT FROM b.source
  WHERE rest * b.weight < 2 * b.source_size * open
  ORDER BY b.source_size / b.weight LIMIT 1),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN rest IS NULL OR rest * s.weight >= 2 * s.source_size * open
              THEN 2.0::DOUBLE * s.source_size
              ELSE (s.weight * rest)::DOUBLE / open::DOUBLE END AS target
  FROM sources s LEFT JOIN level ON true),
drawn AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{SEED}|' || coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, '')))), 1, 13)
         )::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""
