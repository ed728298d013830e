"""Exact dedup by two passes over a Bloom filter of repeated hashes.

The first pass sets, for every row, a few bits of a blocked Bloom filter and keeps the bits set
by two rows or more. The second pass looks each row up: a row with a bit that no other row set
is unique and passes straight through; only the others are shuffled and grouped exactly.
"""

from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import ascii_lower, cut, repeat_rows

#: Bits in one block of the filter: what one bitmap aggregate holds, 4096 bytes.
BLOCK_BITS = 32_768

#: Rows per block, which gives a row 16 bits; fewest and most blocks. The most are 64 MiB when
#: broadcast, enough for 33 million rows; beyond that more rows shuffle, which changes no result.
BLOCK_ROWS = 2048
FEWEST, MOST = 64, 16_384

#: Bits that a row sets.
PROBES = 3


def blocks_for(rows: int) -> int:
    """Blocks of a filter for so many rows."""
    return min(MOST, max(FEWEST, -(-rows // BLOCK_ROWS)))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(blocks)).cast("int")


def _bits(digest: Column) -> list[Column]:
    mixed = F.xxhash64(digest, F.lit(2))
    return [
        F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(BLOCK_BITS - 1).cast("int")
        for i in range(PROBES)
    ]


def repeated_bits(digests: DataFrame, digest: str = "digest", blocks: int = FEWEST) -> DataFrame:
    """Blocks of the filter (``block``, ``bits``) with the bits that two rows or more set."""
    spread = digests.select(
        _block(F.col(digest), blocks).alias("block"),
        F.explode(F.array_distinct(F.array(*_bits(F.col(digest))))).alias("bit"),
    )
    twice = spread.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1


def possibly_repeated(digests: DataFrame, blocks: int | None = None) -> DataFrame:
    """``digests`` with ``maybe``: false only where no other row has the same digest.

    The filter is as large as the counted rows ask, if its ``blocks`` are not given.
    """
    if blocks is None:
        blocks = blocks_for(digests.count())
    filled = repeated_bits(digests, blocks=blocks)
    hit = F.lit(True)
    for bit in _bits(F.col("digest")):
        hit = hit & _is_set(F.col("bits"), bit)
    return (
        digests.withColumn("block", _block(F.col("digest"), blocks))
        .join(F.broadcast(filled), "block", "left")  # at most MOST rows of 4 KiB
        .withColumn("maybe", F.coalesce(hit, F.lit(False)))
        .drop("block", "bits")
    )


def possibly_among(rows: DataFrame, members: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``maybe``: false only where no row of ``members`` has the value of ``column``.

    The filter is as large as the counted members ask.
    """
    blocks = blocks_for(members.count())
    placed = members.select(
        _block(F.col(column), blocks).alias("block"), F.explode(F.array(*_bits(F.col(column)))).alias("bit"))
    filled = placed.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits"))
    hit = F.lit(True)
    for bit in _bits(F.col(column)):
        hit = hit & _is_set(F.col("bits"), bit)
    return (
        rows.withColumn("block", _block(F.col(column), blocks))
        .join(F.broadcast(filled), "block", "left")  # at most MOST rows of 4 KiB
        .withColumn("maybe", F.coalesce(hit, F.lit(False)))
        .drop("block", "bits")
    )


def exact_groups(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; a null counts as empty. Of equal
    texts the row with the largest doc_id is kept, a null doc_id being the smallest; of rows
    that repeat both, one. Other columns, whatever their names, are not read; an empty table
    gives no rows.

    Texts never move: a digest of each is written once and both passes read that. A hot group
    is counted per task before it is shuffled and its rows are matched with its result by a
    join that Spark can split.
    """
    normal = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    digests = cut(docs.select("doc_id", F.unhex(F.sha2(normal, 256)).alias("digest")))
    looked_up = possibly_repeated(digests, blocks)
    alone = looked_up.where(~F.col("maybe")).select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    rows = looked_up.where("maybe").groupBy("digest", "doc_id").agg(
        F.count(F.lit(1)).alias("copies"))
    groups = rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
    ).withColumn("spread", F.xxhash64("digest"))
    # The hash beside the key makes Spark deal both sides out for this join, not reuse the
    # grouping, so that adaptive execution may split a group of very many rows.
    matched = rows.withColumn("spread", F.xxhash64("digest")).join(groups, ["digest", "spread"])
    shared = repeat_rows(matched, "copies", "copy").select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
    )
    return alone.unionByName(shared).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """One row of each text, with all its columns: that of the largest doc_id, a null being the smallest.

    Of rows that share text and doc_id one stays, the greatest by its text as written. A null
    text counts as empty; an empty table gives no rows. Only rows whose text may be repeated move.
    """
    normal = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.unhex(F.sha2(normal, 256)).alias("digest"))
    looked_up = possibly_repeated(whole, blocks)
    best = looked_up.where("maybe").groupBy("digest").agg(
        F.max_by("doc", F.struct("doc.doc_id", "doc.text")).alias("doc"))
    return looked_up.where(~F.col("maybe")).select("doc").unionByName(best.select("doc")).select("doc.*")


ORACLE = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""
