"""Line dedup by pairwise alignment of documents that share lines or parts of them.

Texts are cut into runs of words (``passages``), which stand for lines and for the parts of long
ones. A document meets the first holder of each run it shares; the runs that a pair of documents
shares are aligned by patience diff, as chains that keep the order of both, and the aligned
common blocks are deleted from the later document. The first document that holds a block keeps it.
"""

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import cut
from navlake.llm.exact import possibly_among
from navlake.llm.passages import less, listed_runs

#: Words a block must have to be deleted, and a run to bring two documents together.
BLOCK_WORDS = 8

#: Stands for a null doc_id, which comes first.
NO_ID = -(1 << 63)


def chains(early: list[int], late: list[int]) -> list[list[int]]:
    """Alignments of the runs that two documents share, as lists of numbers into the two lists.

    ``early`` and ``late`` are the places of each shared run in the two documents. Patience sorting deals the
    runs, by their place in the later document, onto piles that rise in the earlier one: the first pile is
    what keeps both orders from the start, and what has moved in between makes piles of its own. Each pile
    is an alignment, and each run is in one.
    """
    tops: list[int] = []  # the last place of each pile, negated, which rises from pile to pile
    piles: list[list[int]] = []
    for i in sorted(range(len(late)), key=late.__getitem__):
        at = bisect_right(tops, -early[i])  # the first pile that ends before this run
        if at == len(tops):
            piles.append([])
            tops.append(0)
        piles[at].append(i)
        tops[at] = -early[i]
    return piles


def blocks(early: list[int], late: list[int]) -> list[list[int]]:
    """The chains cut where either document has something between two runs."""
    out = []
    for pile in chains(early, late):
        for n, i in enumerate(pile):
            before = pile[n - 1] if n else None
            if before is None or (early[i], late[i]) != (early[before] + 1, late[before] + 1):
                out.append([])
            out[-1].append(i)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """``id, doc``: the place of a document in order, and all its columns."""
    return docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _text() -> Column:
    """The text of a row of ``_keyed``, taken where it is needed, so that a row holds it once."""
    return F.coalesce(F.col("doc.text"), F.lit(""))


def document_pairs(keyed: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """``first, id, early, late, keys``: the runs that a document shares with the first holder of each.

    Rows grow with the places of runs, never with the pairs among their holders: however many
    documents hold a run, each meets the first one only, by a join that Spark can split. Eight
    bytes a run travel, no text does.
    """
    listed = cut(keyed.select("id", listed_runs(_text(), least).alias("runs")))
    held = listed.select("id", F.posexplode("runs").alias("at", "key"))
    shared = cut(
        held.groupBy("key").agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.min_by("at", "id").alias("early"))
        .where("first < last").select("key", "first", "early"))
    later = held.join(shared, "key").where("id > first")
    # A pair has as many rows as the later document has runs at most.
    return later.groupBy("first", "id").agg(
        F.collect_list(F.struct("early", F.col("at").alias("late"), "key")).alias("places")
    ).select("first", "id", "places.early", "places.late", F.col("places.key").alias("keys"))


def _aligned(early: Column, late: Column, keys: Column) -> Column:
    @F.pandas_udf("array<array<long>>")
    def of_batches(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for e, l, k in batches:
            yield pd.Series([
                [[key[i] for i in block] for block in blocks(a.tolist(), b.tolist())]
                for a, b, key in zip(e, l, map(lambda x: x.tolist(), k))], dtype=object)

    return of_batches(early, late, keys)


def repeated_blocks(keyed: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """``id, keys``: the runs in blocks that a document shares with an earlier one."""
    pairs = document_pairs(keyed, least)
    found = pairs.select("id", _aligned(F.col("early"), F.col("late"), F.col("keys")).alias("blocks"))
    return found.groupBy("id").agg(F.flatten(F.collect_list(F.flatten("blocks"))).alias("keys"))


def dedup_lines(docs: DataFrame, least: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``text`` less the repeated blocks, and ``n_lines, removed_lines``.

    A block has ``least`` words or more. The earlier document is the one with the smaller doc_id,
    a null being the smallest; rows with one doc_id, and those without any, are not held against each
    other. Spaces between words and the line breaks inside a block are not compared. Of a passage
    inside a line its ends stay, up to its first and last cut. ``removed_lines`` lists the numbers
    from 0 of the lines deleted whole. A null or empty text stays as it is; a text that is deleted whole
    becomes empty; an empty table gives no rows. Input columns named ``n_lines`` or ``removed_lines``
    are replaced, all others kept whatever their names.
    """
    keyed = _keyed(docs)
    found = cut(repeated_blocks(keyed, least))
    # Texts move only to meet what is to go from them: a Bloom filter lets most others pass.
    marked = possibly_among(keyed, found.select("id"), "id")
    moved = marked.where("maybe").join(found, "id", "left").select(
        "doc", less(_text(), F.col("keys"), least).alias("less"))
    passed = marked.where(~F.col("maybe")).select("doc", F.lit(None).cast(moved.schema["less"].dataType).alias("less"))
    joined = moved.unionByName(passed)
    own = [c for c in docs.columns if c not in ("n_lines", "removed_lines")]
    lines = F.split(F.col("doc.text"), "\n", -1)
    return joined.select(
        *[F.coalesce("less.text", "doc.text").alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in own],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("less.gone", F.array().cast("array<int>")).alias("removed_lines"))


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select(
        "doc_id", "text", "n_lines", F.size("removed_lines").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed_lines", lambda i: i.cast("string")), ",").alias("removed_lines"))
