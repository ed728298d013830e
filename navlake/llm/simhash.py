"""SimHash near-dedup with pigeonring filtering.

Fingerprints of 64 bits are split into segments that stand in a ring. If two fingerprints
differ in at most D bits over m segments, some segment starts a chain in which the first j
segments together differ in at most j * D / m bits, for every j. The first segments of such a
chain are equal outright; they are the join key. The other lengths prune candidates before
the distance over all bits is taken.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import cut
from navlake.llm.components import components

BITS = 64
SEED = 42

#: Fingerprints under one key up to which they are compared pair by pair. Above it the same
#: links are found by shared neighbours instead, in rows that grow with the members only.
DENSE = 256


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text as a signed number; words are split at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(p) for p in zip(*(words[i:] for i in range(shingle)))]
    counts = np.zeros(BITS, dtype=np.int64)
    step = 1 << 16  # bounds the unpacked bits of a very long text
    for at in range(0, len(parts), step):
        hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts[at:at + step]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(parts), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return of_batches(text)


def _segments(segments: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment; widths differ by one at most."""
    edges = [round(BITS * i / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _part(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND((1 << width) - 1)


def _chain_holds(difference: Column, start: int, segments: int, distance: int) -> Column:
    """Whether the chain from ``start`` keeps within its share of ``distance`` at each length."""
    ring = _segments(segments)
    mask, holds = 0, F.lit(True)
    for length in range(1, segments + 1):
        first, width = ring[(start + length - 1) % segments]
        mask |= ((1 << width) - 1) << first
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        holds = holds & (F.bit_count(difference.bitwiseAND(F.lit(signed))) <= length * distance // segments)
    return holds


def anchors_of(segments: int, distance: int) -> int:
    """How many segments at the head of a chain must be equal."""
    return max(j for j in range(1, segments + 1) if j * distance < segments)


def links(prints: DataFrame, distance: int = 2, segments: int = 5, dense: int = DENSE) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints within ``distance`` bits.

    ``prints`` has one row per distinct ``fingerprint``. Under a key of up to ``dense``
    fingerprints every pair is held against the chain's budgets and the distance. Under a
    larger key each fingerprint lists its neighbours up to half the distance; two within the
    distance share one, and all that share one are linked with the least of them, which keeps
    every connection in rows that grow with the members, not with their pairs. ``distance``
    must be even for that.
    """
    if distance % 2:
        raise ValueError("distance must be even")
    if distance >= segments:
        raise ValueError("more segments than distance are needed")
    ring, head = _segments(segments), anchors_of(segments, distance)

    def key(start: int) -> Column:
        value = F.lit(0).cast("long")
        for j in range(head):
            first, width = ring[(start + j) % segments]
            value = F.shiftleft(value, width).bitwiseOR(_part(F.col("fingerprint"), first, width))
        return F.struct(F.lit(start).alias("start"), value.alias("head"))

    keyed = prints.select(
        "fingerprint", F.explode(F.array(*[key(s) for s in range(segments)])).alias("key")
    ).select("key.start", "key.head", "fingerprint")
    shared = keyed.groupBy("start", "head").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    spread = F.xxhash64("start", "head").alias("spread")
    meeting = cut(
        keyed.select("*", spread).join(shared.select("*", spread), ["start", "head", "spread"])
        .drop("spread"))

    near = meeting.where(F.col("members") <= dense)
    left, right = near.alias("l"), near.alias("r")
    difference = F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint"))
    chain = F.lit(False)
    for start in range(segments):
        chain = chain | ((F.col("l.start") == start) & _chain_holds(difference, start, segments, distance))
    pairs = left.join(
        right,
        (F.col("l.start") == F.col("r.start")) & (F.col("l.head") == F.col("r.head"))
        & (F.col("l.fingerprint") < F.col("r.fingerprint")) & chain
        & (F.bit_count(difference) <= distance),
    ).select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"))

    crowded = meeting.where(F.col("members") > dense).select("fingerprint").distinct()
    for _ in range(distance // 2):
        flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)])
        last = "near" if "near" in crowded.columns else "fingerprint"
        crowded = crowded.select(
            "fingerprint", F.explode(F.transform(flips, lambda f: F.col(last).bitwiseXOR(f))).alias("near")
        ).distinct()
    if distance == 0:
        return pairs
    met = crowded.groupBy("near").agg(
        F.min("fingerprint").alias("a"), F.collect_set("fingerprint").alias("all"))
    # At most one fingerprint per flip meets at a neighbour.
    stars = met.select("a", F.explode("all").alias("b")).where("a != b").distinct()
    return pairs.unionByName(stars)


def near_groups(docs: DataFrame, shingle: int = 3, distance: int = 2, segments: int = 5,
                dense: int = DENSE) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document.

    ``fingerprint`` is the signed number; ``component_id`` the smallest doc_id that links
    reach, itself included. A null text counts as empty; texts without words have fingerprint
    0 and are linked like any other. Rows without doc_id take part but give no component its
    id (null where none has one); repeated rows are in one component. An empty table gives no
    rows; other columns are not read.
    """
    printed = cut(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fingerprint")))
    distinct = cut(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fingerprint"), distance, segments, dense), "a", "b")
    rooted = cut(
        distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
        .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    spread = F.xxhash64("root").alias("spread")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(
        rooted.select("fingerprint", "root", spread)
        .join(least.select("*", spread), ["root", "spread"])
        .select("fingerprint", "component_id"))
    return printed.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def digest(groups: DataFrame) -> DataFrame:
    """The groups with the fingerprint as 16 hexadecimal digits."""
    return groups.withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, segments: int = 5,
             dense: int = DENSE) -> DataFrame:
    """``docs`` with one document of each group, that of the smallest doc_id, its columns as they are.

    A null doc_id comes last, then the hash of the text decides; of rows that repeat a document
    one stays. A null text counts as empty; documents without words are copies of each other.
    Documents in no group pass without being grouped. An empty table gives no rows.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    printed = whole.select("doc", fingerprints(F.col("doc.text"), shingle).alias("print"))
    counted = cut(printed.groupBy(F.col("print").alias("fingerprint")).agg(F.count(F.lit(1)).alias("rows")))
    roots = components(links(counted.select("fingerprint"), distance, segments, dense), "a", "b")
    rooted = counted.join(roots, counted["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "rows", F.coalesce("root", "fingerprint").alias("root"), F.col("node").isNotNull().alias("linked"))
    # Fingerprints that several rows have or that a link joins to others; a root is linked
    # where another fingerprint names it.
    named = rooted.where("linked").select(F.col("root").alias("fingerprint")).distinct()
    shared = cut(
        rooted.join(named.withColumn("is_root", F.lit(True)), "fingerprint", "left")
        .where("rows > 1 or linked or is_root")
        .select(F.col("fingerprint").alias("print"), F.xxhash64("fingerprint").alias("spread"), "root"))
    joined = printed.withColumn("spread", F.xxhash64("print")).join(shared, ["print", "spread"], "left")
    alone = joined.where("root is null").select("doc")
    order = F.struct(F.col("doc.doc_id").isNull(), "doc.doc_id", F.xxhash64("doc.text"))
    first = joined.where("root is not null").groupBy("root").agg(F.min_by("doc", order).alias("doc"))
    return alone.unionByName(first.select("doc")).select("doc.*")
