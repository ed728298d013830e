"""Importance resampling towards a target: hashed word n-grams, log ratios, Gumbel scores.

A feature's CRC-32 is put together from tables: each byte contributes a value that depends on it
and its distance from the feature's end alone, the contributions of a span are joined by
exclusive or, and the span's length adds a constant. Spans longer than the table fold block by
block.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from navlake.llm.common import cut, number_rows

#: Buckets of features, and words of the longest feature.
BUCKETS = 10_000
MOST_WORDS = 2

#: Words a document must have to be drawn, and the percentage that is.
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Distances from the end that the table holds; bytes of spans that are laid out together.
REACH = 64
STEP = 1 << 19

# Fixed value: the polynomial of CRC-32, its bits reversed.
POLYNOMIAL = 0xEDB88320
ALL = np.uint32(0xFFFFFFFF)


def _bytewise() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_ONE = _bytewise()


def _past(register: np.ndarray, zeros: int) -> np.ndarray:
    """Registers after so many further zero bytes."""
    for _ in range(zeros):
        register = (register >> np.uint32(8)) ^ _ONE[register & np.uint32(255)]
    return register


def _positions() -> np.ndarray:
    rows = [_ONE]
    while len(rows) < REACH:
        rows.append(_past(rows[-1], 1))
    return np.concatenate(rows)


#: What a byte contributes at each distance from the end: ``POSITIONS[256 * distance + byte]``.
POSITIONS = _positions()

#: What the start value alone leaves of a span of each length up to REACH.
LENGTHS = np.array([_past(np.array([ALL]), n)[0] for n in range(REACH + 1)], dtype=np.uint32)

#: Moves a register on by REACH bytes, one table for each of its four bytes.
_FOLD = [[int(v) for v in _past(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), REACH)] for k in range(4)]


def _contributions(stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exclusive or of the bytes' contributions, for spans of 1 to REACH bytes."""
    out = np.empty(len(starts), dtype=np.uint32)
    lens = ends - starts
    edges = np.cumsum(lens) - lens
    parts = np.append(np.searchsorted(edges, np.arange(0, int(lens.sum()) + 1, STEP)), len(starts))
    for a, b in zip(parts, parts[1:]):
        if a == b:
            continue
        first = edges[a:b] - edges[a]
        places = np.arange(int(lens[a:b].sum())) + np.repeat(starts[a:b] - first, lens[a:b])
        distance = np.repeat(ends[a:b] - 1, lens[a:b]) - places
        out[a:b] = np.bitwise_xor.reduceat(POSITIONS[256 * distance + stream[places]], first)
    return out


def span_crcs(stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span ``stream[start:end]``; a span holds a byte at least."""
    lens = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    short = lens <= REACH
    out[short] = _contributions(stream, starts[short], ends[short]) ^ LENGTHS[lens[short]] ^ ALL
    zero, one, two, three = _FOLD
    for i in np.flatnonzero(~short):
        # Blocks end at the span's end, so the first is the one that may be shorter.
        blocks = np.arange(ends[i], starts[i], -REACH)[::-1]
        parts = _contributions(stream, np.maximum(blocks - REACH, starts[i]), blocks)
        register = int(LENGTHS[blocks[0] - starts[i]] ^ parts[0])
        for part in parts[1:].tolist():
            register = (zero[register & 255] ^ one[register >> 8 & 255] ^ two[register >> 16 & 255]
                        ^ three[register >> 24] ^ part)
        out[i] = register ^ 0xFFFFFFFF
    return out


#: Bytes with A-Z lower-cased, and which belong to words: digits, letters, all beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_OF_WORD = np.zeros(256, dtype=bool)
for _low, _high in ((48, 57), (97, 122), (128, 255)):
    _OF_WORD[_low:_high + 1] = True


def features(texts: list[str], most_words: int = MOST_WORDS, buckets: int = BUCKETS):
    """Bucket and text number of every feature, and the number of words of every text."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    given = _LOWER[np.frombuffer(b"\n".join([*coded, b""]), dtype=np.uint8)]
    inside = _OF_WORD[given]
    before = np.concatenate([[False], inside[:-1]])
    # The words, one space after each: a run of words is one span.
    kept = inside | before
    stream = np.where(inside, given, np.uint8(32))[kept]
    place = np.cumsum(kept) - 1
    starts, ends = place[inside & ~before], place[before & ~inside]
    begins = np.cumsum([0] + [len(c) + 1 for c in coded])
    owner = np.searchsorted(begins, np.flatnonzero(inside & ~before), side="right") - 1
    found, owners = [], []
    for words in range(1, most_words + 1):
        n = max(0, len(starts) - words + 1)
        same = owner[:n] == owner[words - 1:words - 1 + n]
        first = np.flatnonzero(same)
        found.append(span_crcs(stream, starts[first], ends[first + words - 1]) % np.uint32(buckets))
        owners.append(owner[first])
    return np.concatenate(found), np.concatenate(owners), np.bincount(owner, minlength=len(texts))


def _steps(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of STEP characters, about."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > STEP:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def bucket_counts(texts: DataFrame, column: str = "text", most_words: int = MOST_WORDS,
                  buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts by bucket; each task sends its sums only."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in _steps(_texts(batch.column(0))):
                total += np.bincount(features(part, most_words, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    parts = texts.select(F.col(column).alias("text")).mapInArrow(count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How much each bucket speaks for the target, in thousandths of the log ratio, rounded down.

    As many numbers as there are buckets reach the driver.
    """
    held = bucket_counts(docs, "text", most_words, buckets).withColumnRenamed("n", "s").join(
        bucket_counts(target, "text", most_words, buckets).withColumnRenamed("n", "t"), "bucket", "full_outer")
    s, t = np.zeros(buckets), np.zeros(buckets)
    for row in held.collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(text: Column, gain: np.ndarray, most_words: int) -> Column:
    @F.pandas_udf("n_words long, n_features long, weight long")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part in _steps([t or "" for t in batch]):
                bucket, owner, words = features(part, most_words, len(gain))
                n = np.bincount(owner, minlength=len(part))
                total = np.zeros(len(part), dtype=np.int64)
                np.add.at(total, owner, gain[bucket])
                rows.append(np.stack([words, n, total // np.maximum(n, 1)], axis=1))
            whole = np.concatenate(rows) if rows else np.zeros((0, 3), dtype=np.int64)
            yield pd.DataFrame(whole, columns=["n_words", "n_features", "weight"])

    return of_batches(text)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    drawn = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(drawn))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, most_words: int = MOST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc`` (all columns of ``docs``), ``n_words, n_features, weight, score``.

    Null and empty texts, and texts without words, have no features and weight 0. A null doc_id hashes as an
    empty one. Repeated rows score alike; an empty table gives no rows.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    found = whole.withColumn("found", _weights(F.col("doc.text"), gain, most_words))
    return found.select(
        "doc", "found.n_words", "found.n_features", "found.weight",
        (F.col("found.weight") + noise(F.col("doc.doc_id"), seed)).alias("score"))


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
           most_words: int = MOST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn and ranked
    from 1: the highest scores, of equal ones the smaller doc_id, a null being the greatest, then the greater
    weight and feature count. The others have no rank. Only these numbers are sorted, never a text.
    """
    weighed = weigh(docs.select("doc_id", "text"), gains(docs, target, most_words, buckets), most_words, seed)
    scored = cut(weighed.select("doc.doc_id", "n_words", "n_features", "weight", "score"))
    able = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    placed = number_rows(scored.where(able), order, "place", "total")
    drawn = F.col("place") < F.floor(F.col("total") * percent / 100)
    with_rank = placed.select(*scored.columns, F.when(drawn, F.col("place") + 1).cast("long").alias("rank"))
    return with_rank.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
         most_words: int = MOST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The documents that are drawn, with all their columns.

    The last rank's score and id decide for every text where it lies, so no text moves. Rows that repeat
    the last drawn one's id and score are all drawn.
    """
    numbers = cut(ranked(docs, target, percent, least_words, most_words, buckets, seed))
    last = numbers.where("rank is not null").orderBy(F.desc("rank")).select("score", "doc_id").first()
    weighed = weigh(docs, gains(docs, target, most_words, buckets), most_words, seed).where(F.col("n_words") >= least_words)
    if last is None:
        return docs.limit(0)
    no_id = (1 << 63) - 1
    key = F.coalesce(F.col("doc.doc_id"), F.lit(no_id))
    at = no_id if last["doc_id"] is None else last["doc_id"]
    ahead = (F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & (key <= at))
    return weighed.where(ahead).select("doc.*")


def digest(numbers: DataFrame) -> DataFrame:
    return numbers.select("doc_id", "n_features", "weight", "score", "rank")
