"""Byte-level BPE encoding and decoding, long texts in overlapping chunks.

Text is cut into pre-tokens, each merged by rank. The pattern decides a pre-token from what
follows its start alone, so two scans that meet at one boundary agree from there on. A long text
is scanned in chunks that overlap; where a chunk's boundaries meet those of the chunk before,
the text is cut, and the pieces between the cuts are encoded by themselves.
"""

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Code points of a chunk, and of what it shares with the next one.
CHUNK = 65_536
OVERLAP = 1_024


@dataclass(frozen=True)
class Ranks:
    """A vocabulary file that executors hold by broadcast; equal by its path."""

    path: str
    shared: Broadcast = field(compare=False)


def read_ranks(spark: SparkSession, path: str = RANKS) -> Ranks:
    """The rank file, read by the driver and sent once: a vocabulary's size."""
    with open(path, "rb") as file:
        return Ranks(path, spark.sparkContext.broadcast(file.read()))


@lru_cache(maxsize=1)
def encoding(ranks: Ranks) -> tiktoken.Encoding:
    """The library's encoder and decoder over the broadcast ranks, made once in each Python worker."""
    lines = (x.split() for x in ranks.shared.value.splitlines() if x.strip())
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines},
        special_tokens={})


def pattern() -> regex.Pattern:
    # White space is what Unicode calls so; the four separators U+001C to U+001F, which this
    # module adds to \s, are not.
    source = public_tokenizers.PATTERN
    return regex.compile(source.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]")
                         .replace(r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"))


def encode_pieces(text: Column, ranks: Ranks, decoded: bool = False) -> Column:
    """Struct of the packed ``ids`` of a text and, where asked for, of the bytes they stand for.

    One Python worker does both, so that a task needs one encoder.
    """

    @F.pandas_udf("ids binary, decoded binary")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoding(ranks)
        for batch in batches:
            packed, back = [], []
            for t in batch:
                ids = coder.encode_to_numpy(t or "", disallowed_special=())
                packed.append(ids.astype("<u4").tobytes())
                back.append(coder.decode_bytes(ids.tolist()) if decoded else None)
            yield pd.DataFrame({"ids": pd.Series(packed, dtype=object), "decoded": pd.Series(back, dtype=object)})

    return of_batches(text)


def chunk_boundaries(text: Column) -> Column:
    """Starts of pre-tokens that a scan from the chunk's start finds, in code points.

    What touches the chunk's end may go on beyond it, so only starts of pre-tokens that some
    further pre-token follows are sure; of those the ones in the first OVERLAP and after CHUNK
    are given, which is where chunks meet.
    """

    @F.pandas_udf("array<int>")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = pattern().finditer
        for batch in batches:
            rows = []
            for t in batch:
                rows.append([m.start() for m in find(t) if m.start() <= OVERLAP or m.start() >= CHUNK])
            yield pd.Series(rows)

    return of_batches(text)


def _chunks(long: DataFrame) -> DataFrame:
    """``same, chunk, start, part``: the overlapping chunks of each distinct text, dealt out."""
    starts = F.sequence(F.lit(0), F.length("text") - 1, F.lit(CHUNK))
    every = long.select("same", F.posexplode(starts).alias("chunk", "start"), "text").select(
        "same", "chunk", "start", F.col("text").substr(F.col("start") + 1, F.lit(CHUNK + OVERLAP)).alias("part"))
    return every.groupBy("same", "chunk").agg(F.first("start").alias("start"), F.first("part").alias("part"))


def _pieces(long: DataFrame) -> DataFrame:
    """``same, number, piece``: each text of ``long`` (``same, text``) cut at sure boundaries.

    Only boundaries near the joints are brought together per text; a piece is cut out of the
    chunk that holds it. A text with a joint at which the scans don't meet, as within one
    pre-token longer than the overlap, has no sure cut there and is one piece.
    """
    chunks = _chunks(long)
    found = chunks.select("same", "chunk", "start", chunk_boundaries(F.col("part")).alias("at"))
    order = Window.partitionBy("same").orderBy("chunk")
    earlier = F.lag("at").over(order)
    met = F.array_min(F.array_intersect("at", F.transform(earlier, lambda p: p - CHUNK)))
    joined = found.select("same", "chunk", F.when(F.col("chunk") == 0, 0).otherwise(met).alias("first"))
    spans = joined.select(
        "same", "chunk", "first", (F.lead("first").over(order) + CHUNK).alias("past"),
        F.min(F.col("first").isNotNull().cast("int")).over(Window.partitionBy("same")).alias("sure"))
    placed = chunks.join(spans, ["same", "chunk"])
    cut_out = placed.where("sure = 1").select("same", F.col("chunk").alias("number"), F.col("part").substr(
        F.col("first") + 1, F.coalesce("past", F.lit(CHUNK + OVERLAP)) - F.col("first")).alias("piece"))
    parts = F.array_sort(F.collect_list(F.struct("chunk", F.col("part").substr(1, CHUNK).alias("part"))))
    uncut = placed.where("sure = 0").groupBy("same").agg(parts.alias("parts")).select(
        "same", F.lit(0).alias("number"), F.array_join("parts.part", "").alias("piece"))
    return cut_out.unionByName(uncut)


def encode(docs: DataFrame, ranks: Ranks, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the text's ids as packed little-endian unsigned 32-bit integers.

    ``decoded`` adds a column of that name, the bytes that the ids stand for. A null or empty text has
    no ids. Texts longer than a chunk are encoded once however often they repeat, in chunks and
    pieces that are dealt out by themselves. Input columns named as the added ones are replaced, all
    others kept whatever their names; an empty table gives no rows.
    """
    names = ["ids", "decoded"] if decoded else ["ids"]
    own = [c for c in docs.columns if c not in names]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), F.col(f"`{text}`").alias("text"))
    is_long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    short = whole.where(~is_long).select("doc", encode_pieces(F.col("text"), ranks, decoded).alias("coded"))
    long = whole.where(is_long).withColumn("same", F.unhex(F.sha2("text", 256)))
    pieces = _pieces(long.select("same", "text")).select(
        "same", "number", encode_pieces(F.col("piece"), ranks, decoded).alias("coded"))
    joined = pieces.groupBy("same").agg(F.struct(*[
        F.expr(f"listagg(coded.{c}, X'') WITHIN GROUP (ORDER BY number)").alias(c) for c in ("ids", "decoded")]).alias("coded"))
    spread = F.xxhash64("same").alias("spread")
    encoded = long.select("doc", "same", spread).join(joined.select("*", spread), ["same", "spread"])
    return short.unionByName(encoded.select("doc", "coded")).select("doc.*", *[f"coded.{c}" for c in names])


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes that packed ids stand for."""

    @F.pandas_udf("binary")
    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        back = encoding(ranks).decode_bytes
        for batch in batches:
            yield pd.Series([back(np.frombuffer(b, dtype="<u4").tolist()) for b in batch], dtype=object)

    return of_batches(ids)


def digest(encoded: DataFrame, *more: str) -> DataFrame:
    """Per document the count of ids, and checksums of the ids and of the bytes decoded from them."""
    return encoded.select(
        "doc_id", *more, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
