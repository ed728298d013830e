"""A training corpus from raw documents: five stages, each written and read by the next.

Documents judged toxic go; lines and passages that repeat an earlier document go; of near copies one stays;
sources are mixed to target weights; what is left is encoded.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from navlake.llm import bpe, lines, mixing, simhash, toxicity
from navlake.llm.common import documents, let_workers_import
from navlake.session import scratch_path


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic; the lexicon is learned from the labelled ones.

    Null and empty texts are judged by the calibration, repeated rows alike; an empty table stays empty.
    """
    let_workers_import(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines and passages that repeat one of a smaller doc_id.

    A null text stays null, a null doc_id is the smallest; rows of one doc_id are not held against each
    other; an empty table stays empty.
    """
    let_workers_import(spark)
    kept = lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id, a null being the greatest.

    Three-word shingles and two differing bits, as the operator's. A null text counts as empty; of
    repeated rows one stays; an empty table stays empty.
    """
    let_workers_import(spark)
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks.

    A null source is a source; a null text has no words and is not taken; repeated rows share their
    draw; an empty table stays empty.
    """
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with checksums of them and of their decoding.

    A null or empty text has no ids; repeated rows are encoded alike; an empty table gives no rows.
    """
    let_workers_import(spark)
    ranks = bpe.read_ranks(spark)
    return bpe.digest(bpe.encode(docs, ranks, decoded=True), "ids")


STAGES = [
    ("toxicity", clean),
    ("line dedup", without_repeated_lines),
    ("near dedup", one_of_each),
    ("mixing", mixed),
    ("encoding", encoded),
]

# The learned lexicon, alignment, fingerprints and token ids have no SQL; tests hold each
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over ``documents``: each is written and read back before the next.

    Nulls, repeated rows, empty texts and tables as the stages say; stages but the last keep the
    columns of ``documents``, whatever their names.
    """
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
