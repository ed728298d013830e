"""The registered queries of the operators, each over its whole table, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from navlake.llm import (
    bpe, exact, importance, licenses, lines, mixing, personal, sharding, simhash, sketches, toxicity, urls, whitening)
from navlake.llm.common import documents, let_workers_import

Query = Callable[[SparkSession, str], DataFrame]


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_groups(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text")))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_edits(documents(spark, sf_dir))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(documents(spark, sf_dir), labels)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_documents(documents(spark, sf_dir)))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.with_copies(documents(spark, sf_dir))
    return planned.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(spark)
    return bpe.digest(bpe.encode(documents(spark, sf_dir), ranks, decoded=True))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    fitted = whitening.fit_whitening(vectors)
    return whitening.digest(whitening.whiten(vectors, fitted), fitted)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.digest(importance.ranked(documents(spark, sf_dir), target))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find_personal(documents(spark, sf_dir)))


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _registered(f) for f in (
        op1_shard, op2_simhash, op3_exact_dedup, op4_line_dedup, op5_fingerprint, op6_url_filter, op7_toxicity,
        op8_license_scan, op9_mix, op10_bpe, op11_whitening, op12_importance, op13_personal)
}

ORACLES: dict[str, str] = {"op3_exact_dedup": exact.ORACLE, "op9_mix": mixing.ORACLE}
