"""The opN_ queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import collocations, fill_in_middle, oracles, token_counts
from docloom.llm.common import table
from docloom.llm.decontamination import leaks
from docloom.llm.line_dedup import line_dedup
from docloom.llm.mih_search import nearest
from docloom.llm.ngram_join import ngram_jaccard_components
from docloom.llm.piece_sampling import encode
from docloom.llm.pii import find_pii
from docloom.llm.sharding import ORACLE as SHARD_ORACLE
from docloom.llm.sharding import shard
from docloom.llm.substring_dedup import substring_dedup
from docloom.llm.suffix_dedup import suffix_dedup
from docloom.llm.toxicity import toxicity


def op1_mih_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op10_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mih_search, op2_pii, op3_ngram_jaccard_join, op4_substring_dedup, op5_sharding, op6_toxicity, op7_line_dedup, op8_decontamination, op9_suffix_dedup, op10_piece_sampling, op11_collocations, op12_token_counts, op13_fill_in_middle, pipeline)}

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": oracles.NGRAM_JOIN,
    "op4_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op5_sharding": SHARD_ORACLE,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op11_collocations": collocations.ORACLE,
    "op13_fill_in_middle": fill_in_middle.ORACLE,
}
