"""A corpus in five stages: toxicity, line dedup, near-duplicate removal, benchmark decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
documents for the documents they keep. ``run`` writes each stage's result as Parquet
into the shared checkpoint folder and reads it back for the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import shared_folder, table
from docloom.llm.decontamination import decontaminate
from docloom.llm.line_dedup import line_dedup
from docloom.llm.ngram_join import keep_one_of_each
from docloom.llm.piece_sampling import encode
from docloom.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go; labels of any document may train it."""
    labelled = table(spark, sf_dir, "labels")
    scored = toxicity(docs, labelled, carry=("text", "lang", "source", "n_chars"))
    return scored.where(~F.col("toxic")).select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document stays even if all its lines do, with an empty text."""
    done = line_dedup(docs, carry=("lang", "source"))
    return done.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a Jaccard similarity of 0.8 over five-word shingles, the smallest doc_id stays."""
    return keep_one_of_each(docs, n=5, percent=80).select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each remaining document."""
    return encode(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece encoding", pieces),
]

#: Not expressible in SQL: a trained classifier, a banded alignment and merge-dropout.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
