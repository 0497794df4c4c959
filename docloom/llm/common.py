"""Reading, row keys and checkpoints shared by the training-data operators."""

from __future__ import annotations

import tempfile

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands in for a null doc_id inside the operators: it sorts after every other id.
NULL_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; one of our own only where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="docloom-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder named by the session."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def apart(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt by something else than ``columns``, before it is joined on them.

    A frame aggregated by the columns of a join is joined where it was aggregated, in one
    task a key. Dealt apart first, the planner deals both sides of the join itself and can
    split the rows of a hot key over several tasks.
    """
    return df.repartition(F.xxhash64(*columns))


def ids_repeat(docs: DataFrame) -> bool:
    """Whether some doc_id (or null) is on several rows; reads the id column alone."""
    return docs.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0


def keyed(docs: DataFrame, repeats: bool = True, *more: Column) -> DataFrame:
    """(did, tkey, text, more columns): a non-null id and a number that together name a row's content.

    Rows that repeat both id and text share a key and get equal results; rows that
    share only the id stay apart, by a hash of their text. Where no id repeats
    (``repeats`` false) that number is 0, which costs nothing in a shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    # a literal would be folded into each use of the frame, and a nullable expression be
    # filtered in some; the uses would then no longer share one shuffle
    tkey = F.xxhash64(text) if repeats else did.bitwiseAND(F.lit(0).cast("long"))
    return docs.select(did.alias("did"), tkey.alias("tkey"), text.alias("text"), *more)


def one_of_each(rows: DataFrame, repeats: bool = True) -> DataFrame:
    """One of the rows that repeat did and tkey, dealt by both; such rows are equal.

    Tasks reduce their own rows before the shuffle, so that a row that repeats a million
    times is one row a task there, and one in all that follows.
    """
    return rows.dropDuplicates(["did", "tkey"]) if repeats else rows.repartition("did", "tkey")


def row_key(docs: DataFrame) -> tuple[Column, Column]:
    """did and tkey of the rows of ``docs``, as ``keyed`` makes them where ids repeat."""
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)), F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def public_id(column: str = "did") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column)).alias("doc_id")


def texts_of(batch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column of an Arrow batch."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def _pack(batches):
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = pa.array([press.compress(x) for x in texts_of(batch)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("tkey"), packed], names=["did", "tkey", "packed"])


def packed(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """``keyed`` with the text compressed, for texts that are shuffled: about half the bytes of Spark's own compression."""
    out = keyed(docs, repeats).mapInArrow(_pack, "did long, tkey long, packed binary")
    # never null, or an inner join's check for nulls would part its use from the others, which share one shuffle
    return out.select(F.coalesce("did", F.lit(NULL_ID)).alias("did"), F.coalesce("tkey", F.lit(0).cast("long")).alias("tkey"), "packed")


def unpacked(batch) -> list[bytes]:
    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(x) for x in batch.column("packed").to_pylist()]
