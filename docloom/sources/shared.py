"""A folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where none is named, one beside the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as they stand, written to the shared folder; what made them is not run again."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def sent(rows: DataFrame, most: int) -> DataFrame:
    """The rows, to be joined where the other side's are if there are ``most`` at most; counting them runs what makes them."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that nothing is at yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
