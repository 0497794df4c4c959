"""Caches as tables of keyed rows, with an idempotent put.

A cache is a Parquet folder whose partitions are buckets of keys. A put replaces the
buckets that its keys fall into, and no others, by dynamic partition overwrite: what a
bucket held and the new rows are merged, of several rows of a key the last written
stays, and the bucket becomes one file again, so that puts leave nothing to compact.

Putting the same rows again changes nothing. A bucket is replaced as a whole when the job
commits; a put that fails half-way is mended by repeating it. Of two puts at a time to one
bucket the later commit wins, so one writer should put at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.sources.shared import checkpointed

#: Partitions of a new cache; an old one keeps its own number, which is in the name of the partition column.
BUCKETS = 64
_PREFIX = "bucket_of_"


@dataclass(frozen=True)
class Cache:
    """A cache at a path: the columns that make its key, and its schema."""

    path: str
    key: tuple[str, ...]
    schema: str
    buckets: int = BUCKETS

    def _stored(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None  # nothing was put yet
            raise

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; of a cache without any, an empty frame."""
        held = self._stored(spark)
        names = [f.split()[0] for f in self.schema.split(", ")]
        return spark.createDataFrame([], self.schema) if held is None else held.select(*names)

    def put(self, rows: DataFrame, order: Column | str | None = None) -> None:
        """Insert rows or replace those of the same key; of new rows that share a key the last by ``order`` stays, any if all are equal."""
        spark = rows.sparkSession
        held = self._stored(spark)
        column = next((c for c in held.columns if c.startswith(_PREFIX)), None) if held is not None else None
        column = column or f"{_PREFIX}{self.buckets}"
        names = [f.split()[0] for f in self.schema.split(", ")]
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(int(column.removeprefix(_PREFIX)))).cast("int").alias(column)
        new = latest(rows.select(*names, (F.lit(0) if order is None else F.col(order) if isinstance(order, str) else order).alias("_order")), self.key).select(*names, bucket)
        if held is not None:
            new = checkpointed(new)  # rows may be dear to make, and are read three times
            # buckets are told apart before anything is read of them
            touched = held.join(F.broadcast(new.select(column).distinct()), column, "left_semi")
            new = touched.join(new.select(*self.key), list(self.key), "left_anti").select(*names, column).unionByName(new)
        dealt = new.repartition(column)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(self.path)


def latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row for each key, the last by ``_order``."""
    place = Window.partitionBy(*key).orderBy(F.desc("_order"))
    return rows.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")
