"""Incremental ingest: new files become blocks once, however often a batch is retried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.functions import text as T
from docloom.operators import inventory
from docloom.operators.cache import BUCKETS, Cache
from docloom.sources import files

CACHE = "variant string, cache_key string, sha256 string, payload_sha256 string, size long, mtime_ns long, payload string"


def watch(spark: SparkSession, root: str) -> DataFrame:
    """A stream of path, content, size, mtime_ns of the files that appear below ``root``."""
    stream = spark.readStream.format("binaryFile").option("recursiveFileLookup", True).schema("path string, modificationTime timestamp, length long, content binary").load(root)
    return stream.select(T.relative_path(F.col("path"), root).alias("path"), "content", F.col("length").alias("size"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def extraction_cache(path: str, buckets: int = BUCKETS) -> Cache:
    return Cache(path, ("variant", "cache_key"), CACHE, buckets)


def extract_into_cache(batch: DataFrame, cache_path: str, variant: str = "default", extractors: dict = files.EXTRACTORS) -> None:
    """Extract the batch's files that the cache lacks and put them; a changed file replaces its entry, and running it again changes nothing."""
    cache = extraction_cache(cache_path)
    new = inventory.extraction_misses(batch, cache.read(batch.sparkSession), variant)
    blocks = files.extract_files(new, extractors).groupBy("path").agg(F.to_json(F.array_sort(F.collect_list(F.struct("block_no", "text", "extra", "error")))).alias("payload"))
    facts = new.select("path", F.sha2("content", 256).alias("content_sha256"), "size", "mtime_ns")
    cache.put(inventory.extraction_entries(facts.join(blocks, "path"), variant), "mtime_ns")


def ingest(spark: SparkSession, root: str, cache_path: str, checkpoint: str, variant: str = "default", extractors: dict = files.EXTRACTORS) -> StreamingQuery:
    """Start the stream over what is there now; ``awaitTermination`` waits for its end."""
    return watch(spark, root).writeStream.foreachBatch(lambda batch, _: extract_into_cache(batch, cache_path, variant, extractors)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
