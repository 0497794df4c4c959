"""Inventory of a corpus of files, its summary, and caches keyed by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T

# What an inventory says about a file.
NOTE_FORMAT = "Formato no soportado por baseline"
NOTE_PHENOMENON = "Archivo de control sin fenomeno: excluido del indice para cumplir metadata obligatoria"
NOTE_EMPTY = "Archivo vacio"
NO_EXTENSION = "[sin_extension]"


def inventory(files: DataFrame) -> DataFrame:
    """One row a file of (path relative to the corpus, size)."""
    suffix = T.extension(F.col("path"))
    shown = F.when(suffix == "", F.lit(NO_EXTENSION)).otherwise(suffix)
    topic, supported = T.phenomenon(F.col("path")), suffix.isin(*T.SUPPORTED)
    usable: Column = topic.isNotNull() & supported & (F.col("size") > 0)
    notes = F.concat_ws("; ", F.when(~supported, F.lit(NOTE_FORMAT)), F.when(topic.isNull(), F.lit(NOTE_PHENOMENON)), F.when(F.col("size") == 0, F.lit(NOTE_EMPTY)))
    return files.where(~F.col("path").rlike(r"(^|/)\.DS_Store$")).select(
        F.col("path").alias("ruta_relativa"),
        shown.alias("extension"),
        F.ltrim(shown, F.lit(".")).alias("formato"),
        F.col("size").cast("long").alias("tamano_bytes"),
        topic.alias("fenomeno"),
        usable.alias("indexable"),
        F.when(usable, F.lit("pendiente")).otherwise(F.lit("excluido")).alias("estado_extraccion"),
        notes.alias("observaciones"),
        T.stable_doc_id(F.col("path")).alias("doc_id"),
    )


def count_by_format(rows: DataFrame) -> DataFrame:
    return rows.groupBy("extension").agg(F.count("*").alias("n"))


def count_by_phenomenon(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce(F.col("fenomeno").cast("string"), F.lit("pendiente")).alias("fenomeno")).agg(F.count("*").alias("n"))


def extraction_misses(files: DataFrame, cache: DataFrame | None, variant: str = "default") -> DataFrame:
    """Files (path, size, mtime_ns) without an entry of this variant, size and time in the cache (variant, cache_key, size, mtime_ns, ...)."""
    if cache is None:
        return files
    held = cache.where(F.col("variant") == variant).select(F.col("cache_key").alias("path"), "size", "mtime_ns")
    return files.join(held, ["path", "size", "mtime_ns"], "left_anti")


def extraction_hits(files: DataFrame, cache: DataFrame, variant: str = "default") -> DataFrame:
    held = cache.where(F.col("variant") == variant).withColumnRenamed("cache_key", "path")
    return files.select("path", "size", "mtime_ns").join(held, ["path", "size", "mtime_ns"]).select("path", "payload")


def extraction_entries(extracted: DataFrame, variant: str = "default") -> DataFrame:
    """Cache rows of (path, content_sha256, size, mtime_ns, payload)."""
    return extracted.select(
        F.lit(variant).alias("variant"),
        F.col("path").alias("cache_key"),
        F.col("content_sha256").alias("sha256"),
        F.sha2(F.concat(F.col("content_sha256"), F.lit(f"\0{variant}")), 256).alias("payload_sha256"),
        "size",
        "mtime_ns",
        "payload",
    )
