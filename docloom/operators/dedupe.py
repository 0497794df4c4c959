"""Removal of blocks that repeat over the pages of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T

SHORT, LEAST_CHARS, LEAST_COUNT = 250, 8, 3
MARGIN, MARGIN_CHARS = 72, 120


def canonical(text: Column) -> Column:
    """Lower case, white space collapsed, outer marks off; page numbers as #."""
    plain = F.regexp_replace(T.collapse(F.lower(text)), r"^[ .,\-:;]+|[ .,\-:;]+$", "")
    numbered = plain.rlike(r"(?U)\b(?:page|página|pagina)\s+\d+\s+(?:of|de)\s+\d+\b")
    return F.when(numbered, F.regexp_replace(plain, r"(?U)\d+", "#")).otherwise(plain)


def threshold(pages: Column) -> Column:
    return F.greatest(F.lit(LEAST_COUNT), F.floor(pages / 3).cast("int"))


def remove_repeated_blocks(blocks: DataFrame, ocr_engine: str | None = "ocr_engine") -> DataFrame:
    """Blocks (doc_id, block_no, text, page_end) without short texts that recur on a third of the pages, three times at least.

    Short blocks are counted, blocks of any length go. Documents without a block
    from OCR stay as they are (``ocr_engine`` None: all count as OCR). The number
    removed from a block's document is in ``removed_repeated_ocr_blocks``.
    """
    doc = Window.partitionBy("doc_id")
    marked = blocks.select(
        *blocks.columns,
        canonical(F.col("text")).alias("_canon"),
        F.max(F.coalesce("page_end", F.lit(1))).over(doc).alias("_pages"),
        (F.lit(True) if ocr_engine is None else F.max(F.col(ocr_engine).isNotNull()).over(doc)).alias("_ocr"),
    )
    alike = Window.partitionBy("doc_id", "_canon")
    counted = marked.withColumn("_n", F.count(F.when(F.length("text") <= SHORT, 1)).over(alike))
    gone = F.col("_ocr") & (F.length("_canon") >= LEAST_CHARS) & (F.col("_n") >= threshold(F.col("_pages")))
    judged = counted.withColumn("_gone", gone).withColumn("removed_repeated_ocr_blocks", F.count(F.when(F.col("_gone"), 1)).over(doc))
    return judged.where(~F.col("_gone")).drop("_canon", "_pages", "_ocr", "_n", "_gone")


def remove_margin_blocks(blocks: DataFrame) -> DataFrame:
    """PDF blocks (doc_id, page, block_number, text, y0, y1, page_height) without texts that recur in margins."""
    cleaned = blocks.withColumn("text", T.clean_text(F.col("text"))).withColumn("_pages", F.max("page").over(Window.partitionBy("doc_id"))).where("text <> ''")
    margin = (F.length("text") <= MARGIN_CHARS) & ((F.col("y0") < MARGIN) | (F.col("y1") > F.col("page_height") - MARGIN))
    counted = cleaned.withColumn("_n", F.count(F.when(margin, 1)).over(Window.partitionBy("doc_id", "text")))
    return counted.where(F.col("_n") < threshold(F.col("_pages"))).drop("_n", "_pages")


def distinct_features(features: DataFrame) -> DataFrame:
    """Vector-tile features (doc_id, layer, feature_no, properties map): the first of equal layer and properties, as text rows."""
    entries = F.array_sort(F.map_entries("properties"))
    first = Window.partitionBy("doc_id", "layer", entries).orderBy("feature_no")
    shown = F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    kept = features.where(F.size("properties") > 0).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return kept.withColumn("text", F.array_join(F.concat(F.array(F.concat(F.lit("layer: "), F.col("layer"))), shown), "; "))


def ocr_paragraphs(words: DataFrame, min_confidence: float = 60.0) -> DataFrame:
    """Paragraphs of OCR words (doc_id, block, par, line, word_no, text, conf) that are confident enough.

    Confidences below 0 are no measure; a paragraph without any stays. The mean is
    rounded to two places, half away from zero in decimal.
    """
    cleaned = words.withColumn("text", T.clean_text(F.col("text"))).where("text <> ''")
    ordered = F.array_sort(F.collect_list(F.struct("line", "word_no", "text")))
    conf = F.col("conf").try_cast("double")
    grouped = cleaned.groupBy("doc_id", "block", "par").agg(ordered.alias("w"), F.avg(F.when(conf >= 0, conf)).alias("mean"))
    kept = grouped.where(F.col("mean").isNull() | (F.col("mean") >= min_confidence))
    return kept.select("doc_id", "block", "par", T.clean_text(F.array_join("w.text", " ")).alias("text"), F.round("mean", 2).alias("ocr_confidence"))
