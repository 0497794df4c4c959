"""Which units of a corpus would reach an index, and why others would not."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.packing import MAX_TOKENS, MAX_WORDS, TARGET_TOKENS, TokenCounter, pack, pack_fold

# The categories, in the order in which the first that applies to a file is taken.
FILE_CATEGORIES = ("fenomeno_faltante", "formato_no_soportado", "imagen_sin_ocr", "error_extraccion")
NO_TEXT = "pagina_o_archivo_sin_texto"
LONG_BUT_FITS = "mas_de_250_palabras_dentro_de_480_tokens"
IMAGES = (".jpg", ".jpeg", ".png", ".avif")
EXAMPLES, PREVIEW = 10, 420


def own_category() -> Column:
    """The category of a file (path, failed boolean) that gives no blocks; null for others."""
    suffix = T.extension(F.col("path"))
    return (
        F.when(T.phenomenon(F.col("path")).isNull(), F.lit(FILE_CATEGORIES[0]))
        .when(~suffix.isin(*T.SUPPORTED), F.lit(FILE_CATEGORIES[1]))
        .when(suffix.isin(*IMAGES), F.lit(FILE_CATEGORIES[2]))
        .when(F.coalesce("failed", F.lit(False)), F.lit(FILE_CATEGORIES[3]))
    )


def file_category(files: DataFrame) -> DataFrame:
    """path, category of files (path, failed boolean) that give no blocks."""
    return files.select("path", own_category().alias("category")).where("category IS NOT NULL")


def _counted(unit: Column, count: TokenCounter | None) -> Column:
    """Tokens of a unit: words, or what a tokenizer counts."""
    if count is None:
        return T.word_count(unit)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else count(t) for t in texts.to_pylist()], pa.int32())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # read by arrow_udf
    return F.arrow_udf(run, "int")(unit)


def units(blocks: DataFrame, max_tokens: int = MAX_TOKENS, count: TokenCounter | None = None, parts: Callable[[Column], Column] = T.sentences) -> DataFrame:
    """doc_id, block_no, unit_no, unit, tokens, words, category, omitted of blocks (doc_id, block_no, text, extension), next to their other columns.

    A block without units is one row without unit. The category of a long unit that
    still fits is counted but omits nothing. ``parts`` tells a long unit of one sentence from
    others: with the default, the original's, a list item is one whatever it holds.
    """
    carried = [c for c in blocks.columns if c != "text"]
    each = blocks.select(*carried, F.posexplode_outer(T.sentences(F.col("text"))).alias("unit_no", "unit"))
    counted = each.withColumn("words", F.when(F.col("unit").isNotNull(), T.word_count(F.col("unit"))))
    counted = counted.withColumn("tokens", F.col("words") if count is None else _counted(F.col("unit"), count))
    category = (
        F.when(F.col("unit").isNull(), F.lit(NO_TEXT))
        .when(F.col("tokens") > max_tokens, T.long_unit_category(F.col("unit"), F.col("extension"), parts))
        .when(F.col("words") > MAX_WORDS, F.lit(LONG_BUT_FITS))
    )
    return counted.withColumn("category", category).withColumn("omitted", F.col("unit").isNull() | (F.col("tokens") > max_tokens))


def document_states(blocks: DataFrame, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS, count: TokenCounter | None = None, k: int = EXAMPLES, parts: Callable[[Column], Column] = T.sentences) -> DataFrame:
    """doc_id, fuente, valid_units, omitted_units, chunks, categories, long_units, examples: all that a report says of a document.

    ``blocks`` has doc_id, fuente, block_no, text, extension, page_start and page_end.
    ``categories`` counts omitted units by category, ``long_units`` those that are long but
    fit; ``examples`` has the first k units of each category. One pass over the blocks makes
    them, and every figure of a report is a sum over these rows.
    """
    sentences = T.sentences(F.col("text"))
    packed = F.size(pack_fold(sentences, target_tokens, max_tokens) if count is None else pack(sentences, count, target_tokens, max_tokens, on_oversize="drop"))
    found = units(blocks.withColumn("chunks", packed), max_tokens, count, parts)
    # a block's chunks stand at its first unit alone
    found = found.withColumn("chunks", F.when(F.coalesce("unit_no", F.lit(0)) == 0, F.col("chunks")).otherwise(0))
    place = Window.partitionBy("doc_id", "category").orderBy("block_no", "unit_no")
    shown = F.struct(
        "category", "block_no", F.coalesce("unit_no", F.lit(0)).alias("unit_no"), F.col("page_start").alias("pagina_inicio"), F.col("page_end").alias("pagina_fin"),
        F.coalesce("words", F.lit(0)).alias("palabras"), F.coalesce("tokens", F.lit(0)).alias("tokens"), T.preview(F.coalesce("unit", F.lit("")), PREVIEW).alias("vista_previa"),
    )
    marked = found.withColumn("example", F.when(F.col("category").isNotNull() & (F.row_number().over(place) <= k), shown))
    # by category first, so that no array is longer than there are categories
    each = marked.groupBy("doc_id", "fuente", "category").agg(
        F.count(F.when(~F.col("omitted"), 1)).alias("valid"), F.count(F.when(F.col("omitted"), 1)).alias("omitted"), F.count("*").alias("n"), F.sum("chunks").alias("chunks"), F.collect_list("example").alias("examples")
    )
    omits = F.col("category").isNotNull() & (F.col("category") != LONG_BUT_FITS)
    return each.groupBy("doc_id", "fuente").agg(
        F.sum("valid").alias("valid_units"),
        F.sum("omitted").alias("omitted_units"),
        F.sum("chunks").alias("chunks"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(omits, F.struct("category", "n"))))).alias("categories"),
        F.coalesce(F.sum(F.when(F.col("category") == LONG_BUT_FITS, F.col("n"))), F.lit(0)).alias("long_units"),
        F.array_sort(F.flatten(F.collect_list("examples"))).alias("examples"),
    )


def excluded_states(excluded: DataFrame) -> DataFrame:
    """The same rows for files (doc_id, path, category, error) that give no blocks; one without text has no category."""
    example = F.struct(
        F.col("category"), F.lit(0).alias("block_no"), F.lit(0).alias("unit_no"), F.lit(None).cast("int").alias("pagina_inicio"), F.lit(None).cast("int").alias("pagina_fin"),
        F.lit(0).alias("palabras"), F.lit(0).alias("tokens"), T.preview(F.coalesce("error", F.lit("")), PREVIEW).alias("vista_previa"),
    )
    none = [F.lit(0).cast("long").alias(c) for c in ("valid_units", "omitted_units", "chunks")]
    one = lambda made: F.filter(F.array(made), lambda _: F.col("category").isNotNull())
    categories = F.map_from_entries(one(F.struct("category", F.lit(1).cast("long").alias("n"))))
    return excluded.select("doc_id", F.col("path").alias("fuente"), *none, categories.alias("categories"), F.lit(0).cast("long").alias("long_units"), one(example).alias("examples"))


def projected(states: DataFrame) -> DataFrame:
    """One row: documents with chunks, without, partly covered, and chunks."""
    has, partly = F.col("valid_units") > 0, (F.col("valid_units") > 0) & (F.col("omitted_units") > 0)
    return states.agg(
        F.count(F.when(has, 1)).alias("documents_with_chunks"), F.count(F.when(~has, 1)).alias("documents_without_chunks"), F.count(F.when(partly, 1)).alias("partially_covered_documents"), F.coalesce(F.sum("chunks"), F.lit(0)).alias("estimated_chunks")
    )


def state_categories(states: DataFrame) -> DataFrame:
    """category, n over all documents."""
    every = F.map_entries("categories").cast("array<struct<category:string,n:bigint>>")
    long = F.array(F.struct(F.lit(LONG_BUT_FITS).alias("category"), F.col("long_units").alias("n")))
    return states.select(F.inline(F.concat(every, long))).where("n > 0").groupBy("category").agg(F.sum("n").alias("n"))


def state_examples(states: DataFrame, k: int = EXAMPLES) -> DataFrame:
    """The first k examples of each category, by file and place."""
    each = states.select("fuente", F.inline("examples"))
    place = Window.partitionBy("category").orderBy("fuente", "block_no", "unit_no")
    return each.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k).drop("block_no", "unit_no")


def categories(found: DataFrame) -> DataFrame:
    return found.where("category IS NOT NULL").groupBy("category").agg(F.count("*").alias("n"))


def documents(found: DataFrame) -> DataFrame:
    """doc_id, valid_units, omitted_units."""
    return found.groupBy("doc_id").agg(F.count(F.when(~F.col("omitted"), 1)).alias("valid_units"), F.count(F.when(F.col("omitted"), 1)).alias("omitted_units"))


def estimated_chunks(blocks: DataFrame, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, chunks: packed within each block, units above the limit left out."""
    packed = F.size(pack_fold(T.sentences(F.col("text")), target_tokens, max_tokens))
    return blocks.groupBy("doc_id").agg(F.sum(packed).alias("chunks"))


def summary(blocks: DataFrame, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row: documents with chunks, without, partly covered, and chunks."""
    state = documents(units(blocks, max_tokens))
    chunks = estimated_chunks(blocks, target_tokens, max_tokens).agg(F.coalesce(F.sum("chunks"), F.lit(0)).alias("estimated_chunks"))
    counts = state.agg(
        F.count(F.when(F.col("valid_units") > 0, 1)).alias("documents_with_chunks"),
        F.count(F.when(F.col("valid_units") == 0, 1)).alias("documents_without_chunks"),
        F.count(F.when((F.col("valid_units") > 0) & (F.col("omitted_units") > 0), 1)).alias("partially_covered_documents"),
    )
    return counts.crossJoin(chunks)  # one row each


def examples(found: DataFrame, k: int = EXAMPLES) -> DataFrame:
    """The first k units of each category, with a preview."""
    order = Window.partitionBy("category").orderBy("doc_id", "block_no", "unit_no")
    first = found.where("category IS NOT NULL").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    return first.select("category", "n", "doc_id", "tokens", T.preview(F.coalesce("unit", F.lit("")), PREVIEW).alias("preview"))


def index_coverage(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count("*").alias("chunks"), F.countDistinct("doc_id").alias("documents_with_chunks"))
