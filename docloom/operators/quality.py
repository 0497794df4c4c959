"""Checks of chunk records and of search results. Findings are rows; nothing is raised."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.packing import MAX_TOKENS, MAX_WORDS, TokenCounter

REQUIRED = ("doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto")
OFFICIAL_QUERIES = 50


def _record_errors(x: dict, max_tokens: int, count: TokenCounter | None) -> list[str]:
    """Codes of one record's faults. JSON true counts as the integer 1, as it does in the source format's own checks."""
    out = []
    missing = sorted(set(REQUIRED) - set(x))
    if missing:
        out.append("missing:" + ",".join(missing))
    out += [name for name in ("doc_id", "chunk_id", "fuente", "formato") if not isinstance(x.get(name), str) or not x[name]]
    if not isinstance(x.get("texto"), str) or not x["texto"].strip():
        out.append("texto")
    number = {name: x.get(name) for name in ("fenomeno", "posicion", "num_tokens")}
    if not isinstance(number["fenomeno"], int) or number["fenomeno"] not in (1, 2, 3):
        out.append("fenomeno")
    if not isinstance(number["posicion"], int) or number["posicion"] < 0:
        out.append("posicion")
    if not isinstance(number["num_tokens"], int) or not 0 < number["num_tokens"] <= max_tokens:
        out.append("num_tokens")
    if count is not None and isinstance(x.get("texto"), str) and count(x["texto"]) != x.get("num_tokens"):
        out.append("num_tokens_differ")
    return out


def _check(max_tokens: int, count: TokenCounter | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, errors = [], []
            for line in batch.column("value").to_pylist():
                try:
                    x = json.loads(line)
                    if not isinstance(x, dict):
                        raise ValueError
                    ids.append(json.dumps(x.get("chunk_id"), sort_keys=True))
                    errors.append(_record_errors(x, max_tokens, count))
                except (ValueError, TypeError):
                    ids.append(None)
                    errors.append(["json"])
            yield pa.RecordBatch.from_arrays([batch.column("line"), pa.array(ids, pa.string()), pa.array(errors, pa.list_(pa.string()))], names=["line", "chunk_key", "errors"])

    return run


def validate_metadata(lines: DataFrame, max_tokens: int = MAX_TOKENS, count: TokenCounter | None = None) -> DataFrame:
    """line, error: faults of JSON lines (line long, value string); all but the first of equal chunk ids are duplicates."""
    checked = lines.select(F.col("line").cast("long").alias("line"), "value").mapInArrow(_check(max_tokens, count), "line long, chunk_key string, errors array<string>")
    # broken lines have no key: each is a partition of its own
    again = F.row_number().over(Window.partitionBy(F.coalesce("chunk_key", F.concat(F.lit("#"), F.col("line").cast("string")))).orderBy("line")) > 1
    marked = checked.withColumn("errors", F.when(F.col("chunk_key").isNotNull() & again, F.array_append("errors", F.lit("chunk_id_duplicate"))).otherwise(F.col("errors")))
    return marked.select("line", F.explode("errors").alias("error"))


def validate_chunks(chunks: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """The same on a typed table of chunks, by chunk_id order within equal ids: chunk_ord, error."""
    rules: dict[str, Column] = {name: F.coalesce(F.col(name), F.lit("")) == "" for name in ("doc_id", "chunk_id", "fuente", "formato")}
    rules["texto"] = ~F.coalesce(F.col("texto").rlike(r"(?U)\S"), F.lit(False))
    rules["fenomeno"] = ~F.coalesce(F.col("fenomeno").isin(1, 2, 3), F.lit(False))
    rules["posicion"] = ~F.coalesce(F.col("posicion") >= 0, F.lit(False))
    rules["num_tokens"] = ~F.coalesce((F.col("num_tokens") > 0) & (F.col("num_tokens") <= max_tokens), F.lit(False))
    rules["chunk_id_duplicate"] = F.row_number().over(Window.partitionBy("chunk_id").orderBy("chunk_ord")) > 1
    codes = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())))
    return chunks.select("chunk_ord", codes.alias("codes")).select("chunk_ord", F.explode("codes").alias("error"))


def validate_results(rows: DataFrame, official: bool = True, chunks: DataFrame | None = None) -> DataFrame:
    """line, error for results (line from 1, query_id, documents, fragments); with ``chunks`` ids are looked up there.

    A wrong number of lines is reported for line 0.
    """
    docs, frags = F.coalesce("documents", F.array()), F.coalesce("fragments", F.array())

    def ranks(column: str, size: int) -> Column:
        return F.coalesce(F.transform(F.col(column), lambda x: x["rank"].cast("int")) == F.array(*map(F.lit, range(1, size + 1))), F.lit(False))

    rules = {
        "sizes": (F.size(docs) != 3) | (F.size(frags) != 10),
        "document_ranks": ~ranks("documents", 3),
        "fragment_ranks": ~ranks("fragments", 10),
        "documents_repeat": F.size(F.array_distinct(F.transform(docs, lambda x: x["doc_id"]))) != F.size(docs),
        "fragment_too_long": F.exists(frags, lambda x: T.word_count(F.coalesce(x["text"], F.lit(""))) > MAX_WORDS),
        "fragment_incomplete": F.exists(frags, lambda x: x["rank"].isNull() | x["chunk_id"].isNull() | x["doc_id"].isNull() | x["text"].isNull()),
    }
    if official:
        rules["query_id"] = ~F.col("query_id").eqNullSafe(F.format_string("q%03d", "line"))
    codes = F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items())))
    out = rows.select("line", F.explode(codes).alias("error"))
    if official:
        total = rows.agg(F.count("*").alias("n")).where(F.col("n") != OFFICIAL_QUERIES)
        out = out.unionByName(total.select(F.lit(0).cast(rows.schema["line"].dataType).alias("line"), F.lit("line_count").alias("error")))
    if chunks is not None:
        each = rows.select("line", F.explode("fragments").alias("f")).select("line", F.col("f.chunk_id").alias("chunk_id"), F.col("f.doc_id").alias("doc_id"))
        known = chunks.select("chunk_id", F.col("doc_id").alias("true_doc"))
        ids = chunks.select("doc_id").distinct()
        met = each.join(known, "chunk_id", "left")
        out = (
            out.unionByName(met.where("true_doc IS NULL").select("line", F.lit("unknown_chunk").alias("error")))
            .unionByName(met.where("NOT true_doc <=> doc_id").select("line", F.lit("chunk_of_other_document").alias("error")))
            .unionByName(each.join(ids, "doc_id", "left_anti").select("line", F.lit("unknown_fragment_document").alias("error")))
            .unionByName(rows.select("line", F.explode("documents").alias("d")).select("line", F.col("d.doc_id").alias("doc_id")).join(ids, "doc_id", "left_anti").select("line", F.lit("unknown_document").alias("error")))
        )
    return out
