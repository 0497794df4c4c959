"""Whole jobs: audit of a corpus, coverage dry run, ingest to an index, graph, and batch retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import entities as E
from docloom.functions import text as T
from docloom.operators import coverage, dedupe, encoding, graph, inventory, packing, quality, search
from docloom.operators.cache import Cache
from docloom.sources import files, tables


def audit(spark: SparkSession, root: str, report_folder: str, manifest: str) -> dict:
    """Inventory of all files below ``root``: JSON and Markdown reports, and the rows as JSON lines."""
    rows = inventory.inventory(files.scan(spark, root)).orderBy("ruta_relativa")
    tables.write_jsonl(rows, manifest)
    by_format = {r["extension"]: r["n"] for r in inventory.count_by_format(rows).orderBy("extension").collect()}
    by_topic = {r["fenomeno"]: r["n"] for r in inventory.count_by_phenomenon(rows).orderBy("fenomeno").collect()}
    empty = [r[0] for r in rows.where("tamano_bytes = 0").select("ruta_relativa").collect()]
    payload = {"corpus_root": root, "total_documentos": sum(by_format.values()), "por_formato": by_format, "por_fenomeno": by_topic, "archivos_vacios": empty, "archivos": [r.asDict() for r in rows.toLocalIterator()]}
    shown = lambda head, counts: [f"| {head} | Cantidad |", "|---|---:|", *(f"| {k} | {v} |" for k, v in sorted(counts.items()))]
    sections = [("Por formato", shown("Formato", by_format)), ("Por fenomeno", shown("Fenomeno", by_topic))]
    if empty:
        sections.append(("Archivos vacios", [f"- `{x}`" for x in empty]))
    tables.write_report("corpus_inventory", report_folder, payload, sections, "Inventario del corpus")
    return payload


def coverage_states(spark: SparkSession, root: str, target_tokens: int = packing.TARGET_TOKENS, max_tokens: int = packing.MAX_TOKENS, count: packing.TokenCounter | None = None, extractors: dict = files.EXTRACTORS) -> DataFrame:
    """A row for each file below ``root``: what an index would have of it, and why not more (see ``coverage.document_states``)."""
    found = files.read_blocks(spark, root, extractors)
    # a file's own category is told from its name, and from the error that its only row has
    named = found.withColumn("failed", F.col("error").isNotNull())
    own = coverage.own_category()
    excluded = named.where(own.isNotNull() | F.col("text").isNull()).select("doc_id", "path", own.alias("category"), "error").dropDuplicates(["path"])
    page = lambda name: F.get_json_object("extra", f"$.{name}").cast("int").alias(name)
    rest = named.where(own.isNull() & F.col("text").isNotNull()).select("doc_id", F.col("path").alias("fuente"), "block_no", "text", T.extension(F.col("path")).alias("extension"), page("page_start"), page("page_end"))
    return coverage.document_states(rest, target_tokens, max_tokens, count).unionByName(coverage.excluded_states(excluded))


def dry_run(
    spark: SparkSession, root: str, report_folder: str, target_tokens: int = packing.TARGET_TOKENS, max_tokens: int = packing.MAX_TOKENS, index: DataFrame | None = None, extractors: dict = files.EXTRACTORS, count: packing.TokenCounter | None = None
) -> dict:
    """Coverage an index of the corpus would have, without making one.

    Each file's state is written once, to ``document_states`` in the report's folder, and
    all else is read from there. The lists of documents without chunks and of partly
    covered ones grow with the corpus: they are JSON lines beside the report.
    """
    folder = f"{report_folder}/document_states"
    coverage_states(spark, root, target_tokens, max_tokens, count, extractors).write.mode("overwrite").parquet(folder)
    states = spark.read.parquet(folder)
    state = coverage.projected(states).first().asDict()
    total = state["documents_with_chunks"] + state["documents_without_chunks"]
    shown = states.drop("examples").orderBy("fuente")
    lists = {"documents_without_chunks": "valid_units = 0", "partially_covered_documents": "valid_units > 0 and omitted_units > 0"}
    for name, which in lists.items():
        tables.write_jsonl(shown.where(which), f"{report_folder}/{name}")
    current = {"available": False} if index is None else {"available": True} | coverage.index_coverage(index).first().asDict()
    categories = {r["category"]: r["n"] for r in coverage.state_categories(states).orderBy("category").collect()}
    samples = {c: [] for c in categories}
    for r in coverage.state_examples(states).orderBy("category", "n").collect():  # ten a category at most
        samples[r["category"]].append({c: v for c, v in r.asDict().items() if c not in ("category", "n")})
    payload = {"summary": {"files_scanned": total, "current_index": current, "projected": state, "categories": categories}, "examples": samples, "lists": {name: f"{report_folder}/{name}" for name in lists}}
    line = lambda x: f"- `{x['fuente']}` | páginas {x['pagina_inicio']}-{x['pagina_fin']} | {x['palabras']} palabras | {x['tokens']} tokens | {x['vista_previa']}"
    sections = [("Cobertura", [f"- Índice actual: {current}", *(f"- {k}: {v}" for k, v in state.items())]), ("Categorías", [f"- {k}: {v}" for k, v in categories.items()])]
    sections += [(f"Ejemplos: {c}", list(map(line, each))) for c, each in samples.items()]
    tables.write_report("coverage_dry_run", report_folder, payload, sections, "Auditoría de cobertura sin embeddings")
    return payload


def _clean(blocks: DataFrame) -> DataFrame:
    return dedupe.remove_repeated_blocks(blocks.withColumn("ocr_engine", F.get_json_object("extra", "$.ocr_engine")))


def oversize_records(blocks: DataFrame, max_tokens: int = packing.MAX_TOKENS, max_words: int | None = None) -> DataFrame:
    """doc_id, fuente, fenomeno, block_no, place, unit, tokens of the units that ``chunk_records`` has in no chunk."""
    left = packing.left_out(T.sentences(F.col("text")), packing.count_words, max_tokens, max_words)
    each = _clean(blocks).select("doc_id", F.col("path").alias("fuente"), T.phenomenon(F.col("path")).alias("fenomeno"), "block_no", F.explode(left).alias("u"))
    return each.select("doc_id", "fuente", "fenomeno", "block_no", "u.place", "u.unit", "u.tokens")


def chunk_records(blocks: DataFrame, target_tokens: int = packing.TARGET_TOKENS, max_tokens: int = packing.MAX_TOKENS, max_words: int | None = None, on_oversize: str = "skip") -> DataFrame:
    """Chunk records of blocks (doc_id, path, block_no, text), packed within each block; their order, by document and place, is that of their ids."""
    packed = _clean(blocks).select("doc_id", "path", "block_no", F.posexplode(packing.pack(T.sentences(F.col("text")), packing.count_words, target_tokens, max_tokens, max_words, on_oversize)).alias("k", "c"))
    place = (F.row_number().over(Window.partitionBy("doc_id").orderBy("block_no", "k")) - 1).alias("posicion")
    rows = packed.select("doc_id", "path", F.col("c.tokens").alias("num_tokens"), F.col("c.text").alias("texto"), place)
    chunk_id = F.concat("doc_id", F.lit("-"), F.lpad(F.col("posicion").cast("string"), 5, "0"))
    return rows.select(
        "doc_id",
        chunk_id.alias("chunk_id"),
        F.col("path").alias("fuente"),
        F.ltrim(T.extension(F.col("path")), F.lit(".")).alias("formato"),
        T.phenomenon(F.col("path")).alias("fenomeno"),
        "posicion",
        "num_tokens",
        "texto",
        chunk_id.alias("chunk_ord"),
    )


def build(spark: SparkSession, root: str, index_path: str, model: encoding.EmbeddingModel, graph_path: str | None = None, min_mentions: int = 1, extractors: dict = files.EXTRACTORS, batch_size: int = 32, cache: Cache | None = None) -> dict:
    """Corpus to index, and to a graph where a path for it is given; units too long for a chunk are written to ``oversize`` beside the chunks."""
    blocks = files.read_blocks(spark, root, extractors).where("text IS NOT NULL")
    chunks = chunk_records(blocks).where("fenomeno IS NOT NULL")
    out = encoding.build_index(chunks, index_path, model, batch_size, cache)
    oversize_records(blocks).where("fenomeno IS NOT NULL").write.mode("overwrite").parquet(f"{index_path}/oversize")
    out["oversize_units"] = spark.read.parquet(f"{index_path}/oversize").count()
    if graph_path:
        nodes, edges = graph.build_graph(spark.read.parquet(f"{index_path}/chunks"), min_mentions)
        out["graph"] = tables.write_graphml(nodes, edges, graph_path)
    return out


def retrieve(spark: SparkSession, queries: DataFrame, index_path: str, model: encoding.EmbeddingModel, graph_path: str | None = None, aggregation: str = "max", candidates: int = 1000, weight: float = search.GRAPH_WEIGHT, lexicon: E.Lexicon = E.DEFAULT, strict: bool = True, batch_size: int = 16) -> DataFrame:
    """Results of queries (query_id and query, text or consulta) against an index, with the graph where one is given."""
    index = encoding.open_index(spark, index_path, model)
    asked = search.query_text(queries)
    embedded = encoding.embed(asked, model, "query", text="query", batch_size=batch_size)
    scores = None
    if graph_path:
        tagged = E.with_entities(asked, "query", lexicon)
        labels = tagged.select("query_id", F.explode("entities.label").alias("label"))
        edges = tables.read_graphml(spark, graph_path)[1]
        scores = graph.chunk_scores(labels, graph.edge_ends(edges.select("src", "dst")), graph.listed_evidence(edges))
    documents, hits = search.search(index, embedded, candidates, candidates, aggregation, scores, weight)
    return search.results(documents, search.fragments(hits), strict)


def checked_results(results: DataFrame, index: DataFrame, official: bool) -> DataFrame:
    """line, error of results ordered by query_id; none for results of ``retrieve``."""
    numbered = results.withColumn("line", F.row_number().over(Window.orderBy("query_id")))
    return quality.validate_results(numbered, official, index)
