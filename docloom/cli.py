"""Command lines: audit, dry-run, build, graph and search."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from docloom.operators import encoding, graph, search
from docloom.plans import corpus
from docloom.sources import tables

QUERY_SCHEMA = "query_id string, query string, text string, consulta string"


def encoder(c: argparse.ArgumentParser, batch_size: int) -> None:
    c.add_argument("--model", help="the built-in model, or module:attribute")
    c.add_argument("--device", choices=("auto", "cuda", "cpu"), default="auto")
    c.add_argument("--batch-size", type=int, default=batch_size)
    c.add_argument("--no-fp16", action="store_true")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docloom")
    commands = p.add_subparsers(dest="command", required=True)
    c = commands.add_parser("audit", help="inventory of a corpus")
    c.add_argument("--corpus-root", required=True)
    c.add_argument("--report-dir", default="reports")
    c.add_argument("--manifest", default="data/processed/documents_manifest.jsonl")
    c = commands.add_parser("dry-run", help="coverage an index would have")
    c.add_argument("--corpus-root", required=True)
    c.add_argument("--report-dir", default="reports")
    c.add_argument("--target-tokens", type=int, default=360)
    c.add_argument("--max-tokens", type=int, default=480)
    c.add_argument("--index-dir", help="an index to compare with")
    c.add_argument("--tokenizer", help="module:attribute of a function that counts a text's tokens; words otherwise")
    c = commands.add_parser("build", help="corpus to index")
    c.add_argument("--corpus-root", required=True)
    c.add_argument("--index-dir", required=True)
    c.add_argument("--graph")
    c.add_argument("--min-mentions", type=int, default=1)
    c.add_argument("--cache", help="folder of the embedding cache")
    encoder(c, 32)
    c = commands.add_parser("graph", help="graph of an index")
    c.add_argument("--index-dir", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--min-mentions", type=int, default=1)
    c = commands.add_parser("search", help="answer queries")
    c.add_argument("--queries", required=True)
    c.add_argument("--index-dir", required=True)
    c.add_argument("--output", default="resultados.jsonl")
    c.add_argument("--aggregation", choices=search.AGGREGATIONS, default="max")
    encoder(c, 16)
    c.add_argument("--candidates", type=int, default=1000)
    group = c.add_mutually_exclusive_group()
    group.add_argument("--graph")
    group.add_argument("--no-graph", action="store_true")
    c.add_argument("--graph-weight", type=float, default=search.GRAPH_WEIGHT)
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None, model: encoding.EmbeddingModel | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("docloom").getOrCreate()
    if a.command in ("build", "search"):
        encoding.select_device(a.device, encoding.gpus_of(spark) > 0)
        model = model or encoding.named_model(a.model, a.device, not a.no_fp16)
    if a.command == "audit":
        corpus.audit(spark, a.corpus_root, a.report_dir, a.manifest)
    elif a.command == "dry-run":
        index = spark.read.parquet(f"{a.index_dir}/chunks") if a.index_dir else None
        count = encoding.named(a.tokenizer) if a.tokenizer else None
        corpus.dry_run(spark, a.corpus_root, a.report_dir, a.target_tokens, a.max_tokens, index, count=count)
    elif a.command == "build":
        corpus.build(spark, a.corpus_root, a.index_dir, model, a.graph, a.min_mentions, batch_size=a.batch_size, cache=encoding.embedding_cache(a.cache) if a.cache else None)
    elif a.command == "graph":
        tables.write_graphml(*graph.build_graph(spark.read.parquet(f"{a.index_dir}/chunks"), a.min_mentions), a.output)
    else:
        beside = Path(a.index_dir).parent / "grafo" / "grafo.graphml"
        path = a.graph or (str(beside) if beside.exists() and not a.no_graph else None)
        queries = tables.read_jsonl(spark, a.queries, QUERY_SCHEMA)
        found = corpus.retrieve(spark, queries, a.index_dir, model, path, a.aggregation, a.candidates, a.graph_weight, batch_size=a.batch_size)
        tables.write_jsonl(found.orderBy("query_id"), a.output)
        held = spark.read.schema(found.schema).json(a.output)
        faults = corpus.checked_results(held, encoding.open_index(spark, a.index_dir, model), queries.count() == 50).orderBy("line", "error").collect()
        if faults:
            raise ValueError("; ".join(f"{f['line']}: {f['error']}" for f in faults))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
