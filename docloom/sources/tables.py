"""JSON lines, GraphML and report files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

_GRAPHML = "http://graphml.graphdrawing.org/xmlns"
_NODE = ("label", "entity_type", "mentions")
_EDGE = ("relation", "evidence_count", "doc_ids", "chunk_ids")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; blank lines are skipped, broken ones are an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lines(spark: SparkSession, path: str, first: int = 0) -> DataFrame:
    """line, value of a file's lines, numbered from ``first``: for checks that need the raw text.

    A file is read in splits. Each split's lines are counted and the counts summed up, a row
    for each split; a line's number is the sum before its split and its place in the split.
    Of a folder, files follow each other by name. Lines end at \\n alone.
    """
    # both scans cut the files alike, as splits are made from the files' sizes only
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", "\n").text(path).select("value", *split, F.monotonically_increasing_id().alias("id"))
    counted = lines.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    ahead = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("file", "start", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) - F.col("least") + first).alias("offset"))
    return lines.join(F.broadcast(offsets), ["file", "start"]).select((F.col("offset") + F.col("id")).alias("line"), "value")


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One JSON object a line, characters as they are, nulls included; a folder of part files."""
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def _escaped(value: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;"), ("\n", "&#10;"), ("\t", "&#9;")):
        value = F.replace(value, F.lit(mark), F.lit(name))
    return value


def _element(rows: DataFrame, target: str, attributes: dict[str, str], names: tuple[str, ...], order: list[str]) -> DataFrame:
    """The rows as lines of XML, in order."""
    head = [F.concat(F.lit(f' {a}="'), _escaped(F.col(c)), F.lit('"')) for a, c in attributes.items()]
    data = [F.concat(F.lit(f'<data key="{target}_{n}">'), _escaped(F.coalesce(F.col(n).cast("string"), F.lit("None"))), F.lit("</data>")) for n in names]
    return rows.orderBy(*order).select(F.concat(F.lit(f"<{target}"), *head, F.lit(">"), *data, F.lit(f"</{target}>")).alias("value"))


def _concatenated(spark: SparkSession, head: str, folders: list[str], tail: str, path: str) -> None:
    """Part files as one file, between a head and a tail: bytes are copied from stream to stream, whatever file system they are in."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(conf).create(at, True)
    try:
        out.write(head.encode())
        for folder in folders:
            place = jvm.org.apache.hadoop.fs.Path(folder)
            system = place.getFileSystem(conf)
            for part in sorted(str(s.getPath()) for s in system.listStatus(place) if s.getPath().getName().startswith("part-")):
                source = system.open(jvm.org.apache.hadoop.fs.Path(part))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
                source.close()
            system.delete(place, True)
        out.write(tail.encode())
    finally:
        out.close()


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> dict:
    """A GraphML file of the graph. Tasks write the elements, in order, to folders beside it; their parts are then put together and the folders go."""
    counted, spark = Observation(), nodes.sparkSession
    counted_edges = Observation()
    folders = [f"{path}.nodes", f"{path}.edges"]
    lines = _element(nodes.observe(counted, F.count("*").alias("n")), "node", {"id": "id"}, _NODE, ["id"])
    lines.write.mode("overwrite").text(folders[0])
    lines = _element(edges.observe(counted_edges, F.count("*").alias("n")), "edge", {"source": "src", "target": "dst"}, _EDGE, ["src", "dst"])
    lines.write.mode("overwrite").text(folders[1])
    keys = [f'<key id="{target}_{n}" for="{target}" attr.name="{n}" attr.type="string" />' for target, names in (("node", _NODE), ("edge", _EDGE)) for n in names]
    head = "\n".join(["<?xml version='1.0' encoding='utf-8'?>", f'<graphml xmlns="{_GRAPHML}">', *keys, '<graph edgedefault="directed">', ""])
    _concatenated(spark, head, folders, "</graph>\n</graphml>\n", path)
    return {"nodes": counted.get["n"], "edges": counted_edges.get["n"], "path": path}


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a GraphML file, whoever wrote it; the ids of an edge's evidence stay one text each."""
    data = "data array<struct<_VALUE: string, _key: string>>"

    def elements(tag: str, schema: str) -> DataFrame:
        return spark.read.format("xml").option("rowTag", tag).option("nullValue", "\0").schema(schema).load(path)

    keys = elements("key", "_id string, `_attr.name` string, _for string").collect()  # a few for a file

    def held(target: str, name: str) -> Column:
        ids = [k["_id"] for k in keys if k["_attr.name"] == name and k["_for"] in (target, "all", None)]
        return F.get(F.filter("data", lambda d: d["_key"].isin(ids)), F.lit(0))["_VALUE"]

    number = lambda target, name, least: F.coalesce(F.nullif(held(target, name), F.lit("")).cast("long"), F.lit(least).cast("long")).alias(name)
    text = lambda target, name: F.coalesce(held(target, name), F.lit("")).alias(name)
    nodes = elements("node", f"_id string, {data}")
    edges = elements("edge", f"_source string, _target string, {data}")
    return (
        nodes.select(F.col("_id").alias("id"), F.coalesce(held("node", "label"), F.col("_id")).alias("label"), held("node", "entity_type").alias("entity_type"), number("node", "mentions", 0)),
        edges.select(F.col("_source").alias("src"), F.col("_target").alias("dst"), held("edge", "relation").alias("relation"), number("edge", "evidence_count", 1), text("edge", "doc_ids"), text("edge", "chunk_ids")),
    )


def write_report(name: str, folder: str, payload: dict, sections: list[tuple[str, list[str]]], title: str) -> None:
    """``name``.json with the payload and ``name``.md with the sections: small reports, written by the driver."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, f"{name}.json").write_text(json.dumps(payload, ensure_ascii=False, indent=2), encoding="utf-8")
    lines = [f"# {title}", ""]
    for heading, body in sections:
        lines += [f"## {heading}", "", *body, ""]
    Path(folder, f"{name}.md").write_text("\n".join(lines), encoding="utf-8")
