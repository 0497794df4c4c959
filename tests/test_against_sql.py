"""Queries over small tables of our own, against their SQL."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__


def differences(spark, folder, name, **given):
    """Rows of a query that its SQL lacks, and the other way round, over tables (rows, schema)."""
    database = duckdb.connect()
    for table, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    frame = __spark_entry__.queries()[name](spark, str(folder))
    got = Counter(tuple(r) for r in frame.collect())
    want = Counter(database.execute(f"SELECT {', '.join(frame.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall())
    assert want
    return got - want, want - got


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp"
NONE = (Counter(), Counter())


@pytest.mark.parametrize("name", ["coverage_categories", "coverage_documents"])
def test_long_list_item_of_several_sentences(spark, tmp_path, name):
    words = "w " * 300
    texts = [f"A. | {words}. Then {words}", f"- {words} {words}", f"{words} {words}. End", f"B) {words} {words}\n- x\n- y", "Short."]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    assert differences(spark, tmp_path, name, documents=(rows, DOCUMENTS)) == NONE


def test_ampersands_in_html(spark, tmp_path):
    pages = [(1, "", "<h1>a&amp;&amp</h1><p>&copy;&copy b &quot;&lt; c&</p>"), (2, "", "<p>x &amp;quot; &#39;y</p><li>&middot;&middo</li>")]
    assert differences(spark, tmp_path, "html_blocks", pages=(pages, "page_id long, url string, html string")) == NONE


def test_evidence_is_dealt_by_key_after_a_join(spark, tmp_path):
    """Enough rows for the planned join to be a shuffle that then turns out to be small."""
    from datetime import datetime

    rows = [(k // 4, k * 7, k * 3 + k // 40, k % 4 + 1, datetime(2020, k % 5 + 1, 1)) for k in range(3000)]
    given = {"autoBroadcastJoinThreshold": "-1", "adaptive.autoBroadcastJoinThreshold": "10m", "files.maxPartitionBytes": "8k", "files.openCostInBytes": "1k", "adaptive.coalescePartitions.enabled": "false"}
    for k, v in given.items():
        spark.conf.set(f"spark.sql.{k}", v)
    try:
        for name in ("graph_edges_collapsed", "graph_triples"):
            assert differences(spark, tmp_path / name, name, lineitem=(rows, LINES)) == NONE
    finally:
        for k in given:
            spark.conf.unset(f"spark.sql.{k}")
