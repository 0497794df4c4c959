"""What a task holds at a time, and how often work is done, whatever the size of the input."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import __spark_entry__
from docloom.functions import entities as E
from docloom.operators import encoding, graph, packing, search


@pytest.mark.parametrize("few", [0, 1, 2])
def test_scores_are_the_same_by_arrays_and_by_rows(spark, monkeypatch, few):
    """Chunks of many edges and queries of many labels are summed over rows, others by what a row carries."""
    edges = [(f"entity:p{a}", f"entity:s{b}", a + 2 * b + 1, ";".join(f"c{k}" for k in range(12) if (a * b + k) % 3 == 0)) for a in range(4) for b in range(3)] + [("entity:p1", "entity:p1", 5, "c1;c77")]
    asked = {"q1": {"p1"}, "q2": {"p0", "s1"}, "q3": {"p0", "p1", "s2", "none"}, "q4": {"none"}}
    want = Counter()
    for query, labels in asked.items():
        for src, dst, weight, chunks in edges:
            if {src[7:], dst[7:]} & labels:
                for c in chunks.split(";"):
                    want[query, c] += weight
    monkeypatch.setattr(graph, "FEW", few)
    rows = spark.createDataFrame(edges, "src string, dst string, evidence_count long, chunk_ids string")
    labels = spark.createDataFrame([(q, x) for q, found in asked.items() for x in found for _ in range(2)], "query_id string, label string")
    for found in (graph.chunk_scores(labels, graph.edge_ends(rows), graph.listed_evidence(rows)), graph.scan_chunk_scores(labels, rows)):
        got = [((x.query_id, x.chunk_id), x.graph_score) for x in found.collect()]
        assert len(got) == len(dict(got)) and dict(got) == want


def test_products_held_at_a_time(monkeypatch):
    held = []
    scored = search._scored
    monkeypatch.setattr(search, "_scored", lambda names, queries, ids, vectors, k: held.append(len(queries) * len(vectors)) or scored(names, queries, ids, vectors, k))
    monkeypatch.setattr(search, "PRODUCTS", 3000)
    vectors = np.random.default_rng(1).normal(size=(900, 4))
    asks = [False] * 700 + [True] * 200
    batch = pa.RecordBatch.from_pydict({"block": [0] * 900, "salt": [0] * 900, "asks": asks, "chunk_ord": [*range(700), *[None] * 200], "query_id": [None] * 700 + [str(k) for k in range(200)], "embedding": vectors.tolist()})
    got = pa.Table.from_batches(search._meet(5)(iter([batch.slice(0, 300), batch.slice(300)]))).to_pylist()
    assert len(held) > 40 and max(held) <= 3000
    want = np.argsort(-(vectors[700:] @ vectors[:700].T), axis=1)[:, :5]
    assert [x["chunk_ord"] for x in got] == want.ravel().tolist()


def test_texts_held_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS", 2)
    monkeypatch.setattr(E, "_ROWS", 2)
    rows = spark.createDataFrame([(k, ["Ab cd."] * k if k % 4 else None) for k in range(11)], "k int, units array<string>").coalesce(1)
    packed = rows.select("k", packing.pack(rows.units, target_tokens=4).alias("c")).collect()
    assert [len(x.c) for x in packed] == [-(-x.k // 2) if x.k % 4 else 0 for x in packed]
    tagged = E.with_entities(rows.selectExpr("k", "if(k % 3 = 0, null, concat('Ab Cd', k)) AS texto")).collect()
    assert [len(x.entities) for x in tagged] == [int(x.k % 3 > 0) for x in tagged]


def test_each_different_ngram_is_hashed_once(monkeypatch):
    calls = []
    plain = xxhash.xxh3_64_intdigest
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda x: calls.append(x) or plain(x))
    texts = ["ab ab ab " * 200, "", "é😀İ ab", "a"]
    for n in (1, 3, 5):
        calls.clear()
        got = encoding.hashed_ngrams(64, n)(texts)
        assert len(calls) == len(set(calls))
        for row, text in zip(got, texts, strict=True):
            want = np.zeros(64)
            padded = f" {text.lower()} "
            for k in range(len(padded) - n + 1):
                want[plain(padded[k : k + n]) % 64] += 1 if plain(padded[k : k + n]) >> 63 else -1
            if not want.any():
                want[0] = 1
            assert row.tolist() == want.tolist()


def test_put_makes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    held = encoding.embedding_cache(str(tmp_path / "cache"), 2)
    for word in ("a", "b"):
        rows = spark.range(40).selectExpr("'m' AS model", "'passage' AS kind", f"concat('{word}', id) AS content_hash", "1 AS dimension", "array(1.0F) AS vector")
        held.put(rows.mapInArrow(count, rows.schema))
    assert made.value == 80 and held.read(spark).count() == 80


def test_search_reads_an_index_that_is_made_once(spark, sf_dir):
    read = __spark_entry__.queries()["search_results"](spark, sf_dir).inputFiles()
    assert read and not any("documents.parquet" in f for f in read)


def test_column_search_ranks_few_of_its_products(spark, monkeypatch):
    """Many vectors and copies: what goes to the ranking is bounded, and the hits are those of all products."""
    k, n = 5, 3000
    random = np.random.default_rng(3)
    vectors = random.integers(-3, 4, size=(n, 6)).astype(float)  # few different products, so many ties
    vectors[random.random(n) < 0.4] = 3.0
    for nulls in (False, True):
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
        if nulls:
            rows[7] = (7, [None, *rows[7][1][1:]])
        base = spark.createDataFrame(rows, "chunk_ord long, embedding array<double>")
        asked = base.where("chunk_ord % 300 = 0").selectExpr("cast(chunk_ord AS string) AS query_id", "embedding")
        counted = search._knn_columns(base, asked, k).groupBy("query_id").count().collect()
        assert len(counted) == 10 and max(x["count"] for x in counted) < n / 10
        found = {(x.query_id, x.hit_rank): (x.chunk_ord, x.score) for x in search.knn(base, asked, k, "columns").collect()}
        score = vectors @ vectors[::300].T
        if nulls:
            score[7] = -np.inf
        for c in range(10):
            order = np.lexsort((np.arange(n), -score[:, c]))[:k]
            assert [found[str(300 * c), r + 1] for r in range(k)] == [(i, score[i, c]) for i in order.tolist()]
        assert len(found) == 10 * k


def test_each_sentence_is_read_once_for_relations(spark, capsys):
    texts = ["The Red House works with The Blue House. Ab Cd stands. The Red House and Ab Cd from this.", "With no names", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "chunk_ord int, texto string")
    found = E.relations(E.with_entities(rows), lexicon=E.Lexicon(triggers="with|from"))
    found.explain()
    plan = capsys.readouterr().out
    assert [plan.count(f"{name}(") for name in ("regexp_instr", "regexp_extract", "locate")] == [1, 1, 1]
    got = {tuple(x) for x in found.select("chunk_ord", "subject", "relation", "object").collect()}
    assert got == {(0, "the red house", "with", "the blue house"), (0, "ab cd", "from", "the red house")}


def _shuffled(spark) -> int:
    """Rows that the session's stages have written to shuffles so far."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = context._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, context._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


@pytest.mark.parametrize(("sent", "alike"), [(100_000, 1 << 18), (0, 100)])
def test_no_pair_of_query_and_edge_is_shuffled(spark, monkeypatch, sent, alike):
    """What is shuffled follows the chunks and the queries' labels, not how often the two meet."""
    monkeypatch.setattr(graph, "SENT", sent, raising=False)
    monkeypatch.setattr(graph, "ALIKE", alike, raising=False)
    facts = [(a * 100 + b, f"d{a}", f"c{a}-{b}-{k}", f"p{a}", f"m{k % 4}", f"s{b}") for a in range(16) for b in range(16) for k in range(4)]
    rows = spark.createDataFrame(facts, "chunk_ord int, doc_id string, chunk_id string, subject string, relation string, object string")
    edges = spark.createDataFrame([(f"p{a}", f"s{b}", f"m{(a + b) % 4}", a + 1) for a in range(16) for b in range(16)], "subject string, object string, relation string, evidence_count long")
    ends = edges.select(graph.entity("subject").alias("src"), graph.entity("object").alias("dst"))
    asked = [(f"q{q}", f"{'ps'[k % 2]}{(q + k) % 16}") for q in range(100) for k in range(8)]
    labels = spark.createDataFrame(asked, "query_id string, label string")
    before = _shuffled(spark)
    found = graph.chunk_scores(labels, graph.edge_ends(ends), graph.edge_evidence(edges, rows)).collect()
    assert _shuffled(spark) - before < len(found)
    of = {q: {x for name, x in asked if name == q} for q, _ in asked}
    want = {(q, f"c{a}-{b}-{(a + b) % 4}"): a + 1 for q, each in of.items() for a in range(16) for b in range(16) if {f"p{a}", f"s{b}"} & each}
    assert {(x.query_id, x.chunk_id): x.graph_score for x in found} == want and len(found) == len(want)


def test_first_of_fused_hits_without_the_others(spark):
    """The first rows of each query as ``fuse`` ranks them, though its graph's chunks are not repeated for each query."""
    random = np.random.default_rng(4)
    chunks = spark.createDataFrame([(f"c{k}", f"d{k % 5}") for k in range(600)], "chunk_id string, doc_id string")
    graphs = [(g, f"c{k}", int(random.integers(0, 15))) for g in range(3) for k in range(650) if k % 3 != g]
    scores = spark.createDataFrame(graphs, "graph int, chunk_id string, graph_score int")
    # some below 0, so that a chunk that is a hit would rank higher as one that only the graph finds; q0 has no hits, q1 no graph
    hits = [(f"q{q}", f"c{c}", f"d{c % 5}", float(s), r + 1) for q in range(1, 40) for r, (c, s) in enumerate(zip(random.permutation(600)[:20], np.sort(random.uniform(-0.5, 0.03, 20))[::-1], strict=True))]
    near = spark.createDataFrame(hits, "query_id string, chunk_id string, doc_id string, score double, hit_rank int")
    asks = spark.createDataFrame([(f"q{q}", q % 3) for q in range(40) if q != 1], "query_id string, graph int")
    columns = ["query_id", "chunk_id", "doc_id", "score", "hit_rank"]
    want = search.fuse(near, asks.join(scores, "graph").drop("graph"), chunks).where("hit_rank <= 12").select(columns).collect()
    before = _shuffled(spark)
    got = search.fused_first(near, asks, scores, chunks, 12, 20).select(columns).collect()
    assert _shuffled(spark) - before < 10_000  # there are 16,000 rows of query and chunk
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 40 * 12


def test_fragments_are_sought_for_first_hits_alone(spark, sf_dir, monkeypatch):
    """Each query brings its first ten hits with texts, not all that its graph finds."""
    given = []
    plain = search.fragments
    monkeypatch.setattr(search, "fragments", lambda hits, *a: given.append(hits) or plain(hits, *a))
    rows = __spark_entry__.queries()["search_fragments"](spark, sf_dir).count()
    counts = [x["count"] for x in given[0].groupBy("query_id").count().collect()]
    assert rows == 250 and len(counts) == 25 and max(counts) <= 10
