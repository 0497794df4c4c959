"""Entities, relations, graph, dedupe, search and checks."""

import json
import random
import re
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.resource import ResourceInformation
from pyspark.sql import functions as F

from docloom.functions import entities as E
from docloom.functions import vectors as V
from docloom.operators import dedupe, encoding, graph, quality, search
from docloom.plans import reference_search


def labels_of(spark, text, lexicon=E.DEFAULT):
    row = E.with_entities(spark.createDataFrame([(text,)], "texto string"), lexicon=lexicon).first()
    return [(e.label, e.entity_type) for e in row.entities]


def relations_of(spark, text, lexicon=E.DEFAULT):
    chunks = E.with_entities(spark.createDataFrame([("c", text)], "chunk_id string, texto string"), lexicon=lexicon)
    return sorted((r.subject, r.relation, r.object) for r in E.relations(chunks, lexicon=lexicon).collect())


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("La OTAN y América Latina", [("américa latina", "concept"), ("la otan", "entity")]),
        ("Ladrones usan ladrones", [("drones", "concept"), ("ladrones", "entity")]),
        ("Universidad Nacional. The. El. Ab", [("universidad nacional", "organization")]),
        ("Foo, Foo Bar y Baz-Qux, Qux", [("baz-qux", "entity"), ("foo bar", "entity")]),
        ("Café Grande", [("café grande", "entity")]),
        (None, []),
    ],
)
def test_entities(spark, text, found):
    assert labels_of(spark, text) == sorted(found)


def test_relations(spark):
    assert relations_of(spark, "Rusia desarrolla Drones.") == [("rusia", "desarrolla", "drones")]
    assert relations_of(spark, "Rusia y Drones. Nada desarrolla.") == []
    assert relations_of(spark, "Alfa uses Beta. Alfa uses Beta. Beta affects Alfa") == [("alfa", "uses", "beta"), ("beta", "affects", "alfa")]


def plain_relations(text, labels, triggers):
    out = set()
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        norm = re.sub(r"\s+", " ", sentence.strip(E.OUTER)).lower()
        placed = [(norm.find(x), x) for x in labels if x in norm]
        m = re.search(rf"\b({triggers})\b", sentence, re.IGNORECASE)
        if m and len(placed) >= 2:
            before, after = [p for p in placed if p[0] < m.start()], [p for p in placed if p[0] >= m.end()]
            subject = max(before, key=lambda p: p[0])[1] if before else placed[0][1]
            object_ = min(after, key=lambda p: p[0])[1] if after else placed[-1][1]
            if subject != object_:
                out.add((subject, m[1].lower(), object_))
    return out


def test_relations_equal_a_plain_version(spark, sf_dir):
    lexicon = E.Lexicon(triggers="with|from|this|para|pour|für")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").select(F.col("doc_id").alias("chunk_id"), F.substring("text", 1, 3000).alias("texto"))
    tagged = E.with_entities(docs, lexicon=lexicon).cache()
    found = {}
    for r in E.relations(tagged, lexicon=lexicon).collect():
        found.setdefault(r.chunk_id, set()).add((r.subject, r.relation, r.object))
    rows = tagged.collect()
    want = {r.chunk_id: plain_relations(r.texto, [e.label for e in r.entities], lexicon.triggers) for r in rows}
    assert {k: v for k, v in want.items() if v} == found and found


FACT = "chunk_ord int, doc_id string, chunk_id string, subject string, relation string, object string"


def test_later_triples_replace_edges(spark):
    facts = spark.createDataFrame([(1, "d", "c1", "a", "uses", "b"), (2, "d", "c2", "a", "affects", "b"), (3, "d", "c3", "a", "uses", "b")], FACT)
    labels = spark.createDataFrame([("a", 3, "entity"), ("b", 3, "entity")], "label string, mentions long, entity_type string")
    (edge,) = graph.edge_rows(graph.edges(labels, graph.triples(facts)), facts).collect()
    assert tuple(edge) == ("entity:a", "entity:b", "affects", 1, "d", "c2")


def test_ids_are_sorted_and_listed_once(spark):
    rows = [(k, f"d{k % 7}", f"c{k % 5000:05}", "a" if k % 3 else "é\n", "uses", "b") for k in range(12_000)] + [(0, None, "c", "x", "uses", "b"), (0, "", "c", "x", "uses", "b")]
    want = {}
    for _, d, c, *triple in rows:
        n, docs, chunks = want.setdefault(tuple(triple), [0, set(), set()])
        want[tuple(triple)][0] += 1
        docs.add(d or "")
        chunks.add(c)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = {tuple(r)[:3]: [r.evidence_count, r.doc_ids, r.chunk_ids] for r in graph.with_ids(spark.createDataFrame(rows, FACT).repartition(5), *graph.TRIPLE).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {k: [n, ";".join(sorted(d)), ";".join(sorted(c))] for k, (n, d, c) in want.items()}


def test_many_phrases_are_one_automaton():
    phrases = tuple(f"phrase {k} of many" for k in range(10_000))
    extractor = E.Extractor(E.Lexicon(concepts=phrases))
    assert extractor.entities("a Phrase 77 of many, phrase 9999 of many") == [("phrase 77 of many", "concept"), ("phrase 9999 of many", "concept")]
    assert E.Extractor(E.Lexicon(concepts=())).entities("Nada") == [("nada", "entity")]


def plain_entities(text, lexicon):
    found, low = {}, text.lower()
    norm = lambda x: unicodedata.normalize("NFC", re.sub(r"\s+", " ", x.strip(E.OUTER))).lower()
    for p in lexicon.concepts:
        if p in low:
            found[norm(p)] = "concept"
    for m in re.finditer(E.NAME, unicodedata.normalize("NFC", text)):
        x = norm(m[0])
        if x not in lexicon.not_entities and len(x) > 2:
            found.setdefault(x, "organization" if any(p in x for p in lexicon.organisation_parts) else "entity")
    return sorted((x, t) for x, t in found.items() if " " in x or not any(o != x and re.search(rf"\b{re.escape(x)}\b", o) for o in found))


def test_entities_equal_a_plain_version():
    r = random.Random(2)
    lexicon = E.Lexicon(concepts=("drones", "drones de ataque", "c++", "a-b", "mar"))
    words = "Drones drones de ataque C++ a-b A-B Mar Mar-Azul Ana-Mar ÁNGEL A\u030angel X\u1f79 El La ONU Onu9 _Foo Foo_ El- The, . (Baz) \n".split(" ")
    extractor = E.Extractor(lexicon)
    for _ in range(3000):
        text = " ".join(r.choice(words) for _ in range(r.randrange(12)))
        assert extractor.entities(text) == plain_entities(text, lexicon), text


def test_isolated_node(spark):
    facts = graph.triples(spark.createDataFrame([(1, "d", "c1", "a", "uses", "b")], FACT))
    labels = spark.createDataFrame([("a", 3, "entity"), ("b", 1, "entity")], "label string, mentions long, entity_type string")
    assert [r.label for r in graph.nodes(labels, facts, 2).collect()] == ["a"]
    assert graph.edges(labels, facts, 2).count() == 0


def test_first_seen_type_and_mentions(spark):
    kind = "chunk_ord int, entities array<struct<label:string,entity_type:string>>"
    rows = spark.createDataFrame([(2, [("x", "entity")]), (1, [("x", "concept"), ("y", "entity")])], kind)
    assert sorted(tuple(r) for r in graph.mentions(rows).collect()) == [("x", 2, "concept"), ("y", 1, "entity")]


def test_edges_count_once_for_a_query(spark):
    edges = spark.createDataFrame([("entity:a", "entity:b", "uses", 2, "d", "c1"), ("entity:b", "entity:c", "uses", 5, "d", "c1;c2"), ("entity:c", "entity:c", "uses", 1, "", "")], "src string, dst string, relation string, evidence_count long, doc_ids string, chunk_ids string")
    asked = spark.createDataFrame([("q", "a"), ("q", "b"), ("r", "a"), ("s", "z")], "query_id string, label string")
    want = {("q", "c1"): 7, ("q", "c2"): 5, ("r", "c1"): 2}
    for found in (graph.chunk_scores(asked, graph.edge_ends(edges), graph.listed_evidence(edges)), graph.scan_chunk_scores(asked, edges)):
        assert {(r.query_id, r.chunk_id): r.graph_score for r in found.collect()} == want


def test_fusion(spark):
    hits = spark.createDataFrame([("q", "c1", "d1", 0.9, 1), ("q", "c2", "d2", 0.899, 2)], "query_id string, chunk_id string, doc_id string, score double, hit_rank int")
    scores = spark.createDataFrame([("q", "c2", 12), ("q", "c3", 4), ("q", "zz", 9)], "query_id string, chunk_id string, graph_score long")
    chunks = spark.createDataFrame([("c1", "d1"), ("c2", "d2"), ("c3", "d3")], "chunk_id string, doc_id string")
    fused = search.fuse(hits, scores, chunks)
    assert [(r.chunk_id, round(r.score, 4)) for r in fused.orderBy("hit_rank").collect()] == [("c2", 0.924), ("c1", 0.9), ("c3", 0.01)]
    assert [r.doc_id for r in search.top_documents(fused).orderBy("rank").collect()] == ["d2", "d1", "d3"]
    assert search.fuse(hits, None, chunks).count() == 2
    with pytest.raises(ValueError):
        search.fuse(hits, scores, chunks, -1)


@pytest.mark.parametrize(("how", "order"), [("max", ["d1", "d2"]), ("top2sum", ["d2", "d1"]), ("mean", ["d2", "d1"])])
def test_document_aggregation(spark, how, order):
    rows = [("q", "d1", 0.9, 1), ("q", "d2", 0.6, 2), ("q", "d2", 0.55, 3), ("q", "d1", 0.1, 4)]
    hits = spark.createDataFrame(rows, "query_id string, doc_id string, score double, hit_rank int")
    assert [r.doc_id for r in search.top_documents(hits, how).orderBy("rank").collect()] == order


def test_knn_ties_and_batches(spark):
    r = np.random.default_rng(0)
    vectors = r.integers(-2, 3, size=(400, 4)).astype(float)  # many ties
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "chunk_ord long, embedding array<double>").repartition(7)
    queries = spark.createDataFrame([(str(k), vectors[k].tolist()) for k in range(9)], "query_id string, embedding array<double>")
    found = {(x.query_id, x.hit_rank): x.chunk_ord for x in search.knn(frame, queries, 25).collect()}
    for k in range(9):
        best = sorted(range(400), key=lambda i: (-float(vectors[i] @ vectors[k]), i))[:25]
        assert [found[str(k), n + 1] for n in range(25)] == best
    assert {(x.query_id, x.hit_rank): x.chunk_ord for x in search.knn(frame, queries, 25, "columns").collect()} == found
    named = frame.withColumn("chunk_ord", F.lpad(F.col("chunk_ord").cast("string"), 4, "0"))
    assert {(x.query_id, x.hit_rank): int(x.chunk_ord) for x in search.knn(named, queries, 25).collect()} == found
    assert search.knn(frame, queries.where("query_id = 'none'"), 3).count() == 0
    assert search.knn(frame.limit(0), queries, 3).count() == 0


def test_knn_prunes_blocks_by_norm(spark, monkeypatch):
    r = np.random.default_rng(3)
    vectors = r.standard_normal((600, 8)) * np.repeat([8.0, 1.0, 0.1, 0.0], 150)[:, None]
    vectors[7] = vectors[8] = vectors[9]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "chunk_ord long, embedding array<double>").repartition(5)
    asked = r.standard_normal((12, 8))
    asked[3] = 0
    queries = spark.createDataFrame([(str(k), v.tolist()) for k, v in enumerate(asked)], "query_id string, embedding array<double>")
    pairs = []
    plain = search.surviving
    monkeypatch.setattr(search, "surviving", lambda *a: pairs.append(out := plain(*a)) or out)
    monkeypatch.setattr(search, "ASKED_TOGETHER", 5)
    for size in (32_000_000, 100 * 64):
        found = search.knn(frame, queries, 5, block_bytes=size).collect()
        for k, v in enumerate(asked):
            best = sorted(range(600), key=lambda i: (-round(float(vectors[i] @ v), 9), i))[:5]
            assert [x.chunk_ord for x in sorted(found, key=lambda x: x.hit_rank) if x.query_id == str(k)] == best
    n_blocks = len(search.blocked(frame, 100 * 64)[1])
    met = {x.query_id: x["count"] for x in pairs[-1].groupBy("query_id").count().collect()}
    assert n_blocks > 10 and met.pop("3") == n_blocks - 1  # a zero query ties with all
    assert sum(met.values()) < 0.4 * n_blocks * 11
    assert pairs[-1].select("salt").distinct().count() == 3


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0],)], "v array<float>")
    assert row.select(V.l2_normalize(F.col("v")).alias("y")).first().y == [0.6, 0.8]
    with pytest.raises(Exception, match="zero vector"):
        spark.createDataFrame([([0.0, 0.0],)], "v array<float>").select(V.l2_normalize(F.col("v"))).collect()


def test_repeated_ocr_blocks(spark):
    rows = [("d", k, f"Page {k + 1} of 3", k + 1, "t") for k in range(3)] + [("d", 3, "body", 1, "t"), ("e", 0, "same text", 1, None), ("e", 1, "same text", 2, None), ("e", 2, "same text", 3, None)]
    blocks = spark.createDataFrame(rows, "doc_id string, block_no int, text string, page_end int, ocr_engine string")
    kept = sorted((r.doc_id, r.text, r.removed_repeated_ocr_blocks) for r in dedupe.remove_repeated_blocks(blocks).collect())
    assert kept == [("d", "body", 3), ("e", "same text", 0), ("e", "same text", 0), ("e", "same text", 0)]


def test_long_block_goes_with_short_ones(spark):
    short = "x" * 200 + " -"
    rows = [("d", k, short, 1, "t") for k in range(3)] + [("d", 3, "x" * 200 + " " * 60 + "...", 1, "t")]
    blocks = spark.createDataFrame(rows, "doc_id string, block_no int, text string, page_end int, ocr_engine string")
    assert dedupe.remove_repeated_blocks(blocks).count() == 0


def test_ocr_paragraphs(spark):
    rows = [("d", 1, 1, 2, 0, "b", "90"), ("d", 1, 1, 1, 1, "a2", "-1"), ("d", 1, 1, 1, 0, "a1", "50"), ("d", 1, 2, 1, 0, "low", "10"), ("d", 2, 1, 1, 0, "none", "x"), ("d", 3, 1, 1, 0, " ", "99")]
    words = spark.createDataFrame(rows, "doc_id string, block int, par int, line int, word_no int, text string, conf string")
    assert sorted((r.block, r.text, r.ocr_confidence) for r in dedupe.ocr_paragraphs(words).collect()) == [(1, "a1 a2 b", 70.0), (2, "none", None)]


def test_metadata_checks(spark):
    good = {"doc_id": "D", "chunk_id": "c", "fuente": "f", "formato": "txt", "fenomeno": 1, "posicion": 0, "num_tokens": 2, "texto": "a b"}
    lines = [good, good, good | {"chunk_id": "x", "fenomeno": True, "num_tokens": 481}, {k: v for k, v in good.items() if k != "texto"} | {"chunk_id": 5}, good | {"chunk_id": "y", "posicion": 1.0, "texto": " "}]
    rows = [(k, json.dumps(x)) for k, x in enumerate(lines)] + [(5, ""), (6, json.dumps(good | {"chunk_id": "z", "num_tokens": 3}))]
    found = sorted((r.line, r.error) for r in quality.validate_metadata(spark.createDataFrame(rows, "line long, value string"), count=lambda t: len(t.split())).collect())
    assert found == [
        (1, "chunk_id_duplicate"), (2, "num_tokens"), (2, "num_tokens_differ"), (3, "chunk_id"), (3, "missing:texto"), (3, "texto"), (4, "num_tokens_differ"), (4, "posicion"), (4, "texto"), (5, "json"), (6, "num_tokens_differ"),
    ]


def test_result_checks(spark):
    docs = [(k, f"d{k}") for k in (1, 2, 3)]
    frags = [("c1", "d1", "a b", k) for k in range(1, 11)]
    kind = "line int, query_id string, documents array<struct<rank:int,doc_id:string>>, fragments array<struct<chunk_id:string,doc_id:string,text:string,rank:int>>"
    rows = [(1, "q001", docs, frags), (2, "q009", docs[:2], frags), (3, "q003", [(1, "d1"), (2, "d1"), (3, "zz")], [("cX", "d1", "a", 1), ("c1", "d2", "a " * 251, 2), *frags[2:]]), (4, "q004", None, None)]
    chunks = spark.createDataFrame([("c1", "d1"), ("c2", "d2"), ("c3", "d3")], "chunk_id string, doc_id string")
    found = {}
    for r in quality.validate_results(spark.createDataFrame(rows, kind), True, chunks).collect():
        found.setdefault(r.line, set()).add(r.error)
    assert found == {
        0: {"line_count"},
        2: {"query_id", "sizes", "document_ranks"},
        3: {"documents_repeat", "fragment_too_long", "unknown_chunk", "chunk_of_other_document", "unknown_document"},
        4: {"sizes", "document_ranks", "fragment_ranks"},
    }


def test_embedding_cache(spark):
    model = encoding.EmbeddingModel()
    texts = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "alpha")], "id int, texto string")
    out = {r.id: r.embedding for r in encoding.embed(texts, model).collect()}
    assert out[1] == out[3] != out[2] and abs(sum(x * x for x in out[1]) - 1) < 1e-5
    cache = encoding.cache_rows(spark.createDataFrame([(r, [9.0])for r in [texts.select(encoding.content_hash(F.col("texto"), "passage")).first()[0]]], "content_hash string, vector array<float>"), model.name, "passage")
    assert {r.id: r.embedding for r in encoding.embed(texts, model, cache=cache).collect()}[1] == [9.0]
    assert encoding.cache_misses(texts, cache, model.name, "passage").count() == 1
    assert encoding.cache_misses(texts, cache, model.name, "query").count() == 2
    with pytest.raises(ValueError):
        encoding.embed(texts, model, "other")
    assert [encoding.select_device(x, False) for x in (None, "auto", "cpu")] == ["cpu"] * 3
    with pytest.raises(RuntimeError):
        encoding.select_device("cuda", False)


def test_device_of_a_task():
    gpu = {"gpu": ResourceInformation("gpu", ["3"])}
    assert encoding.task_device("auto", gpu) == ("cuda:3", True) == encoding.task_device("cuda", gpu)
    assert encoding.task_device("cpu", gpu) == ("cpu", False) == encoding.task_device("auto", {})
    with pytest.raises(RuntimeError):
        encoding.task_device("cuda", {"gpu": ResourceInformation("gpu", [])})


def test_a_model_is_loaded_once_a_worker_for_its_device(spark, monkeypatch):
    loads = spark.sparkContext.accumulator(0)
    resources = {"gpu": ResourceInformation("gpu", ["1"])}

    def load(device, half):
        loads.add(1)
        return lambda texts: np.tile([{"cpu": 1.0, "cuda:1": 2.0}[device], float(half)], (len(texts), 1))

    def found(model):
        held = spark.createDataFrame([(k, f"t{k}") for k in range(40)], "id int, texto string").repartition(1)
        return {tuple(round(x, 3) for x in r.embedding) for r in encoding.embed(held, model, batch_size=3).collect()}

    model = encoding.EmbeddingModel("m", 2, load, "auto")
    assert found(model) == {(1.0, 0.0)} and loads.value <= 4
    encode = encoding._encode(model, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(["h"] * 7), pa.array(["t"] * 7)], names=["content_hash", "_text"])
    monkeypatch.setattr(encoding, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(resources=lambda: resources)))
    monkeypatch.setattr(encoding, "_loaded", lambda pickled, device, half: (lambda texts: np.array([[2.0 if device == "cuda:1" else 1.0, float(half)]] * len(texts))))
    assert {tuple(round(x, 3) for x in v) for b in encode(iter([batch])) for v in b.column("vector").to_pylist()} == {(0.894, 0.447)}
    half_off = encoding._encode(encoding.EmbeddingModel("m", 2, load, "cuda", False), 3)
    assert {tuple(v) for b in half_off(iter([batch])) for v in b.column("vector").to_pylist()} == {(1.0, 0.0)}
    assert encoding.config(model, True)["dtype"] == "float16" and encoding.config(model)["build_device"] == "cpu"
    assert encoding.gpu_profile(spark, "auto") is None
    with pytest.raises(RuntimeError):
        encoding.gpu_profile(spark, "cuda")
    with pytest.raises(ValueError):
        encoding.named_model("unknown")


def test_memory_is_halved():
    calls = []

    def encode(texts):
        calls.append(len(texts))
        if len(texts) > 2:
            raise MemoryError
        return np.ones((len(texts), 2))

    assert encoding._halving(encode, list("abcde")).shape == (5, 2)
    assert calls == [5, 2, 3, 1, 2]


def test_search_results_are_whole(spark, sf_dir):
    rows = reference_search.search_results(spark, sf_dir).collect()
    asked = {r.item_id for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    known = {str(r.doc_id) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {int(r.query_id) for r in rows} == asked
    for r in rows:
        assert [d["rank"] for d in r.documents] == [1, 2, 3] and {d.doc_id for d in r.documents} <= known
        assert [f["rank"] for f in r.fragments] == list(range(1, 11)) and all(f.doc_id in known and f.chunk_id.startswith(f.doc_id) and f.text for f in r.fragments)
