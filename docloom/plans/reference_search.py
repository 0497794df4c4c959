"""Vectors, search, graph and checks over the test tables, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import entities as E
from docloom.functions import text as T
from docloom.functions import vectors as V
from docloom.operators import encoding, graph, packing, quality, search
from docloom.plans.reference import TEST_LEXICON, packing_sql, query, read
from docloom.sources import shared

CANDIDATES, DOCUMENTS = 100, 37
#: Ids that are sent to every task, at most, so that only texts of theirs are shuffled.
IDS_SENT = 1_000_000
#: As in the original's program; its library has 100.
RESULT_CANDIDATES = 1000

# --- vectors ------------------------------------------------------------------------------------


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(e, lambda x: (x / n) * (x / n)))), 6) AS length, round(e[1] / n, 6) AS first FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 3) AS e, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 3 * x::DOUBLE * 3))) AS n FROM embeddings)")
def l2_normalize(spark, d):
    tripled = F.transform(V.as_double(F.col("embedding")), lambda x: x * 3)
    rows = read(spark, d, "embeddings").select("vec_id", V.l2_normalize(tripled).alias("v"))
    return rows.select("vec_id", F.round(F.sqrt(V.inner_product(F.col("v"), F.col("v"))), 6).alias("length"), F.round(F.col("v")[0], 6).alias("first"))


def _queries(spark, d):
    return read(spark, d, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")


def _vectors(spark, d):
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("chunk_ord"), "embedding")


_KNN = f"""
WITH v AS (SELECT vec_id AS chunk_ord, embedding::DOUBLE[] AS e FROM embeddings),
q AS (SELECT vec_id::VARCHAR AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT query_id, chunk_ord, list_inner_product(q.e, v.e) AS score FROM q, v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_ord) AS hit_rank FROM s),
hits AS (SELECT query_id, 'C' || chunk_ord AS chunk_id, 'D' || chunk_ord % {DOCUMENTS} AS doc_id, chunk_ord, score, hit_rank FROM r WHERE hit_rank <= {CANDIDATES})
"""


def _shown(hits):
    return hits.select("query_id", "chunk_ord", F.round("score", 6).alias("score"), "hit_rank")


@query(_KNN + "SELECT query_id, chunk_ord, round(score, 6) AS score, hit_rank::INT AS hit_rank FROM hits")
def knn_topk(spark, d):
    return _shown(search.knn(_vectors(spark, d), _queries(spark, d), CANDIDATES))


@query(_KNN + "SELECT query_id, chunk_ord, round(score, 6) AS score, hit_rank::INT AS hit_rank FROM hits")
def knn_topk_columns(spark, d):
    return _shown(search.knn(_vectors(spark, d), _queries(spark, d), CANDIDATES, "columns"))


def _hits(spark, d):
    near = search.knn(_vectors(spark, d), _queries(spark, d), CANDIDATES)
    return near.select("query_id", "chunk_ord", F.concat(F.lit("C"), "chunk_ord").alias("chunk_id"), F.concat(F.lit("D"), F.col("chunk_ord") % DOCUMENTS).alias("doc_id"), "score", "hit_rank")


def _documents(aggregation: str):
    score = {"max": "max(score)", "mean": "avg(score)", "top2sum": "list_sum(list_slice(list_sort(list(score), 'DESC'), 1, 2))"}[aggregation]
    oracle = _KNN + f", g AS (SELECT query_id, doc_id, {score} AS s, min(hit_rank) AS f FROM hits GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, f) AS rank FROM g) SELECT query_id, rank::INT AS rank, doc_id, round(s, 6) AS doc_score FROM k WHERE rank <= 3"

    def run(spark, d):
        return search.top_documents(_hits(spark, d), aggregation).withColumn("doc_score", F.round("doc_score", 6))

    run.__name__ = f"doc_agg_{aggregation}"
    query(oracle)(run)


for _name in search.AGGREGATIONS:
    _documents(_name)


# each query's graph: the chunks whose number and the query's sum to a multiple of 13
_GRAPH = ", gs AS (SELECT q.query_id, 'C' || v.chunk_ord AS chunk_id, v.chunk_ord % 17 AS g FROM q, v WHERE (v.chunk_ord + q.query_id::BIGINT) % 13 = 0 AND v.chunk_ord % 3 = 0)"
_FUSED = (
    _KNN
    + _GRAPH
    + f""", f AS (SELECT coalesce(h.query_id, gs.query_id) AS query_id, coalesce(h.chunk_id, gs.chunk_id) AS chunk_id, 'D' || (substr(coalesce(h.chunk_id, gs.chunk_id), 2)::BIGINT % {DOCUMENTS}) AS doc_id,
  coalesce(h.score, 0) + 0.0025 * least(coalesce(g, 0), 10) AS score, coalesce(h.hit_rank, 1::BIGINT << 62) AS src FROM hits h FULL OUTER JOIN gs USING (query_id, chunk_id)),
fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, src, chunk_id) AS hit_rank FROM f)"""
)


def _fused(spark, d):
    queries = _queries(spark, d).select("query_id", F.col("query_id").cast("long").alias("q"))
    chunks = _vectors(spark, d).select("chunk_ord").where("chunk_ord % 3 = 0").withColumn("rest", F.col("chunk_ord") % 13)
    asked = queries.withColumn("rest", (13 - F.col("q") % 13) % 13)
    scores = asked.join(chunks, "rest").select("query_id", F.concat(F.lit("C"), "chunk_ord").alias("chunk_id"), (F.col("chunk_ord") % 17).alias("graph_score"))
    known = _vectors(spark, d).select(F.concat(F.lit("C"), "chunk_ord").alias("chunk_id"), F.concat(F.lit("D"), F.col("chunk_ord") % DOCUMENTS).alias("doc_id"))
    return search.fuse(_hits(spark, d), scores, known)


@query(_FUSED + " SELECT query_id, chunk_id, doc_id, round(score, 6) AS score, hit_rank::INT AS hit_rank FROM fused")
def hybrid_fused_hits(spark, d):
    return _fused(spark, d).select("query_id", "chunk_id", "doc_id", F.round("score", 6).alias("score"), "hit_rank")


_SEARCH = _FUSED + ", g AS (SELECT query_id, doc_id, max(score) AS s, min(hit_rank) AS r FROM fused GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, r) AS rank FROM g) "


@query(_SEARCH + "SELECT query_id, rank::INT AS rank, doc_id, round(s, 6) AS doc_score FROM k WHERE rank <= 3")
def search_documents(spark, d):
    return search.top_documents(_fused(spark, d)).withColumn("doc_score", F.round("doc_score", 6))


_FRAGMENTS = (
    packing_sql(250, 250)
    + ", bad AS (SELECT DISTINCT doc_id FROM units WHERE n > 250), "
    + _FUSED.strip().removeprefix("WITH ")
    + """, t AS (SELECT fused.query_id, fused.chunk_id, fused.doc_id, hit_rank, c.chunk_no, c.text FROM fused JOIN chunks c ON 'C' || c.doc_id = fused.chunk_id WHERE c.doc_id NOT IN (SELECT doc_id FROM bad)),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hit_rank, chunk_no) AS rank FROM t)
SELECT query_id, rank::INT AS rank, chunk_id, doc_id, sha256(text) AS sha FROM o WHERE rank <= 10"""
)


@query(_FRAGMENTS)
def search_fragments(spark, d):
    """A hit without texts gives no fragment, and another one at least, so that each query's first hits with texts are enough."""
    texts = read(spark, d, "documents").select(F.col("doc_id").alias("chunk_ord"), F.col("text").alias("texto"))
    held = texts.join(shared.sent(_vectors(spark, d).select("chunk_ord").distinct(), IDS_SENT), "chunk_ord", "left_semi")
    # the condition stands inside an array that is exploded: as a filter, it would be evaluated before the join, for all texts
    given = F.filter(F.array(search.has_fragments(T.sentences(F.col("texto")))), lambda x: x)
    cut = shared.checkpointed(held.select("chunk_ord", F.explode_outer(given).alias("_given")).where("_given").select("chunk_ord").distinct())
    near = _hits(spark, d).join(shared.sent(cut, IDS_SENT), "chunk_ord", "left_semi")
    chunk = F.concat(F.lit("C"), "chunk_ord").alias("chunk_id")
    asks = _queries(spark, d).select("query_id", ((13 - F.col("query_id").cast("long") % 13) % 13).alias("graph"))
    scores = cut.where("chunk_ord % 3 = 0").select((F.col("chunk_ord") % 13).alias("graph"), chunk, (F.col("chunk_ord") % 17).alias("graph_score"))
    chunks = cut.select(chunk, F.concat(F.lit("D"), F.col("chunk_ord") % DOCUMENTS).alias("doc_id"))
    first = shared.checkpointed(search.fused_first(near, asks, scores, chunks, search.TOP_FRAGMENTS, CANDIDATES))
    found = first.select(F.substring("chunk_id", 2, 20).cast("long").alias("chunk_ord")).distinct()
    hits = first.join(texts.join(shared.sent(found, IDS_SENT), "chunk_ord", "left_semi").select(chunk, "texto"), "chunk_id")
    return search.fragments(hits).select("query_id", "rank", "chunk_id", "doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT c_custkey AS query_id, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment ELSE c_nationkey::VARCHAR END AS query FROM customer")
def query_text(spark, d):
    rows = read(spark, d, "customer").select(
        F.col("c_custkey").alias("query_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.lit("")).alias("query"),
        F.when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")).otherwise(F.lit("")).alias("text"),
        F.col("c_nationkey").cast("string").alias("consulta"),
    )
    return search.query_text(rows)


@query()
def search_results(spark, d):
    """Documents and fragments of hashed-spelling vectors, end to end."""
    model = encoding.EmbeddingModel()
    docs = read(spark, d, "documents")
    chunks = packing.chunk_documents(docs).withColumn("chunk_ord", F.col("chunk_id"))
    folder = shared.new_folder(spark, "index")
    encoding.build_index(chunks, folder, model)
    index = encoding.open_index(spark, folder, model)  # the search reads it several times
    asked = read(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    documents, hits = search.search(index, encoding.embed(asked, model, "query", text="query"), RESULT_CANDIDATES, RESULT_CANDIDATES)
    return search.results(documents, search.fragments(hits), strict=False)


# --- encoding and cache -------------------------------------------------------------------------


@query("SELECT DISTINCT sha256('passage: ' || text) AS content_hash FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 4 = 0)")
def embedding_cache_misses(spark, d):
    docs = read(spark, d, "documents")
    cache = docs.where("doc_id % 4 = 0").select(F.lit("m").alias("model"), F.lit("passage").alias("kind"), encoding.content_hash(F.col("text"), "passage").alias("content_hash"))
    return encoding.cache_misses(docs, cache, "m", "passage", "text").select("content_hash")


@query("SELECT DISTINCT 'hashed-3grams-256' AS model, kind, sha256(kind || ': ' || text) AS content_hash, 256 AS dimension FROM documents, (VALUES ('passage'), ('query')) v(kind) WHERE kind = 'passage' OR doc_id % 4 = 0")
def embedding_cache_put(spark, d):
    """A cache that was filled by some texts, then by all, and by some as queries; twice each."""
    docs, model = read(spark, d, "documents").select("doc_id", "text"), encoding.EmbeddingModel()
    held = encoding.embedding_cache(shared.new_folder(spark, "embeddings"), 4)
    some = docs.where("doc_id % 4 = 0")
    for texts, kind in ((some, "passage"), (docs, "passage"), (docs, "passage"), (some, "query"), (some, "query")):
        held.put(encoding.encode_misses(texts, model, kind, "text", cache=held.read(spark)))
    return held.read(spark).drop("vector")


@query()
def encode_hashing(spark, d):
    rows = encoding.embed(read(spark, d, "documents").select("doc_id", "text"), encoding.EmbeddingModel(), text="text")
    return rows.select("doc_id", F.size("embedding").alias("dimension"), F.round(V.inner_product(F.col("embedding"), F.col("embedding")), 3).alias("length"))


# --- entities and graph -------------------------------------------------------------------------


def _chunks(spark, d):
    each = read(spark, d, "documents").select("doc_id", F.posexplode(packing.pack_fold(T.sentences(F.col("text")))).alias("chunk_no", "c"))
    return each.select(F.concat("doc_id", F.lit("-"), F.lpad(F.col("chunk_no").cast("string"), 5, "0")).alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("c.text").alias("texto")).withColumn("chunk_ord", F.col("chunk_id"))


def _in(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


_CAP = "[A-ZÁÉÍÓÚÜÑÇÃÕ][\\p{L}\\p{N}_-]*"
_INSIDE = " OR ".join(f"contains(' ' || o || ' ', '{a}' || x || '{b}')" for a in " -" for b in " -")


def entities_sql(texts: str, lexicon: E.Lexicon) -> str:
    """entities(chunk_id, doc_id, label, entity_type) of ``texts`` (chunk_id, doc_id, text)."""
    return f"""c AS (SELECT *, list_filter([{_in(lexicon.concepts)}], lambda p: contains(lower(text), p)) AS concepts,
  list_distinct(list_filter(list_transform(regexp_extract_all(text, '(?:^|[^\\p{{L}}\\p{{N}}_])({_CAP}(?:\\s+{_CAP}){{0,5}})', 1), lambda s: regexp_replace(regexp_replace(lower(nfc_normalize(s)), '-+$', ''), '\\s+', ' ', 'g')), lambda s: length(s) > 2 AND s NOT IN ({_in(lexicon.not_entities)}))) AS names FROM {texts}),
l AS (SELECT *, list_distinct(list_concat(concepts, names)) AS labels FROM c),
k AS (SELECT chunk_id, doc_id, concepts, unnest(list_filter(labels, lambda x: contains(x, ' ') OR len(list_filter(labels, lambda o: o <> x AND ({_INSIDE}))) = 0)) AS label FROM l),
entities AS (SELECT chunk_id, doc_id, label, CASE WHEN list_contains(concepts, label) THEN 'concept' WHEN {" OR ".join(f"contains(label, '{p}')" for p in lexicon.organisation_parts)} THEN 'organization' ELSE 'entity' END AS entity_type FROM k)
"""


_ENTITIES = packing_sql(360, 480) + ", t AS (SELECT doc_id || '-' || lpad(chunk_no::VARCHAR, 5, '0') AS chunk_id, doc_id::VARCHAR AS doc_id, text FROM chunks), " + entities_sql("t", TEST_LEXICON)


def _tagged(spark, d):
    return E.with_entities(_chunks(spark, d), lexicon=TEST_LEXICON)


@query(_ENTITIES + "SELECT chunk_id, label, entity_type FROM entities")
def graph_entities(spark, d):
    return _tagged(spark, d).select("chunk_id", F.explode("entities").alias("e")).select("chunk_id", "e.label", "e.entity_type")


@query(_ENTITIES + "SELECT label, count(*) AS mentions, arg_min(entity_type, chunk_id) AS entity_type FROM entities GROUP BY label")
def graph_mentions(spark, d):
    return graph.mentions(_tagged(spark, d))


# texts with a known phrase each, and with letters that composition changes
_PHRASED = f"WITH t AS (SELECT doc_id::VARCHAR AS chunk_id, doc_id::VARCHAR AS doc_id, replace(coalesce(text, ''), 'o', chr(8057)) || '. ' || upper(list_extract([{_in(E.DEFAULT.concepts)}], (doc_id % {len(E.DEFAULT.concepts)})::INT + 1)) AS text FROM documents), "


@query(_PHRASED + entities_sql("t", E.DEFAULT) + "SELECT chunk_id, label, entity_type FROM entities")
def graph_entities_known(spark, d):
    """The default lexicon over whole texts, each with one of its phrases at the end."""
    phrase = F.element_at(F.array(*map(F.lit, E.DEFAULT.concepts)), (F.col("doc_id") % len(E.DEFAULT.concepts)).cast("int") + 1)
    text = F.concat(F.replace(F.coalesce("text", F.lit("")), F.lit("o"), F.lit(chr(8057))), F.lit(". "), F.upper(phrase))
    rows = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), text.alias("texto"))
    return E.with_entities(rows).select("chunk_id", F.explode("entities").alias("e")).select("chunk_id", "e.label", "e.entity_type")


_RELATIONS = _ENTITIES + rf""", x AS (SELECT chunk_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM t),
y AS (SELECT *, row_number() OVER () AS sentence, lower(regexp_replace(trim(s, ' ,;:()[]{{}}"' || chr(39)), '\s+', ' ', 'g')) AS norm, regexp_extract(s, '(?is)^(|.*?[^\p{{L}}\p{{N}}_])({TEST_LEXICON.triggers})(?:$|[^\p{{L}}\p{{N}}_])', ['before', 'word']) AS m FROM x),
z AS (SELECT y.chunk_id, sentence, m.word AS word, length(m.before) AS a, length(m.before) + length(m.word) AS b, label, instr(norm, label) - 1 AS p FROM y JOIN entities USING (chunk_id) WHERE m.word <> '' AND contains(norm, label)),
w AS (
  SELECT chunk_id, lower(word) AS relation, coalesce(arg_min(label, (-p, label)) FILTER (WHERE p < a), min(label)) AS subject, coalesce(arg_min(label, (p, label)) FILTER (WHERE p >= b), max(label)) AS object
  FROM z GROUP BY chunk_id, sentence, word, a, b HAVING count(*) >= 2
)
SELECT DISTINCT chunk_id, subject, relation, object FROM w WHERE subject <> object"""


@query(_RELATIONS)
def graph_relations(spark, d):
    return E.relations(_tagged(spark, d), lexicon=TEST_LEXICON).select("chunk_id", "subject", "relation", "object")


# order lines as facts: a part relates to a supplier by the month of shipping
_FACTS = "facts AS (SELECT l_orderkey * 10 + l_linenumber AS chunk_ord, 'd' || l_orderkey % 211 AS doc_id, 'c' || l_orderkey AS chunk_id, 'p' || l_partkey % 50 AS subject, 'm' || month(l_shipdate) AS relation, 's' || l_suppkey % 40 AS object FROM lineitem)"
_LABELS = "labels AS (SELECT label, count(*) AS mentions, arg_min(kind, chunk_ord) AS entity_type FROM (SELECT DISTINCT chunk_ord, label, kind FROM (SELECT chunk_ord, subject AS label, 'concept' AS kind FROM facts UNION ALL SELECT chunk_ord, object, 'entity' FROM facts)) GROUP BY label)"
_TRIPLES = "triples AS (SELECT subject, relation, object, count(*) AS evidence_count, string_agg(DISTINCT doc_id, ';' ORDER BY doc_id) AS doc_ids, string_agg(DISTINCT chunk_id, ';' ORDER BY chunk_id) AS chunk_ids, min(chunk_ord) AS first_ord FROM facts GROUP BY ALL)"
_LEAST = "(SELECT quantile_disc(mentions, 0.3) FROM labels)"
_EDGES = f"kept AS (SELECT * FROM triples WHERE subject IN (SELECT label FROM labels WHERE mentions >= {_LEAST}) AND object IN (SELECT label FROM labels WHERE mentions >= {_LEAST})), edges AS (SELECT subject, object, arg_max(relation, (first_ord, relation)) AS relation, arg_max(evidence_count, (first_ord, relation)) AS evidence_count, arg_max(doc_ids, (first_ord, relation)) AS doc_ids, arg_max(chunk_ids, (first_ord, relation)) AS chunk_ids FROM kept GROUP BY ALL)"


def _facts(spark, d):
    return read(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("chunk_ord"),
        F.concat(F.lit("d"), F.col("l_orderkey") % 211).alias("doc_id"),
        F.concat(F.lit("c"), "l_orderkey").alias("chunk_id"),
        F.concat(F.lit("p"), F.col("l_partkey") % 50).alias("subject"),
        F.concat(F.lit("m"), F.month("l_shipdate")).alias("relation"),
        F.concat(F.lit("s"), F.col("l_suppkey") % 40).alias("object"),
    )


def _labels(facts):
    typed = F.array(F.struct(F.col("subject").alias("label"), F.lit("concept").alias("entity_type")), F.struct(F.col("object").alias("label"), F.lit("entity").alias("entity_type")))
    # dealt before the structs are made, which are several times as large; the few labels are read again and again
    each = facts.select("chunk_ord", "subject", "object").repartition("chunk_ord").select("chunk_ord", F.explode(typed).alias("e"))
    return shared.checkpointed(graph.mentions(each.groupBy("chunk_ord").agg(F.collect_set("e").alias("entities"))))


def _least(labels) -> int:
    return labels.agg(F.expr("percentile_disc(0.3) WITHIN GROUP (ORDER BY mentions)")).first()[0]


@query(f"WITH {_FACTS}, {_TRIPLES} SELECT subject, relation, object, evidence_count, doc_ids, chunk_ids FROM triples")
def graph_triples(spark, d):
    return graph.with_ids(_facts(spark, d), *graph.TRIPLE)


@query(f"WITH {_FACTS}, {_LABELS}, {_TRIPLES}, {_EDGES} SELECT 'entity:' || subject AS src, 'entity:' || object AS dst, relation, evidence_count, doc_ids, chunk_ids FROM edges")
def graph_edges_collapsed(spark, d):
    return graph.edge_rows(_edges(spark, d), _facts(spark, d))


@query(f"WITH {_FACTS}, {_LABELS}, {_TRIPLES} SELECT 'entity:' || label AS id, label, entity_type, mentions FROM labels WHERE mentions >= {_LEAST} AND label IN (SELECT subject FROM triples UNION ALL SELECT object FROM triples)")
def graph_nodes_active(spark, d):
    facts = _facts(spark, d)
    labels = _labels(facts)
    return graph.nodes(labels, graph.triples(facts), int(_least(labels)))


# queries: each order whose key is divisible by 20 asks for the parts and the suppliers of its lines
_ASKED = "asked AS (SELECT DISTINCT 'q' || l_orderkey AS query_id, unnest(['p' || l_partkey % 50, 's' || l_suppkey % 40]) AS label FROM lineitem WHERE l_orderkey % 20 = 0)"
_SCORES = f"WITH {_FACTS}, {_LABELS}, {_TRIPLES}, {_EDGES}, {_ASKED}, m AS (SELECT DISTINCT a.query_id, e.subject, e.object, e.evidence_count, e.chunk_ids FROM asked a JOIN edges e ON a.label = e.subject OR a.label = e.object), x AS (SELECT query_id, evidence_count, unnest(string_split(chunk_ids, ';')) AS chunk_id FROM m) SELECT query_id, chunk_id, sum(evidence_count)::BIGINT AS graph_score FROM x GROUP BY ALL"


def _asked(spark, d):
    lines = read(spark, d, "lineitem").where("l_orderkey % 20 = 0")
    return lines.select(F.concat(F.lit("q"), "l_orderkey").alias("query_id"), F.explode(F.array(F.concat(F.lit("p"), F.col("l_partkey") % 50), F.concat(F.lit("s"), F.col("l_suppkey") % 40))).alias("label")).distinct()


def _edges(spark, d):
    facts = _facts(spark, d)
    labels = _labels(facts)
    return shared.checkpointed(graph.edges(labels, graph.triples(facts), int(_least(labels))))


@query(_SCORES)
def graph_chunk_scores(spark, d):
    found = _edges(spark, d)
    ends = found.select(graph.entity("subject").alias("src"), graph.entity("object").alias("dst"))
    return graph.chunk_scores(_asked(spark, d), graph.edge_ends(ends), graph.edge_evidence(found, _facts(spark, d)))


@query(_SCORES)
def graph_chunk_scores_scan(spark, d):
    return graph.scan_chunk_scores(_asked(spark, d), graph.edge_rows(_edges(spark, d), _facts(spark, d)))


# --- checks -------------------------------------------------------------------------------------

_RECORDS = """r AS (SELECT doc_id AS chunk_ord, CASE WHEN doc_id % 19 = 0 THEN '' ELSE 'D' || doc_id END AS doc_id, 'c' || (doc_id // 2) AS chunk_id, CASE WHEN doc_id % 23 <> 0 THEN source END AS fuente, 'txt' AS formato, (doc_id % 5)::INT AS fenomeno,
  (doc_id - 3)::INT AS posicion, (n_chars // 6)::INT AS num_tokens, CASE WHEN doc_id % 29 = 0 THEN '  ' ELSE text END AS texto FROM documents)"""


def _records(spark, d):
    return read(spark, d, "documents").select(
        F.col("doc_id").alias("chunk_ord"),
        F.when(F.col("doc_id") % 19 == 0, F.lit("")).otherwise(F.concat(F.lit("D"), "doc_id")).alias("doc_id"),
        F.concat(F.lit("c"), F.floor(F.col("doc_id") / 2)).alias("chunk_id"),
        F.when(F.col("doc_id") % 23 != 0, F.col("source")).alias("fuente"),
        F.lit("txt").alias("formato"),
        (F.col("doc_id") % 5).cast("int").alias("fenomeno"),
        (F.col("doc_id") - 3).cast("int").alias("posicion"),
        F.floor(F.col("n_chars") / 6).cast("int").alias("num_tokens"),
        F.when(F.col("doc_id") % 29 == 0, F.lit("  ")).otherwise(F.col("text")).alias("texto"),
    )


_FAULTS = """
SELECT chunk_ord, unnest(list_filter([
  CASE WHEN doc_id = '' THEN 'doc_id' END, CASE WHEN fuente IS NULL THEN 'fuente' END, CASE WHEN trim(texto) = '' THEN 'texto' END,
  CASE WHEN fenomeno NOT IN (1, 2, 3) THEN 'fenomeno' END, CASE WHEN posicion < 0 THEN 'posicion' END, CASE WHEN num_tokens <= 0 OR num_tokens > 480 THEN 'num_tokens' END,
  CASE WHEN n > 1 THEN 'chunk_id_duplicate' END], lambda x: x IS NOT NULL)) AS error FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY chunk_ord) AS n FROM r)"""


@query(f"WITH {_RECORDS} {_FAULTS}")
def validate_chunks(spark, d):
    return quality.validate_chunks(_records(spark, d))


@query(f"WITH {_RECORDS}, e AS ({_FAULTS}) SELECT chunk_ord AS line, error FROM e UNION ALL SELECT chunk_ord, 'missing:fuente' FROM r WHERE fuente IS NULL")
def validate_metadata(spark, d):
    rows = _records(spark, d)
    lines = rows.select(F.col("chunk_ord").alias("line"), F.to_json(F.struct(*(c for c in rows.columns if c != "chunk_ord"))).alias("value"))
    return quality.validate_metadata(lines)


_WORDS = "len(regexp_extract_all(text, '\\S+'))"


@query(
    f"""WITH r AS (SELECT doc_id AS line, doc_id % 43 = 0 AS broken, CASE WHEN doc_id % 31 = 0 THEN '' WHEN doc_id % 33 <> 1 THEN 'c' || doc_id // 2 END AS chunk_id, CASE WHEN doc_id % 37 = 0 THEN '' WHEN doc_id % 41 <> 0 THEN 'txt' END AS formato,
  {_WORDS} AS n, {_WORDS} + (doc_id % 7 = 0)::INT AS num_tokens FROM documents WHERE text IS NOT NULL AND trim(text) <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY broken, chunk_id ORDER BY line) AS k FROM r)
SELECT line, unnest(CASE WHEN broken THEN ['json'] ELSE list_filter([
  'missing:' || nullif(concat_ws(',', CASE WHEN chunk_id IS NULL THEN 'chunk_id' END, CASE WHEN formato IS NULL THEN 'formato' END), ''), CASE WHEN coalesce(chunk_id, '') = '' THEN 'chunk_id' END, CASE WHEN coalesce(formato, '') = '' THEN 'formato' END,
  CASE WHEN num_tokens NOT BETWEEN 1 AND 480 THEN 'num_tokens' END, CASE WHEN n <> num_tokens THEN 'num_tokens_differ' END, CASE WHEN k > 1 THEN 'chunk_id_duplicate' END], lambda x: x IS NOT NULL) END) AS error FROM k"""
)
def validate_metadata_recount(spark, d):
    """Raw lines, some broken, some without or with an empty chunk_id or formato, whose tokens are counted again."""
    key = F.col("doc_id")
    n = T.word_count(F.col("text"))
    record = F.struct(
        F.concat(F.lit("D"), key).alias("doc_id"),
        F.when(key % 31 == 0, F.lit("")).when(key % 33 != 1, F.concat(F.lit("c"), F.floor(key / 2))).alias("chunk_id"),
        F.col("source").alias("fuente"),
        F.when(key % 37 == 0, F.lit("")).when(key % 41 != 0, F.lit("txt")).alias("formato"),
        F.lit(1).alias("fenomeno"),
        F.lit(0).alias("posicion"),
        (n + F.when(key % 7 == 0, 1).otherwise(0)).alias("num_tokens"),
        F.col("text").alias("texto"),
    )
    docs = read(spark, d, "documents").where("text IS NOT NULL AND trim(text) <> ''")
    lines = docs.select(key.alias("line"), F.when(key % 43 == 0, F.lit("{broken")).otherwise(F.to_json(record)).alias("value"))
    return quality.validate_metadata(lines, count=packing.count_words)


@query(
    """WITH r AS (SELECT c_custkey AS line, c_custkey % 7 AS a, c_custkey % 5 AS b, c_custkey % 3 AS c FROM customer)
SELECT line, unnest(list_filter([CASE WHEN a = 0 OR b = 0 THEN 'sizes' END, CASE WHEN a = 0 THEN 'document_ranks' END, CASE WHEN b = 0 THEN 'fragment_ranks' END, CASE WHEN a = 1 THEN 'documents_repeat' END, CASE WHEN b = 1 THEN 'fragment_too_long' END, CASE WHEN c = 0 THEN 'fragment_incomplete' END], lambda x: x IS NOT NULL)) AS error FROM r"""
)
def validate_results(spark, d):
    key = F.col("c_custkey")
    documents = F.transform(F.sequence(F.lit(1), F.when(key % 7 == 0, F.lit(2)).otherwise(F.lit(3))), lambda k: F.struct(k.alias("rank"), F.concat(F.lit("d"), F.when((key % 7 == 1) & (k == 3), F.lit(1)).otherwise(k)).alias("doc_id")))
    text = lambda k: F.when((key % 5 == 1) & (k == 4), F.repeat(F.lit("w "), 251)).otherwise(F.lit("a b"))
    frags = F.transform(F.sequence(F.lit(1), F.when(key % 5 == 0, F.lit(9)).otherwise(F.lit(10))), lambda k: F.struct(F.concat(F.lit("c"), k).alias("chunk_id"), F.when((key % 3 != 0) | (k != 2), F.lit("d1")).alias("doc_id"), text(k).alias("text"), k.alias("rank")))
    rows = read(spark, d, "customer").select(key.alias("line"), F.lit("q").alias("query_id"), documents.alias("documents"), frags.alias("fragments"))
    return quality.validate_results(rows, official=False)


_OFFICIAL = """WITH r AS (SELECT c_custkey AS line, c_custkey % 4 AS a, c_custkey % 3 AS b FROM customer)
SELECT 0::BIGINT AS line, 'line_count' AS error FROM (SELECT count(*) AS n FROM r) WHERE n <> 50
UNION ALL SELECT line, 'query_id' FROM r WHERE a = 0
UNION ALL SELECT line, 'unknown_chunk' FROM r
UNION ALL SELECT line, 'chunk_of_other_document' FROM r
UNION ALL SELECT line, 'chunk_of_other_document' FROM r
UNION ALL SELECT line, 'unknown_fragment_document' FROM r WHERE b = 1
UNION ALL SELECT line, 'chunk_of_other_document' FROM r WHERE b = 1
UNION ALL SELECT line, 'unknown_document' FROM r"""


@query(_OFFICIAL)
def validate_results_official(spark, d):
    """Names of queries and the number of lines, and ids looked up in known chunks: c2 is another document's, c7 is unknown, d3 is no document."""
    key = F.col("c_custkey")
    documents = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.struct(k.alias("rank"), F.concat(F.lit("d"), k).alias("doc_id")))
    doc = lambda k: F.when((key % 3 == 1) & (k == 4), F.lit("d9")).otherwise(F.lit("d1"))
    frags = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: F.struct(F.concat(F.lit("c"), k).alias("chunk_id"), doc(k).alias("doc_id"), F.lit("a b").alias("text"), k.alias("rank")))
    name = F.when(key % 4 == 0, F.lit("q")).otherwise(F.format_string("q%03d", key))
    rows = read(spark, d, "customer").select(key.alias("line"), name.alias("query_id"), documents.alias("documents"), frags.alias("fragments"))
    chunks = spark.range(1, 11).where("id <> 7").select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.when(F.col("id") == 2, F.lit("d2")).otherwise(F.lit("d1")).alias("doc_id"))
    return quality.validate_results(rows, True, chunks)
