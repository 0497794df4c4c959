"""Exact and hybrid search, batched over all queries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vectors as V
from docloom.operators.packing import MAX_WORDS, presentation_texts
from docloom.sources.shared import checkpointed

QUERY_BLOCK = 2048
#: Of the column method: vectors for each hit sought in the first round, at least; times what all rounds up to one have of those before it.
FIRST, WIDER = 4, 4
#: Elements that a vector may have whose elements are made columns.
WIDE = 256
LEAST_DOUBLE = 5e-324
#: Bytes of vectors that one task multiplies, and queries that read past one copy of a block.
BLOCK_BYTES, ASKED_TOGETHER = 32_000_000, 20_000
#: Products that a task holds at a time, whatever the sizes of blocks and batches.
PRODUCTS = 2_000_000
AGGREGATIONS = ("max", "top2sum", "mean")
TOP_DOCUMENTS, TOP_FRAGMENTS, GRAPH_WEIGHT = 3, 10, 0.0025


def _scored(names: pa.Array, queries: np.ndarray, ids: pa.Array, vectors: np.ndarray, k: int) -> pa.RecordBatch:
    """The best k of some vectors, whose ids ascend, for each query; ties to the smaller id."""
    score = queries @ vectors.T
    if k < len(ids):
        least = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
        row, at = np.nonzero(score >= least[:, None])  # with what ties with the last
        order = np.lexsort((at, -score[row, at], row))
        row, at = row[order], at[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, at = row[keep], at[keep]
    else:
        row, at = (x.ravel() for x in np.indices(score.shape))
    return pa.RecordBatch.from_arrays([names.take(pa.array(row)), ids.take(pa.array(at)), pa.array(score[row, at])], names=["query_id", "chunk_ord", "score"])


def _meet(k: int):
    """Rows sorted by block and salt, the vectors of each before the queries that ask it: the best k of the block for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "salt", "asks")]
            new = np.zeros(batch.num_rows, dtype=bool)
            new[0] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            for a, b in zip(first.tolist(), np.append(first[1:], batch.num_rows).tolist(), strict=True):
                part = batch.slice(a, b - a)
                rows = np.asarray(part.column("embedding").flatten()).reshape(b - a, -1)
                if (here := (columns[0][a], columns[1][a])) != key:
                    key, ids, parts = here, [], []
                if not columns[2][a]:
                    ids.append(part.column("chunk_ord"))
                    parts.append(rows)
                elif ids:
                    if len(parts) > 1:
                        ids, parts = [pa.concat_arrays(ids)], [np.concatenate(parts)]
                    names, step = part.column("query_id"), max(1, PRODUCTS // len(ids[0]))
                    for c in range(0, b - a, step):
                        yield _scored(names.slice(c, step), rows[c : c + step], ids[0], parts[0], k)

    return run


@dataclass(frozen=True)
class Block:
    number: int
    rows: float  # about
    top: float  # the largest norm in it


def _norm() -> Column:
    return F.sqrt(V.inner_product(F.col("embedding"), F.col("embedding")))


def blocked(base: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[Block]]:
    """The vectors with the number of their block, and the blocks.

    Vectors are classed by the logarithm of their norm, so that those of a block are of
    about one length, and a class is dealt to as many blocks as its bytes need. What the
    driver gets is a row for each class: four to an octave, some thousands at most.
    """
    classed = base.withColumn("norm", _norm()).withColumn("class", F.coalesce(F.floor(F.log2("norm") * 4), F.lit(-(2**20))).cast("long"))
    sizes = classed.groupBy("class").agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.max(F.size("embedding")).alias("width")).collect()
    blocks, first = [], {}
    for x in sizes:
        slots = max(1, -(-x["n"] * x["width"] * 8 // block_bytes))
        first[x["class"]] = (len(blocks), slots)
        blocks += [Block(len(blocks) + k, x["n"] / slots, x["top"]) for k in range(slots)]
    if len(blocks) < 2:
        return base.withColumn("block", F.lit(0)), blocks
    dealt = F.create_map(*(F.lit(x) for c, (at, slots) in first.items() for x in (c, f"{at} {slots}")))
    place = F.split(dealt[F.col("class")], " ").cast("array<int>")
    return classed.withColumn("block", place[0] + F.pmod(F.xxhash64("chunk_ord"), place[1]).cast("int")).drop("norm", "class"), blocks


def surviving(asked: DataFrame, best: DataFrame, others: list[Block], k: int) -> DataFrame:
    """The queries with each other block that can hold one of their best k.

    No product in a block exceeds the query's norm times the block's largest, so a block
    below the k-th best of the first is left out.
    """
    least = best.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    tops = F.array(*(F.struct(F.lit(b.number).alias("block"), F.lit(float(b.top)).alias("top")) for b in others))
    reached = F.filter(tops, lambda b: F.col("least").isNull() | (F.col("norm") * b["top"] * F.lit(1 + 1e-9) >= F.col("least")))
    return asked.withColumn("norm", _norm()).join(least, "query_id", "left").select("salt", "query_id", "embedding", F.explode(reached["block"]).alias("block"))


def knn(vectors: DataFrame, queries: DataFrame, k: int, method: str = "matrix", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, chunk_ord, score, hit_rank: the k largest inner products of each query, ties to the smaller chunk_ord.

    ``vectors`` has chunk_ord (an integer or string that names a chunk) and embedding,
    ``queries`` query_id (string) and embedding. "matrix" deals vectors to blocks by
    norm. Every query meets the block of the longest vectors that has several times k of them, and then those whose bound
    reaches the k-th product found there. Queries and blocks meet by a shuffle, sorted so
    that a task holds one block and reads the queries past it; so many queries that one
    task should not read them all go to copies of the block. "columns" makes every product
    in column functions, in blocks of queries, and ranks those that can still be hits.
    """
    kind = "string" if vectors.schema["chunk_ord"].dataType.simpleString() == "string" else "bigint"
    base = vectors.select(F.col("chunk_ord").cast(kind).alias("chunk_ord"), V.as_double(F.col("embedding")).alias("embedding"))
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), V.as_double(F.col("embedding")).alias("embedding"))
    if method == "matrix":
        out = _knn_matrix(base, asked, k, kind, block_bytes)
    elif method == "columns":
        out = _knn_columns(base, asked, k)
    else:
        raise ValueError("method must be matrix or columns")
    return _ranked(out, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_ord")
    return found.withColumn("hit_rank", F.row_number().over(best)).where(F.col("hit_rank") <= k)


def _knn_matrix(base: DataFrame, asked: DataFrame, k: int, kind: str, block_bytes: int) -> DataFrame:
    rows, blocks = blocked(base, block_bytes)
    salts = -(-asked.count() // ASKED_TOGETHER)
    schema = f"query_id string, chunk_ord {kind}, score double"
    if not blocks or not salts:
        return base.sparkSession.createDataFrame([], schema)
    salted = asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(salts)).cast("int"))

    def met(held: DataFrame, pairs: DataFrame) -> DataFrame:
        """The best k of each block for the queries (block, salt, query_id, embedding) that ask it."""
        given = held.select("block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(False).alias("asks"), "chunk_ord", F.lit(None).cast("string").alias("query_id"), "embedding")
        asks = pairs.select("block", "salt", F.lit(True).alias("asks"), F.lit(None).cast(kind).alias("chunk_ord"), "query_id", "embedding")
        both = given.unionByName(asks).repartition("block", "salt").sortWithinPartitions("block", "salt", "asks", "chunk_ord")
        return both.mapInArrow(_meet(k), schema)

    first = max(blocks, key=lambda b: (b.rows >= 4 * k, b.top))
    best = met(rows.where(F.col("block") == first.number), salted.withColumn("block", F.lit(first.number)))
    others = [b for b in blocks if b is not first]
    if not others:
        return best
    pairs = surviving(salted, best, others, k)
    return best.unionByName(met(rows.join(pairs.select("block").distinct(), "block", "left_semi"), pairs))


def _rounds(n: int, k: int) -> list[tuple[int | None, int | None]]:
    """Ranges of a 64-bit hash that part the vectors into rounds: up to each there are ``WIDER`` times as many as before it."""
    ends: list[int | None] = [None]
    share = 1 / WIDER
    while n * share >= FIRST * max(k, 1):
        ends.insert(0, int(share * 2**64) - 2**63)
        share /= WIDER
    return list(zip([None, *ends[:-1]], ends, strict=True))


def _plain_width(*frames: DataFrame) -> int | None:
    """The number of elements of every vector, if it is one number, not large, and none is null."""
    found = set()
    for frame in frames:
        gap = F.coalesce(F.exists("embedding", lambda x: x.isNull()), F.lit(True))
        found |= set(frame.agg(F.min(F.size("embedding")), F.max(F.size("embedding")), F.when(F.max(gap), F.lit(-1))).first()) - {None}
    return found.pop() if len(found) == 1 and 0 < min(found) <= WIDE else None


def _knn_columns(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Rows among which are the best k of each query, of all its products.

    Vectors come in rounds, by a hash of their ids. A product is kept only if it comes
    before the k-th best of the rounds up to then, which leaves each round about
    (``WIDER`` - 1) * k rows a query, whatever the number of vectors. Where all vectors
    have the same few elements, the product is one compiled expression, which sums in
    the order of ``inner_product``.
    """
    n, asking = base.count(), asked.count()
    blocks = max(1, -(-asking // QUERY_BLOCK))
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = base.schema["chunk_ord"].dataType.simpleString()
    width = _plain_width(base, asked) if n and asking else None
    if width is None:
        product = V.inner_product(F.col("embedding"), F.col("q"))
        held_columns, asked_columns = [F.col("embedding")], [F.col("embedding").alias("q")]
    else:
        product = F.lit(0.0)
        for i in range(width):
            product = product + F.col(f"e{i}") * F.col(f"q{i}")
        held_columns, asked_columns = ([F.coalesce(F.get("embedding", F.lit(i)), F.lit(0.0)).alias(f"{x}{i}") for i in range(width)] for x in "eq")
    place = F.xxhash64("chunk_ord")
    best = None
    for start, end in _rounds(n, k):
        held = base if start is None else base.where(place >= start)
        # far more comes out than goes in: tasks are not to be merged by what they read
        held = (held if end is None else held.where(place < end)).repartition(tasks).select("chunk_ord", *held_columns)
        if best is None:
            bound = asked.select("query_id", *asked_columns, F.lit(None).cast("double").alias("least"), F.lit(None).cast(kind).alias("last"))
        else:
            last = best.where(F.col("hit_rank") == k).select("query_id", F.col("score").alias("least"), F.col("chunk_ord").alias("last"))
            bound = asked.join(last, "query_id", "left").select("query_id", *asked_columns, "least", "last")
        # above it, or for smaller ids not below it, in one comparison
        reaches = F.col("least").isNull() | (product - F.col("least") > F.when(F.col("chunk_ord") < F.col("last"), F.lit(-LEAST_DOUBLE)).otherwise(F.lit(0.0)))
        out = None if best is None else best.drop("hit_rank")
        for b in range(blocks):
            part = bound.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
            scored = held.join(F.broadcast(part), reaches).select("query_id", "chunk_ord", product.alias("score"))
            out = scored if out is None else out.unionByName(scored)
        if end is not None:
            best = checkpointed(_ranked(out, k))  # read by the next round's bounds and hits
    return out


def fuse(hits: DataFrame, graph_scores: DataFrame | None, chunks: DataFrame, weight: float = GRAPH_WEIGHT) -> DataFrame:
    """query_id, chunk_id, doc_id, score, hit_rank: vector hits and graph scores together.

    ``hits`` has query_id, chunk_id, doc_id, score, hit_rank. Known chunks that only
    the graph finds start at 0. Without a graph the hits keep their order.
    """
    if weight < 0:
        raise ValueError("the graph weight must not be negative")
    if graph_scores is None:
        return hits.select("query_id", "chunk_id", "doc_id", "score", "hit_rank")
    known = graph_scores.join(chunks.select("chunk_id", F.col("doc_id").alias("_doc")), "chunk_id")
    both = hits.join(known, ["query_id", "chunk_id"], "full_outer")
    scored = both.select(
        "query_id",
        "chunk_id",
        F.coalesce("doc_id", "_doc").alias("doc_id"),
        V.fused_score(F.coalesce("score", F.lit(0.0)), F.col("graph_score"), weight).alias("score"),
        F.coalesce(F.col("hit_rank").cast("long"), F.lit(2**62)).alias("_source"),
    )
    # graph-only hits have no order of their own: they follow by chunk_id
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "_source", "chunk_id")
    return scored.withColumn("hit_rank", F.row_number().over(order)).drop("_source")


def fused_first(hits: DataFrame, asks: DataFrame, graph_scores: DataFrame, chunks: DataFrame, k: int, most: int, weight: float = GRAPH_WEIGHT) -> DataFrame:
    """The first ``k`` rows of each query that ``fuse`` makes, with their ``hit_rank``, without the others.

    ``asks`` has query_id and graph, ``graph_scores`` graph, chunk_id and graph_score:
    queries that ask for the same share a graph, and its scores are not repeated for each.
    A query has ``most`` hits at most, so that its first chunks that only the graph finds
    are among the graph's first ``k + most``.
    """
    known = graph_scores.join(chunks.select("chunk_id", F.col("doc_id").alias("_doc")), "chunk_id")
    near = hits.join(asks, "query_id", "left").join(known, ["graph", "chunk_id"], "left")
    near = near.select("query_id", "chunk_id", "doc_id", V.fused_score(F.col("score"), F.col("graph_score"), weight).alias("score"), F.col("hit_rank").cast("long").alias("_source"))
    alone = known.select("graph", "chunk_id", F.col("_doc").alias("doc_id"), V.fused_score(F.lit(0.0), F.col("graph_score"), weight).alias("score"))
    best = alone.withColumn("n", F.row_number().over(Window.partitionBy("graph").orderBy(F.desc("score"), "chunk_id"))).where(F.col("n") <= k + most)
    far = asks.join(best, "graph").select("query_id", "chunk_id", "doc_id", "score", F.lit(2**62).alias("_source"))
    both = near.unionByName(far).repartition("query_id")
    # what is also a hit counts as one
    once = both.withColumn("_first", F.min("_source").over(Window.partitionBy("query_id", "chunk_id"))).where("_source = _first").drop("_first")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "_source", "chunk_id")
    return once.withColumn("hit_rank", F.row_number().over(order)).where(F.col("hit_rank") <= k).drop("_source")


def document_scores(hits: DataFrame, aggregation: str = "max") -> DataFrame:
    """query_id, doc_id, doc_score, first_rank over all hits of a document."""
    if aggregation == "max":
        score = F.max("score")
    elif aggregation == "top2sum":
        score = F.aggregate(F.slice(F.sort_array(F.collect_list("score"), asc=False), 1, 2), F.lit(0.0), lambda s, x: s + x)
    elif aggregation == "mean":
        score = F.avg("score")
    else:
        raise ValueError(f"aggregation must be one of {AGGREGATIONS}")
    return hits.groupBy("query_id", "doc_id").agg(score.alias("doc_score"), F.min("hit_rank").alias("first_rank"))


def top_documents(hits: DataFrame, aggregation: str = "max", k: int = TOP_DOCUMENTS) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("doc_score"), "first_rank")
    return document_scores(hits, aggregation).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "doc_score")


def has_fragments(units: Column, max_words: int = MAX_WORDS) -> Column:
    """Whether ``presentation_texts`` makes any text of the units."""
    return T.let(units, lambda given: (F.size(given) > 0) & ~F.exists(given, lambda u: T.word_count(u) > max_words))


def fragments(hits: DataFrame, k: int = TOP_FRAGMENTS, max_words: int = MAX_WORDS) -> DataFrame:
    """query_id, rank, chunk_id, doc_id, text: the first k presentation texts in hit order (query_id, chunk_id, doc_id, hit_rank, texto)."""
    # a chunk is cut once, whatever the number of queries that found it
    cut = hits.select("chunk_id", "texto").dropDuplicates(["chunk_id"]).select("chunk_id", presentation_texts(T.sentences(F.col("texto")), max_words).alias("texts"))
    held = hits.select("query_id", "chunk_id", "doc_id", "hit_rank").join(cut.where(F.size("texts") > 0), "chunk_id")
    earlier = Window.partitionBy("query_id").orderBy("hit_rank").rowsBetween(Window.unboundedPreceding, -1)
    needed = held.withColumn("before", F.coalesce(F.sum(F.size("texts")).over(earlier), F.lit(0))).where(F.col("before") < k)
    texts = needed.select("query_id", "chunk_id", "doc_id", "before", F.posexplode("texts").alias("pos", "text"))
    return texts.withColumn("rank", (F.col("before") + F.col("pos") + 1).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "chunk_id", "doc_id", "text")


def query_text(queries: DataFrame) -> DataFrame:
    """query_id, query: the first of query, text and consulta that is not empty; none at all is an error."""
    given = [F.nullif(F.col(c), F.lit("")) for c in ("query", "text", "consulta") if c in queries.columns]
    return queries.select("query_id", F.coalesce(*given, F.raise_error(F.concat(F.lit("query without text: "), F.col("query_id"))).cast("string")).alias("query"))


def search(index: DataFrame, queries: DataFrame, candidates: int = 100, top_chunks: int = 10, aggregation: str = "max", graph_scores: DataFrame | None = None, weight: float = GRAPH_WEIGHT) -> tuple[DataFrame, DataFrame]:
    """(documents, hits) of all queries.

    ``index`` has chunk_ord, chunk_id, doc_id, texto and embedding; ``queries``
    query_id and embedding; ``graph_scores`` is from ``graph.chunk_scores``.
    """
    near = knn(index, queries, candidates).join(index.select("chunk_ord", "chunk_id", "doc_id"), "chunk_ord")
    fused = fuse(near, graph_scores, index, weight)
    found = fused.where(F.col("hit_rank") <= top_chunks).join(index.select("chunk_id", "texto"), "chunk_id")
    return top_documents(fused, aggregation), found


def results(documents: DataFrame, frags: DataFrame, strict: bool = True) -> DataFrame:
    """query_id, documents, fragments as arrays by rank; ``strict``: fewer than 3 and 10 are an error."""
    docs = documents.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("documents"))
    parts = frags.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk_id", "doc_id", "text"))).alias("fragments"))
    out = docs.join(parts, "query_id", "full_outer")
    if strict:
        short = (F.coalesce(F.size("documents"), F.lit(0)) < TOP_DOCUMENTS) | (F.coalesce(F.size("fragments"), F.lit(0)) < TOP_FRAGMENTS)
        out = out.withColumn("documents", F.when(short, F.raise_error(F.lit("the index is too small for 3 documents and 10 fragments")).cast(out.schema["documents"].dataType)).otherwise(F.col("documents")))
    return out
