"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are scaled to length 1, rotated by learned orthogonal matrices
(iterative quantisation on a bounded sample: alternate between the signs of the
rotated sample and the rotation that fits them best) and cut to one bit a
dimension; several rotations, learned from different starts, are strung together
to ``BITS`` bits. The sample is the ``SAMPLE`` different vectors of least hash; all
vectors are indexed.

Index: entries are dealt to blocks of bounded size. A block's codes are split into
substrings of 16 bits, each with a table of its own in the task that holds the block.

Search: let m tables have limits t[1..m] with a sum of t[i] + 1 equal to r + 1. Two codes
that differ in at most r bits differ in at most t[i] bits of some substring i, or the
differences would add up to r + 1. So a query probes each table with every value within
t[i] of its own, and retrieves every code within the radius r. Whatever is retrieved is reranked by cosine in double precision on the original
vectors. The radius is the least with which a share of ``RECALL`` of the nearest neighbours
within the sample are retrieved. Queries that retrieve fewer vectors than they need probe
again with a wider radius, in the end all, so that none comes back short.

Equal vectors share one entry, named by its block and its place there, that keeps its
``k + 1`` least ids, which is all a query can return of them. Every query visits every
block: a task holds one block and reads a slice of the queries one after another, and a
query's ``k + 1`` best of the block are all that leaves it. What is retrieved, which grows
with the square of the input, is never kept or sent.

Defined results: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, as queries or as candidates; null ids
neither; rows that repeat an id and vector count once; ties go to the smaller id; an
empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import checkpoint

K = 5
BITS, SUBSTRING = 512, 16
SAMPLE, ROUNDS, SEED, RECALL, ASKED = 8192, 20, 7, 0.97, 2048
#: Entries of a block, and queries that read past one copy of it; about.
BLOCK_ROWS, SLICE_ROWS = 16_384, 8192
#: Queries that probe a table at a time.
TOGETHER = 32


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Rotations as columns, (dimension, bits)."""
    dimension = sample.shape[1]
    random = np.random.default_rng(seed)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        r, _ = np.linalg.qr(random.standard_normal((dimension, dimension)))
        for _ in range(rounds if len(sample) else 0):
            signs = np.where(sample @ r >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(sample.T @ signs)
            r = u @ v
        parts.append(r)
    return np.concatenate(parts, axis=1)[:, :bits]


def codes(vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """(rows, bits / 16) substrings."""
    return np.packbits(vectors @ rotation >= 0, axis=1).view(np.uint16)


def limits(radius: int, tables: int) -> np.ndarray:
    """How far each table is probed; -1: not at all."""
    return np.minimum((radius + 1) // tables - 1 + (np.arange(tables) < (radius + 1) % tables), SUBSTRING)


def fit_radius(sample: np.ndarray, rotation: np.ndarray, k: int = K, recall: float = RECALL) -> int:
    """The least radius whose probes retrieve ``recall`` of the k nearest of some sample vectors."""
    if len(sample) < 2:
        return 0
    code = codes(sample, rotation)
    asked = np.arange(0, len(sample), -(-len(sample) // ASKED))
    near = []
    for part in np.array_split(asked, -(-len(asked) // 256)):
        score = sample[part] @ sample.T
        score[np.arange(len(part)), part] = -2
        near.append(np.argpartition(-score, min(k, len(sample) - 1) - 1, axis=1)[:, : min(k, len(sample) - 1)])
    apart = ONES[code[asked][:, None, :] ^ code[np.concatenate(near)]].reshape(-1, code.shape[1])
    low, high = 0, rotation.shape[1]
    while low < high:  # what is retrieved grows with the radius
        radius = (low + high) // 2
        if (apart <= limits(radius, code.shape[1])).any(axis=1).mean() >= recall:
            high = radius
        else:
            low = radius + 1
    return low


_ONES = np.array([bin(k).count("1") for k in range(256)], dtype=np.int8)
ONES = (_ONES[:, None] + _ONES[None, :]).reshape(-1)  # of every 16-bit number
#: Every 16-bit number by its number of ones, and where each number of ones ends.
MASKS = np.argsort(ONES, kind="stable").astype(np.uint16)
WITHIN = np.cumsum(np.bincount(ONES))


class Table:
    """The postings of one substring's table."""

    def __init__(self, values: np.ndarray):
        self.order = np.argsort(values, kind="stable")
        self.values, self.first = np.unique(values[self.order], return_index=True)
        self.first = np.append(self.first, len(values))
        self.place = np.full(1 << SUBSTRING, -1, dtype=np.int32)
        self.place[self.values] = np.arange(len(self.values))

    def probe(self, value: int, limit: int) -> np.ndarray:
        """The postings whose values differ from ``value`` in at most ``limit`` bits."""
        return self.probe_each(np.array([value], dtype=np.uint16), limit)[1]

    def probe_each(self, asked: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for several values: the place of the value asked for, and the posting."""
        if limit < 0:
            return self.order[:0], self.order[:0]
        if WITHIN[limit] <= 2 * len(self.values):
            hit = self.place[MASKS[: WITHIN[limit]] ^ asked[:, None]]
            row, at = np.nonzero(hit >= 0)
            hit = hit[row, at]
        else:  # fewer values are held than there are to probe
            row, hit = np.nonzero(ONES[self.values ^ asked[:, None]] <= limit)
        size = self.first[hit + 1] - self.first[hit]
        start = np.repeat(self.first[hit] - np.cumsum(size) + size, size)
        return np.repeat(row, size), self.order[start + np.arange(len(start))]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Divided by a power of two, so that squares neither overflow nor vanish; exact."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In extended precision, rounded once at the end, so that multiples of a vector tie."""
    a, b = _scaled(query[None, :])[0].astype(np.longdouble), _scaled(vectors).astype(np.longdouble)
    return ((b * a).sum(axis=1) / np.sqrt((a * a).sum() * (b * b).sum(axis=1))).astype(np.float64)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, dimension)


class Block:
    """Vectors with an index of their codes."""

    def __init__(self, entry: np.ndarray, least: np.ndarray, vectors: np.ndarray, rotation: np.ndarray):
        self.entry, self.least, self.vectors, self.unit = entry, least, vectors, _unit(vectors)
        self.tables = [Table(c) for c in codes(self.unit, rotation).T]

        self.room = np.empty_like(self.unit)

    def retrieved(self, asked: np.ndarray, reach: list[int]) -> np.ndarray:
        """Which vectors the probes of some codes retrieve, (codes, vectors)."""
        hit = np.zeros((len(asked), len(self.entry)), dtype=bool)
        for table, values, limit in zip(self.tables, asked.T, reach, strict=True):
            hit[table.probe_each(values, limit)] = True
        return hit

    def best(self, query: np.ndarray, unit: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the ``k + 1`` best of some rows; ties to the smaller id."""
        if len(rows) > k + 1:
            score = np.take(self.unit, rows, axis=0, out=self.room[: len(rows)], mode="clip") @ unit
            rows = rows[score >= np.partition(score, len(rows) - k - 1)[len(rows) - k - 1] - 1e-12]
        exact = cosines(query, self.vectors[rows])
        # an entry has an id at least, so that k + 1 of them hold the k + 1 first ids
        first = np.lexsort((self.least[rows], -exact))[: k + 1]
        return self.entry[rows[first]], exact[first]


def _search(shared, dimension: int, reach: list[int], k: int):
    """Sorted by block and slice: the block's vectors, then the queries; the best of the block for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block = None, [], None
        for batch in batches:
            blocks, slices, asks = (np.asarray(batch.column(c)) for c in ("block", "slice", "asks"))
            entry, least, matrix = np.asarray(batch.column("entry")), np.asarray(batch.column("least")), _matrix(batch.column("vector"), dimension)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in _stretches(blocks, slices, asks):
                if (blocks[a], slices[a]) != key:
                    key, parts, block = (blocks[a], slices[a]), [], None
                if not asks[a]:
                    parts.append((entry[a:b], least[a:b], matrix[a:b]))
                    continue
                if block is None:
                    if not parts:
                        continue
                    block, parts = Block(*(np.concatenate(x) for x in zip(*parts, strict=True)), shared.value), []
                for c in range(a, b, TOGETHER):
                    asked = slice(c, min(c + TOGETHER, b))
                    unit = _unit(matrix[asked])
                    for query, row, u, hit in zip(entry[asked].tolist(), matrix[asked], unit, block.retrieved(codes(unit, shared.value), reach), strict=True):
                        found, score = block.best(row, u, np.flatnonzero(hit), k)
                        out.append((np.full(len(found), query), found, score))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query", "entry", "score"])

    return run


def _stretches(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    cut = np.flatnonzero(new) + 1
    return zip([0, *cut.tolist()], [*cut.tolist(), len(keys[0])], strict=True) if len(keys[0]) else iter(())


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _retrieve(entries: DataFrame, queries: DataFrame, rotation, dimension: int, blocks: int, radius: int, k: int) -> DataFrame:
    """(query, entry, score): the best retrieved entries of each block for each of the entries ``queries``."""
    reach = limits(radius, rotation.value.shape[1] // SUBSTRING).tolist()
    slices = max(1, -(-queries.count() // SLICE_ROWS))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    held = entries.select("block", each(slices).alias("slice"), F.lit(False).alias("asks"), "entry", F.get("ids", F.lit(0)).alias("least"), "vector")
    asked = queries.select(each(blocks).alias("block"), F.pmod(F.xxhash64("entry"), F.lit(slices)).cast("int").alias("slice"), F.lit(True).alias("asks"), "entry", F.lit(0).cast("long").alias("least"), "vector")
    both = held.unionAll(asked).withColumn("task", F.col("block") * slices + F.col("slice"))
    return both.repartitionById(blocks * slices, "task").drop("task").sortWithinPartitions("block", "slice", "asks").mapInArrow(_search(rotation, dimension, reach, k), "query long, entry long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, radius: int | None = None, bits: int = BITS, sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by cosine of each row that ``is_query`` holds for, itself left out.

    ``vectors`` has vec_id and embedding; ``is_query`` is over vec_id.
    """
    if bits % SUBSTRING or k < 1:
        raise ValueError("bits must be a multiple of 16 and k positive")
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where("vec_id IS NOT NULL").where(_usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, count = sizes["d"], max(1, -(-sizes["count"] // BLOCK_ROWS))
    # -0.0 equals 0.0, so that equal vectors have equal hashes
    rows = rows.where(F.size("vector") == dimension).select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))
    rows = rows.select("vec_id", F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"), "vector")
    names = rows.select("vec_id", "k1", "k2").distinct()
    least = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = names.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    placed = Window.partitionBy("block").orderBy("k1", "k2")
    numbered = (
        few.groupBy("k1", "k2")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("block", F.pmod("k1", F.lit(count)).cast("int"))
        .withColumn("entry", F.shiftleft(F.col("block").cast("long"), 32) + F.row_number().over(placed) - 1)
    )
    entries = checkpoint(rows.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).join(numbered, ["k1", "k2"]))
    sample = entries.select("vector").orderBy("k1", "k2").limit(sample_rows).collect()
    learned = _unit(np.array([r["vector"] for r in sample]))
    rotations = learn(learned, bits)
    radius = fit_radius(learned, rotations, k) if radius is None else radius
    rotation = spark.sparkContext.broadcast(rotations)
    asking = checkpoint(names.where(is_query).join(entries.select("k1", "k2", "entry"), ["k1", "k2"]).select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")))
    owned = entries.select("entry", "ids")
    enough = min(k + 1, entries.agg(F.sum(F.size("ids"))).first()[0])
    left = entries.join(asking.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi")
    found = None
    while True:
        now = checkpoint(_retrieve(entries, left, rotation, dimension, count, radius, k).join(owned, "entry"))
        full = now.groupBy("query").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") >= enough).select(F.col("query").alias("entry"))
        good = now.join(full.withColumnRenamed("entry", "query"), "query", "left_semi")
        found = good if found is None else found.unionAll(good)
        left = left.join(full, "entry", "left_anti")
        if radius >= bits or left.isEmpty():
            break
        left, radius = checkpoint(left), min(bits, radius + bits // 4)
    # per query entry: the candidates' ids, best first; then per asking id, itself left out
    spread = found.select("query", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = spread.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    kept = asking.join(best, "query").where("vec_id <> query_id")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
