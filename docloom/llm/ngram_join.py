"""N-gram Jaccard join with vertical partitioning of the global n-gram order.

1. Each document becomes the set of its word n-gram hashes; documents with equal
   sets form a class, joined by the hash of the set. Only classes are compared.
2. N-grams have one global order: by document count, then by hash. To count them,
   documents are dealt to batches; a batch sends each of its distinct n-grams once,
   in hash slices, and gets the counts back in the same order. A common n-gram
   thus costs a row a batch, not a row a document.
3. Two sets that reach the threshold share an n-gram among the first
   ``n - ceil(t * n) + 1`` of each. Of these prefixes, which hold a set's rarest
   n-grams, only those found in several documents go on; a set whose prefix is its
   own alone has no partner and is done.
4. Classes that share a prefix n-gram are candidates. A class's home is its most
   common prefix n-gram; classes of one home form a block, large ones several, and a pair
   of blocks is compared where some prefix n-gram has classes of both. Only classes with
   such an n-gram are sent to that pair.
5. The sets sent to a pair of blocks are cut into ``FRAGMENTS`` parts of the order of
   n-grams by hash, which has no need of counts and cuts every set evenly. Each pair of
   blocks and fragment is a group of its own: it counts the overlaps within the fragment
   and gives up a pair of classes as soon as the fragment alone holds more n-grams of
   one of the two than two linked sets may differ in. What is left, packed, is summed per pair
   of classes over the fragments; pairs that were given up only lack counts.
6. Of the sums that reach the threshold a spanning forest goes on, and each class's number
   of links, never the pairs. The links' components get the smallest doc_id.

N-grams are equal when their 64-bit hashes are; words of more than 32 bytes are hashed by
xxh3, sets by 128 bits of it.

Defined results: texts with fewer words than n are one sequence; null and empty
texts have no n-grams and link with nothing, not even each other; a null doc_id
counts as larger than any other; rows that repeat a doc_id are documents of their
own; a text of any length is read whole; an empty table gives an empty one. Columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import NULL_ID, apart, checkpoint, ids_repeat, packed, public_id, row_key, unpacked
from docloom.llm.components import connected_components
from docloom.llm.hashing import Words, blocks, prefix, spans

N, PERCENT = 4, 85
SLICES, BATCH_BYTES = 64, 32_000_000
BLOCK_CLASSES, BLOCK_GRAMS, FRAGMENTS, COLUMNS = 2048, 2_000_000, 4, 1024
_LOW = np.uint64(2**40 - 1)


def _sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = Words([t.lower() for t in texts])
    grams, inside = words.grams(n)
    out = []
    p = None
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= n:
            h = np.sort(grams[a : b - n + 1])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
        elif b > a:
            p = prefix(words.hash) if p is None else p
            out.append(spans(p, np.array([a]), np.array([b])))
        else:
            out.append(grams[:0])
    return out


def _set_hashes(sets: list[np.ndarray]) -> list[pa.Array]:
    """128 bits of each set as two numbers."""
    flat = np.frombuffer(b"".join(xxhash.xxh3_128_digest(h.tobytes()) for h in sets), dtype=np.int64)
    return [pa.array(flat[0::2]), pa.array(flat[1::2])]


def _slices(h: np.ndarray, slices: int) -> np.ndarray:
    """The slice of each hash; sorted hashes have ascending slices."""
    return ((h >> np.uint64(40)) * np.uint64(slices) >> np.uint64(24)).astype(np.int64)


def _batch_sets(table: pa.Table, n: int) -> list[np.ndarray]:
    return [h for texts in blocks(unpacked(table)) for h in _sets(texts, n)]


def _distinct(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a batch and the number of its different sets that have each."""
    once = list({h.tobytes(): h for h in sets if len(h)}.values())
    return np.unique(np.concatenate(once), return_counts=True) if once else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _ask(n: int, slices: int):
    """(batch, slice, low 40 bits of each hash, its count in the batch)."""

    def run(table: pa.Table) -> pa.Table:
        grams, counts = _distinct(_batch_sets(table, n))
        cuts = np.searchsorted(_slices(grams, slices), np.arange(slices + 1))
        low = (grams & _LOW).view(np.uint8).reshape(-1, 8)[:, :5]
        few = np.minimum(counts, 255).astype(np.uint8)
        parts = [(k, low[a:b].tobytes(), zlib.compress(few[a:b].tobytes(), 1)) for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if a < b]
        k, asked, held = zip(*parts, strict=True) if parts else ((), (), ())
        return pa.table({"batch": pa.array([table["batch"][0].as_py()] * len(k), pa.int32()), "slice": pa.array(k, pa.int32()), "asked": pa.array(asked, pa.binary()), "held": pa.array(held, pa.binary())})

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each question of one slice, the counts over all batches (255: that or more)."""
    asked = [np.frombuffer(x, dtype=np.uint8).reshape(-1, 5) for x in table["asked"].to_pylist()]
    sizes = [len(x) for x in asked]
    wide = np.zeros((sum(sizes), 8), dtype=np.uint8)
    wide[:, :5] = np.concatenate(asked)
    held = np.concatenate([np.frombuffer(zlib.decompress(x), dtype=np.uint8) for x in table["held"].to_pylist()])
    _, place = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    total = np.minimum(np.bincount(place, weights=held), 255).astype(np.uint8)[place]
    parts = np.split(total, np.cumsum(sizes)[:-1])
    return pa.table({"batch": table["batch"], "slice": table["slice"], "counts": pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())})


def _prefixes(n: int, percent: int):
    """A row per document: size, class, the shared part of its prefix and, where there is one, its shared n-grams."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets = _batch_sets(table, n)
        grams, _ = _distinct(sets)
        known = sorted(zip(answers["slice"].to_pylist(), answers["counts"].to_pylist(), strict=True))
        counts = np.concatenate([np.frombuffer(zlib.decompress(x), dtype=np.uint8) for _, x in known]) if known else np.zeros(0, np.uint8)
        places, shared = [], []
        for h in sets:
            size = len(h)
            mine = counts[np.searchsorted(grams, h)]
            head = np.argsort(mine, kind="stable")[: size - (-(-percent * size // 100)) + 1] if size else np.zeros(0, np.int64)
            head = head[mine[head] > 1]
            places.append(h[head].view(np.int64))
            shared.append(h[mine > 1].tobytes() if len(head) else None)
        cuts = np.concatenate(([0], np.cumsum([len(x) for x in places])))
        c1, c2 = _set_hashes(sets)
        return pa.table({
            "did": table["did"],
            "tkey": table["tkey"],
            "n": pa.array([len(h) for h in sets], pa.int64()),
            "c1": c1,
            "c2": c2,
            "places": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(places) if places else [], pa.int64())),
            "grams": pa.array(shared, pa.binary()),
        })

    return run


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common n-grams of each pair.

    N-grams found in at most eight sets are counted by their pairs; the others by
    matrix products, ``COLUMNS`` n-grams at a time.
    """
    a, b = len(left), len(right)
    every = [*left, *right]
    flat = np.concatenate(every)
    owner = np.repeat(np.arange(a + b), [len(x) for x in every])
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    count = np.diff(np.concatenate((first, [len(flat)])))
    total = np.zeros((a, b), dtype=np.float32)
    for d in range(2, 9):
        at = first[count == d]
        if len(at):
            who = owner[at[:, None] + np.arange(d)]  # ascending, as the sort is stable
            for i in range(d):
                for j in range(i + 1, d):
                    x, y = who[:, i], who[:, j] - a
                    cross = (x < a) & (y >= 0)
                    np.add.at(total, (x[cross], y[cross]), 1)
    many = np.flatnonzero(count > 8)
    for k in range(0, len(many), COLUMNS):
        part = many[k : k + COLUMNS]
        size = count[part]
        column = np.repeat(np.arange(len(part)), size)
        at = np.repeat(first[part] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cut = np.zeros((a + b, len(part)), dtype=np.float32)
        cut[owner[at], column] = 1
        total += cut[:a] @ cut[a:].T
    return total


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per fragment of each set."""
    for batch in batches:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("grams").to_pylist()]
        edge = (np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(62)) if FRAGMENTS == 4 else (np.arange(1, FRAGMENTS) * (2**64 / FRAGMENTS)).astype(np.uint64)
        parts = [x.tobytes() for h in sets for x in np.split(h, np.searchsorted(h, edge))]
        take = pa.array(np.repeat(np.arange(len(sets)), FRAGMENTS))
        fragment = pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), len(sets)))
        kept = [batch.column(c).take(take) for c in ("x", "y", "block", "node", "copies", "n")]
        yield pa.RecordBatch.from_arrays([*kept, fragment, pa.array(parts, pa.binary())], names=["x", "y", "block", "node", "copies", "n", "fragment", "grams"])


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _opened(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def partial_counts(left: list[np.ndarray], right: list[np.ndarray], sizes: tuple[np.ndarray, np.ndarray], percent: int, diagonal: bool) -> tuple[np.ndarray, np.ndarray]:
    """(pair as row * columns + column, common n-grams in the fragment) of the pairs that the fragment leaves possible."""
    common = overlaps(left, right).astype(np.int64)
    here = [np.array([len(x) for x in side], dtype=np.int64) for side in (left, right)]
    pairs, counts = [], []
    for k in range(0, len(left), 256):
        strip = common[k : k + 256]
        # linked sets of a and b n-grams differ in at most (a + b) * (100 - percent) / (100 + percent)
        apart_ = (100 + percent) * (here[0][k : k + 256, None] + here[1] - 2 * strip)
        possible = (strip > 0) & (apart_ <= (100 - percent) * (sizes[0][k : k + 256, None] + sizes[1]))
        row, column = np.nonzero(possible)
        if diagonal:
            upper = row + k < column
            row, column = row[upper], column[upper]
        pairs.append((row + k) * len(right) + column)
        counts.append(strip[row, column])
    return np.concatenate(pairs), np.concatenate(counts)


def _partial(percent: int):
    """One fragment of the sets of a pair of blocks: packed overlaps, and with the first fragment the classes themselves."""

    def run(table: pa.Table) -> pa.Table:
        x, y, fragment = (table[c][0].as_py() for c in ("x", "y", "fragment"))
        table = table.sort_by("node")
        first = np.asarray(table["block"]) == x
        sides = [first, first if x == y else ~first]
        node, copies, size = (np.asarray(table[c]) for c in ("node", "copies", "n"))
        sets = [np.frombuffer(g, dtype=np.uint64) for g in table["grams"].to_pylist()]
        pairs, counts, classes = np.zeros(0, np.int64), np.zeros(0, np.int64), b""
        if all(s.any() for s in sides) and len(sets) > 1:
            left, right = ([sets[k] for k in np.flatnonzero(s)] for s in sides)
            if any(map(len, left)) and any(map(len, right)):
                pairs, counts = partial_counts(left, right, (size[sides[0]], size[sides[1]]), percent, x == y)
            if fragment == 0:
                classes = _packed(np.concatenate([np.stack((node[s], copies[s], size[s])).T.ravel() for s in sides]))
        return pa.table({
            "x": pa.array([x], pa.int64()),
            "y": pa.array([y], pa.int64()),
            "rows": pa.array([int(sides[0].sum())], pa.int32()),
            "classes": pa.array([classes], pa.binary()),
            "pairs": pa.array([_packed(np.diff(pairs, prepend=0))], pa.binary()),
            "counts": pa.array([_packed(counts.astype(np.int32))], pa.binary()),
        })

    return run


def _sum(percent: int):
    """The overlaps of a pair of blocks, summed per pair of classes; links as a forest, and each class's number of them."""

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        parts = [(_opened(p, np.int64).cumsum(), _opened(c, np.int32)) for p, c in zip(table["pairs"].to_pylist(), table["counts"].to_pylist(), strict=True)]
        held = [c for c in table["classes"].to_pylist() if c]
        if held and sum(len(p) for p, _ in parts):
            rows, diagonal = table["rows"][0].as_py(), table["x"][0].as_py() == table["y"][0].as_py()
            classes = _opened(held[0], np.int64).reshape(-1, 3)
            left, right = classes[:rows], classes[rows:]
            common = np.zeros(len(left) * len(right), dtype=np.int32)
            for pairs, counts in parts:
                common[pairs] += counts  # each pair is once in a part
            common = common.reshape(len(left), len(right))
            linked = np.zeros(common.shape, dtype=bool)
            for k in range(0, len(left), 256):
                strip = common[k : k + 256].astype(np.int64)
                linked[k : k + 256] = (strip > 0) & (100 * strip >= percent * (left[k : k + 256, 2][:, None] + right[:, 2] - strip))
            if diagonal:
                linked |= linked.T
            out += [(a, a, d) for a, d in zip(left[:, 0].tolist(), (linked @ right[:, 1]).tolist(), strict=True) if d]
            if not diagonal:
                out += [(a, a, d) for a, d in zip(right[:, 0].tolist(), (left[:, 1] @ linked).tolist(), strict=True) if d]
            out += [(int(left[i, 0]), int(right[j, 0]), 0) for i, j in _forest(linked, diagonal)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])

    return run


def _forest(linked: np.ndarray, diagonal: bool) -> Iterator[tuple[int, int]]:
    """Spanning edges (row, column) of the bipartite (or, on the diagonal, plain) graph."""
    rows_left = linked.any(axis=1)
    columns_left = linked.any(axis=0)
    while rows_left.any():
        i = int(np.argmax(rows_left))
        rows_left[i] = False
        if diagonal:
            columns_left[i] = False
        queue = [(i, True)]
        while queue:
            k, is_row = queue.pop()
            if is_row:
                new = np.flatnonzero(linked[k] & columns_left)
                columns_left[new] = False
                if diagonal:
                    rows_left[new] = False
                for j in new.tolist():
                    yield k, j
                    queue.append((j, diagonal))
            else:
                new = np.flatnonzero(linked[:, k] & rows_left)
                rows_left[new] = False
                for j in new.tolist():
                    yield j, k
                    queue.append((j, True))


def _members(docs: DataFrame, n: int, percent: int, pick: bool) -> DataFrame:
    """did, tkey, n, copies, label, others of every row; with ``pick`` also gone: whether another row stands for it.

    The row that stands for a component has its smallest doc_id and, of the texts with that, the one of least tkey.
    """
    if not 1 <= percent <= 100 or n < 1:
        raise ValueError("percent must be in 1..100 and n positive")
    # classes are named by their least doc_id; where ids repeat, which would name two alike, by a hash
    repeats = ids_repeat(docs)
    slices = max(SLICES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batch = F.pmod(F.xxhash64("did", "tkey"), F.lit(max(2 * slices, -(-size // BATCH_BYTES)))).cast("int").alias("batch")
    text = packed(docs).select(batch, "did", "tkey", "packed")
    asked = text.groupBy("batch").applyInArrow(_ask(n, slices), "batch int, slice int, asked binary, held binary")
    answers = asked.groupBy("slice").applyInArrow(_answer, "batch int, slice int, counts binary")
    described = checkpoint(text.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_prefixes(n, percent), "did long, tkey long, n long, c1 long, c2 long, places array<long>, grams binary"))
    whole = ["c1", "c2", "n"]
    members = described.select("did", "tkey", *whole)
    pick_text = pick and repeats
    first = F.min(F.struct("did", "tkey")).alias("first")
    classes = members.where("n > 0").groupBy(whole).agg(first, F.count("*").alias("copies")).select(*whole, "copies", "first", F.col("first.did").alias("rep"), (F.xxhash64("first.did", "first.tkey", *whole) if repeats else F.col("first.did")).alias("node"))
    # candidates go by the first half of the set's hash; two sets that share it are only compared more often
    postings = described.where("size(places) > 0").select(F.explode("places").alias("place"), "c1", "n").distinct()
    blocks_of = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_GRAMS)).cast("int")
    shared = postings.groupBy("place").agg(F.count("*").alias("m"), F.sum("n").alias("total")).where("m > 1").select("place", "m", blocks_of.alias("blocks"))
    listed = postings.join(apart(shared, "place"), "place").select("place", "c1", "m", "blocks")
    home = listed.groupBy("c1").agg(F.max(F.struct("m", "place", "blocks")).alias("home")).select("c1", F.xxhash64("home.place", F.pmod(F.xxhash64("c1"), F.col("home.blocks"))).alias("block"))
    placed = listed.select("place", "c1").join(home, "c1")
    met = placed.groupBy("place").agg(F.collect_set("block").alias("met")).where("size(met) > 1")
    others = placed.join(apart(met, "place"), "place").select("c1", F.explode("met").alias("other")).groupBy("c1").agg(F.collect_set("other").alias("others"))
    known = home.join(others, "c1", "left").select("c1", "block", F.array_union(F.coalesce("others", F.array().cast("array<bigint>")), F.array("block")).alias("others"))
    heads = classes.join(known, "c1").select("c1", "c2", "n", "copies", "node", "block", "others", F.col("first.did").alias("did"), F.col("first.tkey").alias("tkey"))
    held = described.where("grams is not null").select("did", "tkey", *whole, "grams").join(heads, ["did", "tkey", *whole])
    held = held.dropDuplicates(["node"]) if repeats else held
    dealt = held.select("block", "node", "copies", "n", "grams", F.explode("others").alias("other")).select(F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "copies", "n", "grams")
    cut = dealt.mapInArrow(_cut, "x long, y long, block long, node long, copies long, n long, fragment int, grams binary")
    counted = cut.groupBy("x", "y", "fragment").applyInArrow(_partial(percent), "x long, y long, rows int, classes binary, pairs binary, counts binary")
    found = checkpoint(counted.groupBy("x", "y").applyInArrow(_sum(percent), "a long, b long, links long"))
    labels = connected_components(found.where("a <> b").select("a", "b")).select("node", "label")
    degree = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    if repeats:
        named = labels.join(classes.select("node", "rep", "first"), "node")
        best = [F.min("first").alias("best")] if pick_text else []
        labels = named.join(named.groupBy("label").agg(F.min("rep").alias("least"), *best), "label").select("node", F.col("least").alias("label"), *(["best"] if pick_text else []))
    labelled = classes.join(labels, "node", "left").join(degree, "node", "left")
    shown = [F.coalesce("best", "first").alias("best")] if pick_text else []
    named = labelled.select(*whole, "copies", F.coalesce("label", "rep").alias("label"), F.coalesce("others", F.lit(0)).alias("others"), *shown)
    out = members.join(apart(named, *whole), whole, "left")
    if not pick:
        return out
    later = F.struct("did", "tkey") > F.col("best") if pick_text else F.col("did") > F.col("label")
    return out.withColumn("gone", F.coalesce(later, F.lit(False)))


def ngram_jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (documents linked directly, copies included).

    Documents link when 100 * |intersection| >= percent * |union| of their word n-grams.
    """
    component = F.coalesce("label", "did")
    return _members(docs, n, percent, False).select(
        public_id(),
        F.col("n").alias("n_shingles"),
        F.when(component != NULL_ID, component).alias("component_id"),
        F.coalesce(F.col("others") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one id and text of each; rows that repeat both stay together.

    A null doc_id is one of its own, larger than any other. Rows without n-grams all stay.
    """
    gone = _members(docs, n, percent, True).where("gone").select(F.col("did").alias("gone_did"), F.col("tkey").alias("gone_tkey")).distinct()
    did, tkey = row_key(docs)
    return docs.join(gone, (did == gone["gone_did"]) & (tkey == gone["gone_tkey"]), "left_anti")
