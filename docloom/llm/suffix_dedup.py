"""Suffix-array dedup: remove every byte covered by a 200-byte string that starts elsewhere too.

Sorting all suffixes of a corpus would shuffle many times its size, so suffixes
are first dealt to buckets in which alone they can agree: a string of ``length``
bytes is represented by its least ``GRAM``-byte part (by hash), equal strings have
equal representatives at equal distances, and representatives that occur once are
given up. The text around each other one goes to the task of its bucket, where

* prefix polynomial hashes of the bucket's bytes are made once,
* a common extension is found by binary search over span hashes, so that
  comparing two suffixes takes a logarithmic number of steps,
* a bottom-up mergesort over those comparisons orders the suffixes, and
  neighbours that agree over ``length`` bytes are verified byte by byte.

Texts that are equal as a whole, by 128 bits of xxh3 and their length, are settled
before; one of them stands for all in the buckets. A bucket has at most ``hot`` pieces of
text. Those of a representative found more often are split by all the bytes they hold: equal pieces are
settled together, by a 128-bit BLAKE2 digest of their bytes, and one of each is cut into its
strings, which are dealt by digests of their own. Both counts combine before they
shuffle, and the joins back to the pieces can split a hot one.

Defined results: null and empty texts have no bytes and keep the empty string;
texts shorter than ``length`` are never changed; a text of any length is read whole; an
empty table gives an empty one; repeated rows are copies of each
other, whatever their doc_id, and those that repeat it too are sorted once; a null doc_id stays null. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import apart, checkpoint, ids_repeat, keyed, one_of_each, packed, public_id, texts_of, unpacked
from docloom.llm.hashing import BYTE_VALUES, anchor_runs, blocks, fixed_spans, join, mix, powers, prefix

LENGTH = 200
GRAM = 32
BUCKET_BYTES, SORTED, HOT = 2_000_000, 500_000, 20_000


class SuffixOrder:
    """Suffixes of ``buf``, compared over at most ``length`` bytes."""

    def __init__(self, buf: np.ndarray, length: int):
        self.buf, self.length = buf, length
        self.p = prefix(BYTE_VALUES[buf])
        self.inverse = powers(len(self.p))[1]

    def raw(self, start: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return (self.p[start + n] - self.p[start]) * self.inverse[start]

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix, by binary search over span hashes."""
        out = np.full(len(x), self.length, dtype=np.int64)
        apart = np.flatnonzero(self.raw(x, self.length) != self.raw(y, self.length))
        if len(apart):
            a, b = x[apart], y[apart]
            low = np.zeros(len(apart), dtype=np.int64)
            step = 1 << (self.length - 1).bit_length() - 1
            while step:
                reach = low + step
                inside = reach < self.length
                reach = np.where(inside, reach, low)
                low = np.where(inside & (self.raw(a, reach) == self.raw(b, reach)), reach, low)
                step >>= 1
            out[apart] = low
        return out

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of suffixes."""
        same = self.extension(x, y)
        at = np.minimum(same, self.length - 1)
        a, b = self.buf[x + at].astype(np.int16), self.buf[y + at].astype(np.int16)
        return np.where(same == self.length, 0, np.sign(a - b))

    def mergesort(self, start: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``start`` ordered within each bucket [first, first + size), all buckets at once."""
        order = start.copy()
        run = 1
        live = np.flatnonzero(size > 1)
        while len(live):
            base = np.repeat(first[live], size[live])
            local = np.arange(len(base)) - np.repeat(np.cumsum(size[live]) - size[live], size[live])
            end = np.repeat(first[live] + size[live], size[live])
            mine = local // run
            low = base + (mine ^ 1) * run
            has = low < end
            low = np.where(has, low, end)
            high = np.minimum(low + run, end)
            here = order[base + local]
            left = (mine & 1) == 0
            lo, hi = low.copy(), high.copy()
            open_ = np.flatnonzero(lo < hi)
            while len(open_):
                mid = (lo[open_] + hi[open_]) >> 1
                sign = self.compare(order[mid], here[open_])
                before = (sign < 0) | ((sign == 0) & ~left[open_])
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
                open_ = open_[lo[open_] < hi[open_]]
            order[base + (mine & ~1) * run + (local - mine * run) + (lo - low)] = here
            run *= 2
            live = live[size[live] > run]
        return order

    def repeated(self, start: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Which suffixes agree over ``length`` bytes with another of their bucket."""
        by = np.argsort(bucket, kind="stable")
        start_of, key = start[by], bucket[by]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((first, [len(key)])))
        # the order within a bucket only needs each suffix; where it came from follows from its position
        order = self.mergesort(start_of, first, size)
        pair = np.flatnonzero((key[1:] == key[:-1]))
        equal = pair[self.extension(order[pair], order[pair + 1]) == self.length]
        true = self.verified(order[equal], order[equal + 1])
        found = set()
        if not true.all():
            for k in np.unique(key[equal[~true]]):
                found |= self.by_bytes(start_of[key == k])
            good = ~np.isin(key[equal], key[equal[~true]])
            equal = equal[good]
        hit = np.zeros(len(self.buf), dtype=bool)
        hit[order[equal]] = hit[order[equal + 1]] = True
        if found:
            hit[list(found)] = True
        return hit[start]

    def verified(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        reach = np.arange(self.length)
        for k in range(0, len(x), 20_000):
            out[k : k + 20_000] = (self.buf[x[k : k + 20_000, None] + reach] == self.buf[y[k : k + 20_000, None] + reach]).all(axis=1)
        return out

    def by_bytes(self, start: np.ndarray) -> set[int]:
        """The bucket of a hash collision, by its bytes."""
        held: dict[bytes, list[int]] = {}
        for s in start.tolist():
            held.setdefault(self.buf[s : s + self.length].tobytes(), []).append(s)
        return {s for group in held.values() if len(group) > 1 for s in group}


def _list(flat: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, kind))


def _pairs(digests: list[bytes]) -> list[pa.Array]:
    """128-bit digests as two columns of numbers."""
    flat = np.frombuffer(b"".join(digests), dtype=np.int64)
    return [pa.array(flat[0::2]), pa.array(flat[1::2])]


def _digest(x: bytes) -> bytes:
    return hashlib.blake2b(x, digest_size=16).digest()


def _describe(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in blocks(texts_of(batch)):
                buf, offsets = join(texts)
                p = prefix(BYTE_VALUES[buf])
                grams = fixed_spans(p, gram)
                end = np.repeat(offsets[1:] - 1, np.diff(offsets))
                last = np.arange(len(buf)) + length <= end
                at, first, final = anchor_runs(grams, gram, length, last)
                owner = np.searchsorted(offsets, first, side="right") - 1
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                base = offsets[owner]
                part = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("did"), part.column("tkey"), pa.array(np.diff(offsets) - 1, pa.int64()), *_pairs([xxhash.xxh3_128_digest(t) for t in texts]), _list(grams[at].view(np.int64), cuts, pa.int64()), _list(at - first, cuts, pa.int16()), _list(first - base, cuts, pa.int32()), _list(final - first, cuts, pa.int16())],
                    names=["did", "tkey", "n_bytes", "d1", "d2", "anchor", "ahead", "first", "more"],
                )

    return run


def _snippets(length: int):
    """The bytes of each run of a repeated representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            size = 0
            for did, tkey, text, runs in zip(batch.column("did").to_pylist(), batch.column("tkey").to_pylist(), unpacked(batch), batch.column("runs"), strict=True):
                values = runs.values
                for anchor, ahead, first, more in zip(*(values.field(k).to_pylist() for k in range(4)), strict=True):
                    snippet = text[first : first + more + length]
                    for column, value in zip(rows, (anchor, did, tkey, ahead, first, snippet), strict=True):
                        column.append(value)
                    size += len(snippet)
                if size > 4_000_000:
                    yield _snippet_batch(rows)
                    rows, size = [[], [], [], [], [], []], 0
            yield _snippet_batch(rows)

    return run


def _digests(length: int, whole: bool):
    """A digest of each run's bytes, or of every string in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for did, tkey, text, runs in zip(batch.column("did").to_pylist(), batch.column("tkey").to_pylist(), unpacked(batch), batch.column("runs"), strict=True):
                first, more = (np.asarray(runs.values.field(k)).astype(np.int64) for k in (0, 1))
                if whole:
                    found = [_digest(text[a : a + m + length]) for a, m in zip(first.tolist(), more.tolist(), strict=True)]
                else:
                    first = np.repeat(first, more + 1) + np.arange((more + 1).sum()) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                    found, more = [_digest(text[a : a + length]) for a in first.tolist()], np.zeros(len(first), dtype=np.int64)
                n = len(first)
                yield pa.RecordBatch.from_arrays([*_pairs(found), pa.array(np.full(n, did)), pa.array(np.full(n, tkey)), pa.array(first, pa.int32()), pa.array(first + more, pa.int32())], names=["c1", "c2", "did", "tkey", "first", "last"])

    return run


_DIGESTS = "c1 long, c2 long, did long, tkey long, first int, last int"


def _snippet_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=["anchor", "did", "tkey", "ahead", "first", "snippet"])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[tuple]]]:
    """Whole groups of one representative, several together while they are small."""
    held: dict[int, list[tuple]] = {}
    size, current = 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != current:
                if size > BUCKET_BYTES:
                    yield held
                    held, size = {}, 0
                current = row[0]
            held.setdefault(current, []).append(row[1:])
            size += len(row[5])
    if held:
        yield held


def _sort(length: int):
    """Ranges of window starts that occur elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _buckets(batches):
            out: list[tuple[int, int, int, int]] = []
            parts: list[bytes] = []
            owners: list[list[tuple[int, int, int]]] = []
            number, ahead, width = [], [], []
            for k, rows in enumerate(groups.values()):
                distinct: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
                for did, tkey, before, first, snippet in rows:
                    distinct.setdefault((before, snippet), []).append((did, tkey, first))
                for (_, snippet), places in distinct.items():
                    if len(places) > 1:
                        out += [(did, tkey, first, first + len(snippet) - length) for did, tkey, first in places]
                if len(distinct) > 1:
                    for (before, snippet), places in distinct.items():
                        parts.append(snippet)
                        owners.append(places if len(places) == 1 else [])
                        number.append(k)
                        ahead.append(before)
                        width.append(len(snippet) - length + 1)
            if parts:
                out += _ranges(length, parts, owners, np.array(number), np.array(ahead), np.array(width))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["did", "tkey", "first", "last"])

    return run


def _ranges(length: int, parts: list[bytes], owners: list[list[tuple[int, int, int]]], number: np.ndarray, ahead: np.ndarray, width: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    order = SuffixOrder(np.frombuffer(b"".join(parts), dtype=np.uint8), length)
    base = np.cumsum(width + length - 1) - (width + length - 1)
    owner = np.repeat(np.arange(len(parts)), width)
    within = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
    start = base[owner] + within
    # strings can only agree where they hold the representative at the same distance
    distance = ahead[owner] - within
    place = mix(number[owner].astype(np.uint64) * np.uint64(1 << 20) + (distance + length).astype(np.uint64))
    found = np.zeros(len(start), dtype=bool)
    by = np.argsort(distance, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(distance[by])) + 1, len(by))
    while len(by):  # some distances at a time, for bounded memory
        end = int(ends[np.searchsorted(ends, SORTED)] if ends[-1] > SORTED else ends[-1])
        part, by, ends = by[:end], by[end:], ends[ends > end] - end
        found[part] = order.repeated(start[part], place[part])
    hit = np.flatnonzero(found)
    if not len(hit):
        return
    cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)) + 1
    for a, b in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(hit)])).tolist(), strict=True):
        if a < b:
            k = int(owner[hit[a]])
            for did, tkey, first in owners[k]:
                yield did, tkey, first + int(within[hit[a]]), first + int(within[hit[b - 1]])


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for text, found, copy in zip(unpacked(batch), batch.column("found"), batch.column("copy").to_pylist(), strict=True):
                ranges: list[list[int]] = [[0, len(text)]] if copy and len(text) >= length else []
                if not ranges and found.is_valid:
                    for first, last in sorted((r["first"], r["last"]) for r in found.as_py()):
                        if ranges and first <= ranges[-1][1]:
                            ranges[-1][1] = max(ranges[-1][1], last + length)
                        else:
                            ranges.append([first, last + length])
                kept, at = [], 0
                for a, b in ranges:
                    kept.append(text[at:a])
                    at = b
                left = b"".join([*kept, text[at:]])
                rows.append((len(text), len(text) - len(left), len(ranges), hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("did"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _beside(text: DataFrame, runs: DataFrame, *columns: str) -> DataFrame:
    """The texts that have runs, with these columns of them."""
    held = runs.groupBy("did", "tkey").agg(F.collect_list(F.struct(*columns)).alias("runs"))
    return text.join(held, ["did", "tkey"]).select("did", "tkey", "packed", "runs")


def _counted(rows: DataFrame) -> DataFrame:
    """The digests found more than once, with the place of one of each."""
    found = rows.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.min(F.struct("did", "tkey", "first")).alias("one"))
    return apart(found.where("n > 1").select("c1", "c2", "one"), "c1", "c2")


def _split(text: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The strings of hot representatives that occur again: did, tkey, first, last."""
    pieces = _beside(text, runs, "first", "more").mapInArrow(_digests(length, True), _DIGESTS)
    settled = pieces.join(_counted(pieces), ["c1", "c2"], "left")
    place = ["did", "tkey", "first", "last"]
    alone = settled.where("one IS NULL OR one = struct(did, tkey, first)").withColumn("more", F.col("last") - F.col("first"))
    strings = _beside(text, alone, "first", "more").mapInArrow(_digests(length, False), _DIGESTS)
    return settled.where("one IS NOT NULL").select(place).unionAll(strings.join(_counted(strings).drop("one"), ["c1", "c2"], "left_semi").select(place))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes; a cut can fall inside a character)."""
    if not 1 < gram < length < 2**15:
        raise ValueError("gram must be shorter than length, and length below 32768")
    repeats = ids_repeat(docs)
    every = packed(docs, repeats)
    # what is joined with runs has one row of those that repeat id and text
    text = one_of_each(every, repeats)
    described = checkpoint(keyed(docs, repeats).mapInArrow(_describe(length, gram), "did long, tkey long, n_bytes long, d1 long, d2 long, anchor array<long>, ahead array<short>, first array<int>, more array<short>"))
    same = ["d1", "d2", "n_bytes"]
    shared = described.groupBy(same).agg(F.count("*").alias("n"), F.min("did").alias("least")).where("n > 1").select(*same, "least")
    if repeats:  # counted as copies of each other; from here on one stands for all
        described = one_of_each(described)
    copies = described.select("did", "tkey", *same).join(apart(shared, *same), same).select("did", "tkey", "least").distinct()
    followers = copies.where("did > least").select("did", "tkey")
    runs = (
        described.select("did", "tkey", F.explode(F.arrays_zip("anchor", "ahead", "first", "more")).alias("r"))
        .join(followers, ["did", "tkey"], "left_anti")
        .select("did", "tkey", "r.*")
    )
    repeated = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    met = runs.join(apart(repeated, "anchor"), "anchor")
    snippets = _beside(text, met.where(F.col("n") <= hot), "anchor", "ahead", "first", "more").mapInArrow(_snippets(length), "anchor long, did long, tkey long, ahead int, first int, snippet binary")
    sorted_out = snippets.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort(length), "did long, tkey long, first int, last int")
    found = sorted_out.unionByName(_split(text, met.where(F.col("n") > hot), length))
    ranges = found.groupBy("did", "tkey").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    marks = (every if repeats else text).join(ranges, ["did", "tkey"], "left").join(copies.select("did", "tkey", F.lit(True).alias("copy")), ["did", "tkey"], "left")
    out = marks.select("did", "packed", "found", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(_remove(length), "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.select(public_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
