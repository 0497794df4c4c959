"""Phrase collocation mining: counts by minimal perfect hash over Apriori-safe candidates.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those
into words at spaces and tabs. A phrase of 2 to 4 words that lie side by side in a piece
is as frequent as its words and parts at most. So candidates come level by level, and
every scan looks only at phrases whose parts can be frequent:

1. words are counted (and all words of each language);
2. pairs of frequent words are summed by 48 bits of a hash, some bytes each, which bounds
   their counts from above; the words of those whose sums reach the limit are then
   reported by one task each, the one that had most of the sum;
3. threes and fours all of whose pairs can be frequent are summed and reported likewise;
4. a minimal perfect hash over what is left gives each candidate a slot. Mappers look up
   what they read, verify it against the keys stored in the slots and bincount the slots;
   their arrays are summed as a tree. The counts of a candidate and of the parts of each
   of its cuts are read by slot.

A bucket can hold several phrases, and its task may have met one only. So the counts of
step 4 are taken from the sums of the buckets, and if what is left of any reaches the
limit, steps 2 to 4 are done again and every task reports.

Step 4 takes ``KEYS_AT_ONCE`` candidates and as many scans as there are such blocks, so
that what is broadcast has a bound. The filters of steps 2 to 4 are bitmaps of 16 bits a
key, at most ``MOST_BITS``; a filter that is full lets more through, and no frequent
phrase is lost.

A word stands for itself by 64 bits of a hash of language and word; a seed is taken
under which no two frequent words of the corpus share theirs. A word that is not
frequent is told apart by 64 more bits in the filter. Keys of phrases are the numbers of
their words, whole.

Defined results: a null text is empty, a null language ``und``; texts of any length are
read whole; equal texts and repeated rows count each time; ties of score go by count,
then by phrase; a language without candidates has no rows; an empty table gives an empty
one. Columns other than text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.common import checkpoint, texts_of
from docloom.llm.hashing import BYTE_VALUES, LONG_WORD, OTHER_VALUES, U, blocks, join, mix, prefix, spans

LEAST, TOP, LONGEST = 30, 2000, 4
#: A part is dropped if a longer candidate has this share of its count.
INSIDE_PERCENT, SCALE = 80, 2_000_000
NO_LANGUAGE = "und"
TOGETHER, ROWS = 1_000_000, 500
#: Different phrases that a task holds before it passes them on.
HELD = 300_000
KEYS_AT_ONCE, SLICE = 1 << 20, 1 << 15
MOST_BITS, PART_BITS, BITS_A_KEY = 1 << 30, 19, 16
BUCKET_BITS, SLICE_KEYS = 48, 1 << 20
SALTS = 64
_GOLDEN = U(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True

KEY = ("w1", "w2", "w3", "w4")
COUNTS = ("a", "l1", "r1", "l2", "r2", "l3", "r3")


# --- reading


class Block:
    """The words of some texts: their numbers, checks, texts and neighbours."""

    def __init__(self, texts: list[bytes], langs: Sequence[str], seed: int):
        buf, offsets = join(texts)
        self.low = low = LOWER[buf]
        gap = GAP[low]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(gap) and not gap[0]:
            edge = np.concatenate((np.zeros(1, dtype=np.int64), edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.langs = pa.array(langs, pa.string())
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        seeds = {x: xxhash.xxh3_64_intdigest(x.encode(), seed) for x in set(langs)}
        breaks = np.cumsum(BREAK[low], dtype=np.int32)
        #: Whether a word and the next lie side by side in one piece.
        self.tied = breaks[self.end[:-1] - 1] == breaks[self.start[1:]]
        self.word = mix(self._hashes(BYTE_VALUES, 0) + np.array([seeds[x] for x in langs], dtype=U)[self.doc])
        self.check = self._hashes(OTHER_VALUES, 1)

    def _hashes(self, values: np.ndarray, seed: int) -> np.ndarray:
        out = spans(prefix(values[self.low]), self.start, self.end)
        for k in np.flatnonzero(self.end - self.start > LONG_WORD).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.low[self.start[k] : self.end[k]].tobytes(), seed)
        return out

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words at these places."""
        size = self.end[at] - self.start[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        flat = self.low[np.repeat(self.start[at] - ends[:-1], size) + np.arange(ends[-1])]
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])

    def places(self, filters: Sequence[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """For each phrase length, from 1, the places of phrases all of whose words, and pairs, pass the filters of lengths 1 and 2; of longer ones those that pass a third."""
        words = passing(filters[0], mix(self.word) ^ self.check)
        yield 1, np.flatnonzero(words)
        pairs = self.tied & words[:-1] & words[1:]
        at = np.flatnonzero(pairs)
        if len(filters) < 2:
            yield 2, at
            return
        pairs[at] = passing(filters[1], mix(bucket(self.key(2, at))))
        yield 2, np.flatnonzero(pairs)
        threes = pairs[:-1] & pairs[1:]
        for k, of in ((3, threes), (4, threes[:-1] & pairs[2:])):
            at = np.flatnonzero(of)
            yield k, at if len(filters) < 3 else at[passing(filters[2], mix(bucket(self.key(k, at))))]

    def key(self, k: int, at: np.ndarray) -> list[np.ndarray]:
        return [self.word[at + j] for j in range(k)]


def _read(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Block]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):  # not all texts of a batch at once
            batch = whole.slice(at, ROWS)
            langs, done = batch.column("lang").to_pylist(), 0
            for part in blocks(texts_of(batch), TOGETHER):
                block = Block(part, langs[done : done + len(part)], seed)
                if len(block.start):
                    yield block
                done += len(part)


def folded(words: Sequence[np.ndarray], seed: int = 0) -> np.ndarray:
    """One number for the numbers of a phrase's words."""
    x = mix(words[0] + U((len(words) * int(_GOLDEN) + seed) % 2**64))
    for w in words[1:]:
        x = mix(x * _GOLDEN + w)
    return x


def bucket(words: Sequence[np.ndarray]) -> np.ndarray:
    """A number of ``BUCKET_BITS`` bits for a phrase."""
    return folded(words) >> U(64 - BUCKET_BITS)


def owned(x: np.ndarray, task: np.ndarray | int) -> np.ndarray:
    """One number for a bucket and the task that reports its phrases."""
    return mix(x | np.asarray(task % (1 << 64 - BUCKET_BITS)).astype(U) << U(BUCKET_BITS))


def _counted(words: list[np.ndarray], n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A place of each different phrase, and how often it is there; ``n`` has how often each place counts."""
    x = folded(words)
    order = np.argsort(x)
    x = x[order]
    new = np.concatenate(([True], x[1:] != x[:-1]))
    differ = np.zeros(len(x) - 1, dtype=bool)
    for w in words:
        w = w[order]
        differ |= w[1:] != w[:-1]
    if (differ & ~new[1:]).any():  # two phrases share a number
        order = np.lexsort(words)
        for w in words:
            w = w[order]
            new[1:] |= w[1:] != w[:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first)


class Held:
    """Different phrases of one length with their languages, reduced whenever there are many."""

    def __init__(self, k: int):
        self.k, self.size = k, 0
        self.parts: list[tuple[list[np.ndarray], np.ndarray]] = []

    def add(self, key: list[np.ndarray], lang: np.ndarray) -> bool:
        """Whether so many are held that they should be passed on."""
        self.parts.append((key, lang))
        self.size += len(lang)
        if self.size <= HELD:
            return False
        self.reduce()
        return self.size > HELD // 2

    def reduce(self) -> None:
        key = [np.concatenate([p[0][j] for p in self.parts]) for j in range(self.k)]
        lang = np.concatenate([p[1] for p in self.parts])
        one, _ = _counted(key)
        self.parts, self.size = [([w[one] for w in key], lang[one])], len(one)

    def batch(self, langs: list[str]) -> pa.RecordBatch:
        self.reduce()
        ((key, lang),) = self.parts
        self.parts, self.size = [], 0
        x = bucket(key).view(np.int64)
        key = [w.view(np.int64) for w in key] + [np.zeros(len(x), dtype=np.int64)] * (LONGEST - self.k)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(lang)), pa.array(np.full(len(x), self.k, dtype=np.int32)), *map(pa.array, key), pa.array(x)], names=["lang", "k", *KEY, "x"])


def _words(seed: int):
    """(lang, word, n) of each block, and under a null word all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, seed):
            at, n = _counted([block.word, block.check])
            totals = np.bincount(block.doc, minlength=len(block.langs))
            some = np.flatnonzero(totals)
            yield pa.RecordBatch.from_arrays([block.langs.take(pa.array(block.doc[at])), block.texts(at), pa.array(n)], names=["lang", "word", "n"])
            yield pa.RecordBatch.from_arrays([block.langs.take(pa.array(some)), pa.nulls(len(some), pa.string()), pa.array(totals[some])], names=["lang", "word", "n"])

    return run


def _numbered(seed: int):
    """(lang, word, n, w1, check) of rows that have one word each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = Block(texts_of(batch, "word"), batch.column("lang").to_pylist(), seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block.word.view(np.int64)), pa.array(block.check.view(np.int64))], names=[*batch.schema.names, "w1", "check"])

    return run


def _phrases(lengths: Sequence[int], filters, own, everywhere: bool, seed: int):
    """(lang, k, w1 to w4, bucket) of the phrases a task is to report; what a phrase has no word for is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, mine, task = [f.value for f in filters], own.value, 0 if everywhere else TaskContext.get().partitionId()
        held, langs = {k: Held(k) for k in lengths}, {}
        for block in _read(batches, seed):
            number = np.array([langs.setdefault(x, len(langs)) for x in block.langs.to_pylist()])
            for k, at in block.places(bitmaps):
                if k in held and len(at):
                    at = at[passing(mine, owned(bucket(block.key(k, at)), task))]
                    if len(at) and held[k].add(block.key(k, at), number[block.doc[at]]):
                        yield held[k].batch(list(langs))
        for each in held.values():
            if each.size:
                yield each.batch(list(langs))

    return run


# --- sums by bucket


def _summed_sorted(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(x)
    x, n = x[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return x[first], np.add.reduceat(n, first)


def _votes(x: np.ndarray, n: np.ndarray, task: int) -> np.ndarray:
    """What a task bids for its buckets: most of the sum wins, a hash decides ties; the last bits name it."""
    return np.minimum(n, (1 << 31) - 1).astype(U) << U(32) | owned(x, task) & U(0xFFFF0000) | U(task & 0xFFFF)


def packed_sums(x: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers and their counts, compressed: the bytes of all steps by significance, then those of the counts."""
    steps = np.diff(x, prepend=U(0))
    planes = np.concatenate([v.view(np.uint8).reshape(-1, 8).T.ravel() for v in (steps, n.astype(U))])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked_sums(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(2, 8, -1)
    steps, n = (np.ascontiguousarray(p.T).view(U).ravel() for p in planes)
    return np.cumsum(steps, dtype=U), n.astype(np.int64)


def _bucketed(lengths: Sequence[int], filters, seed: int, slices: int):
    """(slice, task, packed): a task's phrases by bucket, with their counts, in slices of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, parts, size, task = [f.value for f in filters], [], 0, TaskContext.get().partitionId()

        def reduced() -> tuple[np.ndarray, np.ndarray]:
            return _summed_sorted(*(np.concatenate([p[j] for p in parts]) for j in (0, 1)))

        def batch() -> pa.RecordBatch:
            ((x, n),) = parts
            cuts = np.searchsorted(x, np.arange(slices + 1, dtype=U) << U(BUCKET_BITS - slices.bit_length() + 1))
            some = np.flatnonzero(np.diff(cuts))
            packed = [packed_sums(x[cuts[s] : cuts[s + 1]], n[cuts[s] : cuts[s + 1]]) for s in some.tolist()]
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), task, dtype=np.int32)), pa.array(packed, pa.binary())], names=["slice", "task", "packed"])

        for block in _read(batches, seed):
            for k, at in block.places(bitmaps):
                if k in lengths and len(at):
                    parts.append(_summed_sorted(bucket(block.key(k, at)), np.ones(len(at), dtype=np.int64)))
                    size += len(parts[-1][0])
            if size > HELD:
                parts = [reduced()]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield batch()
                    parts, size = [], 0
        if parts:
            parts = [reduced()]
            yield batch()

    return run


def _heavy(least: int):
    """(x, n, task): the buckets that reach ``least``, their sums and who reports; rows of a slice follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, size = None, [], 0

        def reduced() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            x, n, vote = (np.concatenate([p[j] for p in parts]) for j in range(3))
            order = np.argsort(x)
            x = x[order]
            first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
            return x[first], np.add.reduceat(n[order], first), np.maximum.reduceat(vote[order], first)

        def found() -> pa.RecordBatch:
            x, n, vote = reduced()
            some = np.flatnonzero(n >= least)
            return pa.RecordBatch.from_arrays([pa.array(x[some].view(np.int64)), pa.array(n[some]), pa.array((vote[some] & U(0xFFFF)).astype(np.int32))], names=["x", "n", "task"])

        for batch in batches:
            for s, task, packed in zip(*(batch.column(c).to_pylist() for c in ("slice", "task", "packed")), strict=True):
                if s != current and parts:
                    yield found()
                    parts, size = [], 0
                current = s
                x, n = unpacked_sums(packed)
                parts.append((x, n, _votes(x, n, task)))
                size += len(x)
                if size > 2 * SLICE_KEYS:
                    parts = [reduced()]
                    size = len(parts[0][0])
        if parts:
            yield found()

    return run


# --- filters


def _bits(x: np.ndarray, slices: int, part_bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The slice of each key, and its bits within the slice."""
    of = x >> U(65 - slices.bit_length()) if slices > 1 else np.zeros(len(x), dtype=U)
    mask = U((1 << part_bits) - 1)
    return of.astype(np.int64), [(x & mask).astype(np.int64), (x >> U(part_bits) & mask).astype(np.int64)]


def passing(held: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter, which has a row of bytes for each slice."""
    part_bits = (8 * held.shape[1]).bit_length() - 1
    of, bits = _bits(x, len(held), part_bits)
    flat = held.reshape(-1)
    out = np.ones(len(x), dtype=bool)
    for b in bits:
        place = of << part_bits | b
        out &= flat[place >> 3] >> (place & 7).astype(np.uint8) & 1 != 0
    return out


def _filter(keys: DataFrame, n: int):
    """A broadcast bitmap of the column ``x``; each slice is filled by one task, from about as many keys as any other."""
    part_bits, slices = PART_BITS, 1
    while slices << part_bits < min(BITS_A_KEY * n, MOST_BITS):
        slices *= 2

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            of, bits = _bits(batch.column("x").to_numpy(zero_copy_only=False).view(U), slices, part_bits)
            for s in np.unique(of).tolist():
                part = held.setdefault(s, np.zeros(1 << part_bits, dtype=bool))
                for b in bits:
                    part[b[of == s]] = True
        for s, part in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], names=["slice", "bits"])

    of = F.shiftrightunsigned("x", 65 - slices.bit_length()) if slices > 1 else F.lit(0).cast("long")
    out = np.zeros((slices, 1 << part_bits >> 3), dtype=np.uint8)
    for row in keys.repartition(of).mapInArrow(fill, "slice int, bits binary").toLocalIterator():
        out[row["slice"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").to_numpy(zero_copy_only=False).view(U)
        yield pa.RecordBatch.from_arrays([pa.array(mix(x).view(np.int64))], names=["x"])


def _owned_keys(everywhere: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, task = batch.column("x").to_numpy(zero_copy_only=False).view(U), batch.column("task").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(owned(x, 0 if everywhere else task).view(np.int64))], names=["x"])

    return run


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w, c = (batch.column(x).to_numpy(zero_copy_only=False).view(U) for x in ("w1", "check"))
        yield pa.RecordBatch.from_arrays([pa.array((mix(w) ^ c).view(np.int64))], names=["x"])


# --- slots


class PerfectHash:
    """A minimal perfect hash of different 64-bit numbers.

    Numbers are hashed to twice as many places; those alone in a place have it, the others
    go on to the next level. The slot of a number is the rank of its place among those held.
    """

    def __init__(self, x: np.ndarray):
        self.levels: list[tuple[int, int]] = []
        words, base = [], 0
        while len(x):
            size = (2 * len(x) + 63) // 64 * 64
            at = self._place(x, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(U))
            self.levels.append((base, size))
            base += size
            x = x[~alone[at]]
            if len(self.levels) > 200:
                raise ValueError("two keys are equal")
        self.bits = np.concatenate([*words, np.zeros(1, dtype=U)])
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)))

    @staticmethod
    def _place(x: np.ndarray, level: int, size: int) -> np.ndarray:
        return ((mix(x + U((level + 1) * int(_GOLDEN) % 2**64)) >> U(32)) * U(size) >> U(32)).astype(np.int64)

    def slots(self, x: np.ndarray) -> np.ndarray:
        """The slot of each number; -1, or any, for one that is not among the keys."""
        out = np.full(len(x), -1, dtype=np.int64)
        left = np.arange(len(x))
        for level, (base, size) in enumerate(self.levels):
            at = self._place(x[left], level, size) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(U)
            hit = word >> bit & U(1) != 0
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(word[hit] & ((U(1) << bit[hit]) - U(1)))
            left = left[~hit]
            if not len(left):
                break
        return out


class Slots:
    """Candidates by slot: the hash, and the stored keys by which what is found is verified."""

    def __init__(self, k: np.ndarray, key: list[np.ndarray]):
        self.n, self.seed = len(k), 0
        while True:  # until no two keys share a number
            x = self._numbers(k, key)
            if len(np.unique(x)) == len(x):
                break
            self.seed += 1
        self.hash = PerfectHash(x)
        slot = self.hash.slots(x)
        self.k = np.zeros(self.n, dtype=np.int8)
        self.k[slot] = k
        self.key = [np.zeros(self.n, dtype=U) for _ in KEY]
        for held, w in zip(self.key, key, strict=True):
            held[slot] = w

    def _numbers(self, k: np.ndarray, key: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(k), dtype=U)
        for n in range(1, LONGEST + 1):
            of = np.flatnonzero(k == n)
            out[of] = folded([w[of] for w in key[:n]], self.seed)
        return out

    def find(self, words: list[np.ndarray]) -> np.ndarray:
        """The slot of each phrase, or -1."""
        slot = self.hash.slots(folded(words, self.seed)) if self.n else np.full(len(words[0]), -1, dtype=np.int64)
        hit = np.flatnonzero(slot >= 0)
        there = slot[hit]
        same = self.k[there] == len(words)
        for w, held in zip(words, self.key, strict=False):
            same &= held[there] == w[hit]
        slot[hit[~same]] = -1
        return slot


def _count(slots, filters, seed: int):
    """(slice, salt, counts): the counts of one task by slot, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = slots.value, [f.value for f in filters]
        counts = np.zeros(-(-table.n // SLICE) * SLICE, dtype=np.int64)
        for block in _read(batches, seed):
            for k, at in block.places(held):
                slot = table.find(block.key(k, at)) if len(at) else at
                slot = slot[slot >= 0]
                if len(slot):
                    n = np.bincount(slot)
                    counts[: len(n)] += n
        salt = TaskContext.get().partitionId() % SALTS
        for s, part in enumerate(counts.reshape(-1, SLICE)):
            if part.any():
                yield _slice(s, salt, part)

    return run


def _slice(s: int, salt: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([salt], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "salt", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for s, salt, part in zip(*(batch.column(c).to_pylist() for c in ("slice", "salt", "counts")), strict=True):
            one = np.frombuffer(part, dtype=np.int64)
            held[s, salt] = held[s, salt] + one if (s, salt) in held else one
    for (s, salt), part in held.items():
        yield _slice(s, salt, part)


def _tree_sum(parts: DataFrame, n: int) -> np.ndarray:
    """The sum of the tasks' arrays: within each salt first, then over all; n counts in the end."""
    for salt in (F.col("salt"), F.lit(0)):
        parts = parts.select("slice", salt.alias("salt"), "counts").repartition("slice", "salt").mapInArrow(_add, "slice int, salt int, counts binary")
    out = np.zeros(-(-n // SLICE) * SLICE, dtype=np.int64)
    for row in parts.toLocalIterator():
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], dtype=np.int64)
    return out[:n]


def _read_cuts(slots, counts):
    """The counts of candidates and of the parts of their cuts, as far as they are in these slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, by_slot = slots.value, counts.value
        for batch in batches:
            k = batch.column("k").to_numpy(zero_copy_only=False)
            key = [batch.column(w).to_numpy(zero_copy_only=False).view(U) for w in KEY]
            out = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in COUNTS}
            for n in range(2, LONGEST + 1):
                of = np.flatnonzero(k == n)
                words = [w[of] for w in key[:n]]
                parts = {"a": words} | {f"l{c}": words[:c] for c in range(1, n)} | {f"r{c}": words[c:] for c in range(1, n)}
                for name, part in parts.items():
                    slot = table.find(part)
                    out[name][of[slot >= 0]] = by_slot[slot[slot >= 0]]
            yield pa.RecordBatch.from_arrays([pa.array(out[c]) if c in out else batch.column(c) for c in batch.schema.names], names=batch.schema.names)

    return run


# --- the operator


def _frequent_words(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int, int]:
    """Frequent words (lang, word, n, w1, check), all words by language (lang, n), the number of the former and the seed."""
    summed = rows.mapInArrow(_words(0), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    summed = checkpoint(summed.where(F.col("word").isNull() | (F.col("n") >= least)))
    seed = 0
    while True:
        words = summed.where("word is not null").mapInArrow(_numbered(seed), "lang string, word string, n long, w1 long, check long")
        if not words.groupBy("w1").count().where("count > 1").limit(1).count():
            break
        seed += 1
    return words, summed.where("word is null").select("lang", "n"), words.count(), seed


def _heavy_buckets(rows: DataFrame, lengths: Sequence[int], filters, seed: int, totals: DataFrame, least: int) -> DataFrame:
    """The buckets that reach ``least``; a slice has about ``SLICE_KEYS`` phrases of a length at most."""
    n, slices = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], 16
    while slices * SLICE_KEYS < n:
        slices *= 2
    dealt = rows.mapInArrow(_bucketed(lengths, filters, seed, slices), "slice int, task int, packed binary").repartition("slice")
    return checkpoint(dealt.sortWithinPartitions("slice").mapInArrow(_heavy(least), "x long, n long, task int"))


def _reports(rows: DataFrame, lengths: Sequence[int], filters, heavy: DataFrame, seed: int, everywhere: bool) -> DataFrame:
    """The phrases of heavy buckets, and some that pass the filter, as tasks report them."""
    own = _filter(heavy.mapInArrow(_owned_keys(everywhere), "x long"), heavy.count())
    return rows.mapInArrow(_phrases(lengths, filters, own, everywhere, seed), "lang string, k int, w1 long, w2 long, w3 long, w4 long, x long")


def _candidates(reports: DataFrame, heavy: DataFrame) -> DataFrame:
    return checkpoint(reports.join(heavy.select("x"), "x", "left_semi").select("lang", "k", *KEY, "x").distinct())


def _missed(heavy: DataFrame, counted: DataFrame, least: int) -> bool:
    """Whether what the counted phrases leave of some bucket's sum reaches ``least``."""
    found = counted.groupBy("x").agg(F.sum("a").alias("a"))
    return heavy.join(found, "x", "left").where(F.col("n") - F.coalesce("a", F.lit(0)) >= least).limit(1).count() > 0


def _with_counts(rows: DataFrame, candidates: DataFrame, filters, seed: int) -> DataFrame:
    """The candidates of two words and more with the counts of ``COUNTS``."""
    context = rows.sparkSession.sparkContext
    n_blocks = max(1, -(-candidates.count() // KEYS_AT_ONCE))
    block = F.pmod(F.xxhash64(*KEY), F.lit(n_blocks))
    read = candidates.where("k > 1").select("lang", "k", *KEY, "x", *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    for b in range(n_blocks):
        held = candidates.where(block == b).select("k", *KEY).toArrow()
        slots = Slots(held["k"].to_numpy(), [held[w].to_numpy().view(U) for w in KEY])
        sent = context.broadcast(slots)
        parts = rows.mapInArrow(_count(sent, filters, seed), "slice int, salt int, counts binary")
        counts = context.broadcast(_tree_sum(parts, slots.n))
        read = checkpoint(read.mapInArrow(_read_cuts(sent, counts), read.schema))
        sent.unpersist()
        counts.unpersist()
    return read


def _score(cut: int) -> Column:
    l, r = f"l{cut}", f"r{cut}"  # noqa: E741
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0))) div (cast({l} as decimal(19,0)) + cast({r} as decimal(19,0)))")
    return F.when(F.col("k") > cut, F.struct(score.cast("long").alias("score"), F.lit(cut).alias("cut"), F.col(l).alias("l"), F.col(r).alias("r")))


def _parts_of(key: str) -> Column:
    """The shorter phrases of two and three words inside a candidate, as structs."""
    zero = F.lit(0).cast("long")

    def part(first: int, k: int) -> Column:
        return F.struct(F.lit(k).alias("k"), *(F.col(f"{key}{first + j}").alias(f"w{j + 1}") if j < k else zero.alias(f"w{j + 1}") for j in range(3)))

    two, three = [part(f, 2) for f in (1, 2, 3)], [part(f, 3) for f in (1, 2)]
    return F.when(F.col("k") == 3, F.array(*two[:2])).otherwise(F.array(*two, *three))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language with at least ``least`` occurrences."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    words, totals, n_words, seed = _frequent_words(rows, least)
    word_filter = _filter(words.mapInArrow(_word_keys, "x long"), n_words)
    single = words.select("lang", F.lit(1).alias("k"), "w1", *(F.lit(0).cast("long").alias(w) for w in (*KEY[1:], "x")))
    heavy = {2: _heavy_buckets(rows, (2,), [word_filter], seed, totals, least)}
    for everywhere in (False, True):
        filters, candidates = [word_filter], single
        for k, lengths in ((2, (2,)), (3, (3, 4))):
            if k > 2:
                heavy[k] = _heavy_buckets(rows, lengths, filters, seed, totals, least)
            found = _candidates(_reports(rows, lengths, filters, heavy[k], seed, everywhere), heavy[k])
            filters.append(_filter(found.mapInArrow(_bucket_keys, "x long"), found.count()))
            candidates = candidates.unionByName(found)
        counted = _with_counts(rows, candidates, filters, seed)
        if everywhere or not any(_missed(heavy[k], counted.where(F.col("k") == 2 if k == 2 else F.col("k") > 2), least) for k in heavy):
            break
    counted = counted.where(F.col("a") >= least)

    scored = counted.withColumn("best", F.array_min(F.array(*(_score(c) for c in range(1, LONGEST)))))
    inside = counted.where("k > 2").select("a", F.inline(_parts_of("w"))).groupBy("k", *KEY[:3]).agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["k", *KEY[:3]], "left").where(F.col("longer").isNull() | (F.col("k") == LONGEST) | (100 * F.col("longer") < inside_percent * F.col("a")))
    kept = kept.select("lang", "k", *KEY, "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
    # the first of each language, with what ties with the last, in parts of it and then in all
    order = (F.desc("score"), F.desc("a"))
    for by in (("lang", F.pmod(F.xxhash64(*KEY), F.lit(SALTS))), ("lang",)):
        kept = kept.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= top).drop("place")
    return _spelled(checkpoint(kept), words, totals, top)


def _spelled(kept: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The phrases by their words, ranked."""
    one = kept.select("lang", *KEY, F.posexplode(F.slice(F.array(*KEY), F.lit(1), F.col("k"))).alias("at", "word_key"))
    spelled = one.join(words.select(F.col("w1").alias("word_key"), "word"), "word_key").groupBy("lang", *KEY).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    phrase = F.array_join(F.transform("parts", lambda p: p["word"]), " ")
    named = kept.join(spelled.select("lang", *KEY, phrase.alias("phrase")), ["lang", *KEY]).join(totals, "lang")
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.select("lang", F.row_number().over(place).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM p, range(1, 5) r(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE f >= 30 AND k >= 2),
u AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT u.lang, u.phrase, u.k, u.a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * u.a // (x.f + y.f))::BIGINT AS score
  FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(ws[1:cut], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(ws[cut + 1:u.k], ' ')
),
b AS (SELECT lang, phrase, k, a, arg_min(struct_pack(l := l, r := r, score := score), struct_pack(score := score, cut := cut)) AS best FROM s GROUP BY ALL),
i AS (SELECT c.lang, array_to_string(c.ws[j:j + m - 1], ' ') AS phrase, max(c.a) AS longer FROM c, range(2, 4) q(m), range(1, 4) e(j) WHERE m < c.k AND j + m - 1 <= c.k GROUP BY ALL),
g AS (SELECT b.lang, b.phrase, b.a, best.l AS l, best.r AS r, best.score AS score FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * b.a),
h AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM g)
SELECT lang, rank, phrase, a, l, r, n, score FROM h JOIN n USING (lang) WHERE rank <= 2000
"""
