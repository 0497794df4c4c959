"""Substring dedup by level-wise doubling of repeated word windows.

Levels go from a short length to the window, each at most twice the one before (13, 25
and 50 words). A short window that stands in one doc_id alone is given up together with
every full window it speaks for; one that repeats is extended to the next length, to the
right while the full window reaches that far and to the left else, until the full length
is reached or no candidate survives.

On the first level one short window speaks for each full window: the least by hash of
those inside it. Equal full windows have it at the same distance, so no repeat is lost,
and a twentieth of all short windows is shuffled. Neighbouring full windows with the same
short window form a run. After the last extension, runs that are equal from their first
to their last word are settled together, and only the run of the smallest doc_id among
equal ones is cut into its full windows, whatever the number of copies.

Runs, windows and whole texts are equal when two independent hashes are: words are
hashed by two functions, and sequences of them modulo 2**64 and modulo the prime
2**61 - 1; whole texts have 128 bits of xxh3 over their words. Texts equal as word
sequences are settled first, and only the copy with the smallest id goes on.

Defined results: a null or empty text has no words, keeps the empty string and
removes nothing; texts shorter than the window are never changed; a text of any length is
read whole; a null doc_id counts as larger than any other; rows that repeat a doc_id do
not dedupe each other, and those that repeat the text too are worked on once and have
equal results; an empty table gives an empty one. Columns other than doc_id and text are
ignored.
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
from docloom.llm.hashing import Words, anchor_runs, blocks, prefix, prime_prefix, prime_spans, spans

WINDOW, SHORTEST = 50, 16


def levels(window: int) -> tuple[int, list[int]]:
    """The first length, and the lengths to extend to before the window's own."""
    lengths = [-(-window // 2)]
    while lengths[-1] > SHORTEST:
        lengths.append(-(-lengths[-1] // 2))
    return lengths[-1], lengths[-2::-1] or lengths


def _lists(flat: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, kind))


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _whole(texts: list[bytes]) -> list[pa.Array]:
    """128 bits of each text's words as two numbers."""
    digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(t.split())) for t in texts), dtype=np.int64)
    return [pa.array(digest[0::2]), pa.array(digest[1::2])]


def _describe(window: int, short: int):
    """Per row: n_words, the digest of the words, and the runs as parallel arrays: short window's hash and place, first and last full window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in blocks(texts_of(batch)):
                words = Words(texts)
                grams, _ = words.grams(short)
                # a window lies in one text if its first and last word do
                last = words.doc[: max(0, len(words.doc) - window + 1)] == words.doc[window - 1 :]
                at, first, end = anchor_runs(grams, short, window, last)
                owner = words.doc[first] if len(first) else first
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
                base = words.first[owner]
                part = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("did"), part.column("tkey"), pa.array(np.diff(words.first), pa.int64()), *_whole(texts), _lists(grams[at].view(np.int64), cuts, pa.int64()), *(_lists(x - base, cuts, pa.int32()) for x in (at, first, end))],
                    names=["did", "tkey", "n_words", "d1", "d2", "h", "at", "first", "last"],
                )

    return run


def extended(at: np.ndarray, first: np.ndarray, last: np.ndarray, known: int, length: int, window: int) -> tuple[np.ndarray, ...]:
    """(row, place, first, last): the windows of ``length`` words that contain the known one, and the full windows each speaks for."""
    edge = at + length - window  # full windows from here on reach as far as the extension to the right
    rows = np.arange(len(at))
    right = np.maximum(first, edge) <= last
    left = first <= np.minimum(last, edge - 1)
    return (
        np.concatenate((rows[right], rows[left])),
        np.concatenate((at[right], at[left] + known - length)),
        np.concatenate((np.maximum(first, edge)[right], first[left])),
        np.concatenate((last[right], np.minimum(last, edge - 1)[left])),
    )


def _runs(batch: pa.RecordBatch, done: int, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The text number of each run in a slice of a batch, and the runs' columns."""
    column = batch.column("runs").slice(done, n)
    flat = column.flatten()
    count = np.asarray(column.value_lengths()).astype(np.int64)
    return np.repeat(np.arange(n), count), [np.asarray(flat.field(k)).astype(np.int64) for k in range(flat.type.num_fields)]


def _extend(known: int, length: int, window: int):
    """The next longer window of each run, and both hashes of all words that the run's full windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in blocks(unpacked(batch)):
                words = Words(texts)
                p, q = prefix(words.hash), prime_prefix(words.other())
                doc, (at, first, last) = _runs(batch, done, len(texts))
                row, at, first, last = extended(at, first, last, known, length, window)
                doc = doc[row]
                base = words.first[doc]
                part = batch.slice(done, len(texts))
                done += len(texts)
                take = pa.array(doc)
                hashes = spans(p, base + at, base + at + length), spans(p, base + first, base + last + window), prime_spans(q, base + first, base + last + window)
                yield pa.RecordBatch.from_arrays(
                    [*map(_longs, hashes), part.column("did").take(take), part.column("tkey").take(take), *(pa.array(x, pa.int32()) for x in (at, first, last))],
                    names=["h", "r1", "r2", "did", "tkey", "at", "first", "last"],
                )

    return run


def _windows(window: int):
    """Both hashes of every full window of the runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in blocks(unpacked(batch)):
                words = Words(texts)
                p, q = prefix(words.hash), prime_prefix(words.other())
                doc, (first, last) = _runs(batch, done, len(texts))
                size = last - first + 1
                start = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                doc = np.repeat(doc, size)
                at = words.first[doc] + start
                part = batch.slice(done, len(texts))
                done += len(texts)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [_longs(spans(p, at, at + window)), _longs(prime_spans(q, at, at + window)), part.column("did").take(take), part.column("tkey").take(take), pa.array(start, pa.int32())],
                    names=["w1", "w2", "did", "tkey", "start"],
                )

    return run


def _remove(window: int):
    """Cut the covered words and digest what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found, copy in zip(unpacked(batch), batch.column("found"), batch.column("copy").to_pylist(), strict=True):
                words = text.split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                if copy and len(words) >= window:
                    gone[0] = 1
                elif found.is_valid:
                    first, last = (np.asarray(found.values.field(k)) for k in (0, 1))
                    np.add.at(gone, first, 1)
                    np.add.at(gone, last + window, -1)
                covered = np.cumsum(gone)[:-1] > 0
                left = b" ".join(words if not covered.any() else [w for w, c in zip(words, covered.tolist(), strict=True) if not c])
                n_words.append(len(words))
                n_removed.append(int(covered.sum()))
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["did", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """The keys found in more than one doc_id, with the least."""
    found = rows.groupBy(*key).agg(F.min("did").alias("least"), F.max("did").alias("most"))
    return apart(found.where("least < most").select(*key, "least"), *key)


def _beside(text: DataFrame, runs: DataFrame, *columns: str) -> DataFrame:
    """The texts that have runs, with these columns of them."""
    held = runs.groupBy("did", "tkey").agg(F.collect_list(F.struct(*columns)).alias("runs"))
    return text.join(held, ["did", "tkey"]).select("did", "tkey", "packed", "runs")


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: texts without the word windows that start in a smaller doc_id."""
    if window < 2:
        raise ValueError("window must be 2 or more")
    repeats = ids_repeat(docs)
    known, longer = levels(window)
    every = packed(docs, repeats)
    # what is joined with runs has one row of those that repeat id and text
    text = one_of_each(every, repeats)
    described = keyed(docs, repeats).mapInArrow(_describe(window, known), "did long, tkey long, n_words long, d1 long, d2 long, h array<long>, at array<int>, first array<int>, last array<int>")
    described = checkpoint(one_of_each(described) if repeats else described)
    whole = ["d1", "d2", "n_words"]
    copies = described.select("did", "tkey", *whole).join(_repeated(described, *whole), whole).where("did > least").select("did", "tkey").distinct()
    originals = described.select("did", "tkey", F.explode(F.arrays_zip("h", "at", "first", "last")).alias("r")).join(copies, ["did", "tkey"], "left_anti")
    rows = originals.select("did", "tkey", "r.*")
    for length in longer:
        alive = rows.join(_repeated(rows, "h").drop("least"), "h", "left_semi")
        rows = _beside(text, alive, "at", "first", "last").mapInArrow(_extend(known, length, window), "h long, r1 long, r2 long, did long, tkey long, at int, first int, last int")
        known = length
    runs = rows.join(_repeated(rows, "h").drop("least"), "h", "left_semi").select("r1", "r2", "did", "tkey", "first", "last")
    settled = runs.join(_repeated(runs, "r1", "r2"), ["r1", "r2"], "left")
    later = F.coalesce(F.col("did") > F.col("least"), F.lit(False))
    windows = _beside(text, settled.where(~later), "first", "last").mapInArrow(_windows(window), "w1 long, w2 long, did long, tkey long, start int")
    single = windows.join(_repeated(windows, "w1", "w2"), ["w1", "w2"]).where("did > least").select("did", "tkey", F.col("start").alias("first"), F.col("start").alias("last"))
    found = settled.where(later).select("did", "tkey", "first", "last").unionAll(single)
    ranges = found.groupBy("did", "tkey").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    marks = (every if repeats else text).join(ranges, ["did", "tkey"], "left").join(copies.withColumn("copy", F.lit(True)), ["did", "tkey"], "left")
    out = marks.select("did", "packed", "found", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(_remove(window), "did long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(public_id(), "n_words", "n_removed", "kept_sha256", "kept")
