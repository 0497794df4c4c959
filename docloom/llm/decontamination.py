"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared as lower-case characters with white space collapsed. Each
benchmark item is cut into windows of ``WINDOW`` characters (half overlapping, the
last one flush with its end; a shorter item is one window). A document leaks an
item when some part of it aligns with one of the item's windows within the edit
budget of ``len(window) * RATE`` insertions, deletions and substitutions.

A window of n characters that aligns within e edits shares at least
``n + 1 - q * (e + 1)`` q-grams with the document, all within e diagonals of each
other. So the shared q-grams of a document and a window are counted in diagonal
bands of twice that width that overlap by half, every e + 1 diagonals lying within
one of them. Bands that reach the bound are verified by a banded edit distance,
many bands at a time; none else is aligned.

The benchmark is the query set: it is read in blocks of at most ``BLOCK_CHARS``
characters by a hash of the item, and each block's index, of a size bounded by
that, goes to every task. Documents are only scanned, never shuffled.

Items of fewer than ``MIN_CHARS`` characters are sought apart, so that their low bounds
do not let more of the documents through to the others: from ``SHORT_CHARS``
characters on within the same budget, below it as they are, between word bounds.

Defined results: null and empty texts leak nothing; items with fewer than
``LEAST_CHARS`` characters are skipped, as words that many clean documents hold;
repeated items answer under each item_id; repeated documents each on their own; a
null item_id or doc_id stays null; a text of any length is read whole; empty tables leak
nothing. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import NULL_ID, row_key
from docloom.llm.hashing import blocks, join, mix

WINDOW, RATE, Q, MIN_CHARS = 64, 0.08, 8, 40
SHORT_CHARS, LEAST_CHARS = 25, 8
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22


def normalise(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def characters(text: bytes) -> np.ndarray:
    """One small number a character: bytes for ASCII, code points (as uint32) else."""
    if text.isascii():
        return np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    return np.frombuffer(text.decode("utf-8", errors="replace").encode("utf-32-le"), dtype=np.uint32)


@dataclass
class Index:
    """Windows of a block of items and their q-grams, sorted by hash."""

    windows: list[np.ndarray]
    item: np.ndarray
    budget: np.ndarray
    need: np.ndarray
    grams: np.ndarray
    window: np.ndarray
    at: np.ndarray
    known: np.ndarray


def _gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each place on, by doubling; q is a power of two."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    out, span = codes.astype(np.uint64), 1
    while span < q:
        first = out[: len(out) - span] * np.uint64(0x9E3779B97F4A7C15)
        first ^= first >> np.uint64(32)
        first += out[span:]
        out, span = first, 2 * span
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def build(texts: list[bytes], window: int = WINDOW, rate: float = RATE, q: int = Q, least: int = MIN_CHARS, most: float = float("inf")) -> Index:
    """The index of the items with ``least`` characters or more and fewer than ``most``."""
    if q & (q - 1):
        raise ValueError("q must be a power of two")
    parts: list[np.ndarray] = []
    item: list[int] = []
    for k, text in enumerate(texts):
        codes = characters(normalise(text))
        if not least <= len(codes) < most:
            continue
        last = max(0, len(codes) - window)
        for start in sorted({*range(0, last, window // 2), last}):
            parts.append(codes[start : start + window])
            item.append(k)
    budget = np.array([int(len(p) * rate) for p in parts], dtype=np.int64)
    need = np.array([len(p) for p in parts], dtype=np.int64) + 1 - q * (budget + 1)
    if len(need) and need.min() < 1:
        raise ValueError("the edit budget leaves no q-gram to count: lower the rate or q")
    grams = [_gram_hashes(p, q) for p in parts]
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    by = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(parts)), [len(g) for g in grams]).astype(np.int64)
    at = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    known = np.zeros(1 << FILTER_BITS, dtype=bool)
    known[(flat >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Index(parts, np.array(item, dtype=np.int64), budget, need, flat[by], owner[by], at[by], known)


def _crowded(place: np.ndarray, need: int, reach: int) -> np.ndarray:
    """Places that have ``need`` of them, themselves included, within some ``reach`` characters; others cannot be part of a match."""
    if len(place) < need:
        return place[:0]
    start = place[need - 1 :] - place[: len(place) - need + 1] < reach
    change = np.zeros(len(place) + 1, dtype=np.int64)
    change[: len(start)] += start
    change[need : need + len(start)] -= start
    return place[np.cumsum(change[:-1]) > 0]


def _shared(index: Index, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the text, window, place in the window) of each shared q-gram."""
    place = np.flatnonzero(index.known[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    place = _crowded(place, int(index.need.min()), int(max(len(w) + e for w, e in zip(index.windows, index.budget.tolist(), strict=True))))
    low = np.searchsorted(index.grams, hashes[place], side="left")
    count = np.searchsorted(index.grams, hashes[place], side="right") - low
    row = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(place, count), index.window[row], index.at[row]


def _distances(windows: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Least edits that turn each window into some part of its text, on the diagonals that the text leaves.

    Rows of equal length; a text is longer than its window by the width of the band less one, padded by 0xFFFFFFFF.
    """
    n, size = windows.shape
    width = texts.shape[1] - size + 1
    step = np.arange(width, dtype=np.int32)
    row = np.zeros((n, width), dtype=np.int32)  # by diagonal; a part can begin on any
    for k in range(size):
        new = row + (texts[:, k : k + width] != windows[:, k : k + 1])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        # insertions run along the row: new[d] = min over i <= d of new[i] + d - i
        row = np.minimum.accumulate(new - step, axis=1) + step
    return row.min(axis=1)


def find(index: Index, texts: list[bytes], q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the best region of each leaked item; offsets in the normalised text."""
    if not len(index.item):
        return []
    codes = [characters(t) for t in texts]
    gap = np.array([0xFFFFFFFF], dtype=np.uint32)
    flat = np.concatenate([x for c in codes for x in (c, gap)])
    first = np.cumsum([0, *(len(c) + 1 for c in codes)])
    place, window, at = _shared(index, _gram_hashes(flat, q))
    if not len(place):
        return []
    doc = np.searchsorted(first, place, side="right") - 1
    # bands of 2w diagonals every w, w > e: any e + 1 neighbouring diagonals lie in one
    width = index.budget[window] + 1
    diagonal = place - at - first[doc] + len(flat)
    band = diagonal // width
    both = [np.concatenate((x, x)) for x in (doc, window)] + [np.concatenate((band, band - 1)), np.concatenate((at, at)), np.concatenate((place, place))]
    key = mix(both[0].astype(np.uint64) * np.uint64(1 << 32) + both[1].astype(np.uint64)) + both[2].astype(np.uint64)
    by = np.argsort(key, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], key[by][1:] != key[by][:-1])))
    count = np.diff(np.concatenate((cut, [len(by)])))
    head = by[cut]
    enough = count >= index.need[both[1][head]]
    head = head[enough]
    if not len(head):
        return []
    d, w, b = both[0][head], both[1][head], both[2][head]
    e = index.budget[w]
    low = b * (e + 1) - len(flat)
    out: dict[tuple[int, int], tuple[int, int, int, int, int]] = {}
    sizes = np.array([len(index.windows[k]) for k in w.tolist()])
    for size in np.unique(sizes).tolist():
        chosen = np.flatnonzero(sizes == size)
        for k in range(0, len(chosen), 512):
            rows = chosen[k : k + 512]
            reach = int(size + 4 * e[rows].max() + 2)
            start = first[d[rows]] + np.maximum(low[rows] - e[rows], 0)
            spot = start[:, None] + np.arange(reach)
            end = first[d[rows] + 1] - 1
            text = np.where(spot < end[:, None], flat[np.minimum(spot, len(flat) - 1)], gap)
            edits = _distances(np.stack([index.windows[x] for x in w[rows].tolist()]), text)
            for r, s, n in zip(rows.tolist(), start.tolist(), edits.tolist(), strict=True):
                if n <= e[r]:
                    pair = (int(d[r]), int(index.item[w[r]]))
                    begin = s - int(first[d[r]])
                    finish = min(begin + reach, len(codes[d[r]]))
                    old = out.get(pair)
                    out[pair] = (*pair, begin, finish, n) if old is None else (*pair, min(begin, old[2]), max(finish, old[3]), min(n, old[4]))
    return sorted(out.values())


def build_exact(texts: list[bytes], least: int = LEAST_CHARS, most: int = SHORT_CHARS) -> dict[int, list]:
    """(hashes, items, codes) of the items with ``least`` characters or more and fewer than ``most``, by the number of characters hashed."""
    held: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for k, text in enumerate(texts):
        codes = characters(normalise(text))
        if least <= len(codes) < most:
            q = 1 << len(codes).bit_length() - 1
            held.setdefault(q, []).append((int(_gram_hashes(codes[:q], q)[0]), k, codes))
    return {q: [np.array([x[0] for x in found], dtype=np.uint64), found] for q, found in ((q, sorted(x, key=lambda x: x[:2])) for q, x in held.items())}


def find_exact(index: dict[int, list], texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """As ``find``, of items that the text holds as they are with no letter, digit or underscore joined to their ends."""
    out: dict[tuple[int, int], tuple[int, int, int, int, int]] = {}
    for d, text in enumerate(texts) if index else ():
        codes = characters(text)
        word = lambda k: 0 <= k < len(codes) and (chr(codes[k]).isalnum() or codes[k] == 95)  # noqa: B023, E731
        for q, (hashes, found) in index.items():
            grams = _gram_hashes(codes, q)
            low, high = np.searchsorted(hashes, grams, side="left"), np.searchsorted(hashes, grams, side="right")
            for at in np.flatnonzero(high > low).tolist():
                for _, item, wanted in found[low[at] : high[at]]:
                    end = at + len(wanted)
                    if np.array_equal(codes[at:end], wanted) and not (word(at - 1) and word(at)) and not (word(end - 1) and word(end)):
                        old = out.get((d, item))
                        out[d, item] = (d, item, at if old is None else old[2], end, 0)
    return sorted(out.values())


@lru_cache(maxsize=1)
def _built(token: str, items: tuple[bytes, ...]) -> tuple[Index, Index, dict[int, list]]:
    """The index of one block of items, for all tasks of a worker process."""
    texts = list(items)
    return build(texts), build(texts, least=SHORT_CHARS, most=MIN_CHARS), build_exact(texts)


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, ids, items = shared.value
        index, short, exact = _built(token, items)
        for batch in batches:
            done = 0
            texts = [normalise(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for part in blocks(texts):
                found = sorted(find(index, part) + find(short, part) + find_exact(exact, part))
                which = pa.array([f[0] for f in found], pa.int64())
                rows = [batch.column(c).slice(done, len(part)).take(which) for c in ("row", "tkey")]
                done += len(part)
                columns = [pa.array([ids[f[1]] for f in found], pa.int64()), *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4))]
                yield pa.RecordBatch.from_arrays([*rows, *columns], names=["row", "tkey", "item_id", "start", "end", "edits"])

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int) -> DataFrame:
    """``leaks`` with the tkey of the document's row."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-int(total) // block_chars))
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), row_key(docs)[1].alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    out = None
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).collect()
        part.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [r["item_id"] for r in part], tuple(r["text"].encode() for r in part)))
        found = rows.mapInArrow(_scan(shared), "row long, tkey long, item_id long, start long, end long, edits long")
        out = found if out is None else out.unionAll(found)
    return out.withColumnRenamed("row", "doc_id")


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, end, edits: every pair of a document and an item it leaks.

    start and end bound the aligned regions, in characters of the normalised text;
    edits is the least number over the item's windows.
    """
    return _leaks(docs, benchmark, block_chars).drop("tkey")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents that leak no item, with all their columns; rows that share a doc_id, or have none, are judged each on its own."""
    leaked = _leaks(docs, benchmark, BLOCK_CHARS).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("leaked_did"), F.col("tkey").alias("leaked_tkey")).distinct()
    did, tkey = row_key(docs)
    return docs.join(leaked, (did == leaked["leaked_did"]) & (tkey == leaked["leaked_tkey"]), "left_anti")
