"""Line dedup with two Bloom filters.

One pass sends the hashes of each partition's line keys, each once with a mark where the
partition holds it in several texts, to the slices of two filters, cut by hash so that no task holds
all: a once-seen filter and, for hashes that were set before or are marked, a twice-seen
filter. Only lines that the twice-seen filter knows are shuffled, to be counted exactly by
their whole key; the surviving occurrence is the one in the largest doc_id holding the key.

The filters are sized from the number of lines, ``LINE_BITS`` bits each, up to
``MOST_BITS`` bits, which bounds what is broadcast. Above that number of lines they let
more single lines through, which costs shuffle but never changes a result.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points always stay; repeated lines within one document count
once, and all of them stay or go together; rows that repeat a doc_id count as one
document; a null doc_id counts as larger than any other; a text or line of any length is
read whole; an empty table gives an empty one. Columns other than doc_id and text are
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

from docloom.llm.common import apart, checkpoint, ids_repeat, keyed, public_id, texts_of
from docloom.llm.hashing import mix

MIN_CHARS, MIN_DOCS = 20, 3
SLICES, PROBES = 64, 3
LINE_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 31


def line_key(line: bytes) -> bytes:
    """Bytes strip and lower touch ASCII only: exactly 0x20, 0x09-0x0D and A-Z."""
    return line.strip().lower()


def _long_keys(text: bytes, min_chars: int) -> list[bytes]:
    keys = {line_key(line) for line in text.split(b"\n")} if len(text) >= min_chars else ()
    return [k for k in keys if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), dtype=np.uint64, count=len(keys))


def _bits(h: np.ndarray, width: int) -> np.ndarray:
    """Places of each hash in its slice of ``width`` bits; the slice is its first six bits."""
    return np.stack([(mix(h + np.uint64(k)) % np.uint64(width)).astype(np.int64) for k in range(PROBES)])


def filter_bits(lines: int) -> int:
    bits = LEAST_BITS
    while bits < min(MOST_BITS, LINE_BITS * lines):
        bits *= 2
    return bits


def _ask(min_chars: int):
    """The hashes of a partition's keys by slice; first those held by several of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_hashes([k for text in texts_of(batch) for k in _long_keys(text, min_chars)]) for batch in batches]
        h, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        slices = (h >> np.uint64(58)).astype(np.int64)
        cuts = np.searchsorted(slices, np.arange(SLICES + 1))
        for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a < b:
                many = count[a:b] > 1
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([int(many.sum())], pa.int64()), pa.array([np.concatenate((h[a:b][many], h[a:b][~many])).tobytes()], pa.binary())], names=["slice", "many", "hashes"])

    return run


def _fill(width: int):
    """Sorted by slice: the twice-seen filter of all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, np.zeros(0, bool), np.zeros(0, bool)
        row = lambda: pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["slice", "twice"])
        for batch in batches:
            for k, many, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    if current is not None:
                        yield row()
                    current, once, twice = k, np.zeros(width, dtype=bool), np.zeros(width, dtype=bool)
                at = _bits(np.frombuffer(hashes, dtype=np.uint64), width)
                again = once[at].all(axis=0)
                again[:many] = True
                twice[at[:, again]] = True
                once[at] = True
        if current is not None:
            yield row()

    return run


def twice_seen(text: DataFrame, min_chars: int, bits: int) -> bytes:
    """The twice-seen filter, packed: bits / 8 bytes on the driver."""
    asked = text.mapInArrow(_ask(min_chars), "slice int, many long, hashes binary")
    filled = asked.repartition(SLICES, "slice").sortWithinPartitions("slice").mapInArrow(_fill(bits // SLICES), "slice int, twice binary")
    found = {row["slice"]: bytes(row["twice"]) for row in filled.collect()}
    return b"".join(found.get(k, bytes(bits // SLICES // 8)) for k in range(SLICES))


def _suspects(min_chars: int, bits: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, dtype=np.uint8)
        width = bits // SLICES
        for batch in batches:
            keys: list[bytes] = []
            owner: list[int] = []
            for k, text in enumerate(texts_of(batch)):
                mine = _long_keys(text, min_chars)
                keys += mine
                owner += [k] * len(mine)
            h = _hashes(keys)
            at = _bits(h, width) + (h >> np.uint64(58)).astype(np.int64) * width
            hit = np.flatnonzero((packed[at >> 3] & (128 >> (at & 7))).all(axis=0))
            take = pa.array(np.array(owner, dtype=np.int64)[hit])
            for k in range(0, max(1, len(hit)), 20_000):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take[k : k + 20_000]) for c in ("did", "tkey")), pa.array([keys[i] for i in hit[k : k + 20_000].tolist()], pa.binary())], names=["did", "tkey", "key"])

    return run


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for text, gone in zip(texts_of(batch), batch.column("gone").to_pylist(), strict=True):
            lines = text.split(b"\n")
            kept = lines
            if gone:
                dropped = set(gone)
                kept = [x for x in lines if line_key(x) not in dropped]
            left = b"\n".join(kept)
            rows.append((len(lines), len(lines) - len(kept), hashlib.sha256(left).hexdigest(), left.decode()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))], names=["row", "n_lines", "n_dropped", "kept_sha256", "kept"])


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, kept, and the columns named in ``carry``. ``bits``: of each filter, a multiple of 512."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    repeats = ids_repeat(docs)
    text = keyed(docs, repeats)
    context = docs.sparkSession.sparkContext
    if bits is None:
        bits = filter_bits(text.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0)
    shared = context.broadcast(twice_seen(text, min_chars, bits))
    held = checkpoint(text.mapInArrow(_suspects(min_chars, bits, shared), "did long, tkey long, key binary").distinct())
    # a document is an id, whatever the number of its rows
    holders = held.select("did", "key").distinct() if repeats else held
    known = holders.groupBy("key").agg(F.count("*").alias("n"), F.max("did").alias("largest")).where(F.col("n") >= min_docs).drop("n")
    gone = held.join(apart(known, "key"), "key").where("did < largest").groupBy("did", "tkey").agg(F.collect_list("key").alias("gone"))
    extra = F.struct(*(F.col(c) for c in carry)).alias("extra") if carry else F.lit(None).cast("string").alias("extra")
    rows = keyed(docs, repeats, extra).join(gone, ["did", "tkey"], "left")
    out = rows.select(F.struct("did", "extra").alias("row"), "text", "gone")
    kind = out.schema["row"].dataType.simpleString()
    done = out.mapInArrow(_drop, f"row {kind}, n_lines long, n_dropped long, kept_sha256 string, kept string")
    return done.select(public_id("row.did"), "n_lines", "n_dropped", "kept_sha256", "kept", *(F.col(f"row.extra.{c}").alias(c) for c in carry))
