"""Fill-in-middle transformation of whole texts, and its inverse.

A text is decoded to an array of UTF-32 code points. A unit is what
``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`` matches from left to right: it
ends where a code point that is no space is followed by one that is, or with the text.
Two of the n + 1 places between units are drawn for each document from the SHA-256 of
``seed:doc_id``; the array is sliced there and the three pieces are put in the order
that was drawn, each after its mark.

No mark can arise where two pieces meet, as no mark has a border with itself or
another; texts that hold a mark are left plain. So an output holds each mark once, which
tells where the pieces are, and ``restored`` rebuilds the text from output and form.

Defined results: null and empty texts are plain, with no units; a text of any length is
cut whole; a text of spaces alone is one unit; bytes that are not UTF-8 are one code
point each and stay as they are; a null doc_id is drawn as "null"; rows that repeat a
doc_id are drawn alike; an empty table gives an empty one. Other columns are ignored,
but for those named in ``carry``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docloom.llm.common import texts_of
from docloom.llm.hashing import blocks

SEED, PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
#: Bytes of output that go to Spark together, unless one text is longer.
TOGETHER = 4_000_000


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), dtype="<u4")


def encoded(points: np.ndarray) -> bytes:
    return points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def unit_bounds(points: np.ndarray) -> np.ndarray:
    """0 and the end of each unit, in code points."""
    if not len(points):
        return np.zeros(1, dtype=np.int64)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    return np.concatenate(([0], np.flatnonzero(~space[:-1] & space[1:]) + 1, [len(points)]))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four groups of eight digits of the hash, as unsigned integers."""
    digits = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]


def cut(text: bytes, doc_id: int | None, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and of middle, and the output."""
    points = code_points(text)
    bounds = unit_bounds(points)
    n = len(bounds) - 1
    one, two, plain, order = draws(seed, doc_id)
    if not text or plain % 100 >= 100 - plain_percent or any(m in text for m in MARKS):
        return n, "plain", None, None, text
    a, b = (int(bounds[k]) for k in sorted((one % (n + 1), two % (n + 1))))
    prefix, middle, suffix = (encoded(x) for x in (points[:a], points[a:b], points[b:]))
    p, s, m = MARKS
    if order % 100 < suffix_first_percent:
        return n, "spm", a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def _transform(seed: int, plain_percent: int, suffix_first_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, done = [t or b"" for t in texts_of(batch)], batch.column("doc_id").to_pylist(), 0
            for part in blocks(texts, TOGETHER):
                n, form, prefix, middle, output = zip(*(cut(t, d, seed, plain_percent, suffix_first_percent) for t, d in zip(part, ids[done:], strict=False)), strict=True)
                made = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())]
                carried = [batch.column(k).slice(done, len(part)) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
                yield pa.RecordBatch.from_arrays([*carried, *made], names=[*(x for x in batch.schema.names if x != "text"), "n", "form", "prefix_chars", "middle_chars", "output"])
                done += len(part)

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, columns to carry, n, form (plain, psm or spm), prefix_chars, middle_chars, output.

    ``plain_percent`` of the documents stay plain; of the others ``suffix_first_percent``
    become spm. A column to carry must not have the name of one that is made.
    """
    made = [StructField(name, StringType() if name in ("form", "output") else LongType()) for name in ("n", "form", "prefix_chars", "middle_chars", "output")]
    if clash := {"doc_id", "text", *(f.name for f in made)} & set(carry):
        raise ValueError(f"cannot carry {sorted(clash)}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    schema = StructType([*(f for f in rows.schema.fields if f.name != "text"), *made])
    return rows.mapInArrow(_transform(seed, plain_percent, suffix_first_percent), schema)


def _between(output: Column, before: str, after: str) -> Column:
    """What stands after one mark and before the other; each is there once. Works on bytes, whatever they are."""
    return F.substring_index(F.substring_index(output, after, 1), before, -1)


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(_between(output, PREFIX, SUFFIX), middle, _between(output, SUFFIX, MIDDLE))
    spm = F.concat(_between(output, PREFIX, MIDDLE), middle, _between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(done: DataFrame) -> DataFrame:
    """The result with hashes in place of the output."""
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(doc_id::VARCHAR, 'null')) AS h
  FROM documents
),
d AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
p AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle, array_to_string(list_slice(u, b + 1, n), '') AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
