"""Next-fit packing of units into chunks of bounded size.

``pack_fold`` is a fold over the counts that stays in the JVM: right for the
hundreds of units of a usual text. ``pack`` does the same through Arrow in linear
time for texts of any length, and splits or reports units above the limit.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T

TARGET_TOKENS, MAX_TOKENS, MAX_WORDS = 360, 480, 250
TokenCounter = Callable[[str], int]
_WORD = re.compile(r"\S+")
#: Rows of an Arrow batch that are Python objects at a time.
ROWS = 128
_MARKER = re.compile(T.LIST_MARKER.removeprefix("(?U)"))
_END = re.compile(T.SENTENCE_END.removeprefix("(?U)"))

LEFT_OUT = "array<struct<place:int,unit:string,tokens:int>>"
CHUNKS = "array<struct<text:string,tokens:int,words:int,units:int>>"
_LEFT = pa.list_(pa.struct([("place", pa.int32()), ("unit", pa.string()), ("tokens", pa.int32())]))
_CHUNKS = pa.list_(pa.struct([("text", pa.string()), ("tokens", pa.int32()), ("words", pa.int32()), ("units", pa.int32())]))


def count_words(text: str) -> int:
    """The default token counter: words."""
    return len(_WORD.findall(text))


def split_sentences(text: str) -> list[str]:
    cut = _END.sub(lambda m: m[1] + T.MARK, text)
    return [s for s in (p.strip() for p in cut.split(T.MARK)) if s]


def split_oversized(unit: str, count: TokenCounter, max_tokens: int) -> list[str]:
    """Parts of a list item (by sentence) or of a table row (by fields, as many as fit); none if a part is still too long."""
    marker = _MARKER.match(unit)
    if marker:
        parts = split_sentences(unit[marker.end() :].strip())
        if len(parts) < 2:
            return []
        parts[0] = marker[0] + parts[0]
    else:
        fields = [f for f in map(str.strip, unit.split(";")) if f] if ";" in unit else []
        if len(fields) < 2:
            return []
        parts = [fields[0]]
        for field in fields[1:]:
            wider = f"{parts[-1]}; {field}"
            if count(wider) > max_tokens:
                parts.append(field)
            else:
                parts[-1] = wider
    return parts if all(count(p) <= max_tokens for p in parts) else []


def pack_units(
    units: list[str], count: TokenCounter = count_words, target_tokens: float = TARGET_TOKENS, max_tokens: float = MAX_TOKENS, max_words: int | None = None, on_oversize: str = "error", left: list | None = None
) -> list[tuple[str, int, int, int]]:
    """(text, tokens, words, units) of each chunk.

    ``on_oversize``: "error", "skip" (after trying to split) or "drop" (without). Units
    that are in no chunk go to ``left`` as (place, unit, tokens). Each is counted once.
    """
    if on_oversize not in ("error", "skip", "drop"):
        raise ValueError("on_oversize must be error, skip or drop")
    out: list[tuple[str, int, int, int]] = []
    held: list[str] = []
    tokens = words = 0
    left = [] if left is None else left

    def add(part: str, n: int, w: int) -> None:
        nonlocal held, tokens, words
        if held and (tokens + n > target_tokens or (max_words is not None and words + w > max_words)):
            out.append((" ".join(held), tokens, words, len(held)))
            held, tokens, words = [], 0, 0
        held.append(part)
        tokens, words = tokens + n, words + w

    def sizes(part: str) -> tuple[int, int]:
        n = count(part)
        return n, n if count is count_words else count_words(part)

    for place, unit in enumerate(units):
        n, w = sizes(unit)
        if n > max_tokens:
            parts = split_oversized(unit, count, int(max_tokens)) if on_oversize != "drop" else []
            if not parts and on_oversize == "error":
                raise ValueError(f"a unit of {n} tokens exceeds {max_tokens}")
            if not parts:
                left.append((place, unit, n))
            for part in parts:
                add(part, *sizes(part))
        elif max_words is not None and w > max_words:
            if on_oversize == "error":
                raise ValueError(f"a unit exceeds {max_words} words")
            left.append((place, unit, n))
        else:
            add(unit, n, w)
    if held:
        out.append((" ".join(held), tokens, words, len(held)))
    return out


def left_out_units(units: list[str], count: TokenCounter = count_words, max_tokens: float = MAX_TOKENS, max_words: int | None = None) -> list[tuple[int, str, int]]:
    """(place, unit, tokens) of the units that ``pack_units`` has in no chunk with "skip": above a limit, and not to be split."""
    left: list[tuple[int, str, int]] = []
    pack_units(units, count, max_tokens=max_tokens, max_words=max_words, on_oversize="skip", left=left)
    return left


def pack_all(units: Column, count: TokenCounter = count_words, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS, max_words: int | None = None, on_oversize: str = "skip") -> Column:
    """chunks, as structs (text, tokens, words, units), and left, the units in none of them, as structs (place, unit, tokens); both of one pass over an array of units."""

    def some(columns: pa.Array) -> pa.Array:
        chunks, left = [], []
        for units_ in columns.to_pylist():
            left.append([])
            chunks.append([dict(zip(("text", "tokens", "words", "units"), c, strict=True)) for c in pack_units(units_ or [], count, target_tokens, max_tokens, max_words, on_oversize, left[-1])])
        rest = [[dict(zip(("place", "unit", "tokens"), x, strict=True)) for x in each] for each in left]
        return pa.StructArray.from_arrays([pa.array(chunks, _CHUNKS), pa.array(rest, _LEFT)], names=["chunks", "left"])

    def run(columns: pa.Array) -> pa.Array:
        return pa.concat_arrays([some(columns.slice(k, ROWS)) for k in range(0, max(1, len(columns)), ROWS)])

    run.__annotations__ = {"columns": pa.Array, "return": pa.Array}  # read by arrow_udf
    return F.arrow_udf(run, f"chunks {CHUNKS}, left {LEFT_OUT}")(units)


def left_out(units: Column, count: TokenCounter = count_words, max_tokens: int = MAX_TOKENS, max_words: int | None = None) -> Column:
    """The units of an array that ``pack`` has in no chunk with "skip", as structs (place, unit, tokens)."""
    return pack_all(units, count, max_tokens=max_tokens, max_words=max_words)["left"]


def pack(units: Column, count: TokenCounter = count_words, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS, max_words: int | None = None, on_oversize: str = "error") -> Column:
    """Chunks of an array of units, as structs (text, tokens, words, units)."""
    return pack_all(units, count, target_tokens, max_tokens, max_words, on_oversize)["chunks"]


def pack_fold(units: Column, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS, max_words: int | None = None) -> Column:
    """``pack`` counting words and dropping units above the limits, as a fold without Python."""
    counted = F.filter(F.transform(units, lambda u: F.struct(u.alias("u"), T.word_count(u).alias("n"))), lambda x: (x["n"] <= max_tokens) & (F.lit(True) if max_words is None else x["n"] <= max_words))
    limit = target_tokens if max_words is None else min(target_tokens, max_words)
    # the fold only notes after how many units each chunk ends; texts are joined once, from slices
    empty = F.struct(F.lit(0).alias("count"), F.lit(0).alias("units"), F.array().cast("array<int>").alias("ends"))

    def step(s: Column, x: Column) -> Column:
        full = (s["units"] > F.coalesce(F.try_element_at(s["ends"], F.lit(-1)), F.lit(0))) & (s["count"] + x["n"] > limit)
        return F.struct(
            F.when(full, x["n"]).otherwise(s["count"] + x["n"]).alias("count"),
            (s["units"] + 1).alias("units"),
            F.when(full, F.array_append(s["ends"], s["units"])).otherwise(s["ends"]).alias("ends"),
        )

    def texts(given: Column) -> Column:
        bounds = F.aggregate(given, empty, step, lambda s: F.when(s["units"] > 0, F.array_append(s["ends"], s["units"])).otherwise(s["ends"]))

        def cut(ends: Column) -> Column:
            starts = F.concat(F.array(F.lit(0)), ends)
            parts = F.transform(ends, lambda end, k: F.slice(given, F.element_at(starts, k + 1) + 1, end - F.element_at(starts, k + 1)))
            return F.transform(parts, lambda c: F.struct(F.array_join(F.transform(c, lambda x: x["u"]), " ").alias("text"), F.size(c).alias("units")))

        return T.let(bounds, cut)

    return T.let(counted, texts)


def presentation_texts(units: Column, max_words: int = MAX_WORDS) -> Column:
    """Texts of at most ``max_words`` words, cut between units only; null if a unit is longer."""

    def texts(given: Column) -> Column:
        fits = ~F.exists(given, lambda u: T.word_count(u) > max_words)
        return F.when(fits, F.transform(pack_fold(given, max_words, max_words), lambda c: c["text"]))

    return T.let(units, texts)


def chunk_documents(docs: DataFrame, target_tokens: int = TARGET_TOKENS, max_tokens: int = MAX_TOKENS, max_words: int | None = None, on_oversize: str = "skip", count: TokenCounter = count_words) -> DataFrame:
    """Chunk records of (doc_id, text): doc_id, chunk_id, posicion, num_tokens, texto."""
    packed = docs.select("doc_id", F.posexplode(pack(T.sentences(F.col("text")), count, target_tokens, max_tokens, max_words, on_oversize)).alias("posicion", "chunk"))
    return packed.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit("-"), F.lpad(F.col("posicion").cast("string"), 5, "0")).alias("chunk_id"),
        "posicion",
        F.col("chunk.tokens").alias("num_tokens"),
        F.col("chunk.text").alias("texto"),
    )


def oversize_units(docs: DataFrame, max_tokens: int = MAX_TOKENS, max_words: int | None = None, count: TokenCounter = count_words) -> DataFrame:
    """doc_id, place, unit, tokens of the units of (doc_id, text) that ``chunk_documents`` has in no chunk."""
    each = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(left_out(T.sentences(F.col("text")), count, max_tokens, max_words)).alias("u"))
    return each.select("doc_id", "u.place", "u.unit", "u.tokens")
