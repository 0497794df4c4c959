"""Token counts of whole texts under a merge-type SentencePiece model, by rank-synchronous merging of arrays.

The texts of a block are normalised by the library and held as one array of symbols,
at first a symbol for each character. Cuts are made where no merge can cross, that is
between characters that stand side by side in no piece of the vocabulary; what lies
between two cuts is a sequence. Equal sequences are merged once: they are found by
hash, and told apart by their characters.

Sequences are ragged rows of the arrays. In every round each sequence merges its pair
of lowest rank; all sequences do so at once. All places of that pair merge in one round
where the vocabulary shows that no pair that arises from it can rank as low or lower,
else the leftmost alone does, which is the library's order in either case. Sequences
without a pair left go out. What survives counts: a piece is one token, a character
without a piece as many as it has bytes.

Defined results: null and empty texts have no bytes and no tokens; a text of any length
is counted whole; ties of rank go to the leftmost pair; bytes that are not UTF-8 count
as U+FFFD; rows that repeat a doc_id are counted alike; an empty table gives an empty
one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import texts_of
from docloom.llm.hashing import blocks, prefix, spans

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_TOKENS = 4096
#: Bytes of texts whose sequences are merged together, unless one text is longer.
TOGETHER = 2_000_000
NO_RANK = np.int32(2**31 - 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Numbers by pairs of numbers below 2**31: an open hash table in arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, ...]], width: int):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.place = np.zeros(1 << bits, dtype=np.int32)
        self.values = np.array([*pairs.values()], dtype=np.int32).reshape(len(pairs), width)
        key = np.fromiter((a << 32 | b for a, b in pairs), dtype=np.int64, count=len(pairs))
        left, at = np.arange(len(key)), self._slot(key)
        while len(left):
            free = np.flatnonzero(self.keys[at] < 0)
            slot, first = np.unique(at[free], return_index=True)
            self.keys[slot], self.place[slot] = key[left[free[first]]], left[free[first]]
            rest = np.ones(len(left), dtype=bool)
            rest[free[first]] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * _GOLDEN >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each pair's values, or -1."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._slot(key)
        held = self.keys[at]
        out = np.where(held == key, self.place[at], -1)
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.place[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Counter:
    """The vocabulary of a merge-type model as arrays."""

    def __init__(self, proto: bytes):
        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = model.get_piece_size()
        if sum(model.is_byte(k) for k in range(size)) < 256:
            raise ValueError("the model has no byte pieces")
        score: dict[str, float] = {}
        for k in range(size):
            if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                score[model.id_to_piece(k)] = model.get_score(k)
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        number = {piece: k for k, piece in enumerate(score)}
        for c in sorted({c for piece in score for c in piece}):
            number.setdefault(c, len(number))
        # what is left of a symbol counts as one token, or as its bytes if it is no piece
        self.tokens = np.ones(len(number), dtype=np.int64)
        for symbol, k in number.items():
            if symbol not in score:
                self.tokens[k] = len(symbol.encode())
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        for symbol, k in number.items():
            if len(symbol) == 1:
                self.symbol[ord(symbol)] = k
        self.bytes = np.array([1, 2, 3, 4])
        merges, least = {}, {}
        for piece, s in score.items():
            for k in range(1, len(piece)):
                a, b = number.get(piece[:k]), number.get(piece[k:])
                if a is not None and b is not None:
                    merges[a, b] = (order[s], number[piece])
                    for part in (a, b):
                        least[part] = min(least.get(part, NO_RANK), order[s])
        self.merges = Table(merges, 2)
        # ranks of one piece whose own merges all rank higher: their places can merge in one round
        self.steady = np.zeros(len(order) + 1, dtype=bool)
        held = np.bincount([order[s] for s in score.values()], minlength=len(order))
        for piece, s in score.items():
            self.steady[order[s]] = held[order[s]] == 1 and least.get(number[piece], NO_RANK) > order[s]
        # characters that stand side by side in some piece
        beside = {(number[p[k]], number[p[k + 1]]): (1,) for p in score for k in range(len(p) - 1)}
        self.beside = Table(beside, 1)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        plain = [self.model.normalize(t) for t in texts]
        points = np.frombuffer("".join(plain).encode("utf-32-le"), dtype="<u4")
        ends = np.cumsum(np.fromiter(map(len, plain), dtype=np.int64, count=len(plain)))
        out = np.zeros(len(texts), dtype=np.int64)
        if not len(points):
            return out
        symbol = self.symbol[points]
        # a text's first character, and each that no merge ties to the one before it
        begins = np.ones(len(points), dtype=bool)
        begins[1:] = (symbol[1:] < 0) | (symbol[:-1] < 0) | (self.beside.find(symbol[:-1], symbol[1:]) < 0)
        begins[ends[:-1][ends[:-1] < len(points)]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(points))
        tokens = np.empty(len(start), dtype=np.int64)
        alone = end - start == 1
        tokens[alone] = self._alone(points[start[alone]], symbol[start[alone]])
        longer = np.flatnonzero(~alone)
        tokens[longer] = self._merged(symbol, start[longer], end[longer])
        text = np.searchsorted(ends, start, side="right")
        return np.bincount(text, weights=tokens, minlength=len(texts)).astype(np.int64)

    def _alone(self, points: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        size = self.bytes[np.searchsorted(np.array([0x80, 0x800, 0x10000], dtype=np.uint32), points, side="right")]
        return np.where(symbol < 0, size, self.tokens[symbol])

    def _merged(self, symbol: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each sequence; equal ones are merged once."""
        with np.errstate(over="ignore"):
            digest = spans(prefix((symbol.astype(np.int64) + 2).view(np.uint64) * _GOLDEN), start, end)
        _, first, kind = np.unique(digest, return_index=True, return_inverse=True)
        size = end - start
        # the characters of each sequence against those of the first of its kind
        own, model = _gather(symbol, start, size), _gather(symbol, start[first[kind]], np.minimum(size, size[first[kind]]))
        if len(own) == len(model) and np.array_equal(own, model) and np.array_equal(size, size[first[kind]]):
            return self._rounds(_gather(symbol, start[first], size[first]), size[first])[kind]
        return self._rounds(own, size)

    def _rounds(self, symbol: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens that survive in each sequence; the symbols of all sequences follow each other."""
        out = np.zeros(len(size), dtype=np.int64)
        row = np.arange(len(size))
        last = np.zeros(len(symbol), dtype=bool)  # of a sequence
        last[np.cumsum(size) - 1] = True
        rank, made = self._offers(symbol, np.arange(len(symbol)), last)
        while len(row):
            best = np.minimum.reduceat(rank, _starts(size))
            open_ = best < NO_RANK
            if not open_.all():
                stay = np.repeat(open_, size)
                ended = symbol[~stay]
                out[row[~open_]] = np.add.reduceat(self.tokens[ended], _starts(size[~open_]))
                symbol, rank, made, last = symbol[stay], rank[stay], made[stay], last[stay]
                row, size, best = row[open_], size[open_], best[open_]
                if not len(row):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            of = np.searchsorted(np.cumsum(size), at, side="right")
            # of places that overlap every other merges, from the left; where the rank is not steady the leftmost alone
            new = np.ones(len(at), dtype=bool)
            new[1:] = at[1:] != at[:-1] + 1
            run = np.flatnonzero(new)
            turn = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            leftmost = np.ones(len(at), dtype=bool)
            leftmost[1:] = of[1:] != of[:-1]
            take = np.where(self.steady[best[of]], turn % 2 == 0, leftmost)
            at, of = at[take], of[take]
            symbol[at], last[at] = made[at], last[at + 1]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            symbol, rank, made, last = symbol[stay], rank[stay], made[stay], last[stay]
            size = size - np.bincount(of, minlength=len(size))
            at = at - np.arange(len(at))
            inner = at[at > 0] - 1
            changed = np.concatenate((at, inner[~last[inner]]))
            rank[changed], made[changed] = self._offers(symbol, changed, last)
        return out

    def _offers(self, symbol: np.ndarray, at: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the merge of each place with the next; ``NO_RANK`` at the end of a sequence."""
        rank, made = np.full(len(at), NO_RANK, dtype=np.int32), np.zeros(len(at), dtype=np.int32)
        some = np.flatnonzero(~last[at])
        found = self.merges.find(symbol[at[some]], symbol[at[some] + 1])
        hit = found >= 0
        rank[some[hit]], made[some[hit]] = self.merges.values[found[hit], 0], self.merges.values[found[hit], 1]
        return rank, made


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start : start + size] of each, one after the other."""
    return values[np.repeat(start - _starts(size), size) + np.arange(int(size.sum()))]


@lru_cache(maxsize=1)
def _counter(proto: bytes) -> Counter:
    """One vocabulary for all tasks of a worker process."""
    return Counter(proto)


def _count(proto, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(proto.value)
        for batch in batches:
            texts = [t or b"" for t in texts_of(batch)]
            n = [counter.count([t.decode("utf-8", "replace") for t in part]) for part in blocks(texts, TOGETHER)]
            tokens = np.concatenate([*n, np.zeros(0, dtype=np.int64)])
            made = [pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > most)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, model: str = MODEL, most: int = MOST_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``most`` tokens). ``model`` is read by the driver."""
    with open(model, "rb") as f:
        proto = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count(proto, most), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
