"""SentencePiece encoding and decoding with seeded merge-dropout.

Encoding is the merge-type (BPE) procedure of a SentencePiece model: an agenda of
adjacent pairs, best score first and leftmost among equals. With dropout, a pair
that comes up is skipped with the chance ``rate``, and stays out until a
neighbouring merge puts a new pair on the agenda. Each skip is keyed by the seed,
the text's doc_id, the unit's place in the text and the pair's place in the order in
which the unit's pairs come up, so that the same call always gives the same pieces
and every other occurrence of a word, in this text or another, is drawn anew.

A unit is a run of spaces and what follows up to the next space or, where no piece
of the vocabulary crosses it, up to the next change between letters, marks and
digits; merges never cross units. An occurrence draws the skips of a unit's pairs as
the bits of a number; what is kept between occurrences is the segmentation for given
bits, with the number of bits it depends on.

Every segmentation decodes to the source text: characters without a piece become
bytes, as do the model's own space symbol U+2581 where the text holds it.

Defined results: null and empty texts have no pieces; a text of any length is
encoded whole; a null doc_id is keyed as -1; rows that repeat id and text get equal
pieces; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

import gc
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.hashing import blocks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RATE, SEED = 0.1, 17
SPACE = "▁"
CACHE = 300_000
_WORD_OR_MARKS = re.compile(r"▁*(?:[^\W\d_▁¹²³]+|(?:[^\w▁]|[_¹²³])+|\d+)|▁+")
_MASK = 2**64 - 1
NEVER, SHORT = float("inf"), 64


_GOLDEN = 0x9E3779B97F4A7C15
#: Skips in one number; its highest bit, which is always set, tells units that need more.
SKIPS, MORE, SPARE = 63, 1 << 63, 6
#: Stands for a U+2581 of the text among the units, which hold no space.
_SYMBOL = " "
#: Characters of the texts that are drawn together.
TOGETHER, AT_ONCE = 300_000, 4096


def _skips(keys: np.ndarray, rate: int, block: int = 0, wanted: np.ndarray | None = None) -> np.ndarray:
    """For each key ``SKIPS`` bits, each set with the chance rate / 2**32, and the highest bit.

    A bit is set where a random number, of which each key has one for each bit, is less
    than the rate. Binary digits are drawn from the highest on until every bit ``wanted``
    is told apart from the rate's; bits that are not wanted may be left unset.
    """
    out = np.full(len(keys), MORE, dtype=np.uint64)
    if rate <= 0 or rate >= 2**32:
        return out if rate <= 0 else np.full(len(keys), _MASK, dtype=np.uint64)
    open_ = np.full(len(keys), MORE - 1, dtype=np.uint64) if wanted is None else wanted & np.uint64(MORE - 1)
    place, found = None, np.zeros(len(keys), dtype=np.uint64)
    for digit in range(31, (rate & -rate).bit_length() - 2, -1):
        words = mix(keys + np.uint64((digit + 32 * block + 1) * _GOLDEN & _MASK))
        if rate >> digit & 1:
            found |= open_ & ~words
            open_ = open_ & words
        else:
            open_ = open_ & ~words
        alive = open_ != 0
        count = np.count_nonzero(alive)
        if 2 * count < len(alive):
            if place is None:
                out |= found
                place = np.flatnonzero(alive)
            else:
                out[place] |= found
                place = place[alive]
            keys, open_, found = keys[alive], open_[alive], found[alive]
            if not count:
                return out
    if place is None:
        return out | found
    out[place] |= found
    return out


def _more_skips(key: int, rate: int, block: int) -> int:
    return int(_skips(np.array([key], dtype=np.uint64), rate, block)[0]) if rate else 0


class Merges:
    """The pairs of symbols that make a piece, in a hash table of numbers, and agendas of many units at once."""

    NONE = np.int64(2**62)
    WIDTH = 20  # characters: so many have fewer than ``SKIPS`` pairs, whatever is skipped

    def __init__(self, ids: dict[str, int], rank: dict[str, float], size: int):
        number = dict(ids)  # a symbol is a piece, or a character that is part of one
        for piece in ids:
            for c in piece:
                number.setdefault(c, size + len(number))
        self.pieces = size
        self.character = np.full(1 << 16, -1, dtype=np.int64)
        for c, k in number.items():
            if len(c) == 1 and ord(c) < 1 << 16:
                self.character[ord(c)] = k
        # pieces by the order of their merges; equal ranks stay equal
        ranks = {r: k for k, r in enumerate(sorted(set(rank.values())))}
        pairs: dict[int, int] = {}
        for piece, k in ids.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = ranks[rank[piece]] << 32 | k
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.made = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, self.NONE)
        left = np.array(list(pairs), dtype=np.int64)
        value = np.array(list(pairs.values()), dtype=np.int64)
        at = self._place(left)
        while len(left):
            free = np.flatnonzero(self.keys[at] < 0)
            at_free, one = np.unique(at[free], return_index=True)
            self.keys[at_free], self.made[at_free] = left[free[one]], value[free[one]]
            rest = np.ones(len(left), dtype=bool)
            rest[free[one]] = False
            left, value, at = left[rest], value[rest], (at[rest] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(_GOLDEN) >> self.shift).astype(np.int64)

    def offer(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The order of the merge of two symbols and, in the lower 32 bits, the piece that they make; or ``NONE``."""
        key = a.astype(np.int64) << 32 | b
        key[(a < 0) | (b < 0)] = -2
        at = self._place(key)
        held = self.keys[at]
        out = np.where(held == key, self.made[at], self.NONE)
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.made[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def segment(self, units: list[str], skips: np.ndarray, drawn: np.ndarray) -> list[bytes | None]:
        """The ids of each unit, of at most ``WIDTH`` characters, under its skips; None where bits that are not drawn, or bytes, are needed."""
        n = len(units)
        size = np.fromiter(map(len, units), dtype=np.int64, count=n)
        width = int(size.max())
        column = np.arange(width)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32)
        final = np.full((n, width), -1, dtype=np.int32)
        final[column < size[:, None]] = np.where(codes < 1 << 16, self.character[codes & 0xFFFF], -1)
        # one more column, with which nothing merges
        agenda = np.full((n, width), self.NONE)
        agenda[:, :-1] = self.offer(final[:, :-1].ravel(), final[:, 1:].ravel()).reshape(n, width - 1)
        symbol, rows, failed = final.copy(), np.arange(n), np.zeros(n, dtype=bool)
        left, skips, bits = size.copy(), skips.copy(), drawn.copy()
        while True:
            k = agenda.argmin(axis=1)
            best = agenda[np.arange(len(rows)), k]
            short = (best < self.NONE) & (bits & np.uint64(1) == 0)
            if short.any():  # these are done elsewhere
                failed[rows[short]] = True
                agenda[short] = self.NONE
                best[short] = self.NONE
            live = best < self.NONE
            count = np.count_nonzero(live)
            if not count or 4 * count < 3 * len(rows):
                ended = ~live
                final[rows[ended]], size[rows[ended]] = symbol[ended], left[ended]
                if not count:
                    break
                rows, left, skips, bits, k, best = (x[live] for x in (rows, left, skips, bits, k, best))
                symbol, agenda, live = symbol[live], agenda[live], np.ones(count, dtype=bool)
            skip = skips & np.uint64(1) != 0
            skips, bits = skips >> np.uint64(1), bits >> np.uint64(1)
            aside = np.flatnonzero(live & skip)
            agenda[aside, k[aside]] = self.NONE
            m = np.flatnonzero(live & ~skip)
            if len(m):
                at, line = k[m], np.arange(len(m))
                here, there = symbol[m], agenda[m]
                np.copyto(here[:, :-1], here[:, 1:], where=column[:-1] > at[:, None])
                np.copyto(there[:, :-1], there[:, 1:], where=column[:-1] >= at[:, None])
                here[:, -1], there[:, -1] = -1, self.NONE
                here[line, at] = (best[m] & 0xFFFFFFFF).astype(np.int32)
                there[line, at] = self.offer(here[line, at], here[line, np.minimum(at + 1, width - 1)])
                inner = np.flatnonzero(at > 0)
                there[inner, at[inner] - 1] = self.offer(here[inner, at[inner] - 1], here[inner, at[inner]])
                symbol[m], agenda[m] = here, there
                left[m] -= 1
        inside = column < size[:, None]
        failed |= (((final < 0) | (final >= self.pieces)) & inside).any(axis=1)
        flat = final[inside].tobytes()
        ends = (4 * np.cumsum(size)).tolist()
        return [None if bad else flat[a:b] for a, b, bad in zip([0, *ends], ends, failed.tolist(), strict=False)]


class Pieces:
    """The vocabulary of a BPE-type model and its segmentations."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.model = model
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}  # by which merges are ordered, least first
        self.raw: list[bytes] = [b""] * size
        self.byte: dict[int, int] = {}
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                value = int(piece[3:5], 16)
                self.byte[value], self.raw[k] = k, bytes([value])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                self.ids[piece] = k
                self.rank[piece] = -model.get_score(k)
                self.raw[k] = piece.replace(SPACE, " ").encode()
        self.bytes = frozenset(self.byte.values())
        self.merges = Merges(self.ids, self.rank, size)
        if len(self.byte) < 256:
            raise ValueError("the model has no byte pieces; texts could not be restored")
        self.size = np.array([len(x) for x in self.raw], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        # by unit, or by unit and skips: the bits that count and the ids; a new generation of entries, and the one before it
        self.new: dict[str | tuple[str, int], tuple[int, bytes]] = {}
        self.old: dict[str | tuple[str, int], tuple[int, bytes]] = {}
        # the place of each unit without dropout: its ids, the bits that count and its length
        self.place: dict[str, int] = {}
        self.held_ids: list[bytes] = []
        self.held_counts, self.held_sizes = array("Q"), array("i")
        # units may end between letters and marks only where no piece holds both kinds side by side
        crossing = any(_kinds(p) for p in self.ids)
        self.unit = re.compile(r"▁*[^▁]+|▁+") if crossing else _WORD_OR_MARKS

    def segment(self, unit: str, skips: int = 0, key: int = 0, rate: int = 0) -> tuple[bytes, int]:
        """Piece ids of one unit as 32-bit numbers, and how many pairs came up.

        ``skips`` has a bit for each of the first ``SKIPS`` pairs; later ones are drawn
        by the key at a rate out of 2**32, none at rate 0.
        """
        if unit == _SYMBOL:
            return array("i", [self.byte[c] for c in SPACE.encode()]).tobytes(), 0
        symbols, pairs = (self._agenda if len(unit) <= SHORT else self._heap)(unit, skips, key, rate)
        try:
            return array("i", [self.ids[s] for s in symbols]).tobytes(), pairs
        except KeyError:  # characters without a piece become bytes
            parts = [[self.ids[s]] if s in self.ids else [self.byte[c] for c in s.encode()] for s in symbols]
            return array("i", [k for part in parts for k in part]).tobytes(), pairs

    def _short(self, unit: str, key: int, rate: int) -> list[str]:
        return self._agenda(unit, _more_skips(key, rate, 0), key, rate)[0]

    def _long(self, unit: str, key: int, rate: int) -> list[str]:
        return self._heap(unit, _more_skips(key, rate, 0), key, rate)[0]

    def _agenda(self, unit: str, skips: int, key: int, rate: int) -> tuple[list[str], int]:
        """The agenda as a list with a place for each pair, which beats a heap on a word."""
        rank = self.rank.get
        symbols = list(unit)
        agenda = [rank(unit[k : k + 2], NEVER) for k in range(len(unit) - 1)]
        pairs = left = 0
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            k = agenda.index(best)
            if left == SKIPS:
                skips, left = _more_skips(key, rate, pairs // SKIPS), 0
            skip = skips >> left & 1
            pairs += 1
            left += 1
            if skip:
                agenda[k] = NEVER
                continue
            both = symbols[k] + symbols[k + 1]
            symbols[k] = both
            del symbols[k + 1], agenda[k]
            if k:
                agenda[k - 1] = rank(symbols[k - 1] + both, NEVER)
            if k < len(agenda):
                agenda[k] = rank(both + symbols[k + 1], NEVER)
        return symbols, pairs

    def _heap(self, unit: str, skips: int, key: int, rate: int) -> tuple[list[str], int]:
        """The same with a heap, for units of any length."""
        symbols: list[str | None] = list(unit)
        n = len(symbols)
        rank = self.rank.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, k, k + 1, 2) for k in range(n - 1) if (r := rank(unit[k : k + 2], NEVER)) != NEVER]
        heapq.heapify(agenda)

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (r := rank(symbols[a] + symbols[b], NEVER)) != NEVER:
                heapq.heappush(agenda, (r, a, b, len(symbols[a]) + len(symbols[b])))

        pairs = 0
        while agenda:
            _, a, b, width = heapq.heappop(agenda)
            left, right = symbols[a], symbols[b]
            if left is None or right is None or after[a] != b or len(left) + len(right) != width:
                continue
            if pairs and pairs % SKIPS == 0:
                skips = _more_skips(key, rate, pairs // SKIPS)
            skip = skips >> pairs % SKIPS & 1
            pairs += 1
            if skip:
                continue
            symbols[a], symbols[b] = left + right, None
            after[a] = after[b]
            if after[a] >= 0:
                before[after[a]] = a
            offer(a, after[a])
            offer(before[a], a)
        return [s for s in symbols if s is not None], pairs

    def encode(self, text: str, key: int = 0, rate: float = 0.0) -> np.ndarray:
        """Piece ids (int32)."""
        return self.encode_all([text], [key], rate)[0]

    def encode_all(self, texts: list[str], keys: list[int], rate: float) -> list[np.ndarray]:
        """Piece ids (int32) of each text; the units of all texts are drawn together."""
        units: list[str] = []
        size = []
        for text in texts:
            n = len(units)
            if text:
                units += self.unit.findall(SPACE + text.replace(" ", SPACE)) if SPACE not in text else self._parts(text)
            size.append(len(units) - n)
        found = self._drawn(units, np.array(size, dtype=np.int64), np.array(keys, dtype=np.uint64), int(rate * 2**32))
        out, at = [], 0
        for n in size:
            out.append(np.frombuffer(b"".join(found[at : at + n]), dtype=np.int32))
            at += n
        return out

    def _parts(self, text: str) -> list[str]:
        """The units of a text that holds the model's own space symbol, each of which is a unit of its own (``_SYMBOL``)."""
        units = []
        for number, part in enumerate(text.split(SPACE)):
            if number:
                units.append(_SYMBOL)
            if number == 0 or part:
                units += self.unit.findall((SPACE if number == 0 else "") + part.replace(" ", SPACE))
        return units

    def _drawn(self, units: list[str], size: np.ndarray, keys: np.ndarray, rate: int) -> list[bytes]:
        """The ids of each unit; ``size`` units for each of the keys."""
        places = list(map(self.place.get, units, repeat(-1)))
        if -1 in places:
            self._keep({u for u, k in zip(units, places, strict=True) if k < 0}, units)
            places = list(map(self.place.__getitem__, units))
        out = list(map(self.held_ids.__getitem__, places))
        if not rate or not units:
            return out
        at = np.array(places)
        counts = np.frombuffer(self.held_counts, dtype=np.uint64)[at]
        order = np.arange(len(units), dtype=np.uint64) - np.repeat(np.cumsum(size) - size, size).astype(np.uint64)
        drawn = mix(mix(order * np.uint64(_GOLDEN) + np.repeat(keys, size)) + np.uint64(self.seed & _MASK))
        # a skipped pair can bring up some more pairs than the plain unit has
        wanted = np.where(counts == np.uint64(MORE), np.uint64(_MASK), counts << np.uint64(SPARE) | np.uint64((1 << SPARE) - 1))
        skips = _skips(drawn, rate, 0, wanted)
        hit = np.flatnonzero(skips & counts)
        size = np.frombuffer(self.held_sizes, dtype=np.int32)[at[hit]]
        by = np.argsort(size, kind="stable")  # units of like length go together
        short = int(np.searchsorted(size[by], Merges.WIDTH, side="right"))
        alone = hit[by[short:]].tolist()
        for a in range(0, short, AT_ONCE):
            part = hit[by[a : min(a + AT_ONCE, short)]]
            places = part.tolist()
            for k, ids in zip(places, self.merges.segment([units[k] for k in places], skips[part], wanted[part]), strict=True):
                if ids is None:
                    alone.append(k)
                else:
                    out[k] = ids
        for k in alone:
            out[k] = self._skipped(units[k], int(skips[k]), int(counts[k]), int(drawn[k]), rate, int(wanted[k]))
        return out

    def _keep(self, missing: set[str], units: list[str]) -> None:
        """A place for each unit; when there are too many, only for those at hand."""
        if len(self.place) + len(missing) > CACHE:
            self.place, self.held_ids, self.held_counts, self.held_sizes = {}, [], array("Q"), array("i")
            missing = set(units)
        if len(self.new) > CACHE:
            self.old, self.new = self.new, {}
        self._learn(missing)
        for unit in missing:
            counts, ids = self.new.get(unit) or self._known(unit, unit, 0)
            del self.new[unit]
            self.place[unit] = len(self.held_ids)
            self.held_ids.append(ids)
            self.held_counts.append(counts)
            self.held_sizes.append(len(unit))

    def _learn(self, units: set[str]) -> None:
        """Keeps the undropped segmentations of words; the library makes them, as it does the same without dropout."""
        words = []
        for unit in units:
            if found := self.old.get(unit):
                self.new[unit] = found
            elif len(unit) > 1 and unit[0] == SPACE and SPACE not in unit[1:]:
                words.append(unit)
        for unit, ids in zip(words, self.model.encode([u[1:] for u in words], num_threads=1), strict=True):
            # each character that no merge took is a piece; bytes are told apart by the agenda
            if self.bytes.isdisjoint(ids) and (pairs := len(unit) - len(ids)) <= SKIPS:
                self.new[unit] = ((1 << pairs) - 1, array("i", ids).tobytes())

    def _known(self, name: str | tuple[str, int], unit: str, skips: int) -> tuple[int, bytes]:
        """The bits that count for a unit with these skips and no later ones (``MORE`` if it has more pairs than bits), and its ids."""
        found = self.new.get(name) or self.old.get(name)
        if found is None:
            ids, pairs = self.segment(unit, skips)
            found = ((1 << pairs) - 1 if pairs <= SKIPS else MORE, ids)
        self.new[name] = found
        return found

    def _skipped(self, unit: str, skips: int, counts: int, key: int, rate: int, drawn: int = _MASK) -> bytes:
        """The ids of a unit some of whose ``counts`` bits are set; of ``skips`` the bits ``drawn`` are known."""
        while counts != MORE:
            if counts & ~drawn:
                skips, drawn = _more_skips(key, rate, 0), _MASK
            some = skips & counts
            name = (unit, some)
            counts, ids = self.new.get(name) or self._known(name, unit, some)
            if counts != MORE and not counts & ~drawn and not (skips ^ some) & counts:
                return ids
        if drawn != _MASK:
            skips = _more_skips(key, rate, 0)
        return self.segment(unit, skips, key, rate)[0]

    seed = 0

    def with_seed(self, seed: int) -> Pieces:
        """What is kept does not depend on the seed."""
        self.seed = seed
        return self

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The bytes of all pieces, gathered at once, without the space put before the text."""
        ids = np.asarray(ids, dtype=np.int64)
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.repeat(self.start[ids] - end + size, size) + np.arange(end[-1] if len(end) else 0)
        return self.flat[at].tobytes()[1:].decode("utf-8", errors="replace")


def _kinds(piece: str) -> bool:
    """Whether letters, marks and digits meet inside the piece, or a space symbol follows something else."""
    body = piece.lstrip(SPACE)
    return bool(body) and _WORD_OR_MARKS.fullmatch(body) is None


def doc_key(seed: int, doc_id: int | None) -> int:
    return xxhash.xxh3_64_intdigest((-1 if doc_id is None else doc_id).to_bytes(8, "little", signed=True), seed=seed)


@lru_cache(maxsize=1)
def _pieces(proto: bytes, rate: float, seed: int) -> Pieces:
    """One vocabulary with its known units for all tasks of a worker process."""
    return Pieces(proto).with_seed(seed)


def _encode(proto, rate: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(proto.value, rate, seed)
        gc.freeze()  # what is kept has no cycles; the collector need not walk it
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = [doc_key(seed, d) for d in batch.column("doc_id").to_pylist()]
            done = 0
            for part in blocks(texts, TOGETHER):
                flat = pieces.encode_all(part, keys[done : done + len(part)], rate)
                whole = [pieces.decode(ids) == text for ids, text in zip(flat, part, strict=True)]
                cuts = np.concatenate(([0], np.cumsum([len(x) for x in flat])))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(flat), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(done, len(part)), lists, pa.array(np.diff(cuts), pa.int64()), pa.array(whole)], names=["doc_id", "ids", "n_pieces", "lossless"])
                done += len(part)

    return run


def _decode(proto):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(proto.value)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def _read(docs: DataFrame, model: str):
    with open(model, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model: str = MODEL, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, ids, n_pieces, lossless (whether the ids decode to the text). ``model`` is read by the driver."""
    if not 0 <= rate <= 1:
        raise ValueError("rate must be in 0..1")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encode(_read(docs, model), rate, seed), "doc_id long, ids array<int>, n_pieces long, lossless boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text of rows with doc_id and ids."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(_read(encoded, model)), "doc_id long, text string")
