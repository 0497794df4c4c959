"""Vectorised prefix polynomial hashes over blocks of texts (numpy, no Spark).

A block joins several UTF-8 texts, each followed by a newline. ``prefix`` gives
cumulative sums of value[i] * BASE**i modulo 2**64; as BASE is odd it has an
inverse, so the hash of any span is position free after one multiplication.

Modulo 2**64 some long patterned sequences (alternations that double, as Thue and
Morse's) collide for any base. Spans of that family are therefore short: words of more
than ``LONG_WORD`` bytes are hashed by xxh3 instead. ``prime_prefix`` and
``prime_spans`` are a second family, modulo the prime 2**61 - 1, which has no such
patterns; what is decided by hash is decided by both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
BLOCK_BYTES = 1_500_000


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


with np.errstate(over="ignore"):
    BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    OTHER_VALUES = mix(BYTE_VALUES + U(0xD1B54A32D192ED03))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: list[np.ndarray] = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i in 0..n, grown on demand and kept per process."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(size, b, dtype=U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=U)
    np.multiply(values, powers(len(values))[0][: len(values)], out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end) of the sequence under ``p``."""
    inverse = powers(len(p))[1]
    return mix((p[end] - p[start]) * inverse[start] + (end - start).astype(U))


def fixed_spans(p: np.ndarray, length: int) -> np.ndarray:
    """Mixed hash of every span of one length."""
    n = len(p) - length
    if n <= 0:
        return np.zeros(0, dtype=U)
    return mix((p[length:] - p[:n]) * powers(len(p))[1][:n] + U(length))


PRIME = U(2**61 - 1)
PRIME_BASE = 0x14C7_9D1E_63F0_8B35
_prime_powers: list[np.ndarray] = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime; x < 2**64."""
    x = (x & PRIME) + (x >> U(61))
    return np.minimum(x, x - PRIME)  # the difference wraps to a large number where x is reduced


def prime_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime; both reduced."""
    high_a, low_a, high_b, low_b = a >> U(31), a & U(2**31 - 1), b >> U(31), b & U(2**31 - 1)
    middle = high_a * low_b + low_a * high_b
    return _reduced((high_a * high_b << U(1)) + (middle >> U(30)) + ((middle & U(2**30 - 1)) << U(31)) + low_a * low_b)


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """PRIME_BASE**i and PRIME_BASE**-i modulo the prime for i in 0..n, kept per process."""
    modulus = int(PRIME)
    for k, base in enumerate((PRIME_BASE, pow(PRIME_BASE, -1, modulus))):
        while len(_prime_powers[k]) <= n:
            known = _prime_powers[k]
            _prime_powers[k] = np.concatenate((known, prime_product(known, np.full(1, pow(base, len(known), modulus), dtype=U))))
    return _prime_powers[0], _prime_powers[1]


def prime_prefix(values: np.ndarray) -> np.ndarray:
    """Cumulative sums of value[i] * PRIME_BASE**i modulo the prime."""
    terms = prime_product(_reduced(values), prime_powers(len(values))[0][: len(values)])
    low, high = np.cumsum(terms & U(2**32 - 1)), np.cumsum(terms >> U(32))
    out = np.zeros(len(values) + 1, dtype=U)
    out[1:] = _reduced(((high & U(2**29 - 1)) << U(32)) + (high >> U(29)) + low)
    return out


def prime_spans(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of each span [start, end) of the sequence under ``p``."""
    inverse = prime_powers(len(p))[1]
    return mix(prime_product(_reduced(p[end] + PRIME - p[start]), inverse[start]) + (end - start).astype(U) * U(BASE))


LONG_WORD = 32


def blocks(texts: Iterable[bytes], limit: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts, together at most ``limit`` bytes unless one alone is longer."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The block's bytes and the offset of each text, with the end at last."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)), out=offsets[1:])
    return buf, offsets


class Words:
    """Words of a block: byte bounds, hash, and the bounds of each text in words."""

    def __init__(self, texts: list[bytes]):
        buf, offsets = join(texts)
        space = SPACE[buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(buf) and not space[0]:
            edge = np.concatenate((np.zeros(1, dtype=np.int64), edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.buf, self.offsets = buf, offsets
        self.long = np.flatnonzero(self.end - self.start > LONG_WORD)
        self.hash = self._hashes(BYTE_VALUES, 0)
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def _hashes(self, values: np.ndarray, seed: int) -> np.ndarray:
        out = spans(prefix(values[self.buf]), self.start, self.end)
        for k, a, b in zip(self.long.tolist(), self.start[self.long].tolist(), self.end[self.long].tolist(), strict=True):
            out[k] = xxhash.xxh3_64_intdigest(self.buf[a:b], seed)
        return out

    def other(self) -> np.ndarray:
        """A second hash of each word, independent of the first."""
        return self._hashes(OTHER_VALUES, 1)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they lie in one text."""
        h = fixed_spans(prefix(self.hash), n)
        return h, self.doc[: len(h)] == self.doc[n - 1 : n - 1 + len(h)]


def leftmost_min(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each run of ``width`` values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    value, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        m = len(value) - step
        later = value[step:] < value[:m]
        at = np.where(later, at[step:], at[:m])
        value = np.minimum(value[step:], value[:m])
        span += step
    return at


def anchor_runs(h: np.ndarray, gram: int, window: int, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share their least gram: (gram position, first, last window start).

    ``last[i]`` tells whether the window at i lies in one text. Equal windows
    have equal least grams at equal distances, whatever surrounds them.
    """
    at = leftmost_min(h, window - gram + 1)
    good = np.flatnonzero(last[: len(at)])
    if not len(good):
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    a = at[good]
    cut = np.flatnonzero((a[1:] != a[:-1]) | (good[1:] != good[:-1] + 1)) + 1
    first = np.concatenate((np.zeros(1, dtype=np.int64), cut))
    end = np.concatenate((cut - 1, np.array([len(good) - 1])))
    return a[first].astype(np.int64), good[first], good[end]
