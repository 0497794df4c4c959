"""Offset-preserving detection of disguised personal data.

Plain identifiers are found on the text as it is. Where a text shows a disguise,
transducers rewrite it one after another, each keeping for every character it
writes the source span it read:

* homoglyphs: compatibility forms (full-width, mathematical, circled, raised), Cyrillic and
  Greek lookalikes and the digits of other scripts become ASCII; zero-width characters and
  combining marks vanish; character references of HTML become the character; O, o, l and I become
  digits in tokens of figures, and alone between the dots of an address; blanks between a
  plus and the figures after it vanish;
* spelled digits: a digit word (English, Spanish, French, German) beside a digit,
  another digit word, a plus or a full stop becomes a digit, a leading "plus" a plus
  sign, and "double" or "triple" repeat what follows; single digits become one number,
  longer ones stay apart by a space;
* at and dot: bracketed, spaced or spelled ("at", "arroba", "dot", "punto", ...)
  forms become @ and a full stop. A bare word counts only between name characters
  and, for "at", only with a disguised dot after it, so prose stays prose.

The same detectors then read the rewritten text; what they find over rewritten
characters is mapped back to source offsets and added. Plain findings stay.

Defined results: a null text is empty; offsets count code points of the source,
end exclusive; a text of any length is read whole. Columns other than doc_id and
text are ignored, rows that repeat are answered each on its own.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, free = text.find("@"), 0
    while at >= 0:
        # every local part ends at its @, and none reaches back over the one before
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def detect(text: str) -> list[Span]:
    """Plain identifiers, leftmost and non-overlapping within each kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# Lookalikes of ASCII letters in Cyrillic and Greek, and the letters they stand for.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορτυχ",
        "ABESIJKMHOPCTYXaesijopcyxhdqw" + "ABEZHIKMNOPTYXavoptux",
        strict=True,
    )
)
ZERO_WIDTH = "­​‌‍⁠﻿"
#: Punctuation that stands for a dot, a hyphen or a space.
DOTS = {"。": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " ", " ": " ", "　": " "}


def _homoglyphs() -> dict[str, str]:
    table = {}
    for first in range(0x80, 0x20000):
        c = chr(first)
        if unicodedata.category(c) in ("Mn", "Me"):
            table[c] = ""
        elif unicodedata.decimal(c, -1) >= 0:
            table[c] = str(unicodedata.decimal(c))
        elif (plain := unicodedata.normalize("NFKC", c)).isascii() and (plain.isalnum() or len(plain) == 1) and plain != c:
            table[c] = plain
    return table | LOOKALIKES | DOTS | dict.fromkeys(ZERO_WIDTH, "")


HOMOGLYPHS = _homoglyphs()
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
_REFERENCE = re.compile(r"&(?:#[0-9]{2,7}|#[xX][0-9a-fA-F]{2,6}|commat|period|plus|hyphen|lowbar);")
#: Figures with lookalikes among them, or one lookalike alone between dots.
_FIGURES = re.compile(r"(?<![^\W_OoIl])(?=[OoIl]*[0-9])(?=[0-9]*[OoIl])[0-9OoIl]+(?![^\W_])|(?<![\w.@])[OoIl]{1,3}(?=(?:\.[0-9OoIl]{1,3}){3}(?!\w))|(?<=[0-9OoIl]\.)[OoIl]{1,3}(?=\.[0-9OoIl])|(?<=[0-9]\.)[OoIl]{1,3}(?![\w@.])")
_LOOSE_PLUS = re.compile(r"\+([ \t]*+\(?)(?=[0-9])")
_MASKED = re.compile(r"&#?[0-9A-Za-z]{2,7};|[0-9][OoIl]|[OoIl][0-9]|[0-9]\.[OoIl]|\+[ \t]*[( \t][0-9]|\+[ \t]+[0-9(]")
_AS_DIGITS = str.maketrans("OoIl", "0011")

# Digit words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
}
REPEATS = {"double": 2, "triple": 3}
_AT_WORDS = "at|arroba|chez|klammeraffe"
_DOT_WORDS = "dot|punto|point|punkt|ponto"
_ONE_DIGIT = rf"(?:(?:double|triple)[ \t-]+)?(?:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))}|[0-9]++)"
_SPELLED = re.compile(rf"(?<!\w)(?:plus[ \t]+)?{_ONE_DIGIT}(?:[ \t,-]+{_ONE_DIGIT})*(?!\w)", re.IGNORECASE)
_TOKEN = re.compile(r"\w+")
_LETTER = re.compile(r"[^\W\d]")
_DOT = rf"(?:[ \t]*[\[({{<][ \t]*(?:{_DOT_WORDS}|\.)[ \t]*[\])}}>][ \t]*|[ \t]+(?:{_DOT_WORDS})[ \t]+)"
_AT = re.compile(
    rf"(?<![ \t])[ \t]*+[\[({{<][ \t]*+(?:{_AT_WORDS}|@)[ \t]*[\])}}>][ \t]*(?=[\w-])"
    rf"|(?<=[\w.%+-])[ \t]+@[ \t]*(?=[\w-])|(?<=[\w.%+-])@[ \t]+(?=[\w-]+(?:\.|{_DOT})[\w-])"
    rf"|(?<=[\w%+-])[ \t]+(?:{_AT_WORDS})[ \t]+(?=[\w-]+(?:\.[\w-]+)*{_DOT}[\w-])",
    re.IGNORECASE,
)
_BETWEEN = re.compile(rf"(?<=[\w-]){_DOT}(?=[\w-])", re.IGNORECASE)
_SPACED_DOT = re.compile(r"(?<=[\w-])(?:[ \t]+\.[ \t]*|[ \t]*\.[ \t]+)(?=[\w-])")
_BRACKETED = re.compile(rf"[\[({{<][ \t]*(?:{_AT_WORDS}|{_DOT_WORDS}|[@.])[ \t]*[\])}}>]", re.IGNORECASE)
_DOT_SET = frozenset(_DOT_WORDS.split("|"))
_TELLING = _DOT_SET | DIGIT_WORDS.keys()
_MARKS = str.maketrans(dict.fromkeys(",-.;:!?+()[]{}<>\"'/|*=", " "))
_NEAR_AT = 80


class Mapped:
    """A rewritten text; for each character the source span it stands for, and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = array("i", range(len(text)))
        self.end = array("i", range(1, len(text) + 1))
        self.new: bytearray = bytearray(len(text))

    def rewrite(self, edits: list[tuple[int, int, list[tuple[int, int, str]]]]) -> None:
        """Replace [a, b) by pieces (a', b', characters), each standing for its own part of the text."""
        if not edits:
            return
        text: list[str] = []
        start, end, new = array("i"), array("i"), bytearray()
        at = 0
        for a, b, pieces in edits:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            new += self.new[at:a]
            for x, y, characters in pieces:
                text.append(characters)
                start += array("i", (self.start[x],)) * len(characters)
                end += array("i", (self.end[y - 1],)) * len(characters)
                new += b"\x01" * len(characters)
            at = b
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        new += self.new[at:]
        self.text, self.start, self.end, self.new = "".join(text), start, end, new


def _plain_homoglyphs(mapped: Mapped) -> None:
    found = [(m.start(), m.end(), HOMOGLYPHS[m[0]]) for m in _NOT_ASCII.finditer(mapped.text) if m[0] in HOMOGLYPHS]
    mapped.rewrite([(a, b, [(a, b, plain)] if plain else []) for a, b, plain in found])


def _plain_references(mapped: Mapped) -> None:
    if "&" in mapped.text:
        found = [(m, html.unescape(m[0])) for m in _REFERENCE.finditer(mapped.text)]
        mapped.rewrite([(m.start(), m.end(), [(m.start(), m.end(), c)]) for m, c in found if len(c) == 1])


def _plain_figures(mapped: Mapped) -> None:
    edits = []
    for m in _FIGURES.finditer(mapped.text):
        edits += [(k, k + 1, [(k, k + 1, mapped.text[k].translate(_AS_DIGITS))]) for k in range(m.start(), m.end()) if mapped.text[k] in "OoIl"]
    mapped.rewrite(edits)
    if "+" in mapped.text:
        # a plus between figures adds them up
        loose = [m for m in _LOOSE_PLUS.finditer(mapped.text) if m[1] and not mapped.text[max(0, m.start() - 80) : m.start()].rstrip()[-1:].isdigit()]
        mapped.rewrite([(m.start(1), m.end(1), []) for m in loose])


def _plain_digits(mapped: Mapped) -> None:
    text = mapped.text
    edits = []
    done = -1
    for m in _SPELLED.finditer(text):
        if m[0][0].isdigit() and m[0][-1].isdigit() and not _LETTER.search(m[0]):
            continue
        parts: list[tuple[int, int, str | None, bool]] = []  # digits for what is spelled; whether what follows may join it
        times, since, plus, count = 1, None, False, 0
        # a figure after a full stop belongs to what is before it, unless that was spelled too
        chained = text[m.end() : m.end() + 1] == "." or (text[max(0, m.start() - 1) : m.start()] == "." and (mapped.new[m.start() - 1] or done == m.start() - 1))
        for t in _TOKEN.finditer(text, m.start(), m.end()):
            word = t[0].lower()
            if word == "plus":
                plus = True
                parts.append((t.start(), t.end(), "+", True))
            elif word in REPEATS:
                times, since = REPEATS[word], t.start()
            else:
                figure = word not in DIGIT_WORDS
                alone = len(word) == 1 or not figure
                written = None if figure and times == 1 else DIGIT_WORDS.get(word, word) * times
                parts.append((t.start() if since is None else since, t.end(), written, alone and (chained or not (figure and text[t.start() - 1 : t.start()] == "."))))
                times, since, count = 1, None, count + 1
        if not (count > 1 or plus or text[m.end() : m.end() + 1] == "." or text[max(0, m.start() - 1) : m.start()] in (".", "+")):
            continue
        for k, (a, b, written, joins) in enumerate(parts):
            if k:
                joined = parts[k - 1][3] and (written is not None or b - a == 1)
                gap = parts[k - 1][1]
                if joined:
                    edits.append((gap, a, []))
                elif a - gap > 1 or text[gap] not in " -":
                    edits.append((gap, a, [(gap, a, " ")]))
            if written is not None:
                edits.append((a, b, [(a, b, written)]))
                done = m.end()
    mapped.rewrite(edits)


def _plain_at_and_dot(mapped: Mapped) -> None:
    mapped.rewrite([(m.start(), m.end(), [(m.start(), m.end(), "@")]) for m in _AT.finditer(mapped.text)])
    mapped.rewrite([(m.start(), m.end(), [(m.start(), m.end(), ".")]) for m in _BETWEEN.finditer(mapped.text)])
    if "@" in mapped.text:
        # a full stop with spaces is a disguise only in the word after @ and a space before it
        edits, at = [], mapped.text.find("@")
        while at >= 0:
            stop = mapped.text.find("@", at + 1)
            for m in _SPACED_DOT.finditer(mapped.text, at, min(at + _NEAR_AT, stop if stop > 0 else len(mapped.text))):
                if mapped.text[m.start()] in " \t" and " " not in mapped.text[at:m.start()] and "\n" not in mapped.text[at:m.start()]:
                    edits.append((m.start(), m.end(), [(m.start(), m.end(), ".")]))
                    break
            at = stop
        mapped.rewrite(edits)


def _row_of_digits(words: list[str], telling: frozenset[str]) -> bool:
    """Whether four digits, as many as the shortest identifier has, follow each other, one of them spelled."""
    if telling <= _DOT_SET:
        return False
    row, spelled = 0, False
    for word in words:
        if word in DIGIT_WORDS:
            row, spelled = row + 1, True
        elif word.isdigit():
            row += len(word)
        elif word in REPEATS:
            row, spelled = row + REPEATS[word], True
        elif word not in _DOT_SET and word != "plus":
            row, spelled = 0, False
        if row >= 4 and spelled:
            return True
    return False


def disguised(text: str, plain: list[Span]) -> list[Span]:
    """What the transducers bring to light beyond ``plain``."""
    odd = not text.isascii() and not HOMOGLYPHS.keys().isdisjoint(_NOT_ASCII.findall(text))
    words = text.lower().translate(_MARKS).split()
    telling = _TELLING.intersection(words)
    hidden = "@" in text or not telling.isdisjoint(_DOT_SET) or _BRACKETED.search(text) is not None
    masked = _MASKED.search(text) is not None
    if not (odd or hidden or masked or _row_of_digits(words, telling)):
        return []
    mapped = Mapped(text)
    _plain_references(mapped)
    _plain_homoglyphs(mapped)
    _plain_figures(mapped)
    _plain_at_and_dot(mapped)
    _plain_digits(mapped)
    _plain_at_and_dot(mapped)
    known = set(plain)
    out = []
    for kind, a, b in detect(mapped.text):
        if any(mapped.new[a:b]) or mapped.end[b - 1] - mapped.start[a] != b - a:
            span = (kind, mapped.start[a], mapped.end[b - 1])
            if span not in known:
                known.add(span)
                out.append(span)
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        digest, spans, added = [], [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            plain = detect(text)
            more = disguised(text, plain)
            for k, kind in enumerate(KINDS):
                counts[k].append(sum(s[0] == kind for s in plain))
            digest.append(hashlib.sha256(written(plain).encode()).hexdigest())
            spans.append(written(ordered(plain + more)))
            added.append(len(more))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"],
        )


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (plain findings), base_sha256, spans (all findings), n_disguised."""
    rows = docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long")
