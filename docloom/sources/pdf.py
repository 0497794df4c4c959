"""Text blocks of PDF pages, with the standard library: unencrypted files, simple and ToUnicode-mapped fonts."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

#: (y0, y1, text) with y measured from the top of the page, in points.
PageBlock = tuple[float, float, str]

_SPACE, _DELIMITERS = b"\0\t\n\f\r ", b"()<>[]{}/%"
_REGULAR = re.compile(rb"[^\0\t\n\f\r ()<>\[\]{}/%]+")
_OBJECT = re.compile(rb"(?<![0-9])(\d+)\s+\d+\s+obj\b")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


@dataclass(frozen=True)
class Name:
    value: str


@dataclass(frozen=True)
class Ref:
    number: int


@dataclass(frozen=True)
class Operator:
    value: str


@dataclass
class Stream:
    head: dict
    raw: bytes

    def data(self) -> bytes:
        filters = self.head.get("Filter", [])
        out = self.raw
        for f in filters if isinstance(filters, list) else [filters]:
            if f.value not in ("FlateDecode", "Fl"):
                raise ValueError(f"PDF filter {f.value} is not supported")
            out = zlib.decompressobj().decompress(out)
        return out


class Reader:
    """Values of a stretch of PDF syntax, one after another."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> None:
        d = self.data
        while self.at < len(d):
            if d[self.at] in _SPACE:
                self.at += 1
            elif d[self.at] == 0x25:
                end = re.compile(rb"[\r\n]").search(d, self.at)
                self.at = end.start() if end else len(d)
            else:
                return

    def value(self) -> object:
        """The next value; None at the end, "]" or ">>" as an Operator."""
        self.skip()
        d, at = self.data, self.at
        if at >= len(d):
            return None
        c = d[at : at + 1]
        if c == b"/":
            m = _REGULAR.match(d, at + 1)
            self.at = m.end() if m else at + 1
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes([int(x[1], 16)]), m[0]).decode("latin-1") if m else "")
        if c == b"(":
            return self._string()
        if d[at : at + 2] == b"<<":
            self.at = at + 2
            return self._dictionary()
        if c == b"<":
            end = d.index(b">", at)
            self.at = end + 1
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", d[at + 1 : end])
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if c == b"[":
            self.at = at + 1
            return list(iter(self.value, Operator("]")))
        if d[at : at + 2] == b">>":
            self.at = at + 2
            return Operator(">>")
        m = _REGULAR.match(d, at)
        if not m:
            self.at = at + 1
            return Operator(c.decode("latin-1"))
        self.at = m.end()
        if re.fullmatch(rb"[+-]?\d+", m[0]):
            ref = re.compile(rb"\s+\d+\s+R(?![^\s()<>\[\]{}/%])").match(d, self.at)
            if ref:
                self.at = ref.end()
                return Ref(int(m[0]))
            return int(m[0])
        if re.fullmatch(rb"[+-]?(\d+\.\d*|\.\d+)", m[0]):
            return float(m[0])
        return Operator(m[0].decode("latin-1"))

    def _string(self) -> bytes:
        d, out, depth = self.data, bytearray(), 1
        self.at += 1
        while self.at < len(d):
            c = d[self.at : self.at + 1]
            self.at += 1
            if c == b"\\":
                octal = re.compile(rb"[0-7]{1,3}").match(d, self.at)
                if octal:
                    out.append(int(octal[0], 8) & 255)
                    self.at = octal.end()
                else:
                    n = d[self.at : self.at + 1]
                    self.at += 2 if d[self.at : self.at + 2] == b"\r\n" else 1
                    out += b"" if n in b"\r\n" else _ESCAPES.get(n, n)
                continue
            depth += (c == b"(") - (c == b")")
            if depth == 0:
                break
            out += c
        return bytes(out)

    def _dictionary(self) -> dict:
        out: dict[str, object] = {}
        while isinstance(key := self.value(), Name):
            out[key.value] = self.value()
        return out


class Document:
    def __init__(self, data: bytes):
        if b"/Encrypt" in data:
            raise ValueError("encrypted PDF files are not supported")
        self.objects: dict[int, object] = {}
        for m in _OBJECT.finditer(data):
            reader = Reader(data, m.end())
            value = reader.value()
            reader.skip()
            if isinstance(value, dict) and data.startswith(b"stream", reader.at):
                start = reader.at + 6
                start += 2 if data[start : start + 2] == b"\r\n" else 1
                length = value.get("Length")
                end = start + length if isinstance(length, int) and data[start + length : start + length + 12].lstrip().startswith(b"endstream") else data.find(b"endstream", start)
                value = Stream(value, data[start : end if end >= 0 else len(data)])
            self.objects[int(m[1])] = value
        for s in [v for v in self.objects.values() if isinstance(v, Stream) and v.head.get("Type") == Name("ObjStm")]:
            body = s.data()
            numbers = Reader(body)
            pairs = [(numbers.value(), numbers.value()) for _ in range(self.get(s.head["N"]))]
            for number, offset in pairs:
                self.objects.setdefault(number, Reader(body, self.get(s.head["First"]) + offset).value())

    def get(self, value: object) -> object:
        for _ in range(20):
            if not isinstance(value, Ref):
                return value
            value = self.objects.get(value.number)
        return None

    def pages(self) -> Iterator[tuple[dict, dict, list]]:
        """(page, resources, media box) in order."""
        root = next((v for v in self.objects.values() if isinstance(v, dict) and v.get("Type") == Name("Catalog")), None)
        if root is None:
            raise ValueError("no PDF catalog")
        stack = [(root.get("Pages"), {}, [0, 0, 612, 792], 0)]
        while stack:
            ref, resources, box, depth = stack.pop()
            node = self.get(ref)
            if not isinstance(node, dict) or depth > 50:
                continue
            resources, box = self.get(node.get("Resources")) or resources, self.get(node.get("MediaBox")) or box
            if "Kids" in node:
                stack += [(k, resources, box, depth + 1) for k in reversed(self.get(node["Kids"]))]
            else:
                yield node, resources, [self.get(x) for x in box]

    def font(self, value: object) -> Font:
        head = self.get(value) or {}
        mapped = self.get(head.get("ToUnicode"))
        return Font(head.get("Subtype") == Name("Type0"), _to_unicode(mapped.data()) if isinstance(mapped, Stream) else {})


@dataclass(frozen=True)
class Font:
    wide: bool = False
    table: dict[int, str] = field(default_factory=dict)

    def text(self, raw: bytes) -> str:
        if self.wide:
            codes = [int.from_bytes(raw[k : k + 2], "big") for k in range(0, len(raw), 2)]
            return "".join(self.table.get(c, "") for c in codes)
        return "".join(self.table.get(c) or bytes([c]).decode("cp1252", errors="replace") for c in raw)


def _to_unicode(cmap: bytes) -> dict[int, str]:
    out: dict[int, str] = {}
    held: list = []
    number = lambda b: int.from_bytes(b, "big")
    shown = lambda b: b.decode("utf-16-be", errors="replace")
    reader = Reader(cmap)
    while (v := reader.value()) is not None:
        if isinstance(v, Operator):
            if v.value == "endbfchar":
                out |= {number(a): shown(b) for a, b in zip(held[::2], held[1::2], strict=False)}
            elif v.value == "endbfrange":
                for a, z, b in zip(held[::3], held[1::3], held[2::3], strict=False):
                    for k in range(number(z) - number(a) + 1):
                        out[number(a) + k] = shown(b[k]) if isinstance(b, list) else shown(b[:-2] + (number(b[-2:]) + k).to_bytes(2, "big"))
            held = []
        else:
            held.append(v)
    return out


def _times(a: list[float], b: list[float]) -> list[float]:
    return [a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5]]


def _pieces(doc: Document, content: bytes, resources: dict) -> Iterator[tuple[float, float, float, str]]:
    """(x, y, size, text) of each shown string, in drawing order; y from the bottom."""
    fonts = {k: doc.font(v) for k, v in (doc.get(resources.get("Font")) or {}).items()}
    unit = [1, 0, 0, 1, 0, 0]
    state, saved, font, size, leading = unit, [], Font(), 1.0, 0.0
    text = line = unit
    held: list = []
    reader = Reader(content)
    while (v := reader.value()) is not None:
        if not isinstance(v, Operator):
            held.append(v)
            continue
        name, n = v.value, [x for x in held if isinstance(x, int | float)]
        if name == "q":
            saved.append(state)
        elif name == "Q" and saved:
            state = saved.pop()
        elif name == "cm" and len(n) == 6:
            state = _times(n, state)
        elif name == "BT":
            text = line = unit
        elif name == "Tf" and held and n:
            font, size = fonts.get(held[0].value, Font()) if isinstance(held[0], Name) else font, float(n[-1])
        elif name == "TL" and n:
            leading = n[0]
        elif name in ("Td", "TD") and len(n) == 2:
            leading = -n[1] if name == "TD" else leading
            text = line = _times([1, 0, 0, 1, n[0], n[1]], line)
        elif name == "Tm" and len(n) == 6:
            text = line = n
        if name in ("T*", "'", '"'):
            text = line = _times([1, 0, 0, 1, 0, -leading], line)
        if name in ("Tj", "'", '"', "TJ") and held:
            parts = held[-1] if isinstance(held[-1], list) else [held[-1]]
            shown = "".join(font.text(p) if isinstance(p, bytes) else " " if isinstance(p, int | float) and p < -200 else "" for p in parts)
            at = _times(text, state)
            yield at[4], at[5], abs(size * at[3]) or abs(size), shown
            text = _times([1, 0, 0, 1, size * len(shown) / 2, 0], text)  # widths are not read: half an em each
        held = []


def read_pages(data: bytes) -> list[tuple[float, list[PageBlock]]]:
    """(height, blocks) of each page: lines near each other form a block, blocks go from top to bottom."""
    doc = Document(data)
    out = []
    for page, resources, box in doc.pages():
        parts = doc.get(page.get("Contents"))
        streams = [doc.get(x) for x in parts] if isinstance(parts, list) else [parts]
        content = b"\n".join(s.data() for s in streams if isinstance(s, Stream))
        lines: list[list] = []  # y, size, text
        for x, y, size, text in sorted(_pieces(doc, content, resources), key=lambda p: -p[1]):
            if not text.strip():
                continue
            if lines and abs(lines[-1][0] - y) < 0.3 * size:
                lines[-1][2].append((x, text))
            else:
                lines.append([y, size, [(x, text)]])
        height = float(box[3] - box[1])
        blocks: list[list] = []  # y0, y1, texts
        for y, size, pieces in lines:
            text = " ".join(t for _, t in sorted(pieces, key=lambda p: p[0]))
            top, bottom = height - (y - box[1]) - size, height - (y - box[1])
            if blocks and top - blocks[-1][1] < 0.7 * size:
                blocks[-1][1] = bottom
                blocks[-1][2].append(text)
            else:
                blocks.append([top, bottom, [text]])
        out.append((height, [(a, b, "\n".join(t)) for a, b, t in blocks]))
    return out
