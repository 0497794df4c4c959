"""Files of a corpus, and extractors that turn one file's bytes into blocks."""

from __future__ import annotations

import csv
import io
import json
import re
import struct
import zipfile
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.sources.pdf import read_pages

#: A block: its text and what is known of it.
Block = tuple[str, dict]
Extractor = Callable[[bytes], tuple[list[Block], dict]]

# Keys of JSON objects that hold text.
TEXT_KEYS = ("title", "body", "body_text", "body_paragraphs", "content", "text", "description", "summary", "headline")
LIFTED_KEYS = ("url", "date", "published", "tags")
_DROPPED = frozenset(("script", "style", "nav", "footer", "header"))
_SHOWN = frozenset(("h1", "h2", "h3", "p", "li"))
_CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table ul".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def listed(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """path (relative), size, mtime_ns and, if wanted, content of every file below ``root``.

    Spark reads no empty files; they are added from its own listing, without a time.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kept = ["content"] if content else []
    full = files.select(T.relative_path(F.col("path"), root).alias("path"), F.col("length").alias("size"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"), *kept)
    names = spark.createDataFrame([(p,) for p in files.inputFiles()], "path string").select(T.relative_path(F.col("path"), root).alias("path"))
    empty = names.join(full.select("path"), "path", "left_anti").select("path", F.lit(0).cast("long").alias("size"), F.lit(None).cast("long").alias("mtime_ns"), *(F.lit(b"").alias(c) for c in kept))
    return full.unionByName(empty).where(~F.col("path").rlike(r"(^|/)\.DS_Store$"))


def scan(spark: SparkSession, root: str) -> DataFrame:
    """path (relative), size, mtime_ns of every file below ``root``; contents are not read."""
    return listed(spark, root)


def json_blocks(value: object, keys: tuple[str, ...] = TEXT_KEYS, path: str = "$") -> Iterator[Block]:
    """Text fields at any depth, in source order; numbers and booleans under a text key count as text."""
    if isinstance(value, list):
        for k, child in enumerate(value):
            yield from json_blocks(child, keys, f"{path}[{k}]")
    elif isinstance(value, dict):
        for key, child in value.items():
            here = f"{path}.{key}"
            telling = key.lower() in keys
            items = [(here, child)] if not (telling and isinstance(child, list)) else [(f"{here}[{k}]", c) for k, c in enumerate(child)]
            for at, item in items:
                if telling and isinstance(item, str | int | float):
                    yield f"{key}: {item}", {"json_path": at}
                else:
                    yield from json_blocks(item, keys, at)


def extract_text(content: bytes) -> tuple[list[Block], dict]:
    return [(content.decode("utf-8", errors="replace"), {})], {}


def extract_json(content: bytes) -> tuple[list[Block], dict]:
    value = json.loads(content.decode("utf-8", errors="replace"))
    known = {k: value[k] for k in LIFTED_KEYS if k in value} if isinstance(value, dict) else {}
    return list(json_blocks(value)), {"json_type": type(value).__name__} | known


def _row(pairs: Iterator[tuple[object, object]]) -> str:
    return "; ".join(f"{k}: {v}" for k, v in pairs if v is not None and v != "")


def extract_csv(content: bytes) -> tuple[list[Block], dict]:
    rows = csv.DictReader(io.StringIO(content.decode("utf-8-sig", errors="replace"), newline=""))
    return [(_row(iter(row.items())), {"row_number": k, "unit_type": "row"}) for k, row in enumerate(rows, 2)], {}


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _cell(cell: ElementTree.Element, shared: list[str]) -> object:
    kind, value = cell.get("t", "n"), cell.find(f"{_SHEET}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_SHEET}t"))
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return value.text == "1"
    if kind in ("str", "e", "d"):
        return value.text
    number = float(value.text)
    return int(number) if number.is_integer() and not re.search("[.eE]", value.text) else number


def _column(reference: str) -> int:
    out = 0
    for c in re.match("[A-Z]*", reference)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


def extract_xlsx(content: bytes) -> tuple[list[Block], dict]:
    """Rows of every sheet with the first row as names; numbers are shown as stored, dates as their serial numbers."""
    blocks: list[Block] = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_SHEET}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_SHEET}sheet"):
            target = targets[sheet.get(_REL)].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            heads: dict[int, object] = {}
            for n, row in enumerate(root.iter(f"{_SHEET}row"), 1):
                number = int(row.get("r", n))
                cells = {_column(c.get("r", "")) if c.get("r") else k: _cell(c, shared) for k, c in enumerate(row.findall(f"{_SHEET}c"))}
                if number == 1:
                    heads = {k: v for k, v in cells.items() if v}
                else:
                    blocks.append((_row((heads[k], v) for k, v in sorted(cells.items()) if k in heads), {"sheet": sheet.get("name"), "row_number": number, "unit_type": "row"}))
    return blocks, {}


class _Page(HTMLParser):
    """Texts of headings, paragraphs and list items in document order; an open paragraph ends where another begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.open: list[tuple[str, int | None]] = []
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            return
        if tag in _CLOSES_P and any(t == "p" for t, _ in self.open):
            self._close("p")
        if tag in _DROPPED:
            self.silent += 1
        slot = None
        if tag in _SHOWN and not self.silent:
            slot = len(self.found)
            self.found.append((tag, []))
        self.open.append((tag, slot))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in _VOID:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def _close(self, tag: str) -> None:
        while self.open:
            name, _ = self.open.pop()
            self.silent -= name in _DROPPED
            if name == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, _ in self.open):
            self._close(tag)

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if text and not self.silent:
            for _, slot in self.open:
                if slot is not None:
                    self.found[slot][1].append(text)


def html_blocks(html: str) -> list[tuple[str, str]]:
    """(text, unit type) of headings, paragraphs and list items outside scripts, styles, navigation, headers and footers."""
    page = _Page()
    page.feed(html)
    page.close()
    return [(" ".join(parts), "list_item" if tag == "li" else "paragraph") for tag, parts in page.found]


def extract_html(content: bytes) -> tuple[list[Block], dict]:
    return [(text, {"unit_type": kind}) for text, kind in html_blocks(content.decode("utf-8", errors="replace"))], {}


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffers message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def _tile_value(data: bytes) -> object:
    number, value = next(_fields(data))
    if number == 1:
        return value.decode()
    if number == 2:
        return struct.unpack("<f", value)[0]
    if number == 3:
        return struct.unpack("<d", value)[0]
    if number == 6:
        return value >> 1 ^ -(value & 1)
    if number == 7:
        return bool(value)
    return value - (1 << 64) if number == 4 and value >> 63 else value


def tile_features(content: bytes) -> Iterator[tuple[str, int | None, dict]]:
    """(layer, feature id, properties) of a vector tile, in file order."""
    for number, layer in _fields(content):
        if number != 3:
            continue
        parts: dict[int, list] = {}
        for n, value in _fields(layer):
            parts.setdefault(n, []).append(value)
        keys, values = [k.decode() for k in parts.get(3, [])], [_tile_value(v) for v in parts.get(4, [])]
        for feature in parts.get(2, []):
            got = dict(_fields(feature))
            tags: list[int] = []
            packed, at = got.get(2, b""), 0
            while at < len(packed):
                value = shift = 0
                while True:
                    byte = packed[at]
                    at += 1
                    value |= (byte & 127) << shift
                    shift += 7
                    if byte < 128:
                        break
                tags.append(value)
            yield parts[1][0].decode(), got.get(1), {keys[a]: values[b] for a, b in zip(tags[::2], tags[1::2], strict=True)}


def extract_tile(content: bytes) -> tuple[list[Block], dict]:
    seen, blocks = set(), []
    for layer, number, properties in tile_features(content):
        key = layer, tuple(sorted((k, str(v)) for k, v in properties.items()))
        if properties and key not in seen:
            seen.add(key)
            shown = "; ".join([f"layer: {layer}", *(f"{k}: {v}" for k, v in properties.items())])
            blocks.append((shown, {"layer": layer, "feature_id": number, "unit_type": "row"}))
    return blocks, {"pbf_features": len(blocks)}


#: Words of a page image: (block, paragraph, line, text, confidence as read).
OcrWord = tuple[int, int, int, str, object]


def ocr_paragraphs(words: Iterable[OcrWord], min_confidence: float = 60.0) -> list[tuple[str, float | None, int, int]]:
    """(text, mean confidence, block, paragraph) of the paragraphs that are confident enough, for extractors."""
    held: dict[tuple[int, int], dict[int, list[tuple[str, float]]]] = {}
    for block, paragraph, line, text, confidence in words:
        if text := clean(text):
            try:
                sure = float(confidence)
            except (TypeError, ValueError):
                sure = -1.0
            held.setdefault((block, paragraph), {}).setdefault(line, []).append((text, sure))
    out = []
    for (block, paragraph), lines in sorted(held.items()):
        row = [w for _, part in sorted(lines.items()) for w in part]
        known = [c for _, c in row if c >= 0]
        mean = sum(known) / len(known) if known else None
        if mean is None or mean >= min_confidence:
            out.append((clean(" ".join(t for t, _ in row)), None if mean is None else round(mean, 2), block, paragraph))
    return out


def _ocr_blocks(words: Iterable[OcrWord], min_confidence: float, engine: str, **more: object) -> list[Block]:
    facts = {"ocr_engine": engine, "unit_type": "ocr_paragraph"} | more
    return [(text, facts | {"ocr_confidence": sure, "ocr_block": block, "ocr_paragraph": paragraph}) for text, sure, block, paragraph in ocr_paragraphs(words, min_confidence)]


def image_extractor(ocr: Callable[[bytes], Iterable[OcrWord]], min_confidence: float = 60.0, engine: str = "ocr") -> Extractor:
    """An extractor for images from a function that reads their words."""
    return lambda content: (_ocr_blocks(ocr(content), min_confidence, engine), {"ocr_applied": True, "ocr_dpi": None})


def pdf_extractor(
    pages: Callable[[bytes], list[tuple[float, list[tuple[float, float, str]]]]] = read_pages,
    ocr: Callable[[bytes], list[Iterable[OcrWord]]] | None = None,
    min_confidence: float = 60.0,
    engine: str = "ocr",
    dpi: int = 250,
) -> Extractor:
    """An extractor for PDF files from a function that gives each page's height and blocks (y0, y1, text).

    Short texts in the margins of a third of the pages, three at least, go wherever
    they stand. Only a file without any block is given to ``ocr``, if there is one.
    """

    def run(content: bytes) -> tuple[list[Block], dict]:
        found = [(height, [(y0, y1, text, k) for k, (y0, y1, raw) in enumerate(blocks) if (text := clean(raw))]) for height, blocks in pages(content)]
        margins = Counter(text for height, blocks in found for y0, y1, text, _ in blocks if len(text) <= 120 and (y0 < 72 or y1 > height - 72))
        repeated = {text for text, n in margins.items() if n >= max(3, len(found) // 3)}
        out = [(text, {"page_start": page, "page_end": page, "block_number": k}) for page, (_, blocks) in enumerate(found, 1) for _, _, text, k in blocks if text not in repeated]
        facts = {"page_start": 1, "page_end": len(found)}
        if out or ocr is None:
            return out, facts | {"removed_repeated_blocks": len(repeated), "ocr_applied": False}
        read = [b for page, words in enumerate(ocr(content), 1) for b in _ocr_blocks(words, min_confidence, engine, page_start=page, page_end=page)]
        return read, facts | {"removed_repeated_blocks": 0, "ocr_applied": True, "ocr_dpi": dpi}

    return run


def needs(what: str) -> Extractor:
    """Stands for an extractor that has to be given, as no library for it comes with this package."""

    def run(content: bytes) -> tuple[list[Block], dict]:
        raise RuntimeError(f"give an extractor for {what}: none is built in")

    return run


EXTRACTORS: dict[str, Extractor] = {
    ".txt": extract_text, ".md": extract_text, ".json": extract_json, ".csv": extract_csv, ".xlsx": extract_xlsx,
    ".html": extract_html, ".htm": extract_html, ".pbf": extract_tile, ".pdf": pdf_extractor(),
} | dict.fromkeys((".jpg", ".jpeg", ".png", ".avif"), needs("images (OCR)"))

_CONTROL, _BLANKS, _GAP = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), re.compile(r"[ \t]+"), re.compile(r"\n[ \t]*\n+")


def clean(text: str | None) -> str:
    """``clean_text`` for extractors."""
    return _GAP.sub("\n\n", _BLANKS.sub(" ", _CONTROL.sub(" ", text or ""))).strip()


def extract(suffix: str, content: bytes, name: str = "", extractors: dict[str, Extractor] = EXTRACTORS) -> list[Block]:
    """The blocks of a file that have text, each with the file's and its own facts."""
    if suffix not in extractors:
        raise RuntimeError(f"no extractor for {suffix or 'files without extension'}")
    blocks, facts = extractors[suffix](content)
    base = {"source_name": name, "page_start": None, "page_end": None} | facts
    return [(t, base | extra) for t, extra in ((clean(text), extra) for text, extra in blocks) if t]


BLOCKS = "path string, block_no int, text string, page_start int, page_end int, unit_type string, extra string, error string"


def _extract(extractors: dict[str, Extractor]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, suffix, content in zip(*(batch.column(c).to_pylist() for c in ("path", "suffix", "content")), strict=True):
                try:
                    blocks, error = extract(suffix, content, path.rsplit("/", 1)[-1], extractors), None
                except Exception as e:  # a bad file is a row, not a failed job
                    blocks, error = [], f"{type(e).__name__}: {e}"
                rows = [(path, k, t, x["page_start"], x["page_end"], x.get("unit_type"), json.dumps(x, ensure_ascii=False, default=str), None) for k, (t, x) in enumerate(blocks)] or [(path, None, None, None, None, None, None, error)]
                kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["path", "block_no", "text", "page_start", "page_end", "unit_type", "extra", "error"])

    return run


def extract_files(files: DataFrame, extractors: dict[str, Extractor] = EXTRACTORS) -> DataFrame:
    """Blocks of files (path, content); a file that fails or has no text is one row without text, with its error."""
    return files.select("path", T.extension(F.col("path")).alias("suffix"), "content").mapInArrow(_extract(extractors), BLOCKS)


def read_blocks(spark: SparkSession, root: str, extractors: dict[str, Extractor] = EXTRACTORS) -> DataFrame:
    return extract_files(listed(spark, root, content=True), extractors).withColumn("doc_id", T.stable_doc_id(F.col("path")))


def json_fields(rows: DataFrame, column: str, keys: tuple[str, ...] = TEXT_KEYS) -> DataFrame:
    """The rows' other columns with pos, text, json_path of each text field of a JSON column; what is no JSON has none."""

    @F.pandas_udf("array<struct<text:string,json_path:string>>")
    def fields(values):
        def one(v):
            try:
                return [{"text": t, "json_path": x["json_path"]} for t, x in json_blocks(json.loads(v), keys)]
            except (TypeError, ValueError):
                return []

        return values.map(one)

    others = [c for c in rows.columns if c != column]
    return rows.select(*others, F.posexplode(fields(F.col(column))).alias("pos", "f")).select(*others, "pos", F.col("f.text").alias("text"), F.col("f.json_path").alias("json_path"))


def html_fields(rows: DataFrame, column: str = "html") -> DataFrame:
    """The rows' other columns with pos, text, unit_type of each block of an HTML column."""

    @F.pandas_udf("array<struct<text:string,unit_type:string>>")
    def blocks(values):
        return values.map(lambda v: [{"text": clean(t), "unit_type": k} for t, k in html_blocks(v or "") if clean(t)])

    others = [c for c in rows.columns if c != column]
    return rows.select(*others, F.posexplode(blocks(F.col(column))).alias("pos", "b")).select(*others, "pos", "b.text", "b.unit_type")
