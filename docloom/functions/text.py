"""Column functions over text: cleaning, words, sentences, languages, identity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits strings built by these functions; clean text cannot hold it.
MARK = "\x01"

# File formats with an extractor.
SUPPORTED = (".pdf", ".json", ".csv", ".xlsx", ".txt", ".md", ".html", ".htm", ".jpg", ".jpeg", ".png", ".avif", ".pbf")

# Frequent words that tell the languages apart; earlier languages win ties.
LANGUAGE_WORDS = {
    "es": ("de", "la", "el", "los", "las", "para", "que", "en", "con", "por", "una", "del", "como"),
    "en": ("the", "and", "of", "to", "in", "for", "with", "that", "from", "is", "are", "this"),
    "pt": ("a", "é", "de", "da", "do", "para", "que", "em", "com", "por", "uma", "dos", "das", "não", "também", "comissão"),
}

# Fixed patterns.
LIST_MARKER = r"(?U)^\s*(?:[-*•▪◦]|\(?\d{1,3}[.)]|[A-Za-z][.)])\s+"
CAPITAL = "A-ZÁÉÍÓÚÜÑÀ-Ý"
SENTENCE_END = rf"""(?U)(?<=[.!?…])([\])"'»”]*)\s+(?=[¿¡]?[{CAPITAL}])"""
PARAGRAPH_GAP = r"(?U)\n\s*\n+"
LANGUAGE_TOKEN = "[a-záéíóúüñçãõ]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named; inside lambdas Spark would compute it each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def clean_text(text: Column) -> Column:
    """Null as empty, control characters and runs of blanks as a space, blank lines as one, ends stripped."""
    x = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ")
    x = F.regexp_replace(x, r"[ \t]+", " ")
    return strip(F.regexp_replace(x, r"\n[ \t]*\n+", "\n\n"))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0)))


def _nonblank(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def sentence_parts(block: Column) -> Column:
    """Sentences of a block: cut after closing punctuation and its closers, before a capital."""
    return _nonblank(F.split(F.regexp_replace(block, SENTENCE_END, f"$1{MARK}"), MARK))


def list_units(block: Column) -> Column:
    """List items with their wrapped lines, or null if the block does not start with a list marker."""

    def units(lines: Column) -> Column:
        marked = F.array_join(F.transform(lines, lambda x: F.concat(F.when(x.rlike(LIST_MARKER), F.lit(MARK)).otherwise(F.lit(" ")), x)), "")
        return F.when(F.coalesce(F.get(lines, F.lit(0)).rlike(LIST_MARKER), F.lit(False)), F.filter(F.split(marked, MARK), lambda x: x != ""))

    return let(_nonblank(F.split(block, r"\R")), units)


def is_table_row(block: Column) -> Column:
    """At least two semicolons, and a colon in every piece that is not blank."""
    pieces = F.split(block, ";")
    return (F.size(pieces) >= 3) & F.forall(_nonblank(pieces), lambda x: F.contains(x, F.lit(":")))


def paragraphs(text: Column) -> Column:
    return F.split(clean_text(text), PARAGRAPH_GAP)


def sentences(text: Column) -> Column:
    """Units of a text that are never cut: list items, table rows and sentences."""

    def units(block: Column) -> Column:
        listed = list_units(block)
        row = F.filter(F.array(strip(block)), lambda x: x != "")
        return F.coalesce(listed, F.when(is_table_row(block), row).otherwise(sentence_parts(block)))

    return F.flatten(F.transform(paragraphs(text), units))


def detect_language(text: Column) -> Column:
    """The language with most frequent words, "und" below two; null and empty texts are "und"."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LANGUAGE_TOKEN), F.lit(0))

    def hits(tokens: Column, words: tuple[str, ...]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(*words)))

    def choose(scores: Column) -> Column:
        best = F.array_max(scores)
        out = F.when(best < 2, F.lit("und"))
        for k, name in enumerate(LANGUAGE_WORDS):
            out = out.when(F.get(scores, F.lit(k)) == best, F.lit(name))
        return out

    return let(let(found, lambda tokens: F.array(*(hits(tokens, words) for words in LANGUAGE_WORDS.values()))), choose)


def stable_doc_id(path: Column) -> Column:
    return F.concat(F.lit("DOC-"), F.upper(F.substring(F.sha2(path, 256), 1, 16)))


def phenomenon(path: Column) -> Column:
    """1 to 3 where the first path segment starts with f1_ to f3_, else null."""
    digit = F.regexp_extract(F.lower(F.split_part(path, F.lit("/"), F.lit(1))), "^f([123])_", 1)
    return F.when(digit != "", digit.cast("int"))


def relative_path(path: Column, root: str) -> Column:
    """The part of a file path below ``root``, whatever scheme the path is written with."""
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*(?=/))?", "")
    base = root.split("://", 1)[1] if "://" in root else root.removeprefix("file:")
    base = "/" + base.split("/", 1)[1] if "://" in root and "/" in base else base
    return F.substr(plain, F.lit(len(base.rstrip("/")) + 2))


def extension(path: Column) -> Column:
    """Lower-case suffix with its dot, or an empty string; a name that only starts with a dot has none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def preview(text: Column, limit: int = 420) -> Column:
    return F.substring(strip(collapse(text)), 1, limit)


def key_values(columns: dict[str, Column]) -> Column:
    """"k: v" joined by "; ", without null and empty values."""
    shown = [F.when(c.isNotNull() & (c.cast("string") != ""), F.concat(F.lit(f"{name}: "), c.cast("string"))) for name, c in columns.items()]
    return F.concat_ws("; ", *shown)


def is_list_or_table(text: Column, suffix: Column) -> Column:
    lines = _nonblank(F.split(text, r"\R"))
    bullets = F.size(F.filter(lines, lambda x: x.rlike(r"(?U)^(?:[-*•]|\d+[.)])\s+")))
    fields = F.length(text) - F.length(F.translate(text, ":;", ""))
    return suffix.isin(".csv", ".xlsx", ".pbf") | (bullets >= 2) | ((F.size(lines) >= 4) & (fields >= F.size(lines)))


def long_unit_category(text: Column, suffix: Column, parts: Callable[[Column], Column] = sentences) -> Column:
    """Why a unit above the token limit is left out; ``parts`` cuts it, to see whether it is one sentence."""
    return (
        F.when(is_list_or_table(text, suffix), F.lit("lista_o_tabla_texto_plano"))
        .when(F.size(parts(text)) == 1, F.lit("oracion_aparentemente_unica_gigante"))
        .otherwise(F.lit("bloque_mas_de_480_tokens"))
    )
