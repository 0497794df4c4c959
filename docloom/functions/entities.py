"""Entities and relations of a text, by fixed phrases, capitals and trigger words."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from docloom.functions import text as T

# Phrases that are concepts wherever they occur in lower-case text.
CONCEPTS = (
    "inteligencia artificial", "seguridad espacial", "órbita baja terrestre",
    "cambio climático", "derechos humanos", "américa latina", "américa del sur",
    "estados unidos", "unión europea", "fuerzas armadas", "fuerza aeroespacial",
    "sector defensa", "ciencia y tecnología", "desarrollo humano", "space debris",
    "low earth orbit", "artificial intelligence", "machine learning", "cybersecurity",
    "sistemas autónomos", "sistemas no tripulados", "derecho internacional humanitario",
    "derecho internacional", "infraestructura crítica", "guerra electrónica", "energía dirigida",
    "capacidades contraespaciales", "sistemas satelitales", "desechos orbitales", "pruebas antisatélite",
    "operaciones espaciales", "dominio espacial", "órbita geoestacionaria", "reabastecimiento en órbita",
    "control territorial", "grupos armados", "crimen organizado", "economías ilícitas", "minería ilegal",
    "narcotráfico", "reclutamiento infantil", "restitución de tierras", "recursos naturales",
    "electronic warfare", "directed energy", "counterspace capabilities", "satellite systems",
    "orbital debris", "anti-satellite tests", "territorial control", "organized crime", "illegal mining",
    "drones", "semiconductores", "spoofing", "infraestructura satelital", "sistemas espaciales",
    "capacidades láser", "capacidad nuclear antisatélite", "satélites rusos", "órbita geo",
    "grupos criminales", "población civil", "homicidios selectivos", "rutas aéreas", "narcóticos",
    "contrabando", "satellite infrastructure", "laser capabilities", "air routes",
)

# Labels that are no entities.
NOT_ENTITIES = (
    "el", "la", "los", "las", "un", "una", "uno", "the", "this", "that", "these",
    "para", "como", "cómo", "desde", "entre", "según", "también", "sin", "sobre", "más",
    "qué", "que", "cuál", "cuáles", "quién", "quiénes", "dónde", "cuándo", "de qué manera",
    "what", "how", "which", "who", "where", "when", "why", "qual", "quais", "quem",
    "estado", "estados", "geo",
)

# Parts of a label that make it an organisation.
ORGANISATION_PARTS = ("universidad", "ministerio", "nato", "onu", "fuerza")

# Words that name a relation.
TRIGGERS = (
    "desarrolla|desarrollan|utiliza|utilizan|emplea|emplean|afecta|amenaza|"
    "regula|regulan|fortalece|fortalecen|depende|depender|protege|protegen|"
    "promueve|promueven|impacta|impactan|genera|generan|requiere|requieren|"
    "cooper[aá]|contribuye|contribuyen|enfrenta|enfrentan|financia|financian|"
    "controla|controlan|interfiere|interfieren|obstaculiza|obstaculizan|incrementa|incrementan|"
    "incorpora|incorporan|transforma|transforman|despliega|despliegan|improves?|supports?|"
    "empleando|utilizando|desarrollando|incorporando|transformando|detecta|detectan|identifica|identifican|"
    "neutraliza|neutralizan|representa|representan|demuestra|demuestran|evidencia|evidencian|"
    "realiza|realizan|compromete|comprometen|revela|revelan|limita|limitan|aumenta|aumentan|"
    "busca|buscan|logra|logran|asegura|aseguran|adapta|adaptan|"
    "threatens?|regulates?|affects?|uses?|develops?"
)

# The pattern of a capitalised name of up to six words, and the marks that go from a label's ends.
_LETTER = "[A-ZÁÉÍÓÚÜÑÇÃÕ]"
_REST = "[\\wÁÉÍÓÚÜÑáéíóúüñçãõ-]*"
NAME = rf"\b(?:{_LETTER}{_REST})(?:\s+(?:{_LETTER}{_REST})){{0,5}}\b"
OUTER = " ,;:()[]{}\"'"


@dataclass(frozen=True)
class Lexicon:
    concepts: tuple[str, ...] = CONCEPTS
    not_entities: tuple[str, ...] = NOT_ENTITIES
    organisation_parts: tuple[str, ...] = ORGANISATION_PARTS
    triggers: str = TRIGGERS

    @property
    def trigger_pattern(self) -> str:
        return rf"(?iU)\b({self.triggers})\b"


DEFAULT = Lexicon()
ENTITIES = ArrayType(StructType([StructField("label", StringType()), StructField("entity_type", StringType())]))
_LISTS = pa.list_(pa.struct([("label", pa.string()), ("entity_type", pa.string())]))


def normalize_entity(text: Column) -> Column:
    """Outer marks off, white space collapsed, lower case; for texts whose characters are composed."""
    return F.lower(T.collapse(F.btrim(text, F.lit(OUTER))))


def normalized(label: str) -> str:
    """The same with characters composed."""
    return unicodedata.normalize("NFC", re.sub(r"\s+", " ", label.strip(OUTER))).lower()


class Extractor:
    """The labels of texts under a lexicon.

    All known phrases are one automaton, made once by the driver and sent to the
    workers: a text is read once, however many phrases there are.
    """

    def __init__(self, lexicon: Lexicon):
        self.automaton = ahocorasick.Automaton()
        for phrase in lexicon.concepts:
            self.automaton.add_word(phrase, normalized(phrase))
        self.automaton.make_automaton()
        self.not_entities, self.organisation_parts = frozenset(lexicon.not_entities), lexicon.organisation_parts

    def concepts(self, text: str) -> set[str]:
        if not len(self.automaton):
            return set()
        return {label for _, label in self.automaton.iter(text.lower())}

    def entities(self, text: str) -> list[tuple[str, str]]:
        """(label, entity_type) by label; a one-word label goes if it is a word of another label.

        Names are sought in the composed text, so that a letter and its mark are one.
        """
        found = dict.fromkeys(self.concepts(text), "concept")
        for name in _NAME.findall(unicodedata.normalize("NFC", text)):
            label = normalized(name)
            if len(label) > 2 and label not in found and label not in self.not_entities:
                found[label] = "organization" if any(p in label for p in self.organisation_parts) else "entity"
        labels = sorted(found)
        together = "\n".join(labels)
        return [(x, found[x]) for x in labels if " " in x or together.count(x) == 1 or not self._inside(x, labels)]

    @staticmethod
    def _inside(label: str, labels: list[str]) -> bool:
        word = re.compile(rf"\b{re.escape(label)}\b")
        return any(label in other and word.search(other) for other in labels if other != label)


_NAME = re.compile(NAME)
#: Texts of an Arrow batch that are Python objects at a time.
_ROWS = 128


def _found(extractor: Broadcast):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = extractor.value
        for column in texts:
            parts = (column.slice(k, _ROWS).to_pylist() for k in range(0, max(1, len(column)), _ROWS))
            yield pa.concat_arrays([pa.array([held.entities(t or "") for t in part], _LISTS) for part in parts])

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}  # read by arrow_udf
    return F.arrow_udf(run, ENTITIES)


def with_entities(chunks: DataFrame, text: str = "texto", lexicon: Lexicon = DEFAULT) -> DataFrame:
    """The chunks with ``entities``, an array of (label, entity_type) sorted by label."""
    extractor = chunks.sparkSession.sparkContext.broadcast(Extractor(lexicon))
    return chunks.withColumn("entities", _found(extractor)(F.col(text)))


def relations(chunks: DataFrame, text: str = "texto", lexicon: Lexicon = DEFAULT) -> DataFrame:
    """(subject, relation, object) rows of chunks with ``entities``, next to the chunks' other columns.

    In each sentence the first trigger counts, with the nearest entity before it and
    the nearest at or after its end; where one side has none, the first or last
    entity by label. Entities at the same place go by label.
    """
    carried = [c for c in chunks.columns if c not in (text, "entities")]

    def spot(sentence: Column) -> Column:
        return F.struct(sentence.alias("s"), F.regexp_extract(sentence, lexicon.trigger_pattern, 1).alias("t"), F.regexp_instr(sentence, F.lit(lexicon.trigger_pattern)).alias("at"))

    def places(n: Column) -> Column:
        return F.transform(F.filter("_labels", lambda x: F.contains(n, x)), lambda x: F.struct((F.call_function("locate", x, n) - 1).alias("at"), x.alias("label")))

    # conditions stand inside the arrays that are exploded: as filters, they would be evaluated below, with a sentence's regular expressions for each of its labels
    spotted = F.filter(F.transform(F.split(F.col(text), r"(?U)(?<=[.!?])\s+"), spot), lambda x: x["at"] > 0)
    each = chunks.select(*carried, F.col("entities.label").alias("_labels"), F.explode_outer(spotted).alias("_x"))
    found = F.filter(F.array(T.let(normalize_entity(F.col("_x.s")), places)), lambda e: F.size(e) >= 2)
    placed = each.where("_x IS NOT NULL").select(*carried, F.col("_x.t").alias("_t"), (F.col("_x.at") - 1).alias("_from"), (F.col("_x.at") - 1 + F.length("_x.t")).alias("_to"), F.explode_outer(found).alias("_e")).where("_e IS NOT NULL")
    placed = placed.select(*carried, "_t", "_e", F.filter("_e", lambda e: e["at"] < F.col("_from")).alias("_before"), F.filter("_e", lambda e: e["at"] >= F.col("_to")).alias("_after"))

    def pick(side: str, best: Column, fallback: Column) -> Column:
        return F.when(F.size(side) > 0, F.get(F.filter(side, lambda e: e["at"] == best), F.lit(0))["label"]).otherwise(fallback)

    subject = pick("_before", F.array_max(F.col("_before.at")), F.element_at("_e", 1)["label"])
    object_ = pick("_after", F.array_min(F.col("_after.at")), F.element_at("_e", -1)["label"])
    return placed.select(*carried, subject.alias("subject"), F.lower("_t").alias("relation"), object_.alias("object")).where("subject <> object").distinct()
