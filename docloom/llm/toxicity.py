"""Toxicity by a classifier chain of linear models.

Categories have an order. Each one's model reads the words of a text, a few
measures of its form and the probabilities of all categories before it. In training
those probabilities are out of fold, so that a later model learns how far to trust an
earlier one on texts it has not seen; in use they come from the earlier model
fitted on all training rows.

Folds are by a hash of the text's words, so that copies of a text share a fold. A link
after the first is fitted with out-of-fold probabilities only where every row has one:
with a single fold filled the chain falls back to the share of the label.

Training uses at most ``sample_rows`` labelled rows: those with the least hash of
their doc_id, so that the sample does not depend on how rows are dealt. Words and
their first 4 and 5 bytes, which stand for stems, are hashed; per category the
``vocabulary`` of them with the strongest association with the label are features.
The rarer label value is weighted up. Scoring reads every whole text.

Defined results: a null or empty text is scored by its form alone; a category with
a single label value in the sample gets that value's smoothed share for all texts;
without any labelled row all probabilities are 0. Labels that are null are left
out; repeated label rows count each; a text of any length is read whole; an empty table
gives an empty one. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import texts_of
from docloom.llm.hashing import BYTE_VALUES, Words, blocks, mix, prefix, spans

#: (category, label column, the value that means the category), in chain order.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
SAMPLE_ROWS, VOCABULARY, FOLDS, THRESHOLD = 6_000, 384, 5, 0.5
LEAST_DOCS, BEGINNINGS = 5, (4, 5)

_SPLIT = bytes(c | 0x20 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0x20 for c in range(256))
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
FORM = 4


def _block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash) of each word and each word's beginnings, ascending by text, and the form of each text."""
    words = Words([t.translate(_SPLIT) for t in texts])
    form = np.zeros((len(texts), FORM))
    for k, text in enumerate(texts):
        if text:
            buf = np.frombuffer(text, dtype=np.uint8)
            n = words.first[k + 1] - words.first[k]
            form[k] = (_UPPER[buf].sum() / max(1, _LETTER[buf].sum()), _MARK[buf].mean(), np.log1p(n) / 10, len(np.unique(words.hash[words.first[k] : words.first[k + 1]])) / max(1, n))
    codes = prefix(BYTE_VALUES[words.buf])
    hashes = [words.hash]
    for size in BEGINNINGS:
        hashes.append(mix(spans(codes, words.start, np.minimum(words.end, words.start + size)) + np.uint64(size)))
    return np.repeat(words.doc, len(hashes)), (np.stack(hashes, axis=1).ravel() >> np.uint64(32)).astype(np.uint32), form


@dataclass(frozen=True)
class Model:
    """One link: hashes of its words (sorted), and weights of words, form, earlier probabilities and bias."""

    words: np.ndarray
    weights: np.ndarray

    def probability(self, doc: np.ndarray, word: np.ndarray, form: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        dense = np.column_stack((form, earlier, np.ones(len(form))))
        out = dense @ self.weights[len(self.words) :]
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == word)
            pair = np.unique(doc[hit] * len(self.words) + at[hit])
            np.add.at(out, pair // len(self.words), self.weights[pair % len(self.words)])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 3e-5, rounds: int = 25) -> np.ndarray:
    """Logistic regression by Newton steps, the rarer class weighted up by the root of its rarity, on columns scaled to unit mean square."""
    scale = np.sqrt((x * x).mean(axis=0))
    scale[scale == 0] = 1
    z = x / scale
    share = y.mean()
    weight = np.where(y > 0, share**-0.5, (1 - share) ** -0.5).astype(np.float32)
    weight /= weight.sum()

    def loss(v: np.ndarray) -> float:
        score = z @ v.astype(np.float32)
        return float((weight * (np.logaddexp(0, score) - y * score)).sum() + 0.5 * ridge * (v * v).sum())

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w.astype(np.float32), -30, 30)))
        slope = (weight * (p - y)) @ z + ridge * w
        curve = ((z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z).astype(np.float64) + ridge * np.eye(len(w))
        step, size = np.linalg.solve(curve, slope), 1.0
        while (after := loss(w - size * step)) > now and size > 1e-3:
            size /= 2
        if now - after < 1e-7:
            break
        w, now = w - size * step, after
    return w / scale


def _choose(doc: np.ndarray, word: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """The words most associated with the label, by the z value of the difference of shares; words are distinct within a text."""
    known, place = np.unique(word, return_inverse=True)
    total = np.bincount(place, minlength=len(known))
    inside = np.bincount(place[y[doc] > 0], minlength=len(known))
    del place
    share = (total + 1) / (len(y) + 2)
    pos, neg = max(1.0, y.sum()), max(1.0, len(y) - y.sum())
    z = np.abs(inside / pos - (total - inside) / neg) / np.sqrt(share * (1 - share) * (1 / pos + 1 / neg))
    z[total < LEAST_DOCS] = 0
    best = np.lexsort((known, -z))[:size]
    return np.sort(known[best[z[best] > 3]])


def _train(doc: np.ndarray, word: np.ndarray, form: np.ndarray, earlier: np.ndarray, y: np.ndarray, size: int) -> Model:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2) if len(y) else 1e-13
        weights = np.zeros(form.shape[1] + earlier.shape[1] + 1)
        weights[-1] = np.log(share / (1 - share))
        return Model(np.zeros(0, np.uint32), weights)
    chosen = _choose(doc, word, y, size)
    x = np.zeros((len(y), len(chosen) + form.shape[1] + earlier.shape[1] + 1), dtype=np.float32)
    if len(chosen):
        at = np.minimum(np.searchsorted(chosen, word), len(chosen) - 1)
        hit = chosen[at] == word
        x[doc[hit], at[hit]] = 1
    x[:, len(chosen) :] = np.column_stack((form, earlier, np.ones(len(y))))
    return Model(chosen, _fit(x, y.astype(np.float32)).astype(np.float64))


def fit_chain(doc: np.ndarray, word: np.ndarray, form: np.ndarray, labels: np.ndarray, fold: np.ndarray, size: int = VOCABULARY) -> list[Model]:
    """One model for each column of ``labels``; the out-of-fold probabilities of one feed the next."""
    models: list[Model] = []
    earlier = np.zeros((len(form), 0))
    for c in range(labels.shape[1]):
        y = labels[:, c]
        models.append(_train(doc, word, form, earlier, y, size))
        if c + 1 < labels.shape[1]:
            held = np.full(len(y), y.mean() if len(y) else 0.0)
            for f in range(FOLDS):
                out = fold == f
                if out.any() and (~out).any():
                    renumber = np.cumsum(~out) - 1
                    inside = ~out[doc]
                    model = _train(renumber[doc[inside]], word[inside], form[~out], earlier[~out], y[~out], size)
                    renumber = np.cumsum(out) - 1
                    inside = out[doc]
                    held[out] = model.probability(renumber[doc[inside]], word[inside], form[out], earlier[out])
            earlier = np.column_stack((earlier, held))
    return models


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for texts in blocks(texts_of(batch)):
            doc, word, form = _block(texts)
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            part = batch.slice(done, len(texts))
            done += len(texts)
            words = [np.unique(word[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array(words, pa.binary()), pa.array(list(form), pa.list_(pa.float64()))], names=["doc_id", "y", "words", "form"])


def train(docs: DataFrame, labels: DataFrame, chain: tuple = CHAIN, sample_rows: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> list[Model]:
    """Models of the chain, fitted on the driver from at most ``sample_rows`` rows."""
    y = F.array(*((F.col(column) == F.lit(value)).cast("int") for _, column, value in chain))
    known = labels.where(" AND ".join(f"{column} IS NOT NULL" for _, column, _ in chain)).where("doc_id IS NOT NULL")
    # the order is total but for equal rows, which are alike
    sample = known.select(F.col("doc_id").cast("long").alias("doc_id"), y.alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    found = rows.mapInArrow(_features, "doc_id long, y array<int>, words binary, form array<double>").collect()
    found.sort(key=lambda r: (r["doc_id"], bytes(r["words"])))
    sets = [np.frombuffer(bytes(r["words"]), dtype=np.uint32) for r in found]
    doc = np.repeat(np.arange(len(sets)), np.array([len(s) for s in sets], dtype=np.int64))
    word = np.concatenate(sets) if sets else np.zeros(0, np.uint32)
    form = np.array([r["form"] for r in found]).reshape(-1, FORM)
    y = np.array([r["y"] for r in found], dtype=np.float64).reshape(-1, len(chain))
    # by what a text says, so that equal texts are in one fold whatever their ids
    fold = np.array([xxhash.xxh3_64_intdigest(bytes(r["words"])) % FOLDS for r in found], dtype=np.int64)
    return fit_chain(doc, word, form, y, fold, vocabulary)


def _predict(models: list[Model], names: list[str], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in blocks(texts_of(batch)):
                doc, word, form = _block(texts)
                earlier = np.zeros((len(texts), 0))
                for model in models:
                    earlier = np.column_stack((earlier, model.probability(doc, word, form, earlier)))
                p = earlier
                part = batch.slice(done, len(texts))
                done += len(texts)
                columns = [pa.array(p[:, k]) for k in range(len(models))] + [pa.array(p[:, k] >= threshold) for k in range(len(models))]
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns], names=["row", *(f"p_{n}" for n in names), *names])

    return run


def predict(docs: DataFrame, models: list[Model], chain: tuple = CHAIN, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, p_<category> and <category> for each category, and the columns named in ``carry``."""
    names = [name for name, _, _ in chain]
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry))).alias("row")
    rows = docs.select(row, F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = ", ".join([f"row {kind}", *(f"p_{n} double" for n in names), *(f"{n} boolean" for n in names)])
    done = rows.mapInArrow(_predict(models, names, threshold), schema)
    return done.select("row.doc_id", *(f"p_{n}" for n in names), *names, *(F.col(f"row.c{k}").alias(c) for k, c in enumerate(carry)))


def toxicity(docs: DataFrame, labels: DataFrame, chain: tuple = CHAIN, sample_rows: int = SAMPLE_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fit the chain on labelled documents, then score all documents."""
    return predict(docs, train(docs, labels, chain, sample_rows), chain, carry=carry)
