"""Operators 11 to 13 against plain Python and the library."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from docloom.llm import collocations, fill_in_middle, token_counts

CLASHING = "doc_id long, text string, lang string, n int, form string, output string, phrase string, rank int, k string, w1 string, word string, n_tokens string, slice string, a string, score string"
LOWER = {k: k + 32 for k in range(65, 91)}


def frame(spark, rows):
    """Rows of (doc_id, text, lang) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "f", "o", "p", 2, "k", "w", "x", "t", "s", "a", "c") for r in rows], CLASHING)


# --- phrases


def mined(rows, least, top, inside=80):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = collections.Counter()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        rows_ = []
        for p, a in candidates.items():
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * longer[p] < inside * a:
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out[lang, rank, phrase.decode(), -a, left, right, totals[lang], -score] += 1
    return out


def phrase_rows(seed, n=250):
    r = random.Random(seed)
    words = "The of And ñoño in la que 日本 der x's und É to a-b".split() + ["w" * 40]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randrange(12)):
            parts.append(r.choice(("on the other hand", "New York City", "la la la la la", "x", " ".join(r.choice(words) for _ in range(r.randrange(9))))))
            parts.append(r.choice((" ", "  ", "\t", ". ", ", ", "\n", ": ", "\r\n", "!")))
        rows.append((i, "".join(parts), r.choice(("en", "es", None, ""))))
    return [*rows, (None, "New York City", "en"), (1, None, "en"), (2, "", "fr"), (3, " \t.,", "de"), rows[0], rows[0], (9, "one two three four five " * 300, "en")]


def phrase_counts(df):
    return collections.Counter(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, top, at_once, bits", [(12, 2000, 1 << 20, 1 << 30), (5, 7, 40, 1 << 30), (3, 60, 1 << 20, 1 << 4)])
def test_collocations(spark, monkeypatch, least, top, at_once, bits):
    monkeypatch.setattr(collocations, "KEYS_AT_ONCE", at_once)
    monkeypatch.setattr(collocations, "MOST_BITS", bits)
    monkeypatch.setattr(collocations, "PART_BITS", 10)
    rows = phrase_rows(least)
    want = mined(rows, least, top)
    assert len(want) > 10
    assert phrase_counts(collocations.collocations(frame(spark, rows).repartition(7), least, top)) == want


def test_collocations_of_few_and_none(spark):
    assert collocations.collocations(frame(spark, [(1, None, None)])).count() == 0
    assert collocations.collocations(frame(spark, [(1, "a b", "en")]).where("doc_id > 1")).count() == 0
    # ties of score and count go by the bytes of the phrase, and the first of tied cuts counts
    rows = [(k, "é f. z y. a b. p q r", "en") for k in range(30)]
    assert phrase_counts(collocations.collocations(frame(spark, rows), top=3)) == mined(rows, 30, 3)


def reports_of_pairs(spark, rows, partitions, everywhere=False):
    """The rows that tasks report, and the different pairs among them."""
    docs = frame(spark, rows).select("lang", "text").repartition(partitions)
    words, totals, n, seed = collocations._frequent_words(docs, 30)
    filters = [collocations._filter(words.mapInArrow(collocations._word_keys, "x long"), n)]
    heavy = collocations._heavy_buckets(docs, (2,), filters, seed, totals, 30)
    reports = collocations._reports(docs, (2,), filters, heavy, seed, everywhere)
    return reports.count(), collocations._candidates(reports, heavy).count()


def test_a_phrase_is_reported_by_one_task_however_many_hold_it(spark):
    rows = [(k, " ".join(f"a{j} b{j}." for j in range(300)), "en") for k in range(90)]
    assert reports_of_pairs(spark, rows, 30, everywhere=True) == (9000, 300)
    for partitions in (6, 30):
        made, different = reports_of_pairs(spark, rows, partitions)
        assert different == 300 <= made <= 600  # a filter lets some more through


def test_phrases_that_no_task_reported_are_found_missing(spark, monkeypatch):
    rows, tried, reports = phrase_rows(5), [], collocations._reports

    def some_lost(docs, lengths, filters, heavy, seed, everywhere):
        tried.append((lengths, everywhere))
        found = reports(docs, lengths, filters, heavy, seed, everywhere)
        return found if everywhere else found.where(f"pmod(xxhash64(x), 9) > 0 or {lengths[0]} <> {lost}")

    monkeypatch.setattr(collocations, "_reports", some_lost)
    for lost in (2, 3):
        tried.clear()
        assert phrase_counts(collocations.collocations(frame(spark, rows).repartition(7), 5, 300)) == mined(rows, 5, 300)
        assert [x for _, x in tried] == [False, False, True, True]


def test_scores_are_exact_where_products_pass_64_bits(spark):
    big = 5 * 10**13 + 1
    row = spark.createDataFrame([(2, big, big + 1, big + 3)], "k int, a long, l1 long, r1 long")
    assert row.select(collocations._score(1)["score"]).first()[0] == 2_000_000 * big // (2 * big + 4)


def test_perfect_hash_is_minimal_and_verified():
    r = np.random.default_rng(1)
    x = np.unique(r.integers(0, 2**63, 50_000).astype(np.uint64))
    hashed = collocations.PerfectHash(x)
    assert sorted(hashed.slots(x).tolist()) == list(range(len(x)))
    key = [np.concatenate((x, x)), np.concatenate((np.zeros_like(x), x[::-1])), np.zeros(2 * len(x), np.uint64), np.zeros(2 * len(x), np.uint64)]
    slots = collocations.Slots(np.repeat([1, 2], len(x)), key)
    both = np.concatenate((slots.find([x]), slots.find([x, x[::-1]])))
    assert sorted(both.tolist()) == list(range(2 * len(x)))
    others = np.setdiff1d(r.integers(0, 2**63, 50_000).astype(np.uint64), x)
    assert (slots.find([others]) == -1).all()
    assert (slots.find([x, x]) >= 0).sum() == (x == x[::-1]).sum()


def test_packed_sums_round_trip():
    r = np.random.default_rng(2)
    x = np.unique(r.integers(0, 2**48, 5000).astype(np.uint64))
    n = r.integers(1, 2**40, len(x))
    packed = collocations.packed_sums(x, n)
    back = collocations.unpacked_sums(packed)
    assert (back[0] == x).all() and (back[1] == n).all()


def test_words_that_share_a_number_are_told_apart():
    a = np.array([5, 5, 7], dtype=np.uint64)
    at, n = collocations._counted([a, np.array([1, 2, 1], dtype=np.uint64)])
    assert n.tolist() == [1, 1, 1]
    collide = [np.array([1, 1, 2], dtype=np.uint64), np.array([4, 4, 4], dtype=np.uint64)]
    assert sorted(collocations._counted(collide)[1].tolist()) == [1, 2]


# --- tokens


def model():
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)


def strange_texts(n, seed=3):
    r = random.Random(seed)
    alphabet = "ab  \t\n▁étñ日本語🙂ﬁ\x00<s></s><0x41>xyzABC0123.,aaaa"
    every = lambda: chr(r.choice((r.randrange(32, 127), r.randrange(0x80, 0xD800), r.randrange(0xE000, 0x11000))))
    some = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(n)] + ["".join(every() for _ in range(r.randrange(30))) for _ in range(n)]
    letters = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6000))
    return [*some, "", " ", "▁", "▁▁ ▁", "<s>", "<unk>", "</s>hi", "a" * 5001, "ab" * 3000, " " * 1000, letters, "the cat sat. " * 20_000]


def test_counter_gives_the_librarys_counts():
    counter = token_counts.Counter(model().serialized_model_proto())
    texts = strange_texts(3000)
    assert counter.count(texts).tolist() == [len(x) for x in model().encode(texts)]


def test_merges_of_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(token_counts, "spans", lambda p, start, end: np.zeros(len(start), dtype=np.uint64))
    texts = ["the cat", "sat on", "the mat", "a"]
    assert token_counts.Counter(model().serialized_model_proto()).count(texts).tolist() == [len(x) for x in model().encode(texts)]


def test_token_counts(spark):
    texts = [None, *strange_texts(40)]
    rows = [(None if k % 9 == 0 else k % 60, t, "en") for k, t in enumerate(texts)]
    want = collections.Counter((d, len((t or "").encode()), n := len(model().encode(t or "")), n > 30) for d, t, _ in rows)
    found = token_counts.token_counts(frame(spark, rows), most=30)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert collections.Counter(tuple(r) for r in found.collect()) == want
    assert token_counts.token_counts(frame(spark, rows).limit(0)).count() == 0


def test_token_counts_of_the_test_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()}
    assert found == {r.doc_id: len(model().encode(r.text or "")) for r in docs.collect()}


# --- fill in middle


def transformed(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def middle_rows():
    r = random.Random(5)
    alphabet = ["a", "B", "é", "日", "🙂", " ", "\t", "\n", "\x0b", "\r", "\x1c", " ", "<", ">", "P", "<M", "S>", "\x00"]
    rows = [(k, "".join(r.choice(alphabet) for _ in range(r.randrange(40))), "en") for k in range(400)]
    return [*rows, *((k, f"x {m} y", "en") for k, m in enumerate(("<P>", "<S>", "<M>") * 4)), (None, "one two three", None), (5, None, "en"), (6, "", "en"), (7, "  \n ", "en"), rows[3], rows[3], (8, "word " * 100_000, "en")]


def test_fill_in_middle(spark):
    rows = middle_rows()
    done = fill_in_middle.fill_in_middle(frame(spark, rows), carry=("lang", "phrase")).withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form")))
    found = collections.Counter(tuple(r) for r in done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back", "lang", "phrase").collect())
    assert found == collections.Counter((*transformed(d, t), t or "", lang, "p") for d, t, lang in rows)
    assert {f for _, _, f, *_ in found} == {"plain", "spm", "psm"}
    assert fill_in_middle.fill_in_middle(frame(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError, match="form"):
        fill_in_middle.fill_in_middle(frame(spark, rows), carry=("form",))


def test_bytes_that_are_not_text_stay(spark):
    rows = spark.sql("select id as doc_id, cast(unhex('C3A920FF20EDA08020C3') as string) as text from range(50)")
    done = fill_in_middle.fill_in_middle(rows)
    back = done.select("n", "form", F.hex(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("hex")).distinct().collect()
    assert {r.hex for r in back} == {"C3A920FF20EDA08020C3"}
    assert {r.n for r in back} == {4}
    assert len({r.form for r in back}) == 3


def test_digests(spark):
    row = fill_in_middle.digests(fill_in_middle.fill_in_middle(frame(spark, middle_rows()[:40])))
    assert row.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = {(d, hashlib.sha256(transformed(d, t)[-1].encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for d, t, _ in middle_rows()[:40]}
    assert {(r.doc_id, r.output_sha256, r.restored_sha256) for r in row.collect()} == want
