"""Operators 3, 4, 7 and 9 against plain Python on texts with copies, near copies, shared passages and odd rows."""

import collections
import random
import types

import brute
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from docloom.llm import components, hashing, line_dedup, ngram_join, substring_dedup, suffix_dedup

CLASHING = "doc_id long, text string, did string, tkey int, anchor string, n int, cls string, count int, gone string, row string"
WORDS = "the of and to in la que der und é ñoño straße 日本 x1 don't a,b".split()


def corpus(seed, n=60):
    r = random.Random(seed)
    prose = lambda k: " ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(k))
    passage, base = prose(70), prose(160)
    rows = []
    for i in range(n):
        kind = r.randrange(8)
        if kind == 0:
            text = base
        elif kind == 1:
            w = base.split()
            for _ in range(r.randrange(1, 9)):
                w[r.randrange(len(w))] = "edit" + str(r.randrange(9))
            text = " ".join(w)
        elif kind == 2:
            text = f"{prose(r.randrange(60))} {passage}\n{prose(r.randrange(60))}"
        elif kind == 3:
            text = "\n".join(r.choice(("  A line that Many documents share\t", "a line that many documents share", "short", "", prose(6))) for _ in range(r.randrange(9)))
        elif kind == 4:
            text = prose(r.randrange(4))
        elif kind == 5:
            text = (prose(20) + " ") * 5
        elif kind == 6:
            text = base[: r.randrange(len(base))]
        else:
            text = prose(r.randrange(200))
        rows.append((i * 3 - 20, text))
    return [*rows, (5001, None), (5002, ""), (5003, " \t\n "), (None, base), (None, passage), (rows[0][0], base), rows[1], rows[1], (6000, "x" * 5000), (6001, "x" * 4000 + "\x00y")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "a", 2, "c", 3, "g", "r") for r in rows], CLASHING)


def counted(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    rows = corpus(seed)
    found = ngram_join.ngram_jaccard_components(frame(spark, rows))
    assert counted(found, "doc_id", "n_shingles", "component_id", "n_links") == brute.jaccard(rows)


def test_ngram_join_in_blocks(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 3)
    found = ngram_join.ngram_jaccard_components(frame(spark, rows), n=2, percent=70)
    assert counted(found, "doc_id", "n_shingles", "component_id", "n_links") == brute.jaccard(rows, 2, 70)


def test_overlaps_by_fragments(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 90, size=r.integers(1, 80)).astype(np.uint64)) for _ in range(30)]
    found = ngram_join.overlaps(sets[:12], sets[12:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def _paragraphs():
    r = random.Random(9)
    parts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(300)]
    return [(k, " ".join(r.sample(parts, 5))) for k in range(600)] + [(700, " ".join(parts[:5])), (701, " ".join(parts[:5]) + " end")]


def test_ngram_join_of_shared_paragraphs(spark):
    rows = _paragraphs()
    found = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.ngram_jaccard_components(frame(spark, rows)).collect()}
    assert found == {k: (k, 0) for k in range(600)} | {700: (700, 1), 701: (700, 1)}


def test_fragments_give_up_unlinked_pairs():
    rows = _paragraphs()
    sets = ngram_join._sets([t.encode() for _, t in rows], 4)
    table = pa.table({"x": [0] * len(sets), "y": [0] * len(sets), "block": [0] * len(sets), "node": [d for d, _ in rows], "copies": [1] * len(sets), "n": [len(h) for h in sets], "grams": [h.tobytes() for h in sets]})
    cut = pa.Table.from_batches(list(ngram_join._cut(table.to_batches())))
    parts = [ngram_join._partial(85)(cut.filter(pc.equal(cut["fragment"], k))) for k in range(ngram_join.FRAGMENTS)]
    # of 180,901 pairs, the fragments leave next to none but the one that links
    left = [ngram_join._opened(p["pairs"][0].as_py(), np.int64).cumsum() for p in parts]
    assert all(len(x) <= 20 for x in left)
    assert set.intersection(*(set(x.tolist()) for x in left)) == {600 * 602 + 601}
    links = ngram_join._sum(85)(pa.concat_tables(parts)).to_pylist()
    assert sorted((r["a"], r["b"], r["links"]) for r in links) == [(700, 700, 1), (700, 701, 0), (701, 701, 1)]


def test_partial_counts_add_up():
    r = np.random.default_rng(4)
    pool = r.integers(0, 2**64, size=120, dtype=np.uint64)
    sets = [np.unique(r.choice(pool, size=r.integers(60, 120))) for _ in range(40)]
    edge = np.arange(1, 4, dtype=np.uint64) << np.uint64(62)
    cuts = [np.split(h, np.searchsorted(h, edge)) for h in sets]
    size = np.array([len(h) for h in sets])
    for percent in (1, 50, 80):
        total = np.zeros(1600, dtype=np.int64)
        for k in range(4):
            pairs, counts = ngram_join.partial_counts([c[k] for c in cuts], [c[k] for c in cuts], (size, size), percent, True)
            total[pairs] += counts
        for i in range(40):
            for j in range(i + 1, 40):
                both = len(np.intersect1d(sets[i], sets[j]))
                linked = 100 * both >= percent * (size[i] + size[j] - both)
                assert total[i * 40 + j] <= both and (not linked or total[i * 40 + j] == both)


def test_ngram_join_of_patterned_words_and_long_text(spark):
    order = doubling(1024)
    r = random.Random(6)
    long = " ".join(f"w{r.randrange(9999)}" for _ in range(30_000))
    rows = [(1, "".join("ab"[x] for x in order)), (2, "".join("ab"[1 - x] for x in order)), (3, long), (4, f"{long} more"), (5, long[:80_000])]
    found = ngram_join.ngram_jaccard_components(frame(spark, rows))
    assert counted(found, "doc_id", "n_shingles", "component_id", "n_links") == brute.jaccard(rows)


def test_keep_one_of_each(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "g h i j k"), (4, None), (5, "")]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]


def test_keep_one_of_each_row(spark):
    a, near, b, c = " ".join(map(str, range(100))), " ".join(map(str, range(99))), "g h i j k", "l m n o p"
    rows = [(3, a), (5, a), (5, b), (None, a), (None, c), (None, near), (None, "q r s t u"), (7, None), (7, ""), (9, near)]
    kept = ngram_join.keep_one_of_each(frame(spark, rows))
    assert counted(kept, "doc_id", "text") == collections.Counter([(3, a), (5, b), (None, c), (None, "q r s t u"), (7, None), (7, "")])
    # of near copies without an id, or with the same, one stays
    for key in (None, 4):
        texts = [" ".join(map(str, range(k))) for k in range(97, 101)]
        kept = ngram_join.keep_one_of_each(frame(spark, [*((key, t) for t in texts), (key, b)])).collect()
        assert len(kept) == 2 and b in {r.text for r in kept}


@pytest.mark.parametrize("seed", [1, 4])
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    assert counted(substring_dedup.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring(rows)


def test_substring_dedup_unique_ids(spark):
    rows = list({d: (d, t) for d, t in corpus(8) if d is not None}.values())
    assert counted(substring_dedup.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring(rows)


def doubling(n):
    """0 and 1 in the order that doubles with its opposite."""
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return out[:n]


def test_substring_dedup_of_patterned_texts(spark):
    # sequences whose polynomial hashes modulo 2**64 are equal for any base; no window of 50 words is shared
    order = doubling(2048)
    texts = [" ".join(("aa", "bb")[x ^ y] if k % 2 else f"f{k % 7}" for k, x in enumerate(order)) for y in (0, 1)]
    rows = [(1, texts[0]), (2, texts[1]), (3, " ".join("ab"[x] * 1024 for x in order)), (4, " ".join("ab"[1 - x] * 1024 for x in order))]
    assert counted(substring_dedup.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring(rows)
    words = [bytes(97 + (x ^ y) for x in order) for y in (0, 1)]
    assert len(set(hashing.Words([words[0] + b" " + words[1]]).hash.tolist())) == 2


@pytest.mark.parametrize("window", [2, 3, 7, 20, 33, 64])
def test_substring_dedup_of_other_windows(spark, window):
    r = random.Random(window)
    rows = [(k, " ".join(r.choice("ab") for _ in range(r.randrange(120)))) for k in range(12)] + corpus(2, 20)
    assert counted(substring_dedup.substring_dedup(frame(spark, rows), window), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring(rows, window)


def test_substring_dedup_of_hot_passage_and_long_text(spark):
    r = random.Random(3)
    prose = lambda k: " ".join(f"w{r.randrange(9999)}" for _ in range(k))
    passage, long = prose(120), prose(30_000)
    rows = [(k, f"{prose(r.randrange(40))} {passage} {prose(r.randrange(40))}") for k in range(150)] + [(900, long), (901, f"{prose(5)} {long}"), (902, long[:90_000])]
    assert counted(substring_dedup.substring_dedup(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substring(rows)


def test_levels_double():
    for window in range(2, 200):
        first, longer = substring_dedup.levels(window)
        ladder = [first, *longer, window]
        assert all(a <= b <= 2 * a for a, b in zip(ladder, ladder[1:], strict=False)) and first <= substring_dedup.SHORTEST
    assert substring_dedup.levels(50) == (13, [25])
    # every full window is spoken for by one longer window inside it
    at, first, last = np.array([30, 0, 40]), np.array([0, 0, 35]), np.array([30, 0, 40])
    row, place, a, b = substring_dedup.extended(at, first, last, 13, 25, 50)
    for k in range(3):
        said = sorted((s, p) for i, p, x, y in zip(row, place, a, b, strict=True) if i == k for s in range(x, y + 1))
        assert [s for s, _ in said] == list(range(first[k], last[k] + 1))
        assert all(s <= p <= at[k] and p + 25 <= s + 50 and p + 25 >= at[k] + 13 for s, p in said)


@pytest.mark.parametrize("seed", [1, 5])
def test_line_dedup(spark, seed):
    rows = corpus(seed)
    assert counted(line_dedup.line_dedup(frame(spark, rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.lines(rows)


def test_line_dedup_with_full_filters(spark):
    rows = corpus(6)
    assert counted(line_dedup.line_dedup(frame(spark, rows), bits=1024), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.lines(rows)


def test_filters_follow_the_lines(spark):
    assert [line_dedup.filter_bits(n) for n in (0, 1 << 16, (1 << 16) + 1, 10**7, 10**12)] == [1 << 20, 1 << 20, 1 << 21, 1 << 28, 1 << 31]
    lines = [f"a line of its own number {k}" for k in range(20_000)]
    rows = [(k, "\n".join(lines[k * 100 : k * 100 + 100] + ["a line that two documents have"] * (k < 2))) for k in range(200)]
    text = spark.createDataFrame(rows, "did long, text string").withColumn("tkey", F.lit(0).cast("long")).repartition(7)
    bits = line_dedup.filter_bits(20_200)
    suspects = text.mapInArrow(line_dedup._suspects(20, bits, types.SimpleNamespace(value=line_dedup.twice_seen(text, 20, bits))), "did long, tkey long, key binary").collect()
    assert {r.did for r in suspects if bytes(r.key) == b"a line that two documents have"} == {0, 1}
    assert len(suspects) < 200  # of 20,002


def test_line_dedup_of_hot_line_long_text_and_one_id(spark):
    r = random.Random(4)
    hot = "This line is held by every document of all"
    long = "\n".join(f"line number {r.randrange(30_000)} of many" for _ in range(40_000))
    rows = [(k, f"{hot}\nown words {k}\n{hot.upper()} ") for k in range(200)] + [(500, long), (501, long[:300_000]), (502, long[9_000:]), (503, "y" * 300_000)]
    rows += [(7, f"{hot}\nthe same id, row {k}") for k in range(50)]
    assert counted(line_dedup.line_dedup(frame(spark, rows)), "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.lines(rows)


def test_line_dedup_carries_columns(spark):
    done = line_dedup.line_dedup(frame(spark, corpus(1)), carry=("did", "row", "n"))
    assert {tuple(r) for r in done.select("did", "row", "n").collect()} == {("d", "r", 2)}


@pytest.mark.parametrize("seed", [1, 7])
def test_suffix_dedup(spark, seed):
    rows = corpus(seed)
    assert counted(suffix_dedup.suffix_dedup(frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffixes(rows)


def test_suffix_dedup_unique_ids_short_strings(spark):
    rows = list({d: (d, t) for d, t in corpus(9) if d is not None}.values())
    found = suffix_dedup.suffix_dedup(frame(spark, rows), length=30, gram=9)
    assert counted(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffixes(rows, 30)


def test_suffix_dedup_of_hot_representatives(spark):
    rows = corpus(7)
    assert counted(suffix_dedup.suffix_dedup(frame(spark, rows), hot=2), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffixes(rows)


@pytest.mark.parametrize("at_once", [1, 700, 10**6])
def test_suffix_order_decides(monkeypatch, at_once):
    monkeypatch.setattr(suffix_dedup, "SORTED", at_once)
    # snippets that share their representative at the same distance and little else
    r = random.Random(2)
    parts = [("".join(r.choice("ab") for _ in range(90)) + "x" * 32 + "".join(r.choice("ab") for _ in range(90))).encode() for _ in range(300)]
    parts += [parts[0][:50] + b"c" * 10 + parts[0][60:], b"c" * 30 + parts[7][30:]]
    signs = collections.Counter()
    plain = suffix_dedup.SuffixOrder.compare

    def compare(self, x, y):
        found = plain(self, x, y)
        signs.update(found.tolist())
        return found

    monkeypatch.setattr(suffix_dedup.SuffixOrder, "compare", compare)
    n, length = len(parts), 100
    found = list(suffix_dedup._ranges(length, parts, [[(k, 0, 0)] for k in range(n)], np.zeros(n, int), np.full(n, 90), np.array([len(p) - length + 1 for p in parts])))
    places = collections.Counter(p[k : k + length] for p in parts for k in range(len(p) - length + 1))
    want = {(i, k) for i, p in enumerate(parts) for k in range(len(p) - length + 1) if places[p[k : k + length]] > 1}
    assert {(d, k) for d, _, a, b in found for k in range(a, b + 1)} == want and want
    assert signs[-1] + signs[1] > 20 * signs[0]


def test_suffix_dedup_of_patterned_and_long_texts(spark):
    r = random.Random(5)
    order = doubling(2048)
    long = "".join(r.choice("abcdefgh ") for _ in range(120_000))
    rows = [(1, "".join("ab"[x] for x in order)), (2, "".join("ab"[1 - x] for x in order)), (3, long), (4, "x" * 150 + long[500:1200]), (5, "z" + long[:900])]
    assert counted(suffix_dedup.suffix_dedup(frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffixes(rows)


def test_suffix_mergesort_orders():
    r = np.random.default_rng(1)
    buf = r.integers(97, 99, size=4000).astype(np.uint8)
    order = suffix_dedup.SuffixOrder(buf, 20)
    start = np.arange(3900)
    size = np.array([1, 2, 7, 890, 3000])
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    got = order.mergesort(start, first, size)
    text = lambda s: buf[s : s + 20].tobytes()
    for a, n in zip(first, size, strict=True):
        assert sorted(got[a : a + n]) == list(range(a, a + n))
        assert [text(s) for s in got[a : a + n]] == sorted(text(s) for s in range(a, a + n))


def test_suffix_collisions_are_settled_by_bytes(monkeypatch):
    buf = np.frombuffer(b"abcdabcdabceabcd", dtype=np.uint8)
    order = suffix_dedup.SuffixOrder(buf, 4)
    monkeypatch.setattr(order, "extension", lambda x, y: np.full(len(x), 4))
    start = np.array([0, 4, 8, 12])
    assert order.repeated(start, np.zeros(4, dtype=np.uint64)).tolist() == [True, True, False, True]


@pytest.mark.parametrize("run", [ngram_join.ngram_jaccard_components, substring_dedup.substring_dedup, line_dedup.line_dedup, suffix_dedup.suffix_dedup])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)] + [(7, 7), (200, 201), (201, 200)]
    found = {x.node: x.label for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert found == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_spans_do_not_depend_on_place():
    texts = [b"one two three", b"zero one two three four", "ñ two three".encode()]
    words = hashing.Words(texts)
    assert words.hash[:3].tolist() == words.hash[4:7].tolist()
    two, inside = words.grams(2)
    assert inside.tolist() == [True, True, False, True, True, True, True, False, True, True]
    assert two[1] == two[5] == two[9]


@pytest.mark.parametrize("module, find, plain", [(substring_dedup, substring_dedup.substring_dedup, brute.substring), (suffix_dedup, suffix_dedup.suffix_dedup, brute.suffixes)])
def test_rows_that_repeat_many_times_are_worked_on_once(spark, monkeypatch, module, find, plain):
    r = random.Random(4)
    prose = lambda k: " ".join(f"{r.choice(WORDS)}{r.randrange(10**6)}" for _ in range(k))
    passage = prose(120)
    seen = []
    beside = module._beside
    monkeypatch.setattr(module, "_beside", lambda text, runs, *columns: seen.append(runs.count()) or beside(text, runs, *columns))
    made = {}
    for times in (1, 1000):
        rows = [(7, f"{prose(30)} {passage} {prose(10)}")] * times + [(9, f"{prose(20)} {passage}"), (None, f"{passage} {prose(5)}"), (3, prose(40))]
        seen.clear()
        found = find(frame(spark, rows))
        assert counted(found, *[c for c in found.columns if c != "kept"]) == plain(rows)
        made[times] = list(seen)
    assert max(made[1000]) <= max(made[1]) + 1
