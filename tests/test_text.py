"""Text functions and packing, on rows whose results follow from the rules by hand."""

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators import coverage, packing


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_clean_text(spark):
    assert one(spark, T.clean_text, "a\x00b \t c\n \n\n d ") == "a b c\n\n d"
    assert one(spark, T.clean_text, None) == ""
    assert one(spark, T.clean_text, "  x\ry ") == "x\ry"


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("Hola «mundo.» Qué tal? ¿Bien? No. fin. A. B.", ["Hola «mundo.»", "Qué tal?", "¿Bien?", "No. fin.", "A.", "B."]),
        ("", []),
        (None, []),
        ("- uno\n  sigue\n- dos", ["- uno sigue", "- dos"]),
        ("a: 1; b: 2; c: 3", ["a: 1; b: 2; c: 3"]),
        ("Intro\n- uno", ["Intro\n- uno"]),
        ("First one. Second one.\n\n1) x\n2) y", ["First one.", "Second one.", "1) x", "2) y"]),
        ("A. Foo bar\nmore", ["A. Foo bar more"]),
    ],
)
def test_sentences(spark, text, parts):
    assert one(spark, T.sentences, text) == parts


def test_list_units_need_a_marker_first(spark):
    assert one(spark, T.list_units, "plain\n- x") is None
    assert one(spark, T.list_units, "plain") is None
    assert one(spark, T.list_units, "• x\r\ny\n(3) z") == ["• x y", "(3) z"]


@pytest.mark.parametrize(("text", "language"), [("the cat and the dog", "en"), ("el perro", "und"), ("de para", "es"), ("não também", "pt"), (None, "und"), ("THE AND", "en")])
def test_detect_language(spark, text, language):
    assert one(spark, T.detect_language, text) == language


def test_identity(spark):
    assert one(spark, T.stable_doc_id, "a/b.txt") == "DOC-5550000D3B1CF1FF"
    assert one(spark, T.phenomenon, "F2_x/a.pdf") == 2
    assert one(spark, T.phenomenon, "x/f1_a.pdf") is None
    assert [one(spark, T.extension, x) for x in ("a/b.TXT", "a.b/c", ".hidden", "x.tar.gz")] == [".txt", "", "", ".gz"]
    assert one(spark, lambda c: T.relative_path(c, "/data/in"), "file:/data/in/a/b c.txt") == "a/b c.txt"
    assert one(spark, lambda c: T.relative_path(c, "hdfs://host/data"), "hdfs://host/data/x%20y+z.txt") == "x y+z.txt"
    assert one(spark, lambda c: T.preview(c, 5), " a \n b  cdef") == "a b c"
    assert one(spark, T.word_count, " a b  c\n") == 3


def test_key_values(spark):
    row = spark.createDataFrame([("v", None, "", 3)], "a string, b string, c string, d int")
    assert row.select(T.key_values({k: F.col(k) for k in "abcd"}).alias("y")).first().y == "a: v; d: 3"


def test_next_fit(spark):
    units = [" ".join("w" * n) for n in (100, 200, 100, 300, 50)]
    assert [c[3] for c in packing.pack_units(units)] == [2, 1, 2]
    frame = spark.createDataFrame([(units,)], "u array<string>")
    both = frame.select(packing.pack(F.col("u")).alias("a"), packing.pack_fold(F.col("u")).alias("b")).first()
    assert [c.text for c in both.a] == [c.text for c in both.b]
    assert [c.units for c in both.b] == [2, 1, 2]


def test_max_words_and_oversize():
    assert [c[3] for c in packing.pack_units(["a b", "c d", "e"], max_words=4)] == [2, 1]
    with pytest.raises(ValueError):
        packing.pack_units([" ".join("w" * 481)])
    with pytest.raises(ValueError):
        packing.pack_units(["a b c"], max_words=2)
    assert packing.pack_units([" ".join("w" * 481), "x"], on_oversize="skip") == [("x", 1, 1, 1)]
    item = "- " + " ".join(["Aa"] * 300) + ". " + " ".join(["Bb"] * 300) + "."
    assert [c[1] for c in packing.pack_units([item])] == [301, 300]
    row = "; ".join(f"k{k}: " + " ".join("v" * 100) for k in range(6))
    assert [c[1] for c in packing.pack_units([row])] == [404, 202]
    assert packing.pack_units([row], on_oversize="drop") == []


def test_presentation(spark):
    s = lambda n: " ".join(["Word"] * n)
    frame = spark.createDataFrame([([s(200), s(100)],), ([s(200), s(251)],), ([],)], "u array<string>")
    assert [None if r.y is None else len(r.y) for r in frame.select(packing.presentation_texts(F.col("u")).alias("y")).collect()] == [2, None, 0]


def test_fold_and_arrow_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    units = T.sentences(F.col("text"))
    for limit in (None, 100):
        a, b = packing.pack(units, max_words=limit, on_oversize="drop"), packing.pack_fold(units, max_words=limit)
        assert docs.where(F.transform(a, lambda c: c["text"]) != F.transform(b, lambda c: c["text"])).count() == 0


def test_sentences_keep_all_characters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = lambda c: F.regexp_replace(c, r"(?U)\s", "")
    assert docs.where(plain(F.array_join(T.sentences(F.col("text")), "")) != plain(T.clean_text(F.col("text")))).count() == 0


def test_coverage(spark):
    long = " ".join(["w"] * 500)
    rows = [("a", 0, "Short one. " + "X" * 3, ".txt"), ("a", 1, long, ".csv"), ("b", 0, long, ".txt"), ("c", 0, "  ", ".txt"), ("d", 0, " ".join(["w"] * 300), ".txt")]
    blocks = spark.createDataFrame(rows, "doc_id string, block_no int, text string, extension string")
    found = coverage.units(blocks)
    assert {r.category: r.n for r in coverage.categories(found).collect()} == {
        "lista_o_tabla_texto_plano": 1, "oracion_aparentemente_unica_gigante": 1, "pagina_o_archivo_sin_texto": 1, "mas_de_250_palabras_dentro_de_480_tokens": 1,
    }
    assert tuple(coverage.summary(blocks).first()) == (2, 2, 1, 2)
    files = spark.createDataFrame([("x/a.txt", False), ("f1_x/a.exe", False), ("f1_x/a.png", False), ("f1_x/a.txt", True), ("f1_x/b.txt", False)], "path string, failed boolean")
    assert {r.path: r.category for r in coverage.file_category(files).collect()} == {"x/a.txt": "fenomeno_faltante", "f1_x/a.exe": "formato_no_soportado", "f1_x/a.png": "imagen_sin_ocr", "f1_x/a.txt": "error_extraccion"}


def test_packing_accounts_for_every_word(spark, sf_dir):
    from docloom.plans import reference

    docs = {r.doc_id: list(r.u) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", T.sentences(F.col("text")).alias("u")).collect()}
    for name, limit in (("chunk_pack_split", None), ("chunk_pack_split_max_words", 120)):
        words = dict.fromkeys(docs, 0)
        over = set()
        for r in reference.QUERIES[name](spark, sf_dir).collect():
            words[r.doc_id] += len(r.text.split())
            if r.kind == "oversize":
                over.add((r.doc_id, r.place, r.text, r.tokens))
            else:
                assert r.tokens <= 480
        assert words == {d: sum(len(x.split()) for x in u) for d, u in docs.items()}
        assert over and all(docs[d][k] == x and n == len(x.split()) > (limit or 480) for d, k, x, n in over)


def test_what_cannot_be_split_is_told(spark):
    giant, item = " ".join("w" * 481), "- " + " ".join(["Aa"] * 300) + ". " + " ".join(["Bb"] * 300) + "."
    row = "; ".join(f"k{k}: " + " ".join("v" * 100) for k in range(6))
    assert packing.left_out_units(["x", giant, item, row]) == [(1, giant, 481)]
    assert packing.left_out_units(["a b", "a b c"], max_words=2) == [(1, "a b c", 3)]
    docs = spark.createDataFrame([(1, f"Short one. {giant}"), (2, None), (3, item)], "doc_id long, text string")
    assert [(r.doc_id, r.tokens) for r in packing.oversize_units(docs).collect()] == [("1", 483)]
    assert [r.num_tokens for r in packing.chunk_documents(docs).where("doc_id = '3'").orderBy("posicion").collect()] == [301, 300]
