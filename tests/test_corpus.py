"""Sources, sinks, whole jobs, streaming, command line and the registry."""

import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from docloom import cli
from docloom.operators import cache, encoding, inventory
from docloom.plans import corpus
from docloom.sources import files, tables
from docloom.streaming import ingest


def test_json_blocks():
    value = json.loads('{"title":"T","tags":["x"],"body":["a",1,{"text":"b"},true,null]}')
    assert [(t, x["json_path"]) for t, x in files.json_blocks(value)] == [("title: T", "$.title"), ("body: a", "$.body[0]"), ("body: 1", "$.body[1]"), ("text: b", "$.body[2].text"), ("body: True", "$.body[3]")]
    assert list(files.json_blocks([{"Title": 1.0}, 5])) == [("Title: 1.0", {"json_path": "$[0].Title"})]


def test_csv_blocks():
    assert files.extract_csv("﻿k,v\n1,\n\n2,x".encode())[0] == [("k: 1", {"row_number": 2, "unit_type": "row"}), ("k: 2; v: x", {"row_number": 3, "unit_type": "row"})]


def test_html_blocks():
    html = "<header><p>no</p></header><h1>A <b>b</b></h1><nav><li>x</li></nav><p>one<p>two<ul><li>i<li>j</li></ul><script>p</script><footer>z</footer><div>loose</div><li><p>in</p></li>"
    assert files.html_blocks(html) == [("A b", "paragraph"), ("one", "paragraph"), ("two", "paragraph"), ("i j", "list_item"), ("j", "list_item"), ("in", "list_item"), ("in", "paragraph")]


def test_xlsx_blocks():
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>name</t></si><si><r><t>an</t></r><r><t>a</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>n</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>7</v></c><c r="C2"><v>2.5</v></c></row><row r="4"><c r="C4"><v>3</v></c></row></sheetData></worksheet>')
    assert files.extract_xlsx(out.getvalue())[0] == [("name: ana; n: 2.5", {"sheet": "S", "row_number": 2, "unit_type": "row"}), ("n: 3", {"sheet": "S", "row_number": 4, "unit_type": "row"})]


def _message(*fields):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    return b"".join(varint(n << 3 | (0 if isinstance(v, int) else 2)) + (varint(v) if isinstance(v, int) else varint(len(v)) + v) for n, v in fields)


def test_tile_blocks():
    value = _message((1, "río".encode())), struct.pack("<Bd", 3 << 3 | 1, 1.5), _message((4, 300))
    feature = lambda number, tags: _message((1, number), (2, bytes(tags)))
    layer = _message((1, b"water"), (3, b"name"), (3, b"size"), *((4, v) for v in value), (2, feature(9, [0, 0, 1, 1])), (2, feature(10, [1, 1, 0, 0])), (2, feature(11, [])), (2, feature(300, [1, 2])))
    blocks, facts = files.extract_tile(_message((3, layer)))
    assert [t for t, _ in blocks] == ["layer: water; name: río; size: 1.5", "layer: water; size: 300"]
    assert blocks[1][1]["feature_id"] == 300 and facts == {"pbf_features": 2}


def _pdf(pages, compress):
    """A file of pages of (x, y, text) lines, with one simple font and one mapped two-byte font."""
    cmap = b"/CIDInit /ProcSet findresource begin 1 beginbfrange <0001> <001A> <0061> endbfrange 1 beginbfchar <0020> <00F1> endbfchar end"
    parts = [b"<< /Type /Catalog /Pages 2 0 R >>", None, b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>", b"<< /Type /Font /Subtype /Type0 /ToUnicode 5 0 R >>", _stream(cmap, compress)]
    kids = []
    for lines in pages:
        body = b"".join(b"BT /F%d 10 Tf 1 0 0 1 %d %d Tm %s ET\n" % (1 if isinstance(t, str) else 2, x, y, _shown(t)) for x, y, t in lines)
        parts += [_stream(body, compress), b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (len(parts) + 1)]
        kids.append(len(parts))
    parts[1] = b"<< /Type /Pages /Kids [%s] /Count %d /MediaBox [0 0 600 800] /Resources << /Font << /F1 3 0 R /F2 4 0 R >> >> >>" % (b" ".join(b"%d 0 R" % k for k in kids), len(kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, p) for k, p in enumerate(parts, 1)) + b"%%EOF"


def _stream(body, compress):
    import zlib

    body, kind = (zlib.compress(body), b" /Filter /FlateDecode") if compress else (body, b"")
    return b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(body), kind, body)


def _shown(text):
    if isinstance(text, bytes):
        return b"<%s> Tj" % text.hex().encode()
    return b"[(%s) -300 (%s)] TJ" % tuple(w.encode("cp1252").replace(b"(", b"\\(").replace(b")", b"\\)") for w in text.split(" ", 1))


@pytest.mark.parametrize("compress", [True, False])
def test_pdf_blocks(compress):
    wide = bytes([0, 1, 0, 2, 0, 0x20])
    pages = [[(50, 780, "Page header"), (50, 500, f"Body line{k} (ñ)"), (50, 488, "goes on"), (50, 300, "Far below"), (200, 300, wide)] for k in range(4)]
    blocks, facts = files.EXTRACTORS[".pdf"](_pdf(pages, compress))
    assert [t for t, _ in blocks[:2]] == ["Body line0 (ñ)\ngoes on", "Far below abñ"]
    assert facts == {"page_start": 1, "page_end": 4, "removed_repeated_blocks": 1, "ocr_applied": False}
    assert [x["page_start"] for _, x in blocks] == [1, 1, 2, 2, 3, 3, 4, 4] and blocks[0][1]["block_number"] == 1


def test_ocr_takes_over_only_where_there_is_no_text():
    words = [(1, 1, 2, "b", "90"), (1, 1, 1, "a", "-1"), (1, 2, 1, "low", "10"), (2, 1, 1, "none", "x")]
    run = files.pdf_extractor(pages=lambda c: [(800.0, [])], ocr=lambda c: [words])
    blocks, facts = run(b"")
    assert [(t, x["ocr_confidence"], x["page_start"]) for t, x in blocks] == [("a b", 90.0, 1), ("none", None, 1)] and facts["ocr_applied"]
    assert files.pdf_extractor(pages=lambda c: [(800.0, [(100, 120, "t")])], ocr=lambda c: [words])(b"")[0][0][0] == "t"
    assert files.image_extractor(lambda c: words, 95)(b"")[0] == [("none", {"ocr_engine": "ocr", "unit_type": "ocr_paragraph", "ocr_confidence": None, "ocr_block": 2, "ocr_paragraph": 1})]
    with pytest.raises(RuntimeError):
        files.EXTRACTORS[".png"](b"")


@pytest.fixture
def root(tmp_path):
    words = "Fuerza Aérea desarrolla Drones en Bogotá. El control territorial afecta Colombia. "
    for name, text in {
        "F1_a/uno.txt": words * 9,
        "F2_b/dos.md": "Rusia utiliza Sistemas Satelitales. " * 12,
        "F3_c/tres.json": json.dumps({"title": "Ministerio regula Drones", "body": ["Colombia enfrenta Rusia. " * 9]}),
        "F3_c/cuatro.html": "<p>Colombia protege Bogotá.</p><li>Rusia</li>",
        "F1_a/vacio.txt": "",
        "F1_a/foto.png": "x",
        "F1_a/malo.json": "{",
        "F1_a/con espacio+.csv": "k,v\n1,Drones\n",
        "otros/x.exe": "x",
        "otros/.DS_Store": "x",
    }.items():
        p = tmp_path / "corpus" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")
    return str(tmp_path / "corpus")


def test_audit(spark, root, tmp_path):
    out = corpus.audit(spark, root, str(tmp_path / "r"), str(tmp_path / "m"))
    assert out["total_documentos"] == 9 and out["archivos_vacios"] == ["F1_a/vacio.txt"]
    assert out["por_fenomeno"] == {"1": 5, "2": 1, "3": 2, "pendiente": 1}
    by = {r["ruta_relativa"]: r for r in out["archivos"]}
    assert by["otros/x.exe"]["observaciones"] == f"{inventory.NOTE_FORMAT}; {inventory.NOTE_PHENOMENON}"
    assert by["F1_a/con espacio+.csv"]["indexable"] and not by["F1_a/vacio.txt"]["indexable"]
    assert json.loads((tmp_path / "r/corpus_inventory.json").read_text()) == out
    assert "| .json | 2 |" in (tmp_path / "r/corpus_inventory.md").read_text()


def test_dry_run(spark, root, tmp_path):
    out = corpus.dry_run(spark, root, str(tmp_path / "r"))["summary"]
    assert out["categories"] == {"fenomeno_faltante": 1, "imagen_sin_ocr": 1, "error_extraccion": 1}
    assert out["projected"]["documents_with_chunks"] == 5 and out["projected"]["documents_without_chunks"] == 4


def test_dry_run_lists_and_examples(spark, root, tmp_path):
    long = tmp_path / "corpus" / "F2_z" / "largo.txt"
    long.parent.mkdir(exist_ok=True)
    long.write_text("Una frase corta.\n\n" + "palabra " * 500 + "\n\n" + "Vale " + "x " * 300, encoding="utf-8")
    (long.parent / "vacio.md").write_text(" \n")
    index = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "doc_id string, chunk_id string")
    out = corpus.dry_run(spark, root, str(tmp_path / "r"), index=index, count=lambda t: len(t.split()))
    assert out == json.loads((tmp_path / "r/coverage_dry_run.json").read_text())
    summary, samples = out["summary"], out["examples"]
    assert summary["current_index"] == {"available": True, "chunks": 3, "documents_with_chunks": 2}
    assert summary["files_scanned"] == 11 and summary["projected"]["partially_covered_documents"] == 1
    assert summary["categories"] == {"fenomeno_faltante": 1, "imagen_sin_ocr": 1, "error_extraccion": 1, "oracion_aparentemente_unica_gigante": 1, "mas_de_250_palabras_dentro_de_480_tokens": 1}
    (giant,) = samples["oracion_aparentemente_unica_gigante"]
    assert (giant["fuente"], giant["palabras"], giant["tokens"], giant["vista_previa"]) == ("F2_z/largo.txt", 500, 500, ("palabra " * 500)[:420])
    assert [x["fuente"] for x in samples["fenomeno_faltante"]] == ["otros/x.exe"]
    (partly,) = spark.read.json(out["lists"]["partially_covered_documents"]).collect()
    assert (partly.fuente, partly.valid_units, partly.omitted_units, partly.chunks) == ("F2_z/largo.txt", 2, 1, 1)
    without = spark.read.json(out["lists"]["documents_without_chunks"])
    assert "F2_z/vacio.md" in {r.fuente for r in without.collect()} and without.count() == summary["projected"]["documents_without_chunks"]
    assert "| 500 tokens |" in (tmp_path / "r/coverage_dry_run.md").read_text()


def test_build_and_search(spark, root, tmp_path):
    index, graph = str(tmp_path / "base" / "index"), str(tmp_path / "base" / "grafo" / "grafo.graphml")
    made = corpus.build(spark, root, index, encoding.EmbeddingModel(), graph)
    assert made["chunks"] >= 5 and made["graph"]["edges"] > 0
    nodes, edges = tables.read_graphml(spark, graph)
    assert nodes.where("label = 'drones'").first().entity_type == "concept"
    assert edges.where("relation = 'desarrolla'").count() > 0
    queries = spark.createDataFrame([("q001", None, "", "Drones en Bogotá"), ("q002", "Rusia", "x", None)], "query_id string, query string, text string, consulta string")
    found = corpus.retrieve(spark, queries, index, encoding.EmbeddingModel(), graph, strict=False)
    assert {r.query_id: len(r.documents) for r in found.collect()} == {"q001": 3, "q002": 3}
    with pytest.raises(ValueError, match="model"):
        encoding.open_index(spark, index, encoding.EmbeddingModel(name="other"))
    with pytest.raises(Exception, match="query without text"):
        corpus.retrieve(spark, spark.createDataFrame([("q", "")], "query_id string, query string"), index, encoding.EmbeddingModel(), strict=False).collect()


def test_command_line(spark, root, tmp_path):
    for k in range(12):
        p = tmp_path / "corpus" / "F1_a" / f"extra{k}.txt"
        p.write_text(f"Texto número {k} sobre Drones y Bogotá.", encoding="utf-8")
    index, out = str(tmp_path / "b" / "index"), str(tmp_path / "out")
    cli.main(["build", "--corpus-root", root, "--index-dir", index, "--model", "docloom.operators.encoding:EmbeddingModel", "--batch-size", "5", "--no-fp16", "--cache", str(tmp_path / "b" / "cache")], spark)
    with pytest.raises(RuntimeError, match="cuda"):
        cli.main(["build", "--corpus-root", root, "--index-dir", index, "--device", "cuda"], spark)
    cli.main(["graph", "--index-dir", index, "--output", str(tmp_path / "b" / "grafo" / "grafo.graphml")], spark)
    (tmp_path / "q.jsonl").write_text('{"query_id": "q001", "consulta": "Drones"}\n\n{"query_id": "q002", "query": "Rusia y Colombia"}\n')
    cli.main(["search", "--queries", str(tmp_path / "q.jsonl"), "--index-dir", index, "--output", out], spark)
    rows = spark.read.json(out).collect()
    assert [len(r.fragments) for r in rows] == [10, 10] and [d.rank for d in rows[0].documents] == [1, 2, 3]
    cli.main(["audit", "--corpus-root", root, "--report-dir", str(tmp_path / "r"), "--manifest", str(tmp_path / "m")], spark)
    cli.main(["dry-run", "--corpus-root", root, "--report-dir", str(tmp_path / "r"), "--index-dir", index, "--tokenizer", "docloom.operators.packing:count_words"], spark)
    assert json.loads((tmp_path / "r/coverage_dry_run.json").read_text())["summary"]["current_index"]["available"]


def test_stream_extracts_each_file_once(spark, root, tmp_path):
    cache, state = str(tmp_path / "cache"), str(tmp_path / "state")
    ingest.ingest(spark, root, cache, state).awaitTermination()
    first = spark.read.parquet(cache).count()
    (tmp_path / "corpus" / "F1_a" / "nuevo.txt").write_text("Uno más.")
    ingest.ingest(spark, root, cache, state).awaitTermination()
    assert first == 8  # a stream sees no empty files
    assert spark.read.parquet(cache).count() == first + 1
    ingest.extract_into_cache(ingest_batch(spark, root), cache)
    assert spark.read.parquet(cache).count() == first + 1
    row = spark.read.parquet(cache).where("cache_key = 'F1_a/nuevo.txt'").first()
    assert json.loads(row.payload)[0]["text"] == "Uno más."


def ingest_batch(spark, root):
    from docloom.functions import text as T

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return raw.select(T.relative_path(F.col("path"), root).alias("path"), "content", F.col("length").alias("size"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"))


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("é\n", None, 1)], "a string, b string, c int")
    tables.write_jsonl(rows, str(tmp_path / "x"))
    assert [tuple(r) for r in tables.read_jsonl(spark, str(tmp_path / "x"), "a string, b string, c int").collect()] == [("é\n", None, 1)]
    (tmp_path / "l.txt").write_text("a\n\nb\n")
    assert [tuple(r) for r in tables.read_lines(spark, str(tmp_path / "l.txt"), 1).collect()] == [(1, "a"), (2, ""), (3, "b")]


def test_put_replaces_and_replays(spark, tmp_path):
    held = cache.Cache(str(tmp_path / "held"), ("a", "b"), "a string, b int, v array<float>, w string", 5)
    assert held.read(spark).count() == 0
    frame = lambda rows: spark.createDataFrame(rows, "a string, b int, v array<float>, w string, seq int")
    content = lambda: {(r.a, r.b): (r.v, r.w) for r in held.read(spark).collect()}
    held.put(frame([]))
    held.put(frame([(f"k{k % 50}", k % 3, [float(k)], "old", k) for k in range(400)]), "seq")
    want = {(f"k{k % 50}", k % 3): ([float(k)], "old") for k in range(400)}
    assert content() == want and held.read(spark).count() == len(want)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "held").rglob("part-*")}
    assert len(files) == 5
    one = frame([("k7", 1, None, "new", 9), ("k7", 1, [1.0], "newest", 10), ("other", 0, [], None, 1)])
    for _ in range(2):
        cache.Cache(held.path, held.key, held.schema, 64).put(one, "seq")  # the cache keeps its number of buckets
        assert content() == want | {("k7", 1): ([1.0], "newest"), ("other", 0): ([], None)}
    now = set((tmp_path / "held").rglob("part-*"))
    assert len(now) == 5 and len(now & set(files)) >= 3  # other buckets were left as they are


def test_embedding_through_a_cache(spark, tmp_path):
    held, calls = encoding.embedding_cache(str(tmp_path / "held"), 2), spark.sparkContext.accumulator(0)
    plain = encoding.hashed_ngrams()
    model = encoding.EmbeddingModel(load=lambda device, half: lambda texts: calls.add(len(texts)) or plain(texts))
    texts = spark.createDataFrame([(k, f"text {k % 6}") for k in range(20)], "id int, texto string")
    first = {r.id: r.embedding for r in encoding.embed_through(texts, model, held).collect()}
    assert calls.value == 6
    assert {r.id: r.embedding for r in encoding.embed_through(texts.unionAll(texts.limit(1)), model, held).collect()} == first
    assert calls.value == 6 and held.read(spark).count() == 6


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = [("x" * (k % 90)) + ("\r" if k % 7 == 0 else "") + str(k) for k in range(3000)] + [""]
    (tmp_path / "l.txt").write_bytes("\n".join(lines).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = tables.read_lines(spark, str(tmp_path / "l.txt"), 1)
        assert spark.read.text(str(tmp_path / "l.txt")).rdd.getNumPartitions() > 10
        assert sorted(tuple(r) for r in found.collect()) == [(k + 1, x) for k, x in enumerate(lines[:-1])]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_queries_equal_their_sql(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    from docloom.plans import reference

    con = duckdb.connect()
    for name in "customer orders lineitem events documents embeddings pages benchmark".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    shown = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    for name, sql in reference.ORACLES.items():
        rows = reference.QUERIES[name](spark, sf_dir)
        columns = sorted(rows.columns)
        want = con.sql(sql)
        assert sorted(want.columns) == columns, name
        got = sorted(map(shown, rows.select(*columns).collect()), key=str)
        assert got == sorted(map(shown, want.select(*(f'"{c}"' for c in columns)).fetchall()), key=str), name


@pytest.mark.parametrize("name", ["search_documents", "graph_edges_collapsed", "repeated_line_removal"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, name):
    from docloom.plans import reference

    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, reference.QUERIES[name](spark, sf_dir).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_entry(spark, sf_dir):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
