"""Text functions, layout operators, file readers and streams on invented inputs."""

import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from attestra.functions import text as tx
from attestra.operators import layout, search
from attestra.sources import files


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


def test_text_functions(spark):
    assert one(spark, tx.plain, "Ñandú  Nº 5 漢") == "nandu  no 5 "
    assert one(spark, tx.squeeze, "​ a  b\t\n c ") == "a b c"
    assert one(spark, tx.label_key, " Nombre (del) Curso: ") == "nombre del curso"
    assert one(spark, tx.first_int, "dura 12 semanas") == 12 and one(spark, tx.first_int, "none") is None
    assert one(spark, tx.roman, " iv ") == 4 and one(spark, tx.ordinal, "Séptimo") == 7 and one(spark, tx.safe_double, "x") is None
    assert one(spark, tx.json_or_null, [], "array<string>") is None
    assert one(spark, lambda c: tx.clean_page(c), "a  b\nvisit www.ucundinamarca.edu.co now\n\n \n\nc www.site.co") == "a b\nvisit \nc www.site.co"
    assert [tuple(x) for x in one(spark, tx.pages, "one\ftwo\n\f")] == [(1, "one"), (2, "two\n")]
    lines = ["La Universidad de Algo", "12 34 % de", "Nueva información útil", "texto CONOCIDO", "abc", "Vigilada por alguien", "ver www.site.co"]
    got = spark.createDataFrame([(lines, "texto conocido")], "l array<string>, k string").select(tx.novel_lines(F.col("l"), F.col("k")).alias("y")).first().y
    assert got == ["Nueva información útil"]
    assert one(spark, tx.hide_in_cells, [["Clave: s3cret", "b"]], "array<array<string>>") == [["Clave: [omitido]", "b"]]


def test_layout(spark):
    words = spark.createDataFrame([("d", 1, x, y, x + 20.0, y + 10.0, t) for x, y, t in [(10.0, 10.0, "Nombre"), (100.0, 11.0, "Ana"), (10.0, 30.0, "Tipo"), (33.0, 30.5, "de"), (100.0, 30.0, "Libre"), (10.0, 50.0, "Fin")]], "doc string, p int, x0 double, y0 double, x1 double, y1 double, t string")
    lines = layout.visual_lines(words)
    assert {r.t: r.line for r in lines.collect()} == {"Nombre": 0, "Ana": 0, "Tipo": 1, "de": 1, "Libre": 1, "Fin": 2}
    segs = layout.segments(lines, layout.column_starts(lines, 2))
    assert sorted(r.t for r in segs.collect()) == ["Ana", "Fin", "Libre", "Nombre", "Tipo de"]
    assert layout.cells(segs).count() == 5
    pairs = layout.value_to_the_right(segs.where("x0 > 50"), segs.where("x0 < 50"), ["doc", "p"])
    assert {(r.label, r.value) for r in pairs.collect()} == {("Nombre", "Ana"), ("Tipo de", "Libre")}
    blocks = spark.createDataFrame([("d", 0, "x", ""), ("d", 1, "One", "1"), ("d", 2, "text", None), ("d", 3, "One", "1"), ("d", 4, "Intro", "")], "d string, o int, text string, n string")
    got = layout.sections(blocks, ["d"], "o", F.col("n").isNotNull() & (F.col("o") > 0), F.coalesce("n", F.lit("")), F.col("text"), "DM25")
    assert [r.code for r in got.orderBy("section").collect()] == ["DM25-1", "DM25-1-2", "DM25-INTRO"]
    filled = layout.fill_down(spark.createDataFrame([("k", 1, "P1"), ("k", 2, " "), ("k", 3, "P2"), ("k", 4, None)], "k string, o int, p string"), ["k"], "o", ["p"])
    assert [r.p for r in filled.orderBy("o").collect()] == ["P1", "P1", "P2", "P2"]
    events = spark.createDataFrame([("k", 1, "title", "A"), ("k", 2, "f", "x"), ("k", 3, "f", "y"), ("k", 4, "f", "x"), ("k", 5, "title", "B")], "k string, o int, f string, t string")
    assert [r.fields for r in layout.fold_records(events, ["k"], "o", F.col("f") == "title", "f", "t").orderBy("record").collect()] == [{"f": "x y", "title": "A"}, {"title": "B"}]
    table = spark.createDataFrame([("p", x, 1.0, t) for x, t in [(10.0, "a"), (12.0, "b"), (80.0, "c")]], "k string, x0 double, y0 double, t string")
    assert {r.t: r.header for r in layout.table_by_header(table, ["H1", "H2"], ["k"]).collect()} == {"a": "H1", "b": "H1", "c": "H2"}


def test_search(spark):
    df = spark.createDataFrame([(k, f"100% {k}", "a" if k < 60 else "b") for k in range(120)], "k int, t string, g string")
    assert search.matches(df, {"g": "a", "k": None}, "100%", ["t"]).count() == 60 and search.matches(df, text="1_0", text_cols=["t"]).count() == 0
    assert [r.k for r in search.page(df, ["k"], 3).collect()] == list(range(100, 120)) and search.pages(120) == 3
    assert one(spark, lambda c: search.highlight(c, "ana"), "Banana") == "B<mark>ana</mark>na"


def glb():
    g = {"asset": {"generator": "x" * 80}, "accessors": [{"count": 3, "min": [0, 0, 0], "max": [1, 2, 0]}, {"count": 3}], "meshes": [{"primitives": [{"attributes": {"POSITION": 0}, "indices": 1}]}]}
    body = json.dumps(g).encode()
    return struct.pack("<4sII", b"glTF", 2, 20 + len(body)) + struct.pack("<I4s", len(body), b"JSON") + body


def jpeg(w, h):
    tags = struct.pack("<HHII", 0x0110, 2, 4, int.from_bytes(b"Cam\0", "little"))
    exif = b"Exif\0\0" + b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + tags
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, h, w, 3) + bytes(9)


def mp4():
    box = lambda kind, body: struct.pack(">I4s", 8 + len(body), kind) + body
    head = box(b"mvhd", bytes(12) + struct.pack(">II", 1000, 2500) + bytes(80))
    track = box(b"trak", box(b"tkhd", bytes(76) + struct.pack(">II", 1920 << 16, 1080 << 16)))
    return box(b"ftyp", b"isom") + box(b"moov", head + track)


def office(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


R = 'xmlns:r="urn:r"'
REL = lambda *t: "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="{x}"/>' for k, x in enumerate(t)) + "</Relationships>"
XLSX = {"xl/workbook.xml": f'<w {R}><sheets><sheet name="S" r:id="r0"/></sheets></w>', "xl/_rels/workbook.xml.rels": REL("worksheets/s.xml"), "xl/sharedStrings.xml": "<s><si><t>he</t><t>llo</t></si></s>", "xl/worksheets/s.xml": '<w><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row><c r="B2" t="inlineStr"><is><t>in</t></is></c></row></w>'}
CHART = '<c><chart><title><t>T</t></title><plotArea><barChart><ser><tx><v>N</v></tx><cat><lvl><pt idx="0"><v>a</v></pt><pt idx="1"><v>b</v></pt></lvl><lvl><pt idx="0"><v>Y</v></pt></lvl></cat><val><pt idx="0"><v>1.5</v></pt><pt idx="1"><v>bad</v></pt></val></ser></barChart></plotArea></chart></c>'
PPTX = {"ppt/presentation.xml": f'<p {R}><sldId r:id="r1"/><sldId r:id="r0"/></p>', "ppt/_rels/presentation.xml.rels": REL("slides/s1.xml", "slides/s2.xml"), "ppt/slides/s1.xml": "<s><p><t>One</t></p><tbl><tr><tc><p><t>c</t></p></tc></tr></tbl></s>", "ppt/slides/s2.xml": '<s show="0"><p><t>Two</t></p></s>', "ppt/slides/_rels/s1.xml.rels": REL("../charts/chart1.xml"), "ppt/charts/chart1.xml": CHART}


def test_readers():
    g = files.read_glb(glb())
    assert (g["vertices"], g["triangles"], g["dims"], len(g["generator"])) == (3, 1, [1, 2, 0], 60)
    j = files.read_jpeg(jpeg(6016, 3008))
    assert (j["width"], j["height"], j["equirectangular"], j["model"]) == (6016, 3008, True, "Cam") and not files.read_jpeg(jpeg(100, 80))["equirectangular"]
    assert files.read_mp4(mp4()) == {"seconds": 2.5, "width": 1920, "height": 1080}
    assert files.read_xlsx(office(XLSX)) == {"S": [["hello", "", "5"], ["", "in"]]}
    hidden, shown = files.read_pptx(office(PPTX))
    assert hidden["oculta"] and shown["texto"].startswith("One") and shown["tablas"] == [[["c"]]]
    assert shown["graficas"] == [{"titulo": "T", "tipo": "barChart", "series": [{"nombre": "N", "puntos": [("Y / a", 1.5)]}]}]


def test_files(spark, tmp_path):
    for name, data in {"Factor 5. Algo.pdf": b"x", "Factor 5. Algo.pptx": office(PPTX), "2. Rector.pptx": office(PPTX), "HV Ana.pdf": b"x", "~$a.pdf": b"", "bad.glb": b"zz", "m.glb": glb(), "Anexo 46/a.bin": b"1", "Anexo 46/b.bin": b"1", "Anexo 46/c.bin": b"2", "Anexo 21/z.bin": b"3"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    found = files.sources(files.listing(spark, str(tmp_path))).collect()
    assert [(r.codigo, r.factor, r.nombre, bool(r.pdf), bool(r.pptx), r.sede) for r in found] == [("F05", 5, "Factor 5. Algo", True, True, "Programa"), ("S02", None, "Rector", False, True, "Institución")]
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    assert [r.codigo for r in files.annex_codes(raw.where("path LIKE '%.bin'").select("path", "content")).orderBy("codigo").collect()] == ["AX-46-01", "AX-46-02"]
    read = files.read_files(raw.where("path LIKE '%.glb'")).cache()
    assert {bool(r.result): bool(r.error) for r in read.collect()} == {True: False, False: True}
    assert files.read_files(raw.where("path LIKE '%.glb'"), {}, read).where("result IS NOT NULL").count() == 1
    assert "1 modelos" in files.asset_summary(read).first().texto


def test_streams(spark, tmp_path):
    from attestra.streaming import incremental

    rows = spark.createDataFrame([("k", "2024-01-01 00:10:00", "a"), ("k", "2024-01-01 00:50:00", "b"), ("j", "2024-01-01 03:00:00", "a")], "k string, t string, kind string").withColumn("t", F.to_timestamp("t"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = incremental.windowed_counts(stream, "t", "kind").writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counted").count() == 3
    stored = {}
    ev = "codigo string, titulo string, tipo string, texto string, texto_ocr string, fuente string, archivo string, pagina int, sede string, proceso string, nivel string"
    load = spark.createDataFrame([("A", "t", *[None] * 5, 1, None, None, None)], ev)
    load.write.parquet(str(tmp_path / "ev"))

    def write(evidence, actions):
        stored["rows"], stored["actions"] = evidence.collect(), [r.action for r in actions.collect()]

    empty = spark.createDataFrame([], ev + ", estado_revision string")
    incremental.load_stream(spark.readStream.schema(load.schema).parquet(str(tmp_path / "ev")), lambda: empty, write, str(tmp_path / "cp2")).awaitTermination()
    assert stored["actions"] == ["insert"] and stored["rows"][0].estado_revision == "sin_revisar"
