"""Tagged documents and forms; all texts are invented."""

import pytest
from pyspark.sql import functions as F

from attestra.operators import activities, forms, records, tagged

STRUCT = """Document
  /Lang (es)
  TOC
    TOCI
      "4.1 Contents line"
  Figure
    "picture"
  P
    "Front words"
  H1
    "4. First part"
    /BBox [1 2 3 4]
  P
    "One "
    Span
      "two"
    "later"
  P
    "Tabla 1. Credits"
  Table
    /Placement Block
    TR
      TH
        P
          "Course"
      TH
        "Credits"
    TR
      TD
        "Soils"
      TD
        P
          "4"
    TR
      TD
  P
    Table
      TR
        TD
          "bare"
  H2
    " . "
  H2
    "4.1 Second part"
  L
    LI
      Lbl
        "a)"
      LBody
        "item"
  H3
    "4. First part"
  H2
    "Annex of all the other things"
  Caption
    "Tabla 2. More"
  Table
    TR
      TD
        "x"
"""


def test_tree(spark):
    nodes = tagged.parse('A\n  "x"\n  /Attr\n  B\n    "y\n  "z"\n\n3\nC')
    assert [(n["kind"], n["path"], n["said"], n["leaf"]) for n in nodes] == [("A", [0], ["x", "z"], False), ("B", [0, 1], ["y"], True), ("C", [2], [], True)]


def test_sections(spark):
    docs = spark.createDataFrame([("d1", STRUCT), ("d2", None), ("d3", "")], "doc string, t string")
    found = tagged.blocks(tagged.trees(docs, "doc", "t"), "doc")
    shown = [(r.kind, r.text if r.rows is None else r.rows) for r in found.orderBy("at").collect()]
    assert shown == [
        ("P", "Front words"), ("H1", "4. First part"), ("P", "One later two"), ("P", "Tabla 1. Credits"), ("Table", [["Course", "Credits"], ["Soils", "4"]]), ("Table", [["bare"]]),
        ("H2", "."), ("H2", "4.1 Second part"), ("P", "a) item"), ("H3", "4. First part"), ("H2", "Annex of all the other things"), ("Caption", "Tabla 2. More"), ("Table", [["x"]]),
    ]
    texts = ["contents first part second part"] * 12 + ["First  Part", "", "SECOND part", "then first part", "annex of all the other things"]
    pages = spark.createDataFrame([("d1", texts)], "doc string, paginas array<string>")
    got = tagged.sections(found, "doc", F.lit("DM25"), pages).orderBy("seccion").collect()
    assert [(r.codigo, r.titulo, r.nivel, r.pagina) for r in got] == [
        ("DM25-PORTADA", "Portada y créditos", 1, 1), ("DM25-4", "4. First part", 1, 13), ("DM25-4.1", "4.1 Second part", 2, 15), ("DM25-4-2", "4. First part", 3, 16), ("DM25-ANNEX-OF-ALL-THE", "Annex of all the other things", 2, 17),
    ]
    assert got[1].parrafos == ["One later two", "."] and [(t.leyenda, t.filas) for t in got[1].tablas] == [("Tabla 1. Credits", [["Course", "Credits"], ["Soils", "4"]]), (None, [["bare"]])]
    assert got[2].parrafos == ["a) item"] and got[4].tablas[0].leyenda == "Tabla 2. More" and got[0].parrafos == ["Front words"]
    assert {r.pagina for r in tagged.sections(found, "doc", F.lit("X")).collect()} == {1, None}


def test_masters(spark):
    files = spark.createDataFrame([("b Plan 2025.pdf",), ("a PLAN 2025.pdf",), ("other.pdf",)], "archivo string")
    seeds = spark.createDataFrame([("plan", "DM25", "x", "y", "T"), ("none", "DM1", "x", "y", "T")], "patron string, prefijo string, proceso string, nivel string, titulo string")
    assert [(r.prefijo, r.archivo) for r in tagged.masters(files, seeds).collect()] == [("DM25", "a PLAN 2025.pdf")]


def segs(spark, rows):
    return spark.createDataFrame([("d", p, float(x0), float(y0), float(x1), float(y0) + 10, t) for p, x0, y0, x1, t in rows], "doc string, p int, x0 double, y0 double, x1 double, y1 double, t string")


def test_head_and_template(spark):
    s = segs(spark, [(1, 10, 20, 100, "CONTENIDO DIGITAL V2"), (1, 10, 100, 60, "Nombre del CAD"), (1, 200, 101, 260, "SUELOS  I"), (1, 10, 130, 60, "Nmero de crditos"), (1, 200, 130, 220, "4"), (1, 10, 160, 60, "Nombre profesor líder"), (1, 200, 160, 260, "Ana"), (2, 10, 100, 60, "Código del CAD"), (2, 200, 100, 260, "C2"), (1, 300, 190, 350, "Facultad / Unidad Misional")])
    assert forms.head_fields(s).first().fields == {"nombre": "SUELOS I", "creditos": "4"}
    files = spark.createDataFrame([("d", "PAD CAD602020105 FISICA V1.9.pdf"), ("e", "AGRICULTURAL soils.pdf")], "doc string, archivo string")
    assert {tuple(r) for r in forms.template(s, files).collect()} == {("d", "V2", "CAD602020105", "es"), ("e", "V1.9", None, "en")}


def test_glued_labels(spark):
    words = spark.createDataFrame([("d", 1, 0, s, 10.0 * k, 0.0, 10.0 * k + 8, 9.0, t) for s, text in enumerate(["PLATAFORMA Descripción de la actividad fin", "Descripción de la actividad", "nada que ver", "x Descripción de la"]) for k, t in enumerate(text.split())], "doc string, p int, line int, segment int, x0 double, y0 double, x1 double, y1 double, t string")
    got = {}
    for r in forms.split_glued(words).orderBy("x0").collect():
        got.setdefault((r.segment, r.part), []).append(r.t)
    assert {k: " ".join(v) for k, v in got.items()} == {(0, 0): "PLATAFORMA", (0, 1): "Descripción de la actividad", (0, 2): "fin", (1, 1): "Descripción de la", (1, 2): "actividad", (2, 0): "nada que ver", (3, 0): "x", (3, 1): "Descripción de la"}


def test_lists_and_blocks(spark):
    lines = spark.createDataFrame([("c", k, t, "d", 1, 10.0 * k, 10.0 * k + 8) for k, t in enumerate(["• Cultura • Institución", "y más", "•", "¿ Aula", "Naturaleza"])], "cell string, o int, t string, doc string, p int, y0 double, y1 double")
    assert [r.t for r in forms.bullet_items(lines, ["cell"], ["o"]).orderBy("item").collect()] == ["Cultura", "Institución y más", "Aula Naturaleza"]
    beside = spark.createDataFrame([("d", 1, 40.0, 48.0)], "doc string, p int, y0 double, y1 double")
    assert [r.t for r in forms.bullet_items(lines, ["cell"], ["o"], beside).orderBy("item").collect()] == ["Cultura", "Institución y más", "Aula", "Naturaleza"]
    cells = spark.createDataFrame([("d", k, t) for k, t in enumerate(["x", "Justificación del curso", "uno", "REA general", "dos", "justificación otra"])], "doc string, o int, t string")
    assert [r.t for r in forms.block_between(cells, ["doc"], ["o"], "justificacion", ["rea general"]).collect()] == ["uno"]


def test_results(spark):
    s = segs(spark, [(1, 10, 0, 20, "Consecutivo"), (1, 10, 50, 20, "1"), (1, 50, 40, 200, "first a"), (1, 50, 60, 200, "first b"), (1, 10, 100, 20, "2"), (1, 50, 101, 200, "second"), (1, 300, 52, 320, "40 %"), (2, 50, 10, 200, "goes on")])
    assert [tuple(r) for r in forms.specific_results(s).orderBy("consecutivo").collect()] == [("d", 1, "first a first b", 40.0), ("d", 2, "second goes on", None)]
    assert [tuple(r) for r in forms.specific_results(segs(spark, [(1, 50, 10, 99, "only text")])).collect()] == [("d", 1, "only text", None)]


def test_tables(spark):
    s = segs(spark, [
        (3, 60, 100, 90, "Autor"), (3, 210, 100, 260, "Nombre"), (3, 405, 104, 425, "Año"), (3, 500, 100, 520, "ISBN"),
        (3, 10, 150, 140, "Pérez, A."), (3, 160, 140, 300, "Suelos"), (3, 160, 160, 300, "del mundo"), (3, 400, 150, 430, "2.016"), (3, 500, 150, 510, "-"),
        (3, 10, 200, 140, "Gómez"), (3, 160, 200, 300, "Agua"), (3, 400, 200, 430, "2020"), (3, 500, 200, 540, "978"), (3, 10, 250, 90, "Recursos CGCA"), (3, 160, 270, 200, "after"),
    ])
    got = sorted(((r.autor, r.titulo, r.anio, r.isbn) for r in forms.reading_list(s).collect()), key=str)
    assert got == [("Gómez", "Agua", 2020, "978"), ("Pérez, A.", "Suelos del mundo", 2016, None)]
    r = segs(spark, [(4, 40, 10, 120, "Nombre del recurso"), (4, 240, 10, 260, "Tipo"), (4, 410, 12, 480, "Área de conocimiento"), (4, 20, 40, 90, "Video"), (4, 200, 40, 260, "MP4"), (4, 20, 70, 90, "Mapa"), (4, 400, 70, 460, "Geo"), (4, 20, 200, 60, "Bibliografía"), (4, 20, 220, 60, "x")])
    assert sorted(((x.nombre, x.tipo, x.area) for x in forms.resources(r).collect()), key=str) == [("Mapa", None, "Geo"), ("Video", "MP4", None)]


@pytest.mark.parametrize(("text", "field"), [("Descripción:", "descripcion"), ("Trabajo gestor del conocimiento (profesor)", "trabajo_profesor"), ("other", None)])
def test_labels(spark, text, field):
    assert spark.createDataFrame([(text,)], "t string").select(forms.label_of(F.col("t"), forms.LEFT)).first()[0] == field


def test_columns_without_values_go_by_nearest_centre(spark):
    items = spark.createDataFrame([("k", 10.0, 60.0, "a"), ("k", 300.0, 360.0, "b")], "k string, x0 double, x1 double, t string")
    heads = spark.createDataFrame([("k", 0.0, 50.0, "one"), ("k", 150.0, 200.0, "two"), ("k", 290.0, 380.0, "three")], "k string, x0 double, x1 double, field string")
    assert {r.t: r.field for r in forms.columns_by_header(items, heads, ["k"]).collect()} == {"a": "one", "b": "three"}


def test_experiences(spark):
    s = segs(spark, [
        (1, 400, 70, 460, "Semestre: 2"), (1, 60, 100, 200, "Experiencia: The long"), (1, 210, 101, 280, "way to the"), (1, 60, 112, 180, "harvest of it Rea"), (1, 60, 150, 200, "far below"),
        (1, 350, 90, 430, "Dimensiones: Aula - Cultura"), (1, 340, 105, 420, "- Naturaleza"), (1, 345, 118, 400, "Semestre"), (1, 110, 200, 150, "Rea"), (1, 40, 220, 48, "2"), (1, 120, 210, 400, "What is done"),
        (1, 120, 225, 400, "and why"), (1, 120, 300, 200, "Actividades"), (1, 120, 320, 200, "not told"), (1, 40, 330, 45, "9"),
        (2, 110, 75, 200, "above the second"), (2, 60, 100, 200, "Experiencia : Second"), (2, 50, 112, 58, "7"), (2, 60, 124, 90, "no name"), (2, 150, 130, 300, "Its text"), (3, 150, 20, 300, "goes on"), (3, 60, 50, 90, "Autor"), (3, 150, 60, 300, "a book"),
    ])
    assert [tuple(r) for r in forms.experiences(s).orderBy("orden").collect()] == [
        ("d", 1, "vive_experiencia", "The long way to the harvest of it", ["Aula", "Cultura", "Naturaleza"], 2, "What is done and why"),
        ("d", 2, "vive_experiencia", "Second", None, 7, "Its text goes on"),
    ]
    assert forms.experiences(segs(spark, [(1, 10, 10, 50, "Autor"), (1, 400, 10, 450, "Experiencia: right")])).count() == 0
    alone = segs(spark, [(1, 10, 10, 50, "Experiencia:")])
    assert [tuple(r) for r in forms.experiences(alone).collect()] == [("d", 1, "vive_experiencia", "", None, None, None)]


def numbered_words(spark, rows):
    """Words of segments (p, x0, y0, t): every word 5 points a sign wide with 3 between, a line for each height of a page."""
    out = []
    for p, x, y, t in rows:
        for w in t.split(" "):
            out.append(("d", p, int(y), int(x), float(x if w is None else 0), float(y), 0.0, float(y + 10), w))
    at: dict = {}
    words = []
    for d, p, line, seg, _, y0, _, y1, w in out:
        x0 = at.get((p, line, seg), float(seg))
        at[p, line, seg] = x0 + 5 * len(w) + 3
        words.append((d, p, line, seg, x0, y0, x0 + 5 * len(w), y1, w))
    return spark.createDataFrame(words, "doc string, p int, line int, segment int, x0 double, y0 double, x1 double, y1 double, t string")


def test_activities_of_the_second_template(spark):
    long = "a long telling of what is to be done there"
    rows = [(1, 60, 100, "Experiencia: One"), (1, 50, 200, "Actividades")]
    rows += [
        (1, 20, 300, "SEED"), (1, 20, 330, "TIME"), (1, 121, 296, long + " x"), (1, 121, 306, "goes on"), (1, 400, 315, "Semana 2"), (1, 450, 315, "1 Semana(s)"), (1, 500, 305, "guides them"), (1, 500, 309, "well"), (1, 600, 305, "learns"),
        (1, 121, 345, "Herramientas de Recolección de Datos: (Tarea): a text (Foro): talk"), (1, 125, 357, "and more"),
        (1, 20, 500, "HARVEST"), (1, 121, 500, long + " y"), (1, 400, 500, "Semana"), (1, 400, 510, "4"), (1, 450, 500, "3 Semana(s)"), (1, 500, 500, "helps"), (1, 600, 500, "cuts"), (1, 600, 560, "eats"),
        (2, 121, 60, long + " z"), (2, 60, 150, "Experiencia: Two"), (2, 50, 200, "Actividades"), (2, 121, 300, "no weeks here"), (2, 60, 400, "Autor"), (2, 400, 420, "Semana 9"),
    ]
    got = [r.asDict() for r in activities.activities(numbered_words(spark, rows)).orderBy("orden", "actividad").collect()]
    assert [(r["orden"], r["actividad"], r["nombre"], r["semana_inicio"], r["duracion"]) for r in got] == [(1, 1, "SEED TIME", "Semana 2", "1 Semana(s)"), (1, 2, "HARVEST", "Semana 4", "3 Semana(s)")]
    assert [r["descripcion"] for r in got] == [long + " x goes on", f"{long} y {long} z"]
    assert [(r["trabajo_profesor"], r["trabajo_estudiante"]) for r in got] == [("guides them well", "learns"), ("helps", "cuts eats")]
    assert [(r["instrumentos"], r["descripcion_instrumentos"]) for r in got] == [(["Tarea", "Foro"], "(Tarea): a text (Foro): talk and more"), (None, None)]
    assert activities.activities(numbered_words(spark, [(1, 60, 100, "Experiencia: One")])).count() == 0


def test_phases(spark):
    rows = [(1, 50, 100, 120, "Fases del MCA"), (1, 50, 120, 80, "Fase"), (1, 200, 120, 280, "Descripción"), (1, 50, 140, 90, "Fase 1."), (1, 50, 152, 90, "Motivate"), (1, 200, 140, 500, "w" * 61), (1, 200, 152, 300, "end"), (1, 50, 220, 90, "Fase 2. Do"), (1, 50, 300, 150, "Vive una experiencia"), (1, 50, 320, 90, "Fase 3")]
    assert [tuple(r) for r in activities.phases(segs(spark, rows)).orderBy("orden").collect()] == [("d", 1, "Fase 1. Motivate", "w" * 61 + " end"), ("d", 2, "Fase 2. Do", None)]
    assert activities.phases(segs(spark, [(1, 50, 100, 120, "Fases del MCA"), (1, 50, 120, 180, "No hay datos")])).count() == 0


def test_records_of_the_first_template(spark):
    rows = [
        (1, 40, 50, 120, "Dimensiones"), (1, 150, 50, 250, "no record yet"), (1, 40, 80, 200, "Vive una experiencia"), (1, 40, 100, 250, "Experiencia: First one"),
        (1, 40, 120, 100, "Dimensiones"), (1, 150, 114, 250, "• Aula"), (1, 150, 126, 250, "• Cultura"), (1, 40, 160, 200, "Actividad: Digging"), (1, 40, 185, 120, "Trabajo gestor del"), (1, 40, 196, 110, "conocimiento"), (1, 40, 207, 100, "(profesor)"),
        (1, 150, 196, 270, "shows how"), (1, 300, 196, 360, "Semana inicio"), (1, 400, 196, 450, "Semana 1"), (1, 300, 230, 360, "Duración"), (1, 400, 230, 450, "2 semanas"), (1, 40, 260, 120, "Lugares"), (1, 150, 260, 250, "• Field"), (1, 40, 700, 120, "Trabajo estudiante"), (1, 150, 700, 250, "digs and"),
        (2, 150, 20, 250, "plants"), (2, 40, 60, 200, "Soluciona un problema"), (2, 40, 80, 200, "Problema: Drought"), (2, 40, 100, 200, "Etapa 1: Look"), (2, 40, 120, 250, "Actividad: Measure"), (2, 40, 150, 120, "Descripción"), (2, 150, 150, 250, "the wells"),
        (2, 40, 200, 120, "Acciones"), (2, 40, 220, 120, "Mejoras"), (2, 150, 220, 250, "• Less"), (2, 150, 232, 250, "• More"), (2, 40, 300, 120, "Bibliografía"), (2, 150, 320, 250, "a book"),
    ]
    got = [tuple(r)[1:] for r in records.records(segs(spark, rows)).orderBy("orden", "actividad").collect()]
    assert got == [
        (0, 0, None, None, None, {"mejoras": ["Less", "More"]}),
        (1, 0, "vive_experiencia", "First one", None, {"dimensiones": ["Aula", "Cultura"]}),
        (1, 1, None, "Digging", None, {"trabajo_profesor": ["shows how"], "semana_inicio": ["Semana 1"], "duracion": ["2 semanas"], "lugares": ["Field"], "trabajo_estudiante": ["digs and plants"]}),
        (2, 0, "soluciona_problema", "Drought", None, None),
        (2, 1, None, "Measure", "Look", {"descripcion": ["the wells"]}),
    ]
