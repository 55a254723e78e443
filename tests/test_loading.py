"""Loading stage inputs; all rows are invented."""

from pyspark.sql import functions as F

from attestra.operators import labelling as lb
from attestra.operators import loading as ld


def test_slides_and_charts(spark):
    slides = spark.createDataFrame(
        [("F05", 5, "Factor 5", "a.pdf", "Programa", 1, None, None, "FACTOR 5\nshort"), ("F05", 5, "Factor 5", "a.pdf", "Programa", 2, 3, "Name of it.", "Característica 3. Name of it.\nLos resultados muestran avances\nFuente: Oficina Uno"), ("F05", 5, "Factor 5", "a.pdf", "Programa", 3, None, None, "VALORACIÓN INTERPRETATIVA " + "x " * 80), ("S01", None, "Rector", "b.pdf", "Institución", 4, None, None, "12")],
        "fuente string, factor int, nombre_fuente string, archivo string, sede string, pagina int, car int, car_nombre string, texto string",
    )
    ocr = ld.ocr_lines(spark.createDataFrame([("S01", {"4": ["Imagen con título legible", "12 34"]})], "fuente string, paginas map<string,array<string>>"))
    got = {r.codigo: r for r in ld.slide_evidence(slides, ocr).collect()}
    assert set(got) == {"F05-P002", "F05-P003", "S01-P004"}
    assert got["F05-P002"].titulo == "Name of it: Los resultados muestran avances" and got["F05-P002"].fuente == "Oficina Uno"
    assert (got["F05-P003"].tipo, got["F05-P003"].titulo) == ("valoracion", "Valoración interpretativa del factor 5")
    assert got["S01-P004"].titulo == "Imagen con título legible" == got["S01-P004"].texto_ocr
    charts = spark.createDataFrame([("F05", 2, [("T", "bar", [("s", [("a", 1.0), ("b", 2.0)])])], [[["Clave: x", "b"], ["c"]]]), ("F09", 1, [], [])], "fuente string, pagina int, graficas array<struct<titulo:string,tipo:string,series:array<struct<nombre:string,puntos:array<struct<categoria:string,valor:double>>>>>>, tablas array<array<array<string>>>")
    g, t, lost = ld.attach_charts(charts, ld.slide_evidence(slides, ocr))
    assert [(r.orden, r.serie_orden, r.punto_orden, r.categoria) for r in g.orderBy("punto_orden").collect()] == [(1, 1, 1, "a"), (1, 1, 2, "b")]
    assert tuple(t.first())[3:] == (2, 2, [["Clave: [omitido]", "b"], ["c"]]) and [r[0] for r in lost.collect()] == ["F09-P001"]


def test_section_title_looks_through_all_lines(spark):
    text = "\n".join(["SECCIÓN UNO"] * 10_050 + ["La primera línea que dice más"])
    df = spark.createDataFrame([(text,), ("",), ("SECCIÓN UNO",)], "texto string")
    got = [r.t for r in df.select(lb.section_title(F.col("texto"), F.lit("otro")).alias("t")).collect()]
    assert got == ["SECCIÓN UNO: La primera línea que dice más", "otro", "SECCIÓN UNO"]


def test_plans_and_documents(spark):
    pads = spark.createDataFrame(
        [("P1", "d/uno.pdf", "Física", "Ing. Agronómica", None, [(1, "a"), (1, "b")], [("I", "x")], [("vive_experiencia", "E", [("A", "2 semanas", "semana 3", ["campo"])])]), ("P1", "d/dos.pdf", "Otra", None, 3, [], [], [])],
        "codigo string, archivo string, nombre string, programa string, creditos int, rea array<struct<consecutivo:int,texto:string>>, fases array<struct<fase:string,descripcion:string>>, experiencias array<struct<tipo:string,nombre:string,actividades:array<struct<nombre:string,duracion:string,semana_inicio:string,lugares:array<string>>>>>",
    )
    coded = ld.unique_codes(pads)
    assert sorted(r.codigo for r in coded.collect()) == ["P1-dos", "P1-uno"]
    t = ld.plan_tables(coded)
    assert [tuple(r) for r in t["pad_rea"].collect()] == [("P1-uno", 1, "a")]
    a = t["pad_actividad"].first()
    assert (a.duracion_semanas, a.semana_inicio, a.lugares, a.experiencia_orden) == (2, 3, ["campo"], 1)
    other = spark.createDataFrame([("P1-uno", 4), ("P1-dos", 9)], "codigo string, creditos int")
    assert {r.codigo: r.creditos for r in ld.complement(coded, other, ["creditos"]).collect()} == {"P1-uno": 4, "P1-dos": 3}
    related = spark.createDataFrame([("P1-uno", "Física")], "pad string, curso string")
    sites = {r.codigo: r.sede for r in ld.plan_evidence(coded.withColumn("texto", F.lit("t")), related).collect()}
    assert sites == {"PAD-P1-uno": "Programa", "PAD-P1-dos": "Institución"}
    tables = spark.createDataFrame([("D", 1, "Tabla 2. Plan", [["Período I"], ["Física", "", "3", "10", "20", "144"], ["CAI Arte", "", "2", "1", "1", "90"], ["Total", "", "5"], ["Período 2"], ["Química", "x", "4"]]), ("D", 2, "Tabla 3. Distribución", [["física", "4"], ["FÍSICA", "9"]])], "evidencia string, orden int, leyenda string, celdas array<array<string>>")
    plan = ld.proposed_plan(ld.table_by_caption(tables, "Plan"), ld.table_by_caption(tables, "Distribución"))
    assert [(r.periodo, r.nombre, r.tipo, r.creditos, r.creditos_distribucion) for r in plan.orderBy("orden").collect()] == [(1, "Física", "disciplinar", 3, 4), (1, "CAI Arte", "institucional", 2, None), (2, "Química", "institucional", 4, None)]
    moves = spark.createDataFrame([(0, ["A", "II", "3", "B", "3", "4"]), (1, ["", "", "", "C", "IV", "2"])], "k int, fila array<string>")
    assert [tuple(r) for r in ld.transition(moves).orderBy("orden").collect()] == [(0, "A", 2, 3, "B", 3, 4), (1, "A", 2, 3, "C", 4, 2)]
    outcomes = spark.createDataFrame([(0, ["R1", "one"]), (1, ["", "more"]), (2, ["R2", "two"])], "k int, fila array<string>")
    assert [(r.codigo, r.texto) for r in ld.outcome_rows(outcomes).orderBy("record").collect()] == [("R1", "one more"), ("R2", "two")]
    courses = spark.createDataFrame([("Física", 2, 5)], "nombre string, periodo int, creditos int")
    told = ld.warnings(coded.withColumn("semestre", F.lit(1)).withColumn("creditos", F.lit(3)), courses, related, plan, spark.createDataFrame([("X",)], "evidencia string"))
    assert sorted(r.aviso for r in told.collect()) == ["PAD sin relación", "créditos distintos", "gráficas sin evidencia", "semestre distinto", "total del plan"]
    sections = spark.createDataFrame([("f", "DM25", "DM25-1", "One", 3, ["p", "q"], [("Tabla 1", [["a", "b"]])])], "archivo string, prefijo string, codigo string, titulo string, pagina int, parrafos array<string>, tablas array<struct<leyenda:string,filas:array<array<string>>>>")
    documents = spark.createDataFrame([("DM25", "resignificacion", "escenario", "Doc")], "prefijo string, proceso string, nivel string, titulo string")
    e = ld.section_evidence(sections, documents).first()
    assert (e.titulo, e.texto, e.nivel, e.proceso) == ("Doc · One", "p\nq\na | b", "escenario", "resignificacion") and ld.section_tables(sections).first().columnas == 2
    annex = spark.createDataFrame([(46, "N", "AX-46-01", "x.pdf", "Password: abc")], "numero int, nombre string, codigo string, archivo string, texto string")
    assert ld.annex_evidence(annex).first().texto == "Password: [omitido]"
