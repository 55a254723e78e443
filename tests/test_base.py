"""The evidence base: seeds, rules, loading, projection, decisions, views, redaction, exports; all rows are invented."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from attestra.operators import decisions, labelling, projection, reconcile, redaction, scoring
from attestra.operators.validation import SeedError
from attestra.plans import views
from attestra.sources import export, schema, seeds, snapshot

FILES = {
    "marcos": ["1,CNA,Model,,", "2,ABET-EAC,Other,,", "3,CNA-INST,Inst,,", "4,SOFIA,Last,,"],
    "nodos": ["CNA,F01,Factor one,factor,,1,", "CNA,C01,First,caracteristica,F01,2,", "CNA,C02,Second,caracteristica,F01,3,", "ABET-EAC,C4,Improve,criterio,,1,", "ABET-EAC,C3,Outcomes,criterio,,2,", "ABET-EAC,SO1,Solve,outcome,C3,3,", "ABET-EAC,SO3,Tell,outcome,C3,4,", "CNA-INST,IF01,Inst factor,factor,,1,", "CNA-INST,IC01,Inst first,caracteristica,IF01,2,", "SOFIA,SF1,Standard,criterio,,1,", "SOFIA,SF1.1,Part,subcriterio,SF1,2,"],
    "correspondencias": ["CNA,C01,ABET-EAC,C3,equivalente,", "CNA,C02,ABET-EAC,C3,apoyo,", "CNA-INST,IC01,CNA,C01,parcial,", "CNA-INST,IC01,SOFIA,SF1.1,equivalente,", "CNA,C01,SOFIA,SF1,parcial,"],
    "indicadores": ["CNA_VAL,Score,,", "CNA_POND,Weight,,", "CNA_INST_VAL,Score,,", "CNA_INST_POND,Weight,,", "GRAD,Rate,,"],
    "indicador_nodos": ["GRAD,CNA,C01,principal"],
    "mediciones": ["CNA_VAL,2022,,4.6,C01,,", "CNA_VAL,2022,,3.7,C02,,", "CNA_POND,2022,,60,C01,,", "CNA_INST_VAL,2022,,4.0,IC01,,", "GRAD,S1,,10.5,,F01-P001,", "GRAD,S1,,10.54,,F01-P002,", "GRAD,S1,,12,,X99,"],
    "cursos": ["Physics,1,basic,4,1,ciencias_basicas,ciencias_fisicas,basico,alta,", 'Razonamiento Lógico,2,basic,2,7,otro,electivas,transversal,baja,"a ""quoted"" note"'],
    "prerrequisitos": ["Physics,Diagnóstico y nivelatorio de física"],
    "curso_outcomes": ["Physics,SO1,I,propuesta,pad,5,,"],
    "brechas": ["ABET-EAC,C3,Gap,,alta,,,", "ABET-EAC,C3,Gap two,,alta,,,abierta", "CNA,F01,Own,,media,,,", "SOFIA,SF1.1,Late,,media,,,en_curso"],
    "normativa_manual": ["Acuerdo,9,2001,Consejo Superior,special words"],
    "normativa_excluir": ["Acuerdo,777,2010"],
    "pad_curso": ["P1,Physics,"],
    "documentos": ["plan,DM25,acreditacion,principal,Plan"],
    "documento_nodos": [r"^DM25-4\.1,C01,parcial,", r"^DM25-4$,C02,apoyo,"],
    "privacidad": [r"^AX-46,personal data"],
}


def write_seeds(folder, **changes):
    for name, rows in (FILES | changes).items():
        text = ",".join(schema.SEEDS[name].split()) + "\n" + "\n".join(rows) + "\n"
        (folder / f"{name}.csv").write_text(("﻿" if name == "nodos" else "") + text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def base(spark, tmp_path):
    ev = [("F01-P001", "Good", "diapositiva", "principal"), ("F01-P002", "Plan", "plan_mejora", None), ("F01-P003", "Extra", "diapositiva", "complementaria"), ("F01-P004", "Old", "diapositiva", "escenario")]
    evidence = spark.createDataFrame([(c, t, k, "text of " + c, n, "sin_revisar") for c, t, k, n in ev], "codigo string, titulo string, tipo string, texto string, nivel string, estado_revision string")
    t, missing = seeds.base_from_seeds(spark, seeds.read_all(spark, write_seeds(tmp_path)), evidence)
    assert [r[0] for r in missing.collect()] == ["X99"]
    labels = [("F01-P001", "CNA", "C01", "principal"), ("F01-P001", "CNA", "C02", "principal"), ("F01-P002", "CNA", "F01", "principal"), ("F01-P003", "CNA", "C01", "principal"), ("F01-P004", "CNA", "C01", "principal")]
    t["evidencia_nodo"] = schema.conform(spark.createDataFrame([(*x, "extraccion", "validada", None) for x in labels], schema.TABLES["evidencia_nodo"]), "evidencia_nodo")
    return t


def test_seeds(spark, tmp_path):
    s = seeds.read_all(spark, write_seeds(tmp_path))
    assert s["cursos"].where("nombre LIKE 'Raz%'").first().nota == 'a "quoted" note'
    assert s["mediciones"].where("desagregacion = ''").count() == 3 and s["nodos"].first().padre is None


@pytest.mark.parametrize(
    ("name", "row", "told"),
    [
        ("correspondencias", "CNA,C99,ABET-EAC,C3,parcial,", "V4"), ("correspondencias", "CNA,C01,CNA,C02,parcial,", "V5"), ("mediciones", "GRAD,S1,,many,,,", "not a number"), ("mediciones", "GRAD,S1,,,,,", "V9"),
        ("nodos", "CNA,C01,Again,caracteristica,F01,9,", "V3"), ("nodos", "CNA,C09,Child,caracteristica,C10,9,", "V2"), ("curso_outcomes", "Physics,SO3,X,propuesta,pad,1,,", "V15"), ("curso_outcomes", "Physics,SO3,I,validada,pad,1,,", "V17"),
        ("cursos", "Other,1,basic,2,7,otro,nothing,transversal,baja,", "V19"), ("privacidad", "((,why", "compile"), ("documento_nodos", "x,C01,chief,", "V24"), ("brechas", "CNA,C77,G,,alta,,,", "V25"), ("prerrequisitos", "Physics,Magic", "V12"),
    ],
)
def test_bad_seeds_are_named(spark, tmp_path, name, row, told):
    with pytest.raises(SeedError, match=told):
        seeds.read_all(spark, write_seeds(tmp_path, **{name: [*FILES[name], row]}))


def test_header_must_be_exact(spark, tmp_path):
    folder = write_seeds(tmp_path)
    (tmp_path / "marcos.csv").write_text("id,code\n1,2\n")
    with pytest.raises(SeedError, match="header"):
        seeds.read_all(spark, folder)


def inferred(t):
    return {(r.evidencia, r.marco, r.nodo): r.rol for r in t["evidencia_nodo"].where("origen = 'inferida'").collect()}


def test_projection(spark, base):
    labels, actions = projection.project(base)
    got = dict(base, evidencia_nodo=labels)
    assert inferred(got) == {("F01-P001", "ABET-EAC", "C3"): "principal", ("F01-P001", "SOFIA", "SF1"): "parcial", ("F01-P003", "ABET-EAC", "C3"): "apoyo", ("F01-P003", "SOFIA", "SF1"): "apoyo", ("F01-P002", "ABET-EAC", "C4"): "apoyo"}
    again, actions = projection.project(got)
    assert projection.summary(actions).first().asDict() == {"nuevas": 0, "rol": 0, "retiradas": 0, "humanas": 0} and again.count() == labels.count()
    # A decided inferred label survives its edge; a label by hand blocks the pair.
    kept = labels.withColumn("validado_por", F.when((F.col("nodo") == "C3") & (F.col("evidencia") == "F01-P001"), "Ada"))
    gone = dict(base, evidencia_nodo=kept, correspondencia=base["correspondencia"].withColumn("estado", F.when(F.col("destino") == "C3", "descartada").otherwise(F.col("estado"))))
    after, actions = projection.project(gone)
    assert set(inferred(dict(base, evidencia_nodo=after))) == {("F01-P001", "ABET-EAC", "C3"), ("F01-P001", "SOFIA", "SF1"), ("F01-P003", "SOFIA", "SF1"), ("F01-P002", "ABET-EAC", "C4")}
    assert projection.summary(actions).first().asDict() == {"nuevas": 0, "rol": 0, "retiradas": 1, "humanas": 1}
    by_hand = base["evidencia_nodo"].union(spark.createDataFrame([("F01-P001", "ABET-EAC", "C3", "apoyo", "manual", "validada", "Ada")], schema.TABLES["evidencia_nodo"]))
    _, actions = projection.project(dict(base, evidencia_nodo=by_hand))
    assert actions.where("action = 'blocked'").count() == 1


def test_views(base):
    t = dict(base, evidencia_nodo=projection.project(base)[0])
    for view in views.VIEWS.values():
        view(t).collect()
    assert [tuple(r)[:1] + tuple(r)[3:] for r in views.v_cobertura_abet(t).collect()][:2] == [("C4", 0, 0, 1, 0), ("C3", 1, 0, 1, 2)]
    pairs = [(r.valor_a, r.valor_b) for r in views.v_inconsistencias(t).collect()]
    assert sorted(pairs) == [(10.5, 12.0), (10.54, 12.0)]
    cna = {r.codigo: r for r in views.v_valoracion_cna(t).collect()}
    assert (cna["C01"].riesgo_sobrevaloracion, cna["C01"].senales_altas, cna["C01"].brechas_cna, cna["C01"].evidencias, cna["C01"].grado) == ("alto", 2, 1, 2, "Se cumple plenamente")
    assert (cna["C02"].riesgo_sobrevaloracion, cna["C02"].ponderacion, cna["C02"].grado) == ("bajo", None, "Se cumple en alto grado")
    assert tuple(views.v_cna_inst_programa(t).first()) == ("IC01", "Inst first", 4.0, "C01", "First", 4.6, "parcial", 0.6)
    sofia = views.v_valoracion_sofia(t).first()
    assert (sofia.valoracion_inst, sofia.caracteristicas, sofia.brechas_media_alta, sofia.brechas, sofia.evidencias) == (4.0, "IC01=4.0", 1, 1, 2)
    assert {r.area: (r.creditos, r.cursos) for r in views.v_creditos_atmae(t).collect()}["ciencias"] == (4, 1)
    assert {r.modulo: r.ects for r in views.v_creditos_aneca(t).collect()}["transversal"] == 3.0
    assert [r.estado for r in views.v_pad_curso(t).collect()] == ["sin PAD", "sin PAD"]
    node = {r.nodo: r for r in views.node_details(t, "ABET-EAC").collect()}["C3"]
    assert [e.evidencia for e in node.evidencias] == ["F01-P001", "F01-P003"] and len(node.brechas) == 2
    assert views.pending(t).first().sin_abet == 1
    for q in (views.evidence_feed, views.indicator_series, views.norms_cited, views.gaps_by_severity, views.course_matrix, views.study_route, views.factor_scores):
        q(t).collect()


def test_load_is_idempotent_and_spares_decisions(spark, base):
    load = base["evidencia"].select("codigo", *reconcile.EVIDENCE_FIELDS)
    first, actions = reconcile.reconcile_evidence(base["evidencia"], load)
    assert {r.action for r in actions.collect()} == {"keep"}
    fewer, actions = reconcile.reconcile_evidence(first, load.where("codigo <> 'F01-P001'"))
    assert actions.where("action = 'obsolete'").count() == 1 and fewer.where("estado_revision = 'obsoleta'").first().codigo == "F01-P001"
    again, actions = reconcile.reconcile_evidence(fewer, load)
    assert actions.where("action = 'update'").first().codigo == "F01-P001" and again.where("estado_revision <> 'sin_revisar'").count() == 0
    edges = base["correspondencia"].withColumn("validado_por", F.when(F.col("tipo") == "apoyo", "Ada"))
    new = base["correspondencia"].where("origen <> 'C02'").withColumn("tipo", F.lit("apoyo")).select("marco_origen", "origen", "marco_destino", "destino", "tipo", "nota")
    out, actions = reconcile.reconcile_edges(edges, new)
    assert {r.action: r["count"] for r in actions.groupBy("action").count().collect()} == {"protected": 1, "update": 4} and out.count() == 5
    want = spark.createDataFrame([("F01-P001", "CNA", "C01", "apoyo", "propuesta"), ("F01-P002", "CNA", "C02", "parcial", "propuesta")], "evidencia string, marco string, nodo string, rol string, estado string")
    labels, actions = reconcile.reconcile_labels(base["evidencia_nodo"], want, spark.createDataFrame([("F01-P001",), ("F01-P003",)], "evidencia string"))
    assert {(r.evidencia, r.nodo): r.action for r in actions.where("action <> 'keep'").collect()} == {("F01-P001", "C01"): "update", ("F01-P002", "C02"): "insert", ("F01-P001", "C02"): "delete", ("F01-P003", "C01"): "delete"}
    nodes, surplus = reconcile.upsert_nodes(base["nodo"], base["nodo"].where("codigo <> 'SO3'"), F.current_timestamp())
    assert nodes.count() == 11 and surplus.first().codigo == "SO3" and nodes.where("actualizado_en IS NOT NULL").count() == 0


def test_decisions(spark, base):
    labels = base["evidencia_nodo"]
    key = ["evidencia", "marco", "nodo"]
    one = labels.where("evidencia = 'F01-P001' AND nodo = 'C01'")
    log = spark.createDataFrame(decisions.entry(spark, "etiqueta", one, key, "descartar", "Ada").collect(), decisions.LOG)
    now = decisions.apply_log(labels, log, "etiqueta", key)
    r = now.where("evidencia = 'F01-P001' AND nodo = 'C01'").first()
    assert (r.estado, r.validado_por, log.first().estado_anterior) == ("descartada", "Ada", "validada")
    new = spark.createDataFrame([("F01-P004", "ABET-EAC", "C4", None, "manual")], "evidencia string, marco string, nodo string, estado string, origen string")
    more = spark.createDataFrame([*log.collect(), *decisions.entry(spark, "etiqueta", one, key, "reabrir", "Eve").collect(), *decisions.entry(spark, "etiqueta", new, key, "agregar", "Eve", role="parcial").collect()], decisions.LOG)
    now = decisions.apply_log(labels, more, "etiqueta", key)
    r = now.where("evidencia = 'F01-P001' AND nodo = 'C01'").first()
    assert (r.estado, r.validado_por) == ("validada", None)  # an extracted label
    r = now.where("origen = 'manual'").first()
    assert (r.evidencia, r.rol, r.estado, r.validado_por) == ("F01-P004", "parcial", "validada", "Eve") and decisions.audit(more, 2).count() == 2
    for bad in (("validate", "Ada"), ("validar", "  ")):
        with pytest.raises(decisions.InvalidDecision):
            decisions.check(*bad)
    with pytest.raises(decisions.InvalidDecision):
        decisions.entry(spark, "etiqueta", labels.where("false"), key, "validar", "Ada")


def test_norms_and_tags(spark, base):
    text = "Según el Acuerdo 012 del 5 de mayo de 2015 del Superior y la Resolución N° 345 de 2018. De acuerdo con el decreto 1330 de 2019. Acuerdo CESU 02 de 2020 Decreto 1330 de 2019 • Acuerdo 777 de 2010"
    assert [x[:3] for x in labelling.cited_norms(text)] == [("Acuerdo", 12, 2015), ("Resolución", 345, 2018), ("Acuerdo", 777, 2010)]
    ev = spark.createDataFrame([("A", text, 1), ("B", "special words; Acuerdo 012 de 2015", 2)], "codigo string, texto string, orden int")
    ex = spark.createDataFrame([("Acuerdo", 777, 2010)], "tipo string, numero int, anio int")
    manual = spark.createDataFrame([("Acuerdo", 9, 2001, "Consejo Superior", "special words")], "tipo string, numero int, anio int, organo string, texto_a_buscar string")
    norms, cited = labelling.load_norms(ev, ex, manual)
    assert {(r.numero, r.anio) for r in norms.collect()} == {(12, 2015), (345, 2018), (9, 2001)} and cited.count() == 4
    codes = spark.createDataFrame(list(enumerate(["DM25-PORTADA", "DM25-4.1.2", "DM25-OFERTA", "AX-46-03", "DM25-BIBLIOGRAFIA", "DM25-4", "X"])), "k int, codigo string")
    chains = {r.codigo: r.chain for r in labelling.ancestors(codes, "codigo", "k").collect()}
    assert chains["DM25-4.1.2"] == ["DM25-4.1.2", "DM25-4.1", "DM25-4"] and chains["DM25-OFERTA"][0] == "DM25-OFERTA" and chains["DM25-OFERTA"][1:] == chains["DM25-4.1.2"]
    assert chains["AX-46-03"] == ["AX-46-03", "AX-46"] and chains["DM25-BIBLIOGRAFIA"] == ["DM25-BIBLIOGRAFIA"] and chains["DM25-PORTADA"] == ["DM25-PORTADA"]
    tags = labelling.tag_by_rules(labelling.ancestors(codes, "codigo", "k"), "codigo", "chain", [(r"^DM25-4\.1", "C01", "parcial"), (r"^DM25-4$", "C02", "apoyo"), (r"4\.1$", "C01", "principal")])
    assert {(r.codigo, r.nodo, r.rol) for r in tags.collect()} == {("DM25-4.1.2", "C01", "parcial"), ("DM25-OFERTA", "C01", "parcial"), ("DM25-4", "C02", "apoyo")}
    slides = spark.createDataFrame([("F01", 1, 1, 1), ("F01", 2, 1, None), ("IF01", 3, 1, 1), ("IF01", 4, 9, 9)], "fuente string, pagina int, factor int, car int")
    assert {(r.evidencia, r.nodo) for r in labelling.header_labels(slides, base["nodo"]).collect()} == {("F01-P001", "C01"), ("F01-P002", "F01")}
    assert {(r.evidencia, r.nodo, r.rol, r.estado) for r in labelling.institutional_labels(slides, base["nodo"], base["correspondencia"]).collect()} == {("IF01-P003", "IC01", "principal", "validada"), ("IF01-P003", "C01", "parcial", "propuesta")}


def test_scoring(spark):
    courses = spark.createDataFrame([("Física", 7), ("Razonamiento Lógico", 2), ("Arte", 4)], "nombre string, periodo int")
    pads = spark.createDataFrame([("Física", "P1", "Calcular modelos", None), ("Arte", "P2", None, "en equipo y grupal, colaborativo, cooperativo")], "curso string, pad string, rea_general string, texto string")
    results = spark.createDataFrame([("Física", "P1", 1, "Resolver problemas")], "curso string, pad string, consecutivo int, texto string")
    exp = spark.createDataFrame([("Física", "P1", 1, "soluciona_problema", "Puente", "Diseño de experimentos", "Comunicación escrita")], "curso string, pad string, orden int, tipo string, nombre string, descripcion string, competencias string")
    act = spark.createDataFrame([("Física", "P1", "informe de laboratorio")], "curso string, pad string, texto string")
    got = {(r.curso, r.outcome): r for r in scoring.propose(courses, pads, results, exp, act).collect()}
    r = got["Física", "SO1"]
    assert (r.puntaje, r.nivel, r.origen) == (9, "E", "pad") and r.justificacion.startswith("P1 REA 1: «resolv»; P1 soluciona un problema: Puente")
    assert got["Razonamiento Lógico", "SO1"].origen == "nombre" and ("Física", "SO2") not in got and ("Arte", "SO5") not in got
    seed = spark.createDataFrame([("Física", "SO1", "validada"), ("Old", "SO2", "propuesta")], "curso string, outcome string, estado string")
    merged = scoring.merge_decided(scoring.propose(courses, pads, results, exp, act).select("curso", "outcome", "estado"), seed, ["curso", "outcome"], F.col("estado") != "propuesta")
    assert merged.where("curso = 'Física' AND outcome = 'SO1'").first().estado == "validada" and merged.where("curso = 'Old'").count() == 0


def test_redaction_and_export(spark, base, tmp_path):
    text = "Docente líder: Ana Ruiz\nmail ana.ruiz@uni.edu.co\nUsuario: pepe  Contraseña = x1y2\nhttp://plain.example\nNombre del profesor del curso\nMARIA Lopez Diaz\nend"
    ev = spark.createDataFrame([("A-1", "T", "anexo", text, "o", "f"), ("AX-46-03", "A · B · Ana", "anexo", "x", "o", "f")], "codigo string, titulo string, tipo string, texto string, texto_ocr string, archivo string")
    tables = spark.createDataFrame([("A-1", 1, [["Nombre", "Docente"], ["a", "b"]]), ("A-1", 2, [["Key", "a@b.co"]]), ("AX-46-03", 1, [["z"]])], "evidencia string, orden int, celdas array<array<string>>")
    pads = spark.createDataFrame([("P1", "write to a@b.co", None)], "codigo string, justificacion string, acciones string")
    e, t, p, n = redaction.redact(ev, tables, pads, [(r"^AX-46", "personal data")])
    rows = {r.codigo: r for r in e.collect()}
    assert rows["A-1"].texto == "Docente líder: [omitido]\nmail [correo omitido]\nUsuario: [omitido]  Contraseña = [omitido]\nhttp://plain.example\nNombre del profesor del curso\n[omitido]\nend"
    assert rows["AX-46-03"].titulo == "A · B · archivo 03" and "personal data" in rows["AX-46-03"].texto and rows["AX-46-03"].archivo is None
    assert [r.celdas for r in t.collect()] == [[["Key", "[correo omitido]"]]] and n.first().asDict() == {"evidencias_omitidas": 1, "tablas_quitadas": 2} and "@" not in p.first().justificacion
    doc = export.document(base, ("ABET-EAC",), version="compartir")
    html = export.page(doc | {"x": "</script>"}, "<a>{{DATA}}</a>{{SCRIPT}}")
    assert "</script>" not in html and export.publish(html) == html
    with pytest.raises(ValueError):
        export.publish("<html>")
    small = {k: base[k] for k in ("marco", "nodo", "curso_prerrequisito")}
    assert zipfile.ZipFile(io.BytesIO(export.to_zip(small))).namelist() == ["marco.csv", "nodo.csv"]
    assert export.to_csv(small, str(tmp_path / "csv")) == ["marco", "nodo"] and spark.read.csv(str(tmp_path / "csv/nodo"), header=True).count() == 11
    with pytest.raises(ValueError, match="write_document"):
        export.document(base, ("ABET-EAC",), most_rows=2)
    assert "matriz" in export.write_document({**base}, str(tmp_path / "doc"), ("ABET-EAC",)) and spark.read.json(str(tmp_path / "doc/nodos_ABET-EAC")).count() == base["nodo"].where("marco = 'ABET-EAC'").count()
    counters = export.write_shared(base, [("^F01-P001$", "why")], str(tmp_path / "shared")).first()
    assert counters.evidencias_omitidas == 1 and "Texto omitido" in spark.read.csv(str(tmp_path / "shared/evidencia"), header=True).where("codigo = 'F01-P001'").first().texto
    root = str(tmp_path / "snap")
    with pytest.raises(snapshot.SnapshotError):
        snapshot.read(spark, root)
    snapshot.write(spark, root, small)
    snapshot.write(spark, root, {"marco": base["marco"].limit(1), "nodo": base["nodo"]})
    assert snapshot.manifest(spark, root)["previous"] is not None and snapshot._numbers(spark, root) == [1, 2]
    back = snapshot.read(spark, root)
    assert back["marco"].count() == 1 and back["nodo"].count() == 11 and back["decision"].count() == 0
    views.create_views(base)
    assert spark.sql("SELECT sum(creditos) AS n FROM v_creditos_abet").first().n == 6
