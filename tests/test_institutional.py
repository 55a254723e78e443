"""Institutional plans from layout text, configuration and older bases; all texts are invented."""

import pytest
from pyspark.sql import functions as F

from attestra.operators import institutional as inst
from attestra.sources import config, schema, snapshot

PLAN = """\
                 INFORMACIÓN GENERAL DEL CAI
Código del CAI      CAI1002020201
Nombre del CAI      Lectura de textos largos      Créditos: 2
Ubicación Semestral     Segundo semestre
Prerrequisitos (si aplica)      Ninguno de ellos
REA GENERAL *
   Estructura
   Reads long texts and
   writes short ones.
\f  CONSECUTIVO   REA ESPECÍFICO
  1   Finds the main thought of a long text
      and says it in own words
  2   short one
  3   Compares two texts on one question
  PARA EL LOGRO
Experiencia: El primer viaje      Semestre 3
   something below
DESCRIPCIÓN Experiencia: not this one
   nor that
Experiencia/Problema/Comportamiento:
   Un mapa del barrio      9 hours
Nombre de la   EL PRIMER VIAJE
   Experiencia
Nombre de la   Otra salida.
   Experiencia
Experience name: Description of it
"""
OTHER = "Learning Field   Clear Speech\nSemester: IV\nCredits\n   of this course\n   3 each\nGeneral Learning Outcome\n General\n Speaks in front of a group of people\n Specific\n"


def _read(spark, texts):
    rows = spark.createDataFrame([(f"{k}.pdf", t) for k, t in enumerate(texts)], "archivo string, texto string")
    return {r.archivo: r for r in inst.read_plans(rows).collect()}


def test_fields_of_layout_text(spark):
    got = _read(spark, [PLAN, OTHER, "x" * 1500 + PLAN, None, ""])
    assert set(got) == {"0.pdf", "1.pdf"}
    r = got["0.pdf"]
    assert (r.codigo_pdf, r.nombre, r.semestre, r.creditos, r.prerrequisitos) == ("CAI1002020201", "Lectura de textos largos", 2, 2, "Ninguno de ellos")
    assert r.rea_general == "Reads long texts and writes short ones"
    assert [tuple(x) for x in r.rea] == [(1, "Finds the main thought of a long text and says it in own words"), (3, "Compares two texts on one question")]
    assert [x.nombre for x in r.experiencias] == ["El primer viaje", "Un mapa del barrio", "Otra salida"] and {x.tipo for x in r.experiencias} == {"vive_experiencia"}
    o = got["1.pdf"]
    assert (o.codigo_pdf, o.nombre, o.semestre, o.creditos, o.rea_general, o.rea, o.experiencias) == (None, "Clear Speech", 4, 3, "Speaks in front of a group of people", [], [])


@pytest.mark.parametrize(("said", "semester"), [("Semestre: __5__", 5), ("Semestre: séptimo u octavo", 7), ("Ubicación  semestral  VIII", 8), ("Semestre: unknown", None), ("nothing", None), ("Semestre:\n\n  tercer", 3)])
def test_semesters(spark, said, semester):
    assert spark.createDataFrame([(said,)], "t string").select(inst.semester(F.col("t"))).first()[0] == semester


def test_outcome_without_number_opens_the_first(spark):
    text = "REA ESPECÍFICOS\n\n   An outcome that has no number at all\n   in two lines\n2 And a second one that has its number\nDESCRIPCIÓN"
    got = spark.createDataFrame([(text,)], "t string").select(inst.specific_outcomes(F.col("t"))).first()[0]
    assert [tuple(x) for x in got] == [(1, "An outcome that has no number at all in two lines"), (2, "And a second one that has its number")]


def test_only_gaps_are_filled(spark):
    kind = f"codigo string, archivo string, {inst.FIELDS.replace('nombre:string>>', 'nombre:string,dimensiones:array<string>,rea:int>>')}, extra int"
    rows = [("PAD-X", "0.pdf", None, "PAD_lectura V2", None, 7, "", None, [], None, 1), ("Y", "0.pdf", "CAI9", "Own name", 1, None, "Own", "Own", [(1, "own")], [("t", "own", ["d"], 2)], 2),
            ("CAD123", "0.pdf", None, None, None, None, None, None, None, None, 3), ("Z", "9.pdf", None, None, None, None, None, None, None, None, 4), (None, "1.pdf", None, None, None, None, None, None, None, None, 5)]
    texts = spark.createDataFrame([("0.pdf", PLAN), ("1.pdf", OTHER), ("2.pdf", PLAN)], "archivo string, texto string")
    done = inst.complement_plans(spark.createDataFrame(rows, kind), texts)
    got = {r.extra: r for r in done.collect()}
    assert (got[1].codigo, got[1].nombre, got[1].semestre, got[1].creditos, got[1].prerrequisitos, got[1].tipo_campo) == ("CAI1002020201", "Lectura de textos largos", 2, 7, "Ninguno de ellos", "CAI")
    assert len(got[1].rea) == 2 and tuple(got[1].experiencias[0]) == ("vive_experiencia", "El primer viaje", [], None)
    assert tuple(got[2])[:9] == ("Y", "0.pdf", "CAI9", "Own name", 1, 2, "Own", "Own", [(1, "own")]) and got[2].experiencias[0].nombre == "own"
    assert got[3].tipo_campo is None and got[3].nombre is None and got[4].tipo_campo is None
    assert (got[5].nombre, got[5].semestre, got[5].tipo_campo) == ("Clear Speech", 4, "CAI")
    assert done.where("false").count() == 0 and inst.complement_plans(spark.createDataFrame([], kind), texts).count() == 0


def test_configuration(tmp_path, monkeypatch):
    monkeypatch.delenv(config.TOOLS_VARIABLE, raising=False)
    got = config.load(tmp_path / "none.toml")
    assert (got.pdf, got.recursos_ra, got.poppler) == (str(tmp_path / "datos/pdf"), None, None) and got.output("pads_json") == str(tmp_path / "salida/pads.json")
    (tmp_path / "a.toml").write_text('[rutas]\npdf = "/other/pdf"\nsalida = "s3a://shared/out"\npoppler = "bin"\n')
    got = config.load(tmp_path / "a.toml", pdf=None, semillas="/seeds")
    assert (got.pdf, got.semillas, got.poppler, got.output("csv")) == ("/other/pdf", "/seeds", str(tmp_path / "bin"), "s3a://shared/out/csv")
    monkeypatch.setenv(config.TOOLS_VARIABLE, "/tools")
    assert config.load(tmp_path / "a.toml", pdf="s3a://x/pdf").poppler == "/tools"
    with pytest.raises(ValueError, match="unknown"):
        config.load(tmp_path / "a.toml", wrong="x")


def test_older_bases(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "base")
    tables, backup = snapshot.open_base(spark, root)
    assert backup is None and set(tables) == set(schema.TABLES) and tables["nodo"].count() == 0
    small = {"marco": spark.createDataFrame([(1, "M", "Frame")], "id int, codigo string, nombre string"), "decision": spark.createDataFrame([], schema.TABLES["decision"])}
    for version, kept in ((2, 1), (schema.VERSION, 1), (1, 0)):
        monkeypatch.setattr(snapshot, "VERSION", version)
        name = snapshot.write(spark, root, small)
        monkeypatch.setattr(snapshot, "VERSION", schema.VERSION)
        tables, backup = snapshot.open_base(spark, root)
        assert tables["marco"].count() == kept and tables["pad"].count() == 0 and backup == (None if kept else name)
    monkeypatch.setattr(snapshot, "VERSION", schema.VERSION + 1)
    name = snapshot.write(spark, root, small)
    assert snapshot.open_base(spark, root, rebuild=True)[1] == name
    monkeypatch.setattr(snapshot, "VERSION", schema.VERSION)
    with pytest.raises(snapshot.SnapshotError, match="version"):
        snapshot.open_base(spark, root)
    assert spark.read.parquet(f"{root}/{name}/marco").count() == 1
