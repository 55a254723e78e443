"""The sixteen views over an evidence base, each a function of its tables (see sources.schema for their columns).

Rows are joined by natural keys. Column names and order are the views' contract. Only views that promise an order sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.operators import analytics as an

Base = dict[str, DataFrame]
KEY = ["marco", "nodo"]

#: Areas with least and most credits; modules with least ECTS; ECTS and hours of a credit; contradictions from.
ATMAE_AREAS = [("educacion_general", 18, 36), ("matematicas", 6, 18), ("ciencias", 6, 18), ("gestion_tecnica", 42, 60), ("electivas", 0, 18)]
CIN_MODULES = [("basico", 60, 1), ("comun_agricola", 60, 2), ("tecnologia_especifica", 48, 3), ("tfg", 12, 4), ("transversal", 0, 5)]
ECTS, HOURS, TOLERANCE = 1.6, 48, 0.05


def live_labels(t: Base, without_scenario: bool = False) -> DataFrame:
    """Labels that are not discarded, of evidence that is not obsolete."""
    ev = t["evidencia"].where("estado_revision <> 'obsoleta'")
    if without_scenario:
        ev = ev.where(F.coalesce("nivel", F.lit("principal")) != "escenario")
    return t["evidencia_nodo"].where("estado <> 'descartada'").join(ev.select(F.col("codigo").alias("evidencia")), "evidencia", "left_semi")


def open_gaps(t: Base) -> DataFrame:
    return t["brecha"].where("estado <> 'cerrada'")


def nodes(t: Base, framework: str) -> DataFrame:
    return t["nodo"].where(F.col("marco") == framework).withColumnRenamed("codigo", "nodo")


def coverage(t: Base, framework: str) -> DataFrame:
    roles = {"principal": "principales", "parcial": "parciales", "apoyo": "apoyo"}
    out = an.role_coverage(nodes(t, framework), live_labels(t).where(F.col("marco") == framework), open_gaps(t).where(F.col("marco") == framework), KEY, "rol", roles, "brechas_abiertas")
    return out.orderBy("orden", "nodo").select(F.col("nodo").alias("codigo"), "nombre", "tipo", *roles.values(), "brechas_abiertas")


def v_cobertura_abet(t: Base) -> DataFrame:
    return coverage(t, "ABET-EAC")


def v_cobertura_atmae(t: Base) -> DataFrame:
    return coverage(t, "ATMAE-2027")


def v_cobertura_aneca(t: Base) -> DataFrame:
    return coverage(t, "ANECA-EURACE")


def v_validacion_abet(t: Base) -> DataFrame:
    own = t["evidencia_nodo"].where("marco = 'ABET-EAC'")
    person = F.col("validado_por").isNotNull()
    n = an.state_counts(own, KEY, {"validadas_comite": (F.col("estado") == "validada") & person, "propuestas": F.col("estado") == "propuesta", "descartadas": F.col("estado") == "descartada", "manuales": F.col("origen") == "manual"})
    cols = ["validadas_comite", "propuestas", "descartadas", "manuales"]
    return nodes(t, "ABET-EAC").join(n, KEY, "left").fillna(0, cols).orderBy("orden", "nodo").select(F.col("nodo").alias("codigo"), "nombre", "orden", *cols)


def v_creditos_abet(t: Base) -> DataFrame:
    return an.totals_by(t["curso"], ["categoria_abet"], "creditos", "creditos", "cursos")


def _with_bounds(t: Base, rows: list, schema: str, key: str, courses: DataFrame) -> DataFrame:
    return an.totals_vs_bounds(courses.sparkSession.createDataFrame(rows, schema), courses, key, "creditos", "creditos", "cursos")


def v_creditos_atmae(t: Base) -> DataFrame:
    c = F.col("categoria_atmae")
    area = F.when(c.isin("ciencias_fisicas", "ciencias_vida"), "ciencias").when(c.isin("gestion", "tecnica"), "gestion_tecnica").otherwise(c)
    out = _with_bounds(t, ATMAE_AREAS, "area string, minimo int, maximo int", "area", t["curso"].withColumn("area", area))
    return out.orderBy(F.desc("minimo"), "area").select("area", "creditos", "cursos", "minimo", "maximo")


def v_creditos_aneca(t: Base) -> DataFrame:
    out = _with_bounds(t, CIN_MODULES, "modulo string, minimo_ects int, orden int", "modulo", t["curso"].withColumnRenamed("modulo_cin", "modulo"))
    return out.orderBy("orden").select("modulo", "creditos", F.round(F.col("creditos") * F.lit(ECTS).cast("double")).alias("ects"), "cursos", "minimo_ects")


def v_inconsistencias(t: Base) -> DataFrame:
    m = t["medicion"].select("id", "indicador", "periodo", "sede", "desagregacion", "valor", F.col("evidencia").alias("fuente"))
    pairs = an.contradictions(m, ["indicador", "periodo", "sede", "desagregacion"], "id", "valor", TOLERANCE, ["fuente"])
    named = pairs.join(t["indicador"].select(F.col("codigo").alias("indicador"), "nombre"), "indicador")
    return named.select(F.col("indicador").alias("codigo"), "nombre", "periodo", "sede", "valor_a", "fuente_a", "valor_b", "fuente_b")


def v_pad_curso(t: Base) -> DataFrame:
    n = t["pad_actividad"].groupBy("pad").agg(F.count("*").alias("actividades"))
    p = t["pad"].select(F.col("codigo").alias("pad"), "curso", F.col("creditos").alias("creditos_pad"), "semestre")
    out = t["curso"].select(F.col("nombre").alias("curso"), F.col("creditos").alias("creditos_plan")).join(p, "curso", "left").join(n, "pad", "left")
    state = an.plan_status(F.col("creditos_plan"), F.col("creditos_pad"), F.col("pad").isNotNull(), "sin PAD", "créditos distintos", "ok")
    return out.orderBy("semestre", "curso").select("curso", "creditos_plan", "pad", "creditos_pad", "semestre", F.coalesce("actividades", F.lit(0)).alias("actividades"), state.alias("estado"))


def _activities(t: Base) -> DataFrame:
    x = t["pad_experiencia"].select("pad", F.col("orden").alias("experiencia_orden"), F.col("nombre").alias("experiencia"))
    return t["pad_actividad"].withColumnRenamed("nombre", "actividad").join(x, ["pad", "experiencia_orden"]).join(t["pad"].select(F.col("codigo").alias("pad"), F.col("nombre").alias("curso")), "pad")


def v_pad_lugar(t: Base) -> DataFrame:
    return an.unnest(_activities(t), "lugares", "lugar", ["pad", "curso", "actividad"])


def v_pad_instrumento(t: Base) -> DataFrame:
    out = an.unnest(_activities(t), "instrumentos", "instrumento", ["pad", "curso", "experiencia", "actividad", "descripcion_instrumentos"])
    return out.select("pad", "curso", "experiencia", "actividad", "instrumento", "descripcion_instrumentos")


def v_plan_2025_inconsistencias(t: Base) -> DataFrame:
    hours, shares = F.col("horas_total") != F.col("creditos") * HOURS, F.col("creditos_distribucion") != F.col("creditos")
    text = F.concat(
        F.when(hours, F.concat(F.lit("horas totales "), "horas_total", F.lit(" ≠ "), "creditos", F.lit(f" créditos × {HOURS}; "))).otherwise(""),
        F.when(shares, F.concat(F.lit("la tabla de distribución de CADI dice "), "creditos_distribucion", F.lit(" créditos"))).otherwise(""),
    )
    return t["plan_2025"].where(hours | shares).select("periodo", "nombre", "creditos", "horas_total", "creditos_distribucion", F.trim(text).alias("problema"))


def _valued(t: Base, framework: str, weight: str, score: str, without_scenario: bool) -> DataFrame:
    """Characteristics of a framework with factor, weight, score and number of evidences."""
    own = nodes(t, framework)
    factor = own.select("marco", F.col("nodo").alias("padre"), F.col("nombre").alias("factor_nombre"))
    out = own.where("tipo = 'caracteristica'").join(factor, ["marco", "padre"]).withColumn("factor", F.col("padre"))
    for indicator, name in ((weight, "ponderacion"), (score, "valoracion")):
        found = an.first_value_by(t["medicion"].where(F.col("indicador") == indicator), ["desagregacion"], "valor", "id", name)
        out = out.join(found.withColumnRenamed("desagregacion", "nodo"), "nodo", "left")
    n = live_labels(t, without_scenario).where(F.col("marco") == framework).groupBy("nodo").agg(F.count_distinct("evidencia").alias("evidencias"))
    return out.join(n, "nodo", "left").fillna(0, ["evidencias"])


def v_valoracion_cna(t: Base) -> DataFrame:
    edges = t["correspondencia"].where("marco_origen = 'CNA' AND estado <> 'descartada' AND tipo IN ('equivalente', 'parcial')")
    gaps = open_gaps(t).select(F.col("marco").alias("gm"), F.col("nodo").alias("gn"), "severidad", F.col("id").alias("gap"))
    sig = an.signals(edges, gaps, ["origen"], ["marco_destino", "destino"], ["gm", "gn"], "gap", F.col("severidad"), {"alta": "senales_altas", "media": "senales_medias"})
    own = open_gaps(t).where("marco = 'CNA'").groupBy("nodo").agg(F.count("*").alias("g"))
    val = _valued(t, "CNA", "CNA_POND", "CNA_VAL", True).join(sig.withColumnRenamed("origen", "nodo"), "nodo", "left").join(own, "nodo", "left").join(own.select(F.col("nodo").alias("padre"), F.col("g").alias("h")), "padre", "left").fillna(0, ["senales_altas", "senales_medias", "g", "h"])
    return val.orderBy("orden", "nodo").select(
        F.col("nodo").alias("codigo"), "nombre", "factor", "factor_nombre", "ponderacion", "valoracion", an.band(F.col("valoracion")).alias("grado"), "evidencias", "senales_altas", "senales_medias",
        (F.col("g") + F.col("h")).alias("brechas_cna"), an.over_rating_risk(F.col("valoracion"), F.col("senales_altas")).alias("riesgo_sobrevaloracion"),
    )


def v_valoracion_cna_inst(t: Base) -> DataFrame:
    val = _valued(t, "CNA-INST", "CNA_INST_POND", "CNA_INST_VAL", False)
    return val.orderBy("orden", "nodo").select(F.col("nodo").alias("codigo"), "nombre", "factor", "factor_nombre", "ponderacion", "valoracion", "evidencias")


def v_cna_inst_programa(t: Base) -> DataFrame:
    edges = t["correspondencia"].where("marco_origen = 'CNA-INST' AND marco_destino = 'CNA' AND estado <> 'descartada'").select(F.col("origen").alias("inst"), F.col("destino").alias("programa"), "tipo")

    def side(framework: str, key: str, view: Callable[[Base], DataFrame], score: str) -> DataFrame:
        scores = view(t).select(F.col("codigo").alias(key), F.col("valoracion").alias(score))
        return nodes(t, framework).select(F.col("nodo").alias(key), F.col("nombre").alias(f"{key}_nombre")).join(scores, key, "left")

    out = edges.join(side("CNA-INST", "inst", v_valoracion_cna_inst, "val_inst"), "inst").join(side("CNA", "programa", v_valoracion_cna, "val_programa"), "programa")
    gap = F.col("val_programa") - F.col("val_inst")
    return out.orderBy(F.abs(gap).desc_nulls_last(), "inst", "programa").select("inst", "inst_nombre", "val_inst", "programa", "programa_nombre", "val_programa", "tipo", F.round(gap, 1).alias("diferencia"))


def v_valoracion_sofia(t: Base) -> DataFrame:
    own = t["nodo"].where("marco = 'SOFIA'").select(F.col("codigo").alias("top"), "padre", "nombre", "orden")
    members = an.self_and_children(own, ["top"], ["padre"]).withColumnRenamed("m_top", "nodo")
    edges = t["correspondencia"].where("marco_origen = 'CNA-INST' AND marco_destino = 'SOFIA' AND estado <> 'descartada' AND tipo IN ('equivalente', 'parcial')").select("origen", F.col("destino").alias("nodo"))
    inst = members.join(edges, "nodo").select("top", F.col("origen").alias("codigo")).distinct()
    scored = inst.join(v_valoracion_cna_inst(t).select("codigo", "valoracion"), "codigo", "left")
    shown = F.concat("codigo", F.lit("="), F.coalesce(F.col("valoracion").cast("string"), F.lit("s.d.")))
    val = scored.groupBy("top").agg(F.round(F.avg("valoracion"), 2).alias("valoracion_inst"), F.min("valoracion").alias("minima_inst"), an.ordered_list(shown, ["codigo"], " ").alias("caracteristicas"))
    ev = members.join(live_labels(t).where("marco = 'SOFIA'"), "nodo").groupBy("top").agg(F.count_distinct("evidencia").alias("evidencias"))
    gap = members.join(open_gaps(t).where("marco = 'SOFIA'"), "nodo").groupBy("top").agg(an.count_if(F.col("severidad").isin("alta", "media")).alias("brechas_media_alta"), F.count("*").alias("brechas"))
    out = own.where("padre IS NULL").join(val, "top", "left").join(ev, "top", "left").join(gap, "top", "left").fillna(0, ["evidencias", "brechas_media_alta", "brechas"])
    return out.orderBy("orden", "top").select(F.col("top").alias("codigo"), "nombre", "valoracion_inst", "minima_inst", "caracteristicas", "evidencias", "brechas_media_alta", "brechas")


VIEWS: dict[str, Callable[[Base], DataFrame]] = {f.__name__: f for f in (
    v_cobertura_abet, v_cobertura_atmae, v_cobertura_aneca, v_validacion_abet, v_creditos_abet, v_creditos_atmae, v_creditos_aneca, v_inconsistencias, v_pad_curso, v_pad_lugar, v_pad_instrumento,
    v_plan_2025_inconsistencias, v_valoracion_cna, v_valoracion_cna_inst, v_cna_inst_programa, v_valoracion_sofia,
)}


def create_views(t: Base) -> None:
    """Make every table and view available to spark.sql by its name."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(t).createOrReplaceTempView(name)


# --- Queries of the public surface over a base -------------------------------------------------------------------------


def node_details(t: Base, framework: str) -> DataFrame:
    """Nodes with their parent and nested lists: evidences by strength, source edges, gaps, indicators. One join a list."""
    from attestra.functions.roles import weakness

    ev = t["evidencia"].select(F.col("codigo").alias("evidencia"), "titulo", F.col("tipo").alias("tipo_evidencia"))
    labels = live_labels(t).where(F.col("marco") == framework).join(ev, "evidencia").withColumn("w", weakness(F.col("rol")))
    out = nodes(t, framework)
    lists = {
        "evidencias": labels.groupBy("nodo").agg(an.nested(["w", "evidencia"], ["evidencia", "titulo", "tipo_evidencia", "rol", "origen", "estado"]).alias("evidencias")),
        "correspondencias": t["correspondencia"].where(F.col("marco_destino") == framework).groupBy(F.col("destino").alias("nodo")).agg(an.nested(["marco_origen", "origen"], ["marco_origen", "origen", "tipo", "estado", "nota"]).alias("correspondencias")),
        "brechas": t["brecha"].where(F.col("marco") == framework).groupBy("nodo").agg(an.nested(["id"], ["titulo", "severidad", "estado"]).alias("brechas")),
        "indicadores": t["indicador_nodo"].where(F.col("marco") == framework).groupBy("nodo").agg(an.nested(["indicador"], ["indicador", "rol"]).alias("indicadores")),
    }
    for part in lists.values():
        out = out.join(part, "nodo", "left")
    return out.orderBy("orden", "nodo")


#: Fixed value: what leads what OCR adds to a text.
OCR_LEAD = "\n[Texto en imágenes (OCR)]\n"


def evidence_feed(t: Base, text: int = 2200, ocr: int = 800) -> DataFrame:
    """Evidence that is not obsolete with its text cut, what OCR adds, and all its labels."""
    tags = t["evidencia_nodo"].groupBy("evidencia").agg(an.nested(["marco", "nodo"], ["marco", "nodo", "rol", "estado"]).alias("etiquetas"))
    said = F.concat(F.substring(F.coalesce("texto", F.lit("")), 1, text), F.when(F.col("texto_ocr").isNotNull(), F.concat(F.lit(OCR_LEAD), F.substring("texto_ocr", 1, ocr))).otherwise(""))
    ev = t["evidencia"].where("estado_revision <> 'obsoleta'")
    return ev.select(F.col("codigo").alias("evidencia"), "titulo", "tipo", "archivo", "pagina", "sede", said.alias("texto")).join(tags, "evidencia", "left").orderBy("evidencia")


def indicator_series(t: Base) -> DataFrame:
    series = t["medicion"].groupBy(F.col("indicador").alias("codigo")).agg(an.nested(["id"], ["periodo", "sede", "valor", "desagregacion", "evidencia"]).alias("serie"))
    return t["indicador"].join(series, "codigo", "left").orderBy("codigo")


def norms_cited(t: Base) -> DataFrame:
    key = ["tipo", "numero", "anio"]
    cited = t["normativa_mencion"].groupBy(*key).agg(an.ordered_list(F.col("evidencia"), ["evidencia"]).alias("evidencias"))
    return t["normativa"].join(cited, key).orderBy(F.desc("anio"), "tipo", "numero")


def gaps_by_severity(t: Base) -> DataFrame:
    rank = F.when(F.col("severidad") == "alta", 0).when(F.col("severidad") == "media", 1).otherwise(2)
    return t["brecha"].orderBy(rank, "marco", "nodo", "id")


def course_matrix(t: Base) -> DataFrame:
    names = t["nodo"].where("marco = 'ABET-EAC'").select(F.col("codigo").alias("outcome"), F.col("nombre").alias("outcome_nombre"))
    courses = t["curso"].select(F.col("nombre").alias("curso"), "periodo", "numero")
    return t["curso_outcome"].join(courses, "curso").join(names, "outcome").orderBy("periodo", "numero", "outcome")


def study_route(t: Base) -> DataFrame:
    """Courses with prerequisites, first plan and outcomes (those a person confirmed are ticked)."""
    pre = t["curso_prerrequisito"].groupBy("curso").agg(an.ordered_list(F.col("requisito"), ["requisito"]).alias("requisitos"))
    pad = t["pad"].groupBy("curso").agg(F.min("codigo").alias("pad"))
    shown = F.concat("outcome", F.when(F.col("estado") == "validada", " ✓").otherwise(""))
    outcomes = t["curso_outcome"].where("estado <> 'descartada'").groupBy("curso").agg(an.ordered_list(shown, ["outcome"]).alias("outcomes"))
    c = t["curso"].withColumnRenamed("nombre", "curso")
    return c.join(pre, "curso", "left").join(pad, "curso", "left").join(outcomes, "curso", "left").orderBy("periodo", "numero")


def factor_scores(t: Base, indicators: tuple[str, ...] = ("CNA_VAL", "CNA_POND")) -> DataFrame:
    return an.pivot_scores(t["medicion"].where(F.col("indicador").isin(*indicators)), ["desagregacion"], "indicador", "valor", indicators, "id").orderBy("desagregacion")


def pending(t: Base) -> DataFrame:
    """Counts for a start page: proposed edges and labels, evidences without any ABET label, decisions."""
    from attestra.operators.search import without

    bare = without(t["evidencia"].where("estado_revision <> 'obsoleta'").withColumnRenamed("codigo", "evidencia"), t["evidencia_nodo"].where("marco = 'ABET-EAC'"), ["evidencia"])
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(t["correspondencia"].where("estado = 'propuesta'"), "correspondencias").crossJoin(n(t["evidencia_nodo"].where("estado = 'propuesta'"), "etiquetas")).crossJoin(n(bare, "sin_abet")).crossJoin(n(t["decision"], "decisiones"))


def chart_series(t: Base, evidence: Column | str) -> DataFrame:
    """Series of an evidence's charts as 'category=value' texts."""
    rows = t["grafica"].where(F.col("evidencia") == evidence)
    return rows.groupBy("orden", "titulo", "serie_orden", "serie").agg(an.ordered_list(F.concat("categoria", F.lit("="), F.col("valor").cast("string")), ["punto_orden"]).alias("puntos")).orderBy("orden", "serie_orden")


# --- Lists and details of the public surface ---------------------------------------------------------------------------


def edge_list(t: Base, equal: dict[str, object] | None = None, text: str = "") -> DataFrame:
    """Correspondences with the names of both ends, by optional equal columns and a text in names or note."""
    from attestra.operators.search import matches

    names = lambda end: t["nodo"].select(F.col("marco").alias(f"marco_{end}"), F.col("codigo").alias(end), F.col("nombre").alias(f"{end}_nombre"))
    edges = matches(t["correspondencia"], equal).join(names("origen"), ["marco_origen", "origen"]).join(names("destino"), ["marco_destino", "destino"])
    return matches(edges, None, text, ["origen_nombre", "destino_nombre", "nota"])


def label_list(t: Base, equal: dict[str, object] | None = None, text: str = "") -> DataFrame:
    """Labels with their evidence's title and their node's name, by optional equal columns and a text in the evidence."""
    from attestra.operators.search import matches

    ev = matches(t["evidencia"], None, text, ["codigo", "titulo", "texto"]).select(F.col("codigo").alias("evidencia"), "titulo")
    named = t["nodo"].select("marco", F.col("codigo").alias("nodo"), F.col("nombre").alias("nodo_nombre"))
    return matches(t["evidencia_nodo"], equal).join(ev, "evidencia").join(named, KEY)


def evidence_list(t: Base, equal: dict[str, object] | None = None, text: str = "") -> DataFrame:
    """Evidence with the number of labels that stand, by optional equal columns and a text in it or in what OCR adds."""
    from attestra.operators.search import matches

    n = t["evidencia_nodo"].where("estado <> 'descartada'").groupBy(F.col("evidencia").alias("codigo")).agg(F.count("*").alias("etiquetas"))
    return matches(t["evidencia"], equal, text, ["codigo", "titulo", "texto", "texto_ocr"]).join(n, "codigo", "left").fillna(0, ["etiquetas"])


def pad_list(t: Base, text: str = "", also: Column | None = None) -> DataFrame:
    """Course plans whose text, experiences or activities hold a text, and those that meet another condition."""
    from attestra.operators.search import exists_in_any

    holds = lambda c: F.col(c).contains(text) if not text else F.coalesce(F.ilike(F.col(c), F.lit("%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%")), F.lit(False))
    own = [holds("texto"), *([also] if also is not None else [])]
    details = [(t[name].select(F.col("pad").alias("codigo"), "nombre"), holds("nombre")) for name in ("pad_experiencia", "pad_actividad")]
    return exists_in_any(t["pad"], ["codigo"], own, details)


def courses_sorted(t: Base) -> DataFrame:
    return t["curso"].withColumnRenamed("nombre", "curso").orderBy("periodo", "numero")


def courses_without_plan(t: Base) -> DataFrame:
    return t["curso"].withColumnRenamed("nombre", "curso").join(t["pad"].select("curso"), "curso", "left_anti").orderBy("periodo", "curso")


def program_outcomes(t: Base, framework: str = "ABET-EAC") -> DataFrame:
    """Outcomes of a framework with the number of courses that are said to reach them."""
    n = t["curso_outcome"].where("estado <> 'descartada'").groupBy(F.col("outcome").alias("codigo")).agg(F.count("*").alias("cursos"))
    own = t["nodo"].where((F.col("marco") == framework) & (F.col("tipo") == "outcome"))
    return own.join(n, "codigo", "left").fillna(0, ["cursos"]).orderBy("orden")


def plan_details(t: Base) -> DataFrame:
    """Course plans with their course and nested lists: experiences with their activities, outcomes. One join a list."""
    acts = t["pad_actividad"].groupBy("pad", F.col("experiencia_orden").alias("orden")).agg(an.nested(["orden"], ["orden", "nombre", "etapa", "semana_inicio", "lugares", "instrumentos"]).alias("actividades"))
    each = t["pad_experiencia"].join(acts, ["pad", "orden"], "left").withColumn("actividades", F.coalesce("actividades", F.array()))
    experiences = each.groupBy("pad").agg(an.nested(["orden"], ["orden", "nombre", "tipo", "actividades"]).alias("experiencias"))
    outcomes = t["curso_outcome"].where("estado <> 'descartada'").groupBy("curso").agg(an.nested(["outcome", "nivel"], ["outcome", "nivel", "estado"]).alias("outcomes"))
    p = t["pad"].select(F.col("codigo").alias("pad"), "nombre", F.col("curso").alias("__curso"), "semestre", "texto")
    c = t["curso"].select(F.col("nombre").alias("curso"), "periodo", F.col("creditos").alias("creditos_plan"))
    out = p.join(c, F.col("__curso") == F.col("curso"), "left").join(experiences, "pad", "left").join(outcomes.withColumnRenamed("curso", "__o"), F.col("__curso") == F.col("__o"), "left")
    return out.drop("__curso", "__o").orderBy("pad")


def evidence_details(t: Base) -> DataFrame:
    """Evidence with its labels (and their nodes' names) and the number of its charts' points."""
    named = t["nodo"].select("marco", F.col("codigo").alias("nodo"), "nombre")
    tags = t["evidencia_nodo"].join(named, KEY).groupBy("evidencia").agg(an.nested(["marco", "nodo", "rol"], ["marco", "nodo", "nombre", "rol", "origen", "estado", "validado_por"]).alias("etiquetas"))
    points = t["grafica"].groupBy("evidencia").agg(F.count("*").alias("puntos"))
    return t["evidencia"].withColumnRenamed("codigo", "evidencia").join(tags, "evidencia", "left").join(points, "evidencia", "left").fillna(0, ["puntos"])


def accreditor_cards(t: Base, cards: DataFrame) -> DataFrame:
    """Cards (marco and any other columns) with estructura: the nodes of their framework in order."""
    n = t["nodo"].withColumn("__o", F.coalesce("orden", F.lit(-1)))
    own = n.groupBy("marco").agg(an.nested(["__o", "codigo"], ["codigo", "nombre", "tipo", "padre", "descripcion"]).alias("estructura"))
    return cards.join(own, "marco", "left").withColumn("estructura", F.coalesce("estructura", F.array()))
