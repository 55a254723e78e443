"""The views and public queries of an evidence base, run on an invented base that the driver's tables are turned into.

Each table of the base is one SQL text that Spark and DuckDB both understand, so a query's SQL counterpart begins with the
same base and then says in plain SQL what the view must give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.operators import analytics as an
from attestra.operators import decisions, projection, reconcile, search
from attestra.sources import schema

from . import base, views
from .base import Tables

_N2 = "lpad(CAST({} AS STRING), 2, '0')"
_FRAMEWORKS = {"ABET-EAC": ("A", ("C4",)), "ATMAE-2027": ("T", ("A11",)), "ANECA-EURACE": ("E", ())}


def _nodes_sql() -> str:
    parts = []
    for marco, prefix in (("CNA", ""), ("CNA-INST", "I")):
        parts.append(f"SELECT '{marco}' AS marco, '{prefix}F' || {_N2.format('r_regionkey + 1')} AS codigo, r_name AS nombre, 'factor' AS tipo, CAST(NULL AS STRING) AS padre, CAST(r_regionkey * 100 AS INT) AS orden FROM {{region}}")
        parts.append(f"SELECT '{marco}', '{prefix}C' || {_N2.format('n_nationkey + 1')}, n_name, 'caracteristica', '{prefix}F' || {_N2.format('n_regionkey + 1')}, CAST(n_regionkey * 100 + n_nationkey + 1 AS INT) FROM {{nation}}")
    for marco, (letter, more) in _FRAMEWORKS.items():
        parts.append(f"SELECT '{marco}', '{letter}' || CAST(n_nationkey AS STRING), n_name, 'criterio', CAST(NULL AS STRING), CAST(n_nationkey AS INT) FROM {{nation}}")
        parts += [f"SELECT '{marco}', '{m}', 'node {m}', 'criterio', CAST(NULL AS STRING), 900 FROM {{region}} WHERE r_regionkey = 0" for m in more]
    parts.append("SELECT 'ABET-EAC', 'SO' || CAST(n_nationkey + 1 AS STRING), 'outcome ' || n_name, 'outcome', CAST(NULL AS STRING), CAST(100 + n_nationkey AS INT) FROM {nation} WHERE n_nationkey < 7")
    parts.append("SELECT 'SOFIA', 'SF' || CAST(r_regionkey AS STRING), r_name, 'estandar', CAST(NULL AS STRING), CAST(r_regionkey AS INT) FROM {region}")
    parts.append("SELECT 'SOFIA', 'SF' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING), n_name, 'apartado', 'SF' || CAST(n_regionkey AS STRING), CAST(100 + n_nationkey AS INT) FROM {nation}")
    return " UNION ALL ".join(parts)


def _edges_sql() -> str:
    row = "SELECT '{0}' AS marco_origen, {1} AS origen, '{2}' AS marco_destino, {3} AS destino, CASE (n_nationkey + {4}) % 3 WHEN 0 THEN 'equivalente' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS tipo, CASE (n_nationkey + {4}) % 4 WHEN 0 THEN 'descartada' WHEN 1 THEN 'validada' ELSE 'propuesta' END AS estado, 'note ' || CAST(n_nationkey AS STRING) AS nota, CASE WHEN (n_nationkey + {4}) % 4 = 1 THEN 'Ada' END AS validado_por FROM {{nation}}"
    cna, inst = f"'C' || {_N2.format('n_nationkey + 1')}", f"'IC' || {_N2.format('n_nationkey + 1')}"
    parts = []
    for marco, (letter, _) in _FRAMEWORKS.items():
        parts += [row.format("CNA", cna, marco, f"'{letter}' || CAST((n_nationkey * 3 + {k} * 7) % 25 AS STRING)", k) for k in range(2)]
    parts.append(row.format("CNA-INST", inst, "CNA", cna, 2))
    parts.append(row.format("CNA-INST", inst, "SOFIA", "'SF' || CAST(n_regionkey AS STRING) || '.' || CAST(n_nationkey AS STRING)", 3))
    parts.append(row.format("CNA", cna, "SOFIA", "'SF' || CAST(n_regionkey AS STRING)", 1))
    return " UNION ALL ".join(parts)


_LABEL = "SELECT 'D' || CAST(doc_id AS STRING) AS evidencia, '{0}' AS marco, {1} AS nodo, CASE (doc_id + {2}) % 3 WHEN 0 THEN 'principal' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS rol, '{3}' AS origen, CASE doc_id % {4} WHEN 0 THEN 'descartada' WHEN 1 THEN 'propuesta' ELSE 'validada' END AS estado, CASE WHEN doc_id % {4} = 2 THEN 'Ada' END AS validado_por FROM {{documents}} WHERE {5}"
_SCORE = "SELECT n_nationkey + {0} AS id, '{1}' AS indicador, '2022' AS periodo, 'Programa' AS sede, CAST({2} AS DOUBLE) / 10 AS valor, '{3}' || " + _N2.format("n_nationkey + 1") + " AS desagregacion, CAST(NULL AS STRING) AS evidencia FROM {{nation}} WHERE n_nationkey % 9 <> {4}"
_DOC = "'D' || CAST({} AS STRING)"

#: Every table of the invented base, in SQL over the driver's tables.
SQL: dict[str, str] = {
    "nodo": _nodes_sql(),
    "correspondencia": _edges_sql(),
    "evidencia": f"""SELECT {_DOC.format('doc_id')} AS codigo, substring(text, 1, 40) AS titulo, CASE WHEN doc_id % 7 = 0 THEN 'plan_mejora' WHEN doc_id % 11 = 0 THEN 'documento_maestro' ELSE 'diapositiva' END AS tipo, text AS texto,
CASE WHEN doc_id % 10 = 0 THEN lang || ' scanned words' END AS texto_ocr, source AS fuente, source || '.pdf' AS archivo, CAST(doc_id % 90 AS INT) AS pagina, lang AS sede,
CASE doc_id % 5 WHEN 0 THEN 'complementaria' WHEN 1 THEN 'escenario' WHEN 2 THEN 'principal' END AS nivel, CASE WHEN doc_id % 13 = 0 THEN 'obsoleta' ELSE 'sin_revisar' END AS estado_revision FROM {{documents}}""",
    "evidencia_nodo": " UNION ALL ".join([
        _LABEL.format("CNA", "'C' || " + _N2.format("doc_id % 25 + 1"), 0, "extraccion", 8, "doc_id % 17 <> 0"), _LABEL.format("CNA", "'F' || " + _N2.format("doc_id % 5 + 1"), 1, "extraccion", 9, "doc_id % 2 = 0"),
        _LABEL.format("ABET-EAC", "'A' || CAST(doc_id % 25 AS STRING)", 2, "manual", 6, "doc_id % 4 = 0"), _LABEL.format("ABET-EAC", "'A' || CAST(doc_id * 3 % 25 AS STRING)", 0, "inferida", 5, "doc_id % 4 = 1"),
        _LABEL.format("SOFIA", "'SF' || CAST(doc_id % 5 AS STRING)", 0, "manual", 7, "doc_id % 6 = 0"), _LABEL.format("CNA-INST", "'IC' || " + _N2.format("doc_id % 25 + 1"), 1, "extraccion", 8, "doc_id % 3 = 0"),
    ]),
    "indicador": "SELECT 'IND' || CAST(n_nationkey AS STRING) AS codigo, n_name AS nombre, 'count' AS unidad FROM {nation}",
    "indicador_nodo": "SELECT 'IND' || CAST(n_nationkey AS STRING) AS indicador, 'ABET-EAC' AS marco, 'A' || CAST(n_nationkey * 2 % 25 AS STRING) AS nodo, 'principal' AS rol FROM {nation}",
    "medicion": " UNION ALL ".join([
        _SCORE.format(1, "CNA_VAL", "35 + n_nationkey * 7 % 16", "C", 8), _SCORE.format(101, "CNA_POND", "300 + n_nationkey * 11 % 50", "C", 7), _SCORE.format(201, "CNA_INST_VAL", "34 + n_nationkey * 5 % 17", "IC", 6), _SCORE.format(301, "CNA_INST_POND", "200 + n_nationkey", "IC", 5),
        "SELECT c_custkey + 1000 AS id, 'IND' || CAST(c_nationkey AS STRING), c_mktsegment, 'S' || CAST(c_custkey % 40 AS STRING), CAST(CAST(floor(c_acctbal) AS BIGINT) % 4 AS DOUBLE) / 20, '', CASE WHEN c_custkey % 3 = 0 THEN 'D' || CAST(c_custkey % 100 AS STRING) END FROM {customer}",
    ]),
    "curso": "SELECT 'P' || CAST(p_partkey AS STRING) AS nombre, CAST(p_partkey AS INT) AS numero, CAST(p_size % 6 + 1 AS INT) AS creditos, CAST(p_size % 9 + 1 AS INT) AS periodo, p_type AS categoria_abet, CASE p_type WHEN 'SMALL' THEN 'ciencias_fisicas' WHEN 'LARGE' THEN 'ciencias_vida' WHEN 'PROMO' THEN 'gestion' WHEN 'MEDIUM' THEN 'matematicas' WHEN 'ECONOMY' THEN 'tecnica' ELSE 'electivas' END AS categoria_atmae, CASE p_partkey % 5 WHEN 0 THEN 'basico' WHEN 1 THEN 'comun_agricola' WHEN 2 THEN 'tfg' WHEN 3 THEN 'transversal' ELSE 'other' END AS modulo_cin FROM {part}",
    "curso_prerrequisito": "SELECT 'P' || CAST(p_partkey AS STRING) AS curso, 'P' || CAST(p_partkey - 1 AS STRING) AS requisito FROM {part} WHERE p_partkey % 4 = 0 UNION ALL SELECT 'P' || CAST(p_partkey AS STRING), 'P' || CAST(p_partkey - 2 AS STRING) FROM {part} WHERE p_partkey % 8 = 0",
    "curso_outcome": "SELECT 'P' || CAST(p_partkey AS STRING) AS curso, 'SO' || CAST(p_partkey % 7 + 1 AS STRING) AS outcome, CASE p_size % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'R' ELSE 'E' END AS nivel, CASE p_partkey % 5 WHEN 0 THEN 'validada' WHEN 1 THEN 'descartada' ELSE 'propuesta' END AS estado, 'pad' AS origen, CAST(p_size AS INT) AS puntaje FROM {part} WHERE p_partkey % 3 <> 1 UNION ALL SELECT 'P' || CAST(p_partkey AS STRING), 'SO7', 'I', 'propuesta', 'nombre', 0 FROM {part} WHERE p_partkey % 7 = 1",
    "brecha": "SELECT s_suppkey AS id, CASE s_suppkey % 5 WHEN 0 THEN 'CNA' WHEN 1 THEN 'ABET-EAC' WHEN 2 THEN 'ATMAE-2027' WHEN 3 THEN 'ANECA-EURACE' ELSE 'SOFIA' END AS marco, CASE s_suppkey % 5 WHEN 0 THEN (CASE WHEN s_suppkey % 2 = 0 THEN 'C' || lpad(CAST(s_nationkey + 1 AS STRING), 2, '0') ELSE 'F' || lpad(CAST(s_nationkey % 5 + 1 AS STRING), 2, '0') END) WHEN 1 THEN 'A' || CAST(s_nationkey AS STRING) WHEN 2 THEN 'T' || CAST(s_nationkey AS STRING) WHEN 3 THEN 'E' || CAST(s_nationkey AS STRING) ELSE 'SF' || CAST(s_nationkey % 5 AS STRING) END AS nodo, s_name AS titulo, CASE s_suppkey % 3 WHEN 0 THEN 'alta' WHEN 1 THEN 'media' ELSE 'baja' END AS severidad, CASE s_suppkey % 6 WHEN 0 THEN 'cerrada' WHEN 1 THEN 'en_curso' ELSE 'abierta' END AS estado FROM {supplier}",
    "normativa": "SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'Acuerdo' ELSE 'Resolución' END AS tipo, CAST(n_nationkey AS INT) AS numero, CAST(2000 + n_nationkey % 7 AS INT) AS anio, 'Rectoría' AS organo FROM {nation}",
    "normativa_mencion": "SELECT CASE WHEN doc_id % 20 % 2 = 0 THEN 'Acuerdo' ELSE 'Resolución' END AS tipo, CAST(doc_id % 20 AS INT) AS numero, CAST(2000 + doc_id % 20 % 7 AS INT) AS anio, 'D' || CAST(doc_id AS STRING) AS evidencia FROM {documents} WHERE doc_id % 6 = 1",
    "pad": "SELECT 'PAD' || CAST(p_partkey AS STRING) AS codigo, 'P' || CAST(p_partkey AS STRING) AS curso, p_name AS nombre, CAST(p_size % 10 + 1 AS INT) AS semestre, CASE WHEN p_partkey % 5 = 0 THEN CAST(NULL AS INT) ELSE CAST(p_size % 6 + 1 + (CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) AS INT) END AS creditos, p_name || ' ' || p_type AS texto, CAST(p_size AS INT) AS paginas FROM {part} WHERE p_partkey % 3 <> 0",
    "pad_experiencia": "SELECT 'PAD' || CAST(p_partkey AS STRING) AS pad, CAST(k AS INT) AS orden, p_brand || ' ' || CAST(k AS STRING) AS nombre, 'proyecto' AS tipo FROM {part}, (SELECT 0 AS k UNION ALL SELECT 1) WHERE p_partkey % 3 <> 0",
    "pad_actividad": "SELECT 'PAD' || CAST(l_partkey AS STRING) AS pad, CAST(l_linenumber % 2 AS INT) AS experiencia_orden, CAST(l_orderkey * 8 + l_linenumber AS INT) AS orden, 'act ' || CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) AS nombre, CASE l_linenumber WHEN 1 THEN split('lab;field', ';') WHEN 2 THEN split('room', ';') END AS lugares, CASE WHEN l_linenumber % 3 = 0 THEN split('rubric;test;essay', ';') END AS instrumentos, l_returnflag || ' described' AS descripcion_instrumentos FROM {lineitem} WHERE l_orderkey % 5 = 0",
    "plan_2025": "SELECT CAST(p_partkey AS INT) AS orden, CAST(p_size % 10 + 1 AS INT) AS periodo, p_name AS nombre, CAST(p_size % 6 + 1 AS INT) AS creditos, CAST((p_size % 6 + 1) * 48 + (CASE WHEN p_partkey % 3 = 0 THEN 8 ELSE 0 END) AS INT) AS horas_total, CASE WHEN p_partkey % 4 = 0 THEN CAST(2 AS INT) WHEN p_partkey % 4 = 1 THEN CAST(NULL AS INT) ELSE CAST(p_size % 6 + 1 AS INT) END AS creditos_distribucion FROM {part}",
    "grafica": "SELECT 'D' || CAST(user_id % 50 AS STRING) AS evidencia, 1 AS orden, 'chart' AS titulo, CAST(event_id % 3 AS INT) AS serie_orden, 's' || CAST(event_id % 3 AS STRING) AS serie, CAST(event_id AS INT) AS punto_orden, event_type AS categoria, floor(value) + 0.5 AS valor FROM {events}",
    "decision": "SELECT event_id, CASE WHEN event_type = 'click' THEN 'correspondencia' ELSE 'etiqueta' END AS objeto, 'D' || CAST(user_id AS STRING) || '|CNA|C' || lpad(CAST(user_id % 25 + 1 AS STRING), 2, '0') AS referencia, CASE event_type WHEN 'view' THEN 'validar' WHEN 'purchase' THEN 'descartar' ELSE 'reabrir' END AS accion, 'Ada' AS validador FROM {events}",
}
DRIVER = ("region", "nation", "customer", "supplier", "part", "lineitem", "events", "documents")


class Base(dict):
    """The tables of the invented base, built on demand and brought to the columns of the schema."""

    def __init__(self, t: Tables):
        super().__init__()
        self.tables = t

    def __missing__(self, name: str) -> DataFrame:
        spark, text = self.tables.spark, SQL[name]
        raw = spark.sql(text, **{d: self.tables[d] for d in DRIVER if "{" + d + "}" in text})
        self[name] = df = raw if name == "decision" else schema.conform(raw, name)
        return df


PRELUDE = "WITH " + ",\n".join(f"{name} AS ({text.format(**{d: d for d in DRIVER})})" for name, text in SQL.items()) + """,
vivas AS (SELECT en.* FROM evidencia_nodo en JOIN evidencia e ON e.codigo = en.evidencia WHERE en.estado <> 'descartada' AND e.estado_revision <> 'obsoleta'),
abiertas AS (SELECT * FROM brecha WHERE estado <> 'cerrada')"""


def on_base(sql: str | None = None, more: str = ""):
    """Register a function of the invented base; sql is what follows the base's common table expressions."""

    def add(f: Callable[[Base], DataFrame]):
        base.QUERIES[f.__name__] = lambda spark, sf_dir: f(Base(Tables(spark, sf_dir)))
        if sql:
            base.SQL[f.__name__] = PRELUDE + more + "\n" + sql
        return f

    return add


def _coverage_sql(marco: str) -> str:
    return f"""SELECT n.codigo, n.nombre, n.tipo, count(l.evidencia) FILTER (l.rol = 'principal') AS principales, count(l.evidencia) FILTER (l.rol = 'parcial') AS parciales, count(l.evidencia) FILTER (l.rol = 'apoyo') AS apoyo,
(SELECT count(*) FROM abiertas b WHERE b.marco = n.marco AND b.nodo = n.codigo) AS brechas_abiertas FROM nodo n LEFT JOIN vivas l ON l.marco = n.marco AND l.nodo = n.codigo WHERE n.marco = '{marco}' GROUP BY n.marco, n.codigo, n.nombre, n.tipo"""


def _valued_sql(name: str, marco: str, weight: str, score: str, scenario: str) -> str:
    one = "(SELECT min_by(m.valor, m.id) FROM medicion m WHERE m.indicador = '{}' AND m.desagregacion = n.codigo)"
    return f""",
{name} AS (SELECT n.codigo, n.nombre, p.codigo AS factor, p.nombre AS factor_nombre, {one.format(weight)} AS ponderacion, {one.format(score)} AS valoracion,
(SELECT count(DISTINCT l.evidencia) FROM vivas l JOIN evidencia e ON e.codigo = l.evidencia WHERE l.marco = n.marco AND l.nodo = n.codigo AND {scenario}) AS evidencias
FROM nodo n JOIN nodo p ON p.marco = n.marco AND p.codigo = n.padre WHERE n.marco = '{marco}' AND n.tipo = 'caracteristica')"""


_CNA = _valued_sql("cna", "CNA", "CNA_POND", "CNA_VAL", "coalesce(e.nivel, 'principal') <> 'escenario'")
_INST = _valued_sql("inst", "CNA-INST", "CNA_INST_POND", "CNA_INST_VAL", "true")
_SIGNAL = "(SELECT count(DISTINCT b.id) FROM correspondencia c JOIN abiertas b ON b.marco = c.marco_destino AND b.nodo = c.destino AND b.severidad = '{}' WHERE c.marco_origen = 'CNA' AND c.origen = cna.codigo AND c.estado <> 'descartada' AND c.tipo IN ('equivalente', 'parcial'))"
_BOUNDED = "SELECT b.*, CAST(coalesce(sum(c.creditos), 0) AS BIGINT) AS creditos, count(c.nombre) AS cursos FROM b LEFT JOIN c ON c.area = b.area GROUP BY ALL"

VIEW_SQL: dict[str, tuple[str, str]] = {
    "v_cobertura_abet": (_coverage_sql("ABET-EAC"), ""), "v_cobertura_atmae": (_coverage_sql("ATMAE-2027"), ""), "v_cobertura_aneca": (_coverage_sql("ANECA-EURACE"), ""),
    "v_validacion_abet": ("""SELECT n.codigo, n.nombre, n.orden, count(*) FILTER (l.estado = 'validada' AND l.validado_por IS NOT NULL) AS validadas_comite, count(*) FILTER (l.estado = 'propuesta') AS propuestas, count(*) FILTER (l.estado = 'descartada') AS descartadas, count(*) FILTER (l.origen = 'manual') AS manuales
FROM nodo n LEFT JOIN evidencia_nodo l ON l.marco = n.marco AND l.nodo = n.codigo WHERE n.marco = 'ABET-EAC' GROUP BY ALL""", ""),
    "v_creditos_abet": ("SELECT categoria_abet, CAST(sum(creditos) AS BIGINT) AS creditos, count(*) AS cursos FROM curso GROUP BY 1", ""),
    "v_creditos_atmae": ("SELECT area, creditos, cursos, minimo, maximo FROM s", f""",
b(area, minimo, maximo) AS (VALUES {', '.join(map(str, views.ATMAE_AREAS))}), c AS (SELECT nombre, creditos, CASE WHEN categoria_atmae LIKE 'ciencias%' THEN 'ciencias' WHEN categoria_atmae IN ('gestion', 'tecnica') THEN 'gestion_tecnica' ELSE categoria_atmae END AS area FROM curso), s AS ({_BOUNDED})"""),
    "v_creditos_aneca": ("SELECT area AS modulo, creditos, round(creditos * 1.6::DOUBLE) AS ects, cursos, minimo_ects FROM s", f""",
b(area, minimo_ects, orden) AS (VALUES {', '.join(map(str, views.CIN_MODULES))}), c AS (SELECT nombre, creditos, modulo_cin AS area FROM curso), s AS ({_BOUNDED})"""),
    "v_inconsistencias": ("""SELECT i.codigo, i.nombre, a.periodo, a.sede, a.valor AS valor_a, a.evidencia AS fuente_a, b.valor AS valor_b, b.evidencia AS fuente_b FROM medicion a JOIN medicion b
ON a.indicador = b.indicador AND a.periodo = b.periodo AND a.sede = b.sede AND a.desagregacion = b.desagregacion AND a.id < b.id AND abs(a.valor - b.valor) > 0.05 JOIN indicador i ON i.codigo = a.indicador""", ""),
    "v_pad_curso": ("""SELECT c.nombre AS curso, c.creditos AS creditos_plan, p.codigo AS pad, p.creditos AS creditos_pad, p.semestre, (SELECT count(*) FROM pad_actividad a WHERE a.pad = p.codigo) AS actividades,
CASE WHEN p.codigo IS NULL THEN 'sin PAD' WHEN p.creditos <> c.creditos THEN 'créditos distintos' ELSE 'ok' END AS estado FROM curso c LEFT JOIN pad p ON p.curso = c.nombre""", ""),
    "v_pad_lugar": ("SELECT a.pad, p.nombre AS curso, a.nombre AS actividad, unnest(a.lugares) AS lugar FROM pad_actividad a JOIN pad_experiencia x ON x.pad = a.pad AND x.orden = a.experiencia_orden JOIN pad p ON p.codigo = a.pad", ""),
    "v_pad_instrumento": ("SELECT a.pad, p.nombre AS curso, x.nombre AS experiencia, a.nombre AS actividad, unnest(a.instrumentos) AS instrumento, a.descripcion_instrumentos FROM pad_actividad a JOIN pad_experiencia x ON x.pad = a.pad AND x.orden = a.experiencia_orden JOIN pad p ON p.codigo = a.pad", ""),
    "v_plan_2025_inconsistencias": ("""SELECT periodo, nombre, creditos, horas_total, creditos_distribucion, trim(CASE WHEN horas_total <> creditos * 48 THEN 'horas totales ' || horas_total || ' ≠ ' || creditos || ' créditos × 48; ' ELSE '' END
|| CASE WHEN creditos_distribucion <> creditos THEN 'la tabla de distribución de CADI dice ' || creditos_distribucion || ' créditos' ELSE '' END) AS problema FROM plan_2025 WHERE horas_total <> creditos * 48 OR creditos_distribucion <> creditos""", ""),
    "v_valoracion_cna": (f"""SELECT *, CASE WHEN valoracion >= 4.5 AND senales_altas >= 2 THEN 'alto' WHEN valoracion >= 4.0 AND senales_altas >= 1 THEN 'medio' ELSE 'bajo' END AS riesgo_sobrevaloracion FROM (
SELECT codigo, nombre, factor, factor_nombre, ponderacion, valoracion, CASE WHEN valoracion >= 4.5 THEN 'Se cumple plenamente' WHEN valoracion >= 3.7 THEN 'Se cumple en alto grado' WHEN valoracion IS NULL THEN 'sin valoración' ELSE 'por debajo de 3,7' END AS grado, evidencias,
{_SIGNAL.format('alta')} AS senales_altas, {_SIGNAL.format('media')} AS senales_medias, (SELECT count(*) FROM abiertas b WHERE b.marco = 'CNA' AND b.nodo IN (cna.codigo, cna.factor)) AS brechas_cna FROM cna)""", _CNA),
    "v_valoracion_cna_inst": ("SELECT * FROM inst", _INST),
    "v_cna_inst_programa": ("""SELECT o.codigo AS inst, o.nombre AS inst_nombre, i.valoracion AS val_inst, d.codigo AS programa, d.nombre AS programa_nombre, p.valoracion AS val_programa, c.tipo, round(p.valoracion - i.valoracion, 1) AS diferencia FROM correspondencia c
JOIN nodo o ON o.marco = 'CNA-INST' AND o.codigo = c.origen JOIN nodo d ON d.marco = 'CNA' AND d.codigo = c.destino LEFT JOIN inst i ON i.codigo = o.codigo LEFT JOIN cna p ON p.codigo = d.codigo
WHERE c.marco_origen = 'CNA-INST' AND c.marco_destino = 'CNA' AND c.estado <> 'descartada'""", _CNA + _INST),
    "v_valoracion_sofia": ("""SELECT e.codigo, e.nombre, (SELECT round(avg(valoracion), 2) FROM si WHERE si.top = e.codigo) AS valoracion_inst, (SELECT min(valoracion) FROM si WHERE si.top = e.codigo) AS minima_inst,
(SELECT string_agg(codigo || '=' || coalesce(CAST(valoracion AS VARCHAR), 's.d.'), ' ' ORDER BY codigo) FROM si WHERE si.top = e.codigo) AS caracteristicas,
(SELECT count(DISTINCT l.evidencia) FROM ap JOIN vivas l ON l.marco = 'SOFIA' AND l.nodo = ap.nodo WHERE ap.top = e.codigo) AS evidencias,
(SELECT count(*) FROM ap JOIN abiertas b ON b.marco = 'SOFIA' AND b.nodo = ap.nodo WHERE ap.top = e.codigo AND b.severidad IN ('alta', 'media')) AS brechas_media_alta,
(SELECT count(*) FROM ap JOIN abiertas b ON b.marco = 'SOFIA' AND b.nodo = ap.nodo WHERE ap.top = e.codigo) AS brechas FROM nodo e WHERE e.marco = 'SOFIA' AND e.padre IS NULL""", _INST + """,
ap AS (SELECT e.codigo AS top, a.codigo AS nodo FROM nodo e JOIN nodo a ON a.marco = 'SOFIA' AND (a.codigo = e.codigo OR a.padre = e.codigo) WHERE e.marco = 'SOFIA' AND e.padre IS NULL),
si AS (SELECT DISTINCT ap.top, inst.codigo, inst.valoracion FROM ap JOIN correspondencia c ON c.marco_destino = 'SOFIA' AND c.destino = ap.nodo AND c.estado <> 'descartada' AND c.tipo IN ('equivalente', 'parcial') AND c.marco_origen = 'CNA-INST' JOIN inst ON inst.codigo = c.origen)"""),
}


def _register_views() -> None:
    for name, view in views.VIEWS.items():
        sql, more = VIEW_SQL[name]
        on_base(sql, more)(view)


_register_views()


def _said(rows: Column | str, *fields: str) -> Column:
    """An array of structs as one text, 'a/b/c' joined by ';'."""
    return F.array_join(F.transform(rows, lambda x: F.concat_ws("/", *[x[f].cast("string") for f in fields])), ";")


@on_base("""SELECT n.codigo AS nodo, n.padre,
(SELECT string_agg(l.evidencia || '/' || l.rol, ';' ORDER BY CASE l.rol WHEN 'principal' THEN 0 WHEN 'parcial' THEN 1 ELSE 2 END, l.evidencia) FROM vivas l WHERE l.marco = n.marco AND l.nodo = n.codigo) AS evidencias,
(SELECT string_agg(c.marco_origen || '/' || c.origen || '/' || c.tipo, ';' ORDER BY c.marco_origen, c.origen, c.tipo) FROM correspondencia c WHERE c.marco_destino = n.marco AND c.destino = n.codigo) AS correspondencias,
(SELECT string_agg(b.titulo || '/' || b.severidad, ';' ORDER BY b.id) FROM brecha b WHERE b.marco = n.marco AND b.nodo = n.codigo) AS brechas,
(SELECT string_agg(i.indicador, ';' ORDER BY i.indicador) FROM indicador_nodo i WHERE i.marco = n.marco AND i.nodo = n.codigo) AS indicadores FROM nodo n WHERE n.marco = 'ABET-EAC'""")
def node_details(t: Base) -> DataFrame:
    d = views.node_details(t, "ABET-EAC")
    return d.select("nodo", "padre", _said("evidencias", "evidencia", "rol").alias("evidencias"), _said("correspondencias", "marco_origen", "origen", "tipo").alias("correspondencias"), _said("brechas", "titulo", "severidad").alias("brechas"), _said("indicadores", "indicador").alias("indicadores"))


@on_base("""SELECT codigo AS evidencia, titulo, md5(substring(coalesce(texto, ''), 1, 2200) || CASE WHEN texto_ocr IS NOT NULL THEN chr(10) || '[Texto en imágenes (OCR)]' || chr(10) || substring(texto_ocr, 1, 800) ELSE '' END) AS texto,
(SELECT string_agg(marco || '/' || nodo || '/' || rol || '/' || estado, ';' ORDER BY marco, nodo, rol) FROM evidencia_nodo l WHERE l.evidencia = e.codigo) AS etiquetas FROM evidencia e WHERE estado_revision <> 'obsoleta'""")
def evidence_feed(t: Base) -> DataFrame:
    return views.evidence_feed(t).select("evidencia", "titulo", F.md5("texto").alias("texto"), _said("etiquetas", "marco", "nodo", "rol", "estado").alias("etiquetas"))


@on_base("SELECT i.codigo, i.nombre, (SELECT string_agg(m.periodo || '/' || m.sede || '/' || CAST(CAST(round(m.valor * 100) AS BIGINT) AS VARCHAR), ';' ORDER BY m.id) FROM medicion m WHERE m.indicador = i.codigo) AS serie FROM indicador i")
def indicator_series(t: Base) -> DataFrame:
    shown = F.transform("serie", lambda x: F.concat_ws("/", x["periodo"], x["sede"], F.round(x["valor"] * 100).cast("long").cast("string")))
    return views.indicator_series(t).select("codigo", "nombre", F.array_join(shown, ";").alias("serie"))


@on_base("SELECT n.tipo, n.numero, n.anio, n.organo, string_agg(m.evidencia, ', ' ORDER BY m.evidencia) AS evidencias FROM normativa n JOIN normativa_mencion m USING (tipo, numero, anio) GROUP BY 1, 2, 3, 4")
def norms_cited(t: Base) -> DataFrame:
    return views.norms_cited(t)


@on_base("SELECT id, marco, nodo, titulo, severidad, estado FROM brecha")
def gaps_by_severity(t: Base) -> DataFrame:
    return views.gaps_by_severity(t).select("id", "marco", "nodo", "titulo", "severidad", "estado")


@on_base("SELECT o.curso, o.outcome, n.nombre AS outcome_nombre, c.periodo, c.numero, o.nivel, o.estado FROM curso_outcome o JOIN curso c ON c.nombre = o.curso JOIN nodo n ON n.marco = 'ABET-EAC' AND n.codigo = o.outcome")
def course_matrix(t: Base) -> DataFrame:
    return views.course_matrix(t).select("curso", "outcome", "outcome_nombre", "periodo", "numero", "nivel", "estado")


@on_base("""SELECT c.nombre AS curso, c.periodo, (SELECT string_agg(requisito, ', ' ORDER BY requisito) FROM curso_prerrequisito r WHERE r.curso = c.nombre) AS requisitos, (SELECT min(codigo) FROM pad p WHERE p.curso = c.nombre) AS pad,
(SELECT string_agg(outcome || CASE WHEN estado = 'validada' THEN ' ✓' ELSE '' END, ', ' ORDER BY outcome, estado) FROM curso_outcome o WHERE o.curso = c.nombre AND estado <> 'descartada') AS outcomes FROM curso c""")
def study_route(t: Base) -> DataFrame:
    return views.study_route(t).select("curso", "periodo", "requisitos", "pad", "outcomes")


@on_base("SELECT desagregacion, min_by(valor, id) FILTER (indicador = 'CNA_VAL') AS \"CNA_VAL\", min_by(valor, id) FILTER (indicador = 'CNA_POND') AS \"CNA_POND\" FROM medicion WHERE indicador IN ('CNA_VAL', 'CNA_POND') GROUP BY 1")
def factor_scores(t: Base) -> DataFrame:
    return views.factor_scores(t)


@on_base("""SELECT (SELECT count(*) FROM correspondencia WHERE estado = 'propuesta') AS correspondencias, (SELECT count(*) FROM evidencia_nodo WHERE estado = 'propuesta') AS etiquetas,
(SELECT count(*) FROM evidencia e WHERE estado_revision <> 'obsoleta' AND NOT EXISTS (SELECT 1 FROM evidencia_nodo l WHERE l.marco = 'ABET-EAC' AND l.evidencia = e.codigo)) AS sin_abet, (SELECT count(*) FROM decision) AS decisiones""")
def pending(t: Base) -> DataFrame:
    return views.pending(t)


@on_base("SELECT orden, titulo, serie_orden, serie, string_agg(categoria || '=' || CAST(valor AS VARCHAR), ', ' ORDER BY punto_orden) AS puntos FROM grafica WHERE evidencia = 'D7' GROUP BY 1, 2, 3, 4")
def chart_series(t: Base) -> DataFrame:
    return views.chart_series(t, "D7")


_PROJECTED = """,
usable AS (SELECT codigo, coalesce(nivel, 'principal') = 'complementaria' AS extra FROM evidencia WHERE estado_revision <> 'obsoleta' AND coalesce(nivel, 'principal') <> 'escenario'),
ways AS (SELECT l.evidencia, c.marco_destino AS marco, c.destino AS nodo, greatest(CASE WHEN u.extra THEN 2 ELSE CASE l.rol WHEN 'principal' THEN 0 WHEN 'parcial' THEN 1 ELSE 2 END END, CASE c.tipo WHEN 'equivalente' THEN 0 WHEN 'parcial' THEN 1 ELSE 2 END) AS w
 FROM evidencia_nodo l JOIN usable u ON u.codigo = l.evidencia JOIN correspondencia c ON c.marco_origen = l.marco AND c.origen = l.nodo WHERE l.origen = 'extraccion' AND l.estado <> 'descartada' AND c.estado <> 'descartada' AND c.marco_destino IN ('ABET-EAC', 'ATMAE-2027', 'ANECA-EURACE', 'SOFIA')),
plans AS (SELECT DISTINCT l.evidencia FROM evidencia_nodo l JOIN nodo n ON n.marco = l.marco AND n.codigo = l.nodo AND n.tipo = 'factor' JOIN evidencia e ON e.codigo = l.evidencia AND e.tipo = 'plan_mejora' AND e.estado_revision <> 'obsoleta' WHERE l.origen = 'extraccion'),
alls AS (SELECT * FROM ways UNION ALL SELECT evidencia, m, k, 2 FROM plans, (VALUES ('ABET-EAC', 'C4'), ('ATMAE-2027', 'A11'), ('ANECA-EURACE', 'E3')) AS v(m, k)),
want AS (SELECT evidencia, a.marco, a.nodo, CASE min(w) WHEN 0 THEN 'principal' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS rol FROM alls a JOIN nodo n ON n.marco = a.marco AND n.codigo = a.nodo GROUP BY 1, 2, 3)"""


@on_base("SELECT * FROM want", _PROJECTED)
def projected_labels(t: Base) -> DataFrame:
    return projection.desired_labels(t)


_SYNCED = _PROJECTED + """,
acts AS (SELECT coalesce(w.evidencia, l.evidencia) AS evidencia, coalesce(w.marco, l.marco) AS marco, coalesce(w.nodo, l.nodo) AS nodo, w.rol AS role, l.rol AS role_now,
CASE WHEN w.rol IS NOT NULL AND l.rol IS NULL THEN 'insert' WHEN w.rol IS NOT NULL AND l.origen <> 'inferida' THEN 'blocked' WHEN l.validado_por IS NOT NULL THEN 'decided' WHEN w.rol = l.rol THEN 'keep' WHEN w.rol IS NOT NULL THEN 'update' ELSE 'delete' END AS action
FROM want w FULL JOIN (SELECT * FROM evidencia_nodo WHERE marco IN ('ABET-EAC', 'ATMAE-2027', 'ANECA-EURACE', 'SOFIA')) l ON l.evidencia = w.evidencia AND l.marco = w.marco AND l.nodo = w.nodo WHERE w.rol IS NOT NULL OR l.origen = 'inferida')"""


@on_base("SELECT * FROM acts", _SYNCED)
def projection_actions(t: Base) -> DataFrame:
    return projection.project(t)[1]


@on_base("SELECT count(*) FILTER (action = 'insert') AS nuevas, count(*) FILTER (action = 'update') AS rol, count(*) FILTER (action = 'delete') AS retiradas, count(*) FILTER (action = 'decided') AS humanas FROM acts", _SYNCED)
def projection_summary(t: Base) -> DataFrame:
    return projection.summary(projection.project(t)[1])


@on_base("""SELECT l.evidencia, l.marco, l.nodo, coalesce(a.role, l.rol) AS rol, l.origen FROM evidencia_nodo l LEFT JOIN acts a ON a.evidencia = l.evidencia AND a.marco = l.marco AND a.nodo = l.nodo AND a.action IN ('update', 'delete') WHERE a.action IS DISTINCT FROM 'delete'
UNION ALL SELECT evidencia, marco, nodo, role, 'inferida' FROM acts WHERE action = 'insert'""", _SYNCED)
def labels_after_projection(t: Base) -> DataFrame:
    return projection.project(t)[0].select("evidencia", "marco", "nodo", "rol", "origen")


# --- Loads against what is there: the load is the base with some rows changed, some gone, some new -------------------------


@on_base("""SELECT coalesce(o.codigo, n.codigo) AS codigo, coalesce(n.nombre, o.nombre) AS nombre, CASE WHEN o.codigo IS NULL THEN 'insert' WHEN n.codigo IS NULL THEN 'surplus' WHEN n.nombre <> o.nombre THEN 'update' ELSE 'keep' END AS action
FROM (SELECT * FROM nodo WHERE marco = 'CNA' AND orden % 7 <> 1) o FULL JOIN (SELECT codigo, CASE WHEN orden % 5 = 0 THEN nombre || '!' ELSE nombre END AS nombre FROM nodo WHERE marco = 'CNA' AND orden % 9 <> 2) n ON o.codigo = n.codigo""")
def node_upsert(t: Base) -> DataFrame:
    every = t["nodo"].where("marco = 'CNA'")
    load = every.where("orden % 9 <> 2").withColumn("nombre", F.when(F.col("orden") % 5 == 0, F.concat("nombre", F.lit("!"))).otherwise(F.col("nombre")))
    old = every.where("orden % 7 <> 1")
    after, surplus = reconcile.upsert_nodes(old, load, F.lit("2024-01-01").cast("timestamp"))
    out = after.select("codigo", "nombre", F.col("actualizado_en").isNotNull().alias("touched")).join(surplus.select("codigo", F.lit(True).alias("surplus")), "codigo", "left").join(old.select("codigo", F.lit(True).alias("old")), "codigo", "left")
    return out.select("codigo", "nombre", F.when(F.col("surplus"), "surplus").when(~F.col("touched"), "keep").when(F.col("old"), "update").otherwise("insert").alias("action"))


_EDGE_LOAD = """,
load AS (SELECT marco_origen, origen, marco_destino, destino, CASE WHEN nota LIKE '%1' THEN 'apoyo' ELSE tipo END AS tipo, nota FROM correspondencia WHERE nota NOT LIKE '%7')"""


@on_base("""SELECT o.marco_origen, o.origen, o.marco_destino, o.destino, CASE WHEN o.validado_por IS NULL THEN l.tipo ELSE o.tipo END AS tipo, o.estado, o.validado_por
FROM correspondencia o LEFT JOIN load l USING (marco_origen, origen, marco_destino, destino) WHERE l.tipo IS NOT NULL OR o.validado_por IS NOT NULL""", _EDGE_LOAD)
def edge_reconcile(t: Base) -> DataFrame:
    c = t["correspondencia"]
    load = c.where("nota NOT LIKE '%7'").select("marco_origen", "origen", "marco_destino", "destino", F.when(F.col("nota").endswith("1"), "apoyo").otherwise(F.col("tipo")).alias("tipo"), "nota")
    return reconcile.reconcile_edges(c, load)[0].select("marco_origen", "origen", "marco_destino", "destino", "tipo", "estado", "validado_por")


@on_base("""SELECT coalesce(o.codigo, n.codigo) AS codigo, coalesce(n.titulo, o.titulo) AS titulo, CASE WHEN n.codigo IS NULL THEN 'obsoleta' WHEN o.codigo IS NULL OR o.estado_revision = 'obsoleta' THEN 'sin_revisar' ELSE o.estado_revision END AS estado_revision,
CASE WHEN o.codigo IS NULL THEN 'insert' WHEN n.codigo IS NULL THEN CASE WHEN o.estado_revision = 'obsoleta' THEN 'keep' ELSE 'obsolete' END WHEN n.titulo = o.titulo AND o.estado_revision <> 'obsoleta' THEN 'keep' ELSE 'update' END AS action
FROM (SELECT * FROM evidencia WHERE pagina % 11 <> 3) o FULL JOIN (SELECT codigo, CASE WHEN pagina % 6 = 0 THEN titulo || '+' ELSE titulo END AS titulo FROM evidencia WHERE pagina % 8 <> 5) n ON o.codigo = n.codigo""")
def evidence_reconcile(t: Base) -> DataFrame:
    e = t["evidencia"]
    load = e.where("pagina % 8 <> 5").withColumn("titulo", F.when(F.col("pagina") % 6 == 0, F.concat("titulo", F.lit("+"))).otherwise(F.col("titulo"))).select("codigo", *reconcile.EVIDENCE_FIELDS)
    after, actions = reconcile.reconcile_evidence(e.where("pagina % 11 <> 3"), load)
    return after.select("codigo", "titulo", "estado_revision").join(actions, "codigo")


_LABEL_LOAD = """,
load AS (SELECT evidencia, marco, nodo, CASE WHEN right(evidencia, 1) = '4' THEN 'apoyo' ELSE rol END AS rol, 'propuesta' AS estado FROM evidencia_nodo WHERE marco IN ('CNA', 'ABET-EAC') AND right(evidencia, 1) <> '3'
UNION ALL SELECT codigo, 'CNA', 'F09', 'parcial', 'propuesta' FROM evidencia WHERE right(codigo, 1) = '5'),
lact AS (SELECT coalesce(l.evidencia, w.evidencia) AS evidencia, coalesce(l.marco, w.marco) AS marco, coalesce(l.nodo, w.nodo) AS nodo, l.rol AS old_rol, w.rol AS new_rol, l.origen, CASE WHEN l.evidencia IS NULL THEN 'insert' WHEN w.rol IS NOT NULL AND l.origen <> 'extraccion' THEN 'ignored'
WHEN w.rol IS NOT NULL AND l.validado_por IS NULL AND l.rol <> w.rol THEN 'update' WHEN w.rol IS NULL AND l.origen = 'extraccion' AND l.validado_por IS NULL AND EXISTS (SELECT 1 FROM evidencia e WHERE e.codigo = coalesce(l.evidencia, w.evidencia) AND e.estado_revision <> 'obsoleta') THEN 'delete' ELSE 'keep' END AS action
FROM evidencia_nodo l FULL JOIN load w ON w.evidencia = l.evidencia AND w.marco = l.marco AND w.nodo = l.nodo)"""


def _label_load(t: Base) -> tuple[DataFrame, DataFrame]:
    last = lambda c: F.substring(c, -1, 1)
    l = t["evidencia_nodo"]
    old = l.where("marco IN ('CNA', 'ABET-EAC')").where(last("evidencia") != "3").select("evidencia", "marco", "nodo", F.when(last("evidencia") == "4", "apoyo").otherwise(F.col("rol")).alias("rol"), F.lit("propuesta").alias("estado"))
    new = t["evidencia"].where(last("codigo") == "5").select(F.col("codigo").alias("evidencia"), F.lit("CNA").alias("marco"), F.lit("F09").alias("nodo"), F.lit("parcial").alias("rol"), F.lit("propuesta").alias("estado"))
    live = t["evidencia"].where("estado_revision <> 'obsoleta'").select(F.col("codigo").alias("evidencia"))
    return reconcile.reconcile_labels(l, old.unionByName(new), live)


@on_base("SELECT evidencia, marco, nodo, action FROM lact", _LABEL_LOAD)
def label_actions(t: Base) -> DataFrame:
    return _label_load(t)[1]


@on_base("SELECT evidencia, marco, nodo, CASE WHEN action IN ('insert', 'update') THEN new_rol ELSE old_rol END AS rol, CASE WHEN action = 'insert' THEN 'extraccion' ELSE origen END AS origen FROM lact WHERE action <> 'delete'", _LABEL_LOAD)
def label_reconcile(t: Base) -> DataFrame:
    return _label_load(t)[0].select("evidencia", "marco", "nodo", "rol", "origen")


@on_base("SELECT action, count(*) AS n FROM lact GROUP BY 1", _LABEL_LOAD)
def change_summary(t: Base) -> DataFrame:
    return reconcile.summarise(_label_load(t)[1])


@on_base("""SELECT n.codigo, n.nombre, coalesce(n.tipo, 'x') AS tipo FROM (SELECT marco || '/' || codigo AS codigo, upper(nombre) AS nombre, tipo FROM nodo WHERE orden < 105) n
UNION ALL SELECT marco || '/' || codigo, nombre, tipo FROM nodo WHERE orden >= 105""")
def framework_upsert(t: Base) -> DataFrame:
    every = t["nodo"].select(F.concat_ws("/", "marco", "codigo").alias("codigo"), "nombre", "tipo", "orden")
    return reconcile.upsert_frameworks(every, every.where("orden < 105").withColumn("nombre", F.upper("nombre"))).select("codigo", "nombre", "tipo")


# --- Decisions ------------------------------------------------------------------------------------------------------------

_FOLDED = """,
said AS (SELECT referencia, accion, validador, CASE accion WHEN 'validar' THEN 'validada' WHEN 'descartar' THEN 'descartada' ELSE 'validada' END AS nuevo FROM (SELECT *, row_number() OVER (PARTITION BY referencia ORDER BY event_id DESC) AS k FROM decision WHERE objeto = 'etiqueta') WHERE k = 1)"""


@on_base("""SELECT l.evidencia, l.marco, l.nodo, l.rol, coalesce(s.nuevo, l.estado) AS estado, CASE WHEN s.accion = 'reabrir' THEN NULL ELSE coalesce(s.validador, l.validado_por) END AS validado_por
FROM evidencia_nodo l LEFT JOIN said s ON s.referencia = l.evidencia || '|' || l.marco || '|' || l.nodo""", _FOLDED)
def labels_after_decisions(t: Base) -> DataFrame:
    none = F.lit(None).cast("string")
    log = t["decision"].select(F.timestamp_seconds("event_id").alias("fecha"), "objeto", "referencia", "accion", none.alias("rol"), none.alias("estado_anterior"), decisions.new_state(F.col("accion"), F.lit("extraccion")).alias("estado_nuevo"), "validador", none.alias("comentario"))
    return decisions.apply_log(t["evidencia_nodo"], log, "etiqueta", ["evidencia", "marco", "nodo"]).select("evidencia", "marco", "nodo", "rol", "estado", "validado_por")


@on_base("SELECT marco_origen || '/' || origen || ' → ' || marco_destino || '/' || destino AS referencia, tipo FROM correspondencia")
def edge_references(t: Base) -> DataFrame:
    return t["correspondencia"].select(decisions.reference(F.col("marco_origen"), F.col("origen"), F.col("marco_destino"), F.col("destino")).alias("referencia"), "tipo")


# --- Searches of the public surface ---------------------------------------------------------------------------------------


@on_base("""SELECT o.nombre AS origen_nombre, d.nombre AS destino_nombre, c.origen, c.destino, c.tipo FROM correspondencia c JOIN nodo o ON o.marco = c.marco_origen AND o.codigo = c.origen JOIN nodo d ON d.marco = c.marco_destino AND d.codigo = c.destino
WHERE c.marco_destino = 'ABET-EAC' AND c.estado = 'propuesta' AND (contains(o.nombre, '_1') OR contains(d.nombre, '_1') OR contains(c.nota, '_1'))""")
def edge_search(t: Base) -> DataFrame:
    return views.edge_list(t, {"marco_destino": "ABET-EAC", "estado": "propuesta"}, "_1").select("origen_nombre", "destino_nombre", "origen", "destino", "tipo")


@on_base("""SELECT l.evidencia, e.titulo, l.nodo, n.nombre AS nodo_nombre, l.rol FROM evidencia_nodo l JOIN evidencia e ON e.codigo = l.evidencia JOIN nodo n ON n.marco = l.marco AND n.codigo = l.nodo
WHERE l.marco = 'CNA' AND l.estado = 'propuesta' AND (e.codigo ILIKE '%11%' OR e.titulo ILIKE '%11%' OR e.texto ILIKE '%11%')""")
def label_search(t: Base) -> DataFrame:
    return views.label_list(t, {"marco": "CNA", "estado": "propuesta"}, "11").select("evidencia", "titulo", "nodo", "nodo_nombre", "rol")


@on_base("""SELECT codigo, titulo, (SELECT count(*) FROM evidencia_nodo l WHERE l.evidencia = e.codigo AND estado <> 'descartada') AS etiquetas FROM evidencia e WHERE tipo = 'diapositiva' AND fuente = 'src1' AND (codigo ILIKE '%the%' OR titulo ILIKE '%the%' OR texto ILIKE '%the%' OR texto_ocr ILIKE '%the%')""")
def evidence_search(t: Base) -> DataFrame:
    return views.evidence_list(t, {"tipo": "diapositiva", "fuente": "src1"}, "the").select("codigo", "titulo", "etiquetas")


@on_base("""SELECT codigo, nombre FROM pad p WHERE p.nombre ILIKE '%a%' AND codigo ILIKE '%1%' OR EXISTS (SELECT 1 FROM pad_actividad a WHERE a.pad = p.codigo AND a.nombre ILIKE '%act 5/%') OR EXISTS (SELECT 1 FROM pad_experiencia x WHERE x.pad = p.codigo AND x.nombre ILIKE '%act 5/%')
OR p.texto ILIKE '%act 5/%'""")
def pad_search(t: Base) -> DataFrame:
    return views.pad_list(t, "act 5/", F.col("nombre").ilike("%a%") & F.col("codigo").ilike("%1%")).select("codigo", "nombre")


@on_base("SELECT c.nombre AS curso, c.periodo, c.creditos FROM curso c WHERE NOT EXISTS (SELECT 1 FROM pad p WHERE p.curso = c.nombre)")
def courses_without_plan(t: Base) -> DataFrame:
    return views.courses_without_plan(t).select("curso", "periodo", "creditos")


@on_base("""SELECT p.codigo AS pad, p.nombre, c.nombre AS curso, c.periodo, (SELECT count(*) FROM pad_experiencia x WHERE x.pad = p.codigo) AS experiencias,
(SELECT string_agg(x.nombre || ':' || (SELECT count(*) FROM pad_actividad a WHERE a.pad = x.pad AND a.experiencia_orden = x.orden), ';' ORDER BY x.orden) FROM pad_experiencia x WHERE x.pad = p.codigo) AS actividades,
(SELECT string_agg(outcome || '/' || nivel, ';' ORDER BY outcome, nivel) FROM curso_outcome o WHERE o.curso = p.curso AND o.estado <> 'descartada') AS outcomes FROM pad p LEFT JOIN curso c ON c.nombre = p.curso""")
def plan_details(t: Base) -> DataFrame:
    d = views.plan_details(t)
    shown = F.array_join(F.transform("experiencias", lambda x: F.concat(x["nombre"], F.lit(":"), F.size(x["actividades"]).cast("string"))), ";")
    return d.select("pad", "nombre", "curso", "periodo", F.size("experiencias").cast("long").alias("experiencias"), shown.alias("actividades"), _said("outcomes", "outcome", "nivel").alias("outcomes"))


@on_base("""SELECT e.codigo AS evidencia, e.titulo, (SELECT string_agg(l.marco || '/' || l.nodo || '/' || n.nombre || '/' || l.rol, ';' ORDER BY l.marco, l.nodo, l.rol) FROM evidencia_nodo l JOIN nodo n ON n.marco = l.marco AND n.codigo = l.nodo WHERE l.evidencia = e.codigo) AS etiquetas,
(SELECT count(*) FROM grafica g WHERE g.evidencia = e.codigo) AS puntos FROM evidencia e""")
def evidence_details(t: Base) -> DataFrame:
    return views.evidence_details(t).select("evidencia", "titulo", _said("etiquetas", "marco", "nodo", "nombre", "rol").alias("etiquetas"), "puntos")


@on_base("SELECT nombre AS curso, periodo, numero, creditos FROM curso")
def courses_sorted(t: Base) -> DataFrame:
    return views.courses_sorted(t).select("curso", "periodo", "numero", "creditos")


@on_base("SELECT codigo, nombre, (SELECT count(*) FROM curso_outcome o WHERE o.outcome = n.codigo AND o.estado <> 'descartada') AS cursos FROM nodo n WHERE marco = 'ABET-EAC' AND tipo = 'outcome'")
def program_outcomes(t: Base) -> DataFrame:
    return views.program_outcomes(t).select("codigo", "nombre", "cursos")


@on_base("SELECT 'etiqueta' AS objeto, count(*) FILTER (accion = 'validar') AS validar, count(*) FILTER (accion = 'descartar') AS descartar FROM decision WHERE objeto = 'etiqueta' UNION ALL SELECT 'correspondencia', count(*) FILTER (accion = 'validar'), count(*) FILTER (accion = 'descartar') FROM decision WHERE objeto = 'correspondencia'")
def decision_counters(t: Base) -> DataFrame:
    return an.state_counts(t["decision"], ["objeto"], {"validar": F.col("accion") == "validar", "descartar": F.col("accion") == "descartar"})


@on_base("SELECT titulo, texto_ocr AS ocr, nivel FROM evidencia WHERE estado_revision <> 'obsoleta' AND (texto_ocr ILIKE '%fr scan%') ORDER BY codigo LIMIT 50 OFFSET 0")
def ocr_search(t: Base) -> DataFrame:
    found = search.matches(t["evidencia"].where("estado_revision <> 'obsoleta'"), {}, "fr scan", ["texto_ocr"])
    return search.page(found, ["codigo"]).select("titulo", F.col("texto_ocr").alias("ocr"), "nivel")


@on_base("""SELECT c.marco, c.nombre, (SELECT string_agg(codigo || '/' || coalesce(padre, '-'), ';' ORDER BY orden, codigo) FROM nodo n WHERE n.marco = c.marco) AS estructura FROM (VALUES ('CNA', 'first'), ('SOFIA', 'second'), ('OTHER', 'third')) AS c(marco, nombre)""")
def accreditor_cards(t: Base) -> DataFrame:
    cards = t.tables.spark.createDataFrame([("CNA", "first"), ("SOFIA", "second"), ("OTHER", "third")], "marco string, nombre string")
    shown = F.array_join(F.transform("estructura", lambda x: F.concat_ws("/", x["codigo"], F.coalesce(x["padre"], F.lit("-")))), ";")
    return views.accreditor_cards(t, cards).select("marco", "nombre", F.nullif(shown, F.lit("")).alias("estructura"))


# --- Redaction and tables of people -----------------------------------------------------------------------------------------

#: Codes whose texts are withheld, and why.
WITHHELD = [(r"^D[0-9]*7$", "personal data"), (r"^D1[0-9][0-9]$", "contract")]


@on_base("""SELECT codigo, CASE WHEN why IS NULL THEN md5(texto) ELSE md5('[Texto omitido en la versión para compartir: ' || why || '. Está en la versión completa del índice.]') END AS texto, CASE WHEN why IS NULL THEN texto_ocr END AS texto_ocr, CASE WHEN why IS NULL THEN archivo END AS archivo
FROM (SELECT *, CASE WHEN regexp_matches(codigo, '^D[0-9]*7$') THEN 'personal data' WHEN regexp_matches(codigo, '^D1[0-9][0-9]$') THEN 'contract' END AS why FROM evidencia WHERE NOT contains(texto, '@') AND NOT contains(texto, ':') AND NOT contains(texto, '=') AND NOT regexp_matches(texto, '(?i)profesor|l[ií]der'))""")
def redacted_evidence(t: Base) -> DataFrame:
    from attestra.operators import redaction

    quiet = t["evidencia"].where(~F.col("texto").contains("@") & ~F.col("texto").contains(":") & ~F.col("texto").contains("=") & ~F.regexp_like("texto", F.lit("(?iu)profesor|l[ií]der")))
    tables = t.tables.spark.createDataFrame([], schema.TABLES["tabla_diapositiva"])
    out = redaction.redact(quiet, tables, t["pad"], WITHHELD)[0]
    return out.select("codigo", F.md5("texto").alias("texto"), "texto_ocr", "archivo")


# --- Tagged documents: one for each region, a section for each nation -------------------------------------------------------


@on_base("""SELECT 'R' || r_regionkey || '-' || codigo AS codigo, titulo, nivel, parrafos, leyendas, celdas FROM (
SELECT n_regionkey AS r_regionkey, CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey || '.' || n_nationkey ELSE 'NATION-' || n_nationkey || '-OF-THE' END AS codigo, CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey || '.' || n_nationkey || ' ' || n_name ELSE n_name || ' of the world' END AS titulo,
CAST(CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 2 END AS INT) AS nivel, 'about ' || n_name || ' and more' AS parrafos, CASE WHEN n_nationkey % 4 = 0 THEN 'Tabla ' || n_nationkey || '. ' || n_name END AS leyendas, CASE WHEN n_nationkey % 4 < 2 THEN n_name || '|' || n_nationkey END AS celdas FROM nation
UNION ALL SELECT r_regionkey, 'PORTADA', 'Portada y créditos', 1, 'front of ' || r_name, NULL, NULL FROM region)""")
def tagged_sections(t: Base) -> DataFrame:
    from attestra.operators import tagged

    n, k = F.col("n_name"), F.col("n_nationkey").cast("string")
    numbered = F.col("n_nationkey") % 3 == 0
    title = F.when(numbered, F.concat(F.col("n_regionkey").cast("string"), F.lit("."), k, F.lit(" "), n)).otherwise(F.concat(n, F.lit(" of the world")))
    table = F.concat(F.lit('\nTable\n  TR\n    TD\n      "'), n, F.lit('"\n    TD\n      P\n        "'), k, F.lit('"\n  TR\n    TD\n'))
    caption = F.concat(F.lit('\nCaption\n  "Tabla '), k, F.lit(". "), n, F.lit('"'))
    part = F.concat(
        F.when(F.col("n_nationkey") % 2 == 0, "H1").otherwise("H2"), F.lit('\n  "'), title, F.lit('"\n  /BBox [0 0 1 1]\nP\n  "about '), n, F.lit('"\n  Span\n    "and more"'),
        F.when(F.col("n_nationkey") % 4 == 0, caption).otherwise(""), F.when(F.col("n_nationkey") % 4 < 2, table).otherwise(""),
    )
    parts = t.tables["nation"].groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(an.ordered_list(part, ["n_nationkey"], "\n").alias("parts"))
    docs = t.tables["region"].join(parts, "r_regionkey").select(F.concat(F.lit("R"), "r_regionkey").alias("doc"), F.concat(F.lit('TOC\n  "contents"\nP\n  "front of '), "r_name", F.lit('"\n'), "parts").alias("text"))
    found = tagged.sections(tagged.blocks(tagged.trees(docs, "doc", "text"), "doc"), "doc", F.col("doc"))
    cells = F.array_join(F.flatten(F.flatten(F.transform("tablas", lambda x: x["filas"]))), "|")
    return found.select("codigo", "titulo", "nivel", F.array_join("parrafos", "; ").alias("parrafos"), F.nullif(F.array_join(F.transform("tablas", lambda x: x["leyenda"]), ";"), F.lit("")).alias("leyendas"), F.nullif(cells, F.lit("")).alias("celdas"))
