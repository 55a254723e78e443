"""Columns of an evidence base. Rows are identified by natural keys, never by surrogate numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 15

#: Seed files with their columns in order; int and double columns; columns whose empty cell stays a text.
SEEDS = {
    "marcos": "id codigo nombre version descripcion",
    "nodos": "marco codigo nombre tipo padre orden descripcion",
    "correspondencias": "marco_origen origen marco_destino destino tipo nota",
    "indicadores": "codigo nombre unidad descripcion",
    "indicador_nodos": "indicador marco nodo rol",
    "mediciones": "indicador periodo sede valor desagregacion evidencia nota",
    "cursos": "nombre numero componente_cma creditos periodo categoria_abet categoria_atmae modulo_cin confianza nota",
    "prerrequisitos": "curso requisito",
    "curso_outcomes": "curso outcome nivel estado origen puntaje justificacion validado_por",
    "brechas": "marco nodo titulo descripcion severidad accion responsable estado",
    "normativa_manual": "tipo numero anio organo texto_a_buscar",
    "normativa_excluir": "tipo numero anio",
    "pad_curso": "pad curso nota",
    "documentos": "patron prefijo proceso nivel titulo",
    "documento_nodos": "patron nodo rol nota",
    "privacidad": "patron motivo",
}
INTS = {"id", "orden", "numero", "creditos", "periodo_curso", "puntaje", "anio"}
SEED_INTS = {"marcos": {"id"}, "nodos": {"orden"}, "cursos": {"numero", "creditos", "periodo"}, "curso_outcomes": {"puntaje"}, "normativa_manual": {"numero", "anio"}, "normativa_excluir": {"numero", "anio"}}
SEED_DOUBLES = {"mediciones": {"valor"}}
TEXT_IF_EMPTY = {"desagregacion"}

_AUDIT = "validado_por string"
#: Tables of a base. Lists and tables of cells are arrays.
TABLES = {
    "marco": "id int, codigo string, nombre string, version string, descripcion string",
    "nodo": "marco string, codigo string, nombre string, descripcion string, tipo string, padre string, orden int, actualizado_en timestamp",
    "correspondencia": f"marco_origen string, origen string, marco_destino string, destino string, tipo string, estado string, nota string, {_AUDIT}",
    "evidencia": "codigo string, titulo string, tipo string, texto string, texto_ocr string, fuente string, archivo string, pagina int, sede string, proceso string, nivel string, estado_revision string",
    "evidencia_nodo": f"evidencia string, marco string, nodo string, rol string, origen string, estado string, {_AUDIT}",
    "indicador": "codigo string, nombre string, unidad string, descripcion string",
    "indicador_nodo": "indicador string, marco string, nodo string, rol string",
    "medicion": "id long, indicador string, periodo string, sede string, valor double, desagregacion string, evidencia string, nota string",
    "curso": "nombre string, numero int, componente_cma string, creditos int, periodo int, categoria_abet string, categoria_atmae string, modulo_cin string, confianza string, nota string",
    "curso_prerrequisito": "curso string, requisito string",
    "curso_outcome": f"curso string, outcome string, nivel string, estado string, origen string, puntaje int, justificacion string, {_AUDIT}",
    "brecha": "id long, marco string, nodo string, titulo string, descripcion string, severidad string, accion string, responsable string, estado string",
    "normativa": "tipo string, numero int, anio int, organo string",
    "normativa_mencion": "tipo string, numero int, anio int, evidencia string",
    "grafica": "evidencia string, orden int, titulo string, tipo string, serie_orden int, serie string, punto_orden int, categoria string, valor double",
    "tabla_diapositiva": "evidencia string, orden int, leyenda string, filas int, columnas int, celdas array<array<string>>",
    "pad": "codigo string, curso string, nombre string, programa string, plantilla string, idioma string, semestre int, creditos int, prerrequisitos string, justificacion string, rea_general string, acciones string, texto string, archivo string, paginas int",
    "pad_rea": "pad string, consecutivo int, texto string",
    "pad_fase": "pad string, orden int, fase string, descripcion string",
    "pad_experiencia": "pad string, orden int, tipo string, nombre string, rea string, descripcion string, dimensiones array<string>, integrantes int, competencias string, componentes array<string>",
    "pad_actividad": "pad string, experiencia_orden int, orden int, etapa string, nombre string, descripcion string, trabajo_estudiante string, semana_inicio int, duracion_semanas int, tipo_actividad string, lugares array<string>, instrumentos array<string>, descripcion_instrumentos string",
    "pad_bibliografia": "pad string, orden int, autor string, titulo string, anio int, editorial string, identificador string",
    "pad_recurso": "pad string, orden int, nombre string, tipo string, area string",
    "plan_2025": "orden int, periodo int, nombre string, tipo string, obligatorio int, creditos int, horas_acompanamiento int, horas_independiente int, horas_total int, max_estudiantes int, creditos_distribucion int",
    "transicion_2025": "orden int, curso_vigente string, semestre_vigente int, creditos_vigente int, curso_propuesto string, semestre_propuesto int, creditos_propuesto int, tipo string",
    "plan_2025_rea": "codigo_cadi string, campo string, creditos int, perfil string, consecutivo int, texto string",
    "decision": "fecha timestamp, objeto string, referencia string, accion string, rol string, estado_anterior string, estado_nuevo string, validador string, comentario string",
}


def empty_base(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def conform(df: DataFrame, table: str) -> DataFrame:
    """df with exactly a table's columns: missing ones are null, which is how an older base is brought up to date."""
    wanted = df.sparkSession.createDataFrame([], TABLES[table]).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted])
