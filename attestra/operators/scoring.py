"""Weighted pattern scores of course plans against outcomes, with proposals by course name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.text import let, plain

#: Patterns on plain text, competences, proposals by name, threshold and weights.
PATTERNS = {
    "SO1": r"\bresolv|\bsolucion(ar|es)?\b|\bcalcul|\bmodel(o|os|ar|acion)\b|\bcuantific|\boptimiz",
    "SO2": r"\bdisen(ar|o|os|a|e)\b(?!\s+(de\s+(la\s+)?)?(experiment|investigaci|investigativ|metodologic|muestral))|\bdimension(ar|amiento)|\bplan de manejo|\bpropuesta tecnica|\bprototipo",
    "SO3": r"\bexposicion|\bsustentacion|\bsocializ|\binforme|\bpresentacion oral|\bposter\b|\binfografia|\bpodcast|\bvideo\b|\bcomunic(ar|acion)",
    "SO4": r"\betic[ao]s?\b|\bresponsabilidad social|\bimpacto (social|ambiental)|\bnormativ|\bbienestar (animal|social)|\bderechos",
    "SO5": r"\bequipo|\bgrupal|\ben grupo|\bcolaborativ|\bparejas|\bcooperativ",
    "SO6": r"\bexperiment|\blaboratorio|\bmuestre|\banalisis de datos|\bestadistic|\bmedir\b|\bmedicion|\bhipotesis|\btratamientos\b",
    "SO7": r"\bautonom|\bindag|\brevision (bibliografica|documental)|\bconsulta\b|\bautoaprendizaje|\bbusqueda de informacion",
}
COMPETENCES = {"comunicacion escrita": "SO3", "competencias ciudadanas": "SO4"}
BY_NAME = ((r"^comunicacion y lectura critica", ("SO3",)), (r"^lengua extranjera", ("SO3",)), (r"^razonamiento logico", ("SO1",)), (r"^ciudadania|^catedra generacion", ("SO4",)), (r"^ciencia, tecnologia e innovacion", ("SO6", "SO7")), (r"^emprendimiento e innovacion", ("SO5",)))
THRESHOLD, RESULT, EXPERIENCE, PROBLEM, ACTIVITY, COMPETENCE, TEXT_CAP = 4, 3, 2, 3, 1, 1, 3
JUSTIFICATION = 400


def hits(text: Column, patterns: dict[str, str] = PATTERNS) -> Column:
    """array<struct<so, found>> of the patterns a plain text matches, with the first match of each; the text is made plain once."""

    def found(t: Column) -> Column:
        each = [F.when(F.regexp_like(t, F.lit(p)), F.struct(F.lit(so).alias("so"), F.trim(F.regexp_extract(t, p, 0)).alias("found"))) for so, p in patterns.items()]
        return F.filter(F.array(*each), lambda x: x.isNotNull())

    return let(text, found)


def level(period: Column, backed: Column) -> Column:
    return F.when(period.isNull() | (period <= 3), "I").when((period <= 6) | ~backed, "R").otherwise("E")


def _points(df: DataFrame, text: Column, points: int, order: Column, backed: bool = False, motive=None) -> DataFrame:
    found = df.select("curso", "pad", order.alias("orden"), F.explode(hits(plain(text))).alias("h"))
    said = motive(F.col("h.found")) if motive else F.lit(None).cast("string")
    return found.select("curso", "orden", F.col("h.so").alias("so"), F.lit(points).alias("puntos"), F.lit(backed).alias("con_rea"), said.alias("motivo"))


def propose(courses: DataFrame, pads: DataFrame, results: DataFrame, experiences: DataFrame, activities: DataFrame) -> DataFrame:
    """curso, outcome, nivel, estado, origen, puntaje, justificacion of every course and outcome with enough evidence.

    courses: nombre, periodo. pads: curso, pad, rea_general, texto. results: curso, pad, consecutivo, texto.
    experiences: curso, pad, orden, tipo, nombre, descripcion, competencias. activities: curso, pad, texto.
    Courses without plan, or whose plan gives less than the threshold, are proposed by their names.
    """
    at = lambda kind, *c: F.struct(F.col("pad").alias("p"), F.lit(kind).alias("k"), F.coalesce(*c, F.lit(0)).cast("int").alias("n"))
    quote = lambda lead: lambda m: F.concat(lead, F.lit(": «"), m, F.lit("»"))
    words = F.concat_ws(" ", "nombre", "descripcion")
    parts = [
        _points(results, F.col("texto"), RESULT, at(0, F.col("consecutivo")), True, quote(F.concat_ws(" ", "pad", F.lit("REA"), F.col("orden.n").cast("string")))),
        experiences.where("tipo = 'soluciona_problema'").select("curso", at(1, F.col("orden")).alias("orden"), F.lit("SO1").alias("so"), F.lit(PROBLEM).alias("puntos"), F.lit(False).alias("con_rea"), F.concat("pad", F.lit(" soluciona un problema: "), F.substring(F.coalesce("nombre", F.lit("")), 1, 60)).alias("motivo")),
        _points(experiences, words, EXPERIENCE, at(1, F.col("orden")), False, quote(F.concat_ws(" ", "pad", F.lit("experiencia")))),
        _points(pads, F.col("rea_general"), RESULT, at(2), True, quote(F.concat_ws(" ", "pad", F.lit("REA general")))),
        _points(activities, F.col("texto"), ACTIVITY, at(3)),
    ]
    for name, so in COMPETENCES.items():
        parts.append(experiences.where(plain(F.col("competencias")).contains(name)).select("curso", at(1, F.col("orden")).alias("orden"), F.lit(so).alias("so"), F.lit(COMPETENCE).alias("puntos"), F.lit(False).alias("con_rea"), F.lit(None).cast("string").alias("motivo")))
    bare = pads.join(activities.select("pad").distinct(), "pad", "left_anti")
    every_match = lambda t: F.array(*[F.struct(F.lit(so).alias("so"), F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(p), 0), F.trim))).alias("m")) for so, p in PATTERNS.items()])
    found = bare.select("curso", "pad", F.explode(let(plain(F.col("texto")), every_match)).alias("x")).where(F.size("x.m") > 0)
    parts.append(found.select("curso", at(4).alias("orden"), F.col("x.so").alias("so"), F.least(F.lit(TEXT_CAP), F.size("x.m")).alias("puntos"), F.lit(False).alias("con_rea"), F.concat("pad", F.lit(" texto del PAD: «"), F.array_join(F.slice("x.m", 1, 3), "», «"), F.lit("»")).alias("motivo")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    scored = every.groupBy("curso", "so").agg(F.sum("puntos").cast("int").alias("puntaje"), F.bool_or("con_rea").alias("con_rea"), F.sort_array(F.collect_list(F.when(F.col("motivo").isNotNull(), F.struct("orden", "motivo")))).alias("m"))
    motives = F.transform("m", lambda x: x["motivo"])
    rest = F.col("puntaje") - RESULT * F.size(F.filter(motives, lambda x: x.contains("REA")))
    said = F.substring(F.array_join(F.array_distinct(motives), "; "), 1, JUSTIFICATION)
    base = courses.select(F.col("nombre").alias("curso"), "periodo")
    full = scored.join(base, "curso")
    enough = full.where(F.col("puntaje") >= THRESHOLD).select("curso", F.col("so").alias("outcome"), level(F.col("periodo"), F.col("con_rea")).alias("nivel"), F.lit("pad").alias("origen"), "puntaje", F.when(said != "", said).otherwise(F.concat(rest.cast("string"), F.lit(" indicios en actividades o competencias"))).alias("justificacion"))
    named = base.select("curso", "periodo", F.explode(F.flatten(F.array(*[F.when(F.regexp_like(plain(F.col("curso")), F.lit(p)), F.array(*map(F.lit, sos))).otherwise(F.array().cast("array<string>")) for p, sos in BY_NAME]))).alias("outcome")).distinct()
    named = named.join(enough.select("curso", "outcome"), ["curso", "outcome"], "left_anti").join(pads.select("curso").distinct().withColumn("has", F.lit(True)), "curso", "left").join(full.select("curso", F.col("so").alias("outcome"), F.col("puntaje").alias("p")), ["curso", "outcome"], "left")
    why = F.when(F.col("has"), "El PAD no alcanza el umbral: propuesta por el nombre del curso").otherwise("Curso institucional sin PAD: propuesta por el nombre del curso")
    by_name = named.select("curso", "outcome", level(F.col("periodo"), F.lit(False)).alias("nivel"), F.lit("nombre").alias("origen"), F.coalesce("p", F.lit(0)).alias("puntaje"), why.alias("justificacion"))
    return enough.unionByName(by_name).withColumn("estado", F.lit("propuesta"))


def merge_decided(proposed: DataFrame, seed: DataFrame, key: list[str], decided: Column) -> DataFrame:
    """Decided rows of the seed, and proposals for all other keys."""
    kept = seed.where(decided)
    return kept.unionByName(proposed.join(kept.select(*key), key, "left_anti"), allowMissingColumns=True)
