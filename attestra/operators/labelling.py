"""Classifying and tagging evidence: first-match rules, titles, code ancestry, pattern rules, cited norms, carry-forward."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx
from attestra.functions.roles import role_of, weakness
from attestra.operators.analytics import small

#: Lines that never make a title, the lengths of titles, the pattern of page headers and of sources.
NO_TITLE = r"(?iu)^(Caracter[ií]stica|Fuente|FACTOR|Factor \d|Ingenier[ií]a$|Agron[oó]mica$|Acreditaci[oó]n de Alta|Sede Fusa|ALD Faca|Universidad de|CUNDINAMARCA)"
TITLE_LENGTH = 110
HEADER = r"Caracter[ií]stica\s*(\d+)\.?\s*\n?\s*([^\n]+(?:\n[a-záéíóúñ][^\n]+)?)"
SOURCE = r"Fuente[.:]\s*([^\n]{3,80})"
#: The pattern of a cited norm, what its gap must not hold, the years that count, the issuers.
NORM = r"(Acuerdo|Resoluci[oó]n)\b([^\n]{0,60}?)(?:N[o°º]\.?\s*|N\.\s*)?(\d{3,6})\s+(?:del?\s+)?(?:\d{1,2}\s+de\s+[a-zA-Z]+\s+(?:de\s+)?)?(\d{4})"
NORM_GAP = r"\b(decreto|ley|resoluci[oó]n|acuerdo|circular)\b|\b(19|20)\d\d\b"
NORM_YEARS = (1990, 2026)
ISSUERS = (("Consejo Superior", r"Superior|C\.?\s?S\b|CSU|CS\b"), ("Consejo Académico", r"Acad[eé]mico|C\.?\s?A\b"), ("Rectoría", r"Rector"))


def first_match(rules: Sequence[tuple[Column, str | Column]], otherwise: str) -> Column:
    """The value of the first rule whose condition holds."""
    out = F.lit(otherwise)
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def header(text: Column) -> dict[str, Column]:
    """car (number) and car_nombre of a page's text (before its blank lines go), null without one; a name may go on in the
    next line if that begins with a small letter."""
    name = tx.strip_unicode(F.regexp_replace(F.regexp_extract(text, HEADER, 2), r"(?U)\s+", " "))
    return {"car": F.regexp_extract(text, HEADER, 1).try_cast("int"), "car_nombre": F.when(name != "", name)}


def is_cover(text: Column) -> Column:
    first = F.substring_index(text, "\n", 1)
    short = (F.length(text) < 120) & (text.contains("Acreditación de Alta Calidad") | F.regexp_like(first, F.lit(r"FACTOR\s*\d+\s*$")))
    return short | (F.regexp_like(text, F.lit(r"^\s*FACTOR\s*\d+\s*\n")) & (F.length(text) < 200))


def slide_type(text: Column, factor: Column) -> Column:
    up = F.upper(text)
    return first_match([
        (factor.isNull() | (factor == 0), "diapositiva"), (up.contains("VALORACIÓN INTERPRETATIVA"), "valoracion"), (up.contains("LOGROS E") & up.contains("IMPACTO"), "logros"),
        (up.contains("PLAN DE") & up.contains("MEJORAMIENTO") & text.contains("Avance"), "plan_mejora"),
    ], "diapositiva")


def informative_lines(text: Column, least: int, skip: str = NO_TITLE, noise: str = r"^[\d\s%.,$]+$") -> Column:
    """Trimmed lines of a text that can serve as titles."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), tx.strip_unicode)
    return F.filter(lines, lambda x: (F.length(x) >= least) & ~F.regexp_like(x, F.lit(skip)) & ~F.regexp_like(x, F.lit(noise)))


def title(text: Column, name: Column, otherwise: str = "Diapositiva") -> Column:
    """First informative line that the header's name does not say already, cut; else the name."""
    low = F.lower(F.coalesce(name, F.lit("")))
    fresh = F.filter(informative_lines(text, 14), lambda x: ~low.contains(F.lower(x)) & ~low.startswith(F.lower(x)))
    return F.coalesce(F.substring(F.get(fresh, F.lit(0)), 1, TITLE_LENGTH), name, F.lit(otherwise))


def section_title(text: Column, otherwise: Column) -> Column:
    """'SECTION: first line that says more', from the informative lines of a slide without header."""
    lines = informative_lines(text, 4, noise=r"^[\d\s%.,$•|-]+$")
    section = F.get(lines, F.lit(0))
    rest = F.get(F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda x: (F.length(x) >= 12) & (F.upper(x) != F.upper(section))), F.lit(0))
    return F.coalesce(F.substring(F.when(rest.isNotNull(), F.concat(section, F.lit(": "), rest)).otherwise(section), 1, TITLE_LENGTH), otherwise)


def is_good_title(t: Column, name: Column) -> Column:
    first = F.substring(t, 1, 1)
    return (F.length(t) >= 18) & (F.upper(first) == first) & (F.lower(first) != first) & ~F.regexp_like(F.rtrim(t), F.lit("(,| que| de| y)$")) & ~t.eqNullSafe(name)


def source_office(text: Column) -> Column:
    found = F.trim(F.regexp_extract(text, SOURCE, 1))
    return F.when(found != "", found)


def slide_code(source: Column, page: Column) -> Column:
    return F.format_string("%s-P%03d", source, page)


def header_labels(slides: DataFrame, nodes: DataFrame) -> DataFrame:
    """evidencia, marco, nodo, rol, estado from the headers of programme slides: the characteristic, else the factor."""
    known = nodes.where("marco = 'CNA'").select(F.col("codigo").alias("nodo"))
    car, factor = F.format_string("C%02d", "car"), F.format_string("F%02d", "factor")
    wanted = slides.where("NOT startswith(fuente, 'I')").select(slide_code(F.col("fuente"), F.col("pagina")).alias("evidencia"), F.when(F.col("car").isNotNull(), car).alias("c"), F.when(F.col("factor") > 0, factor).alias("f"))
    with_car = wanted.join(known.withColumnRenamed("nodo", "c"), "c", "left_semi").select("evidencia", F.col("c").alias("nodo"))
    rest = wanted.join(with_car, "evidencia", "left_anti").where("f IS NOT NULL").select("evidencia", F.col("f").alias("nodo"))
    return with_car.unionByName(rest).select("evidencia", F.lit("CNA").alias("marco"), "nodo", F.lit("principal").alias("rol"), F.lit("validada").alias("estado"))


def institutional_labels(slides: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """As header_labels for institutional slides, with what their node's correspondences imply for the programme."""
    known = nodes.where("marco = 'CNA-INST'").select(F.col("codigo").alias("nodo"))
    each = slides.where("startswith(fuente, 'I')").select(slide_code(F.col("fuente"), F.col("pagina")).alias("evidencia"), F.explode(F.array(F.struct(F.lit(0).alias("k"), F.format_string("IC%02d", "car").alias("nodo")), F.struct(F.lit(1).alias("k"), F.format_string("IF%02d", "factor").alias("nodo")))).alias("x")).select("evidencia", "x.*")
    own = each.join(known, "nodo", "left_semi").groupBy("evidencia").agg(F.min_by("nodo", "k").alias("nodo"))
    direct = own.select("evidencia", F.lit("CNA-INST").alias("marco"), "nodo", F.lit("principal").alias("rol"), F.lit("validada").alias("estado"))
    over = edges.where("marco_origen = 'CNA-INST' AND marco_destino = 'CNA' AND estado <> 'descartada'").select(F.col("origen").alias("nodo"), "destino", F.when(F.col("tipo") == "apoyo", 2).otherwise(1).alias("w"))
    implied = own.join(over, "nodo").groupBy("evidencia", "destino").agg(F.min("w").alias("w")).select("evidencia", F.lit("CNA").alias("marco"), F.col("destino").alias("nodo"), role_of(F.col("w")).alias("rol"), F.lit("propuesta").alias("estado"))
    return direct.unionByName(implied)


def dotted_chain(code: Column, separator: str = ".") -> Column:
    """A dotted code and its ancestors, the most specific first."""
    parts = F.split(code, "[" + separator + "]")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), separator))


def ancestors(df: DataFrame, code: str, order: str) -> DataFrame:
    """df with `chain`: section codes to try against rules, the most specific first.

    A heading without number inherits the chain of the last numbered section of its document, unless it is front or back
    matter. The order matters only within a document, so the look-back window is partitioned by document.
    """
    c = F.col(code)
    section, annex = r"^(DM\d+)-(\d+(?:\.\d+)*)(-\d+)?$", r"^(AX-\d+)-\d+$"
    doc, number, suffix = (F.regexp_extract(c, section, k) for k in (1, 2, 3))
    own = F.when(doc != "", F.transform(dotted_chain(number), lambda x: F.concat(doc, F.lit("-"), x, suffix)))
    document = F.regexp_extract(c, r"^(DM\d+)-", 1)
    w = Window.partitionBy("__doc").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("__doc", F.when(document != "", document).otherwise(c)).withColumn("__own", own).withColumn("__last", F.last("__own", ignorenulls=True).over(w))
    inherits = (document != "") & F.col("__last").isNotNull() & ~F.regexp_like(c, F.lit("PORTADA|BIBLIOGRAF|REFERENCIAS"))
    chain = F.coalesce("__own", F.when(F.regexp_like(c, F.lit(annex)), F.array(c, F.regexp_extract(c, annex, 1))), F.when(inherits, F.concat(F.array(c), F.col("__last"))), F.array(c))
    return out.withColumn("chain", chain).drop("__doc", "__own", "__last")


def tag_by_rules(df: DataFrame, item: str, chain: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """item, nodo, rol: of the rules (pattern, node, role) those that match at the most specific level with any match.

    The rules are literals (a short list), so every pattern is compiled once and no join is needed.
    """
    def levels(pattern: str) -> Column:
        return F.transform(F.col(chain), lambda code: F.regexp_like(code, F.lit(pattern)))

    hits = F.array(*[F.struct(F.lit(node).alias("nodo"), weakness(F.lit(role)).alias("w"), levels(pattern).alias("at")) for pattern, node, role in rules])
    found = df.select(item, F.explode(hits).alias("h")).withColumn("first", F.array_position("h.at", True)).where("first > 0")
    best = found.withColumn("level", F.min("first").over(Window.partitionBy(item)))
    kept = best.where(F.element_at("h.at", F.col("level").cast("int")))
    return kept.groupBy(item, F.col("h.nodo").alias("nodo")).agg(role_of(F.min("h.w")).alias("rol"))


def carry_down(df: DataFrame, key: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """df with the last value that is not null so far, within a key."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


_NORM, _GAP, _VERB = regex.compile(NORM, regex.I), regex.compile(NORM_GAP, regex.I), regex.compile(r"\s+(con|a|al)\b", regex.I)


def cited_norms(text: str) -> list[tuple[str, int, int, str | None]]:
    """(type, number, year, issuer) of each norm that a text cites, in order; a rejected gap resumes after the keyword."""
    flat, at, out = regex.sub(r"\s+", " ", text or ""), 0, []
    while m := _NORM.search(flat, at):
        verb, gap = _VERB.match(flat, m.end(1)), _GAP.search(m[2])
        at = m.end(1) if gap and not verb else m.end()
        year = int(m[4])
        if not verb and not gap and NORM_YEARS[0] <= year <= NORM_YEARS[1]:
            issuer = next((name for name, p in ISSUERS if regex.search(p, m[0])), None)
            out.append(("Acuerdo" if m[1].lower().startswith("acu") else "Resolución", int(m[3]), year, issuer))
    return out


def cited_norms_udf(c: Column | str) -> Column:
    """cited_norms as a vectorised column function."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: [dict(zip(("tipo", "numero", "anio", "organo"), x, strict=True)) for x in cited_norms(t)])

    return F.pandas_udf(run, "array<struct<tipo:string,numero:int,anio:int,organo:string>>")(c)


def load_norms(evidence: DataFrame, excluded: DataFrame, manual: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normativa, normativa_mencion) from evidence (codigo, texto, orden): issuers are the first known in that order, manual ones win."""
    key = ["tipo", "numero", "anio"]
    found = evidence.select("codigo", "orden", F.posexplode(cited_norms_udf("texto")).alias("at", "n")).select("codigo", "orden", "at", "n.*").join(excluded.select(*key), key, "left_anti")
    by_hand = manual.select(*key, F.col("organo").alias("manual"))
    written = evidence.join(small(manual.select(*key, "texto_a_buscar")), F.expr("contains(texto, texto_a_buscar)")).select("codigo", *key)
    norms = found.groupBy(*key).agg(F.min_by("organo", F.when(F.col("organo").isNotNull(), F.struct("orden", "at"))).alias("organo"))
    norms = norms.join(by_hand, key, "full").select(*key, F.coalesce("manual", "organo").alias("organo"))
    return norms, found.select("codigo", *key).unionByName(written).distinct()
