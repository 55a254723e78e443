"""Course plans of the institutional fields, read from text that keeps its layout, and the gaps they fill in other readings.

Every field is one column expression over the text, so a table of plans is one projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions import text as tx

#: What the head of an institutional plan says, in capitals, and how many signs the head has.
HEADING = r"CAMPO DE APRENDIZAJE INSTITUCIONAL|CAMPO INSTITUCIONAL|NIVELATORIOS CAI|INFORMACI[ÓO]N GENERAL DEL CAI|NOMBRE DEL CAI|LEARNING FIELD|INSTITUTIONAL LEARNING|CAI CODE|APRENDIZAJE \(CAI?\):|C[ÓO]DIGO DEL CAI?:"
HEAD_LENGTH = 1500
#: Codes of plans that are never institutional, names that are only a file's name, the kind that is set.
OTHER_CODE, FILE_NAME, KIND = r"^(CAD|CFC)\d", r"^PAD|^\d\.|_|V\d", "CAI"
#: Words and Roman numerals of a semester.
SEMESTERS = {
    "primero": 1, "primer": 1, "first": 1, "segundo": 2, "second": 2, "tercero": 3, "tercer": 3, "third": 3, "cuarto": 4, "fourth": 4, "quinto": 5, "fifth": 5, "sexto": 6, "sixth": 6,
    "septimo": 7, "séptimo": 7, "seventh": 7, "octavo": 8, "eighth": 8, "noveno": 9, "ninth": 9, "i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9,
}
#: Where each field stands; several patterns are tried in order.
CODE = (r"C[óo]digo del CAI\s+(CAI\d{6,})|\b(CAI\d{8,})\b",)
NAME = (
    r"Nombre del CAI\s+([^\n]+?)(?:\s{2,}|\n)",
    r"Campo de[ \t]*\n?[ \t]*(\S[^\n]*?)\s*\n\s*Aprendizaje \(CAI?\):",
    r"(?:Campo de\s*\n?\s*Aprendizaje \(CAI?\):|Learning Field|Institutional Learning)\s+([^\n]+?)(?:\s{2,}|\n)",
)
SEMESTER = r"(?:Ubicaci[oó]n\s+Semestral|Semester\s+Location|Semestre|Semester)\s*:?\s*([^\n]{0,30})"
CREDITS = r"(?:N[uú]mero\s+de\s+cr[eé]ditos|Cr[eé]ditos|Cr[eé]dits|Credits)\s*:?\s*\n?\s*(?:[^\d\n]{0,40}\n\s*)?_*(\d)\b"
REQUIRED = r"Prerre?quisit(?:os|es)\s*\(?s?i?\s*[^\n]{0,30}?\)?\s{2,}([^\n]+)"
GENERAL = r"(?s)(?:REA GENERAL\s*\*?|General Learning Outcome|RESULTADOS DE APRENDIZAJE \(RA\)\s*\n\s*General)\s*\n(.{20,1500}?)\n\s*(?:CONSECUTIVO|REA ESPEC|RA ESPEC|Espec[ií]fic|PARA EL LOGRO|PARA LOGRAR|DESCRIPCI[ÓO]N EXPERIENCIA|VIVE UNA EXPERIENCIA|Specific)"
GENERAL_SKIP = r"(?iu)^(Estructura|General)$"
SPECIFIC = r"(?s)(?:CONSECUTIVO\s+REA ESPEC[IÍ]FICO|REA ESPEC[IÍ]FICOS?)\s*\n(.{20,4000}?)\n\s*(?:PARA EL LOGRO|PARA LOGRAR|DESCRIPCI)"
EXPERIENCE = r"(?m)(?<!DESCRIPCIÓN )(?<!DESCRIPCION )(?<!Descripción )Experiencia(?:/Problema/Comportamiento)?\s*:[ \t]?([^\n]*?)(?=\s{2,}|$)[^\n]*\n(\s*[^\n]*)"
EXPERIENCE_SKIP = r"(?iu)^(Semestre|Descripci)"
MORE_EXPERIENCES = (r"Nombre de la\s+([^\n]+)\n\s*Experiencia", r"(?:Name of the|Experience name)\s*:?\s+([^\n]+)")
NO_EXPERIENCE = r"(?iu)^(Experiencia/|Experience$|Description|Descripci|Semestre|Actividad)"
EXPERIENCE_KIND, EXPERIENCE_LENGTH, SHORT_OUTCOME = "vive_experiencia", 200, 20

#: Any case, all of Unicode, lines that end with line feeds only.
FLAGS = "(?iudU)"
LINE_END = r"\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"
FIELDS = "codigo_pdf string, nombre string, semestre int, creditos int, prerrequisitos string, rea_general string, rea array<struct<consecutivo:int,texto:string>>, experiencias array<struct<tipo:string,nombre:string>>"


def tidy(c: Column) -> Column:
    """Single spaces, and none of the signs that fill forms at the ends."""
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" .:*-_"))


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, FLAGS + pattern, group), F.lit(""))


def _first(c: Column, patterns: tuple[str, ...], groups: tuple[int, ...] = (1,)) -> Column:
    return F.coalesce(*[_found(c, p, g) for p in patterns for g in groups])


def _lines(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), LINE_END)


def is_institutional(text: Column) -> Column:
    """Only the head counts: other plans name the institutional fields in their text."""
    return F.regexp_like(F.upper(F.substring(text, 1, HEAD_LENGTH)), F.lit(HEADING))


def semester(text: Column) -> Column:
    """The digit that follows the label, else the first of its words that is an ordinal or a Roman numeral."""
    said = F.lower(tx.strip_unicode(_found(text, SEMESTER)))
    words = F.transform(F.regexp_extract_all(said, F.lit("[a-záéíóú]+"), 0), lambda w: tx.lookup(w, SEMESTERS))
    return F.coalesce(F.regexp_extract(said, r"^_*(\d)", 1).try_cast("int"), F.get(F.filter(words, lambda n: n.isNotNull()), F.lit(0)))


def general_outcome(text: Column) -> Column:
    kept = F.filter(F.transform(_lines(_found(text, GENERAL)), tx.strip_unicode), lambda x: (x != "") & ~F.regexp_like(x, F.lit(GENERAL_SKIP)))
    return F.nullif(tidy(F.array_join(kept, " ")), F.lit(""))


def specific_outcomes(text: Column) -> Column:
    """array<struct<consecutivo, texto>>: a line with a digit before it opens an outcome, others go on; short ones are none."""
    opens = r"(?U)^\s*(\d)\s+(.*)$"
    none = F.array().cast("array<struct<consecutivo:int,texto:string>>")

    def outcome(number: Column, said: Column) -> Column:
        return F.array(F.struct(number.cast("int").alias("consecutivo"), said.alias("texto")))

    def step(done: Column, line: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), outcome(last["consecutivo"], tx.strip_unicode(F.concat(last["texto"], F.lit(" "), tx.strip_unicode(line)))))
        opened = outcome(F.regexp_extract(line, opens, 1).try_cast("int"), tx.strip_unicode(F.regexp_extract(line, opens, 2)))
        begun = F.when(F.size(done) == 0, outcome(F.lit(1), tx.strip_unicode(line))).otherwise(longer)
        return F.when(F.regexp_like(line, F.lit(opens)), F.concat(done, opened)).otherwise(begun)

    lines = F.filter(_lines(_found(text, SPECIFIC)), lambda x: tx.strip_unicode(x) != "")
    tidied = F.transform(F.aggregate(lines, none, step), lambda x: F.struct(x["consecutivo"].alias("consecutivo"), tidy(x["texto"]).alias("texto")))
    return F.filter(tidied, lambda x: F.length(x["texto"]) > SHORT_OUTCOME)


def experience_names(text: Column) -> Column:
    """Names beside or below their labels, in order, each once whatever its case."""
    of = lambda pattern, group=1: F.regexp_extract_all(text, F.lit(FLAGS + pattern), group)
    below = F.transform(of(EXPERIENCE, 2), lambda x: tidy(F.get(F.split(tx.strip_unicode(x), r"(?U)\s{3,}"), F.lit(0))))
    titled = F.zip_with(of(EXPERIENCE), below, lambda a, b: F.when(tidy(a) != "", tidy(a)).otherwise(b))
    titled = F.filter(titled, lambda x: ~F.regexp_like(x, F.lit(EXPERIENCE_SKIP)))
    names = F.concat(titled, *[F.transform(of(p), tidy) for p in MORE_EXPERIENCES])
    real = F.filter(names, lambda x: (F.length(x) > 3) & ~F.regexp_like(x, F.lit(NO_EXPERIENCE)))
    return tx.let(real, lambda r: tx.let(F.transform(r, F.lower), lambda low: F.transform(F.filter(r, lambda x, k: F.array_position(low, F.lower(x)) == k + 1), lambda x: F.substring(x, 1, EXPERIENCE_LENGTH))))


def read_plans(texts: DataFrame) -> DataFrame:
    """archivo and FIELDS of the institutional plans among texts (archivo, texto with its layout); pages may end with form feeds."""
    t = F.col("texto")
    whole = texts.select("archivo", F.replace("texto", F.lit("\f"), F.lit("\n")).alias("texto")).where(is_institutional(t))
    experience = F.transform(experience_names(t), lambda n: F.struct(F.lit(EXPERIENCE_KIND).alias("tipo"), n.alias("nombre")))
    return whole.select(
        "archivo", _first(t, CODE, (1, 2)).alias("codigo_pdf"), F.nullif(tidy(_first(t, NAME)), F.lit("")).alias("nombre"), semester(t).alias("semestre"),
        _found(t, CREDITS).try_cast("int").alias("creditos"), F.nullif(tidy(_found(t, REQUIRED)), F.lit("")).alias("prerrequisitos"), general_outcome(t).alias("rea_general"),
        specific_outcomes(t).alias("rea"), experience.alias("experiencias"),
    )


def complement_plans(pads: DataFrame, texts: DataFrame) -> DataFrame:
    """pads (codigo, archivo and FIELDS) with what is empty in institutional plans filled from their texts, and tipo_campo.

    What a plan has already stays, but for a name that is only a file's name. Plans with codes of other courses are left alone.
    rea and experiencias may have more fields than read_plans knows: those are null.
    """
    names = ["codigo_pdf", "nombre", "semestre", "creditos", "prerrequisitos", "rea_general", "rea", "experiencias"]
    kinds = {f.name: f.dataType for f in pads.schema}
    read = read_plans(texts.join(pads.where(~F.regexp_like(F.coalesce("codigo", F.lit("")), F.lit(OTHER_CODE))).select("archivo").distinct(), "archivo", "left_semi"))
    other = read.select(F.col("archivo").alias("__file"), *[_as(F.col(c), kinds[c]).alias(f"__{c}") for c in names])
    both = pads.join(other, pads["archivo"] == other["__file"], "left")
    ours = F.col("__file").isNotNull() & ~F.regexp_like(F.coalesce("codigo", F.lit("")), F.lit(OTHER_CODE))
    empty = {c: F.col(c).isNull() for c in names}
    empty |= {c: F.coalesce(c, F.lit("")) == "" for c in ("codigo_pdf", "prerrequisitos", "rea_general")}
    empty |= {c: F.coalesce(F.size(c) <= 0, F.lit(True)) for c in ("rea", "experiencias")}
    empty["nombre"] = (F.coalesce("nombre", F.lit("")) == "") | F.regexp_like("nombre", F.lit(FILE_NAME))
    filled = {c: F.when(ours & empty[c] & F.col(f"__{c}").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in names}
    filled["codigo"] = F.when(ours & empty["codigo_pdf"] & F.col("__codigo_pdf").isNotNull(), F.col("__codigo_pdf")).otherwise(F.col("codigo"))
    kept = [filled[c].alias(c) if c in filled else F.col(c) for c in pads.columns if c != "tipo_campo"]
    old = F.col("tipo_campo") if "tipo_campo" in pads.columns else F.lit(None).cast("string")
    return both.select(*kept, F.when(ours, KIND).otherwise(old).alias("tipo_campo"))


def _as(c: Column, kind) -> Column:
    """A column in another type; structs in arrays get the fields that they lack, as empty lists or nulls."""
    if kind.typeName() != "array" or kind.elementType.typeName() != "struct":
        return c.cast(kind)
    known = {"consecutivo", "texto"} if "consecutivo" in kind.elementType.names else {"tipo", "nombre"}
    lacking = lambda f: F.array().cast(f.dataType) if f.dataType.typeName() == "array" else F.lit(None).cast(f.dataType)
    return F.transform(c, lambda x: F.struct(*[(x[f.name].cast(f.dataType) if f.name in known else lacking(f)).alias(f.name) for f in kind.elementType]))
