"""A copy for sharing: persons, mail addresses and credentials masked, texts withheld by policy, tables of people dropped."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.text import EMAIL, MAIL_OMITTED, OMITTED, hide_credentials, let

#: What names a leader, who counts as a person, the notice in place of a text.
LEADER = r"(?iu)((?:nombre\s+(?:del\s+)?)?(?:profesor|docente)(?:a)?\s+l[ií]der:?)[^\n]*"
LEADER_CAI = r"((?iu:l[ií]der\s+CAI))[ \t]+[^\n]+"
LEADER_NEXT = r"((?iu:nombre\s+(?:del\s+)?profesor)[^\n]*\n[ \t]*)((?:[A-ZÁÉÍÓÚÑ][A-Za-zÁÉÍÓÚÑáéíóúñ]+[ \t]+){1,4}[A-ZÁÉÍÓÚÑ][A-Za-zÁÉÍÓÚÑáéíóúñ]+)"
PEOPLE = r"(?iu)profesor|docente|investigador|estudiante|egresad|graduad|integrante"
NOTICE = "[Texto omitido en la versión para compartir: {motivo}. Está en la versión completa del índice.]"


def _guarded(applies: Callable[[Column], Column], change: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda t: F.when(applies(t), change(t)).otherwise(t)


def mask(c: Column) -> Column:
    """Mail addresses, leaders' names (on the next line, then on the same), credentials, in this order."""
    # A plain test comes before each pattern; the mail pattern begins at the first sign of a word only, so words are read once.
    has = lambda t, word: F.regexp_like(t, F.lit("(?iu)" + word))
    steps = (
        (lambda t: t.contains("@"), lambda t: F.regexp_replace(t, r"(?<![\w.+-])" + EMAIL, MAIL_OMITTED)),
        (lambda t: has(t, "profesor"), lambda t: F.regexp_replace(t, LEADER_NEXT, "$1" + OMITTED)),
        (lambda t: has(t, "l[ií]der"), lambda t: F.regexp_replace(F.regexp_replace(t, LEADER, "$1 " + OMITTED), LEADER_CAI, "$1 " + OMITTED)),
        (lambda t: t.contains(":") | t.contains("="), hide_credentials),
    )
    for step in steps:
        c = let(c, _guarded(*step))
    return c


def first_policy(code: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The motive of the first rule (pattern, motive) that a code matches, else null."""
    out = F.lit(None).cast("string")
    for pattern, motive in reversed(rules):
        out = F.when(F.regexp_like(code, F.lit(pattern)), motive).otherwise(out)
    return out


def lists_people(cells: Column, people: str = PEOPLE, name: str = "nombre") -> Column:
    """Whether a table's first two rows name a name and a kind of person."""
    head = F.lower(F.array_join(F.flatten(F.slice(cells, 1, 2)), " "))
    return head.contains(name) & F.regexp_like(head, F.lit(people))


def redact(evidence: DataFrame, tables: DataFrame, pads: DataFrame, rules: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(evidence, tables, pads, counters) for sharing; decisions and their authors stay."""
    marked = evidence.withColumn("__why", first_policy(F.col("codigo"), rules))
    held = F.col("__why").isNotNull()
    parts = F.split("titulo", " · ")
    short = F.concat_ws(" · ", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.concat(F.lit("archivo "), F.substring_index("codigo", "-", -1)))
    notice = F.concat(F.lit(NOTICE.split("{motivo}")[0]), "__why", F.lit(NOTICE.split("{motivo}")[1]))
    out = marked.withColumns({
        "titulo": F.when(held & F.regexp_like("codigo", F.lit(r"^AX-\d+-\d+$")), short).otherwise(F.col("titulo")), "texto": F.when(held, notice).otherwise(mask(F.col("texto"))),
        "texto_ocr": F.when(~held, mask(F.col("texto_ocr"))), "archivo": F.when(~held, F.col("archivo")),
    })
    kinds = marked.select(F.col("codigo").alias("evidencia"), F.col("tipo").alias("__kind"), held.alias("__held"))
    seen = tables.join(kinds, "evidencia").withColumn("__gone", F.col("__held") | (F.col("__kind").isin("documento_maestro", "anexo") & lists_people(F.col("celdas"))))
    left = seen.where("NOT __gone").withColumn("celdas", F.transform("celdas", lambda r: F.transform(r, mask))).select(*tables.columns)
    plans = pads.withColumns({c: mask(F.col(c)) for c in ("justificacion", "acciones") if c in pads.columns})
    counters = marked.agg(F.count("__why").alias("evidencias_omitidas")).crossJoin(seen.agg(F.count(F.when(F.col("__gone"), 1)).alias("tablas_quitadas")))
    return out.drop("__why"), left, plans, counters
