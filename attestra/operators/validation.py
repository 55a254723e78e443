"""Rules over the seed tables: each gives the rows that break it, as (rule, message)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Messages that an error shows at most; a report for people, all broken rows are in the frame.
SHOWN = 30


class SeedError(ValueError):
    """Seeds that break rules."""


def _told(df: DataFrame, rule: str, message: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), message.alias("message"))


def _said(*cols: str) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in cols])


def missing_reference(df: DataFrame, cols: Sequence[str], target: DataFrame, target_cols: Sequence[str], rule: str) -> DataFrame:
    """Rows whose reference (unless all null) has no row in target."""
    named = target.select(*[F.col(t).alias(f"__{k}") for k, t in enumerate(target_cols)]).distinct()
    given = df.where(" OR ".join(f"`{c}` IS NOT NULL" for c in cols))
    return _told(given.join(named, [F.col(c) == F.col(f"__{k}") for k, c in enumerate(cols)], "left_anti"), rule, _said(*cols))


def broken(df: DataFrame, condition: Column, cols: Sequence[str], rule: str) -> DataFrame:
    """Rows that do not meet a condition; unknown counts as met."""
    return _told(df.where(~F.coalesce(condition, F.lit(True))), rule, _said(*cols))


def repeated(df: DataFrame, cols: Sequence[str], rule: str) -> DataFrame:
    given = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    return _told(given.groupBy(*cols).count().where("count > 1"), rule, _said(*cols))


def outside(df: DataFrame, col: str, values: Sequence[str], cols: Sequence[str], rule: str) -> DataFrame:
    return broken(df, F.col(col).isin(*values), cols, rule)


def all_of(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The vocabularies of seed columns.
DOMAINS = {
    "categoria_atmae": ("educacion_general", "matematicas", "ciencias_fisicas", "ciencias_vida", "gestion", "tecnica", "electivas"),
    "modulo_cin": ("basico", "comun_agricola", "tecnologia_especifica", "tfg", "transversal"),
    "proceso": ("acreditacion", "resignificacion", "ambos"),
    "nivel": ("principal", "complementaria", "escenario"),
    "outcome_nivel": ("I", "R", "E"),
    "estado": ("propuesta", "validada", "descartada"),
    "rol": ("principal", "parcial", "apoyo"),
}
LEVELLING = "Diagnóstico y nivelatorio"


def bad_patterns(patterns: Iterable[str], spark: SparkSession | None = None) -> list[str]:
    """Patterns that do not compile, in Python or, given a session, in Java, where rules run; a short list of the driver."""
    out = []
    for p in patterns:
        try:
            re.compile(p or "(")
            if spark is not None:
                spark._jvm.java.util.regex.Pattern.compile(p)
        except (re.error, Py4JError):
            out.append(p)
    return out


def seed_rules(s: dict[str, DataFrame]) -> DataFrame:
    """Every rule over the seeds (see sources.seeds for the tables), as one frame of (rule, message)."""
    n, co = s["nodos"], s["cursos"]
    up = n.select(F.col("marco").alias("m"), F.col("codigo").alias("p"), F.col("row").alias("r"))
    late = n.where("padre IS NOT NULL").join(up, (F.col("marco") == F.col("m")) & (F.col("padre") == F.col("p")) & (F.col("r") < F.col("row")), "left_anti")
    pre, out = s["prerrequisitos"], s["curso_outcomes"]
    eac = n.where("marco = 'ABET-EAC' AND startswith(codigo, 'SO')")
    cna = n.where("marco = 'CNA'")
    req = pre.where(~F.col("requisito").startswith(LEVELLING))
    parts = [
        missing_reference(n, ["marco"], s["marcos"], ["codigo"], "V1"), _told(late, "V2", _said("marco", "codigo", "padre")), repeated(n, ["marco", "codigo"], "V3"),
        missing_reference(s["correspondencias"], ["marco_origen", "origen"], n, ["marco", "codigo"], "V4"), missing_reference(s["correspondencias"], ["marco_destino", "destino"], n, ["marco", "codigo"], "V4"),
        broken(s["correspondencias"], F.col("marco_origen") != F.col("marco_destino"), ["marco_origen", "origen", "destino"], "V5"),
        missing_reference(s["indicador_nodos"], ["indicador"], s["indicadores"], ["codigo"], "V6"), missing_reference(s["indicador_nodos"], ["marco", "nodo"], n, ["marco", "codigo"], "V7"),
        missing_reference(s["mediciones"], ["indicador"], s["indicadores"], ["codigo"], "V8"), broken(s["mediciones"], F.col("valor").isNotNull(), ["indicador", "periodo"], "V9"),
        missing_reference(s["pad_curso"], ["curso"], co, ["nombre"], "V10"), missing_reference(pre, ["curso"], co, ["nombre"], "V11"), missing_reference(req, ["requisito"], co, ["nombre"], "V12"),
        missing_reference(out, ["curso"], co, ["nombre"], "V13"), missing_reference(out, ["outcome"], eac, ["codigo"], "V14"), outside(out, "nivel", DOMAINS["outcome_nivel"], ["curso", "outcome", "nivel"], "V15"),
        outside(out, "estado", DOMAINS["estado"], ["curso", "outcome", "estado"], "V16"), broken(out, (F.col("estado") != "validada") | F.col("validado_por").isNotNull(), ["curso", "outcome"], "V17"), repeated(out, ["curso", "outcome"], "V18"),
        outside(co, "categoria_atmae", DOMAINS["categoria_atmae"], ["nombre", "categoria_atmae"], "V19"), outside(co, "modulo_cin", DOMAINS["modulo_cin"], ["nombre", "modulo_cin"], "V20"), repeated(co, ["numero"], "V21"),
        outside(s["documentos"], "proceso", DOMAINS["proceso"], ["prefijo", "proceso"], "V22"), outside(s["documentos"], "nivel", DOMAINS["nivel"], ["prefijo", "nivel"], "V22"),
        broken(s["privacidad"], F.coalesce(F.col("motivo"), F.lit("")) != "", ["patron"], "V23"), missing_reference(s["documento_nodos"], ["nodo"], cna, ["codigo"], "V24"), outside(s["documento_nodos"], "rol", DOMAINS["rol"], ["patron", "rol"], "V24"),
        missing_reference(s["brechas"], ["marco", "nodo"], n, ["marco", "codigo"], "V25"),
    ]
    return all_of(parts)


def require_valid(spark: SparkSession, s: dict[str, DataFrame]) -> None:
    found = [f"{r.rule}: {r.message}" for r in seed_rules(s).limit(SHOWN).collect()]
    for name, rule in (("privacidad", "V23"), ("documento_nodos", "V24")):
        found += [f"{rule}: pattern does not compile: {p}" for p in bad_patterns((r.patron for r in s[name].select("patron").toLocalIterator()), spark)]
    if found:
        raise SeedError("\n".join(found[:SHOWN]))
