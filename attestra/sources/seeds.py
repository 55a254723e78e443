"""Typed scan of seed CSV files: exact header, trimmed cells, empty cells null, numbers parsed without stopping the job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.text import strip_unicode
from attestra.operators.validation import SHOWN, SeedError, require_valid

from .schema import SEED_DOUBLES, SEED_INTS, SEEDS, TEXT_IF_EMPTY, conform, empty_base


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A seed table with `row`, the row's number in the file.

    A seed is one small file, so it is one partition and its rows keep their order. Raises SeedError if the header differs or
    a number cannot be read.
    """
    path, columns = f"{folder}/{name}.csv", SEEDS[name].split()
    # The first line alone, for the exact header; Spark's reader also reads it from stores that only it reaches.
    head = spark.read.text(path).limit(1).collect()
    found = head[0][0].lstrip("﻿").rstrip("\r").split(",") if head else []
    if [c.strip().strip('"') for c in found] != columns:
        raise SeedError(f"{name}: the header is {found}, not {columns}")
    raw = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(path, header=True, multiLine=True, escape='"', enforceSchema=True)
    text = {c: strip_unicode(F.col(c)) for c in columns}
    text = {c: F.coalesce(x, F.lit("")) if c in TEXT_IF_EMPTY else F.when(x != "", x) for c, x in text.items()}
    numbered = raw.select(*[x.alias(c) for c, x in text.items()], (F.monotonically_increasing_id() + 1).alias("row"))
    kinds = {c: "int" for c in SEED_INTS.get(name, ())} | {c: "double" for c in SEED_DOUBLES.get(name, ())}
    bad = F.lit(None).cast("string")
    for c, kind in kinds.items():
        bad = F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.concat(F.lit(f"{name}: row "), "row", F.lit(f", column {c}: not a number: "), c)).otherwise(bad)
    if kinds:
        wrong = [r[0] for r in numbered.select(bad.alias("m")).where("m IS NOT NULL").limit(SHOWN).collect()]
        if wrong:
            raise SeedError("\n".join(wrong))
    return numbered.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()})


def read_all(spark: SparkSession, folder: str, validate: bool = True) -> dict[str, DataFrame]:
    found = {name: read(spark, folder, name) for name in SEEDS}
    if validate:
        require_valid(spark, found)
    return found


def base_from_seeds(spark: SparkSession, s: dict[str, DataFrame], evidence: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables of a base as the seeds alone give them, codes of measurements' evidences that do not exist)."""
    t = empty_base(spark)
    t |= {name: conform(s[seed], name) for name, seed in (("marco", "marcos"), ("nodo", "nodos"), ("indicador", "indicadores"), ("indicador_nodo", "indicador_nodos"), ("curso", "cursos"), ("curso_prerrequisito", "prerrequisitos"))}
    t["correspondencia"] = conform(s["correspondencias"].withColumn("estado", F.lit("propuesta")), "correspondencia")
    t["curso_outcome"] = conform(s["curso_outcomes"], "curso_outcome")
    t["brecha"] = conform(s["brechas"].withColumn("id", F.col("row")).withColumn("estado", F.coalesce("estado", F.lit("abierta"))), "brecha")
    m = s["mediciones"].withColumn("id", F.col("row")).withColumn("sede", F.coalesce("sede", F.lit("Programa")))
    missing = m.where("evidencia IS NOT NULL").select("evidencia").distinct()
    if evidence is not None:
        known = evidence.select(F.col("codigo").alias("evidencia"), F.lit(True).alias("__known"))
        missing = missing.join(known, "evidencia", "left_anti")
        m = m.join(known, "evidencia", "left").withColumn("evidencia", F.when(F.col("__known"), F.col("evidencia")))
        t["evidencia"] = conform(evidence, "evidencia")
    t["medicion"] = conform(m, "medicion")
    return t, missing
