"""Reconciling a new load with the previous snapshot: one full outer join by natural key gives every row its action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed(fields: Sequence[str], old: str = "old", new: str = "new") -> Column:
    """Whether any field differs, null being a value like others."""
    out = F.lit(False)
    for f in fields:
        out = out | ~F.col(f"{old}.{f}").eqNullSafe(F.col(f"{new}.{f}"))
    return out


def reconcile(current: DataFrame, desired: DataFrame, key: Sequence[str], compare: Sequence[str], protected: Column | None = None, revive: Column | None = None) -> DataFrame:
    """key, old and new (structs, null where absent), action.

    insert, update, keep as the compared fields tell; protected for a row that a person decided and the load would change
    or drop; obsolete for a row that the load no longer has. protected and revive are conditions on current's columns;
    a row that meets revive is updated even if nothing differs.
    """
    cur = current.select(*key, F.struct(*[c for c in current.columns if c not in key]).alias("old"), F.coalesce(protected if protected is not None else F.lit(False), F.lit(False)).alias("__protected"), F.coalesce(revive if revive is not None else F.lit(False), F.lit(False)).alias("__revive"))
    new = desired.select(*key, F.struct(*compare).alias("new"))
    both = cur.join(new, list(key), "full")
    differs = changed(compare) | F.col("__revive")
    action = (
        F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), F.when(F.col("__protected"), "protected").otherwise("obsolete"))
        .when(~differs, "keep").when(F.col("__protected"), "protected").otherwise("update")
    )
    return both.select(*key, "old", "new", action.alias("action"))


def summarise(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def upsert_frameworks(current: DataFrame, seeds: DataFrame) -> DataFrame:
    """Frameworks of both; the seeds' attributes win."""
    return seeds.unionByName(current.join(seeds, "codigo", "left_anti"), allowMissingColumns=True)


def upsert_nodes(current: DataFrame, seeds: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(nodes, surplus): surplus nodes stay and are reported; the time of change moves only if an attribute differs."""
    key, fields = ["marco", "codigo"], ["nombre", "descripcion", "tipo", "padre", "orden"]
    actions = reconcile(current, seeds, key, fields)
    touched = F.when(F.col("action").isin("insert", "update"), now).otherwise(F.col("old.actualizado_en"))
    pick = [F.when(F.col("action").isin("insert", "update"), F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields]
    return actions.select(*key, *pick, touched.alias("actualizado_en")), actions.where("action = 'obsolete'").select(*key)


def reconcile_edges(current: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(correspondences, actions): decided ones stay as they are, others follow the seeds or go."""
    key, fields = ["marco_origen", "origen", "marco_destino", "destino"], ["tipo", "nota"]
    actions = reconcile(current, seeds, key, fields, F.col("validado_por").isNotNull())
    live = actions.where("action <> 'obsolete'")
    take = F.col("action").isin("insert", "update")
    out = live.select(*key, *[F.when(take, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields], F.coalesce("old.estado", F.lit("propuesta")).alias("estado"), F.col("old.validado_por").alias("validado_por"))
    return out, actions.select(*key, "action")


EVIDENCE_FIELDS = ["titulo", "tipo", "texto", "texto_ocr", "fuente", "archivo", "pagina", "sede", "proceso", "nivel"]


def reconcile_evidence(current: DataFrame, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(evidence, actions): what is no longer loaded becomes obsolete, what comes back is to be reviewed again."""
    actions = reconcile(current, loaded, ["codigo"], EVIDENCE_FIELDS, revive=F.col("estado_revision") == "obsoleta")
    take = F.col("action").isin("insert", "update")
    state = F.when(F.col("action") == "obsolete", "obsoleta").when((F.col("action") == "insert") | (F.col("old.estado_revision") == "obsoleta"), "sin_revisar").otherwise(F.col("old.estado_revision"))
    out = actions.select("codigo", *[F.when(take, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in EVIDENCE_FIELDS], state.alias("estado_revision"))
    told = F.when((F.col("action") == "obsolete") & (F.col("old.estado_revision") == "obsoleta"), "keep").otherwise(F.col("action"))
    return out, actions.select("codigo", told.alias("action"))


def reconcile_labels(current: DataFrame, desired: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, actions) of extracted labels.

    A pair that has a label of any origin gets no other; roles follow the load unless a person decided; a label that is no
    longer extracted goes only if its evidence is live and nobody decided. desired: evidencia, marco, nodo, rol, estado.
    """
    key = ["evidencia", "marco", "nodo"]
    want = desired.select(*key, F.col("rol").alias("__rol"), F.col("estado").alias("__estado"))
    both = current.withColumn("__here", F.lit(True)).join(want, key, "full").join(live.select("evidencia", F.lit(True).alias("__live")), "evidencia", "left")
    mine = F.coalesce(F.col("origen") == "extraccion", F.lit(False)) & F.col("validado_por").isNull()
    action = (
        F.when(F.col("__here").isNull(), "insert").when(F.col("__rol").isNotNull() & (F.col("origen") != "extraccion"), "ignored")
        .when(F.col("__rol").isNotNull() & mine & (F.col("rol") != F.col("__rol")), "update").when(F.col("__rol").isNull() & mine & F.col("__live").isNotNull(), "delete").otherwise("keep")
    )
    marked = both.withColumn("action", action)
    new = F.col("action") == "insert"
    out = marked.where("action <> 'delete'").select(
        *key, F.when(F.col("action").isin("insert", "update"), F.col("__rol")).otherwise(F.col("rol")).alias("rol"), F.when(new, "extraccion").otherwise(F.col("origen")).alias("origen"),
        F.when(new, F.col("__estado")).otherwise(F.col("estado")).alias("estado"), "validado_por",
    )
    return out, marked.select(*key, "action")


def backfill_min(df: DataFrame, key: str, value: str, source: DataFrame, source_key: str, source_value: str) -> DataFrame:
    """df with null values taken from the least value of its key in source."""
    least = source.groupBy(F.col(source_key).alias(key)).agg(F.min(source_value).alias("__least"))
    return df.join(least, key, "left").withColumn(value, F.coalesce(value, "__least")).drop("__least")


def two_way_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a without an equal in b (side 'a') and the reverse (side 'b'); null equals null, repeats stay."""
    def only(x: DataFrame, y: DataFrame, side: str) -> DataFrame:
        other = y.select(*[F.col(c).alias(f"__{c}") for c in y.columns]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in x.columns]
        return x.join(other, same, "left_anti").withColumn("side", F.lit(side))

    return only(a, b.select(*a.columns), "a").unionByName(only(b.select(*a.columns), a, "b"))
