"""Projection of labels from source frameworks to target frameworks over weighted edges, and its reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.roles import edge_role, role_of, weakness

#: Target frameworks, and the node of each that improvement plans support.
TARGETS = ("ABET-EAC", "ATMAE-2027", "ANECA-EURACE", "SOFIA")
PLAN_NODE = {"ABET-EAC": "C4", "ATMAE-2027": "A11", "ANECA-EURACE": "E3"}


def strongest(paths: DataFrame, key: Sequence[str], weak: str = "weak") -> DataFrame:
    """Of several paths to one pair the strongest: the least weakness."""
    return paths.groupBy(*key).agg(F.min(weak).alias(weak))


def paths(labels: DataFrame, edges: DataFrame, item: Sequence[str], node: Sequence[str], source: Sequence[str], target: Sequence[str], label_weak: Column, edge_weak: Column) -> DataFrame:
    """item, target, weak of every way over one edge: as weak as the weaker of label and edge."""
    joined = labels.join(edges, [F.col(n) == F.col(s) for n, s in zip(node, source, strict=True)])
    return joined.select(*item, *target, F.greatest(label_weak, edge_weak).alias("weak"))


def desired_labels(t: dict[str, DataFrame], targets: Sequence[str] = TARGETS) -> DataFrame:
    """evidencia, marco, nodo, rol that the extracted labels imply in the target frameworks, all targets in one pass."""
    evidence = t["evidencia"].where("estado_revision <> 'obsoleta'")
    level = F.coalesce("nivel", F.lit("principal"))
    own = t["evidencia_nodo"].where("origen = 'extraccion'")
    usable = evidence.where(level != "escenario").select(F.col("codigo").alias("evidencia"), (level == "complementaria").alias("extra"))
    labels = own.where("estado <> 'descartada'").join(usable, "evidencia").select("evidencia", "marco", "nodo", "rol", "extra")
    edges = t["correspondencia"].where(F.col("estado") != "descartada").where(F.col("marco_destino").isin(*targets)).select("marco_origen", "origen", "marco_destino", "destino", "tipo")
    label_weak = F.when(F.col("extra"), 2).otherwise(weakness(F.col("rol")))
    found = paths(labels, edges, ["evidencia"], ["marco", "nodo"], ["marco_origen", "origen"], ["marco_destino", "destino"], label_weak, weakness(edge_role(F.col("tipo"))))
    # Improvement plans labelled with a factor support one node of each target, as weakly as possible.
    factors = t["nodo"].where("tipo = 'factor'").select("marco", F.col("codigo").alias("nodo"))
    plans = own.join(factors, ["marco", "nodo"], "left_semi").join(evidence.where("tipo = 'plan_mejora'").select(F.col("codigo").alias("evidencia")), "evidencia", "left_semi").select("evidencia").distinct()
    rule = F.array(*[F.struct(F.lit(m).alias("marco_destino"), F.lit(n).alias("destino")) for m, n in PLAN_NODE.items() if m in targets]).cast("array<struct<marco_destino:string,destino:string>>")
    planned = plans.select("evidencia", F.explode(rule).alias("x")).select("evidencia", "x.*", F.lit(2).alias("weak"))
    best = strongest(found.unionByName(planned), ["evidencia", "marco_destino", "destino"])
    known = t["nodo"].select(F.col("marco").alias("marco_destino"), F.col("codigo").alias("destino"))
    return best.join(known, ["marco_destino", "destino"], "left_semi").select("evidencia", F.col("marco_destino").alias("marco"), F.col("destino").alias("nodo"), role_of(F.col("weak")).alias("rol"))


def sync_actions(desired: DataFrame, existing: DataFrame, key: Sequence[str], role: str, managed: Column, decided: Column) -> DataFrame:
    """key, role (desired), role_now, action for each pair that is desired or managed.

    blocked: a label outside the managed ones holds the pair; decided: a person has decided, nothing changes.
    """
    now = existing.select(*key, F.col(role).alias("role_now"), managed.alias("__managed"), decided.alias("__decided"), F.lit(True).alias("__here"))
    want = desired.select(*key, F.col(role).alias("role"), F.lit(True).alias("__want"))
    both = want.join(now, list(key), "full")
    here, wanted, own = (F.coalesce(c, F.lit(False)) for c in ("__here", "__want", "__managed"))
    action = (
        F.when(wanted & ~here, "insert").when(wanted & ~own, "blocked").when(own & F.col("__decided"), "decided")
        .when(wanted & (F.col("role") == F.col("role_now")), "keep").when(wanted, "update").when(own, "delete")
    )
    return both.select(*key, "role", "role_now", action.alias("action")).where("action IS NOT NULL")


def project(t: dict[str, DataFrame], targets: Sequence[str] = TARGETS) -> tuple[DataFrame, DataFrame]:
    """(evidencia_nodo after projection, actions). Only undecided inferred labels of the target frameworks change."""
    labels, key = t["evidencia_nodo"], ["evidencia", "marco", "nodo"]
    managed = (F.col("origen") == "inferida") & F.col("marco").isin(*targets)
    actions = sync_actions(desired_labels(t, targets), labels, key, "rol", managed, F.col("validado_por").isNotNull())
    change = actions.where("action IN ('update', 'delete')").select(*key, F.col("role").alias("__rol"), "action")
    kept = labels.join(change, key, "left").where("NOT action <=> 'delete'").withColumn("rol", F.coalesce("__rol", "rol")).drop("__rol", "action")
    new = actions.where("action = 'insert'").select(*key, F.col("role").alias("rol"), F.lit("inferida").alias("origen"), F.lit("propuesta").alias("estado"))
    return kept.unionByName(new, allowMissingColumns=True), actions


def summary(actions: DataFrame) -> DataFrame:
    """nuevas, rol, retiradas, humanas."""
    n = lambda a: F.count(F.when(F.col("action") == a, 1))
    return actions.agg(n("insert").alias("nuevas"), n("update").alias("rol"), n("delete").alias("retiradas"), n("decided").alias("humanas"))
