"""Human decisions as an append-only log; a label's or edge's state is what its log says last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.roles import ROLES

#: Actions and the states they lead to.
STATE_OF = {"validar": "validada", "descartar": "descartada", "reabrir": "propuesta"}
LOG = "fecha timestamp, objeto string, referencia string, accion string, rol string, estado_anterior string, estado_nuevo string, validador string, comentario string"


class InvalidDecision(ValueError):
    """A decision that must not be recorded."""


def check(action: str, validator: str, role: str | None = None) -> None:
    if action not in (*STATE_OF, "agregar"):
        raise InvalidDecision(f"unknown action: {action}")
    if not (validator or "").strip():
        raise InvalidDecision("a validator is needed")
    if role is not None and role not in ROLES:
        raise InvalidDecision(f"unknown role: {role}")


def reference(*parts: Column) -> Column:
    """FRAMEWORK/NODE -> FRAMEWORK/NODE."""
    pairs = [F.concat_ws("/", a, b) for a, b in zip(parts[::2], parts[1::2], strict=True)]
    return F.concat_ws(" → ", *pairs)


def new_state(action: Column, origin: Column) -> Column:
    """Reopening an extracted label makes it valid again, whatever it was before."""
    return F.when(action == "validar", "validada").when(action == "descartar", "descartada").when(action == "agregar", "validada").when((action == "reabrir") & (origin == "extraccion"), "validada").when(action == "reabrir", "propuesta")


def entry(spark: SparkSession, kind: str, target: DataFrame, key: Sequence[str], action: str, validator: str, comment: str | None = None, role: str | None = None) -> DataFrame:
    """A log row for each target row (key, estado, and for labels origen); raises if nothing is targeted."""
    check(action, validator, role)
    if kind not in ("correspondencia", "etiqueta"):
        raise InvalidDecision(f"unknown object: {kind}")
    if action != "agregar" and target.isEmpty():
        raise InvalidDecision("nothing has this key")
    origin = F.col("origen") if "origen" in target.columns else F.lit(None)
    lit = lambda v: F.lit(v).cast("string")
    return target.select(F.current_timestamp().alias("fecha"), lit(kind).alias("objeto"), F.concat_ws("|", *key).alias("referencia"), lit(action).alias("accion"), lit(role).alias("rol"), F.col("estado").alias("estado_anterior"), new_state(F.lit(action), origin).alias("estado_nuevo"), lit(validator.strip()).alias("validador"), lit(comment).alias("comentario"))


def fold(log: DataFrame, key: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The last row of each key in the log's order: partial aggregation keeps one row a key before the shuffle."""
    return log.groupBy(*key).agg(F.max_by(F.struct(*fields), F.struct(*order)).alias("x")).select(*key, "x.*")


def apply_log(rows: DataFrame, log: DataFrame, kind: str, key: Sequence[str]) -> DataFrame:
    """rows with state, validator and role as the log's last word for each has it; a reopened row has no validator.

    Labels added by hand that rows lack come in with origin manual.
    """
    last = fold(log.where(F.col("objeto") == kind), ["referencia"], ["fecha"], ["accion", "rol", "estado_nuevo", "validador"])
    roles = fold(log.where((F.col("objeto") == kind) & (F.col("accion") == "agregar")), ["referencia"], ["fecha"], [F.col("rol").alias("added")])
    marked = rows.withColumn("referencia", F.concat_ws("|", *key)).join(last, "referencia", "left") if "rol" not in rows.columns else rows.withColumn("referencia", F.concat_ws("|", *key)).join(last.drop("rol"), "referencia", "left")
    out = marked.withColumn("estado", F.coalesce("estado_nuevo", "estado")).withColumn("validado_por", F.when(F.col("accion") == "reabrir", None).otherwise(F.coalesce("validador", "validado_por")))
    if "rol" in rows.columns:
        out = out.join(roles, "referencia", "left").withColumn("rol", F.coalesce("added", "rol"))
        new = last.where("accion = 'agregar'").join(marked, "referencia", "left_anti").withColumn("__k", F.split("referencia", "[|]"))
        out = out.select(*rows.columns).unionByName(new.select(*[F.col("__k")[k].alias(c) for k, c in enumerate(key)], "rol", F.lit("manual").alias("origen"), F.col("estado_nuevo").alias("estado"), F.col("validador").alias("validado_por")), allowMissingColumns=True)
    return out.select(*rows.columns)


def audit(log: DataFrame, n: int = 500) -> DataFrame:
    """The latest decisions: a top-n, not a full sort."""
    return log.orderBy(F.desc("fecha"), F.desc("referencia")).limit(n)
