"""Exports: CSV files, one nested document, a page with its data inside, and the gate before publishing."""

from __future__ import annotations

import base64
import io
import json
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.operators import redaction
from attestra.plans import views

#: Tables that no export has, and the mark of a redacted page.
NOT_EXPORTED = ("meta", "curso_prerrequisito")
SHARED = '"version": "compartir"'


def flat(df: DataFrame) -> DataFrame:
    """df with nested columns as JSON text, which CSV can hold."""
    return df.select(*[F.to_json(c).alias(c) if dict(df.dtypes)[c].startswith(("array", "struct", "map")) else F.col(c) for c in df.columns])


def to_csv(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """One CSV folder a table, written by the executors."""
    names = [n for n in tables if n not in NOT_EXPORTED]
    for n in names:
        flat(tables[n]).write.mode("overwrite").csv(f"{folder}/{n}", header=True, quoteAll=False, escape='"')
    return names


def to_zip(tables: dict[str, DataFrame], most_rows: int = 100_000) -> bytes:
    """A zip of CSV files with byte order mark, for people; refuses tables too large for one file."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in sorted(set(tables) - set(NOT_EXPORTED)):
            df = flat(tables[n])
            if df.limit(most_rows + 1).count() > most_rows:
                raise ValueError(f"{n} has more than {most_rows} rows; use to_csv")
            z.writestr(f"{n}.csv", "﻿" + df.toPandas().to_csv(index=False))
    return out.getvalue()


def _parts(t: views.Base, frameworks: tuple[str, ...]) -> dict[str, DataFrame]:
    out = {name: view(t) for name, view in views.VIEWS.items()}
    out |= {f"nodos_{f}": views.node_details(t, f) for f in frameworks}
    return out | {"evidencias": views.evidence_feed(t), "indicadores": views.indicator_series(t), "normativa": views.norms_cited(t), "brechas": views.gaps_by_severity(t), "matriz": views.course_matrix(t), "ruta": views.study_route(t), "cursos": views.courses_sorted(t)}


FRAMEWORKS = ("ABET-EAC", "ATMAE-2027", "ANECA-EURACE", "SOFIA")


def document(t: views.Base, frameworks: tuple[str, ...] = FRAMEWORKS, most_rows: int = 100_000, **more) -> dict:
    """The nested document of a dashboard for one page; a part of more rows is refused, write_document has no such limit."""

    def rows(name: str, df: DataFrame) -> list:
        found = df.limit(most_rows + 1).toJSON().collect()
        if len(found) > most_rows:
            raise ValueError(f"{name} has more than {most_rows} rows; use write_document")
        return [json.loads(x) for x in found]

    return {name: rows(name, df) for name, df in _parts(t, frameworks).items()} | more


def write_document(t: views.Base, folder: str, frameworks: tuple[str, ...] = FRAMEWORKS) -> list[str]:
    """The same parts as JSON lines, a folder each, written by the executors."""
    parts = _parts(t, frameworks)
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
    return list(parts)


def write_shared(t: views.Base, rules: Sequence[tuple[str, str]], folder: str) -> DataFrame:
    """A copy of the base for sharing as CSV folders: texts masked or withheld, tables of people gone; gives the counters."""
    evidence, tables, pads, counters = redaction.redact(t["evidencia"], t["tabla_diapositiva"], t["pad"], rules)
    to_csv(dict(t) | {"evidencia": evidence, "tabla_diapositiva": tables, "pad": pads}, folder)
    return counters


def page(data: dict, template: str, script: str = "", logo: bytes | None = None) -> str:
    """A self-contained page: data and script in the template's places, closing tags in data made harmless."""
    text = json.dumps(data, ensure_ascii=False).replace("</", "<\\/")
    image = "data:image/png;base64," + base64.b64encode(logo).decode() if logo else ""
    return template.replace("{{DATA}}", text).replace("{{SCRIPT}}", script).replace("{{LOGO}}", image)


def publish(html: str) -> str:
    """html if it is a redacted page; raises otherwise."""
    if SHARED not in html:
        raise ValueError("only a redacted page may be published")
    return html


def write_seed(spark: SparkSession, df: DataFrame, path: str, order: list[str]) -> None:
    """Proposals back to one seed file, in a stable order."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True)
