"""Documents with tagged structure: from indented text to a tree, blocks in reading order, sections with tables and pages.

Only the indentation is read line by line, one document at a time; what a block, a table or a section is follows from
relations between nodes: a node is seen unless one of its ancestors is closed, and a block's text is that of its descendants.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions import text as tx

from .analytics import small
from .layout import islands, numbered_codes

#: Kinds of nodes; what begins a caption; pages of contents that hold no section; longest key of a title.
HEADINGS, PARAGRAPHS, SILENT = ("H1", "H2", "H3", "H4"), ("P", "LI", "Lbl", "LBody"), ("TOC", "TOCI", "Figure", "Artifact")
HOLDERS = ("Table", "H1", "H2", "H3")
CAPTION, CONTENTS, KEY = "Tabla ", 12, 60
FRONT_CODE, FRONT_TITLE = "PORTADA", "Portada y créditos"
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9]*")
_TREE = "node int, kind string, path array<int>, kinds array<string>, text string, leaf boolean, holds boolean"


def parse(text: str) -> list[dict]:
    """Nodes in the order of the text; path and kinds run from the root down to the node itself.

    A quoted line is text of the last node that is less indented; a line that begins with a slash is an attribute of none.
    holds tells whether a child is a table or a heading of one of the first three levels, leaf whether there is no child.
    """
    nodes: list[dict] = []
    open_: list[tuple[int, dict]] = []
    for line in text.split("\n"):
        body = line.strip()
        depth = len(line) - len(line.lstrip(" "))
        quoted, name = body.startswith('"'), _NAME.match(body)
        if not quoted and not name:
            continue
        while open_ and open_[-1][0] >= depth:
            open_.pop()
        above = open_[-1][1] if open_ else None
        if quoted:
            if above:
                above["said"].append(body[1:-1] if len(body) > 1 and body.endswith('"') else body[1:])
            continue
        node = {"node": len(nodes), "kind": name.group(), "path": [*(above["path"] if above else []), len(nodes)], "kinds": [*(above["kinds"] if above else []), name.group()], "said": [], "leaf": True, "holds": False}
        if above:
            above["leaf"] = False
            above["holds"] |= node["kind"] in HOLDERS
        nodes.append(node)
        open_.append((depth, node))
    return nodes


def trees(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc and the nodes of every document's indented text; a null text has none."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [{doc: i, **n, "text": " ".join(n["said"])} for i, t in zip(part[doc], part[text], strict=True) for n in parse(t or "")]
            yield pd.DataFrame(rows, columns=[doc, *(c.split()[0] for c in _TREE.split(", "))])

    return docs.select(doc, text).mapInPandas(run, f"{doc} {docs.schema[doc].dataType.simpleString()}, {_TREE}")


def _joined(order: str, text: Column) -> Column:
    return tx.squeeze(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(text != "", F.struct(F.col(order).alias("o"), text.alias("t"))))), lambda x: x["t"]), " "))


def blocks(tree: DataFrame, doc: str) -> DataFrame:
    """doc, at (place), kind (H1 to H4, P, Caption or Table), text, rows (a table's cells) in reading order.

    Contents, pictures and artifacts say nothing; a paragraph that holds a table or a heading is opened up.
    """
    kind = F.col("kind")
    closed = kind.isin(*HEADINGS, "Table", "Caption", *SILENT) | (kind.isin(*PARAGRAPHS) & ~F.col("holds")) | (F.col("leaf") & (F.col("text") != ""))
    ends = tree.where(closed).groupBy(doc).agg(F.collect_set("node").alias("ends"))
    owned = tree.join(ends, doc).withColumn("at", F.get(F.filter("path", lambda n: F.array_contains("ends", n)), F.lit(0))).where("at IS NOT NULL").drop("ends")
    owned = owned.withColumn("owner", F.element_at("kinds", F.array_position("path", F.col("at")).cast("int"))).where(~F.col("owner").isin(*SILENT))
    texts = owned.where("owner <> 'Table'").groupBy(doc, "at").agg(F.first("owner").alias("owner"), _joined("node", F.col("text")).alias("text"))
    # A cell is the node right below the first row on the way down from the table.
    row_at = F.array_position("kinds", "TR").cast("int")
    cells = owned.where("owner = 'Table'").withColumn("row_at", row_at).where("row_at > 0")
    cells = cells.withColumn("tr", F.element_at("path", F.col("row_at"))).where(F.size("path") > F.col("row_at")).withColumn("cell", F.get("path", F.col("row_at"))).where(F.get("kinds", F.col("row_at")).isin("TD", "TH"))
    said = cells.groupBy(doc, "at", "tr", "cell").agg(_joined("node", F.col("text")).alias("t"))
    line = said.groupBy(doc, "at", "tr").agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "t"))), lambda x: x["t"]).alias("cells")).where(F.exists("cells", lambda x: x != ""))
    tables = line.groupBy(doc, "at").agg(F.transform(F.sort_array(F.collect_list(F.struct("tr", "cells"))), lambda x: x["cells"]).alias("rows"))
    whole = owned.where("kind = 'Table' AND node = at").select(doc, "at").join(tables, [doc, "at"], "left").select(doc, "at", F.lit("Table").alias("kind"), F.lit("").alias("text"), F.coalesce("rows", F.array().cast("array<array<string>>")).alias("rows"))
    named = F.when(F.col("owner").isin(*HEADINGS, "Caption"), F.col("owner")).otherwise("P")
    plain = texts.select(doc, "at", named.alias("kind"), "text", F.lit(None).cast("array<array<string>>").alias("rows")).where("kind <> 'P' OR text <> ''")
    return plain.unionByName(whole)


def section_pages(keys: Column, pages: Column, skip: int = CONTENTS) -> Column:
    """For each key the first page (from 1) that holds it, not before the page of the last one found; null where none does.

    keys and pages are arrays of normal forms; the first pages (contents) are skipped.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state: Column, key: Column) -> Column:
        fits = F.transform(pages, lambda p, k: (k >= F.greatest(state["at"], F.lit(skip))) & (key != "") & p.contains(key))
        page = F.nullif(F.array_position(fits, True), F.lit(0)).cast("int")
        return F.struct(F.coalesce(page - 1, state["at"]).alias("at"), F.concat(state["out"], F.array(page)).alias("out"))

    return F.aggregate(keys, start, step, lambda s: s["out"])


def _content(rows: Column) -> Column:
    """struct<parrafos, tablas> of a section's blocks in order: a paragraph that begins as a caption goes to the table after it."""
    cells = "array<array<string>>"
    start = F.struct(F.array().cast("array<string>").alias("parrafos"), F.array().cast(f"array<struct<leyenda:string,filas:{cells}>>").alias("tablas"))

    def step(s: Column, b: Column) -> Column:
        last = F.get(s["parrafos"], F.size(s["parrafos"]) - 1)
        takes = F.coalesce(last.startswith(CAPTION), F.lit(False))
        left = F.when(takes, F.slice(s["parrafos"], F.lit(1), F.greatest(F.size(s["parrafos"]) - 1, F.lit(0)))).otherwise(s["parrafos"])
        table = F.struct(F.when(takes, last).alias("leyenda"), b["rows"].alias("filas"))
        is_table = b["kind"] == "Table"
        return F.struct(F.when(is_table, left).otherwise(F.concat(s["parrafos"], F.array(b["text"]))).alias("parrafos"), F.when(is_table, F.concat(s["tablas"], F.array(table))).otherwise(s["tablas"]).alias("tablas"))

    return F.aggregate(rows, start, step)


def sections(found: DataFrame, doc: str, prefix: Column, pages: DataFrame | None = None) -> DataFrame:
    """doc, seccion (number), codigo, numero, titulo, nivel, pagina, parrafos, tablas of the blocks of every document.

    Headings of dots and spaces begin nothing and are paragraphs. Codes follow the title's number, else its first four words; repeats get -2, -3
    and so on. What comes before the first heading is the front. pages: doc, paginas (array of texts); without it pagina is null.
    """
    heading = F.col("kind").isin(*HEADINGS) & (F.regexp_replace("text", "[ .]", "") != "")
    numbered = islands(found.withColumn("__h", heading).withColumn("prefix", prefix), [doc], ["at"], F.col("__h"), "seccion")
    number = F.regexp_extract("text", r"^(\d+(?:\.\d+)*)\.?\s+(.*)", 1)
    rest = F.when(number != "", F.regexp_extract("text", r"^(\d+(?:\.\d+)*)\.?\s+(.*)", 2)).otherwise(F.col("text"))
    slug = F.array_join(F.slice(F.split(F.upper(tx.label_key(F.col("text"))), " "), 1, 4), "-")
    heads = numbered.where("__h").select(doc, "seccion", F.nullif(number, F.lit("")).alias("numero"), F.col("text").alias("titulo"), F.substring("kind", 2, 1).cast("int").alias("nivel"), F.concat("prefix", F.lit("-"), F.when(number != "", number).otherwise(slug)).alias("base"), F.substring(tx.label_key(rest), 1, KEY).alias("clave"))
    front = numbered.where("seccion = 0").groupBy(doc).agg(F.concat(F.first("prefix"), F.lit(f"-{FRONT_CODE}")).alias("base")).select(doc, F.lit(0).cast("long").alias("seccion"), F.lit(None).cast("string").alias("numero"), F.lit(FRONT_TITLE).alias("titulo"), F.lit(1).alias("nivel"), "base", F.lit(None).cast("string").alias("clave"))
    every = heads.unionByName(front)
    coded = every.withColumn("codigo", numbered_codes(every, [doc, "base"], ["seccion"], F.col("base")))
    body = numbered.where("NOT __h").groupBy(doc, "seccion").agg(_content(F.sort_array(F.collect_list(F.struct("at", "kind", "text", "rows")))).alias("c"))
    out = coded.join(body, [doc, "seccion"], "left")
    if pages is None:
        out = out.withColumn("pagina", F.when(F.col("seccion") == 0, 1))
    else:
        order = heads.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("seccion", "clave"))).alias("h"))
        plain = pages.select(doc, F.transform("paginas", tx.label_key).alias("paginas"))
        at = order.join(plain, doc).select(doc, F.explode(F.arrays_zip(F.transform("h", lambda x: x["seccion"]).alias("seccion"), section_pages(F.transform("h", lambda x: x["clave"]), F.col("paginas")).alias("pagina"))).alias("x")).select(doc, "x.*")
        out = out.join(at, [doc, "seccion"], "left").withColumn("pagina", F.when(F.col("seccion") == 0, 1).otherwise(F.col("pagina")))
    none = lambda c, kind: F.coalesce(F.col(f"c.{c}"), F.array().cast(kind)).alias(c)
    return out.select(doc, "seccion", "codigo", "numero", "titulo", "nivel", "pagina", none("parrafos", "array<string>"), none("tablas", "array<struct<leyenda:string,filas:array<array<string>>>>"))


def masters(files: DataFrame, seeds: DataFrame) -> DataFrame:
    """prefijo, proceso, nivel, titulo, archivo: for each seed (patron, ...) the first file by name that holds its pattern.

    seeds is a short list; its size is checked before it is sent to all files.
    """
    named = files.select(F.col("archivo"))
    hits = named.join(small(seeds), F.lower("archivo").contains(F.lower("patron")))
    first = hits.groupBy("prefijo").agg(F.min("archivo").alias("archivo"))
    return seeds.join(first, "prefijo").select("prefijo", "proceso", "nivel", "titulo", "archivo")
