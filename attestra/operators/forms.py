"""Reading course-plan forms from positioned words: labels, values, lists, blocks and tables as relations between segments.

A segment is a row (doc, p, x0, y0, x1, y1, t) as layout.segments gives it. Every operator works on all documents at once;
windows and groups are within a document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx

from .layout import TABLE_X, gap_islands, islands, nearest_anchor, value_to_the_right

#: Labels of the form's head and the fields they give (null: never read).
HEAD = {
    "nombre del cad": "nombre", "codigo del cad": "codigo", "ubicacion semestral": "semestre", "prerrequisitos si aplica": "prerrequisitos", "numero de creditos": "creditos",
    "nombre profesor lider": None, "facultad unidad misional": "facultad", "programa academico": "programa", "nombre del gestor del conocimiento lider": None, "relacion de creditos": "relacion_creditos",
}
#: Labels in the left column and their fields.
LEFT = {
    "dimensiones": "dimensiones", "rea especifico": "rea", "descripcion": "descripcion", "competencia generica saber pro": "competencia", "trabajo estudiante": "trabajo_estudiante",
    "trabajo gestor del conocimiento profesor": "trabajo_profesor", "trabajo profesor": "trabajo_profesor", "lugares": "lugares", "instrumentos de recoleccion de datos": "instrumentos",
    "instrumentos de recoleccion": "instrumentos", "recursos cgca": "recursos_cgca", "recursos externos y o propios": "recursos_externos", "unidad regional": "unidad_regional",
    "lineas translocales": "lineas_translocales", "postulados persona transhumana": "postulados", "mejoras": "mejoras", "transformaciones": "transformaciones", "semana inicio": "semana_inicio",
    "descripcion de la fase": "fase", "lugar": "lugares", "fase": "fase", "trabajo del creador de oportunidades estudiante": "trabajo_estudiante", "descripcion de la fase 7 y 8": "analisis_retroalimentacion",
}
#: Labels in the middle and right columns and their fields.
MIDDLE = {"descripcion de la actividad": "descripcion"}
RIGHT = {
    "integrantes": "integrantes", "componentes genericos asociados": "componentes", "semana inicio": "semana_inicio", "duracion": "duracion", "tipo actividad": "tipo_actividad",
    "descripcion de los instrumentos": "descripcion_instrumentos", "descripcion instrumentos": "descripcion_instrumentos", "descripcion": "descripcion_transformaciones",
}
#: Labels that the form glues to other text, the longest first.
GLUED = ("Descripción de la actividad", "Descripción de la")
#: Accented letters that one template loses in its labels; what marks that template; codes in file names; files in English.
LOST = {"codigo": "código", "ubicacion": "ubicación", "numero": "número", "creditos": "créditos", "lider": "líder", "academico": "académico"}
V2, CODE, ENGLISH = r"DIGITAL V2\b", r"(CAD\d{9,}(?:[A-Z]{0,2}-?[A-Z])?(?:-[A-Z])?)", r"(?iu)\bAGRICULTURAL\b|\bMICROBIOLOGY\b"
#: A list's bullet at the start of a line, a line that is a bullet only, bullets within a line.
BULLET, ONLY_BULLET, INNER_BULLET = r"^(•|¿(?=\s))\s*", r"^[•¿]$", r"\s+•\s+"
#: Header words of the reading list and their fields.
READING = {"autor": "autor", "nombre": "titulo", "titulo": "titulo", "ttulo": "titulo", "ano": "anio", "ao": "anio", "isbn": "isbn", "estandarizado": "identificador", "editorial": "editorial", "url": "url"}

#: What opens an experience in the second template, labels around its title, what ends the last one, how far its head reaches above and below.
EXPERIENCE, AROUND, AFTER_EXPERIENCES = r"^Experiencia\s*:", r"^(Semestre|Periodo|Dimensiones|Descripci|DESCRIPCI|Rea)", ("autor", "bibliografa o webgrafa", "bibliografia o webgrafia")
ABOVE, BELOW, LEFT_HALF, TITLE_END, TITLE_GAP = 32, 40, 300, 320, 6
#: Texts beside the dimensions and beside the description that are neither.
NO_DIMENSION, NO_DESCRIPTION = r"^(Descripci|Semestre|Periodo|Rea\b)", r"^(Dimensiones|Semestre|Periodo|DESCRIPCI)"

SEGMENT = ("x0", "y0", "x1", "y1", "t")


def ascii_key(c: Column) -> Column:
    """A label without its accented letters, as one template writes them: 'Número' becomes 'nmero'."""
    return tx.squeeze(F.regexp_replace(F.lower(F.regexp_replace(c, r"[^\x00-\x7f]", "")), "[^a-z0-9 ]", ""))


def _without_accented(key: str) -> str:
    for plain, accented in LOST.items():
        key = key.replace(plain, accented)
    return "".join(ch for ch in key if ord(ch) < 128)


def label_of(c: Column, table: dict[str, str | None]) -> Column:
    """The field that a text is the label of, by its normal form or else by its ASCII letters; '-' for labels never read."""
    both = {_without_accented(k): v for k, v in table.items()} | table
    known = F.create_map(*[F.lit(x) for k, v in both.items() for x in (k, v or "-")])
    return F.coalesce(known[tx.label_key(c)], known[ascii_key(c)])


def head_fields(segs: DataFrame) -> DataFrame:
    """doc, fields (map): labels on the first page and the value to the right of each, unless that is a label too."""
    first = segs.where("p = 1").withColumn("label", label_of(F.col("t"), HEAD))
    pairs = value_to_the_right(first, first.where("label IS NOT NULL").drop("label"), ["doc", "p"])
    named = pairs.withColumn("field", label_of(F.col("label"), HEAD)).where("field <> '-'")
    last = named.groupBy("doc", "field").agg(F.max_by("value", "y0").alias("value"))
    return last.groupBy("doc").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", F.trim(F.regexp_replace("value", r"[ \t]+", " ")).alias("value"))))).alias("fields"))


def template(segs: DataFrame, files: DataFrame) -> DataFrame:
    """doc, plantilla, codigo_archivo, idioma from the top of the first page and the file's name (files: doc, archivo)."""
    top = segs.where("p = 1 AND y0 < 60").groupBy("doc").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "x0", "t"))), lambda s: s["t"]), " ").alias("top"))
    kind = F.when(F.regexp_like("top", F.lit(V2)), "V2").otherwise("V1.9")
    code = F.nullif(F.regexp_extract("archivo", CODE, 1), F.lit(""))
    return files.join(top, "doc", "left").select("doc", F.coalesce(kind, F.lit("V1.9")).alias("plantilla"), code.alias("codigo_archivo"), F.when(F.regexp_like("archivo", F.lit(ENGLISH)), "en").otherwise("es").alias("idioma"))


def split_glued(words: DataFrame, key: Sequence[str] = ("doc", "p", "line", "segment"), phrases: Sequence[str] = GLUED) -> DataFrame:
    """Words (key, x0, y0, x1, y1, t) of segments with `part`: a label that is glued to other text is a part of its own.

    Of several phrases the first that occurs and is not the whole segment counts, at its first place.
    """
    order = F.sort_array(F.collect_list(F.struct("x0", "y0", "x1", "y1", "t")))
    seg = words.groupBy(*key).agg(order.alias("w")).withColumn("ts", F.transform("w", lambda w: w["t"]))
    found = F.lit(None).cast("struct<at:int,n:int>")
    for phrase in reversed(phrases):
        parts = phrase.split(" ")
        fits = _fits(parts)
        at = F.array_position(fits, True).cast("int") - 1
        found = F.when((at >= 0) & (F.size("ts") > len(parts)), F.struct(at.alias("at"), F.lit(len(parts)).alias("n"))).otherwise(found)
    cut = seg.withColumn("cut", found).select(*key, "cut", F.posexplode("w").alias("k", "w"))
    part = F.when(F.col("cut").isNull() | (F.col("k") < F.col("cut.at")), 0).when(F.col("k") < F.col("cut.at") + F.col("cut.n"), 1).otherwise(2)
    return cut.select(*key, part.alias("part"), "w.*")


def _fits(parts: list[str]) -> Column:
    wanted = F.array(*map(F.lit, parts))
    return F.transform("ts", lambda _, k: F.slice(F.col("ts"), k + 1, F.lit(len(parts))) == wanted)


def bullet_items(lines: DataFrame, key: Sequence[str], order: Sequence[str], bullets: DataFrame | None = None, near: float = 3.0) -> DataFrame:
    """key, item (number), t: a bullet at a line's start or beside it opens an item, other lines go on with the one before.

    lines has t and, for bullets that are segments of their own (doc, p, y0, y1), also doc, p, y0, y1. A line may hold more
    than one item.
    """
    rows = lines.withColumn("t", tx.strip_unicode(F.col("t"))).where(~F.regexp_like("t", F.lit(ONLY_BULLET)))
    beside = F.lit(False)
    if bullets is not None:
        centre = bullets.groupBy("doc", "p").agg(F.collect_list((F.col("y0") + F.col("y1")) / 2).alias("__c"))
        rows = rows.join(centre, ["doc", "p"], "left")
        beside = F.exists(F.coalesce("__c", F.array().cast("array<double>")), lambda c: F.abs(c - (F.col("y0") + F.col("y1")) / 2) < near)
    parts = F.filter(F.split(F.regexp_replace("t", BULLET, ""), INNER_BULLET), lambda x: x != "")
    each = rows.withColumn("__new", F.regexp_like("t", F.lit(BULLET)) | beside).select(*key, *order, "__new", F.posexplode(parts).alias("__k", "part"))
    opens = F.col("__new") | (F.col("__k") > 0)
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order, "__k")) == 1
    numbered = islands(each.withColumn("__opens", opens | first), key, [*order, "__k"], F.col("__opens"), "item")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], "__k", "part"))), lambda x: x["part"]), " ")
    return numbered.groupBy(*key, "item").agg(F.trim(F.regexp_replace(text, r"[ \t]+", " ")).alias("t"))


def block_between(cells: DataFrame, key: Sequence[str], order: Sequence[str], title: str, until: Sequence[str]) -> DataFrame:
    """Cells after the first whose normal form begins with the title, up to the next that begins with one of `until`."""
    w = Window.partitionBy(*key).orderBy(*order)
    plain = tx.label_key(F.col("t"))
    stop = F.lit(False)
    for u in until:
        stop = stop | plain.startswith(u)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    begun = cells.withColumn("__begun", F.coalesce(F.max(plain.startswith(title)).over(before), F.lit(False))).withColumn("__stop", F.col("__begun") & stop)
    return begun.withColumn("__over", F.max("__stop").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("__begun AND NOT __over").drop("__begun", "__stop", "__over")


def columns_by_header(items: DataFrame, headers: DataFrame, key: Sequence[str], gap: float = TABLE_X) -> DataFrame:
    """Items (key, x0, x1, ...) with `field`: columns are clusters of where items begin.

    headers: key, x0, x1, field. As many columns as headers are taken in order; else each column goes to the header whose
    centre is nearest to the mean centre of its items, of equally near ones to the left one.
    """
    cluster = gap_islands(items.select(*key, "x0").distinct(), key, "x0", gap, "column")
    placed = items.join(cluster, [*key, "x0"])
    heads = headers.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("x0", "x1", "field"))).alias("heads"))
    means = placed.groupBy(*key, "column").agg(F.avg((F.col("x0") + F.col("x1")) / 2).alias("centre")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    nearest = F.array_min(F.transform("heads", lambda h, k: F.struct(F.abs((h["x0"] + h["x1"]) / 2 - F.col("centre")).alias("d"), k.alias("k"), h["field"].alias("field"))))["field"]
    named = means.join(heads, list(key)).withColumn("field", F.when(F.col("n") == F.size("heads"), F.get("heads", (F.col("column") - 1).cast("int"))["field"]).otherwise(nearest))
    return placed.join(named.select(*key, "column", "field"), [*key, "column"]).drop("column")


def rows_by_anchor(items: DataFrame, key: Sequence[str], anchor: str) -> DataFrame:
    """key, row, fields (map): each item of the anchor's field opens a row, all others go to the row nearest in height."""
    marked = items.withColumn("yc", (F.col("y0") + F.col("y1")) / 2).withColumn("__id", F.row_number().over(Window.partitionBy(*key).orderBy("y0", "x0", "t")))
    anchors = marked.where(F.col("field") == anchor).select(*key, "yc", F.col("__id").alias("row"))
    dealt = nearest_anchor(marked, anchors, key, "yc", "__id", "row").where("row IS NOT NULL")
    joined = marked.join(dealt, [*key, "__id"])
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "x0", "t"))), lambda s: s["t"]), " ")
    fields = joined.groupBy(*key, "row", "field").agg(F.trim(F.regexp_replace(text, r"[ \t]+", " ")).alias("t"))
    return fields.groupBy(*key, "row").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "t")))).alias("fields"))


def tables_under(segs: DataFrame, first: str, fields: Column, stop: Sequence[str], anchor: str, reach: float) -> DataFrame:
    """doc, p, row, fields of tables: a header row is what lies within `reach` of a segment whose normal form is `first`.

    fields names a header segment (null: none); the body runs from below the headers to the first line whose normal form
    begins with one of `stop`, or to the page's end. Several tables on a page are told apart by their first headers.
    """
    key = ["doc", "p", "top"]
    s = segs.withColumn("plain", tx.label_key(F.col("t"))).withColumn("yc", (F.col("y0") + F.col("y1")) / 2)
    tops = s.where(F.col("plain") == first).select("doc", "p", F.col("yc").alias("top"))
    near = s.join(tops, ["doc", "p"])
    heads = near.where(F.abs(F.col("yc") - F.col("top")) <= reach).withColumn("field", fields).where("field IS NOT NULL")
    low = heads.groupBy(*key).agg(F.max("y1").alias("low"), F.collect_set("field").alias("known"))
    halt = F.lit(False)
    for word in stop:
        halt = halt | F.col("plain").startswith(word)
    body = near.join(low, key).where(F.col("y0") > F.col("low") + 1)
    end = body.groupBy(*key).agg(F.min(F.when(halt, F.col("y0"))).alias("end"))
    body = body.join(end, key).where(F.col("end").isNull() | (F.col("y0") < F.col("end")))
    return rows_by_anchor(columns_by_header(body.select(*key, *SEGMENT), heads.select(*key, "x0", "x1", "field"), key), key, anchor)


def reading_list(segs: DataFrame) -> DataFrame:
    """doc, p, autor, titulo, anio, isbn, identificador, editorial, url of the reading lists; rows without a title go."""
    last = F.element_at(F.split("plain", " "), -1)
    known = F.create_map(*[F.lit(x) for kv in READING.items() for x in kv])
    rows = tables_under(segs, "autor", F.coalesce(known[last], known[F.col("plain")]), ("recursos", "bibliografia", "nombre del recurso"), "anio", 12)
    get = lambda f: F.col("fields")[f]
    year = F.regexp_extract(F.regexp_replace(F.coalesce(get("anio"), F.lit("")), "[.,]", ""), r"\d+", 0).try_cast("int")
    code = F.when(get("isbn") != "-", get("isbn"))
    return rows.where(get("titulo").isNotNull() & (get("titulo") != "")).select("doc", "p", get("autor").alias("autor"), get("titulo").alias("titulo"), F.nullif(year, F.lit(0)).alias("anio"), code.alias("isbn"), get("identificador").alias("identificador"), get("editorial").alias("editorial"), F.replace(get("url"), F.lit(" "), F.lit("")).alias("url"))


def resources(segs: DataFrame) -> DataFrame:
    """doc, p, nombre, tipo, area of the tables of outside resources: the three headers of one line, from left to right."""
    s = segs.withColumn("plain", tx.label_key(F.col("t"))).withColumn("yc", (F.col("y0") + F.col("y1")) / 2)
    tops = s.where("plain = 'nombre del recurso'").select("doc", "p", F.col("yc").alias("top"))
    line = s.join(tops, ["doc", "p"]).where(F.abs(F.col("yc") - F.col("top")) < 6)
    k = F.row_number().over(Window.partitionBy("doc", "p", "top").orderBy("x0"))
    named = line.withColumn("__k", k).where("__k <= 3").select("doc", "p", "x0", "y0", F.get(F.array(*map(F.lit, ("nombre", "tipo", "area"))), F.col("__k") - 1).alias("__field"))
    marked = segs.join(named, ["doc", "p", "x0", "y0"], "left")
    rows = tables_under(marked, "nombre del recurso", F.col("__field"), ("bibliografia", "autor", "recursos cgca"), "nombre", 6)
    get = lambda f: F.col("fields")[f].alias(f)
    return rows.where(F.col("fields")["nombre"] != "").select("doc", "p", get("nombre"), get("tipo"), get("area"))


def specific_results(segs: DataFrame) -> DataFrame:
    """doc, consecutivo, texto, peso: numbers of a block, the text nearest to each in height, its weight if within 8 points.

    segs are the segments of the block (block_between). A block with text and no number is result 1.
    """
    skip = ("consecutivo", "nombre", "consecutivo nombre", "porcentaje", "total")
    s = segs.withColumn("t", F.trim("t")).where(~tx.label_key(F.col("t")).isin(*skip)).withColumn("yc", (F.col("y0") + F.col("y1")) / 2 + F.col("p") * 100_000)
    s = s.withColumn("__id", F.row_number().over(Window.partitionBy("doc").orderBy("p", "y0", "x0", "t")))
    is_number, is_weight = F.regexp_like("t", F.lit(r"^\d{1,2}$")), F.regexp_like("t", F.lit(r"^\d+([.,]\d+)?\s*%$"))
    numbers = s.where(is_number).select("doc", "yc", F.col("__id").alias("at"), F.col("t").cast("int").alias("consecutivo"))
    dealt = nearest_anchor(s.where(~is_number), numbers, ["doc"], "yc", "__id", "at").join(numbers.drop("yc"), ["doc", "at"], "left")
    both = s.join(dealt, ["doc", "__id"]).withColumn("consecutivo", F.coalesce("consecutivo", F.lit(1)))
    words = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~is_weight, F.struct("__id", "t")))), lambda x: x["t"]), " ")
    weight = F.max(F.when(is_weight & (F.col("distance") < 8), F.regexp_replace(F.regexp_replace("t", r"\s*%", ""), ",", ".").cast("double")))
    out = both.groupBy("doc", "consecutivo").agg(F.trim(F.regexp_replace(words, r"[ \t]+", " ")).alias("texto"), weight.alias("peso"))
    return out.where("texto <> ''")


def _neat(c: Column) -> Column:
    """A field's text: one sign for bullets, no zero-width signs, single spaces."""
    return tx.strip_unicode(F.regexp_replace(F.replace(F.replace(c, F.lit("¿ "), F.lit("• ")), F.lit("\u200b"), F.lit("")), r"[ \t]+", " "))


def _joined(rows: Column, order: Sequence[str]) -> Column:
    """Texts t of an array of structs in an order, with spaces between them."""
    keyed = F.transform(rows, lambda s: F.struct(*[s[c].alias(c) for c in order], s["t"].alias("t")))
    return F.array_join(F.transform(F.sort_array(keyed), lambda s: s["t"]), " ")


def experiences(segs: DataFrame) -> DataFrame:
    """doc, orden, tipo, nombre, dimensiones, rea, descripcion of the experiences in the second template, in reading order.

    A title opens an experience; what it says goes on in the lines below that follow closely. Its head begins some lines above
    it, so the stretch of the one before ends there, and the last ends where the reading list begins. The outcome is a number
    at the left edge before the activities, and the description what stands to the right of it. Ties in height go by x.
    """
    s = segs.select("doc", "p", *SEGMENT).withColumns({"pos": F.col("p") * 100_000 + F.col("y0"), "yc": (F.col("y0") + F.col("y1")) / 2, "plain": tx.label_key(F.col("t"))})
    s = s.withColumn("opens", F.regexp_like("t", F.lit(EXPERIENCE)) & (F.col("x0") < LEFT_HALF))
    s = islands(s, ["doc"], ["pos", F.desc("opens"), "x0", "t"], F.col("opens"), "orden")
    last = segs.where(tx.label_key(F.col("t")).isin(*AFTER_EXPERIENCES)).groupBy("doc").agg(F.min(F.col("p") * 100_000 + F.col("y0")).alias("limit"))
    titles = s.where("opens").select("doc", "orden", "p", *[F.col(c).alias(f"t_{c}") for c in ("y0", "y1", "yc")], "pos")
    titles = titles.withColumn("next", F.lead("pos").over(Window.partitionBy("doc").orderBy("orden")) - ABOVE).join(last, "doc", "left")
    titles = titles.withColumn("end", F.coalesce("next", "limit", F.lit(float("inf"))))

    # The head: all that lies around a title on its page.
    head = titles.join(s.drop("orden", "pos"), ["doc", "p"]).where((F.col("y0") >= F.col("t_y0") - ABOVE) & (F.col("y0") <= F.col("t_y1") + BELOW))
    row = F.struct("y0", "x0", "x1", "y1", "yc", "t")
    heads = head.groupBy("doc", "orden", "t_y1", "t_yc").agg(F.sort_array(F.collect_list(row)).alias("all"))
    left = F.filter("all", lambda x: (x["x0"] < LEFT_HALF) & ~F.regexp_like(x["t"], F.lit(AROUND)))
    line = _joined(F.filter(left, lambda x: F.abs(x["yc"] - F.col("t_yc")) < 3), ["x0"])
    begun = F.struct(F.col("t_y1").alias("y"), F.array(F.regexp_replace(line, r"^[^:]*:", "")).alias("said"), F.lit(False).alias("over"))

    def goes_on(done: Column, x: Column) -> Column:
        over = done["over"] | (x["y0"] - done["y"] > TITLE_GAP) | (x["x1"] > TITLE_END) | F.regexp_like(x["t"], F.lit(r"^\s*\d{1,2}\s*$"))
        return F.when(over, F.struct(done["y"].alias("y"), done["said"].alias("said"), F.lit(True).alias("over"))).otherwise(F.struct(F.greatest(done["y"], x["y1"]).alias("y"), F.concat(done["said"], F.array(x["t"])).alias("said"), F.lit(False).alias("over")))

    said = F.aggregate(F.filter(left, lambda x: x["y0"] > F.col("t_y1") - 1), begun, goes_on, lambda done: F.array_join(done["said"], " "))
    label = F.get(F.filter("all", lambda x: x["t"].startswith("Dimensiones")), F.lit(0))
    near = lambda x, d: (x["y0"] > d["y0"]) & (x["y0"] < d["y0"] + 45) & (x["x0"] >= d["x0"] - 30) & (x["x0"] <= d["x1"] + 40) & ~F.regexp_like(x["t"], F.lit(NO_DIMENSION))
    listed = tx.let(label, lambda d: F.concat_ws(" ", F.regexp_extract(d["t"], r"^[^:]*:(.*)$", 1), F.array_join(F.transform(F.filter("all", lambda x: near(x, d)), lambda x: x["t"]), " ")))
    parts = F.filter(F.transform(F.split(listed, r"\s*-\s*"), tx.strip_unicode), lambda x: x != "")
    named = heads.select("doc", "orden", F.regexp_replace(_neat(said), r"\s+Rea$", "").alias("nombre"), F.when(label.isNotNull(), parts).alias("dimensiones"))

    # The body up to the activities: the outcome's number and what stands beside it.
    body = s.join(titles.select("doc", "orden", "end"), ["doc", "orden"]).where("pos < end")
    acts = body.where("plain = 'actividades'").groupBy("doc", "orden").agg(F.min("pos").alias("acts"))
    before = body.join(acts, ["doc", "orden"], "left").where("acts IS NULL OR pos < acts").groupBy("doc", "orden").agg(F.sort_array(F.collect_list(F.struct("pos", "x0", "t", "plain"))).alias("before"))
    number = F.get(F.filter("before", lambda x: (x["x0"] < 60) & F.regexp_like(x["t"], F.lit(r"^\s*\d{1,2}\s*$"))), F.lit(0))
    beside = lambda x, n: (x["x0"] > 100) & (x["pos"] > n["pos"] - 25) & ~x["plain"].isin("rea", "descripcion") & ~F.regexp_like(x["t"], F.lit(NO_DESCRIPTION))
    told = tx.let(number, lambda n: F.when(n.isNotNull(), F.array_join(F.transform(F.filter("before", lambda x: beside(x, n)), lambda x: x["t"]), " ")))
    described = before.select("doc", "orden", F.trim(number["t"]).cast("int").alias("rea"), _neat(told).alias("descripcion"))
    out = named.join(described, ["doc", "orden"], "left")
    return out.select("doc", F.col("orden").cast("int").alias("orden"), F.lit("vive_experiencia").alias("tipo"), "nombre", "dimensiones", "rea", "descripcion")
