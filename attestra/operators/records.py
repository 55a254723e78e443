"""Experiences and activities of a course plan in the first template: titles open records, labels beside cells name their fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx

from .forms import LEFT, RIGHT, _neat, bullet_items, label_of
from .layout import cells, islands

#: What opens a record, titles of sections, fields that are lists, fields of the actions, fields whose last value counts.
TITLE = r"(?iu)^(Experiencia|Actividad|Nombre de la actividad|Etapa \d+|Problema)\s*:"
SECTIONS = ("vive una experiencia", "soluciona un problema", "acciones", "bibliografia")
LISTS = ("dimensiones", "lugares", "instrumentos", "recursos_cgca", "recursos_externos", "competencia", "postulados", "mejoras", "componentes", "tipo_actividad")
ACTIONS, LAST = ("postulados", "mejoras", "transformaciones", "descripcion_transformaciones"), ("semana_inicio", "duracion", "descripcion_instrumentos", "integrantes")
#: Fixed values, in points: end of the label column, where values and the labels and values of the right side begin, a field's width.
LABEL_END, VALUES, RIGHT_LABELS, RIGHT_VALUES, FIELD = 132, 87.5, 187.5, 287.5, 150

_BOX = ("doc", "p", "x0", "y0", "x1", "y1", "t")


def _bullet(t: Column | str) -> Column:
    return F.trim(t).isin("•", "¿")


def left_labels(segs: DataFrame) -> DataFrame:
    """doc, lefts (array of p, y0, x0, y1, x1, field): labels of the left column, which may go over several lines.

    In lines that follow each other closely the longest label from each line on counts, and the next begins after it.
    """
    own = segs.where((F.col("x1") < LABEL_END) & ~_bullet("t")).withColumn("pos", F.col("p") * 100_000 + F.col("y0"))
    w = Window.partitionBy("doc", "p").orderBy("y0", "x0", "t")
    far = F.coalesce(F.col("y0") - F.lag("y1").over(w) > 1.3 * (F.col("y1") - F.col("y0")), F.lit(True))
    group = islands(own.withColumn("__far", far), ["doc", "p"], ["y0", "x0", "t"], F.col("__far"), "g").groupBy("doc", "p", "g").agg(F.sort_array(F.collect_list(F.struct("y0", "x0", "t", "y1", "x1"))).alias("l"))
    stretch = lambda i, j: F.array_join(F.transform(F.slice("l", i + 1, j - i), lambda x: x["t"]), " ")
    spans = F.flatten(F.transform("l", lambda _, i: F.transform(F.sequence(i + 1, F.size("l")), lambda j: F.struct(i.alias("i"), j.alias("j"), label_of(stretch(i, j), LEFT).alias("field")))))
    group = group.withColumn("spans", F.filter(spans, lambda s: s["field"].isNotNull() & (s["field"] != "-")))
    group = group.withColumn("longest", F.filter("spans", lambda s: ~F.exists("spans", lambda o: (o["i"] == s["i"]) & (o["j"] > s["j"]))))
    none = F.filter("longest", lambda s: F.lit(False))
    chosen = F.aggregate("longest", none, lambda acc, s: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["j"] > s["i"]), acc).otherwise(F.concat(acc, F.array(s))))
    found = group.select("doc", "p", "l", F.explode(chosen).alias("s"))
    first, end = F.get("l", F.col("s.i")), F.get("l", F.col("s.j") - 1)
    each = found.select("doc", "p", first["y0"].alias("y0"), first["x0"].alias("x0"), end["y1"].alias("y1"), F.greatest(first["x1"], end["x1"]).alias("x1"), F.col("s.field").alias("field"))
    return each.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("p", "y0", "x0", "y1", "x1", "field"))).alias("lefts"))


def events(segs: DataFrame) -> DataFrame:
    """doc, e (number in reading order), kind (title, left, right), field or title `t`, vals: the value cells of a label.

    A value belongs to the left label whose middle is beside it, else (after a page break) to the last before it; to a right
    label if it stands to its right at its height. What follows the bibliography is no value.
    """
    rows = cells(segs.select(*_BOX)).groupBy("doc", "p", "cell").agg(F.sort_array(F.collect_list(F.struct("y0", "x0", "x1", "y1", "t"))).alias("l"))
    rows = rows.select("doc", "p", F.col("l")[0]["y0"].alias("y0"), F.col("l")[0]["x0"].alias("x0"), F.element_at("l", -1)["y1"].alias("y1"), F.array_max(F.transform("l", lambda x: x["x1"])).alias("x1"), F.array_join(F.transform("l", lambda x: x["t"]), " ").alias("t"), "l")
    plain = tx.label_key(F.col("t"))
    right = F.when(F.col("x0") > RIGHT_LABELS, label_of(F.col("t"), RIGHT))
    kind = F.when(F.regexp_like("t", F.lit(TITLE)) | plain.isin(*SECTIONS), "title").when(right.isNotNull(), "right").when((F.col("x1") >= LABEL_END) & (F.col("x0") > VALUES) & ~_bullet("t"), "value")
    rows = rows.withColumns({"kind": kind, "t": F.when(kind == "right", right).otherwise(F.col("t")), "pos": F.col("p") * 100_000 + F.col("y0"), "yc": (F.col("y0") + F.col("y1")) / 2})
    limit = F.min(F.when((F.col("kind") == "title") & (plain == "bibliografia"), F.col("pos"))).over(Window.partitionBy("doc"))
    rows = rows.withColumn("limit", limit).where("kind <> 'value' OR limit IS NULL OR pos < limit")
    cell = F.struct("p", "y0", "x0", "y1", "x1", "yc", "pos", "t", "l")
    doc = rows.groupBy("doc").agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, cell))).alias(n) for k, n in (("title", "titles"), ("right", "rights"), ("value", "values"))])
    doc = doc.join(left_labels(segs), "doc", "left").withColumn("lefts", F.transform(F.coalesce("lefts", F.array().cast("array<struct<p:int,y0:double,x0:double,y1:double,x1:double,field:string>>")), lambda c, i: F.struct(i.alias("i"), c["p"].alias("p"), c["y0"].alias("y0"), c["x0"].alias("x0"), ((c["y0"] + c["y1"]) / 2).alias("yc"), (c["p"] * 100_000 + c["y0"]).alias("pos"), c["field"].alias("t"))))
    taken = lambda v: (v["x0"] > RIGHT_VALUES) & F.exists("rights", lambda d: (d["p"] == v["p"]) & (F.abs(v["yc"] - d["yc"]) < 30) & (v["x0"] > d["x1"]))
    beside = lambda v: F.array_min(F.filter(F.transform("lefts", lambda c: F.when((c["p"] == v["p"]) & (c["yc"] >= v["y0"] - 3) & (c["yc"] <= v["y1"] + 3), F.struct(F.abs(c["yc"] - v["yc"]).alias("d"), c["i"].alias("i")))), lambda x: x.isNotNull()))["i"]
    before = lambda v: F.array_max(F.transform("lefts", lambda c: F.when(c["pos"] < v["pos"], c["i"])))
    doc = doc.withColumn("owned", F.transform(F.filter("values", lambda v: ~taken(v)), lambda v: F.struct(F.coalesce(beside(v), before(v)).alias("i"), v.alias("v"))))
    at_height = lambda d: F.filter("values", lambda v: (v["p"] == d["p"]) & (v["x0"] > d["x1"] + 3) & (d["yc"] >= v["y0"] - 6) & (d["yc"] <= v["y1"] + 6))
    of_right = lambda d: tx.let(at_height(d), lambda near: F.filter(near, lambda v: v["x0"] < F.array_min(F.transform(near, lambda n: n["x0"])) + FIELD))
    of_left = lambda c: F.transform(F.filter("owned", lambda o: o["i"] == c["i"]), lambda o: o["v"])
    nothing = lambda c: F.filter("values", lambda v: F.lit(False))
    made = lambda kind, of: lambda c: F.struct(c["p"].alias("p"), c["y0"].alias("y0"), c["x0"].alias("x0"), F.lit(kind).alias("kind"), c["t"].alias("t"), of(c).alias("vals"))
    doc = doc.withColumn("events", F.concat(F.transform("titles", made("title", nothing)), F.transform("lefts", made("left", of_left)), F.transform("rights", made("right", of_right))))
    return doc.select("doc", F.posexplode(F.sort_array("events")).alias("e", "x")).select("doc", "e", "x.kind", "x.t", "x.vals")


def records(segs: DataFrame) -> DataFrame:
    """doc, orden, actividad, tipo, nombre, etapa, fields (map of field to its texts): experiences (actividad 0), their activities,
    and the plan's actions (orden 0).

    A field is a list of items, or one paragraph; fields that come again in a record are joined, lists without repeats, and of
    weeks and durations the last counts. Labels before the first record, and values without a label, are left out.
    """
    w = Window.partitionBy("doc").orderBy("e")
    plain, low = tx.label_key(F.col("t")), F.lower("t")
    opens = F.when(F.col("kind") == "title", F.when(plain.isin(*SECTIONS), plain).when(low.startswith("experiencia") | low.startswith("problema"), "experience").when(low.startswith("etapa"), "stage").otherwise("activity"))
    said = _neat(F.regexp_replace("t", r"^[^:]*:", ""))
    e = events(segs).withColumn("opens", opens)
    so_far = lambda c: F.last(c, ignorenulls=True).over(w)
    e = e.withColumn("section", so_far(F.when(F.col("opens").isin(*SECTIONS), F.col("opens"))))
    e = e.withColumn("changed", F.col("opens").isin(*SECTIONS[1:]) & ~F.col("section").eqNullSafe(F.lag("section").over(w)))
    # What holds at an event: an experience until the actions begin, an activity until another record, a stage or a section begins.
    e = e.withColumn("orden", F.sum(F.when(F.col("opens") == "experience", 1).otherwise(0)).over(w))
    e = e.withColumn("open", so_far(F.when(F.col("opens") == "experience", True).when(F.col("changed") & (F.col("opens") != SECTIONS[1]), False)))
    inside = Window.partitionBy("doc", "orden").orderBy("e")
    acts = (F.col("opens") == "activity") & F.coalesce("open", F.lit(False))
    e = e.withColumn("n", F.sum(F.when(acts, 1).otherwise(0)).over(inside))
    e = e.withColumn("within", F.last(F.when(acts, True).when(F.col("opens").isin("experience", "stage") | F.col("changed"), False), ignorenulls=True).over(inside))
    e = e.withColumn("etapa", F.last(F.when(F.col("opens") == "stage", said), ignorenulls=True).over(inside))
    e = e.withColumn("nombre", F.when((F.col("opens") == "experience") | acts, said)).withColumn("tipo", F.when(F.col("opens") == "experience", F.when(low.startswith("problema"), "soluciona_problema").otherwise("vive_experiencia")))
    acting = (F.col("kind") != "title") & ((F.col("section") == "acciones") | F.col("t").isin(*ACTIONS))
    acting = F.coalesce(acting, F.lit(False))
    e = e.withColumns({"orden": F.when(acting, 0).otherwise(F.col("orden")).cast("int"), "actividad": F.when(acting | ~F.coalesce("within", F.lit(False)), 0).otherwise(F.col("n")).cast("int")})
    e = e.where(acting | F.coalesce("open", F.lit(False)))
    named = e.where("nombre IS NOT NULL").select("doc", "orden", "actividad", "tipo", "nombre", F.when(F.col("actividad") > 0, F.col("etapa")).alias("etapa"))

    lines = e.where("kind <> 'title'").select("doc", "e", "orden", "actividad", F.col("t").alias("field"), F.explode("vals").alias("v")).select("doc", "e", "orden", "actividad", "field", "v.p", F.explode("v.l").alias("x")).select("doc", "e", "orden", "actividad", "field", "p", "x.y0", "x.x0", "x.y1", "x.t")
    key = ["doc", "orden", "actividad", "field", "e"]
    signs = segs.where(_bullet("t") & (F.col("x1") - F.col("x0") < 5)).select("doc", "p", "y0", "y1")
    items = bullet_items(lines.where(F.col("field").isin(*LISTS)), key, ["p", "y0", "x0"], signs)
    listed = items.groupBy("doc", "orden", "actividad", "field").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("e", "item", "t"))), lambda x: x["t"])).alias("texts"))
    text = _neat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "y0", "x0", "t"))), lambda x: x["t"]), " "))
    told = lines.where(~F.col("field").isin(*LISTS)).groupBy(*key).agg(text.alias("t"))
    order = F.transform(F.sort_array(F.collect_list(F.struct("e", "t"))), lambda x: x["t"])
    told = told.groupBy("doc", "orden", "actividad", "field").agg(order.alias("all")).select("doc", "orden", "actividad", "field", F.when(F.col("field").isin(*LAST), F.slice("all", -1, 1)).otherwise(F.array(F.array_join("all", " "))).alias("texts"))
    fields = listed.unionByName(told).groupBy("doc", "orden", "actividad").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "texts")))).alias("fields"))
    return named.join(fields, ["doc", "orden", "actividad"], "full").select("doc", "orden", "actividad", "tipo", "nombre", "etapa", "fields")
