"""Activities of a course plan in the second template: a wide table without rules, read from where its words stand.

Every table is handled on its own, all tables at once: its columns are found by the words of weeks and durations, words are
dealt to zones, names open activities, and all else goes to the activity beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx

from .forms import ABOVE, AFTER_EXPERIENCES, EXPERIENCE, LEFT_HALF, _neat
from .layout import cells, islands, nearest_anchor

#: Words that mark the week and the duration, the sentence on instruments and the kinds within it.
WEEK, WEEKS, LAST, TOOLS, KIND = "Semana", "Semana(s)", r"\d+\s*Semana\(s\)", "Herramientas de Recolecci", r"\(([^()]{2,40})\)\s*:"
#: Fixed values, in points: from the week's column to the duration's, from there to the next, between columns, of a name.
APART, WIDE, COLUMN, NAME = 45, 40, 60, 110

#: The title of the table of phases, its headers, what follows it, its first words, signs of an empty table.
PHASES, PHASE_HEADS, AFTER_PHASES, PHASE = "fases del mca", ("fase", "descripcion"), ("vive una experiencia", "soluciona un problema"), r"^Fase \d+"
NOTHING = r"(?i)^(No hay elementos registrados|Sin recursos registrados|No hay datos)$"

FIELDS = ("nombre", "descripcion", "semana_inicio", "duracion", "trabajo_profesor", "trabajo_estudiante")
_BOX = ("doc", "p", "x0", "y0", "x1", "y1", "t")


def _place(p: Column | str = "p", y: Column | str = "y0") -> Column:
    return (F.col(p) if isinstance(p, str) else p) * 100_000 + (F.col(y) if isinstance(y, str) else y)


def _joined_text(rows: Column, order: tuple[str, ...] = ("x0",)) -> Column:
    return F.array_join(F.transform(F.sort_array(F.transform(rows, lambda w: F.struct(*[w[c].alias(c) for c in order], w["t"].alias("t")))), lambda w: w["t"]), " ")


def table_words(words: DataFrame) -> DataFrame:
    """Segments with their words (ws) below the first header 'actividades' of each experience, and its number `orden`."""
    whole = words.groupBy("doc", "p", "line", "segment").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sort_array(F.collect_list(F.struct("x0", "x1", "y0", "y1", "t"))).alias("ws"))
    segs = whole.withColumn("t", F.array_join(F.transform("ws", lambda w: w["t"]), " ")).withColumns({"pos": _place(), "plain": tx.label_key(F.col("t"))})
    segs = segs.withColumn("opens", F.regexp_like("t", F.lit(EXPERIENCE)) & (F.col("x0") < LEFT_HALF))
    numbered = islands(segs, ["doc"], ["pos", F.desc("opens"), "x0", "t"], F.col("opens"), "orden")
    each = Window.partitionBy("doc")
    numbered = numbered.withColumn("starts", F.sort_array(F.collect_list(F.when(F.col("opens"), F.col("pos"))).over(each)))
    numbered = numbered.withColumn("end", F.coalesce(F.get("starts", F.col("orden").cast("int")) - ABOVE, F.min(F.when(F.col("plain").isin(*AFTER_EXPERIENCES), F.col("pos"))).over(each), F.lit(float("inf"))))
    top = F.min(F.when((F.col("plain") == "actividades") & (F.col("pos") < F.col("end")), F.col("pos"))).over(Window.partitionBy("doc", "orden"))
    return numbered.withColumn("top", top).where("orden > 0 AND pos > top AND pos < end").select(*_BOX, "line", "segment", "orden", "ws")


def _mode(values: Column) -> Column:
    """The value with the most others at most 3 away, of equals the least; null if there is none."""
    return -F.array_max(F.transform(values, lambda x: F.struct(F.size(F.filter(values, lambda y: F.abs(y - x) <= 3)).alias("n"), (-x).alias("x"))))["x"]


def _tables(segs: DataFrame) -> DataFrame:
    """doc, orden, segs (array), cuts (where the zones begin): one row for each table that has weeks or durations."""
    line = Window.partitionBy("doc", "orden", "p", "line").orderBy("x0")
    near = lambda a, b: F.coalesce((b - a > 0) & (b - a < 6), F.lit(False))
    digits = lambda c: F.regexp_like(c, F.lit(r"^\d+$"))
    seen = segs.select("doc", "orden", "p", "line", F.explode("ws").alias("w")).select("doc", "orden", "p", "line", "w.*")
    seen = seen.withColumns({"before": F.lag(F.struct("x0", "x1", "t")).over(line), "after": F.lead(F.struct("x0", "t")).over(line)})
    week = (F.col("t") == WEEK) & near(F.col("x1"), F.col("after.x0")) & digits("after.t") & ~near(F.col("before.x1"), F.col("x0"))
    last = (F.col("t") == WEEKS) & digits("before.t") & near(F.col("before.x1"), F.col("x0"))
    marks = seen.groupBy("doc", "orden").agg(F.collect_list(F.when(week, F.bround("x0"))).alias("weeks"), F.collect_list(F.when(last, F.bround("before.x0"))).alias("lasts"))
    whole = segs.groupBy("doc", "orden").agg(F.sort_array(F.collect_list(F.struct("p", "y0", "x0", "x1", "y1", "t", "ws"))).alias("segs"))
    row = whole.join(marks, ["doc", "orden"]).withColumns({"week": _mode(F.col("weeks")), "last": _mode(F.col("lasts"))}).where("week IS NOT NULL OR last IS NOT NULL")
    row = row.withColumns({"week": F.coalesce("week", F.col("last") - APART), "last": F.coalesce("last", F.col("week") + APART)})
    right = F.transform(F.filter("segs", lambda s: s["x0"] > F.col("last") + WIDE), lambda s: F.bround(s["x0"] / 10) * 10)
    row = row.withColumn("right", right)
    row = row.withColumn("right", F.filter(F.array_distinct("right"), lambda x: F.size(F.filter("right", lambda y: y == x)) >= 3))
    student = F.array_min(F.filter("right", lambda x: x - F.array_min("right") > COLUMN)) - 5
    told = F.transform(F.filter("segs", lambda s: (s["x0"] > 40) & (s["x0"] < F.col("week") - 50) & (F.length(s["t"]) > 45)), lambda s: F.bround(s["x0"]))
    row = row.withColumns({"student": student, "told": told}).withColumn("name_end", F.least(F.lit(float(NAME)), _mode(F.col("told")) - 3.0))
    cuts = F.array("name_end", F.col("week") - 4.0, F.col("last") - 4.0, F.col("last") + float(WIDE), F.coalesce("student", F.lit(float("inf"))))
    return row.select("doc", "orden", "segs", cuts.alias("cuts"))


def _pieces(tables: DataFrame) -> DataFrame:
    """Rows (table, zone, k, p, x0, y0, x1, y1, t): segments cut where zones begin; sentences on instruments are whole, zone 6."""
    heads = F.filter("segs", lambda s: F.contains(s["t"], F.lit(TOOLS)))
    goes_on = lambda h, s: (s["p"] == h["p"]) & (s["y0"] > h["y0"]) & (s["y0"] - h["y0"] < 40) & (F.abs(s["x0"] - h["x0"]) < 30)
    row = tables.withColumn("heads", heads)
    rest = lambda h: F.regexp_replace(F.substring_index(h["t"], TOOLS, -1), r"^[^:]*:", "")
    tool = lambda h: F.struct(F.lit(6).alias("zone"), *[h[c].alias(c) for c in _BOX[1:6]], _neat(F.concat_ws(" ", rest(h), _joined_text(F.filter("segs", lambda s: goes_on(h, s)), ("y0", "x0")))).alias("t"))
    row = row.withColumn("tools", F.transform("heads", tool))
    row = row.withColumn("free", F.filter("segs", lambda s: ~F.contains(s["t"], F.lit(TOOLS)) & ~F.exists("heads", lambda h: goes_on(h, s))))
    zone = lambda w: F.size(F.filter("cuts", lambda c: w["x0"] >= c))
    part = lambda s, ws, z: F.struct(z.alias("zone"), s["p"].alias("p"), F.array_min(F.transform(ws, lambda w: w["x0"])).alias("x0"), F.array_min(F.transform(ws, lambda w: w["y0"])).alias("y0"), F.array_max(F.transform(ws, lambda w: w["x1"])).alias("x1"), F.array_max(F.transform(ws, lambda w: w["y1"])).alias("y1"), _joined_text(ws).alias("t"))
    split = lambda s: F.transform(F.array_distinct(F.transform(s["ws"], zone)), lambda z: part(s, F.filter(s["ws"], lambda w: zone(w) == z), z))
    both = row.select("doc", "orden", F.concat(F.flatten(F.transform("free", split)), F.col("tools")).alias("pieces"))
    each = both.select("doc", "orden", F.posexplode("pieces").alias("k", "x")).select("doc", "orden", "k", "x.*")
    return each.withColumn("alone", F.when(F.col("zone").isin(2, 3, 6), F.col("k")).otherwise(-1))


def _owned(rows: Column, owner) -> Column:
    return F.transform(rows, lambda c: F.struct(owner(c).alias("owner"), c.alias("c")))


def activities(words: DataFrame) -> DataFrame:
    """doc, orden (of the experience), actividad (number), the six fields, instrumentos, descripcion_instrumentos.

    words: doc, p, line, segment, x0, y0, x1, y1, t, the segment as layout numbers it. A cell of names is an activity; where
    there are more of them than durations, all beside one duration are. An activity's week and duration are the first found
    beside it; texts are dealt by height, those that go on after a page break to the last activity before. A table without
    weeks, durations or names gives no rows. A table is one row of arrays, as it lies on a few pages of one document.
    """
    pieces = _pieces(_tables(table_words(words)))
    boxed = pieces.select(F.to_json(F.struct("doc", "orden", "zone", "alone")).alias("doc"), "p", "x0", "y0", "x1", "y1", "t")
    lines = cells(boxed).groupBy("doc", "p", "cell").agg(F.sort_array(F.collect_list(F.struct("y0", "x0", "y1", "t"))).alias("lines"))
    cell = lines.withColumn("in", F.from_json("doc", "doc string, orden long, zone int, alone int")).select("in.doc", "in.orden", "in.zone", "p", F.col("lines")[0]["y0"].alias("y0"), "cell", F.element_at("lines", -1)["y1"].alias("y1"), F.col("lines")[0]["x0"].alias("x0"), F.transform("lines", lambda x: x["t"]).alias("ts"))
    cell = cell.withColumn("yc", (F.col("y0") + F.col("y1")) / 2).withColumn("t", F.array_join("ts", " "))
    whole = F.struct("p", "y0", "x0", "cell", "y1", "yc", "t")
    table = cell.groupBy("doc", "orden").agg(*[F.sort_array(F.collect_list(F.when(F.col("zone") == k, whole))).alias(f) for k, f in enumerate((*FIELDS, "tools"))])

    # Names: by themselves, or together if they are beside the same duration.
    table = table.withColumn("marks", F.filter("duracion", lambda d: F.regexp_like(d["t"], F.lit(LAST))))
    beside = lambda n: F.array_min(F.transform("marks", lambda d, i: F.struct((d["p"] != n["p"]).alias("far"), F.abs(d["yc"] - n["yc"]).alias("d"), i.alias("i"))))["i"]
    more = (F.size("marks") > 0) & (F.size("nombre") > F.size("marks"))
    table = table.withColumn("named", F.when(more, _owned(F.col("nombre"), beside)).otherwise(F.transform("nombre", lambda n, i: F.struct(i.alias("owner"), n.alias("c")))))
    members = lambda g: F.transform(F.filter("named", lambda n: n["owner"] == g), lambda n: n["c"])
    one = lambda ns: F.struct(ns[0]["p"].alias("p"), ns[0]["y0"].alias("y0"), ((ns[0]["y0"] + F.element_at(ns, -1)["y1"]) / 2).alias("yc"), _neat(F.array_join(F.transform(ns, lambda n: n["t"]), " ")).alias("nombre"))
    table = table.withColumn("groups", F.transform(F.array_distinct(F.transform("named", lambda n: n["owner"])), members))
    table = table.withColumn("acts", F.sort_array(F.transform("groups", one))).where("size(acts) > 0")

    # Weeks and durations go to the nearest activity of their page, all else by height.
    closest = lambda s: F.coalesce(F.array_min(F.filter(F.transform("acts", lambda a, i: F.when(a["p"] == s["p"], F.struct(F.abs(a["yc"] - s["yc"]).alias("d"), i.alias("i")))), lambda x: x.isNotNull()))["i"], F.lit(0))
    held = lambda c: F.array_min(F.transform("acts", lambda a, i: F.when((a["p"] == c["p"]) & (a["yc"] >= c["y0"] - 4) & (a["yc"] <= c["y1"] + 4), i)))
    above = lambda c: F.array_max(F.transform("acts", lambda a, i: F.when(_place(a["p"], a["y0"]) <= _place(c["p"], c["y0"]), i)))
    dealt = lambda c: F.coalesce(held(c), above(c), F.lit(0))
    # A week's word and its number may stand on two lines.
    number = lambda s: F.get(F.filter("semana_inicio", lambda v: (v["p"] == s["p"]) & (v["y0"] > s["y0"]) & (v["y0"] - s["y0"] < 14) & F.regexp_like(v["t"], F.lit(r"^\d+$"))), F.lit(0))["t"]
    table = table.withColumn("semana_inicio", F.transform("semana_inicio", lambda s: F.struct(s["p"].alias("p"), s["yc"].alias("yc"), F.when(s["t"] == WEEK, F.concat_ws(" ", s["t"], number(s))).otherwise(s["t"]).alias("t"))))
    told = ("descripcion", "trabajo_profesor", "trabajo_estudiante")
    has = lambda p: lambda s: F.regexp_like(s["t"], F.lit(p))
    table = table.withColumns({f: _owned(F.filter(f, has(p)), closest) for f, p in (("semana_inicio", r"Semana \d+"), ("duracion", LAST))} | {f: _owned(F.filter(f, lambda c: ~c["t"].startswith("Herramientas")), dealt) for f in told} | {"tools": _owned(F.col("tools"), dealt)})
    row = table.select("*", F.posexplode("acts").alias("a", "act"))
    mine = lambda f: F.transform(F.filter(f, lambda x: x["owner"] == F.col("a")), lambda x: x["c"]["t"])
    row = row.withColumns({f: mine(f) for f in ("semana_inicio", "duracion", "tools", *told)})
    first = lambda f, p: F.nullif(F.regexp_extract(F.get(f, F.lit(0)), p, 0), F.lit(""))
    row = row.withColumns({"semana_inicio": first("semana_inicio", r"Semana \d+"), "duracion": first("duracion", LAST)} | {f: F.nullif(_neat(F.array_join(f, " ")), F.lit("")) for f in told})
    row = row.withColumn("semana_inicio", F.coalesce("semana_inicio", F.nullif(F.regexp_extract("descripcion", r"^Semana \d+", 0), F.lit(""))))
    kinds = lambda t: F.regexp_extract_all(t, F.lit(KIND))
    some = F.array_distinct(F.flatten(F.transform("tools", lambda t: F.when(F.size(kinds(t)) > 0, kinds(t)).otherwise(F.array(t)))))
    products = F.nullif(F.array_join(F.filter("tools", lambda t: F.size(kinds(t)) > 0), " "), F.lit(""))
    row = row.withColumns({"instrumentos": F.when(F.size("tools") > 0, some), "descripcion_instrumentos": products})
    return row.select("doc", F.col("orden").cast("int").alias("orden"), (F.col("a") + 1).alias("actividad"), F.col("act.nombre").alias("nombre"), *FIELDS[1:], "instrumentos", "descripcion_instrumentos")


def phases(segs: DataFrame) -> DataFrame:
    """doc, orden, fase, descripcion of the table of phases: each segment goes to the phase nearest in height, its side tells the field.

    The right side begins where the first long text does. A table that says only that it is empty gives no rows.
    """
    s = segs.select(*_BOX).withColumns({"pos": _place(), "plain": tx.label_key(F.col("t")), "at": _place(y=(F.col("y0") + F.col("y1")) / 2)})
    top = s.where(F.col("plain") == PHASES).groupBy("doc").agg(F.min(_place(y="y1")).alias("top"))
    below = s.join(top, "doc").where("pos > top")
    end = below.where(F.col("plain").isin(*AFTER_PHASES)).groupBy("doc").agg(F.min("pos").alias("end"))
    body = below.join(end, "doc", "left").where(F.col("end").isNull() | (F.col("pos") < F.col("end"))).where(~F.col("plain").isin(*PHASE_HEADS))
    each = Window.partitionBy("doc")
    body = body.withColumn("side", F.coalesce(F.min(F.when(F.length("t") > 60, F.col("x0"))).over(each), F.lit(250.0)) - 5)
    body = body.withColumn("some", F.max(~F.regexp_like(F.trim("t"), F.lit(NOTHING))).over(each)).where("some")
    body = body.withColumn("__id", F.row_number().over(each.orderBy("p", "y0", "x0", "t")))
    marks = body.where((F.col("x0") < F.col("side")) & F.regexp_like("t", F.lit(PHASE))).select("doc", "at", F.col("__id").alias("mark"))
    owned = body.join(nearest_anchor(body, marks, ["doc"], "at", "__id", "mark").where("mark IS NOT NULL").select("doc", "__id", "mark"), ["doc", "__id"])
    said = lambda c: _neat(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, F.struct("__id", "t")))), lambda x: x["t"]), " "))
    out = owned.groupBy("doc", "mark").agg(said(F.col("x0") < F.col("side")).alias("fase"), F.nullif(said(F.col("x0") >= F.col("side")), F.lit("")).alias("descripcion"))
    return out.select("doc", F.row_number().over(Window.partitionBy("doc").orderBy("mark")).alias("orden"), "fase", "descripcion")
