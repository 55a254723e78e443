"""From stage inputs (slides, charts, OCR, course plans, sections, annexes) to the tables of an evidence base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx

from . import labelling as lb
from . import layout

#: The total of credits a plan should have; the prefix and mark of institutional courses.
PLAN_CREDITS, INSTITUTIONAL = 150, "CAI"
EVIDENCE = ["codigo", "titulo", "tipo", "texto", "texto_ocr", "fuente", "archivo", "pagina", "sede", "proceso", "nivel"]


def _evidence(df: DataFrame, **columns: Column) -> DataFrame:
    known = {c: F.lit(None).cast("int" if c == "pagina" else "string") for c in EVIDENCE} | columns
    known |= {c: tx.hide_credentials(known[c]) for c in ("texto", "texto_ocr")}
    return df.select(*[known[c].alias(c) for c in EVIDENCE])


def ocr_lines(cache: DataFrame) -> DataFrame:
    """fuente, pagina, lineas of an OCR cache (fuente, paginas map<string, array<string>>)."""
    return cache.select("fuente", F.explode("paginas").alias("pagina", "lineas")).withColumn("pagina", F.col("pagina").try_cast("int"))


def slide_evidence(slides: DataFrame, ocr: DataFrame) -> DataFrame:
    """Evidence of slides (fuente, factor, nombre_fuente, archivo, sede, pagina, car, car_nombre, texto) that are no covers."""
    s = slides.where(~lb.is_cover(F.col("texto"))).join(ocr, ["fuente", "pagina"], "left")
    new = F.array_join(tx.novel_lines(F.coalesce("lineas", F.array().cast("array<string>")), F.col("texto")), "\n")
    s = s.withColumn("nuevo", F.when(new != "", new)).withColumn("clase", lb.slide_type(F.col("texto"), F.col("factor"))).withColumn("corto", lb.title(F.col("texto"), F.col("car_nombre")))
    numbered = F.concat(F.lit("Factor "), "factor", F.lit(", diapositiva "), "pagina")
    name = F.regexp_replace("car_nombre", r"\.+$", "")
    good = lb.is_good_title(F.col("corto"), F.col("car_nombre"))
    own = F.when(F.col("car_nombre").isNotNull(), F.when(good, F.concat(name, F.lit(": "), "corto")).otherwise(name)).otherwise(F.when(good, F.col("corto")).otherwise(numbered))
    lead = lb.section_title(F.col("texto"), F.concat("nombre_fuente", F.lit(", diapositiva "), "pagina"))
    # A slide that is a picture is named by the first legible line that OCR found.
    extra = F.get(F.filter(F.split("nuevo", "\n"), lambda x: F.length(x) >= 12), F.lit(0))
    bare = lead.endswith(F.concat(F.lit("diapositiva "), F.col("pagina").cast("string")))
    other = F.when(extra.isNotNull() & ~lead.contains(":"), F.substring(F.when(bare, extra).otherwise(F.concat(lead, F.lit(": "), extra)), 1, lb.TITLE_LENGTH)).otherwise(lead)
    title = lb.first_match([
        (F.coalesce(F.col("factor"), F.lit(0)) == 0, other), (F.col("clase") == "valoracion", F.concat(F.lit("Valoración interpretativa del factor "), "factor")),
        (F.col("clase") == "logros", F.concat(F.lit("Logros e impacto del factor "), "factor")), (F.col("clase") == "plan_mejora", F.concat(F.lit("Avance en el plan de mejoramiento, factor "), "factor")), (F.lit(True), own),
    ], "Diapositiva")
    return _evidence(s, codigo=lb.slide_code(F.col("fuente"), F.col("pagina")), titulo=title, tipo=F.col("clase"), texto=F.col("texto"), texto_ocr=F.col("nuevo"), fuente=lb.source_office(F.col("texto")), archivo=F.col("archivo"), pagina=F.col("pagina"), sede=F.col("sede"), proceso=F.lit("acreditacion"), nivel=F.lit("principal"))


def plan_evidence(pads: DataFrame, related: DataFrame) -> DataFrame:
    """Course plans (codigo, nombre, programa, texto, archivo) as evidence; those of a course of the programme are its own."""
    own = related.where("curso IS NOT NULL").select(F.col("pad").alias("codigo"), F.lit(True).alias("own"))
    s = pads.join(own, "codigo", "left")
    site = F.when(F.col("own") | F.lower(F.coalesce("programa", F.lit(""))).contains("agron"), "Programa").otherwise("Institución")
    return _evidence(s, codigo=F.concat(F.lit("PAD-"), "codigo"), titulo=F.concat(F.lit("PAD "), "nombre"), tipo=F.lit("pad"), texto=F.col("texto"), archivo=F.col("archivo"), sede=site, proceso=F.lit("acreditacion"), nivel=F.lit("principal"))


def table_text(tables: Column) -> Column:
    """Tables of a section as lines of cells."""
    return F.array_join(F.flatten(F.transform(tables, lambda t: F.transform(t["filas"], lambda row: F.array_join(row, " | ")))), "\n")


def section_evidence(sections: DataFrame, documents: DataFrame) -> DataFrame:
    """Sections (archivo, prefijo, codigo, titulo, pagina, parrafos, tablas) as evidence, with their documents' process and level."""
    s = sections.join(documents.select("prefijo", "proceso", "nivel", F.col("titulo").alias("documento")), "prefijo", "left")
    text = F.concat_ws("\n", F.array_join("parrafos", "\n"), table_text(F.col("tablas")))
    return _evidence(s, codigo=F.col("codigo"), titulo=F.concat_ws(" · ", "documento", "titulo"), tipo=F.lit("documento_maestro"), texto=text, archivo=F.col("archivo"), pagina=F.col("pagina"), sede=F.lit("Programa"), proceso=F.coalesce("proceso", F.lit("acreditacion")), nivel=F.coalesce("nivel", F.lit("principal")))


def annex_evidence(annexes: DataFrame) -> DataFrame:
    """Annexes (numero, nombre, codigo, archivo, texto) as complementary evidence; texts from OCR or files alike."""
    title = F.concat(F.lit("Anexo "), "numero", F.lit(" · "), "nombre", F.lit(" · "), "archivo")
    return _evidence(annexes, codigo=F.col("codigo"), titulo=title, tipo=F.lit("anexo"), texto=F.col("texto"), archivo=F.col("archivo"), sede=F.lit("Programa"), proceso=F.lit("ambos"), nivel=F.lit("complementaria"))


def attach_charts(charts: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grafica rows, tabla_diapositiva rows, orphans) of charts and tables (fuente, pagina, graficas, tablas); orders begin at 1."""
    coded = charts.withColumn("evidencia", lb.slide_code(F.col("fuente"), F.col("pagina")))
    known = evidence.select(F.col("codigo").alias("evidencia"))
    here, lost = coded.join(known, "evidencia", "left_semi"), coded.join(known, "evidencia", "left_anti").select("evidencia")
    g = here.select("evidencia", F.posexplode("graficas").alias("k", "g")).select("evidencia", (F.col("k") + 1).alias("orden"), "g.titulo", "g.tipo", F.posexplode("g.series").alias("s", "serie"))
    g = g.select("evidencia", "orden", "titulo", "tipo", (F.col("s") + 1).alias("serie_orden"), F.col("serie.nombre").alias("serie"), F.posexplode("serie.puntos").alias("p", "punto")).select("evidencia", "orden", "titulo", "tipo", "serie_orden", "serie", (F.col("p") + 1).alias("punto_orden"), "punto.categoria", "punto.valor")
    t = here.select("evidencia", F.posexplode("tablas").alias("k", "celdas")).select("evidencia", (F.col("k") + 1).alias("orden"), F.lit(None).cast("string").alias("leyenda"), *table_size(F.col("celdas")), tx.hide_in_cells(F.col("celdas")).alias("celdas"))
    return g, t, lost


def table_size(cells: Column) -> list[Column]:
    return [F.size(cells).alias("filas"), F.coalesce(F.array_max(F.transform(cells, lambda r: F.size(r))), F.lit(0)).alias("columnas")]


def section_tables(sections: DataFrame) -> DataFrame:
    t = sections.select(F.col("codigo").alias("evidencia"), F.posexplode("tablas").alias("k", "t"))
    return t.select("evidencia", (F.col("k") + 1).alias("orden"), "t.leyenda", *table_size(F.col("t.filas")), tx.hide_in_cells(F.col("t.filas")).alias("celdas"))


def unique_codes(pads: DataFrame) -> DataFrame:
    """Plans whose code another plan has too get their file's name as a suffix."""
    many = F.count(F.lit(1)).over(Window.partitionBy("codigo")) > 1
    return pads.withColumn("codigo", F.when(many, F.concat("codigo", F.lit("-"), F.regexp_replace(F.substring_index("archivo", "/", -1), r"\.[^.]*$", ""))).otherwise(F.col("codigo")))


def complement(pads: DataFrame, other: DataFrame, fields: list[str]) -> DataFrame:
    """Empty fields of plans filled from another reading of the same file; what a plan has already stays."""
    o = other.select("codigo", *[F.col(c).alias(f"__{c}") for c in fields])
    empty = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    return pads.join(o, "codigo", "left").withColumns({c: F.when(empty(c), F.col(f"__{c}")).otherwise(F.col(c)) for c in fields}).drop(*[f"__{c}" for c in fields])


def plan_tables(pads: DataFrame) -> dict[str, DataFrame]:
    """Child tables of course plans with nested results, phases and experiences (which hold activities)."""
    rea = pads.select(F.col("codigo").alias("pad"), F.posexplode("rea").alias("k", "r")).select("pad", "k", "r.consecutivo", "r.texto")
    first = rea.withColumn("n", F.row_number().over(Window.partitionBy("pad", "consecutivo").orderBy("k"))).where("n = 1").select("pad", "consecutivo", "texto")
    fases = pads.select(F.col("codigo").alias("pad"), F.posexplode("fases").alias("k", "f")).select("pad", (F.col("k") + 1).alias("orden"), "f.fase", "f.descripcion")
    exp = pads.select(F.col("codigo").alias("pad"), F.posexplode("experiencias").alias("k", "x")).select("pad", (F.col("k") + 1).alias("orden"), "x.*")
    act = exp.select("pad", F.col("orden").alias("experiencia_orden"), F.posexplode("actividades").alias("k", "a")).select("pad", "experiencia_orden", (F.col("k") + 1).alias("orden"), "a.*")
    act = act.withColumns({c: tx.first_int(F.col(c)) for c in ("semana_inicio",)}).withColumn("duracion_semanas", tx.first_int(F.col("duracion"))).drop("duracion")
    return {"pad_rea": first, "pad_fase": fases, "pad_experiencia": exp.drop("actividades"), "pad_actividad": act}


def table_by_caption(tables: DataFrame, pattern: str) -> DataFrame:
    """The first table (by evidencia and orden) whose caption matches, as rows: k, fila."""
    found = tables.where(F.regexp_like("leyenda", F.lit(pattern))).orderBy("evidencia", "orden").limit(1)
    return found.select(F.posexplode("celdas").alias("k", "fila"))


def proposed_plan(rows: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """Courses of a plan table (k, fila): 'Período N' rows carry down, totals are skipped; a second table gives other credits."""
    cell = lambda k: F.trim(F.get(F.col("fila"), F.lit(k)))
    period = F.regexp_extract(cell(0), r"(?iu)^per[ií]odo\s+(\w+)", 1)
    marked = rows.withColumn("p", F.when(period != "", F.coalesce(period.try_cast("int"), tx.roman(period)))).withColumn("__all", F.lit(0))
    down = lb.carry_down(marked, ["__all"], ["k"], F.col("p"), "periodo").where("p IS NULL").where(cell(0) != "").where(~F.regexp_like(cell(0), F.lit(r"(?iu)^total")))
    name = cell(0)
    out = down.select(F.col("k").alias("orden"), "periodo", name.alias("nombre"), F.when(name.startswith(INSTITUTIONAL) | (F.lower(cell(1)) == "x"), "institucional").otherwise("disciplinar").alias("tipo"), tx.first_int(cell(2)).alias("creditos"), tx.first_int(cell(3)).alias("horas_acompanamiento"), tx.first_int(cell(4)).alias("horas_independiente"), tx.first_int(cell(5)).alias("horas_total")).where("periodo IS NOT NULL")
    if shares is None:
        return out.withColumn("creditos_distribucion", F.lit(None).cast("int"))
    other = shares.select("k", tx.label_key(cell(0)).alias("__key"), tx.first_int(cell(1)).alias("c")).groupBy("__key").agg(F.min_by("c", "k").alias("creditos_distribucion"))
    return out.withColumn("__key", tx.label_key(F.col("nombre"))).join(other, "__key", "left").drop("__key")


def transition(rows: DataFrame) -> DataFrame:
    """Courses of today against those proposed (k, fila of six cells): merged cells on the left carry down."""
    cell = lambda k: F.trim(F.get(F.col("fila"), F.lit(k)))
    flat = rows.select("k", F.lit(0).alias("__all"), *[cell(j).alias(c) for j, c in enumerate(("curso_vigente", "semestre_vigente", "creditos_vigente", "curso_propuesto", "semestre_propuesto", "creditos_propuesto"))])
    down = layout.fill_down(flat, ["__all"], "k", ["curso_vigente", "semestre_vigente", "creditos_vigente"]).where("curso_propuesto <> ''")
    number = lambda c: F.coalesce(F.col(c).try_cast("int"), tx.roman(F.col(c)))
    return down.select(F.col("k").alias("orden"), "curso_vigente", number("semestre_vigente").alias("semestre_vigente"), tx.first_int(F.col("creditos_vigente")).alias("creditos_vigente"), "curso_propuesto", number("semestre_propuesto").alias("semestre_propuesto"), tx.first_int(F.col("creditos_propuesto")).alias("creditos_propuesto"))


def outcome_rows(rows: DataFrame) -> DataFrame:
    """codigo, texto of an outcome table (k, fila): a row without code continues the text of the row before."""
    cell = lambda k: F.trim(F.get(F.col("fila"), F.lit(k)))
    flat = rows.select("k", F.lit(0).alias("__all"), cell(0).alias("codigo"), cell(1).alias("texto"))
    heads = layout.islands(flat, ["__all"], ["k"], F.col("codigo") != "", "record").where("codigo <> ''").select("record", "codigo")
    return layout.continuations(flat, ["__all"], ["k"], F.col("codigo") != "", "texto").join(heads, "record").select("record", "codigo", "texto")


def warnings(pads: DataFrame, courses: DataFrame, related: DataFrame, plan: DataFrame, orphans: DataFrame) -> DataFrame:
    """What a load should tell people: (aviso, referencia)."""
    tell = lambda df, w, ref: df.select(F.lit(w).alias("aviso"), ref.alias("referencia"))
    c = courses.select(F.col("nombre").alias("curso"), F.col("periodo").alias("p"), F.col("creditos").alias("c"))
    linked = pads.join(related.select(F.col("pad").alias("codigo"), "curso"), "codigo", "left")
    joined = linked.join(c, "curso")
    total = plan.agg(F.sum("creditos").alias("n")).where(F.col("n") != PLAN_CREDITS)
    return (
        tell(joined.where("semestre <> p"), "semestre distinto", F.col("codigo")).unionByName(tell(joined.where("creditos <> c"), "créditos distintos", F.col("codigo")))
        .unionByName(tell(linked.join(related.select(F.col("pad").alias("codigo")), "codigo", "left_anti"), "PAD sin relación", F.col("codigo")))
        .unionByName(tell(orphans, "gráficas sin evidencia", F.col("evidencia"))).unionByName(tell(total, "total del plan", F.col("n").cast("string")))
    )
