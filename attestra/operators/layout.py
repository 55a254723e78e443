"""Reconstructing documents from positioned words, indented text and tables with merged cells."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tolerances of the layout, in points.
LINE, COLUMN_GAP, SOFT_GAP, COLUMN_NEAR, SUPPORT, CELL_X, CELL_Y, TABLE_X = 2.5, 8.0, 3.2, 1.5, 3, 2.0, 0.45, 20.0


def islands(df: DataFrame, key: Sequence[str], order: Sequence[str], breaks: Column, name: str = "island") -> DataFrame:
    """df numbered by stretches: a row where `breaks` holds begins a new one. breaks may use lag over the same window."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(name, F.sum(F.when(breaks, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def gap_islands(df: DataFrame, key: Sequence[str], at: str, gap: float, name: str = "island", ties: Sequence[str] = ()) -> DataFrame:
    """Stretches in which neighbours are at most `gap` apart."""
    w = Window.partitionBy(*key).orderBy(at, *ties)
    far = F.col(at) - F.lag(at).over(w) > gap
    return islands(df.withColumn("__far", F.coalesce(far, F.lit(True))), key, [at, *ties], F.col("__far"), name).drop("__far")


def visual_lines(words: DataFrame, tolerance: float = LINE) -> DataFrame:
    """Words (doc, p, x0, y0, x1, y1, t) with `line`: a word joins a line if it is less than the tolerance below its first word.

    Which word begins a line depends on the line before, so a page is folded as one array; pages are small and independent.
    """
    page = words.groupBy("doc", "p").agg(F.sort_array(F.collect_list(F.struct("y0", "x0", "x1", "y1", "t"))).alias("w"))
    step = lambda acc, w: F.when(F.abs(w["y0"] - acc["y"]) < tolerance, F.struct(acc["y"].alias("y"), acc["n"].alias("n"), F.concat(acc["at"], F.array(acc["n"])).alias("at"))).otherwise(F.struct(w["y0"].alias("y"), (acc["n"] + 1).alias("n"), F.concat(acc["at"], F.array(acc["n"] + 1)).alias("at")))
    start = F.struct(F.lit(-1e9).alias("y"), F.lit(-1).alias("n"), F.array().cast("array<int>").alias("at"))
    lines = page.withColumn("at", F.aggregate("w", start, step, lambda acc: acc["at"]))
    return lines.select("doc", "p", F.explode(F.arrays_zip("w", "at")).alias("x")).select("doc", "p", F.col("x.at").alias("line"), F.col("x.w.x0").alias("x0"), F.col("x.w.y0").alias("y0"), F.col("x.w.x1").alias("x1"), F.col("x.w.y1").alias("y1"), F.col("x.w.t").alias("t"))


def start_histogram(df: DataFrame, key: Sequence[str], value: Column, support: int = SUPPORT) -> DataFrame:
    """Rounded values (half to even) that occur at least `support` times within a key."""
    return df.groupBy(*key, F.bround(value, 0).cast("long").alias("start")).agg(F.count("*").alias("n")).where(F.col("n") >= support)


def column_starts(lines: DataFrame, support: int = SUPPORT) -> DataFrame:
    """doc, start, n: where columns begin, from words at line starts or after a gap."""
    w = Window.partitionBy("doc", "p", "line").orderBy("x0")
    firsts = lines.withColumn("gap", F.col("x0") - F.lag("x1").over(w)).where(F.col("gap").isNull() | (F.col("gap") > COLUMN_GAP))
    return start_histogram(firsts, ["doc"], F.col("x0"), support)


def segments(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Runs of words (doc, p, line, segment, x0, x1, y0, y1, t): cut at a wide gap, or at a small one where a column begins."""
    at = starts.groupBy("doc").agg(F.collect_list("start").alias("starts"))
    w = Window.partitionBy("doc", "p", "line").orderBy("x0")
    marked = lines.join(at, "doc", "left").withColumn("gap", F.col("x0") - F.lag("x1").over(w))
    near = F.exists(F.coalesce("starts", F.array().cast("array<bigint>")), lambda s: F.abs(s - F.col("x0")) <= COLUMN_NEAR)
    cut = F.col("gap").isNull() | (F.col("gap") > COLUMN_GAP) | ((F.col("gap") > SOFT_GAP) & near)
    numbered = islands(marked.withColumn("__cut", cut), ["doc", "p", "line"], ["x0"], F.col("__cut"), "segment")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "t"))), lambda x: x["t"]), " ")
    return numbered.groupBy("doc", "p", "line", "segment").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), text.alias("t"))


def cells(segs: DataFrame) -> DataFrame:
    """Segments with `cell`: those that begin at the same x and follow each other closely. Folded page by page."""

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in parts:
            open_: list[list] = []
            out = []
            for i, (x0, y0, y1) in enumerate(zip(page.x0, page.y0, page.y1, strict=True)):
                found = next((c for c in open_ if abs(c[0] - x0) <= CELL_X and -1 <= y0 - c[1] <= CELL_Y * (y1 - y0)), None)
                if found is None:
                    found = [x0, y1, i]
                    open_.append(found)
                found[1] = y1
                out.append(found[2])
            yield page.assign(cell=out)

    def one(page: pd.DataFrame) -> pd.DataFrame:
        return next(fold(iter([page.sort_values(["y0", "x0"]).reset_index(drop=True)])))

    return segs.groupBy("doc", "p").applyInPandas(one, segs.schema.simpleString()[7:-1].replace(":", " ") + ", cell int")


def value_to_the_right(items: DataFrame, labels: DataFrame, key: Sequence[str], dy: float = 3.0, dx: float = 5.0) -> DataFrame:
    """For each label the nearest item to its right on its line, unless that is itself a label. Both have x0, x1, y0, t."""
    a, b = labels.alias("a"), items.alias("b")
    near = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]).where((F.abs(F.col("a.y0") - F.col("b.y0")) < dy) & (F.col("b.x0") - F.col("a.x1") > dx))
    best = near.groupBy(*[F.col(f"a.{k}").alias(k) for k in key], F.col("a.t").alias("label"), F.col("a.y0").alias("y0")).agg(F.min_by(F.struct(F.col("b.t").alias("t"), F.col("b.x0").alias("x0")), F.col("b.x0")).alias("v"))
    return best.select(*key, "label", "y0", F.col("v.t").alias("value")).join(labels.select(*key, F.col("t").alias("value")).distinct(), [*key, "value"], "left_anti")


def nearest_anchor(items: DataFrame, anchors: DataFrame, key: Sequence[str], at: str, item_id: str, anchor_id: str) -> DataFrame:
    """item_id, anchor_id, distance: the nearest anchor of the same key; of equally near ones the lower, then the lower id.

    An as-of join in both directions: each side is put in order once and the anchors before and after are carried over, so no
    pairs of items and anchors are made.
    """
    it = items.select(*key, F.col(at).alias("__at"), F.col(item_id).alias("__item"), F.lit(None).cast(anchors.schema[anchor_id].dataType).alias("__anchor"), F.lit(1).alias("__kind"))
    an = anchors.select(*key, F.col(at).alias("__at"), F.lit(None).cast(items.schema[item_id].dataType).alias("__item"), F.col(anchor_id).alias("__anchor"), F.lit(0).alias("__kind"))
    both = an.unionByName(it)
    here = F.when(F.col("__kind") == 0, F.struct("__at", "__anchor"))
    w = Window.partitionBy(*key)
    before = F.last(here, ignorenulls=True).over(w.orderBy("__at", "__kind", F.desc("__anchor"), "__item").rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(here, ignorenulls=True).over(w.orderBy(F.desc("__at"), "__kind", F.desc("__anchor"), "__item").rowsBetween(Window.unboundedPreceding, 0))
    out = both.withColumn("b", before).withColumn("f", after).where("__kind = 1")
    db, df_ = F.abs(F.col("__at").cast("double") - F.col("b.__at").cast("double")), F.abs(F.col("f.__at").cast("double") - F.col("__at").cast("double"))
    back = F.col("f").isNull() | (F.col("b").isNotNull() & (db <= df_))
    return out.select(*key, F.col("__item").alias(item_id), F.when(back, F.col("b.__anchor")).otherwise(F.col("f.__anchor")).alias(anchor_id), F.when(back, db).otherwise(df_).alias("distance"))


def interval_else_previous(points: DataFrame, spans: DataFrame, key: Sequence[str], at: str, start: str, end: str, point_id: str, span_id: str) -> DataFrame:
    """point_id, span_id, inside: the last span begun at or before a point, and whether the point lies within it.

    For spans of one key that do not overlap: the last span begun is the one that holds the point, or the one before it.
    """
    sp = spans.select(*key, F.col(start).alias("__at"), F.lit(0).alias("__kind"), F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(span_id).alias("id")).alias("__span"), F.lit(None).cast(points.schema[point_id].dataType).alias("__p"))
    pt = points.select(*key, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(sp.schema["__span"].dataType).alias("__span"), F.col(point_id).alias("__p"))
    w = Window.partitionBy(*key).orderBy("__at", "__kind", "__span.id", "__p").rowsBetween(Window.unboundedPreceding, 0)
    out = sp.unionByName(pt).withColumn("__last", F.last("__span", ignorenulls=True).over(w)).where("__kind = 1")
    return out.select(*key, F.col("__p").alias(point_id), F.col("__last.id").alias(span_id), F.coalesce(F.col("__at") < F.col("__last.e"), F.lit(False)).alias("inside"))


def tolerant_mode(df: DataFrame, key: Sequence[str], value: str, tolerance: int = 3) -> DataFrame:
    """By key the value with the most rows within the tolerance around it; of equals the least. Values are whole numbers.

    Distinct values are counted first; each count then reaches its neighbours, so nothing is joined to itself.
    """
    counts = df.groupBy(*key, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    spread = counts.select(*key, F.explode(F.sequence(F.col("__v") - tolerance, F.col("__v") + tolerance)).alias("__v"), "__n").groupBy(*key, "__v").agg(F.sum("__n").alias("support"))
    present = spread.join(counts.drop("__n"), [*key, "__v"], "left_semi")
    best = present.groupBy(*key).agg(F.max_by(F.struct(F.col("__v").alias("mode"), "support"), F.struct("support", -F.col("__v"))).alias("x"))
    return best.select(*key, "x.*")


def zone(value: Column, cuts: Sequence[float]) -> Column:
    """How many cuts lie at or below a value."""
    out = F.lit(0)
    for c in cuts:
        out = out + F.when(value >= c, 1).otherwise(0)
    return out


def table_by_header(items: DataFrame, headers: Sequence[str], key: Sequence[str], gap: float = TABLE_X) -> DataFrame:
    """Items (x0, y0, t) of a table with `header`: clusters of x from left to right take the headers in order."""
    starts = gap_islands(items.select(*key, "x0").distinct(), key, "x0", gap, "cluster")
    named = items.join(starts, [*key, "x0"])
    return named.withColumn("header", F.get(F.array(*map(F.lit, headers)), F.col("cluster") - 1))


def fold_records(events: DataFrame, key: Sequence[str], order: str, opens: Column, field: str, text: str) -> DataFrame:
    """One row a record: an event that opens begins one; the texts of each field are joined in order, repeats once."""
    numbered = islands(events.withColumn("__opens", opens), key, [order], F.col("__opens"), "record")
    parts = numbered.groupBy(*key, "record", field).agg(F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"])), " ").alias("t"))
    return parts.groupBy(*key, "record").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(field, "t")))).alias("fields"))


def continuations(df: DataFrame, key: Sequence[str], order: Sequence[str], opens: Column, text: str, separator: str = " ") -> DataFrame:
    """Rows that open a record, with the texts of the rows that follow appended."""
    numbered = islands(df.withColumn("__opens", opens), key, order, F.col("__opens"), "record")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.col(text).alias("__t")))), lambda x: x["__t"]), separator)
    return numbered.groupBy(*key, "record").agg(joined.alias(text), F.count("*").alias("n_rows"))


def numbered_codes(df: DataFrame, group: Sequence[str], order: Sequence[str], base: Column, single: bool = True) -> Column:
    """A code for each row: the base, and '-2', '-3', ... for further rows of the group (or -01, -02 for all if not single)."""
    w = Window.partitionBy(*group).orderBy(*order)
    n = F.row_number().over(w)
    if single:
        return F.when(n == 1, base).otherwise(F.concat(base, F.lit("-"), n.cast("string")))
    many = F.count(F.lit(1)).over(Window.partitionBy(*group))
    return F.when(many == 1, base).otherwise(F.concat(base, F.lit("-"), F.lpad(n.cast("string"), 2, "0")))


def sections(blocks: DataFrame, key: Sequence[str], order: str, heading: Column, number: Column, title: Column, prefix: str) -> DataFrame:
    """Sections of a document from its blocks in reading order: code (numbered, or from the title; repeats get -2, -3, ...),
    title and text. Blocks before the first heading belong to none."""
    numbered = islands(blocks.withColumn("__h", heading), key, [order], F.col("__h"), "section").where("section > 0")
    slug = F.substring(F.regexp_replace(F.upper(title), "[^A-Z0-9]+", "-"), 1, 24)
    base = F.concat(F.lit(prefix + "-"), F.coalesce(F.when(number != "", number), slug))
    head = numbered.where("__h").select(*key, "section", base.alias("base"), title.alias("title"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~F.col("__h"), F.struct(F.col(order).alias("o"), F.col("text").alias("t"))))), lambda x: x["t"]), "\n")
    body = numbered.groupBy(*key, "section").agg(text.alias("text"))
    named = head.withColumn("code", numbered_codes(head, [*key, "base"], ["section"], F.col("base")))
    return named.join(body, [*key, "section"]).drop("base")


def fill_down(df: DataFrame, key: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Blank cells take the value above them."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.when(F.trim(c) != "", F.col(c)), ignorenulls=True).over(w) for c in columns})
