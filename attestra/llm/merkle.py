"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

A section is a line; its paragraphs are sentences, or stretches of 64 characters where none ends. A paragraph's digest is
the MD5 of its text, a section's that of its paragraphs' digests, the root's the SHA-256 of the sections' digests. Equal
roots mean equal texts; where roots differ, the sections and paragraphs whose digests differ locate the edits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: A paragraph: up to 64 characters up to the end of a sentence, with the marks and spaces that follow.
PARAGRAPH = r"([^.!?]{1,64}[.!?]*[ \t\r]*|[.!?]+[ \t\r]*)"
_CUT = "\x01"
#: Digest of an empty paragraph, which says nothing about likeness.
_EMPTY = "d41d8cd98f00b204"


def _tree(text: Column) -> Column:
    """array<struct<digest, leaves>>, one element for each section."""

    def section(line: Column) -> Column:
        cut = F.regexp_replace(line, PARAGRAPH, "$1" + _CUT)
        leaves = F.transform(F.split(F.substring(cut, F.lit(1), F.greatest(F.length(cut) - 1, F.lit(0))), _CUT, -1), lambda p: F.md5(p))
        return F.struct(F.md5(F.array_join(leaves, "")).alias("digest"), F.transform(leaves, lambda d: F.substring(d, 1, 16)).alias("leaves"))

    return F.transform(F.split(text, "\n", -1), section)


def _fingerprint(tree: Column) -> Column:
    root = F.sha2(F.array_join(F.transform(tree, lambda s: s["digest"]), ""), 256)
    return F.concat(root, F.lit(":"), F.array_join(F.transform(tree, lambda s: F.concat(F.substring(s["digest"], 1, 16), F.lit("="), F.array_join(s["leaves"], "."))), ";"))


def add_fingerprint(df: DataFrame, text: Column, fingerprint: str, leaves: str) -> DataFrame:
    """df with a fingerprint column and a column of the distinct paragraph digests in it."""
    tree = f"__tree_{fingerprint}"
    return df.withColumn(tree, _tree(text)).withColumns({fingerprint: _fingerprint(F.col(tree)), leaves: F.array_distinct(F.array_remove(F.flatten(F.transform(tree, lambda s: s["leaves"])), _EMPTY))}).drop(tree)


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots, else the Dice coefficient of the distinct paragraph digests, 0 where there are none."""
    total = F.size(leaves_a) + F.size(leaves_b)
    shared = F.size(F.array_intersect(leaves_a, leaves_b))
    return F.when(F.substring(root_a, 1, 64) == F.substring(root_b, 1, 64), F.lit(1.0)).when(total > 0, F.round(2.0 * shared / total, 9)).otherwise(0.0)


def differing_sections(a: Column, b: Column) -> Column:
    """Indexes (from 0) of the sections whose digests differ between two fingerprints; a missing section differs."""
    sections = lambda f: F.transform(F.split(F.substring_index(f, ":", -1), ";"), lambda s: F.substring_index(s, "=", 1))
    pairs = F.arrays_zip(sections(a).alias("x"), sections(b).alias("y"))
    marked = F.transform(pairs, lambda p, i: F.when(~p["x"].eqNullSafe(p["y"]), i))
    return F.filter(marked, lambda i: i.isNotNull())


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint, leaves (distinct paragraph digests) of every row.

    A null text counts as empty, a null id is carried, repeated rows get equal fingerprints, an empty table gives no rows,
    other columns are ignored; very long texts have long fingerprints, as every paragraph is in them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return add_fingerprint(docs.select(F.col(id_col).alias("doc_id"), text.alias("__text")), F.col("__text"), "fingerprint", "leaves").select("doc_id", F.length("__text").cast("long").alias("n_chars"), "fingerprint", "leaves")


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, text) with next_text: the text of the next row by ascending doc_id, then text; after the last, the first.

    Null ids come first. Rows are dealt into ranges of ids, each ordered by itself; the rows that begin a range also go,
    as ghosts, to the range before it, so no order over all rows is needed. The range borders are ids found by one pass over
    the id column, as many as there are buckets.
    """
    n = max(1, buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    side = max(1, math.isqrt(n))
    shares = [k / (side * side) for k in range(1, side * side)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10 * side * side).alias("p"), F.min("doc_id").alias("low"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls")).first()
    low = found["low"]
    borders = sorted({b for b in (found["p"] or []) if shares and b > low}) if low is not None else []
    # Two steps find a row's range: first among each side-th border, then among the borders in between.
    chunks = [borders[k : k + side] for k in range(0, len(borders), side)] or [[]]
    coarse = F.array(*[F.lit(c[0]) for c in chunks[1:]]).cast("array<bigint>")
    fine = F.array(*[F.array(*map(F.lit, c)).cast("array<bigint>") for c in chunks])
    key = F.coalesce(F.col("doc_id"), F.lit(low if low is not None else 0))
    at = F.size(F.filter(coarse, lambda b: b <= key))
    placed = docs.withColumn("__c", at).withColumn("__bucket", F.col("__c") * side + F.size(F.filter(F.element_at(fine, F.col("__c") + 1), lambda b: b <= key)))
    last = len(borders)
    starts = F.col("doc_id").isNull() if found["nulls"] else F.col("doc_id") == F.lit(low)
    begins = F.array_contains(F.element_at(fine, F.col("__c") + 1), key)
    copies = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(0).alias("ghost")), F.when(begins, F.struct((F.col("__bucket") - 1).alias("b"), F.lit(1).alias("ghost"))), F.when(starts, F.struct(F.lit(last).alias("b"), F.lit(2).alias("ghost"))))
    dealt = placed.select("doc_id", "text", F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("__g")).select("doc_id", "text", F.col("__g.b").alias("__b"), F.col("__g.ghost").alias("__ghost"))
    order = Window.partitionBy("__b").orderBy("__ghost", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).filter("__ghost = 0").drop("__b", "__ghost")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return compare_with_edit(docs)


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of (doc_id, text), of each text with its last half replaced from the next one, and their likeness.

    A null text counts as empty, a null id comes first in the order, rows of one id are ordered by text (equal rows follow
    each other), a single row is its own next, an empty table gives no rows, very long texts are taken whole. Sections and
    paragraphs are compared by 64 bits of their digests, whole texts by the root's 256.
    """
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    half = F.floor(F.length("text") / 2).cast("int")
    head = lambda c, n: F.substring(c, F.lit(1), n)
    df = with_next(docs).withColumn("edited", F.concat(head(F.col("text"), F.length("text") - half), head(F.col("next_text"), half)))
    df = add_fingerprint(df, F.col("text"), "fingerprint", "leaves")
    df = add_fingerprint(df, F.col("edited"), "edited_fingerprint", "edited_leaves")
    df = add_fingerprint(df, F.col("next_text"), "next_fingerprint", "next_leaves")
    return df.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("leaves"), F.col("edited_fingerprint"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("leaves"), F.col("next_fingerprint"), F.col("next_leaves")).alias("near_next"),
    )


def _tree_sql(text: str) -> str:
    pattern = PARAGRAPH.replace("'", "''")
    cut = f"regexp_replace(line, '{pattern}', '\\1' || chr(1), 'g')"
    leaves = f"list_transform(string_split(substring({cut}, 1, greatest(length({cut}) - 1, 0)), chr(1)), lambda p: md5(p))"
    return f"list_transform(list_transform(string_split({text}, chr(10)), lambda line: {leaves}), lambda x: {{'digest': md5(array_to_string(x, '')), 'leaves': list_transform(x, lambda d: substring(d, 1, 16))}})"


_FINGERPRINT_SQL = "sha256(array_to_string(list_transform({t}, lambda s: s.digest), '')) || ':' || array_to_string(list_transform({t}, lambda s: substring(s.digest, 1, 16) || '=' || array_to_string(s.leaves, '.')), ';')"
_LEAVES_SQL = "list_distinct(list_filter(flatten(list_transform({t}, lambda s: s.leaves)), lambda x: x <> '" + _EMPTY + "'))"
_LIKENESS_SQL = "CASE WHEN substring({f}, 1, 64) = substring({g}, 1, 64) THEN 1.0::DOUBLE WHEN len({x}) + len({y}) > 0 THEN round(2.0::DOUBLE * len(list_intersect({x}, {y})) / (len({x}) + len({y})), 9) ELSE 0.0::DOUBLE END"

ORACLE = f"""
WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY doc_id, t), first_value(t) OVER (ORDER BY doc_id, t)) AS nx FROM d),
e AS (SELECT doc_id, t, n, nx, substring(t, 1, n - n // 2) || substring(nx, 1, n // 2) AS ed FROM n),
tr AS (SELECT doc_id, n, ed, {_tree_sql('t')} AS a, {_tree_sql('ed')} AS b, {_tree_sql('nx')} AS c FROM e),
f AS (SELECT doc_id, n, ed, {_FINGERPRINT_SQL.format(t='a')} AS fa, {_FINGERPRINT_SQL.format(t='b')} AS fb, {_FINGERPRINT_SQL.format(t='c')} AS fc,
  {_LEAVES_SQL.format(t='a')} AS la, {_LEAVES_SQL.format(t='b')} AS lb, {_LEAVES_SQL.format(t='c')} AS lc FROM tr)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(ed) AS edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
  {_LIKENESS_SQL.format(f='fa', g='fb', x='la', y='lb')} AS near_edited, {_LIKENESS_SQL.format(f='fa', g='fc', x='la', y='lc')} AS near_next
FROM f"""
