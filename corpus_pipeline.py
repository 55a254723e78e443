"""The corpus pipeline: quality filter, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns the columns of documents; the
last returns the pieces of packed sequences. run() writes each stage's result in the shared folder and reads it back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm import common, neardup, packing, quality, repeats

#: No SQL can train the classifier or encode tokens; tests compare with a brute-force version.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more; the classifier learns from the labels of these documents.

    Null and empty texts have the score of the model's bias; a score of exactly 0.5 stays; repeated rows have one fate; very
    long texts are scored whole; an empty table gives no rows. Other columns, of whatever name, stay as they are.
    """
    (name,) = common.fresh(("__quality",), docs.columns)
    model = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=True, name=name).where(F.col(name) >= 0.5).drop(name)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the document with the least id.

    Documents without words, null texts among them, are no group and all stay. Where an id repeats, rows of equal text are
    one document; a null id is an id. Very long texts are taken whole, an empty table gives no rows, other columns stay.
    """
    kept_id, again_id = common.fresh(("__kept", "__again"), docs.columns)
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(kept_id)).distinct()
    out = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept[kept_id]), "left_semi")
    again = common.cut(docs.groupBy(F.col("doc_id").alias(again_id)).count().where("count > 1").select(again_id), "pipeline-ids")
    if again.isEmpty():
        common.drop(again)
        return out
    same = out["doc_id"].eqNullSafe(again[again_id])
    return out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that strings of 200 repeated bytes cover; characters cut in two go too; n_chars is counted anew.

    A document may be left with an empty text; it stays, as only its repeated passages were at fault. Null texts stay null,
    repeated rows of 200 bytes or more lose all their text, very long texts are taken whole, an empty table gives no rows,
    other columns stay, whatever their names.
    """
    common.ship(spark)
    size, spans, left = common.fresh(("n_bytes", "spans", "kept"), docs.columns)
    out = repeats.remove_repeats(docs, names=(size, spans, left))
    changed = out.withColumn(left, F.when(F.size(spans) > 0, F.col(left))).drop(size, spans)
    names = docs.columns
    at, kept = names.index("text"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.as_py().decode(errors="ignore") if b.is_valid else t.as_py() for t, b in zip(batch.column(at), batch.column(kept), strict=True)]
            cols = list(batch.columns[:kept])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    done = common.mapped(changed, run, docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else done


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences with their token ids; nulls, empty and very long texts, ties and repeats as pack() says."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("near-duplicates", one_of_each_group), ("repeats", without_repeats), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:  # the stage before has been read for the last time
            common.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
