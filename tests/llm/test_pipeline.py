import os
import re
import zlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as cp
from attestra.llm import common, quality

from .test_dedup import brute_components, brute_starts
from .test_tokens import check_packing, reference  # noqa: F401

SF = "/root/testdata/sf0.001"


def brute_texts(rows):
    data = [(t or "").encode() for _, t in rows]
    out = {}
    for (i, t), b, at in zip(rows, data, brute_starts(data, 200), strict=True):
        gone = bytearray(len(b))
        for s in at:
            gone[s : s + 200] = b"\1" * 200
        out[i] = t if not at else bytes(x for x, g in zip(b, gone, strict=True) if not g).decode(errors="ignore")
    return out


def test_stages_equal_brute_force(spark, reference):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = cp.good_quality(spark, docs, SF).cache()
    assert good.columns == docs.columns
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.5}
    one = cp.one_of_each_group(spark, good, SF).cache()
    assert one.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in one.collect()} == {i for i, _, c in brute_components(rows, 5) if i == c}
    left = cp.without_repeats(spark, one, SF).cache()
    assert left.schema.simpleString() == docs.schema.simpleString()
    assert {r.doc_id: r.text for r in left.collect()} == brute_texts([(r.doc_id, r.text) for r in one.collect()])
    assert left.where(F.length("text") != F.col("n_chars")).count() == 0
    assert check_packing(cp.packed(spark, left, SF).collect(), left.collect(), reference) < 1.02
    assert cp.run(spark, SF).select("doc_id").distinct().count() == left.count()


def test_edges(spark, edge_docs, no_docs):
    keep = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (edge_docs.select(*keep, F.lit("x").alias("score"), F.lit(1).alias("node"), F.lit(2).alias("n_bytes"), F.lit("s").alias("spans"), F.lit("k").alias("kept"), F.lit(0).alias("__kept"), F.lit(1).alias("__quality"), F.lit("t").alias("__text")), no_docs.select(*keep)):
        n = docs.count()
        for stage in (cp.good_quality, cp.one_of_each_group, cp.without_repeats):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= n
        assert cp.packed(spark, docs, SF).select("doc_id").count() >= n
    once = cp.one_of_each_group(spark, edge_docs.select(*keep), SF)
    assert once.where("doc_id = 3").count() == 1 and once.where("doc_id = 5").count() == 0 and once.where("doc_id IN (1, 2, 6)").count() == 3


def test_workers_keep_no_memory_of_a_task_that_has_ended(spark):
    def state(batches):
        for _ in batches:
            pass
        rollup = Path("/proc/self/smaps_rollup").read_text()
        kept = sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", rollup))) // 1024
        yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([len(quality._words())]), pa.array([kept])], ["pid", "words", "mb"])

    # Another environment gets a daemon and workers of its own; one task at a time needs one worker.
    env = spark.sparkContext.environment
    common.ship(spark)
    env["ATTESTRA_TEST"] = "memory"
    try:
        probe = lambda: spark.range(1, numPartitions=1).mapInArrow(state, "pid long, words long, mb long").collect()[0]
        before = probe()
        words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda k: F.concat(F.lit("w"), F.hex(F.xxhash64("id", k)))), " ")
        docs = spark.range(4000, numPartitions=1).select(F.col("id").alias("doc_id"), words.alias("text"))
        assert quality.score(docs, (zlib.compress(bytes(4 << quality.BITS)), 0.0)).where("score = 0.5").count() == 4000
        after = probe()
    finally:
        del env["ATTESTRA_TEST"]
    assert after.pid == before.pid
    assert after.words == 0 and after.mb < before.mb + 40, (before, after)
