import hashlib
import math
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestra.llm import licenses, merkle, quality, url_filter

from .conftest import invented

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.op4_quality(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.9


def slow_model(examples):
    """The same learner written out: a dictionary of weights, one coordinate at a time."""
    z, n = {}, {}

    def vector(text):
        x = {-1: 1.0}
        for family in quality.features(text):
            for i in family.tolist():
                x[i] = x.get(i, 0.0) + 1 / len(family)
        return x

    def weight(i):
        zi, l1 = z.get(i, 0.0), 0.0 if i == -1 else quality.L1
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA + quality.L2)

    rows = [(vector(t), y) for t, y in examples]
    for _ in range(quality.EPOCHS):
        for x, y in rows:
            w = {i: weight(i) for i in x}
            g = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - y
            for i, v in x.items():
                old = n.get(i, 0.0)
                n[i] = old + (g * v) ** 2
                z[i] = z.get(i, 0.0) + g * v - (math.sqrt(n[i]) - math.sqrt(old)) / quality.ALPHA * w[i]
    return lambda text: 1 / (1 + math.exp(-sum(weight(i) * v for i, v in vector(text).items())))


def test_training_and_scores_equal_a_plain_version(spark, rng):
    texts = [invented(rng, rng.randint(0, 40)) + rng.choice(["", "!!!", "\n\nBuy $$$ now"]) for _ in range(120)]
    examples = [(t, int("$" not in t)) for t in texts]
    weights, bias = quality.train(iter(examples))
    slow = slow_model(examples)
    for t in [*texts, "", "unseen words only"]:
        assert quality.raw_score(t, weights, bias) == pytest.approx(slow(t), abs=1e-5)
    docs = spark.createDataFrame([(k % 5, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)], "doc_id long, quality int")
    few = quality.fit(docs, labels, rows=7)  # ids repeat: rows are bounded, not ids
    used = [(r.text, r.y) for r in docs.join(labels.selectExpr("doc_id", "quality AS y"), "doc_id").where(quality.fold(F.col("doc_id")) != 1).withColumn("k", F.xxhash64("doc_id", "text")).orderBy("k", "text", "y").limit(7).collect()]
    slow = slow_model(used)
    for r in quality.score(docs.withColumn("doc_id", F.monotonically_increasing_id()), few).limit(20).collect():
        assert 0 <= r.score <= 1
    packed, bias = few
    weights = np.frombuffer(zlib.decompress(packed), np.float32)
    assert all(quality.raw_score(t, weights, bias) == pytest.approx(slow(t), abs=1e-5) for t in texts)


def test_shape_sees_the_whole_word():
    assert quality.shape("Thnd***") == "Aa*"
    for n in (30, 300, 30_000):  # beyond 24 signs and beyond 256 characters
        a, b = "a1" * n + "!", "a1" * n + "?"
        assert quality.shape(a) == "a0" * n + "!" and quality.shape(a) != quality.shape(b)
        assert quality.features(a)[1].tolist() != quality.features(b)[1].tolist()


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (4, 0), (4, 1), (None, 1), (7, 5)], "doc_id long, quality int")
    model = quality.fit(edge_docs, labels)
    rows = quality.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert len({r.score for r in rows if r.doc_id in (1, 2, 6)}) == 1
    assert quality.score(no_docs, model).count() == 0
    none = quality.fit(no_docs, labels)
    assert {r.score for r in quality.score(edge_docs, none).collect()} == {0.5}
    with pytest.raises(ValueError):
        quality.score(edge_docs, none, keep=True)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    cut = min([k for k in (tail.find(c) for c in "?#") if k >= 0], default=len(tail))
    return host, tail[:cut]


def test_url_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/de/#a", "http://x.com/en/", "http://com/fr/", "http://example.org", "http://example.org?x=/es/", "a://b://c/d", "http://ex\nample.org/es/\n2?q"]
    urls += [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = {r.page_id: r for r in url_filter.judge(pages, labels).collect()}
    for k, u in enumerate(urls):
        host, path = parts(u)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (rows[k].host, rows[k].path, rows[k].rule, rows[k].verdict) == (host, path, best[1], best[2]), u


def test_url_templates(spark):
    rows = [(k, f"http://a.net/shop/{k}.html") for k in range(60)] + [(100 + k, f"http://a.net/spam/{k % 3}x/{k}") for k in range(60)] + [(300 + k, f"http://b.net/u/name{'abcdefgh'[k % 8]}{k}z") for k in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, 1) for k in range(60)] + [(100 + k, 0) for k in range(60)], "doc_id long, quality int")
    got = {r.page_id: r for r in url_filter.judge(pages, labels).collect()}
    assert {got[k].template for k in range(60)} == {"/shop/{num}.html"} and {got[k].verdict for k in range(60)} == {"allow"}
    assert {got[100 + k].verdict for k in range(60)} == {"block"}
    assert {got[300 + k].template for k in range(50)} == {"/u/*"}
    # Purity by hand: (good + 10 * prior) / (labelled + 10), prior 60 / 120.
    assert got[0].purity == pytest.approx((60 + 5) / 70) and got[100].purity == pytest.approx(5 / (10 + sum(got[100 + k].template == got[100].template for k in range(60))))


def test_url_edges(spark):
    schema = "page_id long, url string, host string, verdict string"
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1)], "doc_id long, quality int")
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "http://h.net/a", "h", None), (2, "http://h.net/" + "a/" * 5000, None, None), (2, "http://h.net/a", None, None), (2, "http://h.net/a", None, None)], schema)
    assert len(url_filter.judge(pages, labels).collect()) == 5
    assert url_filter.judge(spark.createDataFrame([], schema), labels).count() == 0


def test_licenses(spark, edge_docs, no_docs):
    mit = licenses.KNOWN["MIT"]
    texts = ["Copyright (c) 2020 Somebody\n\n" + mit, mit.upper().replace(",", " ,").replace('"', "“"), "  \n(C) A. Person\n" + mit.replace(", ", ",\n\t "), mit + " More.", licenses.KNOWN["0BSD"], licenses.KNOWN["BSD-3-Clause"].replace("authorized", "authorised"), "Copyright 2020 Nobody"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.license_id for r in licenses.scan(df).collect()}
    assert got == {0: "MIT", 1: "MIT", 2: "MIT", 3: None, 4: "0BSD", 5: "BSD-3-Clause", 6: None}
    wrapped = ["MIT License\n\nCopyright (c) 2020 A\n\n" + mit.replace("The above copyright notice", "The above\ncopyright notice"), "The MIT License (MIT)\nCopyright © 2020 B\nAll rights reserved.\n" + mit.replace(" ", "\n"), "licence licence licence", "license license license", "MIT License"]
    forms = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(wrapped)), "doc_id long, text string")).collect()}
    assert forms[0].license_id == forms[1].license_id == "MIT" and forms[2].canonical_sha256 == forms[3].canonical_sha256 and forms[4].license_id is None
    rows = licenses.scan(edge_docs).collect()
    assert len(rows) == edge_docs.count() and not any(r.license_id for r in rows)
    assert licenses.scan(no_docs).count() == 0
    spelled = spark.createDataFrame([(1, "Use under this LICENCE, non-commercial!")], "doc_id long, text string")
    assert licenses.scan(spelled, {"X": "use under this license noncommercial", "Y": "Use under this License: noncommercial"}).first().license_id == "X"


def test_whole_licenses(spark):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / n).exists() for n in names.values()):
        pytest.skip("no licence texts at hand")
    rows = [(k, (folder / n).read_text().upper()) for k, n in enumerate(names.values())] + [(50, (folder / "GPL-3").read_text() + " More.")]
    got = {r.doc_id: r.license_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(enumerate(names)), 50: None}


def test_fingerprints(spark, edge_docs, no_docs):
    rows = merkle.fingerprint(edge_docs).collect()
    assert len(rows) == edge_docs.count() and merkle.fingerprint(no_docs).count() == 0
    by = {}
    for r, d in zip(sorted(rows, key=lambda r: (str(r.doc_id), r.n_chars)), sorted(edge_docs.collect(), key=lambda d: (str(d.doc_id), len(d.text or ""))), strict=True):
        by.setdefault(d.text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values()) and len({*map(tuple, by.values())}) == len(by)
    pair = spark.createDataFrame([("one. two.\nthree.\nfour.", "one. two.\nTHREE.\nfour.\nfive.")], "a string, b string")
    pair = merkle.add_fingerprint(merkle.add_fingerprint(pair, F.col("a"), "fa", "la"), F.col("b"), "fb", "lb")
    assert pair.select(merkle.differing_sections(F.col("fa"), F.col("fb")).alias("d")).first().d == [1, 3]


def test_next_and_edit_equal_brute_force(spark, rng, no_docs):
    rows = [(rng.choice([None, *range(40)]), "".join(rng.choice("ab. \nÜ😀") for _ in range(rng.randint(0, 40)))) for _ in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        want.append((i, t, nxt))
    for buckets in (1, 4, 30):
        assert sorted(map(tuple, merkle.with_next(df, buckets).select("doc_id", "text", "next_text").collect()), key=str) == sorted(want, key=str)
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in merkle.compare_with_edit(df).collect()), key=str)
    half = [(i, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest()) for i, t, n in want]
    assert got == sorted(half, key=str)
    one = spark.createDataFrame([(1, "only")], "doc_id long, text string")
    assert merkle.with_next(one).first().next_text == "only"
    assert merkle.compare_with_edit(no_docs.select("doc_id", "text")).count() == 0
