import collections
import hashlib
import tracemalloc
from pathlib import Path

import pytest

from attestra.llm import common, neardup, repeats, suffix

from .conftest import invented


def brute_starts(strings, n):
    count = collections.Counter(s[i : i + n] for s in strings for i in range(len(s) - n + 1))
    return [[i for i in range(len(s) - n + 1) if count[s[i : i + n]] > 1] for s in strings]


def test_suffix_sorting_equals_brute_force(rng, monkeypatch):
    for k in range(400):
        monkeypatch.setattr(suffix.BucketQueue.__init__, "__defaults__", (10 if k % 3 == 0 else 1 << 26,))  # 10: all queues on disk
        letters = rng.choice([b"a", b"ab", b"abc", b"abcdefgh"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, rng.choice([3, 20, 150])))) for _ in range(rng.randint(1, 8))]
        n = rng.choice([1, 2, 3, 8, 20])
        assert [x.tolist() for x in suffix.repeated_starts(strings, n)] == brute_starts(strings, n)
    with pytest.raises(ValueError):
        suffix.repeated_starts([b"a\xffb"], 1)


def test_suffix_sorting_holds_little_beside_the_text(rng):
    strings = [invented(rng, 60).encode() for _ in range(700)]
    size = sum(map(len, strings))
    tracemalloc.start()
    suffix.repeated_starts(strings, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 52 * size


def brute_removed(rows, n):
    data = [(i, (t or "").encode()) for i, t in rows]
    starts = brute_starts([b for _, b in data], n)
    out = []
    for (i, b), at in zip(data, starts, strict=True):
        gone = bytearray(len(b))
        for s in at:
            gone[s : s + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(df, **options):
    rows = repeats.remove_repeats(df, keep=False, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"many": 2, "shard_bytes": 500}])
def test_repeats_equal_brute_force(spark, rng, options):
    shared = [invented(rng, 40) for _ in range(3)]
    rows = [(k, invented(rng, rng.randint(0, 30)) + rng.choice(["", *shared]) + invented(rng, rng.randint(0, 30))) for k in range(60)]
    rows += [(100, "ab" * 300), (101, "x" * 450), (102, "x" * 210), (103, shared[0]), (104, shared[0]), (105, "é" * 150 + "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert removed(df, **options) == brute_removed(rows, 200)


def test_line_repeated_in_a_row_within_a_hot_route(spark, rng):
    """A line of many contexts gives a hot route; in a row, the splitting hash has its least gram across the lines' border."""
    size, gram = 60, repeats.GRAM

    def least(line, family):
        x = repeats._gram_hashes(repeats.np.frombuffer(line.encode() * 6, repeats.np.uint8), family)
        return int(x.argmin()) % size, int(x.min())

    lines = ["".join(rng.choice("abcdefgh ") for _ in range(size)) for _ in range(4000)]
    line = min((x for x in lines if least(x, 0)[0] <= size - gram < least(x, 1)[0]), key=lambda x: least(x, 0)[1])
    rows = [(k, invented(rng, 20) + line + invented(rng, 20)) for k in range(12)] + [(100, invented(rng, 20) + line * 6 + invented(rng, 20))]
    want = brute_removed(rows, 200)
    assert sum(r[2] for r in want) == 6 * size
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(df) == want and removed(df, many=2) == want


def test_repeats_write_only_tables_that_are_read_again(spark, rng, monkeypatch):
    """Each table that is written costs executors memory and files; those read once go straight on."""
    written, cut = [], repeats.common.cut
    monkeypatch.setattr(repeats.common, "cut", lambda df, tag: written.append(tag) or cut(df, tag))
    shared = invented(rng, 40)
    rows = [(k, invented(rng, 20) + shared * (k % 2)) for k in range(8)]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == brute_removed(rows, 200)
    assert written == ["repeats-texts", "repeats-runs", "repeats-hot", "repeats-fate"]


def test_repeats_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    assert removed(edge_docs) == brute_removed(rows, 200)
    assert repeats.remove_repeats(no_docs, keep=False).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(edge_docs)  # its spans and kept would clash
    with pytest.raises(ValueError):
        repeats.repeated_spans(no_docs, length=32)


def brute_components(rows, words, percent=80):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        ids = least.setdefault(find(k), [])
        if i is not None:
            ids.append(i)
    return sorted(((i, len(sets[k]), min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows)), key=str)


def found(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, **options).collect()), key=str)


def test_near_duplicates_equal_brute_force(spark, rng):
    base = [invented(rng, n).split() for n in (6, 12, 30, 80, 200)]
    rows = []
    for k in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 12))):
            w[rng.randrange(len(w))] = rng.choice(["New", "other", "Third"])
        rows.append((k * 7 % 151, rng.choice([" ", "\n"]).join(w)))
    rows.append((900, "The Same passage of Words"))
    rows.append((901, "the same  passage\tof words"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, words=2) == brute_components(rows, 2)


def test_copies_of_one_text_near_the_threshold_equal_brute_force(spark, rng):
    """Many copies at all distances from one text, some of them copies of distant copies: the hub does not link them all."""
    text = invented(rng, 90).split()
    copies = [list(text)]
    for _ in range(250):
        w = list(text if rng.random() < 0.6 else rng.choice(copies))
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] += rng.choice("xyz") + str(rng.randrange(40))
        copies.append(w)
    for percent in (60, 80, 90):
        rows = [(k, " ".join(w)) for k, w in enumerate(copies)]
        want = brute_components(rows, 2, percent)
        assert len({c for *_, c in want}) > 3
        assert found(spark.createDataFrame(rows, "doc_id long, text string"), words=2, percent=percent) == want


def test_registers_of_unlike_sets_share_a_band(rng):
    """Sets at exactly the threshold: how often no band of four registers is equal is near (1 - 0.8 ** 4) ** 32 for any size."""
    import numpy as np

    for n, m, both in ((4, 5, 4), (9, 9, 8), (45, 45, 40), (270, 270, 240), (2700, 2700, 2400)):
        bands = []
        for _ in range(300):
            x = np.array([rng.getrandbits(64) for _ in range(n + m - both)], np.uint64)
            a, b = (neardup.registers(np.sort(s)).view(np.int64) for s in (x[:n], x[-m:]))
            bands.append(int((a == b).sum()))
        assert min(bands) >= 1 and 10.5 < np.mean(bands) < 16 and np.var(bands) < 16


def faults_of_ended_children(pid):
    """Page faults of the processes that this one started and saw end."""
    return int(Path(f"/proc/{pid}/stat").read_text().rsplit(")", 1)[1].split()[8])


def test_near_duplicates_start_no_processes(spark, rng):
    """Hadoop starts a chmod for each file it makes; until that is another program, it counts as a second JVM."""
    df = spark.createDataFrame([(k, invented(rng, 5 + k % 3)) for k in range(60)] + [(60, "one two three"), (61, "one two three")], "doc_id long, text string")
    jvm = spark._jvm.java.lang.ProcessHandle.current().pid()
    common.shared_dir(spark)
    df.count()
    before = faults_of_ended_children(jvm)
    assert neardup.near_duplicates(df, words=2).count() == 62
    assert faults_of_ended_children(jvm) == before


def test_saved_frames_equal_what_was_saved(spark, tmp_path, monkeypatch):
    rows = [(1, b"a", "x", True, [1, None]), (None, None, None, None, None), (2, b"", "", False, [])]
    df = spark.createDataFrame(rows, "i long, b binary, s string, t boolean, l array<long>").repartition(5)
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(common, "_GROUP", 1)
    key = lambda r: str(r)
    doubled = common.mapped(df, lambda batches: (b for x in batches for b in (x, x)), df.schema)
    for frame, times in ((df, 1), (doubled, 2), (df.where("i > 9"), 0)):
        out = common.saved(frame, "t")
        (folder,) = tmp_path.iterdir()
        (folder / "_part-of-a-failed-task.parquet").write_bytes(b"not whole")
        assert out.schema == df.schema
        assert sorted(map(key, out.collect())) == sorted(map(key, df.collect() * times))
        common.drop(out)
        assert not list(tmp_path.iterdir())


def test_frames_are_saved_in_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.only.link./x", f"file://{tmp_path}")
    monkeypatch.setattr(common, "shared_dir", lambda spark: "viewfs://only/x")
    df = spark.range(7).toDF("i")
    twice = common.mapped(df, lambda batches: (b for x in batches for b in (x, x)), "i long")
    for frame, want in ((df, list(range(7))), (twice, sorted([*range(7)] * 2))):
        assert sorted(r.i for r in common.saved(frame, "t").collect()) == want


def test_near_duplicate_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.select("doc_id", "text").collect()]
    for words in (2, 5):
        assert found(edge_docs, words=words) == brute_components(rows, words)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_estimates_follow_similarity(rng):
    import numpy as np

    for share in (0.2, 0.5, 0.8, 0.95):
        both = np.unique(np.array([rng.getrandbits(64) for _ in range(4000)], np.uint64))
        n = int(len(both) * (1 + share) / 2)
        order = np.array(rng.sample(range(len(both)), len(both)))
        a, b = np.sort(both[order[:n]]), np.sort(both[order[-n:]])
        true = len(np.intersect1d(a, b)) / len(both)
        same = (neardup.registers(a) == neardup.registers(b)).sum()
        assert abs(neardup.estimate(np.array([same]), np.array([n]), np.array([n]))[0] - true) < 0.17
