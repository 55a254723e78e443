"""Near-duplicate detection with HyperMinHash registers.

One 64-bit hash of each word shingle deals a text's set into 128 buckets; a bucket's register holds the leading-zero count
and ten more bits of its least hash. An empty bucket takes the register of the first filled one in an order of its own, so
small sets have all registers too. Bands of four whole registers are the candidate keys. A set that several texts share is
one node, and sets too small to be similar to any other have no keys.

Candidates are never all pairs of a group. The member of a band's group that collides most often is its hub; each node is
paired with its hubs only, and what these links join is one component. Only pairs of different components are open then.
They are found by how nodes differ from a hub they share: two sets can be similar enough only if both are linked with the
hub, which is known, or if enough of what sets them apart from it is the same in both. So nodes are joined by the rarest of
these differences, as many as that bound asks for, and what a whole group has in common makes no pairs. Pairs must pass a
Jaccard estimate, corrected for chance collisions of compressed registers and five standard deviations below the threshold,
and are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LANES, ROWS, MANTISSA = 128, 4, 10
BANDS = LANES // ROWS
#: Bits of a hash that name its bucket, and the hash at which each bucket begins.
_INDEX = np.uint64(LANES.bit_length() - 1)
_STARTS = np.arange(LANES, dtype=np.uint64) << (np.uint64(64) - _INDEX)


def _donors() -> np.ndarray:
    """For each bucket all buckets in the order in which it takes a register from them, itself first."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    orders = np.stack([rng.permutation(LANES) for _ in range(LANES)])
    return np.concatenate([np.arange(LANES)[:, None], orders[orders != np.arange(LANES)[:, None]].reshape(LANES, -1)], axis=1)


_DONORS = _donors()
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased, words between ASCII white space)."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(words, len(h))
    x = np.full(len(h) - size + 1, np.uint64(size if len(h) < words else 0))
    for k in range(size):
        x = (x ^ h[k : len(h) - size + 1 + k]) * _P
        x ^= x >> np.uint64(32)
    return np.unique(x * _Q)


def registers(hashes: np.ndarray) -> np.ndarray:
    """128 registers of 16 bits from sorted hashes: leading zeros of a bucket's least hash, then the ten bits after its first one."""
    first = np.searchsorted(hashes, _STARTS)
    filled = np.append(first[1:], len(hashes)) > first
    least = hashes[np.minimum(first, len(hashes) - 1)] << _INDEX
    zeros = (53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    own = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return own[_DONORS[np.arange(LANES), filled[_DONORS].argmax(axis=1)]]


def estimate(matches: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard estimate from equal registers, less the matches that unlike sets of these sizes have by chance."""
    ratio = n / np.maximum(m, 1)
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((matches / LANES - chance) / (1 - chance), 0, 1)


def sketch(docs: DataFrame, words: int, least: int) -> DataFrame:
    """doc_id, n, node (digest of the shingle set; null if it is empty), keys (each band's registers as one long; null below `least` shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, keys = [], [], []
            for x in batch.column(1):
                h = shingle_hashes(x.as_py(), words)
                n.append(len(h))
                node.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                keys.append(registers(h).view(np.int64) if len(h) >= max(1, least) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "node", "keys"])

    return common.mapped(docs, run, "doc_id long, n long, node binary, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, hashes array<long> of wanted (doc_id, node) rows, from the texts."""
    joined = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.w_id)).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = shingle_hashes(x.as_py(), words)
                if hashlib.blake2b(h.tobytes(), digest_size=16).digest() == node:  # an id may have several texts
                    nodes.append(node)
                    sets.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    return common.mapped(joined, run, "node binary, hashes array<long>")


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Of distinct pairs (a, b), those whose estimate is near the threshold or above and whose sizes allow it."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("keys").alias("ka"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("keys").alias("kb"))
    least = threshold - 5 * math.sqrt(threshold * (1 - threshold) / LANES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            regs = [np.asarray(batch.column(c).flatten()).view(np.uint16).reshape(batch.num_rows, LANES) for c in (4, 5)]
            est = estimate((regs[0] == regs[1]).sum(axis=1), np.asarray(batch.column(2)), np.asarray(batch.column(3)))
            kept = pa.array(est >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    sized = pairs.join(a, "a").join(b, "b").where((F.col("na") >= threshold * F.col("nb") - 1e-6) & (F.col("nb") >= threshold * F.col("na") - 1e-6))
    return common.mapped(sized.select("a", "b", "na", "nb", "ka", "kb"), run, "a binary, b binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those with 100 * |A and B| >= percent * |A or B| on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, known, ranks = [], None, None
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != known:
                    known, ranks = a, np.asarray(x.values).view(np.uint64)
                other = np.asarray(y.values).view(np.uint64)
                at = np.searchsorted(ranks, other)
                shared = int(np.count_nonzero(ranks[np.minimum(at, len(ranks) - 1)] == other))
                kept.append(100 * shared >= percent * (len(ranks) + len(other) - shared))
            kept = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    return common.mapped(pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb"), run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node, label (least node reachable) of all nodes that links (a, b) name; links are read from files.

    Each round takes the least label of all neighbours, then that label's own label, so paths are halved.
    """
    both = common.saved(links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.*"), "neardup-edges")
    labels = common.saved(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "neardup-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        lower = labels.join(near.withColumnRenamed("u", "node"), "node", "left").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = common.saved(lower.join(up, "label", "left").select("node", F.least("label", "up").alias("label"), "was"), "neardup-labels")
        done = new.where("label <> was").isEmpty()
        common.drop(labels)
        labels = new.drop("was")
        if done:
            common.drop(both)
            return labels


def _verified(candidates: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    likely = common.saved(_likely(candidates, nodes, percent / 100), "neardup-pairs")
    named = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = common.saved(_sets(docs, nodes.join(named, "node").select(F.col("doc_id").alias("w_id"), "node"), words).dropDuplicates(["node"]), "neardup-sets")
    links = common.saved(_confirmed(likely, sets, percent), "neardup-links")
    common.drop(likely)
    common.drop(sets)
    return links


def _differences(open_: DataFrame, nodes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """hub, node, label, n, hub_n, d (size), diff: the hashes that only one of node and hub has; hubs are left out themselves."""
    named = open_.select(F.explode(F.array("node", "hub")).alias("node")).distinct()
    sets = common.saved(_sets(docs, nodes.join(named, "node").select(F.col("doc_id").alias("w_id"), "node"), words).dropDuplicates(["node"]), "neardup-sets")
    hubs = sets.select(F.col("node").alias("hub"), F.col("hashes").alias("hub_hashes"))
    joined = open_.join(sets, "node").join(hubs, "hub").select("hub", "node", "label", "hashes", "hub_hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(np.asarray(x.values), np.asarray(y.values)) for x, y in zip(batch.column(3), batch.column(4), strict=True)]
            diff = [np.setxor1d(x, y, assume_unique=True) for x, y in pairs]
            counts = [pa.array(c, pa.int64()) for c in ([len(x) for x, _ in pairs], [len(y) for _, y in pairs], [len(x) for x in diff])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *counts, pa.array(diff, pa.list_(pa.int64()))], ["hub", "node", "label", "n", "hub_n", "d", "diff"])

    out = common.saved(common.mapped(joined, run, "hub binary, node binary, label binary, n long, hub_n long, d long, diff array<long>"), "neardup-differences")
    common.drop(sets)
    return out


def _by_differences(open_: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of open nodes (hub, node, label) of one hub and different labels whose differences from it may overlap enough.

    Sets of n and m with differences of x and y from a hub, o of them the same, differ in x + y - 2o places, so they are
    similar enough if and only if 2 * o * plus >= (x + y) * plus - minus * (n + m). One of the two is not linked with the
    hub, or their labels were equal, so x * plus > minus * (n + hub_n) for it, and o is 1 at least.
    """
    plus, minus = 100 + percent, 100 - percent
    found = _differences(open_, nodes, docs, words)
    each = found.select("hub", "node", "label", F.explode("diff").alias("s"))
    often = each.groupBy("hub", "s").agg(F.count("*").alias("f"), (F.min("label") != F.max("label")).alias("mixed")).where("f > 1")
    # A difference of one node only matches nothing, but still uses up a place among the rarest.
    placed = each.join(often, ["hub", "s"], "left").groupBy("hub", "node").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "s", F.coalesce("mixed", F.lit(False)).alias("mixed")))).alias("k"))
    linked = F.col("d") * plus <= minus * (F.col("n") + F.col("hub_n"))
    shared = F.when(linked, F.col("d") * plus + minus * (F.col("hub_n") - F.col("n")) + 1).otherwise(2 * percent + F.col("d") * plus - minus * (F.col("hub_n") + F.col("n")))
    length = F.col("d") - F.greatest(F.lit(1), F.ceil(shared / (2 * plus) - 1e-9)) + 1
    rare = F.transform(F.slice("k", F.lit(1), F.greatest(length, F.lit(0)).cast("int")), lambda k, i: F.struct(k["s"].alias("s"), (i + 1).alias("at"), k["mixed"].alias("mixed")))
    prefix = placed.join(found.drop("diff"), ["hub", "node"]).select("hub", "node", "label", "n", "d", F.explode(F.filter(rare, lambda k: k["mixed"])).alias("k"))
    prefix = common.saved(prefix.select("hub", "node", "label", "n", "d", "k.s", "k.at"), "neardup-prefix")
    a, b = prefix.alias("a"), prefix.alias("b")
    close = (F.col("a.n") * percent <= F.col("b.n") * 100) & (F.col("b.n") * percent <= F.col("a.n") * 100)
    # At the first difference that both have, this one and the shorter rest are all that can be the same.
    enough = 2 * plus * (F.least(F.col("a.d") - F.col("a.at"), F.col("b.d") - F.col("b.at")) + 1) >= (F.col("a.d") + F.col("b.d")) * plus - minus * (F.col("a.n") + F.col("b.n"))
    pairs = a.join(b, (F.col("a.hub") == F.col("b.hub")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label")) & close & enough)
    out = common.saved(pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct(), "neardup-rare")
    common.drop(found)
    common.drop(prefix)
    return out


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable over links of at least `percent` % Jaccard), kept.

    A text with fewer words than a shingle has one shingle, all its words; null texts and texts without words have none and
    are linked with nothing. Rows with equal sets are linked. Repeated rows are rows of one component, all kept if theirs is
    the least id. A null id is never a component's id unless there is no other; such rows are kept only then. An empty table
    gives no rows, other columns are ignored, very long texts are taken whole. The result is a table in the shared folder.
    """
    common.ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Unlike sets are n and n + 1 at best, which fewer shingles than these cannot make similar enough.
    least = percent / (100 - percent) if percent < 100 else math.inf
    rows = common.saved(sketch(docs, words, least if least == math.inf else math.ceil(least - 1e-9)), "neardup-rows")
    nodes = common.saved(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "neardup-nodes")
    placed = nodes.select("node", F.posexplode("keys").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("bucket"))
    sizes = common.saved(placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "neardup-sizes")
    members = common.saved(placed.join(sizes, "bucket"), "neardup-members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = common.saved(members.join(weight, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node"))["node"].alias("hub")), "neardup-hubs")
    grouped = common.saved(members.join(hubs, "bucket").where("node <> hub"), "neardup-groups")
    pairs = grouped.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    links = _verified(pairs, nodes, docs, words, percent)
    labels = components(links)
    label = F.coalesce("label", "node")
    marked = grouped.where("size > 2").join(labels, "node", "left").select("bucket", "hub", "node", label.alias("label"))
    mixed = marked.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("bucket")
    open_ = common.saved(marked.join(mixed, "bucket", "left_semi").select("hub", "node", "label").distinct(), "neardup-open")
    used = [sizes, members, hubs, grouped, links, open_]
    if not open_.isEmpty():
        candidates = _by_differences(open_, nodes, docs, words, percent)
        more = _verified(candidates, nodes, docs, words, percent)
        used += [candidates, more]
        if not more.isEmpty():
            used.append(labels)
            labels = components(links.union(more))

    classes = nodes.select("node", F.col("doc_id").alias("least_id")).join(labels, "node", "left").withColumn("label", label)
    ids = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = classes.select("node", "label").join(ids, "label").select("node", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = common.saved(out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")), "neardup-result")
    for frame in (rows, nodes, labels, *used):
        common.drop(frame)
    return result


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), words=2)
