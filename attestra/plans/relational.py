"""Coverage, totals, valuations, projection, reconciliation, search and decisions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.operators import analytics as an
from attestra.operators import decisions, projection, reconcile, scoring, search, validation

from .base import Tables, query

#: Money as whole cents, so that sums do not depend on their order.
cents = lambda c: F.round(F.col(c) * 100).cast("long")


@query("""
WITH ok AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal >= 0),
l AS (SELECT c_nationkey AS n_nationkey, o_orderstatus AS s FROM orders JOIN ok ON o_custkey = c_custkey),
g AS (SELECT s_nationkey AS n_nationkey, count(*) AS g FROM supplier WHERE s_acctbal < 0 GROUP BY 1),
r AS (SELECT n_nationkey, count(*) FILTER (s = 'F') AS f, count(*) FILTER (s = 'O') AS o, count(*) FILTER (s = 'P') AS p FROM l GROUP BY 1)
SELECT n.n_nationkey, n_name, coalesce(f, 0) AS principal, coalesce(o, 0) AS partial, coalesce(p, 0) AS support, coalesce(g, 0) AS open_gaps
FROM nation n LEFT JOIN r USING (n_nationkey) LEFT JOIN g USING (n_nationkey)""")
def coverage_by_node(t: Tables) -> DataFrame:
    owners = t["customer"].where("c_acctbal >= 0").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    labels = t["orders"].join(owners, F.col("o_custkey") == F.col("c_custkey"))
    gaps = t["supplier"].where("s_acctbal < 0").select(F.col("s_nationkey").alias("n_nationkey"))
    return an.role_coverage(t["nation"].select("n_nationkey", "n_name"), labels, gaps, ["n_nationkey"], "o_orderstatus", {"F": "principal", "O": "partial", "P": "support"}, "open_gaps")


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS validated, count(*) FILTER (o_orderstatus = 'O') AS proposed,
count(*) FILTER (o_orderstatus = 'P') AS discarded, count(*) FILTER (o_totalprice > 250000) AS manual FROM orders GROUP BY 1""")
def validation_state_counts(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return an.state_counts(t["orders"], ["o_orderpriority"], {"validated": s == "F", "proposed": s == "O", "discarded": s == "P", "manual": F.col("o_totalprice") > 250000})


@query("SELECT p_type AS category, CAST(sum(p_size) AS BIGINT) AS credits, count(*) AS courses FROM part GROUP BY 1")
def credits_by_category(t: Tables) -> DataFrame:
    return an.totals_by(t["part"].withColumnRenamed("p_type", "category"), ["category"], "p_size", "credits", "courses")


BOUNDS = [("basic", 18, 36, 1), ("large", 6, 18, 2), ("promo", 42, 60, 3), ("none", 0, 18, 4)]


@query("""
WITH b(area, low, high, place) AS (VALUES ('basic', 18, 36, 1), ('large', 6, 18, 2), ('promo', 42, 60, 3), ('none', 0, 18, 4)),
f AS (SELECT CASE p_type WHEN 'SMALL' THEN 'basic' WHEN 'STANDARD' THEN 'basic' WHEN 'ECONOMY' THEN 'basic' WHEN 'PROMO' THEN 'promo' ELSE 'large' END AS area, p_size FROM part)
SELECT b.area, low, high, place, CAST(coalesce(sum(p_size), 0) AS BIGINT) AS credits, count(p_size) AS courses,
  CAST(round(CAST(coalesce(sum(p_size), 0) AS BIGINT) * 1.6::DOUBLE) AS BIGINT) AS ects, coalesce(sum(p_size), 0) BETWEEN low * 500 AND high * 500 AS within
FROM b LEFT JOIN f ON f.area = b.area GROUP BY 1, 2, 3, 4""")
def credits_vs_bounds(t: Tables) -> DataFrame:
    bounds = t.spark.createDataFrame(BOUNDS, "area string, low int, high int, place int")
    area = F.when(F.col("p_type").isin("SMALL", "STANDARD", "ECONOMY"), "basic").when(F.col("p_type") == "PROMO", "promo").otherwise("large")
    out = an.totals_vs_bounds(bounds, t["part"].withColumn("area", area), "area", "p_size", "credits", "courses")
    return out.withColumn("ects", F.round(F.col("credits") * F.lit(1.6).cast("double")).cast("long")).withColumn("within", F.col("credits").between(F.col("low") * 500, F.col("high") * 500))


@query("""
WITH l AS (SELECT l_partkey, l_suppkey, l_orderkey * 8 + l_linenumber AS id, l_discount, l_orderkey FROM lineitem)
SELECT a.l_partkey, a.l_suppkey, a.id AS id_a, b.id AS id_b, a.l_discount AS discount_a, b.l_discount AS discount_b, a.l_orderkey AS order_a, b.l_orderkey AS order_b
FROM l a JOIN l b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.id < b.id AND abs(a.l_discount - b.l_discount) > 0.05""")
def contradictory_measurements(t: Tables) -> DataFrame:
    rows = t["lineitem"].select("l_partkey", "l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_discount").alias("discount"), F.col("l_orderkey").alias("order"))
    return an.contradictions(rows, ["l_partkey", "l_suppkey"], "id", "discount", 0.05, ["order"])


@query("""
WITH s AS (SELECT l_orderkey, count(*) AS n, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(coalesce(n, 0) AS BIGINT) AS activities, CASE WHEN l_orderkey IS NULL THEN 'missing' WHEN c <> CAST(round(o_totalprice * 100) AS BIGINT) THEN 'different' ELSE 'ok' END AS status
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey""")
def plan_vs_actual_status(t: Tables) -> DataFrame:
    sums = t["lineitem"].groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(cents("l_extendedprice")).alias("c"))
    out = t["orders"].join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return out.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("activities"), an.plan_status(cents("o_totalprice"), F.col("c"), F.col("l_orderkey").isNotNull(), "missing", "different", "ok").alias("status"))


@query("""SELECT event_id, k AS key, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)
UNION ALL SELECT vec_id, 'e' || CAST(i - 1 AS VARCHAR), CAST(round(CAST(embedding[i] AS DOUBLE) * 1000) AS BIGINT)::VARCHAR FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def unnest_list(t: Tables) -> DataFrame:
    entries = t["events"].select("event_id", F.map_entries(F.from_json("props", "map<string,string>")).alias("e"))
    props = an.unnest(entries, "e", "x", ["event_id"]).select("event_id", "x.key", "x.value")
    places = t["embeddings"].select("vec_id", F.transform("embedding", lambda v, i: F.struct(i.alias("i"), v.alias("v"))).alias("e"))
    vec = an.unnest(places, "e", "x", ["vec_id"]).select("vec_id", F.concat(F.lit("e"), "x.i"), F.round(F.col("x.v").cast("double") * 1000).cast("long").cast("string"))
    return props.union(vec)


_SCORES = """
sc AS (SELECT c_nationkey AS k, floor(CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*) / 10000) / 10 + 0.5 AS score FROM customer GROUP BY 1),
sp AS (SELECT s_nationkey AS k, floor(CAST(sum(CAST(round(s_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*) / 10000) / 10 + 0.5 AS score FROM supplier GROUP BY 1)"""


def _scores(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("k")).agg((F.floor(F.sum(cents(value)).cast("double") / F.count("*") / 10000) / 10 + 0.5).alias("score"))


@query(f"""
WITH {_SCORES}, gap AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal < -300 THEN 'high' ELSE 'medium' END AS sev FROM supplier WHERE s_acctbal < 1000),
edge AS (SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey),
sig AS (SELECT a, count(DISTINCT s_suppkey) FILTER (sev = 'high') AS hi, count(DISTINCT s_suppkey) FILTER (sev = 'medium') AS me FROM edge JOIN gap ON b = s_nationkey GROUP BY 1),
ev AS (SELECT c_nationkey AS k, count(DISTINCT c_mktsegment) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY 1),
x AS (SELECT n_nationkey, n_name, score, coalesce(n, 0) AS evidence, coalesce(hi, 0) AS high_signals, coalesce(me, 0) AS medium_signals FROM nation LEFT JOIN sc ON sc.k = n_nationkey LEFT JOIN ev ON ev.k = n_nationkey LEFT JOIN sig ON a = n_nationkey)
SELECT *, CASE WHEN score >= 4.5 THEN 'Se cumple plenamente' WHEN score >= 3.7 THEN 'Se cumple en alto grado' WHEN score IS NULL THEN 'sin valoración' ELSE 'por debajo de 3,7' END AS grade,
CASE WHEN score >= 4.5 AND high_signals >= 2 THEN 'alto' WHEN score >= 4.0 AND high_signals >= 1 THEN 'medio' ELSE 'bajo' END AS risk FROM x""")
def valuation_risk(t: Tables) -> DataFrame:
    a, b = t["nation"].alias("a"), t["nation"].alias("b")
    edges = a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") != F.col("b.n_nationkey"))).select(F.col("a.n_nationkey").alias("src"), F.col("b.n_nationkey").alias("dst"))
    gaps = t["supplier"].where("s_acctbal < 1000")
    severity = F.when(F.col("s_acctbal") < -300, "high").otherwise("medium")
    sig = an.signals(edges, gaps, ["src"], ["dst"], ["s_nationkey"], "s_suppkey", severity, {"high": "high_signals", "medium": "medium_signals"})
    ev = t["customer"].where("c_acctbal >= 0").groupBy(F.col("c_nationkey").alias("e")).agg(F.count_distinct("c_mktsegment").alias("evidence"))
    n = F.col("n_nationkey")
    x = t["nation"].join(_scores(t["customer"], "c_nationkey", "c_acctbal"), n == F.col("k"), "left").join(ev, n == F.col("e"), "left").join(sig, n == F.col("src"), "left").fillna(0, ["evidence", "high_signals", "medium_signals"])
    return x.select("n_nationkey", "n_name", "score", "evidence", "high_signals", "medium_signals", an.band(F.col("score")).alias("grade"), an.over_rating_risk(F.col("score"), F.col("high_signals")).alias("risk"))


@query(f"""
WITH {_SCORES}, node AS (SELECT 'R' || r_regionkey AS k, NULL AS p FROM region UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation),
m AS (SELECT k AS top, k AS mem FROM node WHERE p IS NULL UNION ALL SELECT p, k FROM node WHERE p IS NOT NULL),
v AS (SELECT top, mem, score FROM m LEFT JOIN sc ON mem = 'N' || sc.k)
SELECT top, round(CAST(sum(CAST(round(score * 10) AS BIGINT)) AS DOUBLE) / count(score) / 10, 2) AS mean_score, min(score) AS least_score, count(*) AS members,
string_agg(mem || '=' || coalesce(CAST(CAST(round(score * 10) AS BIGINT) AS VARCHAR), 's.d.'), ' ' ORDER BY mem) AS listed FROM v GROUP BY top""")
def rollup_self_and_children(t: Tables) -> DataFrame:
    nodes = t["region"].select(F.concat(F.lit("R"), "r_regionkey").alias("top"), F.lit(None).cast("string").alias("p")).union(t["nation"].select(F.concat(F.lit("N"), "n_nationkey"), F.concat(F.lit("R"), "n_regionkey")))
    scores = _scores(t["customer"], "c_nationkey", "c_acctbal").select(F.concat(F.lit("N"), "k").alias("m_top"), "score")
    v = an.self_and_children(nodes, ["top"], ["p"]).join(scores, "m_top", "left").withColumn("tenths", F.round(F.col("score") * 10).cast("long"))
    shown = F.concat("m_top", F.lit("="), F.coalesce(F.col("tenths").cast("string"), F.lit("s.d.")))
    return v.groupBy("top").agg(F.round(F.sum("tenths").cast("double") / F.count("score") / 10, 2).alias("mean_score"), F.min("score").alias("least_score"), F.count("*").alias("members"), an.ordered_list(shown, ["m_top"], " ").alias("listed"))


_PROJECTED = """
e AS (SELECT a.n_nationkey AS src, b.n_nationkey AS dst, CASE WHEN a.n_nationkey = b.n_nationkey THEN 0 WHEN abs(a.n_nationkey - b.n_nationkey) <= 5 THEN 1 ELSE 2 END AS we FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey),
l AS (SELECT c_custkey, c_nationkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS wl FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'),
pr AS (SELECT c_custkey, dst, min(greatest(wl, we)) AS weak FROM l JOIN e ON c_nationkey = src GROUP BY 1, 2)"""


def _projected(t: Tables) -> DataFrame:
    a, b = t["nation"].alias("a"), t["nation"].alias("b")
    apart = F.abs(F.col("a.n_nationkey") - F.col("b.n_nationkey"))
    edges = a.join(b, F.col("a.n_regionkey") == F.col("b.n_regionkey")).select(F.col("a.n_nationkey").alias("src"), F.col("b.n_nationkey").alias("dst"), F.when(apart == 0, 0).when(apart <= 5, 1).otherwise(2).alias("we"))
    weak = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    # Labels of one pair are reduced to the strongest before they meet the edges.
    labels = t["orders"].where("o_orderpriority <> '5-LOW'").join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_nationkey", weak.alias("weak"))
    labels = projection.strongest(labels, ["c_custkey", "c_nationkey"])
    found = projection.paths(labels, edges, ["c_custkey"], ["c_nationkey"], ["src"], ["dst"], F.col("weak"), F.col("we"))
    return projection.strongest(found, ["c_custkey", "dst"])


@query(f"WITH {_PROJECTED} SELECT c_custkey, dst AS target, CASE weak WHEN 0 THEN 'principal' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS role FROM pr")
def strongest_projection(t: Tables) -> DataFrame:
    from attestra.functions.roles import role_of

    return _projected(t).select("c_custkey", F.col("dst").alias("target"), role_of(F.col("weak")).alias("role"))


@query(f"""
WITH {_PROJECTED}, d AS (SELECT c_custkey, dst AS target, CASE weak WHEN 0 THEN 'principal' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS role FROM pr),
x AS (SELECT c_custkey, c_nationkey AS target, CASE WHEN c_acctbal > 5000 THEN 'principal' ELSE 'apoyo' END AS role_now, c_mktsegment <> 'BUILDING' AS man, c_acctbal < 0 AS dec FROM customer)
SELECT coalesce(d.c_custkey, x.c_custkey) AS c_custkey, coalesce(d.target, x.target) AS target, role, role_now,
CASE WHEN role IS NOT NULL AND role_now IS NULL THEN 'insert' WHEN role IS NOT NULL AND NOT man THEN 'blocked' WHEN man AND dec THEN 'decided' WHEN role = role_now THEN 'keep' WHEN role IS NOT NULL THEN 'update' ELSE 'delete' END AS action
FROM d FULL JOIN x ON d.c_custkey = x.c_custkey AND d.target = x.target WHERE role IS NOT NULL OR man""")
def projection_sync_actions(t: Tables) -> DataFrame:
    existing = t["customer"].select("c_custkey", F.col("c_nationkey").alias("target"), F.when(F.col("c_acctbal") > 5000, "principal").otherwise("apoyo").alias("role"), "c_mktsegment", "c_acctbal")
    return projection.sync_actions(strongest_projection(t), existing, ["c_custkey", "target"], "role", F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") < 0)


@query("""
WITH n AS (SELECT l_orderkey AS k, max(l_linestatus) AS s, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) > 10000000 AS big FROM lineitem GROUP BY 1),
c AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice > 100000 AS big, o_orderpriority = '1-URGENT' AS pro, o_orderstatus = 'P' AS rev FROM orders)
SELECT coalesce(c.k, n.k) AS k, c.s AS old_status, n.s AS new_status, CASE WHEN c.k IS NULL THEN 'insert' WHEN n.k IS NULL THEN CASE WHEN pro THEN 'protected' ELSE 'obsolete' END
 WHEN c.s = n.s AND c.big = n.big AND NOT rev THEN 'keep' WHEN pro THEN 'protected' ELSE 'update' END AS action FROM c FULL JOIN n ON c.k = n.k""")
def reconcile_snapshot(t: Tables) -> DataFrame:
    current = t["orders"].select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), (F.col("o_totalprice") > 100000).alias("big"), "o_orderpriority")
    desired = t["lineitem"].groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("s"), (F.sum(cents("l_extendedprice")) > 10000000).alias("big"))
    out = reconcile.reconcile(current, desired, ["k"], ["s", "big"], F.col("o_orderpriority") == "1-URGENT", F.col("s") == "P")
    return out.select("k", F.col("old.s").alias("old_status"), F.col("new.s").alias("new_status"), "action")


@query("""
WITH m AS (SELECT o_custkey, min(CAST(round(o_totalprice * 100) AS BIGINT)) AS least FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END, least) AS cents FROM customer LEFT JOIN m ON c_custkey = o_custkey""")
def backfill_min(t: Tables) -> DataFrame:
    known = t["customer"].select("c_custkey", F.when(F.col("c_acctbal") >= 0, cents("c_acctbal")).alias("cents"))
    return reconcile.backfill_min(known, "c_custkey", "cents", t["orders"].withColumn("cents", cents("o_totalprice")), "o_custkey", "cents").select("c_custkey", "cents")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
SELECT user_id, event_id, event_type, CASE event_type WHEN 'purchase' THEN 'validada' WHEN 'error' THEN 'descartada' WHEN 'signup' THEN CASE WHEN value > 5 THEN 'validada' ELSE 'propuesta' END END AS state FROM r WHERE n = 1""")
def decision_log_fold(t: Tables) -> DataFrame:
    last = decisions.fold(t["events"], ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])
    action = F.when(F.col("event_type") == "purchase", "validar").when(F.col("event_type") == "error", "descartar").when(F.col("event_type") == "signup", "reabrir")
    return last.select("user_id", "event_id", "event_type", decisions.new_state(action, F.when(F.col("value") > 5, "extraccion").otherwise("manual")).alias("state"))


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def audit_top_k(t: Tables) -> DataFrame:
    return decisions.audit(t["events"].withColumns({"fecha": F.col("ts"), "referencia": F.col("event_id")})).select("event_id", "user_id", "event_type")


@query("""
WITH w AS (SELECT source, lang, CASE WHEN n_chars >= 4000 THEN 3 WHEN n_chars >= 1000 THEN 2 ELSE 1 END AS pts, n_chars FROM documents),
s AS (SELECT source, lang, CAST(sum(pts) AS BIGINT) AS score, bool_or(n_chars >= 4000) AS backed, min(n_chars) AS low FROM w GROUP BY 1, 2)
SELECT source, lang, score, CASE WHEN low <= 150 THEN 'I' WHEN low <= 600 OR NOT backed THEN 'R' ELSE 'E' END AS level FROM s WHERE score >= 4""")
def scored_levels(t: Tables) -> DataFrame:
    n = F.col("n_chars")
    s = t["documents"].groupBy("source", "lang").agg(F.sum(F.when(n >= 4000, 3).when(n >= 1000, 2).otherwise(1)).alias("score"), F.bool_or(n >= 4000).alias("backed"), F.min("n_chars").alias("low"))
    band = scoring.level(F.when(F.col("low") <= 150, 1).when(F.col("low") <= 600, 5).otherwise(9), F.col("backed"))
    return s.where(F.col("score") >= scoring.THRESHOLD).select("source", "lang", "score", band.alias("level"))


@query("""
WITH d AS (SELECT doc_id, quality, 'seed' AS origin FROM labels WHERE quality = 0 OR toxic = 1), p AS (SELECT doc_id, 1 AS quality, 'proposed' AS origin FROM documents)
SELECT * FROM d UNION ALL SELECT * FROM p WHERE doc_id NOT IN (SELECT doc_id FROM d)""")
def merge_decided_rows(t: Tables) -> DataFrame:
    proposed = t["documents"].select("doc_id", F.lit(1).cast(t["labels"].schema["quality"].dataType).alias("quality"), F.lit("proposed").alias("origin"))
    seed = t["labels"].withColumn("origin", F.lit("seed"))
    return scoring.merge_decided(proposed, seed, ["doc_id"], (F.col("quality") == 0) | (F.col("toxic") == 1)).select("doc_id", "quality", "origin")


@query("""SELECT doc_id, source, substring(replace(text, chr(10), ' '), 1, 220) AS snippet FROM documents WHERE lang = 'en' AND (text ILIKE '%thing%' OR source ILIKE '%thing%') ORDER BY source, doc_id LIMIT 50 OFFSET 50""")
def optional_filter_search(t: Tables) -> DataFrame:
    from attestra.functions.text import snippet

    found = search.matches(t["documents"], {"lang": "en", "source": ""}, "thing", ["text", "source"])
    return search.page(found.select("doc_id", "source", snippet(F.col("text")).alias("snippet")), ["source", "doc_id"], 2)


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def without_label(t: Tables) -> DataFrame:
    return search.without(t["documents"].select("doc_id", "lang"), t["labels"], ["doc_id"])


@query("""SELECT c_custkey, c_name FROM customer c WHERE c_acctbal > 9900 OR EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 495000)
OR EXISTS (SELECT 1 FROM orders o JOIN lineitem ON l_orderkey = o_orderkey WHERE o.o_custkey = c.c_custkey AND l_quantity >= 50 AND l_discount >= 0.1)""")
def exists_or_search(t: Tables) -> DataFrame:
    o = t["orders"].withColumnRenamed("o_custkey", "c_custkey")
    lines = o.join(t["lineitem"].where("l_quantity >= 50 AND l_discount >= 0.1"), F.col("o_orderkey") == F.col("l_orderkey"))
    return search.exists_in_any(t["customer"].select("c_custkey", "c_name", "c_acctbal"), ["c_custkey"], [F.col("c_acctbal") > 9900], [(o, F.col("o_totalprice") > 495000), (lines, F.lit(True))]).select("c_custkey", "c_name")


@query("SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1")
def ordered_listagg(t: Tables) -> DataFrame:
    joined = t["region"].join(t["nation"], F.col("r_regionkey") == F.col("n_regionkey"))
    return joined.groupBy("r_name").agg(an.ordered_list(F.col("n_name"), ["n_name"]).alias("nations"))


@query("""SELECT user_id, arg_min(CAST(round(value * 100) AS BIGINT), event_id) FILTER (event_type = 'view') AS "view", arg_min(CAST(round(value * 100) AS BIGINT), event_id) FILTER (event_type = 'purchase') AS purchase FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1""")
def pivot_scores(t: Tables) -> DataFrame:
    rows = t["events"].where("event_type IN ('view', 'purchase')").withColumn("v", cents("value"))
    return an.pivot_scores(rows, ["user_id"], "event_type", "v", ["view", "purchase"], "event_id")


@query("""SELECT n_nationkey, n_name, string_agg(s_suppkey || ':' || s_name, ';' ORDER BY s_acctbal DESC, s_suppkey) AS feed, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def nested_feed(t: Tables) -> DataFrame:
    rows = t["supplier"].select("s_nationkey", "s_suppkey", "s_name", (-F.col("s_acctbal")).alias("o"))
    fed = rows.groupBy("s_nationkey").agg(an.nested(["o", "s_suppkey"], ["s_suppkey", "s_name"]).alias("items"))
    shown = F.array_join(F.transform("items", lambda x: F.concat(x["s_suppkey"].cast("string"), F.lit(":"), x["s_name"])), ";")
    return t["nation"].join(fed, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("n_nationkey", "n_name", shown.alias("feed"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n"))


@query("""WITH a AS (SELECT c_nationkey AS k, c_mktsegment AS s FROM customer WHERE c_acctbal > 0), b AS (SELECT c_nationkey AS k, CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_mktsegment END AS s FROM customer WHERE c_acctbal < 500 OR c_acctbal > 9000)
SELECT *, 'a' AS side FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k AND b.s IS NOT DISTINCT FROM a.s) UNION ALL SELECT *, 'b' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.k = a.k AND b.s IS NOT DISTINCT FROM a.s)""")
def two_way_difference(t: Tables) -> DataFrame:
    c = t["customer"]
    a = c.where("c_acctbal > 0").select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("s"))
    b = c.where("c_acctbal < 500 OR c_acctbal > 9000").select(F.col("c_nationkey").alias("k"), F.when(~(F.col("c_acctbal") > 9000), F.col("c_mktsegment")).alias("s"))
    return reconcile.two_way_difference(a, b)


@query("""
SELECT 'reference' AS rule, CAST(doc_id AS VARCHAR) AS message FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL
SELECT 'domain', CAST(o_orderkey AS VARCHAR) || '/' || o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O') UNION ALL
SELECT 'unique', text FROM documents GROUP BY text HAVING count(*) > 1 UNION ALL
SELECT 'condition', CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_discount > 0.09""")
def validation_rules(t: Tables) -> DataFrame:
    return validation.all_of([
        validation.missing_reference(t["documents"], ["doc_id"], t["labels"], ["doc_id"], "reference"), validation.outside(t["orders"], "o_orderstatus", ("F", "O"), ["o_orderkey", "o_orderstatus"], "domain"),
        validation.repeated(t["documents"], ["text"], "unique"), validation.broken(t["lineitem"], F.col("l_discount") <= 0.09, ["l_orderkey", "l_linenumber"], "condition"),
    ])
