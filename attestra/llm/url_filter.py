"""URL filter: explicit host and path rules first, then a tree of path templates for each host.

The tree is grown level by level from counts of distinct paths, never from single urls, so a host with a third of all pages
is a few rows after the first aggregation. At each node variable segments (numbers, hexadecimal ids) become wildcards by
their form, and a node with very many children gets one wildcard for all. The other children are put in order of their
smoothed share of good labels and parted at the border where a two-proportion test differs most; if it does not differ
enough anywhere, all are similar and become one branch, else those on each side do. Merged branches are counted together
from there on. A template is rejected if its smoothed share of good labels is too low against that of all pages.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .licenses import LOWER, UPPER

#: (verdict, host, path)
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Children from which, and share of distinct children among a node's pages above which, all become a wildcard.
MANY, SHARE = 20, 0.2
#: Purity: weight of the prior share, the z value from which two sides of a node differ.
PRIOR_WEIGHT, DIFFER = 10.0, 2.576
#: A template is rejected below this part of the overall share of good labels, and below the lower bound in any case.
RELATIVE, LEAST = 0.9, 0.5


def host_and_path(url: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return {"host": F.translate(host, UPPER, LOWER), "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)}


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """rule and rule_verdict of the longest fitting rule (of equally long ones the first by text), else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return {"rule": rule, "rule_verdict": verdict}


#: Variable forms of a segment and what they become.
FORMS = ((r"^[0-9a-fA-F]*[0-9][0-9a-fA-F]{7,}(\.[a-z]+)?$", "{hex}"), (r"^[0-9]+(\.[a-z]+)?$", "{num}"))


def segments(path: Column) -> Column:
    """All segments of a path that are not empty, variable forms generalised."""

    def form(s: Column) -> Column:
        for pattern, name in FORMS:
            s = F.regexp_replace(s, pattern, name + "$1")
        return s

    return F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""), form)


def _steps(children: DataFrame, many: int, share: float, differ: float, weight: float) -> DataFrame:
    """host, template, child, step: what each child (with pages, labelled, good) of a node adds to the template."""
    node = ["host", "template"]
    total = children.groupBy(*node).agg(F.count("*").alias("n"), *(F.sum(c).alias(f"all_{c}") for c in ("pages", "labelled", "good")))
    pool = (F.col("all_good") + 1) / (F.col("all_labelled") + 2)
    rated = children.join(total, node).withColumn("pool", pool).withColumn("rate", (F.col("good") + weight * F.col("pool")) / (F.col("labelled") + weight))
    # Children of equal counts are alike, so a node has far fewer borders than children.
    alike = rated.groupBy(*node, "rate", "labelled").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"), F.first("all_labelled").alias("al"), F.first("all_good").alias("ag"), F.first("pool").alias("pool"))
    before = Window.partitionBy(*node).orderBy("rate", "labelled").rowsBetween(Window.unboundedPreceding, 0)
    sums = alike.withColumns({"low_l": F.sum("l").over(before), "low_g": F.sum("g").over(before)})
    high_l, high_g = F.col("al") - F.col("low_l"), F.col("ag") - F.col("low_g")
    error = F.sqrt(F.col("pool") * (1 - F.col("pool")) * (1 / F.col("low_l") + 1 / high_l))
    z = (high_g / high_l - F.col("low_g") / F.col("low_l")) / error
    borders = sums.where((F.col("low_l") > 0) & (high_l > 0)).select(*node, "rate", "labelled", z.alias("z")).where(F.col("z") >= differ)
    best = borders.groupBy(*node).agg(F.max(F.struct("z", "rate", "labelled")).alias("cut"))
    sided = rated.join(best, node, "left").withColumn("side", F.when(F.col("cut").isNull(), "*").when(F.struct("rate", "labelled") <= F.struct("cut.rate", "cut.labelled"), "{-}").otherwise("{+}"))
    sizes = sided.groupBy(*node, "side").agg(F.count("*").alias("m"))
    wild = (F.col("n") >= many) & (F.col("n") >= share * F.col("all_pages"))
    return sided.join(sizes, [*node, "side"]).select(*node, "child", F.concat(F.lit("/"), F.when(wild, "*").when(F.col("m") == 1, F.col("child")).otherwise(F.col("side"))).alias("step"))


def template_purity(pages: DataFrame, labels: DataFrame, many: int = MANY, share: float = SHARE, differ: float = DIFFER, weight: float = PRIOR_WEIGHT) -> DataFrame:
    """(host, path_form, template, good, labelled, pages): the template of every distinct generalised path, of any depth.

    pages has id, host, path; labels has id, good (0 or 1; other values and repeated ids that contradict count as none).
    A path that is alone at its node is finished at once, so there are as many rounds as levels at which paths part.
    """
    known = labels.where("id IS NOT NULL AND good IN (0, 1)").groupBy("id").agg(F.min("good").alias("good"), F.max("good").alias("other")).where("good = other").drop("other")
    tree = pages.join(known, "id", "left").groupBy("host", segments(F.col("path")).alias("path_form")).agg(F.count("*").alias("pages"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    tree = common.cut(tree.withColumn("template", F.lit("")), "url-tree")
    parts, level = [], 0
    while True:
        ends = F.size("path_form") <= level
        alone = tree.where(~ends).groupBy("host", "template").agg(F.count("*").alias("there"))
        marked = tree.join(alone, ["host", "template"], "left")
        rest = F.when(ends, "").otherwise(F.concat(F.lit("/"), F.array_join(F.expr(f"slice(path_form, {level + 1}, greatest(size(path_form) - {level}, 0))"), "/")))
        done = marked.where(ends | (F.col("there") == 1)).withColumn("template", F.concat("template", rest)).drop("there")
        parts.append(common.cut(done, "url-done"))
        open_ = common.cut(marked.where(~ends & (F.col("there") > 1)).drop("there").withColumn("child", F.col("path_form")[level]), "url-open")
        common.drop(tree)
        if open_.isEmpty():
            common.drop(open_)
            out = common.cut(functools.reduce(DataFrame.unionByName, parts), "url-templates")
            for part in parts:
                common.drop(part)
            return out
        children = open_.groupBy("host", "template", "child").agg(*(F.sum(c).alias(c) for c in ("pages", "labelled", "good")))
        grown = open_.join(_steps(children, many, share, differ, weight), ["host", "template", "child"]).withColumn("template", F.concat("template", "step"))
        tree = common.cut(grown.drop("child", "step"), "url-tree")
        common.drop(open_)
        level += 1


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", label_col: str = "quality", relative: float = RELATIVE, least: float = LEAST, weight: float = PRIOR_WEIGHT) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every url; labels are joined to pages by id.

    A null url and one without '://' have an empty host and path and are judged by the template of the empty path. A null id
    is carried and has no label; repeated rows are judged alike and count each; an empty table gives no rows; other columns
    are ignored; very long urls are taken whole, at any depth. Of fitting rules of equal length the first by text wins.
    Without any label every template's purity is 1 and nothing is rejected.
    """
    common.ship(pages.sparkSession)
    parts = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    parts = parts.select("id", *(c.alias(n) for n, c in host_and_path(F.col("url")).items()))
    tree = template_purity(parts, labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("good")), weight=weight)
    total = tree.agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled")).first()
    prior = total["good"] / total["labelled"] if total["labelled"] else 1.0
    pure = tree.groupBy("host", "template").agg(F.sum("good").alias("g"), F.sum("labelled").alias("l")).select("host", "template", ((F.col("g") + weight * prior) / (F.col("l") + weight)).alias("purity"))
    known = tree.select("host", "path_form", "template").join(pure, ["host", "template"])
    placed = parts.withColumn("path_form", segments(F.col("path"))).join(known, ["host", "path_form"], "left")
    ruled = placed.withColumns(rule_columns(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("rule_verdict", F.when(F.col("purity") < max(least, relative * prior), "block").otherwise("allow"))
    return ruled.select(F.col("id").alias("page_id"), "host", "path", "rule", verdict.alias("verdict"), "template", F.round("purity", 9).alias("purity"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))


#: Levels that the SQL below spells out; pages of the tables have fewer segments.
_SQL_LEVELS = 6


def _oracle() -> str:
    rest = "CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    form = "x"
    for pattern, name in FORMS:
        form = f"regexp_replace({form}, '{pattern}', '{name}\\1')"
    ruled = {"rule": "NULL", "what": "NULL"}
    for what, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        ruled = {"rule": f"CASE WHEN {fits} THEN '{h + p}' ELSE {ruled['rule']} END", "what": f"CASE WHEN {fits} THEN '{what}' ELSE {ruled['what']} END"}
    sql = f"""
WITH r AS (SELECT CAST(page_id AS BIGINT) AS id, {rest} AS rest FROM pages),
p AS (SELECT id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM r),
f AS (SELECT *, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: {form}) AS pf FROM p),
y AS (SELECT CAST(doc_id AS BIGINT) AS id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1 HAVING min(quality) = max(quality)),
t0 AS (SELECT host, pf, '' AS template, count(*) AS pages, count(good) AS labelled, coalesce(sum(good), 0)::BIGINT AS good FROM f LEFT JOIN y USING (id) GROUP BY host, pf)"""
    for k in range(_SQL_LEVELS):
        sql += f""",
o{k} AS (SELECT *, pf[{k + 1}] AS child FROM t{k} WHERE len(pf) > {k}),
c{k} AS (SELECT host, template, child, sum(pages) AS pages, sum(labelled) AS labelled, sum(good) AS good FROM o{k} GROUP BY ALL),
n{k} AS (SELECT *, count(*) OVER w AS n, sum(pages) OVER w AS ap, sum(labelled) OVER w AS al, sum(good) OVER w AS ag FROM c{k} WINDOW w AS (PARTITION BY host, template)),
q{k} AS (SELECT *, (ag + 1)::DOUBLE / (al + 2)::DOUBLE AS pool, (good + {PRIOR_WEIGHT} * ((ag + 1)::DOUBLE / (al + 2)::DOUBLE))::DOUBLE / (labelled + {PRIOR_WEIGHT})::DOUBLE AS rate FROM n{k}),
g{k} AS (SELECT host, template, rate, labelled, sum(labelled) AS l, sum(good) AS g, any_value(al) AS al, any_value(ag) AS ag, any_value(pool) AS pool FROM q{k} GROUP BY host, template, rate, labelled),
s{k} AS (SELECT *, sum(l) OVER w AS ll, sum(g) OVER w AS lg FROM g{k} WINDOW w AS (PARTITION BY host, template ORDER BY rate, labelled ROWS UNBOUNDED PRECEDING)),
z{k} AS (SELECT host, template, rate, labelled, ((ag - lg)::DOUBLE / (al - ll)::DOUBLE - lg::DOUBLE / ll::DOUBLE) / sqrt(pool * (1 - pool) * (1::DOUBLE / ll::DOUBLE + 1::DOUBLE / (al - ll)::DOUBLE)) AS z FROM s{k} WHERE ll > 0 AND al - ll > 0),
b{k} AS (SELECT * FROM z{k} WHERE z >= {DIFFER} QUALIFY row_number() OVER (PARTITION BY host, template ORDER BY z DESC, rate DESC, labelled DESC) = 1),
d{k} AS (SELECT q.*, CASE WHEN b.z IS NULL THEN '*' WHEN q.rate < b.rate OR q.rate = b.rate AND q.labelled <= b.labelled THEN '{{-}}' ELSE '{{+}}' END AS side FROM q{k} q LEFT JOIN b{k} b USING (host, template)),
e{k} AS (SELECT host, template, child, CASE WHEN n >= {MANY} AND n >= {SHARE} * ap THEN '*' WHEN count(*) OVER (PARTITION BY host, template, side) = 1 THEN child ELSE side END AS step FROM d{k}),
t{k + 1} AS (SELECT t.host, t.pf, t.template || CASE WHEN len(t.pf) > {k} THEN '/' || e.step ELSE '' END AS template, t.pages, t.labelled, t.good FROM t{k} t LEFT JOIN e{k} e ON t.host = e.host AND t.template = e.template AND t.pf[{k + 1}] = e.child)"""
    return sql + f""",
prior AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(good)::DOUBLE / sum(labelled)::DOUBLE ELSE 1.0 END AS prior FROM t{_SQL_LEVELS}),
pure AS (SELECT host, template, (sum(good) + {PRIOR_WEIGHT} * any_value(prior))::DOUBLE / (sum(labelled) + {PRIOR_WEIGHT})::DOUBLE AS purity FROM t{_SQL_LEVELS}, prior GROUP BY host, template)
SELECT f.id AS page_id, f.host, f.path, {ruled['rule']} AS rule, coalesce({ruled['what']}, CASE WHEN purity < greatest({LEAST}, {RELATIVE} * prior) THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 9) AS purity
FROM f JOIN t{_SQL_LEVELS} USING (host, pf) JOIN pure USING (host, template), prior"""


ORACLE = _oracle()
