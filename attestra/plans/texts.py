"""Text, labelling, layout and redaction operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions import text as tx
from attestra.operators import institutional as inst
from attestra.operators import labelling as lb
from attestra.operators import layout as ly
from attestra.operators import redaction as rd
from attestra.operators import scoring

from .base import Tables, query

_PLAIN = f"regexp_replace(lower(translate(coalesce({{0}}, ''), '{tx.ACCENTED}', '{tx.PLAIN}')), '[^\\x00-\\x7f]', '', 'g')"
#: Rules over dotted part codes: pattern, node, role.
RULES = [(r"^MEDIUM\.Brand#1", "M1", "parcial"), (r"^MEDIUM$", "M", "apoyo"), (r"^(SMALL|LARGE)\.Brand#2\d$", "B2", "principal"), (r"^SMALL", "S", "parcial"), (r"#25$", "B2", "apoyo"), (r"^PROMO\.Brand#\d\.\d$", "P", "principal"), (r"^PROMO$", "P", "apoyo")]


def _rules_sql() -> str:
    weak = {"principal": 0, "parcial": 1, "apoyo": 2}
    return ", ".join(f"('{p}', '{n}', {weak[r]})" for p, n, r in RULES)


@query(f"""
WITH r(pat, node, w) AS (VALUES {_rules_sql()}), c AS (SELECT p_partkey, p_type AS a, p_brand AS b, CAST(p_size AS VARCHAR) AS s FROM part),
ch AS (SELECT p_partkey, a || '.' || b || '.' || s AS code, 1 AS lv FROM c UNION ALL SELECT p_partkey, a || '.' || b, 2 FROM c UNION ALL SELECT p_partkey, a, 3 FROM c),
h AS (SELECT p_partkey, node, w, lv, min(lv) OVER (PARTITION BY p_partkey) AS best FROM ch JOIN r ON regexp_matches(code, pat))
SELECT p_partkey, node AS nodo, CASE min(w) WHEN 0 THEN 'principal' WHEN 1 THEN 'parcial' ELSE 'apoyo' END AS rol FROM h WHERE lv = best GROUP BY 1, 2""")
def rule_tagger_most_specific(t: Tables) -> DataFrame:
    coded = t["part"].select("p_partkey", lb.dotted_chain(F.concat_ws(".", "p_type", "p_brand", F.col("p_size").cast("string"))).alias("chain"))
    return lb.tag_by_rules(coded, "p_partkey", "chain", RULES)


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM conversations""")
def locf_header(t: Tables) -> DataFrame:
    return lb.carry_down(t["conversations"], ["conv_id"], ["turn", F.md5("text")], F.when(F.col("role") == "user", F.md5("text")), "header").select("conv_id", "turn", "header")


#: Texts that cite norms: by number, with words between, through another norm, after a verb, out of the years that count.
CITING = ("Según el Acuerdo No. {n} del 12 de mayo de {y} del Consejo Superior", "la Resolución 0{n} de {y} de la Rectoría", "el Acuerdo que reforma la Resolución N° {n} de {y} del CSU", "de Acuerdo con {n} de {y}", "Acuerdo {n} de 1950 y el ACUERDO académico {n} de {y}", "sin norma {n} de {y}")
_CITING_SQL = "CASE o_orderkey % 6 " + " ".join(f"WHEN {k} THEN replace(replace('{t}', '{{n}}', CAST(100 + o_orderkey % 800 AS STRING)), '{{y}}', CAST(1985 + o_orderkey % 45 AS STRING))" for k, t in enumerate(CITING)) + " END"
_ISSUER_SQL = "CASE " + " ".join(f"WHEN regexp_matches(hit, '{p}') THEN '{name}'" for name, p in lb.ISSUERS) + " END"


@query(f"""WITH t AS (SELECT o_orderkey, {_CITING_SQL} AS text FROM orders),
p AS (SELECT o_orderkey, unnest(string_split(regexp_replace(text, '(?i)(Acuerdo|Resoluci[oó]n)\\b', chr(1) || '\\0', 'g'), chr(1))) AS piece FROM t),
h AS (SELECT o_orderkey, piece, regexp_extract(piece, '(?i)^{lb.NORM}', 0) AS hit, regexp_extract(piece, '(?i)^{lb.NORM}', 2) AS gap, regexp_extract(piece, '(?i)^{lb.NORM}', 3) AS n, regexp_extract(piece, '(?i)^{lb.NORM}', 4) AS y FROM p)
SELECT o_orderkey, CASE WHEN starts_with(lower(piece), 'acu') THEN 'Acuerdo' ELSE 'Resolución' END AS tipo, CAST(n AS INT) AS numero, CAST(y AS INT) AS anio, {_ISSUER_SQL} AS organo FROM h
WHERE hit <> '' AND NOT regexp_matches(piece, '(?i)^(Acuerdo|Resoluci[oó]n)\\s+(con|a|al)\\b') AND NOT regexp_matches(gap, '(?i){lb.NORM_GAP}') AND CAST(y AS INT) BETWEEN {lb.NORM_YEARS[0]} AND {lb.NORM_YEARS[1]}""")
def norm_rescan(t: Tables) -> DataFrame:
    texts = t["orders"].select("o_orderkey", F.expr(_CITING_SQL).alias("text"))
    return texts.select("o_orderkey", F.explode(lb.cited_norms_udf("text")).alias("n")).select("o_orderkey", "n.*")


@query("""SELECT doc_id, CASE WHEN length(text) < 120 THEN 'cover' WHEN text LIKE '%$$$%' THEN 'noise' WHEN text ILIKE '%licen%' AND n_chars > 200 THEN 'licensed' WHEN contains(text, ' | ') THEN 'table' ELSE 'slide' END AS kind FROM documents""")
def classify_first_match(t: Tables) -> DataFrame:
    x = F.col("text")
    kind = lb.first_match([(F.length(x) < 120, "cover"), (x.contains("$$$"), "noise"), (x.ilike("%licen%") & (F.col("n_chars") > 200), "licensed"), (x.contains(" | "), "table")], "slide")
    return t["documents"].select("doc_id", kind.alias("kind"))


@query("""SELECT doc_id, coalesce(substring(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 14 AND NOT regexp_matches(x, '""" + lb.NO_TITLE.replace('(?iu)', '(?i)') + """') AND NOT regexp_matches(x, '^[0-9 %.,$]+$') AND NOT contains('the and attion', lower(x)) )[1], 1, 110), 'the and attion') AS title FROM documents""")
def title_pick(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", lb.title(F.col("text"), F.lit("the and attion")).alias("title"))


@query(f"""
WITH w AS (SELECT conv_id, turn, list_distinct(regexp_extract_all({_PLAIN.format('text')}, '[a-z]{{4,}}')) AS w, md5(text) AS h FROM conversations),
p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn, h) AS v FROM w)
SELECT conv_id, turn, round(CASE WHEN len(list_distinct(list_concat(w, v))) = 0 THEN 1.0 ELSE len(list_intersect(w, v)) / len(list_distinct(list_concat(w, v))) END, 9)::DOUBLE AS similarity FROM p WHERE v IS NOT NULL""")
def token_jaccard(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn", F.md5("text"))
    rows = t["conversations"].withColumn("w", tx.words4(F.col("text"))).withColumn("v", F.lag("w").over(w)).where("v IS NOT NULL")
    return rows.select("conv_id", "turn", F.round(tx.jaccard(F.col("w"), F.col("v")), 9).alias("similarity"))


@query(f"""
WITH p AS (SELECT conv_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, md5(text)) AS known FROM conversations),
k AS (SELECT conv_id, turn, text, regexp_extract_all({_PLAIN.format('known')}, '[a-z]{{4,}}') AS known FROM p),
l AS (SELECT conv_id, turn, known, unnest(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')))) AS line FROM k)
SELECT conv_id, turn, count(*) AS new_lines, CAST(sum(length(line)) AS BIGINT) AS new_chars FROM l WHERE length(line) >= 6 AND NOT regexp_matches(line, '{tx.REPEATED.replace('(?iu)', '(?i)')}')
AND length(regexp_replace(line, '[^\\p{{L}}]', '', 'g')) >= 0.6 * greatest(length(replace(line, ' ', '')), 1)
AND len(list_filter(regexp_extract_all({_PLAIN.format('line')}, '[a-z]{{4,}}'), lambda x: NOT list_contains(known, x))) > 0 GROUP BY 1, 2""")
def novel_lines(t: Tables) -> DataFrame:
    known = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", F.md5("text")))
    rows = t["conversations"].withColumn("known", known).select("conv_id", "turn", tx.novel_lines(F.split("text", "\n"), F.col("known")).alias("new"))
    chars = F.aggregate("new", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return rows.where(F.size("new") > 0).select("conv_id", "turn", F.size("new").cast("long").alias("new_lines"), chars.alias("new_chars"))


@query("""SELECT p_partkey, CASE WHEN row_number() OVER w = 1 THEN p_name ELSE p_name || '-' || row_number() OVER w END AS code,
CASE WHEN count(*) OVER g = 1 THEN p_brand ELSE p_brand || '-' || lpad(CAST(row_number() OVER g2 AS VARCHAR), 2, '0') END AS numbered FROM (SELECT *, CAST(p_size AS VARCHAR) AS z FROM part)
WINDOW w AS (PARTITION BY p_name ORDER BY p_partkey), g AS (PARTITION BY p_brand, p_size, p_type), g2 AS (PARTITION BY p_brand, p_size, p_type ORDER BY p_partkey)""")
def collision_suffix(t: Tables) -> DataFrame:
    p = t["part"]
    return p.select("p_partkey", ly.numbered_codes(p, ["p_name"], ["p_partkey"], F.col("p_name")).alias("code"), ly.numbered_codes(p, ["p_brand", "p_size", "p_type"], ["p_partkey"], F.col("p_brand"), single=False).alias("numbered"))


@query("""SELECT doc_id, md5(regexp_replace(regexp_replace(text, '[0-9A-Za-z_.+-]+@[0-9A-Za-z_-]+(\\.[0-9A-Za-z_-]+)+', '[correo omitido]', 'g'), '(?i)\\b(usuario|user(?:name)?|contrase(?:ñ|n)a|password|clave(?: de acceso)?)(\\s*[:=]\\s*)(\\S+)', '\\1\\2[omitido]', 'g')) AS masked FROM documents""")
def mask_text(t: Tables) -> DataFrame:
    return t["documents"].select("doc_id", F.md5(rd.mask(F.col("text"))).alias("masked"))


POLICY = [(r"^src1\d$", "restricted"), (r"^src[0-4]$", "personal"), (r"9$", "contract")]


@query("""SELECT doc_id, why, CASE WHEN why IS NULL THEN length(text) ELSE length('[Texto omitido en la versión para compartir: ' || why || '. Está en la versión completa del índice.]') END AS n
FROM (SELECT doc_id, text, CASE WHEN regexp_matches(source, '^src1[0-9]$') THEN 'restricted' WHEN regexp_matches(source, '^src[0-4]$') THEN 'personal' WHEN regexp_matches(source, '9$') THEN 'contract' END AS why FROM documents)""")
def suppress_by_policy(t: Tables) -> DataFrame:
    why = rd.first_policy(F.col("source"), POLICY)
    before, after = rd.NOTICE.split("{motivo}")
    return t["documents"].select("doc_id", why.alias("why"), F.when(why.isNull(), F.length("text")).otherwise(F.length(F.concat(F.lit(before), why, F.lit(after)))).cast("long").alias("n"))


@query("""WITH c AS (SELECT page_id, lower(array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)[1:2], ' ')) AS head FROM pages)
SELECT page_id, contains(head, 'the') AND regexp_matches(head, 'and|ing|tion') AS people FROM c""")
def drop_person_tables(t: Tables) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1)
    return t["pages"].select("page_id", rd.lists_people(F.transform(links, lambda x: F.array(x)), "and|ing|tion", "the").alias("people"))


PATTERNS = {"P1": r"\bthe\b", "P2": r"\bla\b|\ble\b", "P3": r"\bder\b|\bdie\b", "P4": r"\bcion\b|\bmente", "P5": r"licens", "P6": r"\| ", "P7": r"\brights reserved"}


@query(f"""
WITH d AS (SELECT source, doc_id, {_PLAIN.format('text')} AS x, n_chars FROM documents), p(so, pat) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in PATTERNS.items())}),
h AS (SELECT source, so, doc_id, CASE WHEN n_chars > 2000 THEN 3 ELSE 1 END AS pts, trim(regexp_extract(x, pat)) AS found FROM d JOIN p ON regexp_matches(x, pat)),
s AS (SELECT source, so, CAST(sum(pts) AS BIGINT) AS score, string_agg(DISTINCT found, '; ' ORDER BY found) AS why FROM h GROUP BY 1, 2)
SELECT source, so, score, why FROM s WHERE score >= 4""")
def weighted_pattern_score(t: Tables) -> DataFrame:
    hit = t["documents"].select("source", F.when(F.col("n_chars") > 2000, 3).otherwise(1).alias("pts"), F.explode(scoring.hits(tx.plain(F.col("text")), PATTERNS)).alias("h"))
    s = hit.groupBy("source", F.col("h.so").alias("so")).agg(F.sum("pts").alias("score"), F.array_join(F.array_sort(F.collect_set("h.found")), "; ").alias("why"))
    return s.where(F.col("score") >= scoring.THRESHOLD)


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000 OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(event_id) AS first_event FROM i GROUP BY 1, 2""")
def gap_islands(t: Tables) -> DataFrame:
    e = t["events"].select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return ly.gap_islands(e, ["user_id"], "at", 21_600_000_000, ties=["event_id"]).groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT event_type, CAST(round_even(value, 0) AS BIGINT) AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) >= 3""")
def start_histogram(t: Tables) -> DataFrame:
    return ly.start_histogram(t["events"], ["event_type"], F.col("value"))


@query("""
WITH i AS (SELECT user_id, event_id, epoch_us(ts) AS pos FROM events WHERE event_type <> 'purchase'), a AS (SELECT user_id, event_id AS anchor, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'),
r AS (SELECT i.user_id, event_id, anchor, abs(pos - t) AS d, row_number() OVER (PARTITION BY event_id ORDER BY abs(pos - t), t, anchor) AS n FROM i LEFT JOIN a ON a.user_id = i.user_id)
SELECT user_id, event_id, anchor, CAST(d AS DOUBLE) AS distance FROM r WHERE n = 1""")
def nearest_anchor(t: Tables) -> DataFrame:
    e = t["events"].select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return ly.nearest_anchor(e.where("event_type <> 'purchase'"), e.where("event_type = 'purchase'").withColumnRenamed("event_id", "anchor"), ["user_id"], "at", "event_id", "anchor")


@query("""
WITH s AS (SELECT user_id, event_id AS span, epoch_us(ts) AS s, least(epoch_us(ts) + 7200000000, coalesce(lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id), epoch_us(ts) + 7200000000)) AS e FROM events WHERE event_type = 'signup'),
p AS (SELECT user_id, event_id, epoch_us(ts) AS pos FROM events WHERE event_type = 'click')
SELECT p.user_id, event_id, coalesce(s.span, -1) AS span, coalesce(pos < s.e, false) AS inside FROM p LEFT JOIN LATERAL (SELECT span, e FROM s WHERE s.user_id = p.user_id AND s.s <= p.pos ORDER BY s.s DESC, span DESC LIMIT 1) s ON true""")
def interval_else_previous(t: Tables) -> DataFrame:
    e = t["events"].select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    nxt = F.lead("at").over(Window.partitionBy("user_id").orderBy("at", "event_id"))
    spans = e.where("event_type = 'signup'").withColumn("e", F.least(F.col("at") + 7_200_000_000, nxt)).select("user_id", F.col("event_id").alias("span"), F.col("at").alias("s"), "e")
    return ly.interval_else_previous(e.where("event_type = 'click'"), spans, ["user_id"], "at", "s", "e", "event_id", "span").fillna(-1, ["span"])


@query("""
WITH c AS (SELECT event_type, CAST(floor(value) AS BIGINT) AS v, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT a.event_type, a.v, CAST(sum(b.n) AS BIGINT) AS support FROM c a JOIN c b ON a.event_type = b.event_type AND abs(a.v - b.v) <= 3 GROUP BY 1, 2)
SELECT event_type, v AS mode, support FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY support DESC, v) AS r FROM s) WHERE r = 1""")
def tolerant_mode(t: Tables) -> DataFrame:
    return ly.tolerant_mode(t["events"].withColumn("v", F.floor("value")), ["event_type"], "v")


@query("""SELECT zone, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM (SELECT l_linenumber, (l_quantity >= 10)::INT + (l_quantity >= 25)::INT + (l_quantity >= 40.5)::INT AS zone FROM lineitem) GROUP BY 1""")
def zone_assignment(t: Tables) -> DataFrame:
    return t["lineitem"].select("l_linenumber", ly.zone(F.col("l_quantity"), [10, 25, 40.5]).alias("zone")).groupBy("zone").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("""
WITH r AS (SELECT *, md5(text) AS h, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn, md5(text) ROWS UNBOUNDED PRECEDING) AS record FROM conversations)
SELECT conv_id, CAST(record AS BIGINT) AS record, md5(string_agg(text, ' ' ORDER BY turn, h)) AS digest, count(*) AS n_rows FROM r GROUP BY 1, 2""")
def continuation_concat(t: Tables) -> DataFrame:
    rows = t["conversations"].withColumn("h", F.md5("text"))
    return ly.continuations(rows, ["conv_id"], ["turn", "h"], F.col("role") == "user", "text").select("conv_id", "record", F.md5("text").alias("digest"), "n_rows")


#: A plan's layout text, made of a part's row by an expression that Spark and DuckDB both read; and what another reading has.
_SEMESTER_SAID = "CASE p_partkey % 7 WHEN 0 THEN '3' WHEN 1 THEN 'Segundo semestre' WHEN 2 THEN 'VIII' WHEN 3 THEN '__5__' WHEN 4 THEN 'not known' WHEN 5 THEN 'in the Ninth' ELSE 'séptimo u octavo' END"
_PLAN_TEXT = f"""concat(CASE WHEN p_partkey % 4 = 0 THEN 'COURSE PLAN' ELSE 'INFORMACIÓN GENERAL DEL CAI' END, chr(10), 'Código del CAI   CAI', lpad(CAST(p_partkey AS string), 8, '0'), chr(10),
CASE WHEN p_partkey % 4 = 0 THEN 'Curso   ' ELSE 'Nombre del CAI   ' END, p_name, ' .   other', chr(10), 'Ubicación Semestral   ', {_SEMESTER_SAID}, chr(10), 'Créditos:', CASE WHEN p_partkey % 3 = 0 THEN chr(10) ELSE ' ' END, CAST(p_size % 10 AS string), chr(10),
'Prerrequisitos (si aplica)    ', p_type, chr(10))"""
_PLAN_READ = {
    "codigo": "CASE WHEN p_partkey % 9 = 0 THEN 'CAD1' ELSE concat('PAD-', CAST(p_partkey AS string)) END", "codigo_pdf": "CASE WHEN p_partkey % 5 = 0 THEN 'OWN' END",
    "nombre": "CASE p_partkey % 4 WHEN 1 THEN 'PAD one' WHEN 2 THEN NULL ELSE 'Own name' END", "semestre": "CASE WHEN p_partkey % 2 = 0 THEN 1 END", "creditos": "CASE WHEN p_partkey % 5 = 1 THEN 8 END", "prerrequisitos": "CASE WHEN p_partkey % 5 = 2 THEN 'Own' ELSE '' END",
}


def _semester_sql() -> str:
    return "CASE w " + " ".join(f"WHEN '{w}' THEN {n}" for w, n in inst.SEMESTERS.items()) + " END"


@query(rf"""
WITH p AS (SELECT CAST(p_partkey AS string) AS archivo, {_PLAN_TEXT} AS texto, {", ".join(f"{e} AS {c}" for c, e in _PLAN_READ.items())} FROM part),
k AS (SELECT *, regexp_matches(upper(substr(texto, 1, {inst.HEAD_LENGTH})), '{inst.HEADING}') AND NOT regexp_matches(codigo, '{inst.OTHER_CODE}') AS ours,
nullif(regexp_extract(texto, '(?i)C[óo]digo del CAI\s+(CAI\d{{6,}})', 1), '') AS c, nullif(trim(regexp_extract(texto, '(?i){inst.NAME[0]}', 1), ' .:*-_'), '') AS n,
lower(trim(regexp_extract(texto, '(?i){inst.SEMESTER}', 1))) AS said, try_cast(regexp_extract(texto, '(?i){inst.CREDITS}', 1) AS integer) AS cr, nullif(trim(regexp_extract(texto, '(?i){inst.REQUIRED}', 1), ' .:*-_'), '') AS r FROM p),
l AS (SELECT *, coalesce(try_cast(regexp_extract(said, '^_*(\d)', 1) AS integer), list_extract(list_filter(list_transform(regexp_extract_all(said, '[a-záéíóú]+'), lambda w: {_semester_sql()}), lambda x: x IS NOT NULL), 1)) AS s FROM k)
SELECT archivo, CASE WHEN ours AND codigo_pdf IS NULL THEN coalesce(c, codigo) ELSE codigo END AS codigo, CASE WHEN ours THEN coalesce(codigo_pdf, c) ELSE codigo_pdf END AS codigo_pdf,
CASE WHEN ours AND regexp_matches(coalesce(nombre, 'PAD'), '{inst.FILE_NAME}') THEN coalesce(n, nombre) ELSE nombre END AS nombre, CASE WHEN ours THEN coalesce(semestre, s) ELSE semestre END AS semestre,
CASE WHEN ours THEN coalesce(creditos, cr) ELSE creditos END AS creditos, CASE WHEN ours AND prerrequisitos = '' THEN coalesce(r, '') ELSE prerrequisitos END AS prerrequisitos, CASE WHEN ours THEN '{inst.KIND}' END AS tipo_campo FROM l""")
def institutional_plans(t: Tables) -> DataFrame:
    parts, key = t["part"], F.col("p_partkey").cast("string").alias("archivo")
    lists = [F.lit(None).cast("string").alias("rea_general"), F.lit(None).cast("array<struct<consecutivo:int,texto:string>>").alias("rea"), F.lit(None).cast("array<struct<tipo:string,nombre:string>>").alias("experiencias")]
    pads = parts.select(key, *[F.expr(e).alias(c) for c, e in _PLAN_READ.items()], *lists)
    done = inst.complement_plans(pads, parts.select(key, F.expr(_PLAN_TEXT).alias("texto")))
    return done.select("archivo", "codigo", "codigo_pdf", "nombre", "semestre", "creditos", "prerrequisitos", "tipo_campo")
