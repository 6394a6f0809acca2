"""Registered analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.catalog import query
from saleswh.oracle.ctes import CTES, with_ctes
from saleswh.plans import analytics, learned, marts
from saleswh.plans.warehouse import Warehouse
from saleswh.sources import bridge

AS_OF = "2001-09-01"
DIMS = ["PRODUCT_LINE", "SALES_ORG_NAME", "CHANNEL_NAME", "REGION"]

CTES["ml_daily_sales"] = """
SELECT p.PRODUCT_LINE AS s, d.FULL_DATE AS ts, CAST(SUM(f.NET_AMOUNT) AS DOUBLE) AS y
FROM fact_billing f JOIN dim_date d ON d.DATE_SK = f.DATE_SK JOIN dim_product p ON p.PRODUCT_SK = f.PRODUCT_SK
WHERE f.NET_AMOUNT > 0 GROUP BY 1, 2
"""
CTES["ml_daily_billing"] = """
SELECT f.SALES_ORG_ID AS s, d.FULL_DATE AS ts, CAST(SUM(f.NET_AMOUNT) AS DOUBLE) AS y
FROM fact_billing f JOIN dim_date d ON d.DATE_SK = f.DATE_SK GROUP BY 1, 2
"""


def _fit_sql(src: str, where: str = "TRUE") -> str:
    t = "CAST(datediff('day', DATE '1970-01-01', ts) AS DOUBLE)"
    return f"""
    tr AS (SELECT s, regr_slope(y, {t}) AS b, regr_intercept(y, {t}) AS a, max(ts) AS last
           FROM {src} WHERE {where} GROUP BY s),
    rs AS (SELECT x.s, isodow(x.ts) AS dow, x.y - (tr.a + tr.b * {t.replace('ts', 'x.ts')}) AS r
           FROM {src} x JOIN tr ON tr.s = x.s WHERE {where.replace('ts', 'x.ts')}),
    wd AS (SELECT s, dow, avg(r) AS wd FROM rs GROUP BY s, dow),
    sg AS (SELECT rs.s, stddev_samp(rs.r - wd.wd) AS sigma FROM rs JOIN wd ON wd.s = rs.s AND wd.dow = rs.dow
           GROUP BY rs.s)"""


@query("forecast_sales", "D1,U3,A9", with_ctes(f"""
WITH {_fit_sql('ml_daily_sales')},
hz AS (SELECT tr.s, tr.a, tr.b, sg.sigma,
         CAST(unnest(generate_series(CAST(tr.last + 1 AS TIMESTAMP), CAST(tr.last + 90 AS TIMESTAMP),
              INTERVAL 1 DAY)) AS DATE) AS ts
       FROM tr JOIN sg ON sg.s = tr.s)
SELECT hz.s AS SERIES, strftime(hz.ts, '%Y-%m-%d') AS TS,
  round(hz.a + hz.b * CAST(datediff('day', DATE '1970-01-01', hz.ts) AS DOUBLE) + coalesce(wd.wd, 0), 0) AS FORECAST,
  round(hz.a + hz.b * CAST(datediff('day', DATE '1970-01-01', hz.ts) AS DOUBLE) + coalesce(wd.wd, 0)
        - 1.96 * coalesce(hz.sigma, 0), 0) AS LOWER_BOUND,
  round(hz.a + hz.b * CAST(datediff('day', DATE '1970-01-01', hz.ts) AS DOUBLE) + coalesce(wd.wd, 0)
        + 1.96 * coalesce(hz.sigma, 0), 0) AS UPPER_BOUND
FROM hz LEFT JOIN wd ON wd.s = hz.s AND wd.dow = isodow(hz.ts)"""))
def q_forecast_sales(spark, sf_dir):
    """90-day forecast per product line with 95 % bounds."""
    return analytics.forecast(marts.daily_sales(Warehouse(spark, sf_dir)), "SERIE", "TS", "VENTA", 90)


@query("anomalies_billing", "D2,U3,A9,P9", with_ctes(f"""
WITH {_fit_sql('ml_daily_billing', "ts < DATE '2001-09-01' - 60")},
w AS (SELECT s, ts, y FROM ml_daily_billing WHERE ts >= DATE '2001-09-01' - 60 AND ts <= DATE '2001-09-01')
SELECT w.s AS SERIES, strftime(w.ts, '%Y-%m-%d') AS TS, w.y AS Y,
  round(tr.a + tr.b * CAST(datediff('day', DATE '1970-01-01', w.ts) AS DOUBLE) + coalesce(wd.wd, 0), 0) AS FORECAST,
  abs(w.y - (tr.a + tr.b * CAST(datediff('day', DATE '1970-01-01', w.ts) AS DOUBLE) + coalesce(wd.wd, 0)))
    > 2.576 * sg.sigma AS IS_ANOMALY
FROM w LEFT JOIN (SELECT tr.s, tr.a, tr.b, sg.sigma, wd.dow, wd.wd FROM tr JOIN sg ON sg.s = tr.s
                  LEFT JOIN wd ON wd.s = tr.s) m ON m.s = w.s AND m.dow = isodow(w.ts)
LEFT JOIN tr ON tr.s = m.s LEFT JOIN sg ON sg.s = m.s LEFT JOIN wd ON wd.s = m.s AND wd.dow = m.dow"""))
def q_anomalies_billing(spark, sf_dir):
    """Daily billing per org in the last 60 days scored against a model fitted before them."""
    return analytics.detect_anomalies(marts.daily_billing(Warehouse(spark, sf_dir)), "SERIE", "TS", "FACTURADO",
                                      AS_OF, 60)


_GS = ", ".join(["(PRODUCT_LINE)", "(SALES_ORG_NAME)", "(CHANNEL_NAME)", "(REGION)"]
                + [f"({a}, {b})" for i, a in enumerate(DIMS) for b in DIMS[i + 1:]])
CTES["v_ml_contribucion"] = """
SELECT p.PRODUCT_LINE, o.SALES_ORG_NAME, o.CHANNEL_NAME, c.REGION, f.NET_AMOUNT,
  d.FULL_DATE >= CAST(DATE '2001-09-01' - INTERVAL 3 MONTH AS DATE) AS ES_PERIODO_ACTUAL
FROM fact_billing f
JOIN dim_date d ON d.DATE_SK = f.DATE_SK
JOIN dim_product p ON p.PRODUCT_SK = f.PRODUCT_SK
JOIN dim_sales_org o ON o.SALES_ORG_ID = f.SALES_ORG_ID
JOIN dim_customer c ON c.CUSTOMER_SK = f.CUSTOMER_SK
WHERE d.FULL_DATE >= CAST(DATE '2001-09-01' - INTERVAL 6 MONTH AS DATE)
"""


@query("top_drivers", "D3,U3,O1,D-14", with_ctes(f"""
SELECT PRODUCT_LINE, SALES_ORG_NAME, CHANNEL_NAME, REGION, CAST(GID AS BIGINT) AS GID,
  CAST(CURRENT_SUM AS DOUBLE) AS CURRENT_SUM, CAST(PREVIOUS_SUM AS DOUBLE) AS PREVIOUS_SUM, RELATIVE_CHANGE
FROM (SELECT *, round((CAST(CURRENT_SUM AS DOUBLE) - CAST(PREVIOUS_SUM AS DOUBLE))
                      / NULLIF(CAST(PREVIOUS_SUM AS DOUBLE), 0), 6) AS RELATIVE_CHANGE
      FROM (SELECT PRODUCT_LINE, SALES_ORG_NAME, CHANNEL_NAME, REGION,
              GROUPING_ID(PRODUCT_LINE, SALES_ORG_NAME, CHANNEL_NAME, REGION) AS GID,
              SUM(CASE WHEN ES_PERIODO_ACTUAL THEN NET_AMOUNT ELSE 0 END) AS CURRENT_SUM,
              SUM(CASE WHEN NOT ES_PERIODO_ACTUAL THEN NET_AMOUNT ELSE 0 END) AS PREVIOUS_SUM
            FROM v_ml_contribucion GROUP BY GROUPING SETS ({_GS})))
ORDER BY abs(RELATIVE_CHANGE) DESC NULLS LAST, GID, PRODUCT_LINE NULLS FIRST, SALES_ORG_NAME NULLS FIRST,
  CHANNEL_NAME NULLS FIRST, REGION NULLS FIRST
LIMIT 10"""))
def q_top_drivers(spark, sf_dir):
    """Top-10 segments explaining the change, last 3 months vs the 3 before."""
    return analytics.top_drivers(marts.driver_base(Warehouse(spark, sf_dir), AS_OF), DIMS,
                                 "ES_PERIODO_ACTUAL", "NET_AMOUNT", 10)


def _lex_sql() -> str:
    rows = [f"('{w}', 1)" for w in analytics.POSITIVE] + [f"('{w}', -1)" for w in analytics.NEGATIVE]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(w, p)"


def _kw_sql() -> str:
    rows = [f"('{w}', '{lab}', {i})" for i, (lab, ws) in enumerate(analytics.CATEGORIES) for w in ws]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(w, label, rnk)"


CTES["complaints"] = """
SELECT doc_id AS RECLAMO_ID, text AS TEXTO FROM documents
"""
CTES["complaint_tokens"] = """
SELECT RECLAMO_ID, w FROM (SELECT RECLAMO_ID, unnest(regexp_split_to_array(lower(TEXTO), '[^\\p{L}]+')) AS w
                           FROM complaints) WHERE w <> ''
"""
CTES["lexicon"] = _lex_sql()
CTES["category_keywords"] = _kw_sql()
CTES["complaints_scored"] = """
SELECT c.RECLAMO_ID, round(coalesce(CAST(s.pos - s.neg AS DOUBLE) / NULLIF(CAST(s.pos + s.neg AS DOUBLE), 0), 0), 4)
    AS SENTIMIENTO, k.label AS CATEGORIA
FROM complaints c
LEFT JOIN (SELECT RECLAMO_ID, SUM(CASE WHEN p > 0 THEN 1 ELSE 0 END) AS pos, SUM(CASE WHEN p < 0 THEN 1 ELSE 0 END) AS neg
           FROM complaint_tokens JOIN lexicon USING (w) GROUP BY 1) s ON s.RECLAMO_ID = c.RECLAMO_ID
LEFT JOIN (SELECT RECLAMO_ID, label FROM (
             SELECT RECLAMO_ID, label, row_number() OVER (PARTITION BY RECLAMO_ID ORDER BY n DESC, rnk ASC) AS rn
             FROM (SELECT RECLAMO_ID, label, rnk, COUNT(*) AS n FROM complaint_tokens
                   JOIN category_keywords USING (w) GROUP BY 1, 2, 3)) WHERE rn = 1) k ON k.RECLAMO_ID = c.RECLAMO_ID
"""


def _scored(spark, sf_dir):
    c = bridge.complaints(spark, sf_dir).select("RECLAMO_ID", "TEXTO")
    s = analytics.sentiment(c, "RECLAMO_ID", "TEXTO")
    k = analytics.classify(c, "RECLAMO_ID", "TEXTO")
    return s.join(k, "RECLAMO_ID")


@query("complaints_analyzed", "D4,D5", with_ctes("""
SELECT CAST(RECLAMO_ID AS BIGINT) AS RECLAMO_ID, SENTIMIENTO, CATEGORIA FROM complaints_scored"""))
def q_complaints_analyzed(spark, sf_dir):
    """Sentiment (-1..1) and category of every document (whole texts)."""
    return _scored(spark, sf_dir)


@query("complaint_digest", "A12", with_ctes("""
SELECT string_agg(item, '; ' ORDER BY item) AS DIGEST FROM (
  SELECT coalesce(CATEGORIA, 'Sin categoría') || ' (' || CAST(round(avg(SENTIMIENTO), 2) AS VARCHAR) || ')' AS item
  FROM complaints_scored GROUP BY CATEGORIA)"""))
def q_complaint_digest(spark, sf_dir):
    """One line: each category with its mean sentiment (bounded: one item per category)."""
    return analytics.complaint_digest(_scored(spark, sf_dir))


CTES["complaint_sentences"] = """
SELECT RECLAMO_ID, pos, sentence FROM (
  SELECT RECLAMO_ID, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS pos
  FROM (SELECT RECLAMO_ID, regexp_split_to_array(TEXTO, '[.!?]+') AS parts FROM complaints))
WHERE trim(sentence) <> ''
"""
CTES["sentence_words"] = """
SELECT RECLAMO_ID, pos, w, count(*) AS n FROM (
  SELECT RECLAMO_ID, pos, unnest(regexp_split_to_array(lower(sentence), '[^\\p{L}]+')) AS w FROM complaint_sentences)
WHERE w <> '' GROUP BY ALL
"""


@query("complaint_summaries", "D6", with_ctes("""
WITH rated AS (
  SELECT RECLAMO_ID, pos, CAST(sum(n * tf) AS DOUBLE) / sum(n) AS score
  FROM sentence_words JOIN (SELECT RECLAMO_ID, w, sum(n) AS tf FROM sentence_words GROUP BY ALL) USING (RECLAMO_ID, w)
  GROUP BY ALL),
best AS (
  SELECT s.RECLAMO_ID, trim(s.sentence) AS RESUMEN
  FROM complaint_sentences s LEFT JOIN rated r ON r.RECLAMO_ID = s.RECLAMO_ID AND r.pos = s.pos
  QUALIFY row_number() OVER (PARTITION BY s.RECLAMO_ID ORDER BY coalesce(r.score, 0) DESC, s.pos) = 1)
SELECT CAST(c.RECLAMO_ID AS BIGINT) AS RECLAMO_ID, best.RESUMEN FROM complaints c LEFT JOIN best USING (RECLAMO_ID)"""))
def q_complaint_summaries(spark, sf_dir):
    """Extractive one-sentence summary of every document."""
    c = bridge.complaints(spark, sf_dir).select("RECLAMO_ID", "TEXTO")
    return analytics.summarize(c, "RECLAMO_ID", "TEXTO")


# ------------------------------------------------------------------ learned from seeds
CTES["text_words"] = """
SELECT DISTINCT doc_id, coalesce(lang, 'und') AS lang, w
FROM (SELECT doc_id, lang, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS w FROM documents) WHERE w <> ''
"""
CTES["label_seeds"] = """
WITH known AS (
  SELECT doc_id, t.lang, w, toxic = 0 AS good FROM text_words t JOIN labels USING (doc_id) WHERE toxic = 1 OR quality = 1),
sizes AS (SELECT lang, count(*) FILTER (good) AS ng, count(*) FILTER (NOT good) AS nb FROM (SELECT DISTINCT doc_id, lang, good FROM known) GROUP BY lang),
counts AS (SELECT lang, w, count(*) FILTER (good) AS g, count(*) FILTER (NOT good) AS b FROM known GROUP BY lang, w HAVING count(*) >= 3),
rated AS (SELECT lang, w, g * nb - b * ng AS gain FROM counts JOIN sizes USING (lang))
SELECT lang, w, p FROM (
  SELECT lang, w, 1 AS p, row_number() OVER (PARTITION BY lang ORDER BY gain DESC, w) AS r FROM rated WHERE gain > 0
  UNION ALL SELECT lang, w, -1, row_number() OVER (PARTITION BY lang ORDER BY gain, w) FROM rated WHERE gain < 0) WHERE r <= 20
"""


def _label_seeds(spark, sf_dir, docs):
    labels = bridge.table(spark, sf_dir, "labels").where("toxic = 1 or quality = 1").select("doc_id", (F.col("toxic") == 0).alias("good"))
    return learned.seeds_of_labels(learned.words(docs, "doc_id", "text", "lang"), labels, "doc_id")


@query("sentiment_learned", "D4", with_ctes("""
WITH sides AS (SELECT doc_id, lang, bool_or(p > 0) AS pos, bool_or(p < 0) AS neg FROM text_words JOIN label_seeds USING (lang, w) GROUP BY doc_id, lang),
n AS (SELECT lang, count(*) FILTER (pos) AS np, count(*) FILTER (neg) AS nn FROM sides GROUP BY lang),
counts AS (SELECT lang, w, count(*) FILTER (pos) AS cp, count(*) FILTER (neg) AS cn FROM text_words JOIN sides USING (doc_id, lang) GROUP BY lang, w HAVING count(*) >= 3),
pol AS (SELECT lang, w, CAST(round(ln(CAST((cp + 1) * (nn + 2) AS DOUBLE) / CAST((cn + 1) * (np + 2) AS DOUBLE)) * 1000) AS BIGINT) AS pol FROM counts JOIN n USING (lang)),
sums AS (SELECT doc_id, sum(pol) AS s, sum(abs(pol)) AS a FROM text_words JOIN pol USING (lang, w) GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, round(coalesce(CAST(s AS DOUBLE) / nullif(CAST(a AS DOUBLE), 0), 0), 4) AS SENTIMIENTO
FROM documents d LEFT JOIN sums USING (doc_id)"""))
def q_sentiment_learned(spark, sf_dir):
    """Sentiment of every document in its language; the seeds of each language are the words that most tell documents
    labelled good from those labelled toxic."""
    docs = bridge.table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return learned.sentiment(docs, "doc_id", "text", "lang", _label_seeds(spark, sf_dir, docs))


#: Categories by keywords; in texts of invented words, by the words at these ranks of frequency in each language too.
LABELS = [name for name, _ in analytics.CATEGORIES]
FIRST_RANK, LAST_RANK = 41, 80
_KEYWORDS = [(w, i) for i, (_, ws) in enumerate(analytics.CATEGORIES) for w in ws]
CTES["category_seeds"] = f"""
SELECT w, min(label) AS label FROM (
  SELECT * FROM (VALUES {", ".join(f"('{w}', {i})" for w, i in _KEYWORDS)}) v(w, label)
  UNION ALL
  SELECT w, CAST(r % 4 AS INTEGER) FROM (SELECT w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS r FROM text_words GROUP BY lang, w)
  WHERE r BETWEEN {FIRST_RANK} AND {LAST_RANK}) GROUP BY w
"""


def _bayes_sql(name: str, labels: str) -> str:
    """A round of the model: from (doc_id, label) to the labels it gives."""
    logs = ", ".join(f"CAST(round(ln(CAST(count(*) FILTER (label = {i}) + 1 AS DOUBLE) / (any_value(n{i}) + 2)) * 1000) AS BIGINT) AS l{i}" for i in range(4))
    sums = ", ".join(f"sum(l{i}) + CAST(round(ln((any_value(n{i}) + 1.0) / (any_value(n0 + n1 + n2 + n3) + 4)) * 1000) AS BIGINT) AS s{i}" for i in range(4))
    sizes = ", ".join(f"count(*) FILTER (label = {i}) AS n{i}" for i in range(4))
    best = " ".join(f"WHEN s{i} = greatest(s0, s1, s2, s3) THEN {i}" for i in range(4))
    return f"""
{name}_n AS (SELECT {sizes} FROM {labels}),
{name}_m AS (SELECT w, {logs} FROM text_words JOIN {labels} USING (doc_id), {name}_n GROUP BY w HAVING count(*) >= 2),
{name} AS (SELECT doc_id, CASE {best} END AS label FROM (SELECT doc_id, {sums} FROM text_words JOIN {name}_m USING (w), {name}_n GROUP BY doc_id))"""


_LEARN = "doc_id % 5 <> 0"


@query("categories_learned", "D5", with_ctes(f"""
WITH seeded AS (
  SELECT doc_id, label FROM (SELECT doc_id, label, count(*) AS n FROM text_words JOIN category_seeds USING (w) GROUP BY doc_id, label)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, label) = 1),
seeded_learn AS (SELECT * FROM seeded WHERE {_LEARN}),{_bayes_sql('first_round', 'seeded_learn')},
first_learn AS (SELECT * FROM first_round WHERE {_LEARN}),{_bayes_sql('second_round', 'first_learn')},
names AS (SELECT unnest({[*range(4)]}) AS label, unnest({LABELS}) AS name)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, a.name AS CATEGORIA, b.name AS SEED
FROM documents d LEFT JOIN second_round f USING (doc_id) LEFT JOIN names a ON a.label = f.label
LEFT JOIN seeded s ON s.doc_id = d.doc_id LEFT JOIN names b ON b.label = s.label"""))
def q_categories_learned(spark, sf_dir):
    """Category of every document by naive Bayes from seeds, learned from four of five documents; and the seeds' own."""
    docs = bridge.table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    tokens = learned.words(docs, "doc_id", "text", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    common = tokens.select("lang", F.explode("words").alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")).withColumn("r", rank).where(F.col("r") <= LAST_RANK)
    common = common.where(F.col("r") >= FIRST_RANK).select("w", (F.col("r") % 4).cast("int").alias("label"))
    seeds = spark.createDataFrame(_KEYWORDS, "w string, label int").union(common).groupBy("w").agg(F.min("label").alias("label"))
    return learned.seeded_bayes(docs, "doc_id", "text", "lang", seeds, LABELS, F.col("doc_id") % 5 == 0)
