"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.llm import chat, collocations, decontaminate, html_text, languages, neighbours, packing, quality, repair, simhash, substrings, tokens, urls
from saleswh.llm.tables import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document, and a digest of those kept."""
    kept = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    removed = F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return kept.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(words, 256).alias("kept_sha256"))


@query
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words hit, items found and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.matched(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.counted(docs, public_tokenizers.path("piece_bpe_32k.model"))


#: Fixed rules of the contract: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query
def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op5_url_filters"] = """
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
  SELECT parts.*, h || p AS rule, verdict, length(h || p) AS fit
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN verdict
    WHEN regexp_matches('.' || host || path, '^[^/]*\\.ads[.-]|^[^/]*\\.adserver\\.|/ads/') THEN 'block' ELSE 'allow' END AS verdict
FROM fitting QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY fit DESC) = 1
"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))  # without an id: not held out
    docs = table(spark, sf_dir, "documents")
    model = languages.fit(docs.where(~held).select("text", "lang"))
    return languages.predicted(docs.select("doc_id", held.alias("held_out"), "text"), model)


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extracted(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars")


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant; the mask as start:length pairs."""
    views = chat.rotated(table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["length"])), ",")
    return views.select("conv_id", "participant", "part", "sub", "n_messages", "text", mask.alias("mask"))


ORACLE_SQL["op2_chat_formatting"] = """
WITH RECURSIVE m AS (
  SELECT DISTINCT conv_id, CAST(floor(turn / 64) AS BIGINT) AS part, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body
  FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS participant FROM m WHERE speaker <> 'system'),
turns AS (
  SELECT conv_id, part, turn, count(*) AS n, row_number() OVER (PARTITION BY conv_id, part ORDER BY turn) AS i
  FROM m GROUP BY conv_id, part, turn),
dealt AS (
  SELECT conv_id, part, turn, i, CAST(0 AS BIGINT) AS first, (n + 255) // 256 - 1 AS last, least(n, 256) AS held FROM turns WHERE i = 1
  UNION ALL
  SELECT t.conv_id, t.part, t.turn, t.i,
    if(d.held + t.n <= 256, d.last, d.last + 1), if(d.held + t.n <= 256, d.last, d.last + 1) + (t.n + 255) // 256 - 1,
    if(d.held + t.n <= 256, d.held + t.n, least(t.n, 256))
  FROM dealt d JOIN turns t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND t.part IS NOT DISTINCT FROM d.part AND t.i = d.i + 1),
subs AS (
  SELECT m.conv_id, m.part, m.turn, speaker, body, CAST(first + (row_number() OVER (PARTITION BY m.conv_id, m.turn ORDER BY speaker, body) - 1) // 256 AS BIGINT) AS sub
  FROM m JOIN dealt d ON d.conv_id IS NOT DISTINCT FROM m.conv_id AND d.turn IS NOT DISTINCT FROM m.turn),
s AS (
  SELECT subs.*, participant,
    CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = participant THEN '<|assistant|>'
      ELSE '<|user name=' || replace(speaker, '<|', '< |') || '|>' END || chr(10) AS head,
    replace(body, '<|', '< |') || '<|end|>' AS tail
  FROM subs JOIN who ON subs.conv_id IS NOT DISTINCT FROM who.conv_id),
placed AS (
  SELECT *, length(tail) AS size, length(head) + coalesce(sum(length(head) + length(tail) + 1) OVER (
    PARTITION BY conv_id, participant, part, sub ORDER BY turn, speaker, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM s)
SELECT conv_id, participant, part, sub, count(*) AS n_messages,
  string_agg(head || tail || chr(10), '' ORDER BY turn, speaker, body) AS text,
  coalesce(string_agg(CAST(start AS BIGINT) || ':' || size, ',' ORDER BY turn, speaker, body) FILTER (WHERE speaker = participant), '') AS mask
FROM placed GROUP BY conv_id, participant, part, sub
"""


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_phrase_collocations"] = r"""
WITH words AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
runs AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30),
found AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
inner_runs AS (SELECT lang, a, w, m, s, unnest(range(1, m - s + 2)) AS i FROM found, (VALUES (2), (3)) AS shorter(s) WHERE s < m),
around AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer FROM inner_runs GROUP BY ALL),
kept AS (SELECT found.* FROM found LEFT JOIN around USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, p.f AS l, q.f AS r, (2000000::HUGEINT * a) // (p.f + q.f)::HUGEINT AS score
  FROM cuts JOIN f p ON p.lang = cuts.lang AND p.phrase = array_to_string(cuts.w[1:k], ' ')
  JOIN f q ON q.lang = cuts.lang AND q.phrase = array_to_string(cuts.w[k + 1:cuts.m], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cost, audit and digest of every conversation, damaged and repaired."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair.audited(repair.damaged(given)).withColumnRenamed("conv_id", "g")
    every = given.select("conv_id").distinct().join(fixed, F.col("conv_id").eqNullSafe(F.col("g")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
