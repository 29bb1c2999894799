"""The queries of this package and their SQL counterparts."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickermood.llm import embedding_dedup, simhash
from tickermood.llm.html_text import extract_text
from tickermood.llm.line_dedup import dedup_lines
from tickermood.llm.packing import pack_documents
from tickermood.llm.quality_rules import quality_verdicts
from tickermood.llm.secret_scan import scan_secrets
from tickermood.llm.sentence_pieces import decoded, encoded
from tickermood.llm.source_divergence import divergence
from tickermood.llm.suffix_dedup import without_repeats
from tickermood.llm.toxicity import toxicity_scores
from tickermood.llm.url_filters import PATTERN_RULES, url_verdicts
from tickermood.llm.whitening import whitened


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark, sf_dir) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_sentencepiece(spark, sf_dir) -> DataFrame:
    """Ids of every whole text, and a digest of what they decode to."""
    found = decoded(encoded(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("text", 256).alias("decoded_sha256")
    )


def op3_html_extraction(spark, sf_dir) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op4_simhash(spark, sf_dir) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_url_filters(spark, sf_dir) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_embedding_dedup(spark, sf_dir) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_packing(spark, sf_dir) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark, sf_dir) -> DataFrame:
    docs = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return docs.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op9_secret_scan(spark, sf_dir) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_suffix_dedup(spark, sf_dir) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_whitening(spark, sf_dir) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark, sf_dir) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_html_extraction": op3_html_extraction,
    "op4_simhash": op4_simhash,
    "op5_url_filters": op5_url_filters,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_toxicity": op10_toxicity,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_whitening": op12_whitening,
    "op13_source_divergence": op13_source_divergence,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_PATTERNS = " OR ".join(f"regexp_matches(lower(url), '{pattern}')" for _, pattern, _ in PATTERN_RULES)

_RULES = ["few_words", "repeated_words", "symbols", "repeated_lines"]

_OP1 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS body FROM documents
), cut AS (
  SELECT row_id, doc_id, source, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(body, chr(10)), lambda l: length(trim(l, {_SPACES})) > 0) AS lines
  FROM texts
), windows AS (
  SELECT row_id, i, struct_pack(a := words[i], b := words[i + 1], c := words[i + 2]) AS w
  FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM cut)
), twice AS (
  SELECT row_id, w FROM windows GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + step) AS n_repeat_words
  FROM (SELECT row_id, i FROM windows SEMI JOIN twice USING (row_id, w)), (VALUES (0), (1), (2)) s(step) GROUP BY row_id
), measures AS (
  SELECT doc_id, source, len(words) AS n_words,
    length(body) - length(regexp_replace(body, '[^\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_text_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (row_id)
), failures AS (
  SELECT *, n_words < 50 AS few_words, 100 * n_repeat_words > 50 * n_words AS repeated_words,
    10 * n_symbols > word_chars AS symbols, 10 * n_dup_lines > 3 * n_text_lines AS repeated_lines
  FROM measures
), hosts AS (
  SELECT source AS host, count(*) AS n_docs, {", ".join(f"count(*) FILTER ({r}) AS {r}" for r in _RULES)}
  FROM failures WHERE source IS NOT NULL GROUP BY source
), moments AS (
  SELECT sum(n_docs) AS n, count(*) AS k, {", ".join(f"sum({r}) / sum(n_docs) AS {r}_m, sum({r} * {r} / n_docs) / sum(n_docs) AS {r}_q" for r in _RULES)}
  FROM hosts
), prior AS (
  SELECT {", ".join(f"{r}_m AS {r}_m, least(greatest(coalesce({r}_m * (1 - {r}_m) / nullif(greatest({r}_q - {r}_m * {r}_m - {r}_m * (1 - {r}_m) * k / n, 1e-9), 0), 0) - 1, 2.0), 1e6) AS {r}_s" for r in _RULES)}
  FROM moments
), rates AS (
  SELECT host, {", ".join(f"({r} + {r}_m * {r}_s) / (n_docs + {r}_s) AS {r}_r, {r}_m, sqrt({r}_m * (1 - {r}_m) / ({r}_s + 1)) AS {r}_d" for r in _RULES)}
  FROM hosts, prior
), verdicts AS (
  SELECT host, {" OR ".join(f"{r}_r > {r}_m + 2 * {r}_d" for r in _RULES)} AS suspect,
    {" OR ".join(f"({r}_r > {r}_m + {r}_d AND {r}_r >= 0.5)" for r in _RULES)} AS condemned
  FROM rates
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  few_words OR repeated_words AS base_failed,
  NOT (few_words OR repeated_words OR coalesce(condemned, false)
    OR (coalesce(suspect, true) AND (symbols OR repeated_lines))) AS kept
FROM failures LEFT JOIN verdicts ON source = host
"""

_OP5 = f"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) END AS rest FROM pages)
), rules(verdict, rule, rule_host, rule_path) AS (VALUES
  ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), judged AS (
  SELECT page_id, url, host, path, (
    SELECT max(struct_pack(size := length(rule), rule := rule, verdict := verdict)) FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS fit
  FROM parts
)
SELECT page_id, host, path, fit.rule AS rule,
  coalesce(fit.verdict, CASE WHEN {_PATTERNS} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged
"""

_OP6 = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row_id, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT row_id, vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM vectors
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.row_id, a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.row_id <> b.row_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(node, seen) AS (
  SELECT DISTINCT a, a FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), roots AS (
  SELECT node, min(seen) AS root FROM reach GROUP BY node
), counts AS (
  SELECT row_id, count(*) AS n FROM links GROUP BY row_id
)
SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(root, v.vec_id) AS component_id,
  v.vec_id = coalesce(root, v.vec_id) AS kept
FROM vectors v LEFT JOIN counts USING (row_id) LEFT JOIN roots ON v.vec_id = node
"""

_OP8 = f"""
WITH cut AS (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT row_id, doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM cut
), keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_id) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY row_id
"""

_OP11 = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, row_number() OVER (ORDER BY doc_id NULLS LAST) AS place FROM documents
), grams AS (
  SELECT place, s, md5_number(substring(h, 2 * s + 1, 200)) AS gram
  FROM (SELECT place, h, unnest(range(length(h) // 2 - 99)) AS s FROM texts WHERE length(h) >= 200)
), later AS (
  SELECT place, s FROM (SELECT place, s, row_number() OVER (PARTITION BY gram ORDER BY place, s) AS nth FROM grams) WHERE nth > 1
), marked AS (
  SELECT place, s, coalesce(s > lag(s) OVER w + 100, true) AS new FROM later WINDOW w AS (PARTITION BY place ORDER BY s)
), runs AS (
  SELECT place, min(s) AS a, max(s) + 100 AS b
  FROM (SELECT place, s, count(*) FILTER (new) OVER (PARTITION BY place ORDER BY s) AS run FROM marked) GROUP BY place, run
), pieces AS (
  SELECT place, coalesce(lag(b) OVER (PARTITION BY place ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL SELECT place, max(b), NULL FROM runs GROUP BY place
), kept AS (
  SELECT place, string_agg(substring(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
  FROM pieces JOIN texts USING (place) GROUP BY place
), sums AS (
  SELECT place, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY place
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM texts LEFT JOIN sums USING (place) LEFT JOIN kept USING (place)
"""

_OP13 = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), terms AS (
  SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN terms USING (lang, term) GROUP BY ALL
), dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER g AS total, count(*) OVER g AS v
  FROM groups JOIN terms USING (lang) LEFT JOIN counts USING (lang, source, term) WINDOW g AS (PARTITION BY lang, source)
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5) // (total + 5 * v) AS p FROM dense
), langs AS (
  SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total, count(*) OVER (PARTITION BY lang) AS v
  FROM dense GROUP BY lang, term
), base AS (
  SELECT lang, term, 1 + 1000000000 * (n + 5) // (total + 5 * v) AS q FROM langs
), apart AS (
  SELECT lang, a.source AS source, b.source AS item, sum(abs(a.p - b.p)) AS d
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang AS lang, a.source AS source, b.source AS item, coalesce(d, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
), items AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares JOIN base USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM items
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op1_quality_rules": _OP1,
    "op5_url_filters": _OP5,
    "op6_embedding_dedup": _OP6,
    "op8_line_dedup": _OP8,
    "op11_suffix_dedup": _OP11,
    "op13_source_divergence": _OP13,
}
