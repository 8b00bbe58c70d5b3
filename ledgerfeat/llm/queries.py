"""Registered queries of the corpus operators with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfeat.llm import chat_format, collocations, decontaminate, fingerprints, html_extract, lexical_search, lm_score, mixing, near_dedup, ngram_join, quality, substring_dedup, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op3_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and of their edits by the next document."""
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probabilities of all texts under the maximum-entropy model."""
    return lm_score.lm_scores(table(spark, folder, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in all documents."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "contaminated", F.size("items").cast("long").alias("n_items"), "items")


def op6_toxicity_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all texts, learned from the labels outside the held-out part."""
    docs = table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All texts without the passages that an earlier document holds as well."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract_pages(table(spark, folder, "pages"))


#: A conversation whose texts are full of control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """What the examples of all conversations hold when they are read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.inline(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(CONTROL_TEXT).alias("text"))
                           for i, role in enumerate(("user", "assistant"))])))
    return chat_format.read_back(chat_format.chat_examples(turns.unionByName(control)))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of five-word shingles are at least 85 % alike."""
    groups = near_dedup.near_duplicate_groups(table(spark, folder, "documents"), percent=85)
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all texts, learned from the labels outside the held-out part."""
    docs = table(spark, folder, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, folder, "labels")))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    return mixing.mix(table(spark, folder, "documents")).drop("source")


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by sets of four-word shingles that are at least 85 % alike."""
    return ngram_join.ngram_join_groups(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases of two and three words that stand together more often than their parts, for every language."""
    return collocations.collocations(table(spark, folder, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DEDUP_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS v FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS common
  FROM shingles x JOIN shingles y ON x.v = y.v AND x.doc_id <> y.doc_id GROUP BY 1, 2),
edges AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)),
reach(node, seen) AS (SELECT doc_id, doc_id FROM sets UNION SELECT e.b, r.seen FROM reach r JOIN edges e ON e.a = r.node),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON l.node = s.doc_id
"""

JOIN_SQL = (NEAR_DEDUP_SQL.replace("len(w) < 5", "len(w) < 4").replace("w[i:i + 4]", "w[i:i + 3]").replace("len(w) - 3)", "len(w) - 2)")
            .replace(", s.doc_id = l.component_id AS kept", ""))


SUBSTRING_SQL = r"""
WITH pieces AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS p,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, place, array_to_string(w[place:place + 49], ' ') AS v
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS place FROM pieces)),
firsts AS (SELECT v, min(doc_id) AS first FROM windows GROUP BY v HAVING min(doc_id) < max(doc_id)),
later AS (SELECT doc_id, place FROM windows JOIN firsts USING (v) WHERE doc_id <> first),
words AS (
  SELECT doc_id, place, piece, max(l.place) OVER (PARTITION BY doc_id ORDER BY place) AS latest
  FROM (SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS place FROM pieces) LEFT JOIN later l USING (doc_id, place)),
cut AS (
  SELECT doc_id, coalesce(string_agg(piece, '' ORDER BY place) FILTER (latest IS NULL OR latest < place - 49), '') AS rest,
    count(*) FILTER (latest >= place - 49) AS removed_words FROM words GROUP BY doc_id)
SELECT p.doc_id, regexp_extract(p.text, '^[\x20\x09-\x0D]*') || coalesce(c.rest, '') AS text,
  coalesce(c.removed_words, 0) AS removed_words,
  length(regexp_extract(p.text, '^[\x20\x09-\x0D]*') || coalesce(c.rest, '')) AS n_chars
FROM pieces p LEFT JOIN cut c ON p.doc_id = c.doc_id
"""

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
placed AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
    sum(length(role) + len(regexp_extract_all(role, '[\\<>]')) + length(text) + len(regexp_extract_all(text, '[\\<>]')) + 17)
      OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR place = turns))::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    0.1::DOUBLE + 0.9::DOUBLE * coalesce(length(regexp_replace(text, '[^\p{L} ]+', '', 'g'))::DOUBLE / greatest(length(text), 1), 0.0)
      AS weight,
    (('0x' || md5(coalesce(doc_id::VARCHAR, 'null') || ':17:' || md5(coalesce(text, ''))) [1:12])::BIGINT::DOUBLE + 0.5)
      / 281474976710656.0::DOUBLE AS u
  FROM documents),
keyed AS (SELECT doc_id, source, size, -ln(u) / greatest(weight, 1e-9) AS key FROM sized),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM keyed GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][(place % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM sources),
filled AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM weighed),
level AS (
  SELECT arg_min((budget - capped) / open, (cap / weight, place)) AS level FROM filled
  WHERE (budget - capped) / open * weight <= cap),
targets AS (
  SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM filled, level),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM targets),
ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.passes,
    floor(p.target - p.passes * p.source_size)::BIGINT AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN passes p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM ordered
"""

SEARCH_SQL = rf"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS place, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
sized AS (SELECT place, doc_id, len(t)::BIGINT AS n, t FROM doc_terms WHERE len(t) > 0),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sized),
item_terms AS (
  SELECT item_id, item, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
tf AS (
  SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(t) AS term FROM sized)
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, whole GROUP BY term, documents),
gains AS (
  SELECT s.doc_id, s.place, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))) AS gain
  FROM tf JOIN sized s USING (place) JOIN weights USING (term), whole),
scores AS (
  SELECT item_id, item, doc_id, place, sum(times * gain)::BIGINT AS score
  FROM item_terms JOIN gains USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""

COLLOCATION_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest([array_to_string(w[i:i + 1], ' ') FOR i IN range(1, len(w))]) FROM words
  UNION ALL SELECT lang, 3, unnest([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) FROM words),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.k AS cut, l.f AS l, r.f AS r, 1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f) AS score
  FROM candidates c JOIN (VALUES (1), (2)) x(k) ON x.k < c.k
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:x.k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[x.k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3)
  GROUP BY lang, phrase),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN inner_phrases i ON i.lang = o.lang AND i.phrase = o.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * o.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
  l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def queries() -> dict[str, Query]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_source_mixing": op2_source_mixing,
        "op3_syncmer_fingerprints": op3_syncmer_fingerprints,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_benchmark_decontamination": op5_benchmark_decontamination,
        "op6_toxicity_classifier": op6_toxicity_classifier,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_html_extraction": op8_html_extraction,
        "op9_chat_formatting": op9_chat_formatting,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
        "op12_lexical_search": op12_lexical_search,
        "op13_phrase_collocations": op13_phrase_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixing": MIXING_SQL,
        "op7_substring_dedup": SUBSTRING_SQL,
        "op9_chat_formatting": CHAT_SQL,
        "op10_minhash_near_dedup": NEAR_DEDUP_SQL,
        "op11_ngram_jaccard_join": JOIN_SQL,
        "op12_lexical_search": SEARCH_SQL,
        "op13_phrase_collocations": COLLOCATION_SQL,
    }
