"""The queries of the training-data operators on the given tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm import (
    bpe, decontaminate, grid_join, hard_negatives, html_text, impact_index, licenses, line_dedup,
    near_copies, quality, token_counts, toxicity, whitening,
)
from yearloom.llm.common import held_out, table
from yearloom.session import scratch_path, store

QUALITY = 0.3  # scores from which a document passes
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MANY_WORDS = 400_000  # that a worker remembers where no other stage shares its memory


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, WORD_BPE, decoded="decoded", words=MANY_WORDS)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def known_labels(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """The largest label of each document that models may learn from."""
    known = table(spark, folder, "labels").where(~held_out("doc_id") & F.col(label).isin(0, 1))
    return known.groupBy("doc_id").agg(F.max(label).alias(label))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the passages that others hold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.cut(docs).select(
        "doc_id",
        F.col("cut.lines").alias("n_lines"),
        F.col("cut.gone").alias("n_removed"),
        F.length("cut.text").cast("long").alias("n_chars"),
        F.sha2("cut.text", 256).alias("text_sha256"),
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence mentions of every document."""
    return licenses.scan(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, known_labels(spark, folder, "toxic"))
    return toxicity.score(docs, net).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of 4-word shingles are nearly equal."""
    return near_copies.find(table(spark, folder, "documents"), size=4)


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_grid_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of embeddings of a label that point in nearly the same direction."""
    return grid_join.find(table(spark, folder, "embeddings"))


TOKEN_LIMIT = 2048


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, from an empty cache."""
    docs = table(spark, folder, "documents")
    sized = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = token_counts.count(sized, WORD_BPE, scratch_path(spark, "token-counts"))
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Discriminant:
    """Learned from all documents (``doc_id``, ``features``) with a label."""
    rows = docs.select("doc_id", "features").join(labels, "doc_id")
    return quality.fit(rows, "quality")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labelled ones that are not held out."""
    docs = quality.features(table(spark, folder, "documents").select("doc_id", "text"))
    docs = store(docs.select("doc_id", "features"), "quality")
    model = quality_model(docs, known_labels(spark, folder, "quality"))
    return quality.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The words of every document that lie in a window of a benchmark item."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, folder, "benchmark"))
    hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "found.n_words",
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of other labels that score nearly as high as an anchor's best ones of its own."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five best vectors for every fiftieth one."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    queries = impact_index.build(vectors.where(F.col("vec_id") % 50 == 0))
    found = impact_index.search(impact_index.build(vectors), queries)
    return found.withColumnRenamed("id", "vec_id")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector along the four leading components, each scaled to variance one."""
    found = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_licenses": op3_licenses,
    "op4_toxicity": op4_toxicity,
    "op5_near_copies": op5_near_copies,
    "op6_html_text": op6_html_text,
    "op7_grid_join": op7_grid_join,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_decontaminate": op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_impact_search": op12_impact_search,
    "op13_whitening": op13_whitening,
}

# Words of lower-cased text, for DuckDB.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

# Vectors of whole numbers, for DuckDB.
_WHOLE = """
SELECT vec_id, {label} AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
FROM embeddings
WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"""

_TEMPLATES = ", ".join(
    f"({k}, '{label}', {base}, string_split('{words}', ' '))"
    for k, (label, base, words) in enumerate(licenses.TEMPLATES)
)

ORACLE: dict[str, str] = {
    "op3_licenses": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_TEMPLATES}) AS v(template, label, base, w)),
grams AS (
  SELECT template, label, base, len(w) - 1 AS pairs, i - 1 AS place, w[i] AS a, w[i + 1] AS b
  FROM t, unnest(range(1, len(w))) AS s(i)),
places AS (SELECT r, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM d, unnest(range(1, len(w))) AS s(i)),
matches AS (SELECT r, template, label, base, pairs, pos, place FROM places JOIN grams USING (a, b)),
-- Every diagonal with a match begins a span; a place of the template counts where it stands first in it.
firsts AS (
  SELECT m.r, m.template, m.label, m.base, m.pairs, d.start, m.place, min(m.pos) AS pos
  FROM (SELECT DISTINCT r, template, pos - place AS start FROM matches) d
  JOIN matches m ON m.r = d.r AND m.template = d.template
    AND m.pos - m.place BETWEEN d.start AND d.start + CASE WHEN m.base THEN 0 ELSE {licenses.DRIFT} END
  GROUP BY ALL),
-- And only if it comes after all earlier places of the template.
ordered AS (
  SELECT *, pos > coalesce(max(pos) OVER (PARTITION BY r, template, start ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS follows FROM firsts),
spans AS (
  SELECT r, label, base, start, count(*) FILTER (follows) / pairs AS share,
    CASE WHEN base THEN count(*) FILTER (follows) = pairs
      ELSE count(*) FILTER (follows) >= {licenses.VOTES} AND count(*) FILTER (follows) / pairs >= {licenses.SHARE} END AS found
  FROM ordered GROUP BY r, template, label, base, pairs, start),
rows AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM spans WHERE found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN rows USING (r)
""",
    "op11_hard_negatives": f"""
WITH v AS (SELECT * FROM ({_WHOLE.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")})
  WHERE label IS NOT NULL),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)::INTEGER AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
    "op12_impact_search": f"""
WITH v AS ({_WHOLE.format(label="NULL")}),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score
FROM scores QUALIFY rank <= 5
""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM sized, unnest(range(1, len(w) - n + 2)) AS s(i)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS s(i)),
hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, gram)),
words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(0, n)) AS s(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
