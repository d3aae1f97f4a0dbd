"""The queries of the corpus operators over the test tables, and their checking SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    chat, fingerprints, html_main, mixing, packing, quality, ranking, runs, simhash, substrings, suffixes, vectors, warc,
)
from riskloom.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens."""
    pieces = packing.cut_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    # The checksum is taken where the ids are read, so that they need not move.
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "slice", "rank")
    return packing.place_pieces(slim)


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of marks only, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], turns.schema)
    made = chat.format_conversations(turns.unionByName(more))
    back = chat.parse(F.col("formatted"))
    said = F.concat_ws("", F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return made.select(
        "conv_id", F.size(back).cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.held_out().alias("held_out"), model.score(F.col("text")).alias("score")).select(
        "*", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document go into the mix."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC, normalised, and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_main.extract(table(spark, sf_dir, "pages")).select("*", F.length("text").cast("long").alias("n_chars"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand earlier."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited text."""
    return fingerprints.fingerprint(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that stand anywhere else."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words of all documents, every tenth of which is made to repeat a passage."""
    found = runs.periodic_runs(runs.with_repeating_tails(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
plain AS (SELECT *, '[INST] ' || role || ' [/INST] ' || text || ' </s>' AS form FROM turns),
told AS (
  SELECT *, strpos(form, ' </s>') = length(form) - 4 AND strpos(form, ' [/INST] ') = 8 + length(role)
    AND NOT regexp_matches(role, '\\(?:\[/?INST\]|</?s>)') AND NOT regexp_matches(text, '\\(?:\[/?INST\]|</?s>)') AS same
  FROM plain),
sized AS (
  SELECT *, CASE WHEN same THEN length(form) ELSE 21 + length(regexp_replace(role, '(\\*(?:\[/?INST\]|</?s>))', '\\\1', 'g'))
    + length(regexp_replace(text, '(\\*(?:\[/?INST\]|</?s>))', '\\\1', 'g')) END AS chars FROM told),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(chars) AS chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM whole
"""

# The limit of a source is 3 times its size. Of the sources ordered by limit per weight, those are at their
# limit that come before the level at which the rest share what is left by weight.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
sources AS (SELECT source, sum(size)::HUGEINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 3 * source_size AS top,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::HUGEINT AS weight FROM sources),
summed AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(top) OVER w, 0) AS tops, coalesce(sum(weight) OVER w, 0) AS weights
  FROM weighed WINDOW w AS (ORDER BY top / weight::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (total - tops) AS rest, (all_weight - weights) AS share FROM summed
  WHERE top * (all_weight - weights) > weight * (total - tops) ORDER BY top / weight::DOUBLE LIMIT 1),
goals AS (
  SELECT source, source_size, CASE WHEN rest IS NULL OR top * share <= weight * rest THEN top::DOUBLE
    ELSE weight::DOUBLE * rest::DOUBLE / share::DOUBLE END AS target
  FROM weighed LEFT JOIN level ON true),
placed AS (
  SELECT s.*, g.source_size, g.target, floor(g.target)::HUGEINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
turned AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + least(greatest(budget - epochs * source_size - place, 0), size) AS BIGINT) AS taken
FROM turned
"""

VECTOR_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine FROM embeddings),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.fine AND b.fine AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN lowest ON lowest.a = v.vec_id LEFT JOIN degree ON degree.a = v.vec_id
"""

WARC_SQL = r"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w FROM starts),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
away AS (SELECT doc_id, unnest(places) AS p FROM gone),
kept AS (
  SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.p) AS text, count(*) AS n
  FROM each LEFT JOIN away ON each.doc_id = away.doc_id AND each.p = away.p WHERE away.p IS NULL GROUP BY each.doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

RANKING_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
docs AS (SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
asked AS (
  SELECT qid, item_id, term, count(*) AS qtf FROM (
    SELECT item_id, row_number() OVER () AS qid, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counts, total WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scores AS (
  SELECT qid, item_id, row, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN docs USING (row), total GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_chat_formatting": chat_formatting,
    "op3_quality_classifier": quality_scores,
    "op4_source_mixing": source_mixing,
    "op5_embedding_dedup": embedding_dedup,
    "op6_warc": warc_archive,
    "op7_simhash_dedup": simhash_dedup,
    "op8_html_extraction": html_extraction,
    "op9_substring_dedup": substring_dedup,
    "op10_document_fingerprints": document_fingerprints,
    "op11_lexical_search": lexical_search,
    "op12_suffix_dedup": suffix_dedup,
    "op13_periodic_runs": periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": CHAT_SQL,
    "op4_source_mixing": MIX_SQL,
    "op5_embedding_dedup": VECTOR_SQL,
    "op6_warc": WARC_SQL,
    "op9_substring_dedup": SUBSTRING_SQL,
    "op11_lexical_search": RANKING_SQL,
}
