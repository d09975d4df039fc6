"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimforge.llm import archive, embedding_dedup, fill_middle, langid, lexical, line_quality, simhash, toxicity
from dimforge.llm.common import ship
from dimforge.llm.fingerprints import fingerprint_documents
from dimforge.llm.mixing import mixture
from dimforge.llm.packing import pack
from dimforge.llm.token_counts import token_counts
from dimforge.llm.token_files import token_digest


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, distance 4 or less."""
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), words_each=4, radius=4)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return token_digest(_read(spark, sf_dir, "documents"), end_id=2)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return pack(_read(spark, sf_dir, "documents"), end_id=0, capacity=1024)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive of all pages, written and read back."""
    return archive.facts(archive.write_archive(_read(spark, sf_dir, "pages"), least=100))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings, cosine 0.98 or more within a label."""
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return langid.identified(_read(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of all documents."""
    return token_counts(_read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.scored(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), threshold=0.7)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix."""
    return mixture(_read(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of all documents, their edited texts and likenesses."""
    return fingerprint_documents(_read(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of all documents, cut at line ends, and the texts restored from it."""
    return fill_middle.digest(_read(spark, sf_dir, "documents"), fill_middle.Shape(seed=7, rate=100, spm=50))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item, over an index of all documents."""
    return lexical.ranked(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=10)


def op13_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of all documents, and whether they hold without the common lines of their source."""
    return line_quality.verdicts(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_embeddings": op5_embeddings,
    "op6_language": op6_language,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_fingerprints": op10_fingerprints,
    "op11_fill_middle": op11_fill_middle,
    "op12_lexical_search": op12_lexical_search,
    "op13_line_quality": op13_line_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
ranked AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM ranked""",
    "op5_embeddings": """
WITH RECURSIVE units AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len([x FOR x IN embedding IF x <> 0]) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, CAST((SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS BIGINT) AS n_links,
  min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id GROUP BY e.vec_id""",
    "op11_fill_middle": """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
lines AS (
  SELECT *, string_split(t, chr(10)) AS parts,
    CAST(length(t) - length(replace(t, chr(10), '')) + CASE WHEN t <> '' AND NOT ends_with(t, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS n
  FROM texts),
draws AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
    CAST('0x' || h[25:32] AS BIGINT) % 100 AS side FROM lines),
cuts AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN side < 50 THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN least(c1, c2) = 0 THEN '' WHEN least(c1, c2) = n THEN t
      ELSE array_to_string(parts[1:least(c1, c2)], chr(10)) || chr(10) END AS p,
    CASE WHEN greatest(c1, c2) = 0 THEN '' WHEN greatest(c1, c2) = n THEN t
      ELSE array_to_string(parts[1:greatest(c1, c2)], chr(10)) || chr(10) END AS pm
  FROM draws),
pieces AS (SELECT *, substr(pm, length(p) + 1) AS m, substr(t, length(pm) + 1) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM pieces""",
    "op12_lexical_search": """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term),
norms AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // total AS m FROM lengths, whole),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10""",
    "op13_line_quality": """
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
placed AS (SELECT k, words, unnest(range(1, len(words) - 3)) AS i FROM texts WHERE len(words) >= 5),
windows AS (SELECT k, i, words[i:i + 4] AS win FROM placed),
twice AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, win) AS times FROM windows) WHERE times > 1),
covered AS (SELECT k, count(DISTINCT pos) AS n FROM (SELECT k, unnest(range(i, i + 5)) AS pos FROM twice) GROUP BY k),
raw_lines AS (SELECT k, source, t, unnest(string_split(t, chr(10))) AS line FROM texts),
lines AS (
  SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words,
    translate(array_to_string(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM raw_lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dups AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY k),
hosts AS (SELECT source, count(DISTINCT t) AS host_docs FROM texts GROUP BY source),
common AS (
  SELECT l.source, norm, count(DISTINCT t) AS n_docs, any_value(host_docs) AS host_docs
  FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source GROUP BY l.source, norm
  HAVING count(DISTINCT t) > 5 AND count(DISTINCT t) > 0.01 * any_value(host_docs)),
lost AS (
  SELECT k, sum(len(words)) AS n FROM lines l JOIN common c ON l.norm = c.norm AND l.source IS NOT DISTINCT FROM c.source GROUP BY k),
facts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(words) - coalesce(lost.n, 0) AS BIGINT) AS words_left
  FROM texts LEFT JOIN dups USING (k) LEFT JOIN covered USING (k) LEFT JOIN lost USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND words_left >= 10 AND words_left >= 0.3 * n_words AS kept,
  words_left
FROM facts""",
}
