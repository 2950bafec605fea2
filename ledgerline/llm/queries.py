"""Queries of this subpackage, one per operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, chat, collocations, decontam, html_main, kdtree, langid, line_dedup, minhash, mixing, packing, repair, token_count
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def byte_bpe() -> str:
    """Path of the byte-level BPE vocabulary."""
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from the formatted output.

    Conversation -7 is added: its texts are control strings of chat templates.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(chat.format_turns(turns.union(probe), byte_bpe()), byte_bpe())


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at 85 percent similarity of 5-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("row")


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents for the piece vocabulary."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.predict(docs, model).drop("row")


@query
def op5_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written bit-packed and read back."""
    out = scratch_path(spark, "llm", f"packed-{uuid.uuid4().hex[:12]}")
    return packing.read_packed(spark, packing.write_packed(table(spark, sf_dir, "documents"), out, byte_bpe()))


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents, one row per document and item."""
    return decontam.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


@query
def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level BPE and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe())


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated three-line passages: line counts and a digest of the text that is left."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


@query
def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.train(pages))


@query
def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector against all others."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


@query
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 by source: the words that the mix takes of each."""
    return mixing.document_totals(mixing.mix(table(spark, sf_dir, "documents")))


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to four words of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after the stated damage, their faults and cheapest repairs."""
    return repair.repair(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op2_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 85 * (nx + ny - c)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN roots r USING (doc_id)
"""

ORACLE_SQL["op1_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(<SYS>>|</SYS>>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\]|s>|/s>)', '\1\2|\3', 'g'))
    + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""

_LINES = r"""
lines AS (
  SELECT doc_id, i, trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') AS line, line AS raw FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM {docs})),
solid AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines WHERE line <> ''),
windows AS (
  SELECT a.doc_id, a.k, a.line || chr(10) || b.line || chr(10) || c.line AS w
  FROM solid a JOIN solid b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN solid c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, k) AS place FROM windows),
gone AS (SELECT DISTINCT s.doc_id, s.i FROM ranked r JOIN solid s ON s.doc_id = r.doc_id AND s.k BETWEEN r.k AND r.k + 2 WHERE r.place > 1),
cut AS (
  SELECT l.doc_id, count(*) FILTER (l.line <> '') AS n_lines, count(g.i) AS n_removed,
    coalesce(string_agg(l.raw, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
"""
ORACLE_SQL["op8_line_dedup"] = "WITH " + _LINES.format(docs="documents") + """
SELECT doc_id, n_lines, n_removed, length(text)::BIGINT AS n_chars, sha256(text) AS text_sha256 FROM cut
"""

ORACLE_SQL["op10_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE_SQL["op11_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM sources),
-- a source is at its bound when giving every source the same multiple of its weight up to there stays within the share
tried AS (
  SELECT a.source, a.source_size, a.weight,
    sum(least(2 * b.source_size * a.weight, 2 * a.source_size * b.weight)) * 2 <= 3 * a.weight * sum(b.source_size) AS bounded
  FROM weighed a CROSS JOIN weighed b GROUP BY a.source, a.source_size, a.weight),
shared AS (
  SELECT coalesce(sum(source_size), 0) * 150 - 200 * coalesce(sum(source_size) FILTER (bounded), 0) AS spare, sum(weight) FILTER (NOT bounded) AS open FROM tried),
targets AS (
  SELECT t.source, t.source_size, CASE WHEN bounded THEN 2.0::DOUBLE * t.source_size::DOUBLE
    ELSE (s.spare * t.weight)::DOUBLE / (100 * s.open)::DOUBLE END AS target FROM tried t, shared s),
tape AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS words,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, words) - start) + greatest(0, least(start + source_size + size, words) - start - source_size))::BIGINT AS taken
FROM tape
"""

ORACLE_SQL["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, s.size AS size, w[i:i + s.size - 1] AS p FROM split, (VALUES (1), (2), (3), (4)) s(size), unnest(range(1, len(w) - s.size + 2)) AS u(i)),
f AS (SELECT lang, size, p, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, p, size, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, 2000000 * c.a // (l.f + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:c.k] JOIN f r ON r.lang = c.lang AND r.p = c.p[c.k + 1:]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, p[i:i + len - 1] AS p, max(f) AS most
  FROM f, unnest(range(2, size)) AS x(len), unnest(range(1, size - len + 2)) AS y(i) WHERE size > 2 GROUP BY 1, 2),
kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score FROM lowest s LEFT JOIN inner_ i ON i.lang = s.lang AND i.p = s.p
  WHERE i.most IS NULL OR 100 * i.most < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
