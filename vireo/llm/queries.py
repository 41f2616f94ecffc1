"""The queries opN_<name> over the driver tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.llm.lexical_search import search_sql
from vireo.llm.license_scan import scan_sql

TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.packing import pack_documents
    p = pack_documents(_read(spark, sf_dir, "documents"), _tokenizer_file())
    return p.select("doc_id", F.col("piece_start").alias("start"), "length", F.crc32("ids_le32").alias("ids_crc32"),
                    "doc_tokens", "sequence_id", F.col("sequence_offset").alias("offset"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.mixing import mix_sources
    return mix_sources(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.warc import warc_roundtrip
    return warc_roundtrip(_read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.line_dedup import dedup_lines
    return dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "lines_total", "lines_removed", "text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.quality_crf import score_quality
    return score_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.langid_gru import identify_languages
    return identify_languages(_read(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.ngram_join import ngram_links
    return ngram_links(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.substring_dedup import remove_repeats
    return remove_repeats(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.exact_dedup import exact_groups
    return exact_groups(_read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.embedding_dedup import near_vectors
    return near_vectors(_read(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.conversation_repair import damaged_and_repaired
    return damaged_and_repaired(_read(spark, sf_dir, "conversations")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.license_scan import scan_licenses
    return scan_licenses(_read(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vireo.llm.lexical_search import search_documents
    return search_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_packing, op2_mixing, op3_warc, op4_line_dedup, op5_quality, op6_language, op7_ngram_join,
                                   op8_substring_dedup, op9_exact_dedup, op10_embedding_dedup, op11_conversation_repair, op12_license_scan,
                                   op13_lexical_search, pipeline)}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

SQL = {
    "op3_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f""",
    "op4_line_dedup": """
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
occ AS (SELECT doc_id, pos, raw, trim(raw, {space}) AS line FROM raw),
cls AS (SELECT line, length(line) AS n, min(doc_id * 1000000 + pos) AS place FROM occ WHERE length(line) >= 20 GROUP BY line),
cut AS (SELECT line, n, place, unnest(range(1, n + 1)) AS p FROM cls),
v AS (SELECT 's' AS kind, n, p, left(line, p - 1) || substr(line, p + 1) AS rest, line, place, false AS longer FROM cut
      UNION ALL SELECT 'd', n - 1, 0, left(line, p - 1) || substr(line, p + 1), line, place, true FROM cut
      UNION ALL SELECT 'd', n, 0, line, line, place, false FROM cls),
g AS (SELECT kind, n, p, rest, min(place) AS first, min(place) FILTER (NOT longer) AS first_short FROM v
      GROUP BY ALL HAVING min(place) < max(place) AND count(*) FILTER (NOT longer) > 0),
near AS (SELECT DISTINCT v.line FROM v JOIN g USING (kind, n, p, rest)
         WHERE v.place > CASE WHEN v.longer THEN g.first_short ELSE g.first END),
marked AS (
  SELECT o.doc_id, o.pos, o.raw,
         c.line IS NOT NULL AND (o.doc_id * 1000000 + o.pos > c.place OR near.line IS NOT NULL) AS gone
  FROM occ o LEFT JOIN cls c ON c.line = o.line LEFT JOIN near ON near.line = o.line),
per AS (SELECT doc_id, count(*) AS lines_total, count(*) FILTER (gone) AS lines_removed,
               coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(lines_total, 0) AS lines_total, coalesce(lines_removed, 0) AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN per.text END AS text
FROM documents d LEFT JOIN per USING (doc_id)""".format(space=_SPACE),
    "op7_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 3), lambda i : array_to_string(words[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT a AS id, b AS other FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, (SELECT min(other) FROM r WHERE r.id = d.doc_id)) AS component_id,
       (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN n USING (doc_id)""",
    "op8_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS p, words FROM w WHERE len(words) >= 35),
h AS (SELECT doc_id, p, array_to_string(words[p:p + 34], ' ') AS g FROM win),
rep AS (SELECT doc_id, p FROM h WHERE g IN (SELECT g FROM h GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM rep),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
kept AS (SELECT w.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
                coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (g.i IS NULL), '') AS t
         FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op9_exact_dedup": r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(norm) AS text_sha256
FROM t WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "op10_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, list_transform(e, lambda x : x / sqrt(list_sum(list_transform(e, lambda y : y * y)))) AS u FROM v
       WHERE e IS NOT NULL AND len(list_filter(e, lambda x : x IS NULL OR NOT isfinite(x))) = 0
         AND list_sum(list_transform(e, lambda y : y * y)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND list_dot_product(a.u, b.u) >= 0.95),
r AS (SELECT a AS id, b AS other FROM l UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, least(vec_id, (SELECT min(other) FROM r WHERE r.id = vec_id)) AS component_id FROM v)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c""",
    "op12_license_scan": scan_sql(),
    "op13_lexical_search": search_sql(),
}
