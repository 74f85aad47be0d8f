"""Registered queries: each applies one text operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (ann, byte_bpe, jaccard_join, lexical_search, line_dedup, packing, quality_rules, rule_classifier, shards,
                        token_alignment, token_counts, token_store, va_file)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the line-first verdict of every document."""
    judged = quality_rules.apply_line_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *[f"cleaning.{k}" for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_removed_lines", "removed_chars", "base_failed", "kept")])


_TERMINAL = quality_rules.TERMINAL.replace("'", "''")
_BEHIND = quality_rules.BEHIND.replace("'", "''")
_BOILER = " OR ".join([f"contains({{0}}, '{x}')" for x in quality_rules.NOTICES] + [
    f"starts_with(ltrim({{0}}, ' '), '{x} ') OR ends_with(' ' || rtrim({{0}}, '{_BEHIND}'), ' {x}')" for x in quality_rules.CHROME])
#: A line's sentences, each with the blank after it.
_SENTENCES = "regexp_extract_all(lower(line), '(?s:.*?[.!?] |.+)')"
ORACLE["op6_line_rules"] = rf"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS pos FROM src),
base AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid),
grams AS (SELECT rid, pos, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
          FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
rep AS (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM grams WHERE c IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT rid, unnest([pos, pos + 1, pos + 2]) AS p FROM rep WHERE k > 1) GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM src),
facts AS (SELECT rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                 length(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), '')) AS chars,
                 NOT regexp_matches(line, '{_TERMINAL}') AS unended,
                 len(regexp_extract_all(line, '{quality_rules.SYMBOL_WORD}')) AS sym,
                 len(regexp_extract_all(line, '{quality_rules.SHOUTED_WORD}')) AS shout,
                 len(regexp_extract_all(line, '{quality_rules.SEPARATOR_WORD}')) AS sep FROM lines),
judged AS (SELECT *, (n >= {quality_rules.MIN_LINE_WORDS} AND unended)
                     OR (n >= 2 AND (sym * 2 >= n OR shout * 2 >= n OR (sep >= 3 AND sep * 5 >= n)))
                     OR CASE WHEN length(line) <= {quality_rules.BOILERPLATE_CHARS} THEN {_BOILER.format("lower(line)")}
                        ELSE coalesce(list_sum(list_transform(list_filter({_SENTENCES}, lambda x: {_BOILER.format("x")}),
                                                              lambda x: length(x))), 0) * 2 >= length(lower(line)) END AS bad FROM facts),
per AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_removed_lines,
               coalesce(sum(chars) FILTER (WHERE bad), 0) AS removed_chars,
               count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS n_dup_lines
        FROM judged GROUP BY rid),
v AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_removed_lines, removed_chars,
             coalesce(n_words, 0) < {quality_rules.MIN_WORDS}
               OR coalesce(n_repeat_words, 0) * 100 > {quality_rules.MAX_REPEAT_PERCENT} * coalesce(n_words, 0) AS base_failed
      FROM src LEFT JOIN base USING (rid) LEFT JOIN cov USING (rid) JOIN per USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines,
       n_removed_lines::BIGINT AS n_removed_lines, removed_chars::BIGINT AS removed_chars, base_failed,
       NOT base_failed AND removed_chars * 100 <= word_chars * {quality_rules.MAX_LOST_PERCENT} AS kept
FROM v
"""


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the piece model."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes."""
    rows = shards.shard(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "size", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document by merge replay, decode its ids, and digest both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ids to directly addressable code segments and read the documents back."""
    store = token_store.write_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return token_store.read_tokens(store)


@query
def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from weighted rules over its statistics."""
    return rule_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    base = table(spark, sf_dir, "embeddings")
    return ann.nearest(base, base.where(F.col("vec_id") % 100 == 0))


@query
def op4_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens with their BM25 neighbours."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand in an earlier one."""
    docs = table(spark, sf_dir, "documents")
    cleaned = line_dedup.dedup_lines(docs.withColumn("n_chars", F.length("text").cast("long")), count_col="n_cut_chunks")
    return cleaned.select("doc_id", "text", "n_cut_chunks", (F.col("n_chars") - F.length("text")).alias("cut_chars"))


@query
def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 5-word shingles, Jaccard 0.8."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op11_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents of highest lexical score for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op11_dual_tree_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_TERM}') AS terms FROM documents),
lengths AS (SELECT rid, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS documents, sum(n)::BIGINT AS occurrences FROM lengths),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY rid, term),
weights AS (SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tf, total GROUP BY term, documents),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term FROM benchmark),
scored AS (SELECT item_id, rid, doc_id,
                  sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // occurrences))))::BIGINT AS score
           FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (rid), total
           GROUP BY item_id, rid, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scored WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= {lexical_search.TOP}
"""


@query
def op12_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 vectors of highest integer inner product for every vector whose id is divisible by 50."""
    base = table(spark, sf_dir, "embeddings")
    return va_file.top_k(base, base.where(F.col("vec_id") % 50 == 0))


ORACLE["op12_va_file"] = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({va_file.SCALE} * x::DOUBLE)) AS whole FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, b.vec_id, list_inner_product(q.whole, b.whole)::BIGINT AS score
           FROM v q JOIN v b ON q.vec_id <> b.vec_id AND len(q.whole) = len(b.whole) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= {va_file.NEIGHBOURS}
"""


@query
def op13_span_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two models aligned by bytes in every document, with corpus-wide pair counts."""
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
