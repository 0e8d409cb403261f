"""The checked queries opN_<name> over the driver tables: thin digests of the operators' results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.bpe import encode_documents
from pricelake.llm.collocations import collocations
from pricelake.llm.columnwise import dedup_bytes
from pricelake.llm.decontaminate import find_contamination
from pricelake.llm.hard_negatives import hard_negatives
from pricelake.llm.line_dedup import dedup_lines
from pricelake.llm.ngram_trie import score_documents as lm_scores
from pricelake.llm.pii import KINDS, find_personal_data, listed
from pricelake.llm.quality import assess
from pricelake.llm.records import read_records, write_records
from pricelake.llm.seed_extend import dedup_substrings
from pricelake.llm.simhash import near_duplicates
from pricelake.llm.toxicity import fit, score_documents
from pricelake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op7_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line FROM split
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE length(k) > 0 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""".strip()


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, radius=2)


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN, ids=False, digests=True)


def fold(folds: int):
    """crc32 of doc_id as text, modulo ``folds``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels, fold(3) != 1)
    return score_documents(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op8_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(documents(spark, sf_dir), width=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(documents(spark, sf_dir), width=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {k})) AS bigint)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query
def op5_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_scores(documents(spark, sf_dir), fold(5) != 1)
    return out.select("doc_id", (fold(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, f"llm-records-{uuid.uuid4().hex}")
    write_records(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_word=True)
    return read_records(spark, path, as_array=False).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), min_count=100, max_words=5, top=2000, share=100)


ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (
  SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, m, array_to_string(ws[s:s + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS s FROM pieces, (SELECT unnest(range(1, 6)) AS m))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT g.lang, g.m, g.phrase, g.f AS a, k, l.f AS l, r.f AS r,
         ((1000::HUGEINT * g.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score, l.phrase AS head, r.phrase AS tail, n
  FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1) g
  JOIN grams l ON l.lang = g.lang AND l.phrase = array_to_string(string_split(g.phrase, ' ')[1:k], ' ')
  JOIN grams r ON r.lang = g.lang AND r.phrase = array_to_string(string_split(g.phrase, ' ')[k + 1:], ' ')
  JOIN totals t ON t.lang = g.lang
), held AS (
  SELECT lang, head AS phrase FROM cuts WHERE m > 2 AND k = m - 1 AND a >= l
  UNION SELECT lang, tail FROM cuts WHERE m > 2 AND k = 1 AND a >= r
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score
  FROM weakest ANTI JOIN held USING (lang, phrase)
)
SELECT * FROM ranked WHERE rank <= 2000
""".strip()

@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100, scale=256)


ORACLES["op13_hard_negatives"] = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
  SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x::DOUBLE)) AS v FROM rows
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), found AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
   AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT * FROM found WHERE rank <= 5
""".strip()

ORACLES["op1_decontaminate"] = r"""
WITH bench AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM bench WHERE len(ws) > 0)
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), doc_windows AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM item_windows))
), hits AS (
  SELECT doc_id, d.n, s, item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.k = i.k
), words AS (
  SELECT doc_id, count(DISTINCT pos)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""".strip()

ORACLES["op8_seed_extend"] = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS s FROM split)
), earliest AS (
  SELECT k, min(doc_id) AS lo FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS pos FROM windows JOIN earliest USING (k) WHERE lo < doc_id
), words AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS pos, unnest(ws) AS word FROM split
), marked AS (
  SELECT words.doc_id, words.pos, word, gone.pos IS NOT NULL AS out FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.pos = gone.pos
), kept AS (
  SELECT doc_id, count(*) FILTER (out) AS n, string_agg(word, ' ' ORDER BY pos) FILTER (NOT out) AS text FROM marked GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
""".strip()
