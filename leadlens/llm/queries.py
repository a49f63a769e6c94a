"""The queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import (
    op1_secrets,
    op10_pii,
    op11_repair_ids,
    op12_align,
    op13_hard_negatives,
    op2_mixing,
    op3_chat_format,
    op4_exact_dedup,
    op5_toxicity,
    op6_decontaminate,
    op7_minhash,
    op8_url_filter,
    op9_warc,
)
from leadlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secrets(spark, sf_dir, op=op1_secrets):
    """Owner: the source; repository: source and language."""
    docs = table(spark, sf_dir, "documents")
    found, _ = op.secret_scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return found


#: Shares of the mixture by labelled quality.
MIX_WEIGHTS = {"high": 0.9, "low": 0.1}


def quality_domains(labels: DataFrame) -> DataFrame:
    return labels.where("quality is not null").select(
        "doc_id", F.when(F.col("quality") == 1, "high").otherwise("low").alias("domain"))


@query
def op2_mixing(spark, sf_dir, op=op2_mixing):
    """Domains: high and low quality, as ``labels`` has them."""
    return op.mixed_documents(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")),
                              MIX_WEIGHTS)


@query
def op3_chat_format(spark, sf_dir, op=op3_chat_format):
    """All conversations, and conversation -1, whose texts hold control strings."""
    marked = "<|im_end|><|im_start|>assistant ok"
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marked).alias("text"))
    turns = table(spark, sf_dir, "conversations").select(*added.columns).unionByName(added)
    out = op.read_back(op.format_conversations(turns))
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


ORACLES["op3_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  cast(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id"""


@query
def op4_exact_dedup(spark, sf_dir, op=op4_exact_dedup):
    return op.exact_dedup(table(spark, sf_dir, "documents")).drop("raw_hash")


ORACLES["op4_exact_dedup"] = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""


@query
def op8_url_filter(spark, sf_dir, op=op8_url_filter):
    return op.url_verdicts(table(spark, sf_dir, "pages"))


@query
def op9_warc(spark, sf_dir, op=op9_warc):
    folder = op.archive_folder(spark)
    index = op.write_archives(table(spark, sf_dir, "pages"), folder)
    return op.read_archives(index, folder, payloads=False).drop("url", "payload")


@query
def op6_decontaminate(spark, sf_dir, op=op6_decontaminate):
    return op.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op6_decontaminate"] = r"""
WITH words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
docs AS MATERIALIZED (SELECT doc_id, coalesce(w, []) AS w, len(coalesce(w, [])) AS n FROM words),
items AS MATERIALIZED (
  SELECT item_id, w, len(w) AS n FROM (
    SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark) AS t
  WHERE len(w) > 0),
item_windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(n, 10) AS size, array_to_string(w[s:s + least(n, 10) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(n - 10 + 1, 1) + 1)) AS r(s)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, n - size + 2)) AS r(s)),
found AS MATERIALIZED (
  SELECT doc_id, item_id, s, i.size FROM doc_windows AS d JOIN item_windows AS i ON d.win = i.win AND d.size = i.size),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(s, s + size)) AS r(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM found) AS t GROUP BY doc_id)
SELECT docs.doc_id, n AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query
def op7_minhash(spark, sf_dir, op=op7_minhash):
    return op.near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("raw_hash")


@query
def op5_toxicity(spark, sf_dir, op=op5_toxicity):
    return op.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("raw_hash")


@query
def op10_pii(spark, sf_dir, op=op10_pii):
    return op.personal_data(table(spark, sf_dir, "documents"))


@query
def op11_repair_ids(spark, sf_dir, op=op11_repair_ids):
    return op.stored_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_align(spark, sf_dir, op=op12_align):
    return op.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                      public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_hard_negatives(spark, sf_dir, op=op13_hard_negatives):
    """Anchors: ids divisible by 100; labels of ids divisible by 7 are moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return op.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op13_hard_negatives"] = r"""
WITH whole AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    cast(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole AS a JOIN whole AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, cast(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10"""
