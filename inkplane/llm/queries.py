"""The subpackage's queries: thin wrappers over its operators, for __spark_entry__.py."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, embeddings, licenses, line_dups, media, mixing, near_dups, token_counts, toxicity
from ._shared import table

TOKENIZERS = os.environ.get("TOKENIZERS", "")


def tokenizer_path(name: str) -> str:
    """A vocabulary file's place: in the folder $TOKENIZERS, else where the installed package has it."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(media.store_texts(table(spark, sf_dir, "documents")))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_shares(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.id_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_line_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dups.deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.chat_digest(rows.unionByName(extra), tokenizer_path("byte_bpe_50k.tiktoken"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_media, op3_embeddings, op4_mixing, op5_bpe, op6_licenses, op7_line_dups, op8_near_duplicates, op9_token_counts, op10_chat, pipeline)}


#: Groups by two-word shingles, from all pairs that share one.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS shingles FROM w),
s AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM l),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT x, y FROM met WHERE 100 * c >= 80 * (n + m - c)),
sym AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM l UNION SELECT r.doc_id, sym.y FROM reach r JOIN sym ON sym.x = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM l JOIN comp USING (doc_id)
"""

#: Links of all pairs of one label, by cosine.
EMBEDDINGS_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
sym AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.vec_id, sym.y FROM reach r JOIN sym ON sym.x = r.other),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n_links FROM sym GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM e JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""

#: What reading back must give, from the rows alone.
CHAT_SQL = r"""
WITH w AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, 17 + 2 * length(r) - length(regexp_replace(r, '[\\<\[\n]', '', 'g')) + 2 * length(t) - length(regexp_replace(t, '[\\<\[]', '', 'g')) AS size FROM w)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_embeddings": EMBEDDINGS_SQL, "op4_mixing": mixing.SHARES_SQL, "op8_near_duplicates": NEAR_DUPLICATES_SQL, "op10_chat": CHAT_SQL}
