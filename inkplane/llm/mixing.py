"""Mixing sources to target weights by Sainte-Laguë apportionment; DataFrame functions only.

Targets first: the mix's size is TOTAL times that of all documents, shared by weight; a source's
target stops at EPOCHS times its size and the excess is shared anew by weight. Then blocks of equal
token numbers (here words) go to sources by highest quotients target / (2k - 1), and each source's
blocks to its shards likewise, by the shards' sizes: integer quotas per shard. In a shard the
documents lie in a seeded order on a line of words; the line is cut into blocks, all are taken
quota div blocks times, and those that come first in a seeded order (an affine permutation of the
block numbers) once more. A document's share is the overlap of its words with the blocks taken.

A source is spread over shards of SHARD_WORDS words by a seeded digest of id and text, so rows without an
id, or with one id, are spread too. What meets in one task is a shard, and one row of sums for each source
(sources are weighed against each other) or for each shard of a source.

Defined cases: null and empty texts have size 0 and nothing is taken; null is a source of its own,
the last; rows that tie in the seeded order are equal in id and text, so reruns agree; without words all
targets are 0; an empty table has no mix; other columns of docs are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # of sources by code point, repeating
TOTAL = 1.5
EPOCHS = 2
BLOCK_WORDS = 128
SHARD_WORDS = 65_536
MAX_SHARDS = 65_536  # of a source; beyond that shards grow
SEED = 20
STEP = 2_147_483_647  # prime, so a permutation of any smaller number of blocks


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def seeded(text: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def place_key(doc_id: Column, digest: Column, seed: int = SEED) -> Column:
    """A document's place in the seeded order, by its id and the digest of its text."""
    return seeded(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), digest), seed)


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def hex_number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def sainte_lague(parties: DataFrame, group: list[str], votes: str, seats: str, name: str) -> DataFrame:
    """Adds quota: the group's seats (a column of the same value within it) by highest quotients votes / (2k - 1), ties by name.

    The allocation lies between those of two divisors, so only quotients between them are ranked:
    about twice as many as there are parties, however many seats there are.
    """
    all_of, n = Window.partitionBy(*group), F.count(F.lit(1)).over(Window.partitionBy(*group))
    total, q = F.sum(votes).over(all_of), F.col(seats)
    bounds = parties.withColumn("_total", total).withColumn("_n", n)
    least = F.when((q > F.col("_n") / 2) & (F.col("_total") > 0), F.greatest(F.lit(0), F.ceil(F.col(votes) * (q - F.col("_n") / 2) / F.col("_total") - 0.5))).otherwise(0)
    most = F.when(F.col("_total") > 0, F.floor(F.col(votes) * (q + F.col("_n") / 2 + 1) / F.col("_total") + 0.5)).otherwise(0)
    bounds = bounds.withColumn("_least", least.cast("long")).withColumn("_most", F.greatest(most.cast("long"), F.col("_least")))
    bounds = bounds.withColumn("_left", q - F.sum("_least").over(all_of))
    asked = bounds.where("_most > _least").select("*", F.explode(F.sequence(F.col("_least") + 1, F.col("_most"))).alias("_k"))
    place = F.row_number().over(all_of.orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), name))
    won = asked.withColumn("_place", place).where("_place <= _left").groupBy(*group, name).agg(F.count(F.lit(1)).alias("_won"))
    out = bounds.join(won, [*group, name], "left").withColumn("quota", F.col("_least") + F.coalesce("_won", F.lit(0)))
    return out.drop("_total", "_n", "_least", "_most", "_left", "_won")


def source_targets(sizes: DataFrame) -> DataFrame:
    """From (source, size): source_no by code point, source_size, target and quota in blocks."""
    one = F.lit(0).alias("_all")
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_all", one)
    s = s.withColumn("source_no", F.row_number().over(Window.partitionBy("_all").orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("source_no") % len(WEIGHTS) + 1).cast("double"))
    s = s.withColumn("_goal", F.sum("source_size").over(Window.partitionBy("_all")) * F.lit(TOTAL))
    s = s.withColumn("_stop", F.col("source_size") * float(EPOCHS))
    in_order = Window.partitionBy("_all").orderBy(F.col("_stop") / F.col("weight"), "source_no")
    stopped = F.coalesce(F.sum("_stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.col("_goal") - stopped) / F.sum("weight").over(in_order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("_level", level).withColumn("_place", F.row_number().over(in_order))
    first = F.min(F.when(F.col("_level") <= F.col("_stop") / F.col("weight"), F.struct("_place", "_level"))).over(Window.partitionBy("_all"))
    s = s.withColumn("target", F.least("_stop", F.coalesce(first["_level"] * F.col("weight"), F.col("_stop"))))
    s = s.withColumn("blocks", F.round(F.col("_goal") / BLOCK_WORDS).cast("long"))
    return sainte_lague(s, ["_all"], "target", "blocks", "source_no").select("source", "source_no", "source_size", "target", "quota")


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """All columns of docs (it needs doc_id, digest, source and size) and source_size, target, taken; and what
    tells which words are taken: start (the document's place on its shard's line), blocks, rounds and
    extra (its shard's blocks, how often all are taken, and how many are taken once more), turn."""
    keyed = docs.withColumn("_key", place_key(F.col("doc_id"), F.col("digest"), seed))
    sources = source_targets(docs.select("source", "size"))
    shards_of = F.least(F.lit(MAX_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))).cast("long")
    named = sources.select(F.col("source").alias("_source"), "source_no", "source_size", "target", F.col("quota").alias("_blocks"))
    keyed = keyed.join(named, keyed["source"].eqNullSafe(F.col("_source")), "left").withColumn("shard", hex_number(F.col("_key")) % shards_of)
    parts = keyed.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"), F.first("target").alias("_target"), F.first("source_size").alias("_size"), F.first("_blocks").alias("_blocks"))
    parts = parts.withColumn("_votes", F.when(F.col("_size") > 0, F.col("_target") * F.col("shard_size") / F.col("_size")).otherwise(0.0))
    parts = sainte_lague(parts, ["source_no"], "_votes", "_blocks", "shard")
    blocks = F.ceil(F.col("shard_size") / BLOCK_WORDS).cast("long")
    parts = parts.withColumn("blocks", blocks).withColumn("quota", F.least("quota", F.col("blocks") * EPOCHS))
    turn = hex_number(seeded(F.concat_ws(":", F.lit("turn"), "source_no", "shard"), seed))
    parts = parts.select("source_no", "shard", "blocks", F.when(F.col("blocks") > 0, F.expr("quota div blocks")).otherwise(0).alias("rounds"), F.when(F.col("blocks") > 0, F.col("quota") % F.col("blocks")).otherwise(0).alias("extra"), turn.alias("turn"))
    line = Window.partitionBy("source_no", "shard").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0)))
    placed = placed.join(parts, ["source_no", "shard"], "left")
    return placed.withColumn("taken", F.when(F.col("size") > 0, F.col("size") * F.col("rounds") + extra_words()).otherwise(0)).drop("_key", "_source", "_blocks", "source_no", "shard")


def _first_block() -> Column:
    return F.expr(f"start div {BLOCK_WORDS}")


def _last_block() -> Column:
    return F.expr(f"(start + size - 1) div {BLOCK_WORDS}")


def _once_more(block: Column) -> Column:
    return (block * STEP + F.col("turn")) % F.col("blocks") < F.col("extra")


def _overlap(block: Column) -> tuple[Column, Column]:
    """The words of the document in a block: from, to (in the document)."""
    begin, end = F.col("start"), F.col("start") + F.col("size")
    return F.greatest(block * BLOCK_WORDS, begin) - begin, F.least((block + 1) * BLOCK_WORDS, end) - begin


def extra_words() -> Column:
    def add(so_far: Column, block: Column) -> Column:
        a, b = _overlap(block)
        return so_far + F.when(_once_more(block), b - a).otherwise(0)

    return F.aggregate(F.sequence(_first_block(), _last_block()), F.lit(0).cast("long"), add)


def mix_shares(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.save(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), text_digest(F.col("text")).alias("digest")), "sizes")
    out = scratch.save(mix(sizes).select("doc_id", "size", "source_size", "target", "taken"), "shares")
    scratch.drop("sizes")
    return out


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: each is there once for every round in which any of its words are taken,
    with the words of that round (white space after a word goes with it). Columns as in docs."""
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), text_digest(F.col("text")).alias("digest"))
    mixed = mix(rows).where("taken > 0")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD + r"(?:[\x20\x09-\x0D]+(?![^\x20\x09-\x0D]))?"), F.lit(0))

    def part(block: Column) -> Column:
        a, b = _overlap(block)
        return F.array_join(F.slice(F.col("words"), (a + 1).cast("int"), (b - a).cast("int")), "")

    chosen = F.filter(F.sequence(_first_block(), _last_block()), _once_more)
    once = F.when(extra_words() == F.col("size"), F.col("row.text")).when(extra_words() > 0, F.array_join(F.transform(chosen, part), "")).otherwise(F.lit(None))
    whole = F.when(F.col("rounds") > 0, F.array_repeat(F.col("row.text"), F.col("rounds").cast("int"))).otherwise(F.array().cast("array<string>"))
    rounds = mixed.withColumn("words", F.when(extra_words().between(F.lit(1), F.col("size") - 1), words)).withColumn("once", once)
    texts = F.concat(whole, F.when(F.col("once").isNotNull(), F.array("once")).otherwise(F.array().cast("array<string>")))
    out = rounds.select("row", F.explode(texts).alias("text"))
    return out.select(*(F.col("text").alias(c) if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in columns))


#: The same shares in SQL. All quotients of a source or shard that could win are ranked.
SHARES_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM s0),
s2 AS (SELECT *, [3.0, 1.0, 2.0][(no % 3 + 1)::INT]::DOUBLE AS weight, {EPOCHS}::DOUBLE * source_size AS stop,
       1.5::DOUBLE * (SELECT sum(source_size) FROM s0)::DOUBLE AS goal FROM s1),
s3 AS (SELECT *, (goal - coalesce(sum(stop) OVER (ORDER BY stop / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(weight) OVER (ORDER BY stop / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
       row_number() OVER (ORDER BY stop / weight, no) AS place FROM s2),
s4 AS (SELECT source, no, source_size, least(stop, weight * (SELECT arg_min(level, place) FROM s3 WHERE level <= stop / weight)) AS target,
       round(goal / {BLOCK_WORDS})::BIGINT AS seats FROM s3),
q1 AS (SELECT no, seats, target / (2 * k - 1) AS quotient FROM (SELECT *, unnest(range(1, seats + 1)) AS k FROM s4) WHERE target > 0),
q2 AS (SELECT no, count(*) AS quota FROM (SELECT no, seats, row_number() OVER (ORDER BY quotient DESC, no) AS place FROM q1) WHERE place <= seats GROUP BY no),
s AS (SELECT s4.*, coalesce(quota, 0) AS quota, least({MAX_SHARDS}, greatest(1, ceil(source_size / {SHARD_WORDS}.0)))::BIGINT AS shards FROM s4 LEFT JOIN q2 USING (no)),
e AS (SELECT d.doc_id, d.size, d.k, s.no, s.source_size, s.target, s.quota, ('0x' || d.k[1:8])::BIGINT % shards AS shard
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
p0 AS (SELECT no, shard, sum(size)::BIGINT AS shard_size, any_value(quota) AS seats,
       CASE WHEN any_value(source_size) > 0 THEN any_value(target) * sum(size)::BIGINT / any_value(source_size) ELSE 0 END AS votes FROM e GROUP BY no, shard),
r1 AS (SELECT no, shard, seats, votes / (2 * k - 1) AS quotient FROM (SELECT *, unnest(range(1, seats + 1)) AS k FROM p0) WHERE votes > 0),
r2 AS (SELECT no, shard, count(*) AS quota FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY quotient DESC, shard) AS place FROM r1) WHERE place <= seats GROUP BY no, shard),
p1 AS (SELECT p0.*, ceil(shard_size / {BLOCK_WORDS}.0)::BIGINT AS blocks, coalesce(r2.quota, 0) AS q FROM p0 LEFT JOIN r2 USING (no, shard)),
p AS (SELECT *, least(q, {EPOCHS} * blocks) AS quota, ('0x' || md5('{SEED}:turn:' || no || ':' || shard)[1:8])::BIGINT AS turn FROM p1),
f AS (SELECT e.doc_id, e.size, e.source_size, e.target, p.blocks, p.quota, p.turn,
      coalesce(sum(e.size) OVER (PARTITION BY e.no, e.shard ORDER BY e.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM e JOIN p USING (no, shard))
SELECT doc_id, size, source_size, target::DOUBLE AS target,
  CASE WHEN size = 0 THEN 0 ELSE size * (quota // blocks) + coalesce(list_sum(list_transform(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1),
    lambda b: CASE WHEN (b * {STEP} + turn) % blocks < quota % blocks THEN least((b + 1) * {BLOCK_WORDS}, start + size) - greatest(b * {BLOCK_WORDS}, start) ELSE 0 END)), 0) END::BIGINT AS taken
FROM f
"""
