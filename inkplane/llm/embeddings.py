"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation is learned on a bounded sample so that the signs of the rotated, centred vectors make
balanced binary codes (alternately the nearest codes of the rotated sample and, by an SVD, the best
rotation onto them). A code's BITS bits are cut into TABLES chunks; two vectors are candidates when,
in one table at least, their chunks differ in at most one bit: every vector asks for its chunk and
that chunk with each single bit set that isn't, so of two such chunks the smaller one asks. A pair is taken in
the first such table only. Candidates
whose codes differ in more than FAR bits are let go; the others are compared by cosine, in double
precision, on the original vectors. Only vectors of one label meet, and equal vectors are one class.

Where two buckets have many vectors, blocks of them are compared as matrices, and only sums leave a task:
of each vector the number of its links in the two blocks and the smallest vector it is joined with. So
near copies by the thousand make no rows of pairs; the number of links asks for comparing them all
(a group of n different near copies has n^2 links), in as many tasks as there are pairs of blocks.

Vectors of one label and length meet; each length has its own rotation, learned on its share of the sample
(or drawn at random where the sample has too few of it).

Defined cases: vectors that are null, empty, zero, or hold nulls, NaN or infinities link with nothing, and
so do those without label or vec_id; rows that repeat an id are a vector each, with its own links, and equal
vectors of one label are copies whatever their ids; empty tables give none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, arrow_batches
from .graphs import components

BITS = 64
TABLES = 4
CHUNK = BITS // TABLES
FAR = 20  # of BITS; at a cosine of 0.98 codes differ in about 4 bits
SAMPLE = 20_000
THRESHOLD = 0.98
BLOCK = 256  # vectors of a block
FULL = 4096  # questions of more pairs of vectors than this are answered block by block


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dims, bits) of iterative quantisation. With fewer dimensions than bits,
    more directions are drawn at random before rotating; without a sample all are random."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    mean = sample.mean(0) if len(sample) else np.zeros(dims)
    x = sample - mean
    _, vectors = np.linalg.eigh(x.T @ x + 1e-9 * np.eye(dims))
    basis = vectors[:, ::-1][:, :bits]
    if basis.shape[1] < bits:
        basis = np.c_[basis, rng.standard_normal((dims, bits - basis.shape[1])) / np.sqrt(dims)]
    turn, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    v = x @ basis
    for _ in range(rounds if len(sample) > bits else 0):
        u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    return mean, basis @ turn


def codes(vectors: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Signs of the rotated vectors, as 64-bit integers."""
    return np.packbits((vectors - mean) @ projection >= 0, axis=1, bitorder="little").view(np.int64).ravel()


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """For each length of vectors: it, the rows that have it, and these vectors."""
    lengths = pa.compute.list_value_length(column).to_numpy()
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield int(n), rows, column if len(rows) == len(column) else column.take(pa.array(rows))


class Rotations(dict):
    """(mean, projection) by length; a length that the sample lacks has random directions, the same everywhere."""

    def __missing__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return learn_rotation(np.zeros((0, n)))


def learn_rotations(sample: pa.Array) -> Rotations:
    out = Rotations()
    for n, _, vectors in _by_length(sample):
        x = _matrix(vectors)
        out[n] = learn_rotation(x / np.sqrt((x * x).sum(1))[:, None])
    return out


def _chunk(table: int) -> Column:
    return F.shiftrightunsigned("code", table * CHUNK).bitwiseAND((1 << CHUNK) - 1)


#: What vectors that meet have in common, and a bucket's key.
GROUP = ["label", "dims"]
BUCKET = [*GROUP, "t", "chunk"]


def _entries(coded: DataFrame) -> DataFrame:
    """One row for each vector and table."""
    entry = [F.struct(F.lit(t).alias("t"), _chunk(t).alias("chunk")) for t in range(TABLES)]
    return coded.select("class", *GROUP, "code", F.explode(F.array(*entry)).alias("e")).select("class", *GROUP, "code", "e.t", "e.chunk")


def _asked(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every vector's questions: own bucket, and the larger buckets one bit off, with both buckets' sizes. The
    questions are the same for all of a bucket, so it asks once, and only for buckets that there are."""
    flips = F.array(*(F.lit(x).cast("long") for x in [0, *(1 << k for k in range(CHUNK))]))
    more = F.filter(flips, lambda x: F.col("chunk").bitwiseAND(x) == 0)
    buckets = sizes.select(*GROUP, "t", F.col("chunk").alias("own"), F.col("n").alias("n_own"), F.explode(F.transform(more, lambda x: F.col("chunk").bitwiseOR(x))).alias("chunk"))
    buckets = buckets.join(sizes, BUCKET).where("own <> chunk or n > 1")
    return entries.withColumnRenamed("chunk", "own").join(buckets, [*GROUP, "t", "own"])


def candidate_pairs(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """(a, b) with a < b that meet in a table, from the questions and the held entries."""
    asked = asked.select(F.col("class").alias("a"), F.col("code").alias("code_a"), *BUCKET, "own")
    held = entries.select(F.col("class").alias("b"), F.col("code").alias("code_b"), *BUCKET)
    differ = F.col("code_a").bitwiseXOR(F.col("code_b"))
    near = [F.bit_count(F.shiftrightunsigned(differ, t * CHUNK).bitwiseAND((1 << CHUNK) - 1)) <= 1 for t in range(TABLES)]
    first = F.when(near[0], 0)
    for t in range(1, TABLES):
        first = first.when(near[t], t)
    return asked.join(held, BUCKET).where(((F.col("a") < F.col("b")) | (F.col("own") != F.col("chunk"))) & (F.bit_count(differ) <= FAR) & (first == F.col("t"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def block_links(asked: DataFrame, entries: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The links of full buckets, as sums: (class, others, root). Both buckets are cut into blocks of
    about BLOCK vectors; a task compares two blocks as matrices and gives, for each vector that links, the
    number of vectors it links with there and the smallest class it is joined with in the two blocks."""
    bucket = [*GROUP, "t", "own", "chunk"]
    key = [*bucket, "block_a", "block_b"]
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("class"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    buckets = asked.select(*bucket, "n_own", "n").distinct()
    left = asked.select("class", *bucket, place("n_own").alias("block_a"), every("n").alias("block_b"), F.lit(True).alias("asks"))
    right = entries.join(buckets, BUCKET).select("class", *bucket, every("n_own").alias("block_a"), place("n").alias("block_b"), F.lit(False).alias("asks"))
    both = left.unionByName(right).join(vectors.select("class", "code", "vector", "copies"), "class")

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, code, copies = (table.column(c).to_numpy() for c in ("class", "code", "copies"))
        x = _matrix(table.column("vector").combine_chunks())
        x /= np.sqrt((x * x).sum(1))[:, None]
        differ = code[asks][:, None] ^ code[~asks][None, :]
        ok = (x[asks] @ x[~asks].T >= threshold) & (np.bitwise_count(differ.view(np.uint64)) <= FAR)
        if table.column("own")[0].as_py() == table.column("chunk")[0].as_py():
            ok &= ids[asks][:, None] < ids[~asks][None, :]
        for t in range(table.column("t")[0].as_py()):  # met in an earlier table already
            ok &= np.bitwise_count((differ >> (t * CHUNK)) & ((1 << CHUNK) - 1)) > 1
        if not ok.any():
            return _SUMS.empty_table()
        none = np.iinfo(np.int64).max
        root_a, root_b, before = ids[asks].copy(), None, None
        while before is None or (root_a != before).any():
            before = root_a.copy()
            root_b = np.where(ok, root_a[:, None], none).min(0)
            root_a = np.minimum(root_a, np.where(ok, root_b[None, :], none).min(1))
        others = np.r_[ok @ copies[~asks], ok.T @ copies[asks]]
        some = others > 0
        return pa.table([np.r_[ids[asks], ids[~asks]][some], others[some], np.r_[root_a, root_b][some]], schema=_SUMS)

    return both.groupBy(*key).applyInArrow(compare, "class long, others long, root long")


_SUMS = pa.schema([("class", pa.int64()), ("others", pa.int64()), ("root", pa.int64())])


def cosine_links(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine is at least threshold, with it."""
    left = vectors.select(F.col("class").alias("a"), F.col("vector").alias("x"))
    right = vectors.select(F.col("class").alias("b"), F.col("vector").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cosine = np.empty(b.num_rows)
                for (_, rows, p), (_, _, q) in zip(_by_length(b.column(2)), _by_length(b.column(3)), strict=True):  # a pair has one length
                    x, y = _matrix(p), _matrix(q)
                    cosine[rows] = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
                ok = pa.array(cosine >= threshold)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok), pa.array(cosine).filter(ok)], ["a", "b", "cosine"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, cosine double")


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of embeddings (vec_id, embedding, label)."""
    spark = embeddings.sparkSession
    arrow_batches(spark)
    scratch = Scratch(spark, "embeddings")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    whole = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = rows.where(whole)
    fitted = good.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(sample).select("vector").toArrow().column(0).combine_chunks()  # bounded by sample
    if not len(fitted):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rotations = learn_rotations(fitted)
    # a class is the copies of one vector under one label, told by 128 bits; it gets a number, and keeps its smallest id
    digest = [F.xxhash64("label", "vector").alias("d1"), F.xxhash64(F.lit(1), "label", "vector").alias("d2")]
    classes = good.select("vec_id", "label", "vector", *digest).groupBy("d1", "d2").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code = np.empty(b.num_rows, np.int64)
                for n, rows, vectors in _by_length(b.column(3)):
                    x = _matrix(vectors)
                    code[rows] = codes(x / np.sqrt((x * x).sum(1))[:, None], *rotations[n])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code)], [*b.schema.names, "code"])

    coded = classes.select("d1", "d2", "label", "vector", "least", "copies").mapInArrow(encode, "d1 long, d2 long, label long, vector array<double>, least long, copies long, code long")
    coded = scratch.save(coded.withColumns({"class": F.monotonically_increasing_id(), "dims": F.size("vector")}), "coded")
    entries = _entries(coded)
    sizes = scratch.save(entries.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n")), "sizes")
    asked = scratch.save(_asked(entries, sizes), "asked")
    full = F.col("n") * F.col("n_own") > FULL
    links = scratch.save(cosine_links(candidate_pairs(asked.where(~full), entries), coded.select("class", "vector"), threshold).select("a", "b").distinct(), "links")
    sums = scratch.save(block_links(asked.where(full), entries, coded, threshold), "sums")
    scratch.drop("asked", "sizes")
    copies = coded.select(F.col("class").alias("other"), F.col("copies").alias("n"))
    ends = links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("class"), F.col("a").alias("other")))
    linked = ends.join(copies, "other").select("class", "n").unionByName(sums.select("class", F.col("others").alias("n"))).groupBy("class").agg(F.sum("n").alias("others"))
    links = links.unionByName(sums.select(F.col("root").alias("a"), F.col("class").alias("b")).distinct())
    placed = scratch.save(components(links, scratch).withColumnRenamed("node", "class"), "placed")
    least = placed.join(coded.select("class", "least"), "class").groupBy("component").agg(F.min("least").alias("component_id"))
    result = coded.select("class", "d1", "d2", "least", "copies").join(linked, "class", "left").join(placed.join(least, "component").select("class", "component_id"), "class", "left")
    result = result.select("d1", "d2", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    result = scratch.save(result, "result")
    scratch.drop_all_but("result")
    keyed = rows.select("vec_id", *(F.when(whole, d).alias(n) for d, n in zip(digest, ("d1", "d2"), strict=True)))
    out = keyed.join(result, ["d1", "d2"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
