"""Near-duplicate documents by min-max hashing of word shingles.

Every permutation gives two signature values, its minimum and its maximum over a document's shingle
set; so VALUES values need half as many hash evaluations. Bands of BAND_VALUES values are bucket
keys; pairs with a resemblance of 0.8 share none of the bands with a probability near 1e-7.

Equal sets are one class from the start (by a digest of the set), so copies make no pairs. In each
bucket every class is compared with one centre, on the full shingle sets: a link needs
100 * intersection >= percent * union. Then every bucket gets as a second centre the one that most
classes link with, of those its members link with. Two members that both link with the centre need no comparison;
others are found, without listing a bucket's pairs, by the edits they share relative to the centre
(see _links_past_centres). So no link between candidates that could join two components is lost, and a
group of near copies costs about as many comparisons as it has members.

Defined cases: null and empty texts and texts without words have an empty set and link with nothing;
fewer words than a shingle has make one shingle of all of them; rows that share an id are one
document with the links of all of them (but where their texts differ, links can be lost; see README); rows without an id link with nothing and are kept; texts of any
length are hashed whole; an empty table gives none; columns of docs are kept by first_of_groups, whatever
their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import Scratch, arrow_batches, free_name, hashes_of_words, mixed, text_or_empty, trimming
from .graphs import components

BANDS, BAND_VALUES = 40, 5
VALUES = BANDS * BAND_VALUES
PERMUTATIONS = VALUES // 2
SKETCH = -(-VALUES // 64)  # 64-bit words of a sketch
SURE = 5.4  # standard deviations
FULL = 32  # meetings by shared keys for each member; a centre of whose members more would meet is compared by blocks
BLOCK = 256
SLICE = 64  # texts hashed at once
COLUMNS = 4096
#: Bytes with A-Z lowered and ASCII white space as blanks.
LOWER = np.frombuffer(bytes(32 if c in b"\t\n\v\f\r " else c + 32 if 65 <= c <= 90 else c for c in range(256)), np.uint8)
_random = np.random.default_rng(20)
FLIPS = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2)
FACTORS = _random.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
BAND_FACTORS = _random.integers(0, 1 << 63, BAND_VALUES, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles (64-bit hashes) of each text. Lowering and splitting UTF-8 bytes
    touches A-Z and ASCII white space only."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    codes = LOWER[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    hashed, start = hashes_of_words(codes, codes == 32, 1)
    ends = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in raw]))
    out = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        h = hashed[0, a:b]
        if not len(h):
            out.append(np.zeros(0, np.uint64))
            continue
        k = min(words, len(h))
        s = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            s = s * np.uint64(0xD6E8FEB86659FD93) + h[j : len(h) - k + 1 + j]
        out.append(np.unique(mixed(s)))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The band keys (sets, BANDS) of sets, none of them empty, and their sketches (sets, SKETCH): a bit of each value."""
    x = np.concatenate(sets)
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    values = np.empty((VALUES, len(sets)), np.uint64)
    for k in range(PERMUTATIONS):
        h = (x ^ FLIPS[k]) * FACTORS[k]
        values[2 * k] = np.minimum.reduceat(h, start)
        values[2 * k + 1] = np.maximum.reduceat(h, start)
    keys = np.empty((len(sets), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sets), b + 1, np.uint64)
        for v, f in zip(values[b * BAND_VALUES : (b + 1) * BAND_VALUES], BAND_FACTORS, strict=True):
            key = mixed((key + v) * f)
        keys[:, b] = key
    bits = np.packbits((mixed(values) & np.uint64(1)).astype(np.uint8).T, axis=1)
    return keys, np.ascontiguousarray(np.pad(bits, ((0, 0), (0, 8 * SKETCH - bits.shape[1])))).view(np.int64)


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                sets = shingle_sets(b.column(1).to_pylist(), words)
                some = [s for s in sets if len(s)]
                found = iter(zip(*signatures(some), strict=True)) if some else iter(())
                both = [next(found) if len(s) else (None, None) for s in sets]
                keys, sketches = [None if k is None else k.view(np.int64) for k, _ in both], [x for _, x in both]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                sets = [s.view(np.int64) for s in shingle_sets(b.column(1).to_pylist(), words)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Centres a and members b on their full sets: size (of a's), added and gone (what b has beyond a and lacks of a), linked."""
    left = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")).hint("merge")
    right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")).hint("merge")
    both = pairs.join(left, "b").join(right, "a")
    both = both.select("a", "b", F.size("x").alias("size"), F.array_except("y", "x").alias("added"), F.array_except("x", "y").alias("gone"))
    linked = 100 * (F.col("size") - F.size("gone")) >= percent * (F.col("size") + F.size("added"))
    return both.withColumn("linked", linked)


def _pairs(shared: DataFrame, centre: str) -> DataFrame:
    return shared.where(F.col("node") != F.col(centre)).select(F.col(centre).alias("a"), F.col("node").alias("b")).distinct()


def _with_hubs(shared: DataFrame, compared: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds to buckets the centre anew: of the centres that members link with, the one with most links.
    It need not be in the bucket itself; so the members of a large group are told apart by one centre."""
    linked = compared.where("linked").select("a", "b")
    degrees = scratch.save(linked.groupBy("a").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    of_b = linked.join(degrees, "a").select(F.col("b").alias("node"), "degree", F.col("a").alias("hub"))
    best = of_b.unionByName(degrees.select(F.col("a").alias("node"), "degree", F.col("a").alias("hub")))
    best = best.groupBy("node").agg(F.max(F.struct("degree", -F.col("hub"))).alias("best"))
    placed = shared.join(best, "node", "left").withColumn("best", F.coalesce("best", F.struct(F.lit(0).cast("long").alias("degree"), -F.col("node"))))
    hubs = placed.groupBy("bucket").agg((-F.max("best")["col2"]).alias("hub"))
    return shared.join(hubs, "bucket")


def _block_links(placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): for members of full centres the smallest node that a member is joined with among two blocks
    of about BLOCK members, strays against all. Shared edits are counted by products of incidence
    matrices, COLUMNS edits at a time. A task holds two blocks, whatever their number; how large these are hangs on
    the members' edits, so very long texts that differ much make large tasks."""
    edits = F.concat("added", F.transform("gone", lambda v: F.bitwise_not(v)))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    rows = placed.select("a", F.col("b").alias("node"), "linked", "size", F.size("added").alias("n_added"), F.size("gone").alias("n_gone"), edits.alias("edits"), "strays", "n")
    place = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    given = ["a", "node", "size", "n_added", "n_gone", "edits"]
    left = rows.where("not linked").select(*given, place("strays").alias("block_x"), every("n").alias("block_y"), F.lit(True).alias("stray"))
    right = rows.select(*given, every("strays").alias("block_x"), place("n").alias("block_y"), F.lit(False).alias("stray"))
    nothing = pa.schema([("a", pa.int64()), ("b", pa.int64())]).empty_table()

    def compare(table: pa.Table) -> pa.Table:
        x = table.column("stray").to_numpy()
        if x.all() or not x.any():
            return nothing
        node, size, added, gone = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "size", "n_added", "n_gone"))
        lists = table.column("edits").combine_chunks()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        _, column, often = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        number = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[column]  # edits of one member only are shared by none
        shared = np.zeros((x.sum(), (~x).sum()), np.float32)
        order = np.argsort(number, kind="stable")
        row, number = row[order], number[order]
        for low in range(0, int(number.max(initial=-1)) + 1, COLUMNS):
            part = slice(*np.searchsorted(number, [low, low + COLUMNS]))
            has = np.zeros((len(lists), COLUMNS), np.float32)
            has[row[part], number[part] - low] = 1
            shared += has[x] @ has[~x].T
        inter = (size - gone)[x][:, None] - gone[~x][None, :] + shared.astype(np.int64)
        union = (size + added)[x][:, None] + added[~x][None, :] - shared.astype(np.int64)
        ok = 100 * inter >= percent * union
        none = np.iinfo(np.int64).max
        root_x, before = node[x].copy(), None
        while before is None or (root_x != before).any():
            before = root_x.copy()
            root_y = np.where(ok, root_x[:, None], none).min(0)
            root_x = np.minimum(root_x, np.where(ok, root_y[None, :], none).min(1))
        ends, roots = np.r_[node[x], node[~x]], np.r_[root_x, root_y]
        joined = (roots != none) & (roots != ends)
        return pa.table([roots[joined], ends[joined]], names=["a", "b"])

    return left.unionByName(right).groupBy("a", "block_x", "block_y").applyInArrow(lambda t: compare(t), "a long, b long")


def least_bits(percent: int) -> int:
    """Equal bits of two sketches, of VALUES, that sets of this resemblance have but for one case in 10^7."""
    p = (1 + percent / 100) / 2
    return math.floor(VALUES * p - SURE * math.sqrt(VALUES * p * (1 - p)))


def _keys(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The keys by which members b of centres a meet: a, b, stands, stray, component, sketch, size (of b's set, or edits), key,
    place (the key's in b's order, from 1), asks (else b only holds it). In an order go first the keys that the fewest
    strays have; one that no other member, or for b no stray, has is left out."""
    edits = F.concat("added", F.transform("gone", lambda v: F.bitwise_not(v)))
    shared = F.expr(f"({percent} * size(added) + 100 * size(gone) + {100 + percent}) div {100 + percent}").cast("int")
    by_edits = placed.where("stands").select("a", "b", "stands", (~F.col("linked")).alias("stray"), edits.alias("keys"), (F.size("added") + F.size("gone") - shared + 1).alias("asked"))
    out_of = F.size("shingles") - F.expr(f"(size(shingles) * {percent} + 99) div 100").cast("int") + 1  # whole numbers, so nothing is rounded
    members = placed.where("not stands").select("a", "b", "stands", (~F.col("linked")).alias("stray"))
    by_sets = members.join(sets.withColumnRenamed("node", "b"), "b").select(*members.columns, F.col("shingles").alias("keys"), out_of.alias("asked"))
    # rows that share an id have sets of their own
    own = ["a", "b", "stands", "stray", "row", "size", "asked"]
    each = by_edits.unionByName(by_sets).withColumns({"row": F.xxhash64("keys"), "size": F.size("keys")}).select(*own, F.explode("keys").alias("key"))
    same = Window.partitionBy("a", "key")  # a row each: no pairs, and one exchange
    each = each.withColumns({"often": F.count_if("stray").over(same), "have": F.count(F.lit(1)).over(same)})
    others = each.where(F.when(F.col("stray"), F.col("have") > 1).otherwise(F.col("often") > 0))  # what goes is first in the order
    ordered = others.groupBy(*own).agg(F.array_sort(F.collect_set(F.struct("often", "have", "key"))).alias("keys"))
    ordered = ordered.join(placed.select("a", "b", "component", "sketch").dropDuplicates(["a", "b"]), ["a", "b"])
    left_out = F.col("size") - F.size("keys")
    used = F.when(F.col("stands") & F.col("stray"), F.size("keys")).otherwise(F.greatest(F.col("asked") - left_out, F.lit(0)))
    out = ordered.select("a", "b", "stands", "stray", "component", "sketch", "size", "asked", left_out.alias("left_out"), F.posexplode(F.slice("keys", F.lit(1), used)).alias("at", "k"))
    place = F.col("left_out") + F.col("at") + 1
    return out.select("a", "b", "stands", "stray", "component", "sketch", "size", F.col("k.key").alias("key"), place.alias("place"), (place <= F.col("asked")).alias("asks"))


def _links_past_centres(compared: DataFrame, joined: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between members of one bucket that its centre doesn't join and that are in different
    components of the links found so far (joined: node, component).

    Let x not be linked with the centre (a stray), and y be another member. Two filters that lose no link find
    candidates by shared keys; each centre's members use one of them.

    Where most members link with the centre, it stands for them, and their edits (shingles added, shingles
    gone) tell them apart. If x and y link, counting gives at least (1 + percent * added + 100 * gone) /
    (100 + percent) edits that both share, by y's numbers. So among any so many of y's edits that fewer
    are left out there is one of x's: y asks with as many, and all of x's are held.

    Elsewhere the members share some passage with the centre and not much else, and the first shingles of x and y
    must meet (prefix filtering). Where the first that both have stands, enough must be left in both.

    y asks with the keys that the fewest strays have, so members don't meet by what all of a group have.
    What meetings there would be is counted before any is made: a centre of whose members more than FULL for each would meet
    is compared by blocks as matrices (see _block_links). So the join makes at most FULL rows a member, however large a group is.

    Of the pairs that meet, those whose sketches differ in too many bits go at once (see least_bits; as sure
    as the banding itself). The full sets of both then decide.
    """
    placed = compared.join(sketches.select(F.col("node").alias("b"), "sketch"), "b").join(joined.withColumnRenamed("node", "b"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    kinds = compared.groupBy("a").agg((2 * F.count_if("linked") >= F.count(F.lit(1))).alias("stands"), F.count_if(~F.col("linked")).alias("strays"), F.count(F.lit(1)).alias("n")).where("strays > 0")
    placed = scratch.save(placed.join(kinds, "a"), "placed")
    keys = scratch.save(_keys(placed, sets, percent), "keys")
    meetings = keys.groupBy("a", "key").agg((F.count_if("stray") * F.count_if("asks")).alias("meetings")).groupBy("a").agg(F.sum("meetings").alias("meetings"))
    full = scratch.save(meetings.join(kinds.select("a", "n"), "a").where(F.col("meetings") > FULL * F.col("n")).select("a"), "full")
    blocks = scratch.save(_block_links(placed.join(full, "a", "left_semi"), percent), "blocks")
    keys = keys.join(full, "a", "left_anti")
    held = keys.where("stray").select("a", "key", "stands", F.col("b").alias("x"), F.col("component").alias("of_x"), F.col("sketch").alias("of_x_bits"), F.col("size").alias("size_x"), F.col("place").alias("place_x"))
    asked = keys.where("asks").select("a", "key", F.col("b").alias("y"), F.col("component").alias("of_y"), F.col("sketch").alias("of_y_bits"), F.col("size").alias("size_y"), F.col("place").alias("place_y"))
    differing = sum((F.bit_count(F.col("of_x_bits")[k].bitwiseXOR(F.col("of_y_bits")[k])) for k in range(SKETCH)), F.lit(0))
    left = 1 + F.least(F.col("size_x") - F.col("place_x"), F.col("size_y") - F.col("place_y"))
    enough = F.col("stands") | ((100 + percent) * left >= percent * (F.col("size_x") + F.col("size_y")))
    met = held.join(asked, ["a", "key"]).where((F.col("of_x") != F.col("of_y")) & enough & (differing <= VALUES - least_bits(percent)))
    met = scratch.save(met.select(F.least("x", "y").alias("p"), F.greatest("x", "y").alias("q")).distinct(), "met")
    side = lambda n: sets.select(F.col("node").alias(n), F.col("shingles").alias(f"of_{n}"))
    both = met.join(side("p"), "p").join(side("q"), "q").withColumn("inter", F.size(F.array_intersect("of_p", "of_q")))
    linked = 100 * F.col("inter") >= percent * (F.size("of_p") + F.size("of_q") - F.col("inter"))
    return both.where(linked).select(F.col("p").alias("a"), F.col("q").alias("b")).distinct().unionByName(blocks)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs."""
    spark = docs.sparkSession
    arrow_batches(spark)
    scratch = Scratch(spark, "near-dups")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = scratch.save(texts.mapInArrow(trimming(_signatures(words)), "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"), "signatures")
    with_id = signed.where("doc_id is not null and n_shingles > 0")
    classes = scratch.save(with_id.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    members = with_id.join(classes, (with_id["digest"] == classes["digest"]) & (with_id["doc_id"] == classes["node"]), "left_semi")
    sketches = members.select(F.col("doc_id").alias("node"), "sketch").dropDuplicates(["node"])
    entries = members.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    centres = entries.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre < last").drop("last")
    shared = scratch.save(entries.join(centres, "bucket"), "shared")
    # the sets are made anew from the texts, only for documents that share a bucket; texts move once, at any size
    wanted = shared.select(F.col("node").alias("doc_id")).distinct().hint("merge")
    chosen = texts.join(wanted, "doc_id", "left_semi").select("doc_id", "text")
    sets = scratch.save(chosen.mapInArrow(trimming(_sets(words)), "node long, shingles array<long>"), "sets")
    pairs = scratch.save(_pairs(shared, "centre"), "pairs")
    first = scratch.save(_compared(pairs, sets, percent), "first")
    again = scratch.save(_pairs(_with_hubs(shared, first, scratch), "hub"), "again")
    second = scratch.save(_compared(again.join(pairs, ["a", "b"], "left_anti"), sets, percent), "second")
    compared = scratch.save(first.unionByName(second).join(again, ["a", "b"], "left_semi"), "compared")
    direct = first.unionByName(second).where("linked").select("a", "b")
    direct = scratch.save(components(direct, scratch, "direct"), "joined")
    links = direct.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(_links_past_centres(compared, direct, sketches, sets, percent, scratch))
    found = scratch.save(components(links, scratch, "all"), "components")
    # rows that share an id are one document: their classes have one node
    labels = scratch.save(classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component")), "labels")
    scratch.drop_all_but("signatures", "labels")
    rows = signed.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "doc_id"))
    out = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def first_of_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is the first of its group; all columns. Repeated rows of one id
    and text are one document and leave one row, the least by its columns in turn; rows without an id all stay."""
    scratch = Scratch(docs.sparkSession, "first-of-groups")
    found = near_duplicates(docs, words, percent).where("doc_id is not null").groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    key, digest, row = (free_name(docs, c) for c in ("_id", "_digest", "_row"))
    found = scratch.save(found.where("not kept or n > 1").select(F.col("doc_id").alias(key), "kept"), "found")
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    single = keyed.join(found.select(key), key, "left_anti").select(*docs.columns)
    repeated = keyed.join(found.where("kept").select(key), key, "left_semi").withColumn(digest, F.xxhash64(text_or_empty()))
    least = repeated.groupBy(key, digest).agg(F.min(F.struct(*docs.columns)).alias(row))
    return single.unionByName(least.select(*(F.col(row)[c].alias(c) for c in docs.columns)))
