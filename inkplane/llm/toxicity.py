"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two interpolated Kneser-Ney models, of toxic and of ordinary rows, give every word (lower case,
split at white space, with its end) a log-likelihood each; the classes keep own counts down to
two characters and back off to continuation counts both share, which smooths rare expressions.
A text's features are length-normalised comparisons of the two over its words: the mean difference,
the mean excess of the difference over EXCESS nats and the share of words whose difference exceeds
CLEAR nats. A logistic link, fitted on labelled rows that gave no counts, turns them into a score.

The models' counts are those of all labelled rows but the held out and the link's, and every gram stays; so the model
grows with the distinct grams of words, some 60 bytes each, at the driver and in the workers. The link is fitted
on all of its rows: each step of Newton's method sums over them where they lie. max_grams and max_labelled
bound both for callers that ask for it. Scoring is one pass over whole texts without a shuffle. Labels, lang, source and doc_id are no inputs of a score. Words are scored each by itself:
expressions of several ordinary words aren't modelled.

Defined cases: a null text is an empty one; an empty text has all features 0 and gets the link's
value there; without any labelled rows every score is 0; with one class only, that class's label.
Rows that repeat, or have no id, are scored each; several labels of one id count as toxic if one is; an empty
table gives none; other columns are kept, and one named like the score's is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import Scratch, arrow_batches, text_or_empty, trim, trimming

ORDER = 6  # characters of the longest gram
OWN_ORDER = 2  # the shortest gram of which classes have counts of their own
BITS = 10  # of a character in a gram's key: ORDER * BITS < 63
PLAIN = 0x180  # characters below are themselves in a key (Latin); others share what is left, and never meet these
START = 2  # what stands before a word
ALPHABET = 200  # the last backoff is uniform over so many characters
LONGEST = 64  # a longer word's difference is scaled to this length
EXCESS, CLEAR = 4.0, 12.0
SMALL_TABLE = 2_000_000  # labels up to which their table (16 bytes a row) is broadcast; the counts are the same either way
STEPS, NEAR = 40, 1e-10  # of Newton's method: at most so many, the last one not larger


def folds(doc_id: Column | str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5


def _unique_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the index of each text's words in order, and the words of each text."""
    split = [t.lower().split() for t in texts]
    n = np.array([len(x) for x in split], np.int64)
    found = pa.array([w for x in split for w in x], pa.string()).dictionary_encode()
    words = np.empty(len(found.dictionary), object)
    words[:] = found.dictionary.to_pylist()
    return words, found.indices.to_numpy(), n


def _grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of the gram that ends at each character of the words (and of their ends), and its word."""
    joined = "".join([f"{chr(START) * (ORDER - 1)}{w} " for w in words])
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.where(c < PLAIN, c, PLAIN + (c * 0x9E3779B1 >> 7) % ((1 << BITS) - PLAIN))
    key = c.copy()
    for k in range(1, ORDER):
        key[k:] |= c[:-k] << (BITS * k)
    size = np.fromiter((len(w) for w in words), np.int64, len(words))
    start = np.cumsum(size + ORDER) - size - ORDER
    word = np.repeat(np.arange(len(words)), size + 1)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1) + np.repeat(start, size + 1) + ORDER - 1
    return key[at], word


class _Level:
    """Discounted relative frequencies and backoff weights of one order."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys = keys
        contexts = keys >> BITS  # sorted, as keys are
        new = np.append(True, contexts[1:] != contexts[:-1])[: len(keys)]
        self.contexts, of = contexts[new], (np.cumsum(new, dtype=np.int32) if len(keys) < 1 << 31 else np.cumsum(new)) - 1
        del contexts, new
        total = np.bincount(of, n)
        once, twice = (n == 1).sum(), (n == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        self.share = (np.maximum(n - discount, 0) / total[of]).astype(np.float32)
        self.rest = (np.bincount(of, np.minimum(n, discount)) / total).astype(np.float32)

    @staticmethod
    def _at(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, absent: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), absent)
        i = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[i] == asked, values[i], absent)

    def probability(self, asked: np.ndarray, below: np.ndarray) -> np.ndarray:
        return self._at(self.keys, self.share, asked, 0.0) + self._at(self.contexts, self.rest, asked >> BITS, 1.0) * below


def _levels(keys: np.ndarray, n: np.ndarray) -> dict[int, _Level]:
    """A class's levels from ORDER down to OWN_ORDER: counts at the top, below it the numbers of distinct left neighbours."""
    out = {}
    for order in range(ORDER, OWN_ORDER - 1, -1):
        if order < ORDER:
            keys, n = np.unique(keys & ((1 << (BITS * order)) - 1), return_counts=True)
        out[order] = _Level(keys, n)
    return out


def _shared_levels(keys: np.ndarray) -> dict[int, _Level]:
    """The levels below OWN_ORDER, of both classes' grams."""
    out, keys = {}, np.unique(keys & ((1 << (BITS * OWN_ORDER)) - 1))
    for order in range(OWN_ORDER - 1, 0, -1):
        keys, n = np.unique(keys & ((1 << (BITS * order)) - 1), return_counts=True)
        out[order] = _Level(keys, n)
    return out


@dataclass
class Model:
    """Counts of ORDER-grams by class, as (keys, n), and the link's weights."""

    toxic: dict[int, _Level]
    ordinary: dict[int, _Level]
    shared: dict[int, _Level]
    weights: np.ndarray | None = None
    constant: float | None = None  # the score where the classes can't be compared

    @classmethod
    def of(cls, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
        """keys: sorted."""
        if not toxic.any() or not ordinary.any():
            return cls({}, {}, {}, constant=1.0 if toxic.any() else 0.0)
        return cls(_levels(keys[toxic > 0], toxic[toxic > 0]), _levels(keys[ordinary > 0], ordinary[ordinary > 0]), _shared_levels(keys))

    def word_differences(self, words: np.ndarray) -> np.ndarray:
        """Log-likelihood under the toxic model less that under the ordinary one, of each word."""
        key, word = _grams(words)
        asked, back = np.unique(key, return_inverse=True)
        p = np.full(len(asked), 1.0 / ALPHABET)
        for order in range(1, OWN_ORDER):
            p = self.shared[order].probability(asked & ((1 << (BITS * order)) - 1), p)
        by_class = []
        for levels in (self.toxic, self.ordinary):
            q = p
            for order in range(OWN_ORDER, ORDER + 1):
                q = levels[order].probability(asked & ((1 << (BITS * order)) - 1), q)
            by_class.append(np.log(np.maximum(q, 1e-12)))
        n = np.bincount(word, minlength=len(words))
        return np.bincount(word, (by_class[0] - by_class[1])[back], len(words)) * np.minimum(1.0, LONGEST / np.maximum(n, 1))

    def features(self, texts: list[str]) -> np.ndarray:
        words, codes, n = _unique_words(texts)
        out = np.zeros((len(texts), 3))
        if len(words):
            each = self.word_differences(words)[codes]
            text, least = np.repeat(np.arange(len(texts)), n), np.maximum(n, 1)
            for k, v in enumerate((each, np.maximum(each - EXCESS, 0), each > CLEAR)):
                out[:, k] = np.bincount(text, v, len(texts)) / least
        return out

    def fit_link(self, rows: DataFrame) -> None:
        """Logistic regression with a small ridge, by Newton's method, on all rows (a, b, c, toxic); even weights if a class
        is missing. Weights have nine digits, so the order of sums doesn't show."""
        if self.constant is not None:
            return
        names, y = ("a", "b", "c"), F.col("toxic").cast("double")
        about = rows.agg(F.min("toxic"), F.max("toxic"), *(f(n) for f in (F.avg, F.stddev_pop) for n in names)).first()
        if about[0] == about[1]:  # or no rows
            self.weights = np.array([-3.0, 10.0, 20.0, 100.0])
            return
        mean, dev = np.array(about[2:5]), np.array(about[5:8]) + 1e-9
        x, ridge = [F.lit(1.0), *((F.col(n) - float(m)) / float(d) for n, m, d in zip(names, mean, dev, strict=True))], 0.1
        w = np.zeros(len(x))
        upper = np.triu_indices(len(x))
        for _ in range(STEPS):
            z = sum((float(v) * c for v, c in zip(w[1:], x[1:], strict=True)), F.lit(float(w[0])))
            p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
            at = rows.select(*(c.alias(f"x{k}") for k, c in enumerate(x)), p.alias("p"), y.alias("y"))
            gradient = [F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")) for i in range(len(x))]
            second = [F.sum(F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in zip(*upper, strict=True)]
            sums = np.array(at.agg(*gradient, *second).first())
            h = np.zeros((len(x), len(x)))
            h[upper] = sums[len(x) :]
            step = np.linalg.solve(h + np.triu(h, 1).T + ridge * np.eye(len(x)), sums[: len(x)] - ridge * w)
            w += step
            if np.abs(step).max() <= NEAR:
                break
        self.weights = np.array([float(f"{v:.9g}") for v in np.r_[w[0] - (w[1:] * mean / dev).sum(), w[1:] / dev]])

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + self.features(texts) @ self.weights[1:], -30, 30)))


def least_count(sizes: list[tuple[int, int]], most: int) -> int:
    """The least count that at most so many grams have; sizes: (count, grams that have it)."""
    left = sum(n for _, n in sizes)
    for count, n in sorted(sizes):
        if left <= most:
            return count
        left -= n
    return max((c for c, _ in sizes), default=0) + 1


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int | None = None, max_grams: int | None = None) -> Model:
    """The model from all labelled rows of folds 1 to 4: three give counts, the fourth fits the link. A caller may bound
    the link's rows (by a hash of the id) and the grams (the rarest go)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    scratch = Scratch(spark, "toxicity")
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (folds() != 0)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = scratch.save(chosen.withColumn("fold", folds()), "labels")
    counted, linked = chosen.where("fold <> 4"), chosen.where("fold = 4")
    if max_labelled is not None:
        linked = linked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    if chosen.count() <= SMALL_TABLE:  # else both sides are sorted
        counted, linked = F.broadcast(counted), F.broadcast(linked)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, codes, n = _unique_words(b.column(0).to_pylist())
            if not len(words):
                continue
            toxic = np.repeat(b.column(1).to_numpy(zero_copy_only=False) > 0, n)
            by_word = [np.bincount(codes[toxic == c], minlength=len(words)) for c in (True, False)]
            key, word = _grams(words)
            keys, back = np.unique(key, return_inverse=True)
            got = [np.bincount(back, w[word], len(keys)).astype(np.int64) for w in by_word]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(got[0]), pa.array(got[1])], ["gram", "toxic", "ordinary"])

    grams = texts.join(counted, "doc_id").select("text", "toxic").mapInArrow(trimming(count), "gram long, toxic long, ordinary long")
    grams = scratch.save(grams.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), "grams")
    if max_grams is not None and grams.count() > max_grams:
        sizes = grams.groupBy(F.least(F.col("toxic") + F.col("ordinary"), F.lit(4096)).alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()  # 4,096 rows at most
        grams = grams.where(F.col("toxic") + F.col("ordinary") >= least_count([(r.c, r.n) for r in sizes], max_grams))
    got, columns = grams.orderBy("gram").toArrow(), []
    for name in ("gram", "toxic", "ordinary"):
        columns.append(got.column(name).to_numpy())
        got = got.drop_columns([name])
    model = Model.of(*columns)
    del got, columns
    trim()  # the driver is small too
    if model.constant is None:
        sent = spark.sparkContext.broadcast(model)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = sent.value.features(b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*(pa.array(x[:, k]) for k in range(3)), b.column(1)], ["a", "b", "c", "toxic"])

        measured = texts.join(linked, "doc_id").select("text", "toxic").mapInArrow(trimming(measure), "a double, b double, c double, toxic int")
        model.fit_link(scratch.save(measured, "link"))
        scratch.drop("link")
        sent.destroy()
    scratch.drop("labels", "grams")
    trim()
    return model


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """All columns of docs and the score of each whole text, 0 to 1."""
    arrow_batches(docs.sparkSession)
    docs = docs.drop(column)
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = sent.value.scores([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], [*b.schema.names, column])

    return docs.mapInArrow(trimming(run), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs."""
    scored = score(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")), fit(docs, labels, max_labelled))
    return scored.select("doc_id", (folds() == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
