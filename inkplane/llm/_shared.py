"""What several operators of this subpackage need: tables, scratch tables, hashing of ids."""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch

#: Rows of an Arrow batch. Texts are whole, so a batch is bounded by this many texts.
ARROW_ROWS = 512
#: The same for rows of a few numbers.
SLIM_ROWS = 16_384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Bounds the batches that go to Python workers, so long texts don't pile up in one. All operators
    set the same, since plans read it when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def trim() -> None:
    """Gives memory that this process holds but doesn't use back to the system."""
    pa.default_memory_pool().release_unused()
    if (libc := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        libc(0)


def trimming(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, for mapInArrow; when it ends, memory that the worker process holds but doesn't use goes back to the
    system. Workers live on for later tasks and stages, next to an executor's heap."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Characters that are hashed at once; a longer text is cut at white space.
HASHED_CHARS = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: White space as str.split has it; the entry behind the last stands for all other characters.
SPACES = np.array([chr(c).isspace() for c in range(0x3002)])
_SPACE = re.compile(r"\s")


@functools.cache
def _powers(n: int, base: int) -> np.ndarray:
    return np.cumprod(np.array([1] + [base] * (n - 1), np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def hashes_of_words(codes: np.ndarray, blank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k hashes (k, words) of the stretches of codes between blank ones, and where they begin; the first and the last code are blank."""
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    if not len(start):
        return np.zeros((k, 0), np.uint64), start
    inside, offset = codes[~blank].astype(np.uint64), np.cumsum(size) - size
    place = np.arange(len(inside), dtype=np.int32) - np.repeat(offset.astype(np.int32), size)
    inside = (inside + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    inside ^= inside >> np.uint64(32)
    longest = 1 << int(size.max()).bit_length()
    return np.stack([mixed(np.add.reduceat(inside * _powers(longest, b)[place], offset)) for b in _BASES[:k]]), start


def _pieces(texts: list[str]) -> Iterator[tuple[int, str]]:
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at > HASHED_CHARS and (cut := _SPACE.search(t, at + HASHED_CHARS)):
            yield i, t[at : cut.start()]
            at = cut.start()
        yield i, t[at:] if at else t


def hashed_words(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """k hashes (k, words) of all words of the texts, split as str.split does, and the number of words of each."""
    parts, counts = [np.zeros((k, 0), np.uint64)], np.zeros(len(texts), np.int64)
    batch: list[str] = []
    of: list[int] = []

    def flush() -> None:
        joined = "\n" + "\n".join(batch) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        found, start = hashes_of_words(codes, SPACES[np.minimum(codes, len(SPACES) - 1)], k)
        begins = np.cumsum([0] + [len(t) + 1 for t in batch])
        np.add.at(counts, of, np.diff(np.searchsorted(start, begins)))
        parts.append(found)
        batch.clear()
        of.clear()

    size = 0
    for i, piece in _pieces(texts):
        batch.append(piece)
        of.append(i)
        size += len(piece)
        if size >= HASHED_CHARS:
            flush()
            size = 0
    if batch:
        flush()
    return np.concatenate(parts, axis=1), counts


class Scratch(scratch.Scratch):
    """Scratch tables whose writing runs Python functions."""

    def save(self, df: DataFrame, name: str, slim: bool = False, hashes: bool = False) -> DataFrame:
        """Writes df and reads it again. slim: its Python functions get rows of a few numbers, so many in a batch.
        hashes: its columns are mostly hashes, which neither a dictionary nor compression makes smaller."""
        if slim:
            self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SLIM_ROWS))
        try:
            return super().save(df, name, {"compression": "none", "parquet.enable.dictionary": "false"} if hashes else {})
        finally:
            if slim:
                arrow_batches(self.spark)
