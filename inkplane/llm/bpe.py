"""Exact byte-level BPE by dynamic programming over prefixes.

For every prefix of a word there is exactly one token that can be the last of its encoding: of the
vocabulary's tokens that end there (found by an automaton over the tokens with suffix links), the
one that is compatible with the last token of what stands before it. Two tokens are compatible when
merging by rank never joins anything over their border. The last tokens are stored by prefix;
following them back from the end gives the ids the merge rules give. No merge is simulated on texts.

Defined cases: a null text is an empty one, with no ids; rows that repeat, or have no id, are encoded each; a
word of any length, also a long text without white space, is encoded whole, with one list entry for each of its bytes;
special tokens inside texts are what the tokenizer's file says (a match is one id); undecodable ids become
U+FFFD, as in the library; an empty table gives none; other columns are kept, but for those that are set.
"""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import arrow_batches, text_or_empty, trimming

#: Fixed value: the pre-tokenizer pattern of byte-level BPE, with white space by Unicode's property. Words come
#: first, which changes nothing (contractions begin with an apostrophe) and is faster.
WORDS = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words kept with their encoding while a task runs (id_digests: a worker), in two generations: a full one becomes the old one,
#: and words asked for again move to the young one. Results don't depend on it.
CACHE_WORDS = 200_000
#: Pairs of tokens kept with their compatibility; a full cache is emptied.
CACHE_PAIRS = 400_000
#: Longer words are encoded each time, so that the cache is bounded in bytes too.
CACHE_CHARS = 64
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Words(dict):
    """Pieces of text with their ids joined by commas and the bytes these decode to, found when first asked for."""

    def __init__(self, bpe: PrefixBPE, most: int = CACHE_WORDS):
        super().__init__()
        self.bpe, self.old, self.most = bpe, {}, most

    def __missing__(self, piece: str) -> tuple[str, bytes]:
        if (found := self.old.get(piece)) is None:
            bpe = self.bpe
            ids = [bpe.added[piece]] if piece in bpe.added else bpe.encode_word(piece.encode())
            found = ",".join([bpe.digits[i] for i in ids]), b"".join([bpe.bytes_of[i] for i in ids])
        if len(piece) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class PrefixBPE:
    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text())
        model, stand_in = spec["model"], byte_alphabet()
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a plain byte-level BPE file is needed")
        self.bytes_of = {i: bytes(stand_in[c] for c in t) for t, i in model["vocab"].items() if all(c in stand_in for c in t)}
        id_of = model["vocab"]
        self.rank: dict[int, int] = {}  # by left << 20 | right
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}  # the rank of the merge that makes a token; -1: a byte
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            whole = id_of[a + b]
            self.rank[id_of[a] << 20 | id_of[b]] = r
            if whole not in self.parts:
                self.parts[whole], self.born[whole] = (id_of[a], id_of[b]), r
        self.born |= {i: -1 for i, b in self.bytes_of.items() if len(b) == 1}
        self._fits: dict[int, dict[int, bool]] = {}  # by left and right
        self._pairs = 0
        self._edges: tuple[dict[int, list], dict[int, list]] = {}, {}
        self.automaton = ahocorasick.Automaton()
        for i, b in self.bytes_of.items():
            if len(b) == 1 or i in self.parts and self._meets(*self.parts[i], self.born[i]):
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.digits = {i: str(i) for i in self.bytes_of}
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(WORDS)
        self.kept: Words | None = None

    def _meets(self, left: int, right: int, before: int) -> bool:
        """Whether both stand side by side until merges of rank before: no merge over their border comes earlier.

        The border's tokens change as each side grows: on the left along last parts, on the right
        along first parts. A pair of them can merge while both exist; at equal ranks the merge
        further left comes first.
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        i, j = len(a), len(b)
        x, x_ends = a[-1] if i else (left, before)
        y, y_ends = b[-1] if j else (right, before)
        rank = self.rank
        while True:
            r = rank.get(x << 20 | y, NEVER)
            if r < x_ends and (r <= y_ends if y_ends < before else r < y_ends):
                return False
            if i == 0 and j == 0:
                return True
            if j == 0 or i and x_ends <= y_ends:
                i -= 1
                x, x_ends = a[i - 1] if i else (left, before)
            else:
                j -= 1
                y, y_ends = b[j - 1] if j else (right, before)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at a token's left (0) or right (1) edge before it is made, the latest first, and the rank at
        which each ends."""
        known = self._edges[side]
        if (found := known.get(token)) is None:
            found = known[token] = []
            while token in self.parts:
                found.append((self.parts[token][side], self.born[token]))
                token = found[-1][0]
        return found

    def fits(self, left: int, right: int) -> bool:
        known = self._fits.get(left)
        if known is None or (found := known.get(right)) is None:
            if self._pairs >= CACHE_PAIRS:
                self._fits.clear()
                self._pairs = 0
            found = self._fits.setdefault(left, {})[right] = self._meets(left, right, NEVER)
            self._pairs += 1
        return found

    def encode_word(self, word: bytes) -> list[int]:
        last, size = [-1] * (len(word) + 1), [0] * (len(word) + 1)  # by prefix length: its last token and that one's length
        known, none = self._fits, {}
        for end, (token, n) in self.automaton.iter(word.decode("latin-1")):
            if last[end + 1] < 0:
                start = end + 1 - n
                if start:
                    before = last[start]
                    if before < 0:
                        continue
                    if (ok := known.get(before, none).get(token)) is None:
                        ok = self.fits(before, token)
                    if not ok:
                        continue
                last[end + 1], size[end + 1] = token, n
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def pieces(self, text: str) -> list[str]:
        """Words, with special tokens as pieces of their own."""
        if self.split is None or not any(t in text for t in self.added):
            return self.words.findall(text)
        out = []
        for k, part in enumerate(self.split.split(text)):
            out += [part] if k % 2 else self.words.findall(part)
        return out

    def encode(self, text: str, words: Words | None = None) -> list[int]:
        words = Words(self) if words is None else words
        joined = ",".join([words[p][0] for p in self.pieces(text)])
        return list(map(int, joined.split(","))) if joined else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


_LOADED: dict[str, PrefixBPE] = {}  # one for each worker process; what tasks cache goes with them


def loaded(path: str) -> PrefixBPE:
    if path not in _LOADED:
        _LOADED[path] = PrefixBPE(path)
    return _LOADED[path]


def with_ids(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """All columns of docs and token_ids array<int> of each whole text; on demand decoded too, the text
    that these stand for. Columns of these names in docs are replaced."""
    arrow_batches(docs.sparkSession)
    names = ["token_ids", "decoded"] if decoded else ["token_ids"]
    docs = docs.drop(*names)
    at = docs.columns.index("text")

    def run(batches):
        bpe = loaded(tokenizer)
        words = Words(bpe)
        for b in batches:
            ids = pa.array([bpe.encode(t or "", words) for t in b.column(at).to_pylist()], pa.list_(pa.int32()))
            more = [pa.array([bpe.decode(x) for x in ids.to_pylist()], pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*b.columns, ids, *more], [*b.schema.names, *names])

    kinds = [T.ArrayType(T.IntegerType()), T.StringType()]
    return docs.mapInArrow(trimming(run), T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=False))]))


def with_text(rows: DataFrame, tokenizer: str) -> DataFrame:
    """All columns of rows and decoded, the text that token_ids stand for."""
    arrow_batches(rows.sparkSession)
    rows = rows.drop("decoded")
    at = rows.columns.index("token_ids")

    def run(batches):
        bpe = loaded(tokenizer)
        for b in batches:
            texts = [None if ids is None else bpe.decode(ids) for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def id_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text, encoded and decoded again."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        bpe = loaded(tokenizer)
        words = bpe.kept = bpe.kept or Words(bpe)  # by this worker's later tasks too
        for b in batches:
            n, ids, back = [], [], []
            for text in b.column(1).to_pylist():
                found = [words[p] for p in bpe.pieces(text)]
                joined = ",".join([f[0] for f in found])
                n.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(b"".join([f[1] for f in found]).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(trimming(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
