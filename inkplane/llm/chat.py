"""Chat formatting over prefix trees: turns that conversations share at their start stand once.

Conversations are sorted by the digests of their turns; that order is a depth-first walk of the
tree of all conversations, so one pass over a sorted partition writes each tree node when it first
appears and needs to remember one path only. The walk is cut into packs of bounded size: a pack has
the text of its nodes, and for each node its span in the pack, its parent, the position id of its
first character (as in the conversation alone) and the ancestors' spans that it may attend to, plus
the part of the span under the loss mask. A pack is one training sequence, so what its nodes attend to is
in it: a path that crosses a cut is written again in the next pack, and once in each.

With a tokenizer a pack has the token ids of its nodes too, each node's once, and every node its token
span, the position id of its first token, the spans of tokens it attends to and those under the loss mask.
A turn's head, text and end are encoded apart, so masks end where tokens do, and a node's tokens are the same
in all conversations.

Template: <|turn|>role, newline, text, <|end|>, newline. In texts and roles a backslash, < and [ are
written as a backslash with \\, l or b (in roles a newline too, as n), so no control string of this or
of another common template can stand in them, and reading back is exact. The mask covers the escaped
text of assistant turns. Lengths and positions count code points.

Defined cases: null text or role is empty; turns that tie follow by role and text; repeated rows are
turns of their own; rows without conv_id are each a conversation of one turn, with a null conv_id; equal
conversations share all nodes and are told apart by their leaf entries; an empty table has no packs; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch, arrow_batches, text_or_empty

TURN, END = "<|turn|>", "<|end|>\n"
_WRITTEN = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_ROLE = str.maketrans(_WRITTEN | {"\n": "\\n"})
_TEXT = str.maketrans(_WRITTEN)
_READ = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END), re.S)

PACK_CHARS = 65_536  # a pack is closed at the first conversation beyond it
PACK_CONVERSATIONS = 512


def escape(text: str) -> str:
    return text.translate(_TEXT)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _READ[m[1]], text) if "\\" in text else text


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its text in it, empty unless it is an assistant's."""
    head = f"{TURN}{role.translate(_ROLE)}\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + (len(body) if role == "assistant" else 0)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


SPAN = "struct<start:int,end:int>"
TOKENS = f"token_start:int,token_end:int,token_position:long,token_loss_start:int,token_loss_end:int,token_attends:array<{SPAN}>"
NODE = f"struct<start:int,end:int,parent:int,depth:int,position:long,loss_start:int,loss_end:int,attends:array<{SPAN}>,{TOKENS}>"
PACKS = f"formatted string, tokens array<int>, nodes array<{NODE}>, leaves array<struct<conv_id:long,node:int>>"

_ENCODERS: dict[str, object] = {}


#: Fixed value: the pre-tokenizer pattern of byte-level BPE, which files of ranks don't hold.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Heads and ends of turns are few and short; texts are each encoded once.
SHORT = 64


def _encoder(path: str | None):
    """A function text -> its token ids, from a file of ranks (.tiktoken) or a tokenizer's (.json); one for each
    worker process."""
    if path is not None and path not in _ENCODERS:
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            encode = lambda text: model.encode(text, add_special_tokens=False).ids
        short = functools.lru_cache(4096)(encode)
        _ENCODERS[path] = lambda text: short(text) if len(text) <= SHORT else encode(text)
    return _ENCODERS.get(path)


def _joined(spans: list[dict], start: int, end: int) -> list[dict]:
    """Spans and one more; such that touch are one interval."""
    if spans and spans[-1]["end"] == start:
        return [*spans[:-1], {"start": spans[-1]["start"], "end": end}]
    return [*spans, {"start": start, "end": end}]


class _Pack:
    """The nodes written so far, and the path to the last of them."""

    def __init__(self):
        self.texts, self.nodes, self.leaves, self.size = [], [], [], 0
        self.path: list[tuple[tuple[str, str], int]] = []

    def full(self) -> bool:
        return self.size >= PACK_CHARS or len(self.leaves) >= PACK_CONVERSATIONS

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        same = 0
        while same < min(len(turns), len(self.path)) and self.path[same][0] == turns[same]:
            same += 1
        del self.path[same:]
        for turn in turns[same:]:
            text, a, b = write_turn(*turn)
            up = self.nodes[self.path[-1][1]] if self.path else None
            spans = _joined(up["attends"], up["start"], up["end"]) if up else []
            position = up["position"] + up["end"] - up["start"] if up else 0
            self.nodes.append({"start": self.size, "end": self.size + len(text), "parent": self.path[-1][1] if self.path else -1, "depth": len(self.path), "position": position, "loss_start": self.size + a, "loss_end": self.size + b, "attends": spans})
            self.texts.append(text)
            self.size += len(text)
            self.path.append((turn, len(self.nodes) - 1))
        self.leaves.append({"conv_id": conv_id, "node": self.path[-1][1] if self.path else -1})

    def row(self, encode=None) -> dict:
        formatted = "".join(self.texts)
        return {"formatted": formatted, "tokens": self._tokens(formatted, encode) if encode else None, "nodes": self.nodes, "leaves": self.leaves}

    def _tokens(self, formatted: str, encode) -> list[int]:
        """The nodes' tokens in order; adds to nodes what tells of them."""
        out: list[int] = []
        for n in self.nodes:
            a, at, sizes = formatted.index("\n", n["start"]) + 1, len(out), []  # roles hold no newline
            for piece in (formatted[n["start"] : a], formatted[a : n["end"] - len(END)], END):
                ids = encode(piece)
                out += ids
                sizes.append(len(ids))
            up = self.nodes[n["parent"]] if n["parent"] >= 0 else None
            lost = n["loss_end"] > n["loss_start"]
            n |= {"token_start": at, "token_end": len(out), "token_position": up["token_position"] + up["token_end"] - up["token_start"] if up else 0, "token_loss_start": at + sizes[0], "token_loss_end": at + sizes[0] + (sizes[1] if lost else 0), "token_attends": _joined(up["token_attends"], up["token_start"], up["token_end"]) if up else []}
        return out


def format_conversations(conversations: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Packs (see PACKS) of all conversations, given conv_id, turn, role and text by row; with tokens if there is
    a tokenizer's file."""
    spark = conversations.sparkSession
    arrow_batches(spark)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text_or_empty().alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    whole = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.unionByName(rows.where("conv_id is null").select("conv_id", F.array("t").alias("turns")))
    # a step of the path is a digest of a turn; two turns with one digest still make two nodes, since nodes compare turns
    steps = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    whole = whole.withColumn("path", steps).repartitionByRange(F.col("path"), F.col("conv_id")).sortWithinPartitions("path", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("formatted", pa.string()), ("tokens", pa.list_(pa.int32())), ("nodes", _NODES), ("leaves", _LEAVES)])
        pack, encode = _Pack(), _encoder(tokenizer)
        for b in batches:
            for conv_id, turns in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pack.add(conv_id, [(t["role"], t["text"]) for t in turns])
                if pack.full():
                    yield pa.RecordBatch.from_pylist([pack.row(encode)], schema)
                    pack = _Pack()
        if pack.leaves:
            yield pa.RecordBatch.from_pylist([pack.row(encode)], schema)

    return whole.select("conv_id", "turns").mapInArrow(run, PACKS)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_OF_TOKENS = [("token_start", pa.int32()), ("token_end", pa.int32()), ("token_position", pa.int64()), ("token_loss_start", pa.int32()), ("token_loss_end", pa.int32()), ("token_attends", pa.list_(_SPAN))]
_NODES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("position", pa.int64()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("attends", pa.list_(_SPAN)), *_OF_TOKENS]))
_LEAVES = pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int32())]))

DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_packs(packs: DataFrame) -> DataFrame:
    """What the packs say of each conversation, read back along its leaf's attention spans (see DIGEST)."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k in range(b.num_rows):
                pack = b.slice(k, 1).to_pylist()[0]  # one at a time
                text, nodes = pack["formatted"], pack["nodes"]
                for leaf in pack["leaves"]:
                    path, k = [], leaf["node"]
                    while k >= 0:
                        path.append(nodes[k])
                        k = nodes[k]["parent"]
                    last = path[0] if path else None
                    seen = "".join(text[s["start"] : s["end"]] for s in [*last["attends"], last]) if last else ""
                    turns = read_turns(seen)
                    loss = "".join(unescape(text[n["loss_start"] : n["loss_end"]]) for n in reversed(path))
                    said = "".join(f"{r}\n{t}\n" for r, t in turns)
                    rows.append((leaf["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(seen)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return packs.select("formatted", "nodes", "leaves").mapInArrow(run, DIGEST)


def chat_digest(conversations: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The digest of every conversation, read back from the packs; these are written, tokens and all."""
    packs = Scratch(conversations.sparkSession, "chat").save(format_conversations(conversations, tokenizer), "packs")
    return read_packs(packs)


def digest_of(rows: list[tuple[int, str, str]]) -> tuple[int, str, int, str]:
    """The digest of one conversation from its rows, by its definition alone; for tests."""
    ordered = sorted((t, r or "", x or "") for t, r, x in rows)
    said = "".join(f"{r}\n{x}\n" for _, r, x in ordered)
    loss = "".join(x for _, r, x in ordered if r == "assistant")
    return len(ordered), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
