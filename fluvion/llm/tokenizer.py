"""Byte-pair encoding of a corpus by a tokenization automaton.

A vocabulary's merges, taken in order, build the automaton. Each merge u+v -> w adds a gadget: an arc labelled w
beside the path u, v, and a bar on walking v straight after u. What is left is deterministic: a byte string has
exactly one path, so the last token of every prefix is fixed, and a text is encoded left to right by table
look-ups alone, without a queue of merges. The byte side of the automaton is a trie with failure links over all
arc labels; the bars of composite tokens follow from the gadgets of their parts and are stored as the
encoder first needs them. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pre-split pattern that belongs to the byte_bpe vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def load_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> bytes:
    """The vocabulary file (base64 token and id a line), under 1 MB."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return f.read()


class Automaton:
    """The tokenization automaton of one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        self.labels: dict[int, bytes] = {}
        for line in ranks.splitlines():
            token, i = line.split()
            self.labels[int(i)] = base64.b64decode(token)
        ids = {t: i for i, t in self.labels.items()}
        self.words = regex.compile(pattern).findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self._build(ids)

    def _build(self, ids: dict[bytes, int]) -> None:
        self.byte_arc = [ids.get(bytes([b]), -1) for b in range(256)]
        self.parts: dict[int, tuple[int, int]] = {}  # of an arc: the two arcs that its gadget replaced
        self.gadget: dict[tuple[int, int], int] = {}
        self.apart: dict[int, bool] = {}  # (u << 20 | v): may v follow u
        # trie over labels: child[(node << 8) | byte]; arc[node] is the label that ends there
        self.child: dict[int, int] = {}
        arc, depth, order = [-1], [0], []
        for i in sorted(self.labels):
            label = self.labels[i]
            if len(label) > 1:
                self._add_gadget(i, label, ids)
            node = 0
            for b in label:
                k = node << 8 | b
                nxt = self.child.get(k)
                if nxt is None:
                    nxt = len(arc)
                    self.child[k] = nxt
                    arc.append(-1)
                    depth.append(depth[node] + 1)
                    order.append((depth[nxt], node, b, nxt))
                node = nxt
            arc[node] = i
        fail = [0] * len(arc)
        for _, node, b, nxt in sorted(order):
            if node:
                f = fail[node]
                while f and (f << 8 | b) not in self.child:
                    f = fail[f]
                fail[nxt] = self.child.get(f << 8 | b, 0)
        # of a node, the nearest node on its failure path (itself included) that ends a label
        ends = list(range(len(arc)))
        for _, _, _, nxt in sorted(order):
            if arc[nxt] < 0:
                ends[nxt] = ends[fail[nxt]]
        self.arc, self.depth, self.fail, self.ends = arc, depth, fail, ends

    def _add_gadget(self, w: int, label: bytes, ids: dict[bytes, int]) -> None:
        """The gadget of one merge: its two parts are the path that the arcs made so far give for the label."""
        at = [ids[bytes([b])] for b in label]
        while len(at) > 2:
            best, where = w, -1
            for k in range(len(at) - 1):
                m = self.gadget.get((at[k], at[k + 1]), w)
                if m < best:
                    best, where = m, k
            if where < 0:
                break
            at[where : where + 2] = [best]
        if len(at) == 2:
            self.parts[w] = (at[0], at[1])
            self.gadget[at[0], at[1]] = w

    def follows(self, u: int, v: int) -> bool:
        """Whether arc v may be walked straight after arc u.

        The merges that could cross the border join the last part of u and the first part of v; they are looked at
        from the latest gadget downwards: one that was made before both sides were complete bars the pair.
        """
        key = u << 20 | v
        known = self.apart.get(key)
        if known is not None:
            return known
        a, b, limit = u, v, 1 << 30
        while True:
            w = self.gadget.get((a, b))
            if w is not None and w < limit:
                ok = False
                break
            # take apart the side that was made later; the other side existed by then
            if a > b or b not in self.parts:
                if a not in self.parts:
                    ok = True
                    break
                limit, a = a, self.parts[a][1]
            else:
                limit, b = b + 1, self.parts[b][0]
        self.apart[key] = ok
        return ok

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        child, arc, fail, ends, depth = self.child, self.arc, self.fail, self.ends, self.depth
        n = len(word)
        last = [-1] * (n + 1)  # the arc on which the only path of each prefix ends
        node = 0
        for i in range(n):
            b = word[i]
            while node and (node << 8 | b) not in child:
                node = fail[node]
            node = child.get(node << 8 | b, 0)
            e = ends[node]
            while e:
                start = i + 1 - depth[e]
                if not start or (last[start] >= 0 and self.follows(last[start], arc[e])):
                    last[i + 1] = arc[e]
                    break
                e = ends[fail[e]]
        out = []
        while n:
            out.append(last[n])
            n -= len(self.labels[last[n]])
        return tuple(out[::-1])

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text without special tokens; empty for null and empty text."""
        if not text:
            return []
        memo, out = self.memo, []
        for w in self.words(text):
            t = memo.get(w)
            if t is None:
                t = self.encode_word(w.encode())
                if len(w) <= 32:
                    if len(memo) >= 500_000:
                        memo.clear()
                    memo[w] = t
            out += t
        return out

    def count(self, text: str | None) -> int:
        return len(self.encode(text))

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.labels[i] for i in ids).decode("utf-8", errors="replace")


_compiled: dict[int, Automaton] = {}


def automaton(ranks: bytes) -> Automaton:
    """The automaton of a vocabulary, compiled once in a process."""
    key = hash(ranks)
    if key not in _compiled:
        _compiled[key] = Automaton(ranks)
    return _compiled[key]


def _mapped(df: DataFrame, column: str, out: str, out_type: pa.DataType, sql_type: str, ranks: bytes, how: str) -> DataFrame:
    keep = [c for c in df.columns if c != out]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name != "__text") + f", `{out}` {sql_type}"
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary: under 1 MB whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = getattr(automaton(shared.value), how)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                values = pa.array([work(x) for x in part.column(part.num_columns - 1).to_pylist()], out_type)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], values], names=[*keep, out])

    return src.mapInArrow(run, schema)


def encode_corpus(df: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds ``out``: array of token ids of ``text``, taken as it is, without special tokens (their strings are
    ordinary text). Null and empty texts give an empty list. Other columns stay; one named ``out`` is replaced.
    The vocabulary is read on the driver from ``folder`` and broadcast."""
    return _mapped(df, text, out, pa.list_(pa.int32()), "array<int>", load_ranks(name, folder), "encode")


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds ``out``: the number of tokens of ``text`` (0 for null and empty)."""
    return _mapped(df, text, out, pa.int64(), "bigint", load_ranks(name, folder), "count")


def decode_corpus(df: DataFrame, ids: str = "ids", out: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """Adds ``out``: the text whose tokens are ``ids`` (null gives an empty text)."""
    ranks = load_ranks(name, folder)
    keep = [c for c in df.columns if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[f"`{c}`" for c in keep]).schema.fields) + f", `{out}` string"
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    at = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = automaton(shared.value).decode
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([work(x or []) for x in batch.column(at).to_pylist()], pa.string())], names=[*keep, out])

    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)
