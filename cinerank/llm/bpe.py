"""Operator 10: byte-level BPE by a tokenization automaton.

The merges compile into a deterministic automaton over tokens whose paths
are exactly the correct tokenizations. It starts with one state in which
every byte loops. The gadget of a merge (a, b) -> c gives a a state of its
own without the arc b, and every state with an arc a also an arc c to where
the arc b led. A state so belongs to the last token read, and what a gadget
copies or removes is settled by when the two tokens of an arc came to be.
So the arcs are worked out when first needed and kept in the table
(`Automaton.arc`); all of them at once would be 50k x 50k.

A pre-split word is encoded by transitions of that table: for each prefix
there is exactly one last token that an arc leads to. Which tokens end at a
byte is read off in one pass over the word, by a string matcher of the arcs'
labels. Decoding emits the byte labels of the arcs.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, prepare, small

# How byte-level vocabularies print bytes, and how they split words.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

KNOWN = 600_000    # words, and as many arcs, that a worker remembers
_ODD_BLANK = re.compile(r"[^\S \n]|  | \n|\n |\n\n")


class Automaton:
    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        label = {i: bytes(_BYTE[c] for c in t) for t, i in model["vocab"].items() if all(c in _BYTE for c in t)}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        label |= {i: t.encode() for t, i in self.special.items()}
        self.label = [label.get(i, b"") for i in range(max(label, default=-1) + 1)]
        special = set(self.special.values())
        self.token = {b: i for i, b in label.items() if i not in special}
        self.size = [len(b) for b in self.label]
        self.made = [0] * len(self.label)            # the merge that made a token; 0 for bytes
        self.left, self.right = [-1] * len(self.label), [-1] * len(self.label)
        self.merge: dict[tuple[int, int], int] = {}
        for n, m in enumerate(model["merges"], 1):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y, c = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merge[x, y] = n
            self.made[c], self.left[c], self.right[c] = n, x, y
        self.ending = ahocorasick.Automaton()        # one character a byte
        for b, i in self.token.items():
            if b:
                self.ending.add_word(b.decode("latin-1"), i)
        if len(self.ending):
            self.ending.make_automaton()
        self.arcs: dict[tuple[int, int], bool] = {}

    def arc(self, t: int, u: int) -> bool:
        """Whether the finished automaton has an arc u in the state of t."""
        known = self.arcs.get((t, u))
        if known is None:
            if len(self.arcs) >= KNOWN:
                self.arcs.clear()
            known = self.arcs[t, u] = self._built(t, u, len(self.merge) + 1)
        return known

    def _built(self, t: int, u: int, now: int) -> bool:
        """Whether that arc is there once the gadgets up to `now` are in."""
        made, left, right, merge = self.made, self.left, self.right, self.merge
        while True:
            n = merge.get((t, u))
            if n is not None and n <= now:
                return False                              # a gadget took it away
            r, s = made[t], made[u]
            if r > s:                                     # t's state is a copy of its right half's, from before its gadget
                t, now = right[t], r - 1
            elif s > r:                                   # the gadget gave u to the states with an arc for its left half
                u, now = left[u], s
            elif not r:
                return True                               # a loop of the first state
            else:                                         # the arc of a token in its own state
                t, u, now = right[t], left[t], r - 1

    def encode(self, word: bytes) -> list[int]:
        """The ids of one pre-split word. The first state has an arc for
        every token; elsewhere the table says."""
        n, size, arcs = len(word), self.size, self.arcs
        if not n:
            return []
        last = [-1] * (n + 1)
        for end, u in self.ending.iter(word.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - size[u]
                if not start:
                    last[end] = u
                elif (t := last[start]) >= 0:
                    known = arcs.get((t, u))
                    if known or known is None and self.arc(t, u):
                        last[end] = u
        out = []
        while n > 0:
            u = last[n]
            out.append(u)
            n -= size[u]
        return out[::-1]


class _Known(dict):
    """Decimal ids and ids of text between blanks, with the blank before it."""

    def __init__(self, coder: Coder, before: str):
        super().__init__()
        self.coder, self.before = coder, before

    def __missing__(self, part: str) -> tuple[str, list[int]]:
        if len(self) >= KNOWN:
            self.clear()
        ids = self.coder.plain(self.before + part)
        self[part] = out = (",".join(map(str, ids)), tuple(ids))
        return out


class Coder:
    """Encodes and decodes whole texts."""

    def __init__(self, spec: str):
        self.automaton = Automaton(spec)
        self.words: dict[str, list[int]] = {}
        self.after_blank, self.first = _Known(self, " "), _Known(self, "")
        special = sorted(self.automaton.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def plain(self, text: str) -> list[int]:
        """Ids of text without special tokens."""
        out: list[int] = []
        for w in (text,) if text.isascii() and text.isalpha() else _WORDS.findall(text):
            ids = self.words.get(w)
            if ids is None:
                if len(self.words) >= KNOWN:
                    self.words.clear()
                ids = self.automaton.encode(w.encode())
                if len(w) < 64:
                    self.words[w] = tuple(ids)
            out += ids
        return out

    def encode(self, text: str) -> tuple[list[str], list[list[int]]]:
        """Ids in parts: as decimal text and as numbers."""
        if self.special and any(s in text for s in self.automaton.special):
            ids = []
            for piece in self.special.split(text):
                ids += [self.automaton.special[piece]] if piece in self.automaton.special else self.plain(piece)
            return [",".join(map(str, ids))], [ids]
        if not text or _ODD_BLANK.search(text) or text[0] in " \n" or text[-1] in " \n":
            ids = self.plain(text)
            return [",".join(map(str, ids))] if ids else [], [ids]
        # single blanks and newlines only: words can't reach across them
        found = []
        for k, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if k:
                found.append(self.first["\n"])
            found.append(self.first[parts[0]])
            found += map(self.after_blank.__getitem__, parts[1:])
        decimal, ids = zip(*found, strict=True)
        return list(decimal), list(ids)

    def decode(self, parts: list[list[int]]) -> str:
        return b"".join(map(self.automaton.label.__getitem__, chain.from_iterable(parts))).decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def coder(spec: str) -> Coder:
    """One per worker and file, so that what it remembers serves all tasks."""
    if spec not in _coders:
        _coders.clear()
        _coders[spec] = Coder(spec)
        gc.freeze()   # the tables stay: nothing for the collector to look through
    return _coders[spec]


def _spec(docs: DataFrame, tokenizer: str):
    prepare(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _texts(docs: DataFrame) -> DataFrame:
    return columns(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """`doc_id, ids array<int>` of each row of `docs` (`doc_id`, `text`). A
    null text counts as empty: no ids. doc_id may be null or repeated, other
    columns are ignored; no rows give no rows. `tokenizer` is the path of a
    byte-level BPE file, read by the driver; its special tokens in a text
    are special."""
    spec, docs = _spec(docs, tokenizer), _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(spec.value)
        for b in small(batches, 256):
            ids = [list(chain.from_iterable(c.encode(t or "")[1])) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """`doc_id, text` from `encode`'s rows; null ids give an empty text."""
    spec = _spec(encoded, tokenizer)
    encoded = columns(encoded, "doc_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(spec.value)
        for b in small(batches):
            texts = [c.decode([ids or []]) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per row of `docs`, as for `encode`: doc_id, n_tokens, ids_sha256 of
    the decimal ids joined by commas, decoded_sha256 of the decoded text."""
    spec, docs = _spec(docs, tokenizer), _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(spec.value)
        for b in small(batches):
            n, ids_hash, text_hash = [], [], []
            for t in b.column(1).to_pylist():
                decimal, ids = c.encode(t or "")
                n.append(sum(map(len, ids)))
                ids_hash.append(hashlib.sha256(",".join(decimal).encode()).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
