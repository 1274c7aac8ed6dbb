"""Operator 5: best-fit packing of tokenized documents, by sums of squares.

Each document becomes its token ids and an end id. Only documents longer
than the capacity are cut, into capacity-long pieces. A piece goes to the
open sequence for which the sum, over the gaps 1..capacity-1, of the squared
number of open sequences with that gap becomes smallest; ties go to the
smaller gap left. A new sequence is opened only when no open one has room
(the plain rule, which may open one at any time, took 0.2 % more sequences).
Pieces come longest first.

Packing needs only lengths, so shards of at most SHARD pieces pack on their
own, whatever key the documents have. What lies in sequences that stayed
more than `slack` short of full is packed again with that of the other
shards, until one shard holds the rest or a round no longer helps.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, prepare, save, small

CAPACITY = 4096
END_ID = 1
SHARD = 20_000
SLACK = 8             # tokens that a sequence may lack to be kept in a round
CACHE = 250_000       # words whose ids a worker remembers

_ITEM = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_WORD_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")  # no apostrophe: it may begin a word part


class _Known(dict):
    """Ids of blank-free runs; a run that is not known yet is noted."""

    def __init__(self):
        super().__init__({"": b""})
        self.noted: set[str] = set()

    def __missing__(self, run: str) -> None:
        self.noted.add(run)


class WordIds:
    """Ids of whole texts as the tokenizer gives them.

    Its words never cross blanks, so the ids of blank-free runs are found
    once and remembered: letters followed by marks are the ids of either
    part; plain Latin words, each a word of its own, are encoded together.
    """

    def __init__(self, spec: str, cache: int = CACHE):
        self.cache = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = _Known()

    def _learn(self) -> None:
        known = self.known
        todo, known.noted = known.noted, set()
        parts = {w: m.groups() for w in todo if (m := _WORD_MARKS.fullmatch(w))}
        need = {x for p in parts.values() for x in p if x not in known} | todo.difference(parts)
        plain = [w for w in need if w.isalpha() and w.islower() and max(w) < "\u0250"]
        for a in range(0, len(plain), 1000):
            some = plain[a:a + 1000]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ends = np.flatnonzero(np.diff(np.array([*e.word_ids, -1]))) + 1
            ids, start = np.array(e.ids, dtype="<u4").tobytes(), 0
            for w, end in zip(some, (4 * ends).tolist(), strict=True):
                known[w] = ids[start:end]
                start = end
        rest = [w for w in need if w not in known]
        for w, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, dtype="<u4").tobytes()
        for w, (x, y) in parts.items():
            known[w] = known[x] + known[y]

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cache:
            self.known = _Known()
        runs, out = [], []
        for t in texts:
            if "<" not in t and "Σ" not in t:  # no special token; lower case doesn't depend on neighbours
                t = t.lower()
            runs.append(t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
        for r in runs:
            found = list(map(self.known.__getitem__, r))
            out.append(None if self.known.noted and None in found else b"".join(found))
        if self.known.noted:
            self._learn()
            out = [b"".join(map(self.known.__getitem__, r)) if o is None else o for r, o in zip(runs, out, strict=True)]
        return out


_tokenizers: dict[tuple[str, int], WordIds] = {}


def _word_ids(spec: str, cache: int) -> WordIds:
    """One per worker and file, so that what it remembers serves all tasks."""
    if (spec, cache) not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[spec, cache] = WordIds(spec, cache)
    return _tokenizers[spec, cache]


def _pieces(spec, capacity: int, end_id: int, with_ids: bool, cache: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(spec.value, cache)
        for batch in small(batches, 256):
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for i, ids in zip(batch.column(0).to_pylist(), words.of(texts), strict=True):
                ids += end
                for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[s:s + 4 * capacity]
                    for name, v in zip(out, (i, k, s // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None), strict=True):
                        out[name].append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))
    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's gap."""
    order = np.argsort(-lengths, kind="stable")
    count = np.zeros(capacity + 1, dtype=np.int64)   # open bins by gap; 0 and capacity stay 0
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    used = 0
    for i in order:
        s = int(lengths[i])
        gap = capacity
        if s < capacity:
            here = count[s:capacity]
            after = count[:capacity - s].copy()
            change = 2 * (after - here) + 2
            change[0] = 1 - 2 * here[0]
            change[here == 0] = 1 << 40
            at = int(change.argmin())     # the first: the smallest gap left
            if here[at]:  # something open has room
                gap = s + at
        if gap == capacity:
            b = used
            used += 1
        else:
            b = stacks[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        left = gap - s
        if left:
            stacks[left].append(b)
            count[left] += 1
    gaps = np.zeros(used, dtype=np.int64)
    for g, held in enumerate(stacks):
        gaps[held] = g
    return bins, offsets, gaps


def _pack_shard(capacity: int, slack: int, last: bool, first_id: int):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "ids_crc32", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        bins, offsets, gaps = sum_of_squares(shard["length"].to_numpy(), capacity)
        base = first_id + (int(shard["shard"].iloc[0]) << 20)
        done = np.ones(len(shard), dtype=bool) if last else gaps[bins] <= slack
        return shard.assign(sequence_id=np.where(done, base + bins, -1), offset=np.where(done, offsets, -1)).drop(columns="shard")
    return run


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, cache: int = CACHE,
         shard: int = SHARD, slack: int = SLACK) -> DataFrame:
    """Per piece of each row of `docs` (`doc_id`, `text`): doc_id, piece,
    start, length, ids_crc32, sequence_id, offset; with `with_ids` also the
    ids themselves (unsigned, 32 bits, little-endian).

    `tokenizer` is the path of a tokenizers file whose words don't cross
    blanks; the driver reads it. `cache` bounds the words a worker remembers,
    about 250 bytes each. A null or empty text is the end id alone.
    doc_id may be null or repeated; other columns are ignored. No rows give
    no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    docs = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items, items_path = save(docs.mapInArrow(_pieces(spec, capacity, end_id, with_ids, cache), _ITEM), "op5-pieces")
    packed = items.where(F.col("length") == capacity).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = items.where(F.col("length") < capacity)
    schema = f"{_ITEM}, sequence_id long, offset long"
    parts, paths, n, turn = [packed], [], left.count(), 0
    while n:
        turn += 1
        shards = -(-n // shard)
        # rows are dealt by where they lie, so equal rows spread too
        dealt = left.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
        last = shards == 1
        out = dealt.groupBy("shard").applyInPandas(_pack_shard(capacity, slack, last, turn << 56), schema)
        out, path = save(out, "op5-round")
        paths.append(path)
        if not last:
            rest = out.where("sequence_id < 0")
            m = rest.count()
            if m > 0.7 * n:  # hardly anything fills a sequence: keep what the shards have found
                last = True
                out, path = save(dealt.groupBy("shard").applyInPandas(_pack_shard(capacity, slack, True, turn << 56), schema), "op5-round")
            n = m
        parts.append(out.where("sequence_id >= 0"))
        if last:
            break
        left = rest.drop("sequence_id", "offset")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*names, *(["ids"] if with_ids else []))


