"""Operator 7: language by the nearest centroid.

A text becomes a vector of hashed byte n-grams (lengths 1 to 3) of its
lower-cased letters; digits, marks and blanks count as one blank. Weights
are log(1 + count) times inverse document frequency, normalised. Each
language has a few centroids from spherical k-means. A text gets the
language of the centroid with the largest cosine; a cosine below the floor
for texts of its length rejects it.

The classifier is fitted on a bounded sample: at most `sample` distinct texts
of each language, in the order of their hash, whole texts. Their
vectors go to the driver: at most `sample` x DIMS counts a language, for at
most MAX_LANGS languages (those of the most distinct texts). All texts are predicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, prepare, save, small

DIMS = 1 << 12
SAMPLE = 400
MAX_LANGS = 400
CENTROIDS = 4
PARTS = 256        # groups of partitions that sample on their own first
FLOOR = 0.5        # of the smallest cosine of sample texts of that length or shorter
UNKNOWN = "und"

_LETTERS = np.full(256, 32, dtype=np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of one whole text."""
    x = _LETTERS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = x[keep]
    two = x[:-1] << np.uint32(8) | x[1:]
    three = two[:-1] << np.uint32(8) | x[2:]
    codes = np.concatenate((x[x != 32], two + np.uint32(1 << 25), three + np.uint32(1 << 26)))
    slot = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
    return np.bincount(slot, minlength=DIMS)


def _normal(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=-1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def _length_class(grams: float) -> int:
    return min(23, int(np.log2(max(1.0, grams))))


def _sample_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches, 100):
        counts = [gram_counts(t).astype(np.int32) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in counts], pa.binary())], ["lang", "counts"])


class Centroids:
    """A fitted classifier: languages, idf, centroids and rejection floors."""

    def __init__(self, langs: list[str], counts: np.ndarray, k: int, floor: float):
        self.names = sorted(set(langs))
        self.idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
        v = self.vectors(counts)
        of = np.array([self.names.index(x) for x in langs])
        parts = [self._cluster(v[of == i], k) for i in range(len(self.names))]
        self.centres = np.concatenate(parts).astype(np.float32)
        self.owner = np.repeat(np.arange(len(self.names)), [len(p) for p in parts])
        best = (v @ self.centres.T).max(1)
        size = np.array([_length_class(x) for x in counts.sum(1)])
        lows = [best[size >= c].min() if (size >= c).any() else 1.0 for c in range(24)]
        self.floor = floor * np.minimum.accumulate(np.array(lows)[::-1])[::-1]
        # no sample that short: what the shortest sample texts reach, less as the square root of the length
        first = int(size.min())
        for c in range(first):
            self.floor[c] = self.floor[first] * 2 ** ((c - first) / 2)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _normal(np.log1p(counts).astype(np.float32) * self.idf)

    @staticmethod
    def _cluster(v: np.ndarray, k: int) -> np.ndarray:
        centres = v[np.linspace(0, len(v) - 1, min(k, len(v))).astype(int)]
        for _ in range(12):
            at = (v @ centres.T).argmax(1)
            centres = _normal(np.stack([v[at == i].mean(0) if (at == i).any() else centres[i] for i in range(len(centres))]))
        return centres

    def predict(self, counts: np.ndarray) -> tuple[str, float, bool]:
        cos = self.centres @ self.vectors(counts)
        i = int(cos.argmax())
        score = float(min(1.0, max(0.0, cos[i])))
        return self.names[self.owner[i]], score, score < self.floor[_length_class(counts.sum())]


def fit(docs: DataFrame, *, sample: int = SAMPLE, centroids: int = CENTROIDS, floor: float = FLOOR) -> Centroids | None:
    """A classifier of the rows with a text and a lang; None without any."""
    prepare(docs.sparkSession)
    rows = columns(docs, "text", "lang").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if sample < 1:
        return None
    rows = rows.withColumn("h", F.xxhash64("text"))
    hashes, _ = save(rows.select("lang", "h").distinct(), "op7-hashes")
    top = hashes.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS).select("lang")
    # first among parts, so that no task sorts what all partitions pass on for a language
    few = hashes.withColumn("part", F.spark_partition_id() % PARTS)
    for group in ("lang, part", "lang"):
        few = few.withColumn("r", F.expr(f"row_number() over (partition by {group} order by h)")).where(F.col("r") <= sample).drop("r")
    few, _ = save(few.select("lang", "h").join(top, "lang", "left_semi"), "op7-sample")
    got = rows.join(few, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text")
    got = got.mapInArrow(_sample_vectors, "lang string, counts binary").orderBy("lang", "counts").collect()
    if not got:
        return None
    counts = np.stack([np.frombuffer(r["counts"], dtype=np.int32) for r in got])
    return Centroids([r["lang"] for r in got], counts, centroids, floor)


def predict(docs: DataFrame, model: Centroids | None) -> DataFrame:
    """All rows and columns of `docs` with `lang_pred`, `score` and
    `rejected`. `und`, score 0 and rejected: a null text, one without a
    letter, or no model. Other columns never take part; a column of one of
    these names is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    held = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    at = keep.index("text")
    has = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("__letter")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in small(batches):
            out = [m.predict(gram_counts(t)) if ok and m else (UNKNOWN, 0.0, True)
                   for t, ok in zip(b.column(at).to_pylist(), b.column(len(keep)).to_pylist(), strict=True)]
            lang, score, no = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(no, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"])

    return docs.select("*", has).mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(doc_id="doc_id"):
    """crc32 of the id's text is a multiple of 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, **fitted) -> DataFrame:
    """`predict` with a classifier learned from the rows not held out."""
    model = fit(docs.where(~held_out() & F.col("doc_id").isNotNull()), **fitted)
    return predict(docs, model)
