"""Operator 12: toxicity by a weighted finite-state pattern grammar.

Three transducers are composed into one table. The lexicon reads words, by
whole word or longest prefix, and writes classes with a weight: insult,
threat, intent, target, negation, report, quotation mark. The scope
transducer follows negation, reported speech and quotation within a clause
and marks the insults and threats they cover. The pattern transducer reads
marked classes and matches clauses: an insult alone, an insult with a target
before or after it, an intent or target with a threat. The best path through
the composition (max, +) gives a clause its matches; words outside a matched
clause add nothing. Matches add up by pattern and scope, and a logistic model
over those sums, their density, the strongest clause and the length gives the
score.

Learnt from at most `sample` distinct labelled texts, whole, in the order of
their hash: the weights of the lexicon, as lower bounds of a word's (or
prefix's) log odds between toxic and clean texts, and the logistic
coefficients. Sums for the latter come from a lexicon counted without the
text's own part (crc32 of its doc_id modulo 5), so that words known from one
text alone don't count as proof.
The model has at most `entries` lexicon entries, those of the highest bounds.
The word lists below are what is known without labels; learnt counts replace
their weights, and drop those that clean texts use as well.

Nulls: a null text counts as an empty one; a label of a null doc_id or a null
mark is not learnt from, of several for a doc_id the highest holds; a null
doc_id is not held out. Without labels the lists alone score. Repeated rows
are scored each. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import columns, drop, prepare, save, small

FOLDS = 5
SAMPLE = 20_000             # labelled texts that are learnt from, at most; all texts are scored
ENTRIES = 50_000
PREFIX, LONGEST = 4, 12     # lengths of prefixes that are counted
SUPPORT = 3                 # toxic texts a word needs
BOUND = 1.0                 # least log odds, at Z standard errors below the estimate
Z = 2.0
SAME = 0.8                  # of a prefix's toxic texts: then the longer entry stands for it
KNOWN = 3.0                 # weight of a listed insult or threat that labels don't cover
SPAN = 1 << 20              # code points looked at together, up to the end of a clause

INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE, CLAUSE = range(1, 9)

# Words known without labels, in English, German, French, Spanish.
INSULTS = """idiot idiots moron morons imbecile stupid scum scumbag bastard bitch asshole dumbass retard loser pathetic worthless
disgusting trash vermin idioten arschloch dummkopf abschaum hurensohn missgeburt schlampe wertlos widerlich imbécile connard connasse salaud
salope ordure crétin débile minable pendejo estúpido estúpida cabrón gilipollas mierda escoria basura inútil asqueroso asquerosa""".split()
THREATS = """kill murder strangle stab shoot slaughter destroy hurt töten umbringen erschießen abstechen vernichten tuer égorger abattre
massacrer frapper matar matarte asesinar degollar apuñalar golpear""".split()
INTENTS = "will gonna going shall werde werden vais allons voy vamos quiero".split()
TARGETS = "you your yours yourself u du dich dir dein deine euch ihr tu toi vous votre tes usted ustedes vosotros vuestro eres".split()
NEGATIONS = "not never don doesn isn aren wasn nobody neither nicht kein keine keinen niemals jamais aucun aucune nunca jamás tampoco".split()
REPORTS = "said says told wrote writes quoted quotes reported called sagte schrieb behauptete zitierte déclaré écrit raconté dijo escribió citó".split()

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"“”„«»]")
_STOP = re.compile(r"[.!?;\n]")


# -- transducers --------------------------------------------------------------

@dataclass
class Transducer:
    """arcs[state][symbol] = [(output, weight, next state)]; a symbol without
    an arc leaves the state and is passed on. `ends` has the final weights of
    the states a clause may end in."""
    arcs: dict = field(default_factory=dict)
    ends: dict = field(default_factory=dict)
    start: object = 0

    def step(self, state, symbol) -> list[tuple]:
        return self.arcs.get(state, {}).get(symbol) or [(symbol, 0.0, state)]


def compose(a: Transducer, b: Transducer, symbols) -> Transducer:
    """b after a, over the states that `symbols` reach."""
    out = Transducer(start=(a.start, b.start))
    todo = [out.start]
    while todo:
        at = todo.pop()
        if at in out.arcs:
            continue
        out.arcs[at] = {}
        if at[0] in a.ends and at[1] in b.ends:
            out.ends[at] = a.ends[at[0]] + b.ends[at[1]]
        for s in symbols:
            out.arcs[at][s] = [(z, v + w, (p, q)) for y, v, p in a.step(at[0], s) for z, w, q in b.step(at[1], y)]
            todo += [q for _, _, q in out.arcs[at][s]]
    return out


ASSERTED, NEGATED, REPORTED = "asserted", "negated", "reported"


def scopes() -> Transducer:
    """Marks insults and threats by what covers them in their clause: quotation
    or reported speech first, then negation."""
    t = Transducer(ends=dict.fromkeys([(n, r, q) for n in (0, 1) for r in (0, 1) for q in (0, 1)], 0.0), start=(0, 0, 0))
    for n, r, q in t.ends:
        how = REPORTED if r or q else NEGATED if n else ASSERTED
        t.arcs[n, r, q] = {NEGATION: [(None, 0.0, (1, r, q))], REPORT: [(None, 0.0, (n, 1, q))], QUOTE: [(None, 0.0, (n, r, 1 - q))],
                           INSULT: [((INSULT, how), 0.0, (n, r, q))], THREAT: [((THREAT, how), 0.0, (n, r, q))]}
    return t


BARE, AIMED, MENACE = "bare", "aimed", "menace"
PATTERNS = [(p, s) for p in (BARE, AIMED, MENACE) for s in (ASSERTED, NEGATED, REPORTED)]
AIM, PROMISE = 0.5, 0.5     # what a path gains where a target or an intent joins


def patterns() -> Transducer:
    """State 0: nothing yet; target: one was named; intent: one was uttered;
    owed: an insult was read as aimed at a target that still has to come."""
    t = Transducer(ends={0: 0.0, "target": 0.0, "intent": 0.0}, start=0)
    for state in (0, "target", "intent", "owed"):
        t.arcs[state] = {TARGET: [(None, 0.0, "target")], INTENT: [(None, 0.0, "owed" if state == "owed" else "intent")], None: [(None, 0.0, state)]}
        for s in (ASSERTED, NEGATED, REPORTED):
            if state == "target":
                insult = [((AIMED, s), AIM, "target")]
            elif state == "owed":
                insult = [((AIMED, s), AIM, "owed")]
            else:
                insult = [((BARE, s), 0.0, state), ((AIMED, s), AIM, "owed")]
            t.arcs[state][INSULT, s] = insult
            threat = [(None, 0.0, state)]
            if state in ("target", "intent"):
                threat = [((MENACE, s), PROMISE, state)]
            t.arcs[state][THREAT, s] = threat
    return t


GRAMMAR = compose(scopes(), patterns(), (INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT, QUOTE))


def parse(clause: list[tuple[int, float]], grammar: Transducer = GRAMMAR) -> tuple[float, tuple]:
    """The best path for the (class, weight) of a clause's words: its weight,
    and what it matched as ((pattern, scope), weight)."""
    best = {grammar.start: (0.0, ())}
    for kind, weight in clause:
        after: dict = {}
        for state, (total, found) in best.items():
            for out, gain, to in grammar.step(state, kind):
                won = weight if isinstance(out, tuple) else 0.0
                new = total + gain + won
                if to not in after or new > after[to][0]:
                    after[to] = (new, (*found, (out, won)) if won else found)
        best = after
    return max((best[s] for s in best if s in grammar.ends), key=lambda x: x[0], default=(0.0, ()))


# -- the lexicon --------------------------------------------------------------

class Lexicon(dict):
    """word -> (class, weight) or None, by whole word or longest prefix;
    remembers words it has looked up."""

    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries      # a prefix, or a whole word and "$"
        self.fixed: dict[str, tuple[int, float]] = {}
        for kind, words in ((INTENT, INTENTS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            for w in words:
                self.fixed[w] = (kind, KNOWN if kind == THREAT else 0.0)
        self.fixed |= {q: (QUOTE, 0.0) for q in "\"“”„«»"} | {c: (CLAUSE, 0.0) for c in ".!?;\n"}

    def __missing__(self, word: str):
        if len(self) > 1_000_000:
            self.clear()
        found = self.fixed.get(word)
        if not found:
            weight = self.entries.get(word + "$")
            for n in range(min(len(word), LONGEST), PREFIX - 1, -1):
                if weight is None:
                    weight = self.entries.get(word[:n])
            found = None if weight is None else (INSULT, weight)
        self[word] = found
        return found


def _spans(text: str) -> Iterator[str]:
    """The text in pieces that end with a clause."""
    at = 0
    while at < len(text):
        end = at + SPAN
        stop = _STOP.search(text, end) if end < len(text) else None
        end = stop.end() if stop else len(text)
        yield text[at:end].lower()
        at = end


def words_of(text: str) -> set[str]:
    return {w for span in _spans(text) for w in _TOKEN.findall(span)}


FEATURES = [*("-".join(p) for p in PATTERNS), "strongest", "clauses", "density", "length"]


def measure(text: str, lexicon: Lexicon) -> list[float]:
    """The features of a whole text, in the order of FEATURES."""
    sums, strongest, clauses, words = dict.fromkeys(PATTERNS, 0.0), 0.0, 0, 0
    for span in _spans(text):
        kinds = list(map(lexicon.__getitem__, _TOKEN.findall(span)))
        words += len(kinds)
        clause: list = []
        live = False
        for k in [*filter(None, kinds), (CLAUSE, 0.0)]:
            if k[0] != CLAUSE:
                clause.append(k)
                live = live or k[0] in (INSULT, THREAT)
                continue
            if live:
                total, found = parse(clause)
                strongest = max(strongest, total)
                clauses += bool(found)
                for pattern, weight in found:
                    sums[pattern] += weight
            clause, live = [], False
    total = sum(sums.values())
    return [*(math.log1p(x) for x in sums.values()), strongest, math.log1p(clauses), math.log1p(100 * total / (words + 20)), math.log1p(words)]


def choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Lexicon entries from (prefix or word$, toxic, clean) counts and the
    totals of both kinds; listed words join unless counts speak against them. Of a chain of prefixes the longest that still has
    nearly all its toxic texts stands for the chain."""
    bound, hits = {}, {}
    for p, t, c in counts:
        a, b = t + 0.5, c + 0.5
        low = math.log(a / (toxic + 1)) - math.log(b / (clean + 1)) - Z * math.sqrt(1 / a + 1 / b)
        hits[p] = t, c
        if t >= SUPPORT and low >= BOUND:
            bound[p] = low
    longer = defaultdict(list)
    for p in bound:
        longer[p[:-1][:LONGEST]].append(p)      # of a whole word "w$" the shorter entry is w, or its first letters
    out = {p: low for p, low in bound.items() if not any(hits[q][0] >= SAME * hits[p][0] for q in longer[p])}
    for w in INSULTS:
        t, c = hits.get(w + "$", (0, 0))
        if c <= t:
            out.setdefault(w + "$", KNOWN)
    return out


# -- fitting ------------------------------------------------------------------

@dataclass
class Model:
    entries: dict[str, float]
    coefficients: list[float]       # of FEATURES, then the constant
    mean: list[float]
    scale: list[float]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        x = (np.array(rows) - self.mean) / self.scale
        z = x @ np.array(self.coefficients[:-1]) + self.coefficients[-1]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


# What holds without labels: an asserted match speaks for toxicity, a negated or reported one less.
PRIOR = [2.0 if s == ASSERTED else 0.4 for _, s in PATTERNS] + [0.2, 0.2, 0.2, 0.0, -4.0]
RIDGE = 1.0


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float], list[float]]:
    """Ridge towards PRIOR, by Newton steps, on features scaled to unit variance."""
    mean = np.zeros(x.shape[1])
    scale = np.maximum(x.std(0), 0.1) if len(x) else np.ones(x.shape[1])
    prior = np.array(PRIOR) * np.append(scale, 1.0)
    z = np.hstack((x / scale, np.ones((len(x), 1))))
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        slope = z.T @ (p - y) + RIDGE * (w - prior)
        curve = (z * (p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist(), mean.tolist(), scale.tolist()


def fold() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(1))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches, 2000):
        found: Counter = Counter()
        for text, toxic, part in zip(*(b.column(i).to_pylist() for i in range(3))):
            found.update((w, part, toxic) for w in words_of(text))
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())], names=["word", "fold", "toxic", "n"])


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """The model learnt from the labelled documents given."""
    spark = documents.sparkSession
    prepare(spark)
    marks = columns(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    marks = marks.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    docs = columns(documents, "doc_id", "text").where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    # ids and hashes meet the labels; texts are only read again, by at most `sample` rows
    chosen = docs.select("doc_id", "h").join(marks, "doc_id").groupBy("h").agg(F.min(F.struct("doc_id", "toxic")).alias("one"))
    chosen, cpath = save(chosen.select("h", "one.doc_id", "one.toxic").orderBy("h").limit(sample), "op12-sample")
    known = docs.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["h"])
    known, kpath = save(known.select("text", F.col("toxic").cast("int").alias("toxic"), fold().cast("int").alias("fold")), "op12-texts")
    words, wpath = save(known.mapInArrow(_count_words, "word string, fold int, toxic int, n bigint")
                        .groupBy("word", "fold", "toxic").agg(F.sum("n").alias("n")), "op12-words")
    folds = range(FOLDS)
    spread = [F.sum(F.when((F.col("fold") == k) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"{'ct'[y]}{k}") for k in folds for y in (0, 1)]
    total = words.agg(*spread).first().asDict()
    total = {k: v or 0 for k, v in total.items()}
    cut = F.when(F.length("word") >= PREFIX, F.transform(
        F.sequence(F.lit(PREFIX), F.least(F.length("word"), F.lit(LONGEST))), lambda n: F.substring("word", F.lit(1), n))).otherwise(F.array().cast("array<string>"))
    starts = words.select(F.explode(F.concat(cut, F.array(F.concat("word", F.lit("$"))))).alias("p"), "fold", "toxic", "n")
    counts = starts.groupBy("p").agg(*spread)

    def low(skip: int | None) -> F.Column:
        t = sum((F.col(f"t{k}") for k in folds if k != skip), F.lit(0.5))
        c = sum((F.col(f"c{k}") for k in folds if k != skip), F.lit(0.5))
        toxic, clean = (sum(total[f"{x}{k}"] for k in folds if k != skip) + 1.0 for x in "tc")
        return F.log(t / toxic) - F.log(c / clean) - Z * F.sqrt(1 / t + 1 / c)
    bounds = F.greatest(low(None), *[low(k) for k in folds])
    toxic_n = sum((F.col(f"t{k}") for k in folds), F.lit(0))
    listed = F.col("p").isin([w + "$" for w in INSULTS])
    counts = counts.withColumn("low", bounds).where(((F.col("low") >= BOUND) & (toxic_n >= SUPPORT)) | listed)
    kept = [r.asDict() for r in counts.orderBy(F.desc("low"), "p").limit(entries).collect()]
    drop(spark, wpath)

    def lexicon(skip: int | None) -> dict[str, float]:
        rows = [(r["p"], sum(r[f"t{k}"] for k in folds if k != skip), sum(r[f"c{k}"] for k in folds if k != skip)) for r in kept]
        return choose(rows, *(sum(total[f"{x}{k}"] for k in folds if k != skip) for x in "tc"))
    without = {k: lexicon(k) for k in folds}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexica = {k: Lexicon(e) for k, e in without.items()}
        for b in small(batches):
            text, toxic, part = (b.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([measure(x, lexica[k]) for x, k in zip(text, part)], pa.list_(pa.float64()))],
                                             names=["toxic", "x"])
    rows = known.mapInArrow(sums, "toxic int, x array<double>").collect()
    drop(spark, cpath, kpath)
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return Model(lexicon(None), *_logistic(x, np.array([r["toxic"] for r in rows], dtype=float)))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every text; only texts are read."""
    prepare(documents.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.entries)
        for b in small(batches):
            scores = model.score([measure(x or "", lexicon) for x in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(scores >= 0.5, pa.bool_()).cast(pa.int32())],
                                             names=["doc_id", "score", "predicted"])
    docs = columns(documents, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return docs.mapInArrow(task, "doc_id bigint, score double, predicted int")
