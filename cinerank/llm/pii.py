"""Operator 8: personal data, and terms that give protected entities away.

Everything is DataFrame expressions; no Python runs on the executors.

Base kinds are matched by fixed patterns. Then information-theoretic
sanitisation: for each protected entity E (a kind and value, or a kind alone)
and each term t of the whole texts that hold E, counts over all documents give

    P(E|t) = (c(E,t) + PRIOR P(E)) / (c(t) + PRIOR),
    bits(E;t) = log2(P(E|t) / P(E))

with c(t) the documents holding t outside of their entities, c(E,t) those of
them that hold E, and P(E) the share of documents holding E. A term that
reaches both disclosure thresholds gives E away; in the documents that hold E
all its occurrences are removed like the entity itself. A term is any run of
letters and digits, so account numbers and user names count as well. PRIOR
documents speak against every term: one document is no proof, two that hold
both E and t are, if no other document holds t. Copies count as documents; the
pipeline has removed them before. A document without a protected entity is
never changed.

Pairs are made only where the thresholds can be reached: even with c(E,t) the
smaller of c(E) and c(t), most terms and entities fall short, and entities of
the very same documents are one case. Neither changes a result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.common import columns, drop, save
from cinerank.operators.skew import skew_join

# Kinds in their order of rank, and their patterns. Quantifiers
# are possessive where what follows can't begin inside the run, and a local
# part starts only where a run starts, so long runs take linear time; the
# matches are those of the plain patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this can't hold the kind.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TERM = r"[\p{L}\p{N}]++"
TERM_RANK = len(KINDS)

POSTERIOR = 0.5    # P(E|t) that discloses
BITS = 6.0         # and the information it gives about E
PRIOR = 2.0        # documents that P(E) counts for in P(E|t)

_SPANS = "array<struct<start:int,end:int,value:string>>"


# Matches of a text are placed in parts of so many, so that the arrays that
# grow by one stay short.
_PART = 128


def _matches(text: Column, pattern: str) -> Column:
    """Spans of all matches, from the pieces between them."""
    pattern = F.lit(pattern)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("h"))
    zipped = F.transform(zipped, lambda x: F.struct(F.length(x["p"]).alias("p"), x["h"].alias("h")))

    def add(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["p"]
        end = start + F.coalesce(F.length(x["h"]), F.lit(0))
        hit = F.array(F.struct(start.alias("start"), end.alias("end"), x["h"].alias("value")))
        return F.struct(end.alias("pos"), F.when(x["h"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], hit)).alias("out"))

    def add_part(acc: Column, k: Column) -> Column:
        start = F.struct(acc["pos"].alias("pos"), F.expr(f"cast(array() as {_SPANS})").alias("out"))
        part = F.aggregate(F.slice(acc["all"], k * _PART + 1, _PART), start, add)
        return F.struct(acc["all"].alias("all"), part["pos"].alias("pos"), F.concat(acc["out"], F.array(part["out"])).alias("out"))

    start = F.struct(zipped.alias("all"), F.lit(0).alias("pos"), F.expr(f"cast(array() as array<{_SPANS}>)").alias("out"))
    # split gives one piece at least
    parts = F.sequence(F.lit(0), F.floor((F.size(zipped) - 1) / F.lit(_PART)).cast("int"))
    return F.aggregate(parts, start, add_part, lambda acc: F.flatten(acc["out"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = F.split(value, r"\.")
        return F.forall(part, lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All valid base spans as `(start, rank, end, kind, value)`, by start
    and kind; code points, end exclusive."""
    text = F.coalesce(text, F.lit(""))
    parts = []
    for rank, kind in enumerate(KINDS):
        found = _ranked(_matches(text, PATTERNS[kind]), rank, kind)
        none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string>>)")
        parts.append(F.when(text.rlike(HINTS[kind]), found).otherwise(none))
    return F.array_sort(F.concat(*parts))


def _ranked(found: Column, rank: int, kind: str) -> Column:
    found = F.filter(found, lambda s: _valid(kind, s["value"]))
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _key(kind: Column, value: Column) -> Column:
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), _digits(value)).otherwise(F.lower(value)))


def _replaced(text: Column, spans: Column, put: Callable[[Column, Column], Column]) -> Column:
    """The text with `put(end of the last span, span)` for each span. Spans
    are handled in parts that cut their stretch out of the text once, so that
    a position is never sought from the text's start for each of them."""
    def add(acc: Column, s: Column) -> Column:
        gap = F.substring(acc["stretch"], acc["pos"] - acc["off"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0)))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["off"].alias("off"), acc["stretch"].alias("stretch"),
                        F.concat(acc["out"], F.array(gap, put(acc["pos"], s))).alias("out"))

    def add_part(acc: Column, k: Column) -> Column:
        part = F.slice(spans, k * _PART + 1, _PART)
        last = F.coalesce(F.array_max(F.transform(part, lambda s: s["end"])), F.lit(0))
        start = F.struct(acc["pos"].alias("pos"), acc["pos"].alias("off"),
                         F.substring(text, acc["pos"] + 1, F.greatest(last - acc["pos"], F.lit(0))).alias("stretch"),
                         F.expr("cast(array() as array<string>)").alias("out"))
        done = F.aggregate(part, start, add, lambda x: F.struct(x["pos"].alias("pos"), F.array_join(x["out"], "").alias("out")))
        return F.struct(done["pos"].alias("pos"), F.concat(acc["out"], F.array(done["out"])).alias("out"))

    start = F.expr("named_struct('pos', 0, 'out', cast(array() as array<string>))")
    parts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(spans) - 1) / F.lit(_PART)).cast("int"), F.lit(0)))
    return F.aggregate(parts, start, add_part, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))


def _blanked(text: Column, base: Column) -> Column:
    """The text with blanks for its base spans; positions stay."""
    blank = _replaced(text, base, lambda pos, s: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(pos, s["start"]), F.lit(0))))
    return F.when(F.size(base) > 0, blank).otherwise(text)


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def telling_words(docs: DataFrame, some: DataFrame, *, posterior: float = POSTERIOR, bits: float = BITS,
                  prior: float = PRIOR) -> DataFrame:
    """`(row, term)`: the terms that give away entities of this row of `some`
    (row, base, and the blanked text `shown`).

    A text's terms are made distinct and pre-aggregated before the shuffle.
    """
    n = some.count()
    some = some.where(F.size("base") > 0)
    keys = F.concat(F.transform("base", lambda s: _key(s["kind"], s["value"])), F.transform("base", lambda s: s["kind"]))
    held = some.select("row", F.explode(F.array_distinct(keys)).alias("entity"))
    every, every_path = save(held.groupBy("entity").agg(
        F.count("*").alias("c_e"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")), "op8-entities")

    def in_reach(c_e: Column, c_t: Column) -> Column:
        return posterior * (c_t + prior) <= F.least(c_e, c_t) + c_e * (prior / max(n, 1)) + 1e-9

    # the most that a term can tell: one in the very documents of the entity
    entities = every.where((F.log2(F.lit(float(n)) / F.col("c_e")) >= bits) & in_reach(F.col("c_e"), F.col("c_e")))
    # kinds are hot, but four at most; a value is split where many rows hold it
    kind = F.col("entity").isin(*KINDS)
    counts = every.select("entity", F.col("c_e").alias("_n"))
    own = held.where(kind).join(F.broadcast(entities.where(kind)), "entity").unionByName(
        skew_join(held.where(~kind), entities.where(~kind), "entity", left_counts=counts, right_hot=False))
    own, own_path = save(own.select("row", "c_e", "x", "y").distinct(), "op8-own")

    all_words = docs.select("text", base_spans(F.col("text")).alias("base")).select(_words(_blanked(F.col("text"), F.col("base"))).alias("w"))
    all_terms = all_words.select(F.explode(F.array_distinct(F.transform("w", F.lower))).alias("term"))
    most = own.agg(F.max("c_e")).first()[0] or 0
    seen, seen_path = save(all_terms.groupBy("term").agg(F.count("*").alias("c_t")).where(in_reach(F.lit(most), F.col("c_t"))), "op8-seen")
    words = some.select("row", F.explode(F.array_distinct(F.transform(_words(F.col("shown")), F.lower))).alias("term"))
    words, words_path = save(words.join(seen, "term"), "op8-words")
    pairs, pairs_path = save(words.join(own, "row").where(in_reach(F.col("c_e"), F.col("c_t"))), "op8-pairs")
    p_e = F.col("c_e") / F.lit(float(n))
    p = (F.col("c_et") + prior * p_e) / (F.col("c_t") + prior)
    told = pairs.groupBy("term", "c_e", "x", "y").agg(F.count("*").alias("c_et"), F.first("c_t").alias("c_t")).where(
        (p >= posterior) & (F.log2(p / p_e) >= bits))
    hits = pairs.join(told.select("term", "c_e", "x", "y"), ["term", "c_e", "x", "y"], "left_semi").select("row", "term").distinct()
    hits, _ = save(hits, "op8-terms")
    drop(docs.sparkSession, every_path, own_path, seen_path, words_path, pairs_path)
    return hits


def term_spans(some: DataFrame, hits: DataFrame) -> DataFrame:
    """`(row, terms)`: the spans of all words of `shown` whose term is among
    the row's `hits` (row, term).

    The words become rows with their positions and meet the hits by (row,
    term), so a text's cost grows with its length, not with its length times
    its telling terms. A window holds the words of one text.
    """
    texts = some.join(hits.select("row").distinct(), "row", "left_semi")
    pieces = F.arrays_zip(F.split("shown", TERM, -1).alias("p"), F.regexp_extract_all("shown", F.lit(TERM), F.lit(0)).alias("w"))
    pieces = F.transform(pieces, lambda x: F.struct(F.length(x["p"]).alias("p"), x["w"].alias("w")))
    words = texts.select("row", F.posexplode(pieces).alias("i", "x")).select("row", "i", F.col("x.p").alias("p"), F.col("x.w").alias("w"))
    step = F.col("p") + F.coalesce(F.length("w"), F.lit(0))
    words = words.withColumn("end", F.sum(step).over(Window.partitionBy("row").orderBy("i")).cast("int")).where("w is not null")
    words = words.select("row", F.lower("w").alias("term"), (F.col("end") - F.length("w")).alias("start"), "end")
    span = F.struct("start", F.lit(TERM_RANK).alias("rank"), "end", F.lit("term").alias("kind"), F.lit("").alias("value"))
    return words.join(hits, ["row", "term"], "left_semi").groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("terms"))


def find_pii(docs: DataFrame, **thresholds) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): doc_id, h, n_email,
    n_ip, n_card, n_phone, base_sha256, base, terms, spans.

    `base` and `terms` are arrays of spans, `spans` writes both as
    kind:start:end (kind `term` for the method's own). A null text counts as
    empty. doc_id may be null or repeated: rows are told apart by id and text.
    No rows give no rows; other columns are ignored.
    """
    docs = columns(docs, "doc_id", "text").select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = docs.select("doc_id", F.xxhash64("text").alias("h"), "text", base_spans(F.col("text")).alias("base"))
    shown = F.when(F.size("base") > 0, _blanked(F.col("text"), F.col("base"))).alias("shown")
    some, _ = save(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h", "base", shown), "op8-base")
    hits = telling_words(docs, some, **thresholds)
    out = some.drop("shown").join(term_spans(some, hits), "row", "left")
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string,value:string>>)")
    out = out.withColumn("terms", F.coalesce("terms", none))
    return out.select("doc_id", "h", *map(_count, KINDS), F.sha2(_written(F.col("base")), 256).alias("base_sha256"), "base", "terms",
                      _written(F.array_sort(F.concat("base", "terms"))).alias("spans"))


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """`docs` with every span of `find_pii` in `text` replaced by its kind in
    brackets. All columns and rows stay; a text without spans is unchanged,
    a null text stays null; `n_chars`, where present, is the new length.
    """
    found = find_pii(docs, **thresholds).select(
        F.col("doc_id").alias("__i"), F.col("h").alias("__h"), F.array_sort(F.concat("base", "terms")).alias("__s"))
    found, _ = save(found.where(F.size("__s") > 0).dropDuplicates(["__i", "__h"]), "op8-spans")
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__i")) & (key == F.col("__h")), "left")
    text = F.col("text")

    clean = _replaced(text, F.col("__s"), lambda pos, s: F.when(
        s["start"] >= pos, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit("")))
    clean = F.when(F.col("__s").isNull(), text).otherwise(clean)
    names = [c for c in docs.columns]
    out = out.withColumn("__t", clean)
    picked = [F.col("__t").alias("text") if c == "text" else
              F.when(F.col("__s").isNull(), F.col("n_chars")).otherwise(F.length("__t")).cast("long").alias("n_chars")
              if c == "n_chars" else F.col(f"`{c}`") for c in names]
    return out.select(*picked)
