import itertools
import random
import zlib

import pytest

from cinerank.llm import toxicity as tx
from cinerank.llm.langid import held_out
from tests.conftest import SF_MID

DOCS = "doc_id bigint, text string, toxic int, score double"
LABELS = "doc_id bigint, toxic int, text string"


def matched(text, entries=None):
    lexicon = tx.Lexicon(entries or {"idiot$": 2.0, "fool": 1.0})
    return {n: v for n, v in zip(tx.FEATURES, tx.measure(text, lexicon)) if v and n not in ("length", "density", "clauses", "strongest")}


@pytest.mark.parametrize("text,pattern", [
    ("an idiot stood there", "bare-asserted"), ("you are an idiot", "aimed-asserted"), ("idiot that you are", "aimed-asserted"),
    ("you are not an idiot", "aimed-negated"), ("never call anyone an idiot", "bare-negated"), ("he said an idiot came", "bare-reported"),
    ('the word "idiot" is rude', "bare-reported"), ("he called you not an idiot", "aimed-reported"), ("i will kill him", "menace-asserted"),
    ("i will not kill him", None), ("he said i will destroy it", "menace-reported"), ("not so. you idiot", "aimed-asserted"),
    ("Foolish.", "bare-asserted"), ("they kill time", None), ("you. an idiot", "bare-asserted"), ("", None), ("!!..", None)])
def test_clauses_are_matched(text, pattern):
    got = matched(text)
    if text == "i will not kill him":
        assert set(got) == {"menace-negated"}
    else:
        assert set(got) == ({pattern} if pattern else set())


def test_composition_equals_one_after_the_other():
    a, b, rnd = tx.scopes(), tx.patterns(), random.Random(1)
    kinds = [tx.INSULT, tx.THREAT, tx.INTENT, tx.TARGET, tx.NEGATION, tx.REPORT, tx.QUOTE]

    def paths(machine, word):
        found = [((), 0.0, machine.start)]
        for s in word:
            found = [((*out, y), w + v, to) for out, w, state in found for y, v, to in machine.step(state, s)]
        return [(out, w + machine.ends[state]) for out, w, state in found if state in machine.ends]
    for _ in range(300):
        word = [rnd.choice(kinds) for _ in range(rnd.randrange(7))]
        two = [(out, v + w) for mid, v in paths(a, word) for out, w in paths(b, mid)]
        assert sorted(map(repr, paths(tx.GRAMMAR, word))) == sorted(map(repr, two))
        weights = [(k, 2.0 if k in (tx.INSULT, tx.THREAT) else 0.0) for k in word]
        best = max(w + sum(2.0 for y in out if isinstance(y, tuple)) for out, w in two)
        assert tx.parse(weights)[0] == pytest.approx(best)


def test_lexicon_takes_the_longest_entry():
    lexicon = tx.Lexicon({"abcd": 1.0, "abcdef": 2.0, "abcdefg$": 3.0})
    assert [lexicon[w] and lexicon[w][1] for w in ("abc", "abcd", "abcde", "abcdefz", "abcdefg", "abcdefgh")] == [None, 1.0, 1.0, 2.0, 3.0, 2.0]
    assert lexicon["you"] == (tx.TARGET, 0.0)


def test_chain_of_prefixes_is_one_entry():
    word = "grobian"
    counts = [(word[:n], 20, 0) for n in range(4, 8)] + [(word + "$", 20, 0)]
    counts += [("stem"[:n], 30, 1) for n in (4,)] + [(f"stem{c}", 3, 0) for c in "abcdefghij"] + [("idiot$", 0, 9), ("rare$", 2, 0)]
    got = tx.choose(counts, 1000, 9000)
    assert "grobian$" in got and "grob" not in got and "stem" in got and "idiot$" not in got and "rare$" not in got and "moron$" in got


def test_long_texts_are_read_whole(monkeypatch):
    text = ("some words here, and more. " * 3000) + "you idiot " + ("tail " * 30000)
    want = tx.measure(text, tx.Lexicon({"idiot$": 2.0}))
    assert want[tx.FEATURES.index("aimed-asserted")] > 0
    monkeypatch.setattr(tx, "SPAN", 100)
    assert tx.measure(text, tx.Lexicon({"idiot$": 2.0})) == want
    assert tx.words_of(text) == {"some", "words", "here", "and", "more", ".", "you", "idiot", "tail"}


def test_nulls_empty_tables_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 0, 1.0), (1, None, 0, 1.0), (None, "you idiot!", 0, 1.0), (3, "", 1, 1.0), (4, "You worthless idiot! Scum!", 0, 0.0)], DOCS)
    labels = spark.createDataFrame([(None, 1, "x"), (3, None, "x"), (9, 1, "x")], LABELS)
    model = tx.fit(docs, labels)
    out = {(r["doc_id"], r["predicted"]) for r in tx.predict(docs, model).collect()}
    assert out == {(1, 0), (None, 1), (3, 0), (4, 1)} and tx.predict(docs, model).count() == 5
    assert tx.predict(docs.limit(0), tx.fit(docs.limit(0), labels.limit(0))).collect() == []


def test_learns_new_words_and_leaves_negated_ones(spark):
    rnd = random.Random(5)
    filler = [a + b + c for a, b, c in itertools.product("bdg", "aeo", ["lin", "mur", "tas"])]
    docs, labels = [], []
    for i in range(600):
        words = [rnd.choice(filler) for _ in range(rnd.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["zorfal", "zorfen", "krimp"]))
        docs.append((i, " ".join(words) + ".", 0, 0.0))
        labels.append((i, int(toxic), "x"))
    model = tx.fit(spark.createDataFrame(docs[:450], DOCS), spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r["predicted"] for r in tx.predict(spark.createDataFrame(docs[450:], DOCS), model).collect()}
    assert got == {i: t for i, t, _ in labels[450:]}
    assert "krimp$" in model.entries


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = tx.fit(docs.where(~held_out()), labels)
    mark = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in tx.predict(docs, model).collect() if r["doc_id"] in mark and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(rows) > 50 and sum(r["predicted"] == mark[r["doc_id"]] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
