import zlib

import numpy as np

from cinerank.llm import langid
from cinerank.llm.langid import fit, held_out, identify, predict
from tests.conftest import SF_MID


def test_held_out_accuracy_and_rejections(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = identify(docs).withColumn("held", held_out()).collect()
    assert len(got) == docs.count()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    mine = [r for r in got if r["held"] and r["lang"] and any(c.isalpha() for c in r["text"] or "")]
    assert sum(r["lang_pred"] == r["lang"] for r in mine) >= 0.97 * len(mine)
    assert sum(r["rejected"] for r in mine) <= 0.01 * len(mine)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_labels_of_predicted_rows_are_no_input(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(200).cache()
    model = fit(docs, sample=50)
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(docs, model).collect()}
    b = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(docs.selectExpr("doc_id", "text", "'xx' lang"), model).collect()}
    assert a == b


def test_awkward_rows(spark):
    rows = [(i, f"the cat and the dog number {i}", "en", 7) for i in range(40)]
    rows += [(100 + i, f"der hund und die katze nummer {i}", "de", 7) for i in range(40)]
    rows += [(200, None, "en", 7), (201, "", None, 7), (202, "12 34 !!", "en", 7), (None, "the cat and the dog", None, 7),
             (203, "und die katze " * 20000, None, 7), (204, "漢字かな", None, 7), (205, "x", None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r for r in identify(df).collect()}
    assert [got[i]["lang_pred"] for i in (200, 201, 202, None, 203)] == ["und", "und", "und", "en", "de"]
    assert got[204]["rejected"] and got[204]["lang_pred"] in ("en", "de")
    assert got[202]["rejected"] and not got[0]["rejected"] and not got[203]["rejected"]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert identify(empty).collect() == []
    assert {r["lang_pred"] for r in identify(df.withColumn("lang", df["lang"].substr(9, 1)).selectExpr(
        "doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_copies_enter_the_sample_once(spark):
    rows = [(f"the cat and dog {'abcdefgh'[i % 8] * (i + 3)}", "en") for i in range(30)] + [(f"der hund {'klmnopqr'[i % 8] * (i + 3)}", "de") for i in range(30)]
    one = fit(spark.createDataFrame(rows, "text string, lang string"), sample=30)
    many = fit(spark.createDataFrame(rows + rows[::3] * 40, "text string, lang string").repartition(5), sample=30)
    assert np.allclose(one.centres, many.centres) and np.allclose(one.floor, many.floor) and np.allclose(one.idf, many.idf)


def test_languages_are_chosen_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    rows = [("rare words", "aa")] * 50 + [(f"the cat {'ab'[i % 2] * (i + 3)}", "en") for i in range(9)] + [(f"der hund {'kl'[i % 2] * (i + 3)}", "zz") for i in range(9)]
    assert fit(spark.createDataFrame(rows, "text string, lang string"), sample=5).names == ["en", "zz"]
