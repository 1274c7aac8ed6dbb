"""Every stage of the pipeline, and all of them, against plain versions."""

import random
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from cinerank.llm.langid import identify
from tests.conftest import SF_SMALL
from tests.llm.brute import jaccard_components, pii_spans, pii_terms

RANK = {"email": 0, "ip": 1, "card": 2, "phone": 3, "term": 4}


def plain_near_copies(rows):
    """doc_id -> text of the smallest document of each group."""
    groups = jaccard_components(rows, width=5, percent=80)
    return {i: t for i, t in rows.items() if groups[i][1] == i}


def plain_sanitise(rows):
    out = {}
    for (i, t), terms in zip(rows.items(), pii_terms(list(rows.values())), strict=True):
        spans = [(int(a), RANK[k], int(b), k) for k, a, b in (s.split(":") for s in pii_spans(t))]
        spans += [(a, RANK["term"], b, "term") for a, b in terms]
        pos, text = 0, ""
        for a, _, b, k in sorted(spans):
            if a >= pos:
                text += t[pos:a] + f"[{k.upper()}]"
            pos = max(pos, b)
        out[i] = None if t is None else text + t[pos:]
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_number_of_stages():
    assert [n for n, _ in P.STAGES] == ["language", "near_copies", "personal_data", "packed"] and P.ORACLE_SQL is None


def test_run_equals_the_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    spoken = {r["doc_id"] for r in identify(docs).where("not rejected").collect()}
    first = P.language(spark, docs, SF_SMALL)
    assert first.columns == docs.columns
    kept = texts(first)
    assert set(kept) == spoken and kept.items() <= texts(docs).items()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
            for i, t in plain_sanitise(plain_near_copies(kept)).items()}
    got = {}
    for r in P.run(spark, SF_SMALL).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want and 0 < len(got) < len(kept) + 1


def test_stages_on_awkward_rows(spark):
    rng = random.Random(4)
    words = ["the", "and", "river", "stone", "house", "green", "walks", "under", "bright", "morning", "little", "garden"]
    rows = {i: " ".join(rng.choices(words, k=40)) for i in range(1, 30)}
    rows[40] = rows[3]                                   # a copy
    rows[41] = rows[5] + " end"                          # a near copy
    rows |= {50: None, 51: "", 52: "a@b.co calls 1.2.3.4", 53: "+1 (202) 555-0199 " * 400}
    table = [(i, t, "en", "s", 0, "x") for i, t in rows.items()] + [(None, "no id", "en", "s", 0, "x"), (1, rows[1], "en", "s", 0, "x")]
    names = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
    df = spark.createDataFrame(table, names)
    near = P.near_copies(spark, df, SF_SMALL)
    assert near.columns == df.columns
    out = near.collect()
    assert {r["doc_id"]: r["text"] for r in out if r["doc_id"] is not None} == plain_near_copies(rows)
    assert len([r for r in out if r["doc_id"] == 1]) == 1 and [r["text"] for r in out if r["doc_id"] is None] == ["no id"]
    clean = P.personal_data(spark, df, SF_SMALL)
    assert clean.columns == df.columns and clean.count() == len(table)
    got = texts(clean.where("doc_id is not null and doc_id > 1"))
    assert got[50] is None and got[51] == "" and got[53] == "[PHONE] " * 400
    assert re.search(r"\[EMAIL\].*\[IP\]", got[52]) and all(got[i] == rows[i] for i in range(2, 30))
    for stage in (P.near_copies, P.personal_data, P.language, P.packed):
        assert stage(spark, df.limit(0), SF_SMALL).count() == 0
    assert {r["doc_id"] for r in P.packed(spark, df, SF_SMALL).collect()} == set(rows) | {None}
