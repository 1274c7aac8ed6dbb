import hashlib

from cinerank.llm.pii import find_pii, sanitise
from tests.conftest import SF_MID
from tests.llm.brute import KINDS, pii_spans, pii_terms


def check(df, **thresholds):
    got = find_pii(df, **thresholds).collect()
    texts = {(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()}
    want = sorted((str(i), ",".join(pii_spans(t))) for i, t in texts)
    assert sorted({(str(r["doc_id"]), ",".join(s for s in r["spans"].split(",") if not s.startswith("term"))) for r in got}) == want
    for r in got:
        base = [s for s in r["spans"].split(",") if s and not s.startswith("term:")]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s.startswith(k + ":") for s in base) for k in KINDS]
    return got


def test_whole_table_equals_brute_force(spark):
    got = check(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    assert len(got) == 1000 and sum(r["n_email"] for r in got) > 10


def test_awkward_texts(spark):
    texts = ["", None, "a@b.c-d@e.f", "a@b.c_d@e.f x@y.zz.", "é🎈 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "x1.2.3.4444 9.9.9.9",
             "4111 1111 1111 1111-2 4111-1111-1111-1111", "+1 (202) 555-0199 +12345 +49.30.1234567--", "a" * 20000 + "@" + "b" * 50,
             "1 " * 9000, "1" * 9000, "+1" + " " * 9000 + "2", "+1234567890 1.1.1.1 a@b.co 4111111111111111" * 30, "\n@a.b\na@b.c\n",
             "1-2 3-4 5-6", "..@..", "a@b", "a@b..c a@b.c.", "0" * 400 + "1.2.3.4"]
    check(spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "x@y.z", 1), (1, None, 1), (2, "other", 2)],
                                "doc_id long, text string, spans int"))
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_disclosing_terms_are_removed_and_clean_texts_stay(spark):
    rows = [(i, f"{'ab' * (i + 1)} the secret badger writes from badger@zoo.org and the rest {'xy' * (i + 1)}") for i in range(6)]
    rows += [(100 + i, f"the rest and the {'pq' * (i + 1)} from nobody") for i in range(600)]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows] + [(900, None, None)], "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: r for r in find_pii(df).collect()}
    t = rows[0][1]
    gone = {t[int(a):int(b)] for k, a, b in (s.split(":") for s in found[0]["spans"].split(",")) if k == "term"}
    assert gone == {"secret", "badger", "writes"}
    out = {r["doc_id"]: r for r in sanitise(df).collect()}
    assert out[0]["text"] == "ab the [TERM] [TERM] [TERM] from [EMAIL] and the rest xy"
    assert out[0]["n_chars"] == len(out[0]["text"])
    assert all(out[i]["text"] == t and out[i]["n_chars"] == len(t) for i, t in rows if i >= 100)
    assert out[900]["text"] is None and len(out) == len(rows) + 1


def test_terms_of_whole_texts_equal_brute_force(spark):
    far = "filler " * 40
    texts = ["Quokka " + far + "mail a@b.co " + far + "quokka end",               # one text only, far from the entity, every occurrence
             "heron by 9.8.7.6 then wombat", "the wombat " + far + "9.8.7.6",       # an entity of two texts
             "heron without an entity", "x" + "badger@zoo.org and Zoo", "𝒜𝒷𝒸𝒹 é🎈 c@d.eécole école", None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, "okapi +1 (202) 555-0199")]
    rows += [(1000 + i, f"mail the end and then by {far} filler") for i in range(600)]
    rows += [(5000, "a@x.io b@x.io " + " ".join("w" + chr(97 + i % 26) * (3 + i // 26) for i in range(2000)))]
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string"), prior=1.0).collect()
    want = pii_terms([t for _, t in rows], prior=1.0)
    assert sorted((str(r["doc_id"]), [(s["start"], s["end"]) for s in r["terms"]]) for r in got) == sorted(
        (str(i), want[k]) for k, (i, _) in enumerate(rows))
    first = next(r for r in got if r["doc_id"] == 0)
    assert [texts[0][s["start"]:s["end"]] for s in first["terms"]] == ["Quokka", "quokka"]


def test_terms_of_the_whole_table_equal_brute_force(spark):
    rows = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    got = find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = pii_terms([r["text"] for r in rows])
    assert sorted((str(r["doc_id"]), [(s["start"], s["end"]) for s in r["terms"]]) for r in got) == sorted(
        (str(r["doc_id"]), want[k]) for k, r in enumerate(rows))


def test_one_document_is_no_proof_two_are(spark):
    rows = [(1, "zebu alone writes a@b.co"), (2, "okapi7 x9 pays from c@d.eu"), (3, "okapi7 x9 calls c@d.eu too"), (4, "too few pays")]
    rows += [(10 + i, "alone few writes from calls pays too") for i in range(600)]
    got = {r["doc_id"]: {rows[r["doc_id"] - 1][1][s["start"]:s["end"]] for s in r["terms"]}
           for r in find_pii(check_rows(spark, rows)).where("doc_id < 10").collect()}
    assert got == {1: set(), 2: {"okapi7", "x9"}, 3: {"okapi7", "x9"}, 4: set()}


def test_terms_that_give_a_kind_away(spark):
    """Every e-mail differs; the word that only they stand with tells of one."""
    rows = [(i, f"mailbox{'' if i else ' '} of{i} u{i}@zoo.org here") for i in range(8)]
    rows += [(100 + i, f"of and here {i}") for i in range(1200)]
    got = {r["doc_id"]: [rows[r["doc_id"]][1][s["start"]:s["end"]] for s in r["terms"]]
           for r in find_pii(check_rows(spark, rows)).where("doc_id < 100").collect()}
    assert got == {i: ["mailbox"] for i in range(8)}


def test_very_long_texts(spark):
    """Thousands of telling words, and thousands of entities, in one text."""
    words = [f"q{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(12000)]
    ips = [f"1.{i // 250}.2.{i % 250}" for i in range(6000)]
    rows = [(1, "a@b.co " + " ".join(words)), (2, " ".join(ips)), (3, " word ".join(ips[:1000]) + " +1 (202) 555-0199 " * 300)]
    rows += [(10 + i, "plain words here") for i in range(300)]
    df = check_rows(spark, rows, prior=1.0)
    out = {r["doc_id"]: r["text"] for r in sanitise(df, prior=1.0).collect()}
    assert out[1] == "[EMAIL]" + " [TERM]" * 12000 and out[2] == " ".join(["[IP]"] * 6000)
    assert out[10] == "plain words here"


def test_columns_that_clash_with_own_names(spark):
    df = spark.createDataFrame([(1, "mail a@b.co now", 5, "b", "s", "t")], "doc_id long, text string, base int, __h string, row string, shown string")
    assert find_pii(df).first()["n_email"] == 1
    got = sanitise(df.withColumnRenamed("__h", "terms")).first()
    assert got["text"].startswith("mail [EMAIL]") or got["text"].startswith("[TERM] [EMAIL]")
    assert (got["base"], got["terms"], got["row"], got["shown"]) == (5, "b", "s", "t")


def check_rows(spark, rows, **thresholds):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = check(df, **thresholds)
    want = pii_terms([t for _, t in rows], **thresholds)
    assert sorted((r["doc_id"], [(s["start"], s["end"]) for s in r["terms"]]) for r in got) == sorted(
        (i, want[k]) for k, (i, _) in enumerate(rows))
    return df
