import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from cinerank.llm.bpe import Automaton, Coder, decode, digests, encode
from tests.conftest import SF_MID

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    t, got = library(), {r["doc_id"]: r for r in digests(docs, PATH).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert (g["n_tokens"], g["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert g["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False))


def test_random_texts_equal_the_library():
    t, c, rng = library(), Coder(open(PATH).read()), random.Random(4)
    letters = "aaabcdeeehinorst  \n\n\t'sStTrREve.,!?#$<|endoftext|>éßñ漢字\U0001f600́\x1c\x85 ​1234٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(2500)]
    texts += ["a" * 700, "the " * 50, "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", " a", "a ", "a\n", "\na", "a\nb c", "a  b", "a\n\nb", "a \nb"]
    for text in texts:
        decimal, ids = c.encode(text)
        want = t.encode(text, add_special_tokens=False).ids
        assert [x for p in ids for x in p] == want, text
        assert ",".join(decimal) == ",".join(map(str, want))
        assert c.decode(ids) == t.decode(want, skip_special_tokens=False)


def test_arcs_are_the_pairs_that_stay_apart():
    spec, t, rng = open(PATH).read(), library(), random.Random(7)
    a = Automaton(spec)
    ids = [i for i, b in enumerate(a.label) if b.isalpha() and b.isascii()]
    for _ in range(3000):
        x, y = rng.choice(ids), rng.choice(ids)
        word = (a.label[x] + a.label[y]).decode()
        assert a.arc(x, y) == (t.encode(word, add_special_tokens=False).ids == [x, y])


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "Hi there", 3), (3, " x" * 30000, 3), (3, "again", 3)],
                               "doc_id long, text string, ids int")
    got = encode(df, PATH)
    assert sorted(len(r["ids"]) for r in got.collect()) == [0, 0, 1, 2, 30000]
    assert sorted(r["text"] for r in decode(got, PATH).collect()) == sorted(t or "" for _, t, _ in df.collect())
    assert digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
