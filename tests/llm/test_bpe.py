import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe
from tidemark.llm.op10_query import op10_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def reference(name="word_bpe_49k.json"):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def texts():
    rng = random.Random(4)
    words = ["the", "It's", "don't", "ÉTÉ", "ét", "ß", "日本", "x y", "<|endoftext|>", "a<|startoftext|>b", "12", "́", "🙂", "Σ"]
    long = [" ".join(rng.choices(words, k=rng.randrange(1, 400))) for _ in range(20)]
    return long + [long[0], long[1] + "\n" + long[2], None, "", " \n", "x" * 5000, "the " * 20_000, "the　the", "\x85 a\x1cb"]


def test_whole_table_equals_the_library(spark):
    tokenizer = reference()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:] == expected(tokenizer, docs[r.doc_id])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_odd_texts_equal_the_library(spark, name):
    tokenizer = reference(name)
    rows = [*enumerate(texts()), (3, texts()[3]), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).withColumnRenamed("lang", "h")
    got = bpe.digests(docs, bpe.Codec(public_tokenizers.path(name))).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(tokenizer, t)) for i, t in rows), key=key)


def test_joins_inside_words_are_repaired():
    encoder = bpe.Codec(public_tokenizers.path("word_bpe_49k.json")).load()
    rng = random.Random(6)
    text = " ".join(rng.choices(["nation", "attion", "don't", "reading", "thereafter", "été"], k=60)).encode()
    for _ in range(50):
        cuts = sorted({0, len(text), *rng.sample([i for i in range(len(text)) if text[i] < 128 and text[i - 1] < 128], 6)})
        chunks = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        assert bpe.join_chunks(chunks, encoder.chunks(chunks), encoder) == encoder.encode([text])[0]


def test_chunks_make_up_the_text_and_recur():
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60 * bpe.CUT_ONE_IN)]
    passage = " ".join(words)
    a, b = bpe.chunk_list("other start " + passage), bpe.chunk_list(passage + " tail\n")
    assert b"".join(a).decode() == "other start " + passage
    assert len(set(a) & set(b)) >= len(a) - 3 > 30
    assert max(len(c.split()) for c in bpe.chunk_list("same " * 5000)) <= bpe.MOST_WORDS


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], SCHEMA), bpe.Codec(public_tokenizers.path("word_bpe_49k.json"))).count() == 0


def test_a_row_that_occurs_very_often(spark):
    text = " ".join(f"word{i % 37} It's {i}" for i in range(600))
    docs = spark.range(20_000).selectExpr("7L AS doc_id", f"'{text.replace(chr(39), chr(92) + chr(39))}' AS text")
    docs = docs.union(spark.createDataFrame([(8, text), (7, "other")], "doc_id long, text string"))
    got = bpe.digests(docs, bpe.Codec(public_tokenizers.path("word_bpe_49k.json")))
    counts = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256): r["count"] for r in got.groupBy(got.columns).count().collect()}
    tokenizer = reference()
    assert counts == {(7, *expected(tokenizer, text)): 20_000, (8, *expected(tokenizer, text)): 1, (7, *expected(tokenizer, "other")): 1}
