import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lm
from tidemark.llm.op2_query import op2_lm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def base(rows):
    counts = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for i, x in rows:
        ts = tokens(x)
        yield i, held(i), len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    got, want = sorted((tuple(r)[:6] for r in got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_base_scores_equal_brute_force(spark, head):
    rng = random.Random(1)
    rows = [(i, " ".join(f"W{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(60)))) for i in range(200)]
    rows += [(200, None), (201, ""), (202, "\t"), (None, "Null id"), (5, rows[5][1]), (203, "É é " * 3000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA).withColumnRenamed("lang", "score")
    params = lm.LogBilinear(words=20, classes=4, head=head, batch=256)
    same(lm.scores(docs.repartition(3), params).collect(), base(rows))


def test_whole_table_beats_frequencies_on_held_out_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op2_lm(spark, SF).collect()
    same(got, base(rows))
    out = [r for r in got if r.held_out]
    model, frequencies = sum(r.score for r in out), sum(r.base_score for r in out)
    print("log10 per token", model / sum(r.n_tokens for r in out), frequencies / sum(r.n_tokens for r in out))
    assert model > frequencies


def test_probabilities_sum_to_one(spark):
    rng = random.Random(2)
    rows = [(" ".join(rng.choices(["a", "b", "c", "dd", "de", "f"], [9, 7, 5, 2, 1, 1], k=30)),) for _ in range(40)]
    texts = spark.createDataFrame(rows, "text string")
    params = lm.LogBilinear(words=3, classes=2, batch=64)
    counts = lm.word_counts(texts)
    vocab = lm.vocabulary(counts, params)
    scorer = lm.Scorer(lm.train(texts, vocab, params), vocab)
    words = [lm.END, *sorted(bytes(r.word) for r in counts.collect() if r.word)]
    number = {bytes(r.word): r.n for r in counts.collect()}
    _, symbol = vocab.encode(words)
    for c1 in range(vocab.symbols):
        for c2 in range(vocab.symbols):
            total = 0.0
            for w, s in zip(words, symbol.tolist()):
                p = 10 ** scorer.log10(np.array([s]), np.array([c1]), np.array([c2]))[0]
                if s >= vocab.own:
                    c = s - vocab.own
                    p *= (number[w] + 1) / (vocab.class_tokens[c] + vocab.class_words[c] + 1)
                total += p
            for c in range(params.classes):  # the word that never occurred
                p = 10 ** scorer.log10(np.array([vocab.own + c]), np.array([c1]), np.array([c2]))[0]
                total += p / (vocab.class_tokens[c] + vocab.class_words[c] + 1)
            assert math.isclose(total, 1, rel_tol=1e-4)


def test_empty_and_untrained_tables(spark):
    assert lm.scores(spark.createDataFrame([], SCHEMA)).count() == 0
    only_held = next(i for i in range(100) if held(i))
    got = lm.scores(spark.createDataFrame([(only_held, "a b", "en", "s", 1)], SCHEMA)).collect()
    assert got[0].n_known == 0 and got[0].train_tokens == 0 and got[0].base_score == 0
