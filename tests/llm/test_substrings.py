import hashlib
import random
import re
from collections import Counter

import pytest

from tidemark.llm import substrings
from tidemark.llm.op4_query import op4_substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        yield w, gone


def texts():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "a b", "x,"]
    fresh = lambda n: rng.choices(vocabulary, k=n)
    shared = [fresh(n) for n in (34, 35, 36, 60, 90)]
    out = []
    for i in range(60):
        words = fresh(rng.randrange(5, 120))
        for s in rng.sample(shared, rng.randrange(3)):
            a = rng.randrange(len(words))
            words[a:a] = s
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    out += [out[0], out[1], out[1] + " tail", None, "", "  \n", "same " * 200, "ab ba " * 100, " ".join(shared[4][:35])]
    near = fresh(200)
    for _ in range(40):
        words = list(near)
        words[rng.randrange(200)] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("limit", [1024, 3])
def test_kept_words_equal_brute_force(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(substrings, "SHARD_SEGMENTS", limit)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    rows = list(enumerate(texts())) + [(3, texts()[3]), (None, texts()[5]), (None, "short")]
    frame(spark, rows).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for (i, _), (words, gone) in zip(rows, brute([t for _, t in rows])):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        want.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    got = [tuple(r) for r in op4_substrings(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_documents_keep_their_other_characters_and_columns(spark):
    rows = list(enumerate(texts()))
    docs = frame(spark, rows).withColumnRenamed("n_chars", "marks")
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    found = {r.doc_id: r.text for r in out.collect()}
    for (i, t), (words, gone) in zip(rows, brute([t for _, t in rows])):
        assert WORD.findall(found[i] or "") == [w for w, g in zip(words, gone) if not g]
        if not any(gone):
            assert found[i] == t


def test_empty_table(spark):
    assert substrings.kept_words(frame(spark, [])).count() == 0
    assert substrings.without_repeats(frame(spark, [])).count() == 0


def test_automaton_counts():
    rng = random.Random(1)
    sequences = ["".join(rng.choices("ab", k=rng.randrange(1, 30))) for _ in range(20)]
    automaton = substrings.SuffixAutomaton()
    for s in sequences:
        automaton.add(s, 1)
    automaton.close()
    for s in sequences:
        want = [i >= 3 and sum(t[j : j + 4] == s[i - 3 : i + 1] for t in sequences for j in range(len(t) - 3)) > 1 for i in range(len(s))]
        assert list(automaton.frequent(s, 4)) == want


def test_a_row_that_occurs_very_often(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(20_000).selectExpr("7L AS doc_id", f"'{text}' AS text")
    docs = docs.union(spark.createDataFrame([(8, "x y " + text + " z"), (9, text[:100])], "doc_id long, text string"))
    got = substrings.kept_words(docs)
    counts = {(r.doc_id, r.n_words, r.n_removed, r.kept): r["count"] for r in got.groupBy(got.columns).count().collect()}
    assert counts == {(7, 60, 60, ""): 20_000, (8, 63, 60, "x y z"): 1, (9, len(text[:100].split()), 0, text[:100]): 1}
