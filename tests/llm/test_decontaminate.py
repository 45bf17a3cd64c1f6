import random

import numpy as np

from tidemark.llm import decontaminate as dc
from tidemark.llm.op3_query import op3_decontaminate

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"
SF = "/root/testdata/sf0.01"


def plain(text):
    return " ".join("".join(c.lower() if c.isalnum() else " " for c in text or "").split())


def distance(pattern, text):
    """Edits between ``pattern`` and the nearest part of ``text``."""
    row = [0] * (len(text) + 1)
    for j, c in enumerate(pattern, 1):
        before, row[0] = row[0], j
        for i, t in enumerate(text, 1):
            before, row[i] = row[i], min(before + (c != t), row[i] + 1, row[i - 1] + 1)
    return min(row)


def brute(docs, items, p):
    out = set()
    for item, text in items:
        whole = plain(text)
        if len(whole) < p.least:
            continue
        last = max(0, len(whole) - p.length)
        for a in sorted({*range(0, last + 1, p.stride), last}):
            pattern = whole[a : a + p.length]
            out |= {(d, item) for d, t in docs if distance(pattern, plain(t)) <= p.edits(len(pattern))}
    return out


def case():
    rng = random.Random(9)
    words = ["the", "thing", "re", "Ändern", "of", "onbleer", "été", "ing", "x1", "and"] + [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 40)))) for i in range(12)] + [(12, None), (13, ""), (None, "no id " * 12)]
    docs = []
    for i in range(90):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 60)))
        if i % 3:
            passage = list(rng.choice(items[:12])[1])
            if i % 2:
                a = rng.randrange(len(passage))
                passage = passage[a:]
            for _ in range(rng.randrange(9)):
                at = rng.randrange(len(passage) + 1)
                passage[at : at + rng.randrange(2)] = rng.choice(["", "q", "z!"])
            at = rng.randrange(len(text) + 1)
            text = text[:at] + "".join(passage) + text[at:]
        docs.append((i, text.upper() if i % 7 == 0 else text))
    return docs + [(90, None), (91, ""), (92, "?!"), (5, docs[5][1])], items


def test_regions_equal_brute_force(spark):
    docs, items = case()
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA).repartition(3)
    got = dc.leaks(frame, spark.createDataFrame(items, ITEMS)).collect()
    want = brute(docs, items, dc.Leaks())
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 20
    texts = dict(docs)
    for r in got:
        assert 0 <= r.start < r.end <= len(texts[r.doc_id])
        assert r.edits <= 4


def test_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = case()
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA)
    want = sorted(map(repr, dc.leaks(frame, spark.createDataFrame(items, ITEMS)).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 400)
    assert sorted(map(repr, dc.leaks(frame, spark.createDataFrame(items, ITEMS)).collect())) == want


def test_clean_documents_stay_with_their_columns(spark):
    docs, items = case()
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA).withColumnRenamed("lang", "doc")
    clean = dc.without_leaks(frame, spark.createDataFrame(items, ITEMS))
    assert clean.columns == frame.columns
    bad = {d for d, _ in brute(docs, items, dc.Leaks())}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _ in docs if d not in bad)


def test_whole_table_holds_every_exact_passage(spark):
    docs = [(r.doc_id, plain(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in op3_decontaminate(spark, SF).collect()}
    assert exact <= got and exact


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a text", "en", "s", 1)], SCHEMA)
    assert dc.leaks(docs, items).count() == dc.leaks(some, items).count() == 0
    assert dc.without_leaks(some, items).count() == 1


def test_gram_hashes_depend_on_the_gram_alone():
    codes = np.array([ord(c) for c in "abcabcabdabcabcabd" * 3], np.uint32)
    for q in (1, 5, 8, 12):
        hashes = dc.gram_hashes(codes, q)
        grams = [codes[i : i + q].tobytes() for i in range(len(codes) - q + 1)]
        assert len(set(zip(grams, hashes.tolist()))) == len(set(grams)) == len(set(hashes.tolist()))


def test_a_passage_is_found_wherever_it_begins(spark):
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(n))
    item = text(60)
    whole = plain(item)
    docs = [(a, f"{text(9)}. {whole[a : a + 98]} .{text(9)}") for a in range(0, 140, 7)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA)
    got = {r.doc_id: r for r in dc.leaks(frame, spark.createDataFrame([(1, item)], ITEMS)).collect()}
    assert set(got) == {a for a, _ in docs}
    for a, t in docs:
        assert whole[a : a + 98].strip() in plain(t[got[a].start : got[a].end])


def test_a_short_text_is_found_between_word_bounds(spark):
    docs = [(1, "so Who wrote: Hamlet? he"), (2, "who wrote hamlets"), (3, "xwho wrote hamlet"), (4, "who wrote hamlet"), (5, None)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA)
    items = spark.createDataFrame([(7, "Who wrote Hamlet?"), (8, "?")], ITEMS)
    got = {(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in dc.leaks(frame, items).collect()}
    assert got == {(1, 7, 3, 20, 0), (4, 7, 0, 16, 0)}
    assert {r.doc_id for r in dc.without_leaks(frame, items).collect()} == {2, 3, 5}


def test_stretches_of_a_repetitive_text_give_the_same(monkeypatch):
    rng = random.Random(12)
    item = ("so we go on and on and " * 40)[:720]
    patterns = dc.Patterns([(1, item), (2, " ".join(f"other{i}" for i in range(60)))], dc.Leaks())
    for _ in range(4):
        words = ("so we go on and on and " * 60).split()
        for at in rng.sample(range(len(words)), 12):
            words[at] = rng.choice(["x", "", "and on", " ".join(f"other{i}" for i in range(rng.randrange(30)))])
        text = " ".join(words)
        monkeypatch.setattr(dc, "PAIRS_AT_ONCE", 10**9)
        monkeypatch.setattr(dc, "SPANS", 10**9)
        whole = patterns.find(text)
        monkeypatch.setattr(dc, "PAIRS_AT_ONCE", 500)
        monkeypatch.setattr(dc, "SPANS", 3)
        assert patterns.find(text) == whole and whole


def test_a_long_repetitive_text_takes_little_memory():
    import tracemalloc

    item = ("so we go on and on and " * 40)[:720]
    patterns = dc.Patterns([(1, item)], dc.Leaks())
    text = "so we go on and on and " * 2000
    tracemalloc.start()
    assert patterns.find(text) == [(1, 0, len(text) - 1, 4)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
