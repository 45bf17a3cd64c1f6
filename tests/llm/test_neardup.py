"""Near-duplicates by shared word shingles, against all pairs."""

import random

import pytest

import corpus_pipeline
from tidemark.llm import neardup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def roots(rows):
    """The first row of each row's group, by comparing all rows."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(rows))]


def texts():
    rng = random.Random(7)
    rows = []
    for g in range(12):
        base = rng.choices([f"w{i}" for i in range(500)], k=rng.randrange(60, 300))
        for _ in range(6):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randrange(1 + len(words) // 30)):
                words[at] = "other"
            rows.append((len(rows), " ".join(words)))
    return rows + [(len(rows) + i, t) for i, t in enumerate([None, "", " \n", "One two", "one  TWO", "a b c d e", "a b c d f"])]


@pytest.mark.parametrize("up_to", [64, 1])
def test_one_of_each_group_of_similar_texts(spark, monkeypatch, up_to):
    monkeypatch.setattr(neardup, "PAIRS_UP_TO", up_to)
    rows = texts()
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    want = {rows[r][0] for r in roots(rows)}
    assert found == want and len(want) < 60


def crowd():
    """Pairs of texts at 0.97 that share a lead with all others (0.76 to them), near copies in a chain away from
    the first of them, and copies of it at many distances: one bucket for all of each."""
    rng = random.Random(3)
    word = lambda: f"u{rng.randrange(10**9)}"
    lead, rows = [f"lead{i}" for i in range(300)], []
    for _ in range(60):
        tail = [word() for _ in range(48)]
        rows += [lead + tail, lead + tail[:-2] + [word(), word()]]
    text = [word() for _ in range(200)]
    rows.append(list(text))
    for i in range(40):  # each step changes a word; ends are far apart
        text[i * 5] = word()
        rows.append(list(text))
    base = [word() for _ in range(200)]
    for i in range(80):
        copy = list(base)
        for at in rng.sample(range(200), i % 12):
            copy[at] = word()
        rows.append(copy)
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize(("up_to", "broadcast"), [(64, 500_000), (8, 500_000), (8, 0)])
def test_no_pair_of_a_crowded_bucket_is_lost(spark, monkeypatch, up_to, broadcast):
    monkeypatch.setattr(neardup, "PAIRS_UP_TO", up_to)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", broadcast)
    rows = crowd()
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(5)
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert found == {rows[r][0] for r in roots(rows)}


def test_copies_too_far_apart_are_not_all_compared(spark, monkeypatch):
    """A crowd at about 0.75 to its base and less to one another: no pair is similar, few may be compared."""
    rng = random.Random(5)
    base, rows = [f"u{rng.randrange(10**9)}" for _ in range(150)], []
    for i in range(300):
        copy = list(base)
        for at in rng.sample(range(30), 5):
            copy[at * 5] = f"u{rng.randrange(10**9)}"
        rows.append((i, " ".join(copy)))
    compared, similar = [], neardup.similar

    def counted(pairs, texts, params):
        compared.append(pairs.count())
        return similar(pairs, texts, params)

    monkeypatch.setattr(neardup, "similar", counted)
    monkeypatch.setattr(neardup, "PAIRS_UP_TO", 8)
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(5)
    found = {r.doc_id for r in neardup.one_of_each_similar(docs, neardup.Shingles(rows=1)).collect()}
    assert found == {rows[r][0] for r in roots(rows)}
    assert sum(compared) < 10_000  # of 44,850


def near_copies(count):
    """Copies of two texts that share a lead, with some words changed, dropped or put in, often for common ones."""
    rng = random.Random(11)
    lead, rows = [f"lead{i}" for i in range(60)], []
    bases = [lead + [f"{b}{i}" for i in range(90 + 5 * b)] for b in range(2)]
    for i in range(count):
        copy = list(bases[i % 6 == 0])
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(copy))
            word = "common" if rng.random() < 0.4 else f"u{rng.randrange(10**9)}"
            copy[at : at + rng.randrange(2)] = [word] if rng.random() < 0.8 else []
        rows.append((i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_a_crowd_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch, broadcast):
    """What the centres leave apart is compared with the texts that differ from the centre alike, and not with all
    the texts of its buckets; no similar pair is lost."""
    compared, similar = [], neardup.similar

    def counted(pairs, texts, params):
        compared.append(pairs.count())
        return similar(pairs, texts, params)

    monkeypatch.setattr(neardup, "similar", counted)
    monkeypatch.setattr(neardup, "PAIRS_UP_TO", 8)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", broadcast)
    rows = near_copies(600)
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(5)
    found = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert found == {rows[r][0] for r in roots(rows)}
    assert len(found) > 20 and compared[-1] < 100  # of 179,700


def test_fingerprints_alone_give_candidates(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(5):
        text = [f"u{rng.randrange(10**9)}" for _ in range(2000)]
        rows += [(len(rows) + i, " ".join([*text[:i], "other", *text[i + 1 :]])) for i in range(3)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    kept = neardup.one_of_each_similar(docs, neardup.Shingles(bands=0)).collect()
    assert {r.doc_id for r in kept} == {0, 3, 6, 9, 12}


def test_near_copies_of_the_table_do_not_all_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id in (1, 255, 643, 770)")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()} == {1, 643}


def test_empty_table(spark):
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame([], SCHEMA), SF).count() == 0
