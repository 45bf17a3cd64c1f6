import random
import re

import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.frames import components
from tidemark.llm.op7_query import op7_simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def print_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, prints):
    """Smallest id reachable from each row, by comparing all rows."""
    label, out = list(range(len(rows))), []

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append(min(ids, default=None))
    return out


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=200) for _ in range(12)]
    rows = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 + i * 37 % 150, " ".join(words)))
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "One"), (9, "one"), (10, "a b c"), (None, "A  b\nc"), (11, "É b c d e")]
    rows += [(7, "repeated row"), (7, "repeated row"), (None, "no id"), (None, "no id"), (12, "z " * 50_000)]
    return rows


def test_groups_equal_brute_force(spark, tmp_path):
    rows = texts()
    spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA).repartition(3).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    prints = [print_of(t) for _, t in rows]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, brute(rows, prints))]
    got = [tuple(r) for r in op7_simhash(spark, str(tmp_path)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("up_to", [0, 2, 64])
def test_midpoints_and_pairs_give_the_same_components(spark, monkeypatch, up_to):
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", up_to)
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(5):
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                p ^= 1 << b
            prints.add(p)
    rows = [(simhash.signed(p),) for p in prints]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long"), 4)
    assert all((a & (2**64 - 1) ^ b & (2**64 - 1)).bit_count() <= 4 for a, b in links.collect())
    got = {r.node: r.root for r in components(links).collect()}
    numbered = [(p[0], None) for p in rows]
    want = brute(numbered, [p[0] & (2**64 - 1) for p in rows])
    assert [got.get(p[0], p[0]) for p in rows] == want


def test_one_document_of_each_group_stays(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], SCHEMA).withColumn("h", simhash.F.lit("own"))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {}
    for (i, t), p, c in zip(rows, [print_of(t) for _, t in rows], brute(rows, [print_of(t) for _, t in rows])):
        want.setdefault(c if c is not None else t, []).append(i)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(min(x for x in v if x is not None) if any(x is not None for x in v) else -1 for v in want.values())


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.groups(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0
