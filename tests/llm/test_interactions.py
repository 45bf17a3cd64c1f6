"""The filter audit against a plain version, over several micro-batches with smaller ids that come late."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from tidemark.llm import interactions
from tidemark.llm.interactions import Audit, filter_audit, mask_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, digest string, n int"
LABELS = "doc_id long, quality int, toxic int, good string"


def plain(rows, labels):
    docs = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in rows)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": smaller,
        }
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        docs.append((source or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {d[0] for d in docs}:
        first = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                inside = [d for d in docs if d[0] == part]
                came = [d for d in inside if not any(d[1][g] for g in order[: step - 1])]
                gone = [d for d in came if d[1][f]]
                first[f] += len(gone)
                out[part, order, step] = [
                    len(came) - len(gone),
                    len(gone),
                    sum(d[1][f] for d in inside) - len(gone),
                    sum(d[1][f] and sum(d[1].values()) == 1 for d in inside),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(first[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def texts():
    rng = random.Random(11)
    long = lambda n, spread: " ".join(f"w{rng.randrange(spread)}" for _ in range(n))
    kinds = [long(250, 10_000), long(250, 20), long(30, 1000), "LOUD " * 210, long(210, 9000) + " a|b", "", None, " \n\t", "é" * 300]
    kinds += [long(199, 10**6), long(200, 10**6), "x\x0by\x85z " * 70, "A" + "b" * 49, "A" + "b" * 48]
    return kinds


def documents():
    rng, kinds = random.Random(4), texts()
    ids = rng.sample(range(1000), 160)
    rows = [(i, rng.choice(kinds), rng.choice(["s1", "s2", None, ""])) for i in ids]
    hot = kinds[0]
    rows += [(2000 - i, hot, "s1") for i in range(120)]  # smaller ids come later
    rows += [(5, hot, "s1"), (5, hot, "s1"), (5, hot, "s2"), (5, kinds[2], "s1"), (None, hot, "s3"), (None, None, None)]
    return rows


def write(spark, rows, path, files):
    size = -(-len(rows) // files)
    for at in range(0, len(rows), size):
        full = [(i, t, "en", s, 1, "x", 1, "d", 2) for i, t, s in rows[at : at + size]]
        spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, labels, **params):
    table = spark.createDataFrame([(*x, "g") for x in labels], LABELS)
    found = filter_audit(spark, path, table, Audit(**params))
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley"
    assert found.columns == names.split()
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("files", "batches", "page_texts", "combined"), [(1, 1, 2000, 50_000), (5, 5, 3, 4)])
def test_equals_the_plain_version(spark, tmp_path, monkeypatch, files, batches, page_texts, combined):
    monkeypatch.setattr(interactions, "COMBINED", combined)
    labels = [(i, i % 2, i % 3) for i in range(0, 2000, 3)] + [(5, 1, 0), (5, 0, 1), (5, None, None), (None, 1, 1)]
    rows = documents()
    write(spark, rows, str(tmp_path / "docs"), files)
    assert run(spark, str(tmp_path / "docs"), labels, batches=batches, page_texts=page_texts) == plain(rows, labels)


def test_a_smaller_id_retracts_what_was_counted(spark, tmp_path):
    path = str(tmp_path / "docs")
    seen = []
    for i, source in [(9, "a"), (7, "b"), (8, "a"), (3, "a"), (3, "b")]:
        seen.append((i, "same text", source))
        write(spark, seen[-1:], path, 1)
        assert run(spark, path, [(7, 1, 0), (3, 0, 1)], batches=99) == plain(seen, [(7, 1, 0), (3, 0, 1)])


def test_no_documents_and_no_labels(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "docs"))
    assert run(spark, str(tmp_path / "docs"), []) == set()
    write(spark, [(1, None, None)], str(tmp_path / "one"), 1)
    assert run(spark, str(tmp_path / "one"), []) == plain([(1, None, None)], [])


def test_thresholds_are_strict():
    assert mask_of(b"a " * 199 + b"b") == interactions.B
    assert mask_of("A".encode() + b"b" * 49) == interactions.A
    assert mask_of("A".encode() + b"b" * 48) == interactions.A | interactions.C
    assert mask_of("ÉÉÉ".encode()) == interactions.A and mask_of(b"") == interactions.A
