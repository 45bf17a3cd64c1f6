"""Cases of the native operators that the tables lack: NULLs, ties, repeats, long texts, empty tables."""

import re
from collections import Counter
from importlib import resources

import pytest

from tidemark.llm import licences, quality
from tidemark.llm.chat import ChatFormat, rotate
from tidemark.llm.licences import known_digests, license_scan
from tidemark.llm.quality import QualityRules
from tidemark.llm.reputation import UrlRule, judge_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], SCHEMA)


def measured(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered |= {*range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_measures_equal_brute_force(spark):
    texts = [None, "", " \n\t", "a", "one two three four five six seven eight", "x y " * 30, "é ü\n" * 9, "a # b\r\n" * 3]
    texts += ["lead " + "one two three four five six seven eight nine " * 2 + "tail", " ".join(map(str, range(50)))]
    texts += ["w " * 30_000, "nbsp\u00a0stays \x85 and\x1cthis " * 5]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(texts)] + [(None, "no id", None), (3, "a", "s0"), (3, "a", "s0")]
    docs = frame(spark, rows).withColumnRenamed("lang", "host")
    got = quality.quality(docs).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, *(r[c] for c in columns)) for r in got), key=key) == sorted(((i, *measured(t)) for i, t, _ in rows), key=key)


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_a_failing_host_takes_its_documents_along(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality, "BROADCAST_HOSTS", broadcast)
    good = " ".join(map(str, range(40)))
    rows = [(i, "short", "bad") for i in range(50)] + [(50, good, "bad")]
    rows += [(100 + i, good, f"h{i % 5}") for i in range(200)] + [(400, "short", "h1"), (401, good, None)]
    docs = frame(spark, rows)
    kept = {r.doc_id for r in quality.quality(docs).collect() if r.kept}
    assert kept == {*range(100, 300), 401}
    stays = quality.keep_good(docs)
    assert stays.columns == docs.columns and {r.doc_id for r in stays.collect()} == kept
    assert 50 in {r.doc_id for r in quality.keep_good(docs, QualityRules(max_host_rate=1.0)).collect()}


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert quality.quality(empty).count() == quality.keep_good(empty).count() == 0
    assert license_scan(empty, known_digests(spark)).count() == 0
    assert rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    assert judge_urls(pages, labels, []).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/x", "")], pages.schema)
    assert [r.verdict for r in judge_urls(one, labels, []).collect()] == ["allow"]


def test_licences(spark):
    mit = next(iter(__import__("tidemark.llm.licences", fromlist=["KNOWN"]).KNOWN["MIT"]))
    rows = [
        (1, "MIT LICENCE\n\nCopyright (c) 2020 Somebody\n" + mit.split("\n", 1)[1].replace('"', "“"), "s"),
        (2, "some text\nreleased under the MIT licence\nmore\nLicensed under CC BY-NC 4.0", "s"),
        (3, None, "s"), (4, "", "s"), (5, "© 2021 me\nAll rights reserved.", "s"), (None, "Released under the MIT License!", "s"),
        (2, "some text\nreleased under the MIT licence\nmore\nLicensed under CC BY-NC 4.0", "s"), (6, "MIT", "s"), (7, "x " * 100_000, "s"),
    ]
    got = license_scan(frame(spark, rows).withColumnRenamed("lang", "digest"), known_digests(spark)).collect()
    seen = sorted(((r.doc_id or 0, r.license, r.notices, r.notice_lines) for r in got), key=repr)
    assert seen == sorted(
        [(1, "MIT", None, 0), (2, None, "CC-BY-NC-4.0,MIT", 2), (2, None, "CC-BY-NC-4.0,MIT", 2), (3, None, None, 0), (4, None, None, 0),
         (5, None, None, 0), (0, "MIT", "MIT", 1), (6, None, None, 0), (7, None, None, 0)], key=repr)
    assert len({r.digest for r in got if r.doc_id in (3, 4, 5)}) == 1


def test_whole_licence_texts(spark):
    bsd = licences.BSD_HEAD + "\n1. " + licences.BSD_CONDITIONS[0] + "\n2. " + licences.BSD_CONDITIONS[1]
    ends = "\n" + licences.BSD_AS_IS.format("HOLDER")
    third = "\n3. " + licences.BSD_CONDITIONS[2].format("the copyright holder")
    read = lambda name: (resources.files("tidemark.llm") / "texts" / name).read_text()
    texts = {
        "BSD-2-Clause": "BSD 2-Clause License\n\nCopyright (c) 2020, Somebody\nAll rights reserved.\n\n" + bsd + ends,
        "BSD-3-Clause": "Copyright 2020 Somebody\n\n" + bsd + third + ends,
        "Apache-2.0": read("Apache-2.0.txt").split("   APPENDIX")[0],
        "GPL-3.0": "\n" + read("GPL-3.0.txt"),
        "MPL-2.0": read("MPL-2.0.txt").replace("http://", "https://"),
    }
    got = license_scan(frame(spark, [(i, t, "s") for i, t in enumerate(texts.values())]), known_digests(spark)).collect()
    assert [r.license for r in sorted(got, key=lambda r: r.doc_id)] == list(texts)
    digests = [r.digest for r in known_digests(spark).collect()]
    assert len(digests) == len(set(digests))


def test_perspectives(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", "yo"), (1, 2, "ann", None), (1, 2, "ann", None), (1, 40, "cy", "late"),
            (None, None, None, "?"), (2, 5, "ann", "tie b"), (2, 5, "ann", "tie a")]
    frame_ = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {(r.conv_id, r.speaker, r.block): r for r in rotate(frame_).collect()}
    assert set(got) == {(1, s, b) for s in ("ann", "bob", "cy") for b in (0, 1)} | {(None, "unknown", None), (2, "ann", 0)}
    assert got[1, "ann", 0].mask == "101" and got[1, "bob", 0].mask == "010" and got[1, "cy", 0].mask == "000"
    assert got[1, "bob", 0].dialogue == (
        "<|im_start|>user name=ann\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user name=ann\n<|im_end|>\n"
    )
    assert got[2, "ann", 0].dialogue.index("tie a") < got[2, "ann", 0].dialogue.index("tie b")


@pytest.mark.parametrize("most", [4, 1000])
def test_no_message_is_lost_in_a_crowded_block(spark, most):
    rows = [(1, 3, f"p{i % 3}", f"text {i}") for i in range(60)]
    got = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), ChatFormat(most=most)).collect()
    assert sum(r.n_messages for r in got) == 180 and sum(r.n_trained for r in got) == 60
    assert all(r.mask.count("1") == r.n_trained and len(r.mask) == r.n_messages for r in got)


def test_parts_of_a_crowded_block_give_the_dialogue_in_order(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, t, f"p{i % 3}", f"text {i:03d}") for c, t in ((1, 3), (None, None), (2, None)) for i in range(50)]
    rows += [(1, 2, "p1", "before"), (1, 4, "p1", "after"), (3, 0, "p0", "alone"), (1, 40, "p0", "late")]
    frame_ = spark.createDataFrame(rows, schema).repartition(5)
    whole = {(r.conv_id, r.speaker, r.block): r for r in rotate(frame_, ChatFormat(most=1000)).collect()}
    parts = {}
    for r in sorted(rotate(frame_, ChatFormat(most=8)).collect(), key=lambda r: r.part):
        assert r.n_messages <= 8
        parts.setdefault((r.conv_id, r.speaker, r.block), []).append(r)
    assert set(parts) == set(whole)
    for k, rs in parts.items():
        assert [r.part for r in rs] == list(range(-(-whole[k].n_messages // 8)))
        assert "".join(r.dialogue for r in rs) == whole[k].dialogue and "".join(r.mask for r in rs) == whole[k].mask


def test_url_rules_and_reputation(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/x?q#f", "x://example.org", "x://example.org/en/12", "x://y.com/de/",
            "x://com/fr/1?://z", "x://notexample.org/es/", "x://bad.net/1\n2", "x://b.bad.net/", "x://u@h.co.uk:80/p#a?b"]
    pages = [(i, u, "") for i, u in enumerate(urls)] + [(100 + i, f"http://bad.net/{i}", "") for i in range(60)]
    pages += [(200 + i, f"http://good{i % 9}.net/{i}", "") for i in range(90)] + [(None, "x://bad.net/", ""), (9, urls[9], "")]
    labels = [(100 + i, True) for i in range(50)] + [(200 + i, i % 10 == 0) for i in range(90)] + [(100, True), (None, True), (101, None)]
    rules = [UrlRule("org", "/", "allow"), UrlRule("example.org", "/es/", "block"), UrlRule("example.org", "/en/1", "block"),
             UrlRule("com", "/fr/", "allow"), UrlRule("com", "/de/", "block")]
    frame_ = spark.createDataFrame(pages, "page_id long, url string, html string").withColumnRenamed("html", "host")
    got = judge_urls(frame_, spark.createDataFrame(labels, "page_id long, bad boolean"), rules).collect()
    assert len(got) == len(pages)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is not None}
    assert by[0] == by[1] == by[2] == ("", "", None, "allow")
    assert by[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert by[4] == ("example.org", "", None, "allow")
    assert by[5] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert by[6] == ("y.com", "/de/", "com/de/", "block")
    assert by[7] == ("com", "/fr/1", "com/fr/", "allow")
    assert by[8] == ("notexample.org", "/es/", "org/", "allow")
    assert by[9] == ("bad.net", "/1\n2", None, "block") and by[100][3] == "block"
    assert by[11][:2] == ("u@h.co.uk:80", "/p")
    assert {by[200 + i][3] for i in range(90)} == {"allow"}


def test_crowded_blocks_equal_the_sql(spark, tmp_path):
    import duckdb

    from tidemark.llm.op6_query import SQL, op6_chat

    rows = [(1, 3, f"p{i % 3}", f"text {i:03d}") for i in range(300)] + [(None, None, None, f"t{i}") for i in range(130)]
    rows += [(2, t, "ann", "x") for t in range(70)] + [(2, 5, "bob", None), (2, 5, "bob", None)]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    got = op6_chat(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(SQL)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
    assert max(r.part for r in got.collect()) == 2
