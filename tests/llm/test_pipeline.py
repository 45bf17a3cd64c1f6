"""The pipeline against a plain version of each stage, on whole tables."""

import sys
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import test_bpe  # noqa: E402
import test_decontaminate  # noqa: E402
import test_native  # noqa: E402
import test_neardup  # noqa: E402
import test_substrings  # noqa: E402

import corpus_pipeline  # noqa: E402
from tidemark.llm.decontaminate import Leaks  # noqa: E402
from tidemark.llm.substrings import cut_out  # noqa: E402
import numpy as np  # noqa: E402

SF = "/root/testdata/sf0.001"


def leaks(text, items, p=Leaks()):
    """Whether a pattern is within its budget: one of budget + 1 pieces of it must then occur unchanged, and
    the place around it decides."""
    text = test_decontaminate.plain(text)
    for item in items:
        whole = test_decontaminate.plain(item)
        if len(whole) < p.least:
            continue
        last = max(0, len(whole) - p.length)
        for a in sorted({*range(0, last + 1, p.stride), last}):
            pattern, k = whole[a : a + p.length], p.edits(min(p.length, len(whole)))
            size = len(pattern) // (k + 1)
            for piece in range(k + 1):
                at = text.find(pattern[piece * size : piece * size + size])
                while at >= 0:
                    around = text[max(0, at - piece * size - k) : at - piece * size + len(pattern) + k]
                    if test_decontaminate.distance(pattern, around) <= k:
                        return True
                    at = text.find(pattern[piece * size : piece * size + size], at + 1)
    return False


def test_every_stage_equals_its_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r.asDict() for r in docs.collect()]
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test")
        outputs.append(docs)
    for out in outputs[:-1]:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    by_id = [{r.doc_id: r for r in out.collect()} for out in outputs]

    rows = [r for r in rows if not test_native.measured(r["text"])[5]]  # no host of these tables fails
    assert set(by_id[0]) == {r["doc_id"] for r in rows}

    pairs = [(r["doc_id"], r["text"]) for r in rows]
    rows = [r for at, (r, root) in enumerate(zip(rows, test_neardup.roots(pairs))) if at == root]
    assert set(by_id[1]) == {r["doc_id"] for r in rows}

    for r, (_, gone) in zip(rows, test_substrings.brute([r["text"] for r in rows])):
        r["text"] = cut_out(r["text"], np.array(gone, bool))
    assert {i: r.text for i, r in by_id[2].items()} == {r["doc_id"]: r["text"] for r in rows}

    rows = [r for r in rows if not leaks(r["text"], benchmark)]
    assert set(by_id[3]) == {r["doc_id"] for r in rows}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(by_id[4]) == {r["doc_id"] for r in rows}
    for r in rows:
        got = by_id[4][r["doc_id"]]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == test_bpe.expected(tokenizer, r["text"])


def test_other_columns_and_odd_rows_pass_through(spark):
    good = " ".join(f"word{i}" for i in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, h int, doc string, marks int"
    rows = [(1, good, None, None, 1, "x", 1, "d", 2), (2, None, "en", "s", None, None, None, None, None), (None, good, "en", "s", 3, "", 0, "", 0)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
    assert docs.count() == 1  # both good rows are copies; the row with an id stays
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
