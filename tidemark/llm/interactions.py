"""How filters interact: what each removes in every order, per part of the corpus, by incremental retraction.

All that the audit asks follows from how many documents of a part fail which set of filters. Four filters judge
a text alone; the fifth, E, fails a document whose text a smaller id has as well. Files are taken as available-now
micro-batches. Keyed state holds the smallest id of every text and the documents that hold it; when a smaller one
arrives, the mask of the earlier ones is retracted from its part's counter and counted again with E.

A text is known by its SHA-256. State is kept in pages of some thousand texts by the first bits of it, so a batch
hands Python few groups. Rows are combined per text in the task that reads them, and again after the labels
are joined: a text that a third of all documents share reaches its page once for each task. Every batch writes
its changes of counters, a few rows for each part, to a folder of its own number, so a batch that is
repeated after a failure counts once.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.llm.frames import UPPER, Rows, new_folder, rows_of, small_batches, stored

A, B, C, D, E = (1 << i for i in range(5))
FILTERS = "ABCDE"
SIGNS = b"#$%&*|"
COMBINED = 50_000  # texts or documents a task combines before it hands them on

JUDGED = "id long, part string, digest binary, mask int, n long"
KEYED = "page int, digest binary, id long, part string, mask int, good boolean, toxic boolean, n long"
CHANGES = "part string, mask int, good boolean, toxic boolean, n long"


@dataclass(frozen=True)
class Audit:
    """``batches`` micro-batches at most; ``page_texts`` documents for each page of state, on average."""

    batches: int = 4
    page_texts: int = 2000
    least_words: int = 200


def mask_of(text: bytes, least_words: int = 200) -> int:
    """The filters of A to D that a text fails."""
    words = text.split()
    points = len(text.decode("utf-8", "surrogatepass"))
    mask = A if len(words) < least_words else 0
    if 100 * len(set(words)) < 50 * len(words):
        mask |= B
    if 100 * (len(text) - len(text.translate(None, UPPER.encode()))) > 2 * points:
        mask |= C
    if len(text) > len(text.translate(None, SIGNS)):
        mask |= D
    return mask


def judged(docs: DataFrame, params: Audit) -> DataFrame:
    """(id, part, digest, mask, n) of documents (id, part, text); equal rows of a task are one with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = Rows(schema_of(JUDGED)), Counter()

        def rest() -> Iterator[pa.RecordBatch]:
            for row, n in seen.items():
                yield from out.add(*row, n)
            seen.clear()

        for doc, part, text in rows_of(batches, "id", "part", "text"):
            raw = text.encode("utf-8", "surrogatepass")
            seen[doc, part, hashlib.sha256(raw).digest(), mask_of(raw, params.least_words)] += 1
            if len(seen) >= COMBINED:
                yield from rest()
        yield from rest()
        yield from out.rest()

    return docs.mapInArrow(run, JUDGED)


def schema_of(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


class First:
    """The smallest id of a text and how many documents hold it, by part and labels."""

    __slots__ = ("holders", "id")

    def __init__(self):
        self.id, self.holders = None, Counter()

    def take(self, doc: int, holder: tuple, mask: int, n: int, changes: Counter) -> None:
        """Count ``n`` documents, and those again that they come before."""
        part, good, toxic = holder
        if self.id is not None and doc > self.id:
            changes[part, mask | E, good, toxic] += n
            return
        if self.id is not None and doc < self.id:
            for (p, g, t), m in self.holders.items():
                changes[p, mask, g, t] -= m
                changes[p, mask | E, g, t] += m
            self.holders = Counter()
        self.id = doc
        self.holders[holder] += n
        changes[part, mask, good, toxic] += n


def combined(rows: DataFrame, pages: int) -> DataFrame:
    """``rows`` of labelled documents as ``KEYED``: of each text the documents with the smallest id in the task,
    on their way to its page, and the others (and those without an id) as changes that need no state: no digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, task = Rows(schema_of(KEYED)), TaskContext.get().partitionId()
        firsts: dict[bytes, tuple[int, First]] = {}
        settled = Counter()

        def rest() -> Iterator[pa.RecordBatch]:
            for digest, (mask, first) in firsts.items():
                for holder, n in first.holders.items():
                    settled[holder[0], mask, *holder[1:]] -= n  # counted by the page instead
                    part, good, toxic = holder
                    page = int.from_bytes(digest[:8], "big") % pages
                    yield from out.add(page, digest, first.id, part, mask, good, toxic, n)
            for i, ((part, mask, good, toxic), n) in enumerate(settled.items()):
                if n:
                    yield from out.add((task + i) % pages, None, None, part, mask, good, toxic, n)
            firsts.clear()
            settled.clear()

        for digest, doc, part, mask, good, toxic, n in rows_of(batches, "digest", "id", "part", "mask", "good", "toxic", "n"):
            if doc is None:
                settled[part, mask, good, toxic] += n
                continue
            if digest not in firsts:
                firsts[digest] = (mask, First())
            firsts[digest][1].take(doc, (part, good, toxic), mask, n, settled)
            if len(firsts) + len(settled) >= COMBINED:
                yield from rest()
        yield from rest()
        yield from out.rest()

    return rows.mapInArrow(run, KEYED)


def update_page(_page: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Bring a page of texts up to date and give the changes of counters."""
    firsts: dict[bytes, First] = {d: restored(*f) for d, f in pickle.loads(state.get[0]).items()} if state.exists else {}
    changes = Counter()
    for frame in frames:
        for digest, doc, part, mask, good, toxic, n in zip(*(frame[c].tolist() for c in ("digest", "id", "part", "mask", "good", "toxic", "n"))):
            if digest is None:
                changes[part, mask, good, toxic] += n
            else:
                firsts.setdefault(bytes(digest), First()).take(int(doc), (part, good, toxic), mask, n, changes)
    state.update((pickle.dumps({d: (f.id, dict(f.holders)) for d, f in firsts.items()}),))
    rows = [(*key, n) for key, n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def restored(doc: int, holders: dict) -> First:
    first = First()
    first.id, first.holders = doc, Counter(holders)
    return first


def file_stream(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """The rows of all Parquet files under ``path`` (or of the one file it is), as a stream of about ``batches``
    available-now micro-batches."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", at.getName()).parquet(path.rsplit("/", 1)[0])


def counters(stream: DataFrame, labels: DataFrame, documents: int, params: Audit = Audit()) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail which filters, from a stream of documents
    with doc_id, source and text, and a table of labels (doc_id, quality, toxic). ``documents``, about how many the
    stream will bring, sets the number of pages.

    NULL texts are empty, NULL sources the empty string. A document is good or toxic where any label of its id says
    1. Documents without an id have no labels, never fail E and make no other fail it. Rows that share the smallest
    id of a text all pass E.
    """
    spark = stream.sparkSession
    flags = _flags(labels)
    pages = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-documents // params.page_texts))
    small_batches(stream)
    docs = stream.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Rows without an id match no label; the second key spreads them.
    apart = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest", "part"), F.lit(1 << 16)) + 1).otherwise(F.lit(0))
    rows = judged(docs, params).withColumn("apart", apart.cast("long"))
    labelled = rows.join(flags, (F.col("id") == F.col("label_id")) & (F.col("apart") == F.col("label_apart")), "left")
    labelled = labelled.select(
        "digest", "id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n"
    )
    changed = combined(labelled, pages).groupBy("page").applyInPandasWithState(
        update_page, CHANGES, "texts binary", "append", GroupStateTimeout.NoTimeout
    )
    folder = new_folder(spark, "changes")

    def keep(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    running = changed.writeStream.foreachBatch(keep).option("checkpointLocation", new_folder(spark, "audit"))
    running = running.trigger(availableNow=True).start()
    try:
        running.awaitTermination()
    finally:
        running.stop()
    if running.lastProgress is None:  # no batch at all: no files
        return spark.createDataFrame([], CHANGES)
    changes = spark.read.schema(CHANGES).parquet(folder)
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def _flags(labels: DataFrame) -> DataFrame:
    one = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)))
    flags = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("label_id"))
    flags = flags.agg(one("quality").alias("good"), one("toxic").alias("toxic")).where("good or toxic")
    return stored(flags.withColumn("label_apart", F.lit(0).cast("long")), "flags")


def steps() -> list[dict]:
    """Every order of the filters and every step of it: the step's filter, and those before it, as bits."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def effects(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, from ``counters``: 600 rows for each part, all from
    the 32 sums of documents, good and toxic ones that a part has."""

    def cells(wanted: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(wanted & (F.col("mask") == m), F.col("n"))), F.lit(0)) for m in range(32)])

    parts = counts.groupBy("part").agg(
        cells(F.lit(True)).alias("every"), cells(F.col("good")).alias("good"), cells(F.col("toxic")).alias("toxic")
    )
    table = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order string, step int, bit int, before int>>")
    rows = parts.select("*", F.inline(table))
    bit, before = F.col("bit"), F.col("before")
    fails = lambda m, bits: m.bitwiseAND(bits) != 0

    def total(values: str, wanted, weight=lambda n, m: n) -> Column:
        add = lambda acc, m: acc + F.when(wanted(m), weight(F.get(F.col(values), m), m)).otherwise(F.lit(0))
        return F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("long"), add)

    here = lambda m: fails(m, bit) & ~fails(m, before)
    # of all orders, the part in which a filter comes first among those that a document fails
    share = lambda n, m: n * F.floor(F.lit(120) / F.bit_count(m))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("every", lambda m: ~fails(m, bit) & ~fails(m, before)).alias("kept"),
        total("every", here).alias("removed"),
        total("every", lambda m: fails(m, bit) & fails(m, before)).alias("redundant"),
        F.get(F.col("every"), bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        total("every", lambda m: fails(m, bit), share).alias("shapley"),
    )


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, params: Audit = Audit()) -> DataFrame:
    """``effects`` over all documents under ``path``; see ``counters``. An empty table gives no rows."""
    documents = spark.read.parquet(path).count()
    return effects(counters(file_stream(spark, path, params.batches), labels, documents, params))
