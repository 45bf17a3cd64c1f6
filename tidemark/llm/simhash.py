"""SimHash near-duplicates by pigeonhole blocks.

Two fingerprints within ``max_bits`` of each other agree in some choice of whole blocks, so they meet in at
least one table that is keyed by those blocks. Equal fingerprints are one row throughout. In a bucket of
few fingerprints the pairs are compared; a bucket of many is keyed again by every value within half the
distance of a member: fingerprints that share such a midpoint are linked, linked ones share one, and at
most as many fingerprints as there are midpoints to one can meet there. So a group of any size costs a
fixed number of rows for each fingerprint, and no link is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Rows, components, keyed, pin, rows_of, same_row, scratch, small_side, stored

PRINTS = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("fp", pa.int64())])
PAIRS_UP_TO = 64  # fingerprints of a bucket that are compared in pairs; more go by midpoints
UNPACK = 1 << 15  # shingles whose bits are added up at once


@dataclass(frozen=True)
class SimHash:
    shingle: int = 4
    seed: int = 42
    max_bits: int = 4


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words of ``text``; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return print_of(np.fromiter((digest(joined[a:b], seed) for a, b in cuts), np.uint64, len(words) - k + 1))


def print_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the 64-bit ``hashes``."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), UNPACK):
        part = hashes[at : at + UNPACK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, params: SimHash = SimHash()) -> DataFrame:
    """(id, h, fp): the fingerprint of every row as a signed long; see ``frames.keyed`` for id and h."""
    shingle, seed = params.shingle, params.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(PRINTS)
        for doc, h, text in rows_of(batches, "id", "h", "text"):
            fp = fingerprint(text, shingle, seed)
            yield from out.add(doc, h, fp - (1 << 64) if fp >> 63 else fp)
        yield from out.rest()

    rows = keyed(docs)
    return rows.withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id long, h long, fp long")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def tables_for(fingerprint_count: int, max_bits: int) -> list[int]:
    """Masks of the bits that key each table. More blocks make keys longer and tables more; the first
    scheme is taken whose buckets have four fingerprints or fewer on average. All schemes find every pair."""
    for blocks in range(max_bits + 1, 17):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
        masks = [sum(c) for c in combinations(block, blocks - max_bits)]
        if fingerprint_count <= 4 << min(m.bit_count() for m in masks):
            break
    return masks


def near_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``prints``: all that fingerprints at
    ``max_bits`` or less need to be in one component, each between fingerprints that are that near."""
    masks = tables_for(prints.count(), max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = pin(rows.join(sizes, ["t", "key"]))
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= max_bits

    few = shared.filter(F.col("n") <= PAIRS_UP_TO).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    few = few.select("fps", F.explode("fps").alias("a"))
    few = few.select("a", F.explode(F.filter("fps", lambda b: (b > F.col("a")) & near(F.col("a"), b))).alias("b"))

    # midpoints: a bucket's members agree in the key, so only the other bits can differ
    half = max_bits // 2
    flips = [
        (i, signed(sum(bits)))
        for i, m in enumerate(masks)
        for k in range(half + 1)
        for bits in combinations([1 << b for b in range(64) if not m >> b & 1], k)
    ]
    flips = prints.sparkSession.createDataFrame(flips, "t int, flip long")
    many = shared.filter(F.col("n") > PAIRS_UP_TO).select("t", "fp")
    middle = many.join(F.broadcast(flips), "t").select("t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    least = middle.groupBy("t", "mid").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
    star = least.filter(F.size("fps") > 1).select("a", F.explode("fps").alias("b")).filter("a < b")
    return few.union(star.select("a", "b")).distinct()


def groups(docs: DataFrame, params: SimHash = SimHash()) -> DataFrame:
    """(id, h, fp, component_id): near-duplicate groups of all rows. ``component_id`` is the smallest id
    that can be reached over links, NULL where no row of the component has an id.

    NULL and empty texts have fingerprint zero and link like any other. Odd ``max_bits`` are not offered
    (midpoints need half of it).
    """
    if params.max_bits % 2:
        raise ValueError("max_bits must be even")
    rows = pin(fingerprints(docs, params))
    prints = pin(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(near_links(prints.select("fp"), params.max_bits))
    labelled = prints.join(roots, F.col("fp") == F.col("node"), "left")
    labelled = labelled.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(lowest, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    # every row of a fingerprint has the same label; a hot fingerprint's rows are split by the skew join
    return rows.join(by_print, F.col("fp") == F.col("_fp"), "left").select("id", "h", "fp", "root", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, params: SimHash = SimHash()) -> DataFrame:
    """The documents with their columns, one of each group: that with the smallest id (rows without an id
    come last; rows equal in id and text count once)."""
    return kept_of(docs, groups(docs, params))


def kept_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One document for each ``root`` of ``found`` (id, h, root). Few rows that go are looked up where the
    documents lie; documents are shuffled only where more go than are broadcast."""
    with scratch(docs.sparkSession):
        found = stored(found, "groups")
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h"))
        keep = found.groupBy("root").agg(first.alias("k")).select(F.col("k.id").alias("id"), F.col("k.h").alias("h"))
        rows = found.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n"))
        gone = stored(rows.join(keep, same_row(rows, keep), "left_anti").select("id", "h"), "gone", keep=True)
        again = stored(rows.filter("n > 1").select("id", "h"), "again", keep=True)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("h"))
    gone, again = small_side(gone), small_side(again)
    kept = whole.join(gone, same_row(whole, gone), "left_anti")
    single = kept.join(again, same_row(kept, again), "left_anti").select("doc")
    twice = kept.join(again, same_row(kept, again), "left_semi")
    twice = twice.groupBy("id", "h").agg(F.first("doc").alias("doc")).select("doc")
    return single.union(twice).select("doc.*")
