"""Near-duplicates by the word shingles they share.

Two texts are linked where the Jaccard similarity of their sets of word shingles is at least
``similarity``. Candidates come from two sketches of those sets. SimHash: texts whose fingerprints differ in at most
``max_bits`` bits, found by pigeonhole blocks (see ``simhash``). MinHash, since most texts at 0.8 differ in more bits
than blocks can find: texts that agree in all hashes of a band meet in a bucket. Every candidate pair is then decided by
the shingles themselves. Texts equal in their lower-cased words are one throughout. In a bucket of few texts all pairs
are candidates.

The texts of crowded buckets are joined exactly, by their rare shingles. Shingles are put in one order, rare ones
(in at most ``PAIRS_UP_TO`` of these texts) before frequent ones. Of a text with n shingles the first
n - ceil(0.8 n) + 1 are its prefix, and similar texts have a shingle of both prefixes in common:

* A rare one: the few texts that have it are compared in pairs.
* A frequent one: most shingles of both texts are frequent, as in a crowd of near copies. In every crowded bucket
  such texts are compared with one of them, the centre, which links a crowd by one row for each text. Pairs that this
  leaves in two components are found by how they differ from their centre (see ``alone_in_crowds``): two texts that
  both lack similarity to it are similar only if they differ from it in much the same shingles.

So no similar pair that meets in a bucket is left in two components, and what is compared in full is what
does not belong to a crowd.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.frames import BROADCAST_ROWS, Rows, components, compressed, keyed, rows_of, same_row, scratch, small_side, stored, unpacked
from tidemark.llm.simhash import kept_of, near_links, print_of, signed

SIGNED = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("c", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
HOT = pa.schema([("c", pa.int64()), ("size", pa.int64()), ("s", pa.int64()), ("hot", pa.list_(pa.int64()))])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
PAIRS_UP_TO = 64  # texts of a bucket, or of a shingle, that are compared in pairs
AT_ONCE = 1 << 12  # shingles hashed at once


@dataclass(frozen=True)
class Shingles:
    """``bands`` of ``rows`` MinHashes: a pair at similarity 0.8 shares no band with a chance of 3e-6."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 4
    seed: int = 42
    max_bits: int = 4  # of SimHash fingerprints


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return raw.lower().split()


def shingle_hashes(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; of all words together where there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], seed) for a, b in cuts), np.uint64, len(words) - k + 1))


def band_keys(hashes: np.ndarray, params: Shingles) -> list[int]:
    """A key for each band, of the least values of its hash functions; none without shingles."""
    if not len(hashes):
        return []
    rng = np.random.default_rng(params.seed)
    n = params.bands * params.rows
    factor = (rng.integers(1, 1 << 63, n, np.uint64) << np.uint64(1)) | np.uint64(1)
    plus = rng.integers(0, 1 << 63, n, np.uint64)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), AT_ONCE):
        part = hashes[at : at + AT_ONCE, None] * factor + plus
        np.minimum(least, (part ^ part >> np.uint64(31)).min(axis=0), out=least)
    bands = least.reshape(params.bands, params.rows)
    return [int.from_bytes(xxhash.xxh64_digest(b.tobytes(), i), "big", signed=True) for i, b in enumerate(bands)]


def canonical(words: list[bytes]) -> int:
    return int.from_bytes(xxhash.xxh64_digest(b" ".join(words)), "big", signed=True)


def signatures(docs: DataFrame, params: Shingles) -> DataFrame:
    """(id, h, c, fp, bands): ``c`` is a hash of the lower-cased words, ``fp`` the fingerprint of the set of shingles
    (NULL without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(SIGNED)
        for doc, h, text in rows_of(batches, "id", "h", "text"):
            words = words_of(text)
            hashes = shingle_hashes(words, params.shingle, params.seed)
            fp = signed(print_of(hashes)) if words else None
            yield from out.add(doc, h, canonical(words), fp, band_keys(hashes, params))
        yield from out.rest()

    rows = keyed(docs)
    return rows.withColumn("id", F.col("id").cast("long")).mapInArrow(run, "id long, h long, c long, fp long, bands array<long>")


def near_prints(texts: DataFrame, params: Shingles) -> DataFrame:
    """Pairs (a, b) of distinct texts (c, fp) whose fingerprints are near. Texts with the same fingerprint are paired
    with the least of them, which stands for them in pairs with other fingerprints."""
    least = stored(texts.filter("fp is not null").groupBy("fp").agg(F.min("c").alias("least")), "prints")
    same = texts.join(least, "fp").filter("c <> least").select(F.col("least").alias("a"), F.col("c").alias("b"))
    links = near_links(least.select("fp"), params.max_bits)
    of = lambda end: least.select(F.col("fp").alias(end), F.col("least").alias(f"{end}_c"))
    near = links.join(of("a"), "a").join(of("b"), "b")
    return same.union(near.select(F.least("a_c", "b_c").alias("a"), F.greatest("a_c", "b_c").alias("b")))


def crowds(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the buckets of distinct texts (c, bands): the pairs (a, b) of those with few texts, and the members
    (t, key, c) of the others."""
    rows = texts.select("c", F.posexplode("bands").alias("t", "key"))
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(rows.join(sizes, ["t", "key"]), "buckets")
    few = shared.filter(F.col("n") <= PAIRS_UP_TO).groupBy("t", "key").agg(F.collect_list("c").alias("cs"))
    return in_pairs(few), shared.filter(F.col("n") > PAIRS_UP_TO).select("t", "key", "c")


def in_pairs(lists: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of each list ``cs``."""
    each = lists.select("cs", F.explode("cs").alias("a"))
    return each.select("a", F.explode(F.filter("cs", lambda b: b > F.col("a"))).alias("b"))


def prefixes(texts: DataFrame, params: Shingles) -> DataFrame:
    """(c, size, s, hot): of every text (c, packed) the rare shingles s of its prefix, and, where the prefix has
    frequent ones as well (and so all its rare ones), one row with all its frequent shingles as ``hot``. Few frequent
    shingles are looked up where the texts are; more are marked by a join."""

    def hashes_of(packed: bytes) -> np.ndarray:
        return shingle_hashes(words_of(unpacked(packed)), params.shingle, params.seed).view(np.int64)

    def longest(n: int) -> int:
        return n - int(np.ceil(n * params.similarity - 1e-9)) + 1

    def rows(c: int, size: int, part: np.ndarray) -> list[pa.Array]:
        return [pa.array(np.full(len(part), v, np.int64)) for v in (c, size)] + [pa.array(part)]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c, packed in rows_of(batches, "c", "packed"):
            hashes = hashes_of(packed)
            for at in range(0, len(hashes), 1 << 16):
                yield pa.RecordBatch.from_arrays(rows(c, len(hashes), hashes[at : at + (1 << 16)]), ["c", "size", "s"])

    every = texts.mapInArrow(whole, "c long, size long, s long")
    often = every.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PAIRS_UP_TO)
    often = stored(often.select("s"), "often")
    if often.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        frequent = np.array(sorted(r[0] for r in often.collect()), np.int64)
        sent = texts.sparkSession.sparkContext.broadcast(frequent)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for c, packed in rows_of(batches, "c", "packed"):
                hashes = hashes_of(packed)
                known = np.isin(hashes, sent.value)
                rare, prefix = hashes[~known], longest(len(hashes))
                part = rows(c, len(hashes), rare[:prefix])
                yield pa.RecordBatch.from_arrays([*part, pa.nulls(len(part[0]), HOT.field("hot").type)], schema=HOT)
                if len(rare) < prefix:
                    yield pa.RecordBatch.from_pylist([{"c": c, "size": len(hashes), "hot": hashes[known]}], schema=HOT)

        return texts.mapInArrow(cut, "c long, size long, s long, hot array<long>")
    marked = every.join(often.withColumn("often", F.lit(True)), "s", "left")
    marked = marked.withColumn("crowd", F.coalesce("often", F.lit(False)))
    place = F.row_number().over(Window.partitionBy("c").orderBy("crowd", "s"))
    prefix = F.col("size") - F.ceil(F.col("size") * params.similarity - 1e-9) + 1
    rare = marked.withColumn("place", place).filter((F.col("place") <= prefix) & ~F.col("crowd"))
    hot = marked.groupBy("c", "size").agg(F.collect_list(F.when(F.col("crowd"), F.col("s"))).alias("hot"))
    hot = hot.filter(F.col("size") - F.size("hot") < prefix).select("c", "size", F.lit(None).cast("long").alias("s"), "hot")
    return rare.select("c", "size", "s", F.lit(None).cast("array<long>").alias("hot")).union(hot)


def surplus(params: Shingles) -> Column:
    """Of a text with ``size`` shingles, ``hot`` of them frequent: what its rare shingles leave of the share of its
    size that a similar text must have in common. Texts x and y with no rare shingle in common are similar where
    2 |hot x & hot y| is at least |hot x| + |hot y| + surplus x + surplus y."""
    return F.col("size") * (2 * params.similarity / (1 + params.similarity)) - F.size("hot")


def alone_in_crowds(spokes: DataFrame, hot: DataFrame, roots: DataFrame, params: Shingles) -> DataFrame:
    """Pairs (a, b) of texts c (``hot``: c, size, hot) that have a centre m in common (``spokes``: m, c) but no
    component, and can be similar. All pairs with a rare shingle in common, and all spokes, have been compared.

    Texts are told apart by the d frequent shingles that only they or their centre have. Let q be d plus the surplus.
    Similar texts have (q + q')/2 of those shingles in common. This is more than none, for the centre has the least
    surplus, and of two texts in different components one is not similar to the centre. So, with the shingles in
    one order, there is one in common with (q + q')/2 or more of either text's left from it on.
    """
    of = roots.select(F.col("node").alias("c"), "root")
    rows = spokes.join(of, "c", "left").join(roots.select(F.col("node").alias("m"), F.col("root").alias("main")), "m", "left")
    rows = rows.withColumn("root", F.coalesce("root", "c")).withColumn("apart", F.col("root") != F.coalesce("main", "m"))
    rows = stored(rows.select("m", "c", "root", "apart"), "rooted")
    split = rows.filter("apart").select("m").distinct()
    rows = rows.join(split, "m", "left_semi").join(hot.select("c", "hot", surplus(params).alias("base")), "c")
    rows = rows.join(hot.join(split, F.col("c") == F.col("m"), "left_semi").select(F.col("c").alias("m"), F.col("hot").alias("its")), "m")
    off = F.concat(F.array_except("hot", "its"), F.array_except("its", "hot"))
    rows = rows.select("m", "c", "root", "apart", "base", off.alias("off")).withColumn("d", F.size("off"))
    rows = stored(rows.withColumn("q", F.col("d") + F.col("base")), "differing")
    # Two texts fit where the q of each is in reach of the other; one of them is apart from the centre.
    reach = F.col("d") - F.col("base") + 1e-6
    ends = rows.groupBy("m").agg(
        F.min("q").alias("low"),
        F.max(reach).alias("far"),
        F.min(F.when(F.col("apart"), F.col("q"))).alias("apart_low"),
        F.max(F.when(F.col("apart"), reach)).alias("apart_far"),
    )
    low, far = (F.when(F.col("apart"), F.col(e)).otherwise(F.col(f"apart_{e}")) for e in ("low", "far"))
    rows = rows.join(ends, "m").filter((reach >= low) & (F.col("q") <= far)).withColumn("low", low)
    rows = rows.select("m", "c", "root", "d", "q", "low", F.explode("off").alias("s"))
    rows = stored(rows, "differences")
    rows = rows.join(rows.groupBy("m", "s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), ["m", "s"], "left")
    place = F.row_number().over(Window.partitionBy("m", "c").orderBy(F.coalesce("n", F.lit(1)), "s"))
    left = 2 * (F.col("d") - place + 1) - F.col("q") + 1e-6
    rows = rows.withColumn("reach", left).filter("reach >= low and n > 1").select("m", "s", "c", "root", "q", "reach")
    rows = stored(rows, "prefixes")
    sizes = rows.groupBy("m", "s", "root").agg(F.count(F.lit(1)).alias("n"), F.min("q").alias("low"), F.max("reach").alias("far"))
    most = sizes.groupBy("m", "s").agg(
        F.max_by("root", F.struct("n", "root")).alias("most"),
        F.count(F.lit(1)).alias("roots"),
        F.min("low").alias("low"),
        F.max("far").alias("far"),
    )
    rows = rows.join(most.filter("roots > 1"), ["m", "s"]).filter("reach >= low and q <= far")
    one, two = rows.filter("root <> most").alias("one"), rows.alias("two")
    fit = F.expr("one.root <> two.root and one.q <= two.reach and two.q <= one.reach")
    met = one.join(two, F.expr("one.m = two.m and one.s = two.s") & fit)
    return met.select(F.least("one.c", "two.c").alias("a"), F.greatest("one.c", "two.c").alias("b")).distinct()


def texts_of(wanted: DataFrame, rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(c, packed): the text of each ``wanted`` c, of the one row of ``rows`` (id, h, c) that comes first. Few
    keys are looked up where the documents lie."""
    one = rows.join(small_side(wanted), "c", "left_semi").groupBy("c").agg(F.min(F.struct("h", "id")).alias("k"))
    keys = small_side(stored(one.select("c", "k.id", "k.h"), "keys"))
    whole = keyed(docs).withColumn("id", F.col("id").cast("long"))
    found = whole.join(keys, same_row(whole, keys)).select("c", compressed(F.col("text")).alias("packed"))
    return stored(found.dropDuplicates(["c"]), "texts")


def similar(pairs: DataFrame, texts: DataFrame, params: Shingles) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts (c, packed) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, one = Rows(LINKS), None, None
        of = lambda p: shingle_hashes(words_of(unpacked(p)), params.shingle, params.seed)
        for a, b, first, second in rows_of(batches, "a", "b", "first", "second"):
            if a != last:
                last, one = a, of(first)
            other = of(second)
            both = len(np.intersect1d(one, other, assume_unique=True))
            if both >= params.similarity * (len(one) + len(other) - both):
                yield from out.add(a, b)
        yield from out.rest()

    both = pairs.join(texts.select(F.col("c").alias("b"), F.col("packed").alias("second")), "b")
    both = both.join(texts.select(F.col("c").alias("a"), F.col("packed").alias("first")), "a")
    return stored(both.select("a", "b", "first", "second").mapInArrow(run, "a long, b long"), "links")


def links_of(rows: DataFrame, docs: DataFrame, params: Shingles) -> DataFrame:
    """Links (a, b) that join all similar texts into their components. ``rows``: (id, h, c, fp, bands)."""
    distinct = stored(rows.groupBy("c").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")), "distinct")
    few, members = crowds(distinct)
    few = stored(few.union(near_prints(distinct, params)).distinct(), "pairs")
    crowded = stored(members.select("c").distinct(), "crowded")
    texts = texts_of(few.select(F.explode(F.array("a", "b")).alias("c")).union(crowded).distinct(), rows, docs)
    links = similar(few, texts, params)
    if crowded.isEmpty():
        return links
    prefix = stored(prefixes(texts.join(small_side(crowded), "c", "left_semi"), params), "prefixes")
    rare = in_pairs(prefix.filter("hot is null").groupBy("s").agg(F.collect_list("c").alias("cs")))
    hot = prefix.filter("hot is not null").select("c", "size", "hot")
    rows = members.join(small_side(hot.select("c", surplus(params).alias("base"))), "c")
    centre = rows.groupBy("t", "key").agg(F.min_by("c", F.struct("base", F.xxhash64("c"))).alias("m"))
    spokes = stored(rows.join(centre, ["t", "key"]).filter("c <> m").select("m", "c").distinct(), "spokes")
    pairs = rare.union(spokes.select(F.least("c", "m").alias("a"), F.greatest("c", "m").alias("b")))
    links = links.union(similar(stored(pairs.distinct(), "pairs"), texts, params))
    rest = stored(alone_in_crowds(spokes, hot, components(links), params), "rest")
    return links.union(similar(rest, texts, params))


def one_of_each_similar(docs: DataFrame, params: Shingles = Shingles()) -> DataFrame:
    """The documents with their columns, one of each group of similar texts: that with the smallest id (rows
    without an id come last; rows equal in id and text count once). NULL and empty texts are one group; texts of
    fewer words than a shingle are one shingle. A similar pair is missed only if it shares no bucket (see
    ``Shingles``). An empty table gives no rows."""
    with scratch(docs.sparkSession):
        rows = stored(signatures(docs, params), "signatures")
        roots = components(links_of(rows, docs, params))
        found = rows.join(roots, F.col("c") == F.col("node"), "left")
        found = stored(found.select("id", "h", F.coalesce("root", "c").alias("root")), "roots", keep=True)
    return kept_of(docs, found)
