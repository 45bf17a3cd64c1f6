"""Exact top-k by inner product: ball-tree branch and bound in every shard.

The table is cut into shards of bounded size where its rows lie; each becomes a ball tree, stored in the
shared folder. No inner product of a query q with a vector of a node exceeds <q, centre> + |q| radius, so
nodes are opened in the order of that bound until none can reach the k-th score found so far.

Queries that lie near each other descend a tree together, and the search of a leaf is one matrix product. A
task carries its k-th scores from shard to shard. Tasks share them in two waves: the first opens one leaf of a
bounded number of shards for each query, and its k-th scores, which are scores of real rows, are what the second
wave starts from in every shard. Queries come in blocks of bounded size, each broadcast and finished by itself,
so neither a machine nor the driver holds more than a block of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.frames import new_folder, small_batches, stored
from tidemark.llm.vectors import matrices, usable

EXACT = 2.0**53  # whole numbers below it are exact in a double
LAST = np.iinfo(np.int64).max

TREES = (
    "shard long, ids array<long>, asked array<boolean>, size int, vectors binary, spans binary, centres binary, "
    "radii binary, least binary"
)
ASKED = "shard long, place int, id long, vector binary"
FOUND = "shard long, place int, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class TopK:
    """``together`` queries descend a tree at once; ``seed_shards`` is about how many shards the first wave reads."""

    k: int = 5
    scale: int = 256
    leaf: int = 128
    shard_rows: int = 8192
    shard_bytes: int = 8 << 20
    block_queries: int = 1 << 15
    block_bytes: int = 32 << 20
    together: int = 64
    seed_shards: int = 32


class BallTree:
    """``order`` puts rows of a leaf side by side. Node i has rows ``spans[i, :2]`` of it and children
    ``spans[i, 2:]`` (-1: a leaf)."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.order = np.arange(len(vectors))
        self.spans, self.centres, self.radii = [], [], []
        self._grow(vectors, 0, len(vectors), leaf)
        self.spans = np.array(self.spans, np.int32).reshape(-1, 4)
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def _grow(self, vectors: np.ndarray, start: int, end: int, leaf: int) -> int:
        rows = self.order[start:end]
        points = vectors[rows]
        centre = points.mean(axis=0)
        away = ((points - centre) ** 2).sum(axis=1)
        me = len(self.spans)
        self.spans.append([start, end, -1, -1])
        self.centres.append(centre)
        self.radii.append(np.sqrt(away.max()))
        if end - start > leaf:
            # along the line of two far points; the sort is stable, so equal vectors stay in order of their ids
            one = points[away.argmax()]
            other = points[((points - one) ** 2).sum(axis=1).argmax()]
            self.order[start:end] = rows[np.argsort(points @ (other - one), kind="stable")]
            middle = (start + end) // 2
            self.spans[me][2] = self._grow(vectors, start, middle, leaf)
            self.spans[me][3] = self._grow(vectors, middle, end, leaf)
        return me


def tree_rows(vectors: DataFrame, params: TopK) -> DataFrame:
    """One row for each shard's ball tree (``TREES``), from ``usable`` rows with ``asked``. Shards hold rows of one
    partition and one vector length; (shard, place in it) names a row, whatever its id."""

    def tree(shard: int, ids: np.ndarray, missing: np.ndarray, asked: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        by_id = np.lexsort((ids, missing))
        ids, missing, asked, v = ids[by_id], missing[by_id], asked[by_id], v[by_id]
        made = BallTree(v, params.leaf)
        at = made.order
        order_ids = np.where(missing, LAST, ids)[at]
        least = np.array([order_ids[a:b].min() for a, b, *_ in made.spans.tolist()], np.int64)
        values = [
            [shard],
            [[None if m else i for i, m in zip(ids[at].tolist(), missing[at].tolist())]],
            [asked[at].tolist()],
            [v.shape[1]],
            *[[a.tobytes()] for a in (v[at], made.spans, made.centres, made.radii, least)],
        ]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int32()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, types)], [n.split()[0] for n in TREES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        waiting: dict[int, list] = {}  # by vector length
        held = 0

        def flush(size: int) -> Iterator[pa.RecordBatch]:
            nonlocal shard, held
            parts = waiting.pop(size)
            ids, missing, asked, v = (np.concatenate(x) for x in zip(*parts))
            held -= v.nbytes
            for at in range(0, len(ids), params.shard_rows):
                cut = slice(at, at + params.shard_rows)
                yield tree(shard, ids[cut], missing[cut], asked[cut], v[cut])
                shard += 1

        for batch in batches:
            ids = batch.column("id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            for rows, v in matrices(batch, params.scale):
                waiting.setdefault(v.shape[1], []).append((ids[rows], missing[rows], asked[rows], v))
                held += v.nbytes
                if sum(len(p[0]) for p in waiting[v.shape[1]]) >= params.shard_rows:
                    yield from flush(v.shape[1])
                while held >= params.shard_bytes:
                    yield from flush(max(waiting, key=lambda s: sum(p[3].nbytes for p in waiting[s])))
        for size in list(waiting):
            yield from flush(size)

    return vectors.mapInArrow(run, TREES)


@dataclass
class Shard:
    """A tree as it comes out of the table; NULL ids sort last, so they are ``LAST`` and ``missing`` here."""

    number: int
    ids: np.ndarray
    missing: np.ndarray
    vectors: np.ndarray
    spans: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    least: np.ndarray
    norm: float


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names if n != "asked"}
            size = row["size"].as_py()
            ids = row["ids"].values
            array = lambda n, t: np.frombuffer(row[n].as_py() or bytearray(), t)
            vectors = array("vectors", np.float64).reshape(len(ids), size)
            radii = array("radii", np.float64)
            yield Shard(
                row["shard"].as_py(),
                ids.fill_null(LAST).to_numpy(zero_copy_only=False),
                ids.is_null().to_numpy(zero_copy_only=False),
                vectors,
                array("spans", np.int32).reshape(-1, 4),
                array("centres", np.float64).reshape(len(radii), size),
                radii,
                array("least", np.int64),
                np.sqrt((vectors**2).sum(axis=1).max()),
            )


class Queries:
    """A block of queries. Components that a query or a vector lacks count as zero."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        self.shard = np.array([r[0] for r in rows], np.int64)
        self.place = np.array([r[1] for r in rows], np.int64)
        self.ids = np.array([r[2] for r in rows], np.int64)
        self.vectors = [np.frombuffer(r[3], np.float64) for r in rows]
        self._laid: dict[int, tuple] = {}

    def laid_out(self, size: int, together: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """All vectors at length ``size``, and groups of neighbours."""
        if size not in self._laid:
            matrix = np.zeros((len(self.ids), size))
            for row, v in zip(matrix, self.vectors):
                row[: min(size, len(v))] = v[:size]
            tree = BallTree(matrix, together)
            groups = [tree.order[a:b] for a, b, left, _ in tree.spans.tolist() if left < 0]
            self._laid = {size: (matrix, groups)}  # of the last length only
        return self._laid[size]


class Best:
    """The k best of every query by (score, then id, NULL last), beside a floor that another wave found: an entry
    that comes after the floor is not wanted."""

    def __init__(self, queries: int, k: int, floors: dict[int, tuple[int, int]]):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), LAST)
        self.missing = np.ones((queries, k), bool)
        self.floor = np.full(queries, -np.inf)
        self.floor_id = np.full(queries, LAST)
        for q, (score, number) in floors.items():
            self.floor[q], self.floor_id[q] = score, number

    def bar(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a row must reach: score, and at that score at most this id."""
        own, own_id = self.score[rows, -1], self.id[rows, -1]
        floor, floor_id = self.floor[rows], self.floor_id[rows]
        ours = (own > floor) | ((own == floor) & (own_id < floor_id))
        return np.where(ours, own, floor), np.where(ours, own_id, floor_id)

    def reach(self, rows: np.ndarray, bound: np.ndarray, least: int) -> np.ndarray:
        score, number = self.bar(rows)
        return (bound > score) | ((bound == score) & (least <= number))

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        bar, number = self.bar(rows)
        wanted = (scores > bar[:, None]) | ((scores == bar[:, None]) & (ids[None, :] <= number[:, None]))
        better = wanted.any(axis=1)
        if not better.any():
            return
        rows, scores = rows[better], np.where(wanted, scores, -np.inf)[better]
        shape = scores.shape
        scores = np.concatenate([self.score[rows], scores], axis=1)
        ids = np.concatenate([self.id[rows], np.broadcast_to(ids, shape)], axis=1)
        missing = np.concatenate([self.missing[rows], np.broadcast_to(missing, shape)], axis=1)
        order = np.lexsort((ids, missing, -scores), axis=1)[:, : self.k]
        for mine, new in ((self.score, scores), (self.id, ids), (self.missing, missing)):
            mine[rows] = np.take_along_axis(new, order, axis=1)


def search(shard: Shard, queries: Queries, best: Best, together: int, first_leaf: bool) -> int:
    """Bring ``best`` up to date with a shard; returns how many inner products were computed."""
    matrix, groups = queries.laid_out(shard.vectors.shape[1], together)
    norms = np.sqrt((matrix**2).sum(axis=1))
    if len(norms) and norms.max() * shard.norm >= EXACT:
        raise ValueError("inner products of 2^53 or more are not offered")
    own = {}
    for q in np.flatnonzero(queries.shard == shard.number).tolist():
        own.setdefault(int(queries.place[q]), []).append(q)
    own_places = np.array(sorted(own), np.int64)
    done = 0

    def bounds(rows: np.ndarray, node: int) -> np.ndarray:
        reach = matrix[rows] @ shard.centres[node] + norms[rows] * shard.radii[node]
        return np.floor(reach + 1e-9 * norms[rows] * shard.norm + 1e-6)  # rounded up by more than its error

    for group in groups:
        bound = bounds(group, 0)
        heap = [(-bound.max(), 0, group, bound)]
        while heap:
            _, node, rows, bound = heapq.heappop(heap)
            ok = best.reach(rows, bound, shard.least[node])
            rows = rows[ok]
            if not len(rows):
                continue
            start, end, left, right = shard.spans[node].tolist()
            if left >= 0:
                for child in (left, right):
                    bound = bounds(rows, child)
                    ok = best.reach(rows, bound, shard.least[child])
                    if ok.any():
                        heapq.heappush(heap, (-bound[ok].max(), child, rows[ok], bound[ok]))
                continue
            scores = matrix[rows] @ shard.vectors[start:end].T
            done += scores.size
            for place in own_places[np.searchsorted(own_places, start) : np.searchsorted(own_places, end)].tolist():
                scores[np.isin(rows, own[place]), place - start] = -np.inf
            best.add(rows, scores, shard.ids[start:end], shard.missing[start:end])
            if first_leaf:
                break
    return done


def candidates(trees: DataFrame, queries, floors, params: TopK, first_leaf: bool) -> DataFrame:
    """Rows (``FOUND``) of the best ``k`` that each task knows for each query of a broadcast block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Queries(queries.value)
        best = Best(len(block.ids), params.k, floors.value)
        for shard in shards_of(batches):
            search(shard, block, best, params.together, first_leaf)
        at, rank = np.nonzero(best.score > -np.inf)
        for cut in range(0, len(at), 20_000):
            q, r = at[cut : cut + 20_000], rank[cut : cut + 20_000]
            columns = [
                pa.array(block.shard[q]),
                pa.array(block.place[q].astype(np.int32)),
                pa.array(block.ids[q]),
                pa.array(best.id[q, r], mask=best.missing[q, r]),
                pa.array(best.score[q, r].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [n.split()[0] for n in FOUND.split(", ")])

    return trees.mapInArrow(run, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("shard", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def asked_rows(trees: DataFrame) -> DataFrame:
    """The queries among the rows of ``trees``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked = np.flatnonzero(batch.column("asked")[i].values.to_numpy(zero_copy_only=False))
                size, raw = batch.column("size")[i].as_py(), batch.column("vectors")[i].as_py()
                columns = [
                    pa.array([batch.column("shard")[i].as_py()] * len(asked), pa.int64()),
                    pa.array(asked.astype(np.int32)),
                    batch.column("ids")[i].values.take(pa.array(asked)),
                    pa.array([raw[8 * size * a : 8 * size * (a + 1)] for a in asked.tolist()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [n.split()[0] for n in ASKED.split(", ")])

    return trees.mapInArrow(run, ASKED)


def top_k(df: DataFrame, id_col: str, vector_col: str, asked: Column, params: TopK = TopK()) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that is ``asked`` its ``k`` best inner products over
    ``floor(scale * x)`` with all other rows, ties to the smaller id, NULL ids last.

    Rows whose vector is NULL or holds a NULL or non-finite component take no part; an empty vector scores 0
    with all. Vectors of different lengths meet on the components both have. Repeated rows are rows of their own:
    they find each other, and each repeated query gets its rows. Fewer than ``k`` other rows: all of them. A row
    whose ``asked`` is NULL, or that has no id, is no query. An empty table gives no rows. Inner products of 2^53 or
    more are an error.
    """
    spark = df.sparkSession
    wanted = F.coalesce(asked & df[id_col].isNotNull(), F.lit(False))
    trees = small_batches(stored(tree_rows(usable(df, id_col, vector_col, asked=wanted), params), "balltrees"))
    queries = stored(asked_rows(trees), "queries")
    shards = trees.count()
    size = queries.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("vector")).alias("bytes")).first()
    blocks = max(-(-size["rows"] // params.block_queries), -(-(size["bytes"] or 0) // params.block_bytes))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("shard", "place"), F.lit(max(blocks, 1))))
    # Of the first wave: a start only, since the second reads all shards.
    seeds = trees.where(F.pmod(F.xxhash64("shard"), F.lit(max(1, shards // params.seed_shards))) == 0)
    folder = new_folder(spark, "topk")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for b in range(blocks):
        rows = [tuple(r) for r in queries.where(F.col("block") == b).drop("block").collect()]
        sent = [spark.sparkContext.broadcast(rows), spark.sparkContext.broadcast({})]
        number = {(r[0], r[1]): q for q, r in enumerate(rows)}
        kth = ranked(candidates(seeds, *sent, params, True), params.k).where(F.col("rank") == params.k).collect()
        floors = {number[r["shard"], r["place"]]: (r["score"], LAST if r["vec_id"] is None else r["vec_id"]) for r in kth}
        sent.append(spark.sparkContext.broadcast(floors))
        found = ranked(candidates(trees, sent[0], sent[2], params, False), params.k).select(*out.columns)
        found.write.parquet(f"{folder}/block={b}")
        for s in sent:
            s.unpersist()
    return spark.read.schema(out.schema).parquet(folder).select(*out.columns) if blocks else out
