"""Helpers the operators share: row keys, words, Arrow batches, connected components."""

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.session import pin, removed, shared_dir

# ASCII white space, the only characters that part words: space and tab to carriage return.
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# What a Python worker gets at once. Spark's own limits let one batch of long texts fill a small executor.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches are at most ``BATCH_ROWS`` rows and ``BATCH_BYTES``; smaller
    settings stay. A longer single row is a batch of its own."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(conf.get(key).removesuffix("b"))
        if now <= 0 or now > most:
            conf.set(key, str(most))
    return df


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words of a text as an array; none for NULL and for white space alone."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[ \\t-\\r]+")
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id``, ``h`` and ``text``, whatever else the table has.

    ``h`` is a hash of the text, so (id, h) tells rows apart that share an id, and NULL ids too. Rows equal
    in both are copies of one another and get equal results.
    """
    text = docs[text_col].cast("string")
    return small_batches(docs).select(
        docs[id_col].alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["h"] == right["h"])


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Python values row by row, without holding more than one batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            yield from zip(*(part.column(c).to_pylist() for c in columns))
    give_back()


def give_back() -> None:
    """Hand unused memory back to the system. A worker process outlives its task and may stay idle beside
    others for a long time, and an executor counts them all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def compressed(text: Column) -> Column:
    """A text as a zstandard frame, for a shuffle of whole texts; NULL as the empty text. A column function
    and not mapInArrow: Spark then sees it when two joins need the same shuffle."""

    def frames(texts: pd.Series) -> pd.Series:
        compress = zstandard.ZstdCompressor(level=1).compress
        return texts.map(lambda t: compress((t or "").encode("utf-8", "surrogatepass")))

    return F.pandas_udf(frames, BinaryType())(text)


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` of ``keyed`` with the text compressed, in ``packed``."""
    return rows.select("id", "h", compressed(F.col("text")).alias("packed"))


def unpacked(frame: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame)


class Rows:
    """Collects output rows and hands them on as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = 4000, max_bytes: int = 4 << 20):
        self.schema, self.limit, self.max_bytes = schema, limit, max_bytes
        self._clear()

    def _clear(self) -> None:
        self.columns, self.count, self.bytes = [[] for _ in self.schema], 0, 0

    def add(self, *values, size: int = 0) -> Iterator[pa.RecordBatch]:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.count += 1
        self.bytes += size
        if self.count >= self.limit or self.bytes >= self.max_bytes:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.count:
            arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
            self._clear()


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): one row (node, root) per node with a link, root being the
    smallest node of its component.

    Large-star and small-star rounds; each joins the links to their nodes' smallest neighbour, so a hub is
    one aggregated value and its links stay spread. Every round is checkpointed, and nothing but a count
    and a checksum reaches the driver.
    """
    both = links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    edges, before = pin(both), None
    while True:
        around = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = around.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        # large star: neighbours above a node move to its smallest neighbour
        large = around.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.filter("u <> v").distinct()
        # small star: what lies below a node, and the node, move to the smallest below it
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.union(low.select("v", F.col("m").alias("u"))).filter("u <> v").distinct()
        edges = pin(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("u").distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        roots.select(F.col("u").alias("node"), F.col("u").alias("root"))
    )


def new_folder(spark: SparkSession, name: str) -> str:
    """A name in the shared folder that nothing else has."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"


BROADCAST_ROWS = 500_000  # of two or three numbers each


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for a join, to be broadcast where it has no more than ``rows`` rows, and shuffled beyond that."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside, but for what it is told to ``keep``, is deleted at the end; shuffles that
    nothing uses any more go too. Whatever leaves the block must not read from it."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            removed(spark, path)
        tidy(spark)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner see which shuffles and checkpoints have no user left. It learns so from the collection
    of garbage, which a driver with little to do may put off for long."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as Parquet to a new folder in the shared folder, and read back: several passes get the
    same rows, also after executors are lost, and take less room than a checkpoint. ``keep``: beyond the innermost
    ``scratch``."""
    path = new_folder(df.sparkSession, name)
    if len(_OPEN) > keep:
        _OPEN[-1 - keep].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
