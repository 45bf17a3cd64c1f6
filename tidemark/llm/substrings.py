"""Substring dedup with suffix automata of reference shards.

A window of ``window`` words counts as repeated when its words also start anywhere else. Comparing every
document with an automaton of every shard of the corpus would grow with the square of the corpus, so
documents and shards are routed to each other:

* Every window elects its anchor, the run of ``anchor`` words with the smallest hash. Equal windows elect
  equal anchors. A segment is the words of all successive windows with one anchor; each window is in
  exactly one segment.
* Segments are counted by (anchor, content). An anchor that occurs once has no repeated window. Where all
  segments of an anchor are equal, all their windows are repeated.
* For the rest, the different segments of an anchor, each with its count, go to one reference shard. The
  shard's suffix automaton is built over them, and the segments stream through it: at each word the state
  of the last ``window`` words tells how often they occur.
* An anchor with more than ``SHARD_SEGMENTS`` different segments is too large for one shard. Its segments
  are cut into their windows, and each window is a shard of its own, counted with a combining aggregate.

The marks found for a content are joined back to all its occurrences. All counts cover the whole table, and
the largest thing a task holds is one shard or one document.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.frames import (
    Rows,
    compressed,
    give_back,
    keyed,
    packed,
    rows_of,
    same_row,
    scratch,
    small_batches,
    stored,
    tidy,
    unpacked,
)

SHARD_SEGMENTS = 1024  # different segments of one anchor in a shard
SHARD_WORDS = 20_000  # small anchors share an automaton up to so many words
WORD = re.compile("[^ \t-\r]+")

ANCHORS = "anchor long, content long, id long, h long, start int, windows int"
SEGMENTS = pa.schema(
    [("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("kinds", pa.int64()), ("segment", pa.string())]
)
MARKS = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("mask", pa.int32())])


@dataclass(frozen=True)
class SubstringDedup:
    """``window`` less ``anchor`` must be under 31: a segment's marks are the bits of an int."""

    window: int = 35
    anchor: int = 8

    def __post_init__(self) -> None:
        if not 0 < self.anchor <= self.window < self.anchor + 31:
            raise ValueError("anchor must be at most window and at least window - 30")


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def segments_of(words: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, content hash, first word and number of windows of each segment."""
    n = len(words)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    runs = np.zeros(n - anchor + 1, np.uint64)
    for k in range(anchor):  # a polynomial over the words, then mixed so that its order is random
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - anchor + 1 + k]
    runs ^= runs >> np.uint64(31)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    runs ^= runs >> np.uint64(29)
    views = np.lib.stride_tricks.sliding_window_view(runs, window - anchor + 1)
    elected = np.arange(len(views)) + views.argmin(axis=1)
    start = np.flatnonzero(np.concatenate(([True], elected[1:] != elected[:-1])))
    windows = np.diff(np.append(start, len(views)))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))[start].tolist()
    last = ends[start + windows + window - 2].tolist()
    content = np.fromiter((xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(first, last)), np.uint64, len(start))
    return runs[elected[start]].view(np.int64), content.view(np.int64), start.astype(np.int32), windows.astype(np.int32)


def anchors(rows: DataFrame, params: SubstringDedup) -> DataFrame:
    window, anchor = params.window, params.anchor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, which = [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                words = word_list(text)
                if len(words) >= window:
                    parts.append(segments_of(words, window, anchor))
                    which.append(np.full(len(parts[-1][0]), at))
            if not parts:
                continue
            anchor_, content, start, windows = (np.concatenate(c) for c in zip(*parts))
            row = pa.array(np.concatenate(which))
            columns = [anchor_, content, batch.column("id").take(row), batch.column("h").take(row), start, windows]
            names = ["anchor", "content", "id", "h", "start", "windows"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)
        give_back()

    return rows.mapInArrow(run, ANCHORS)


class SuffixAutomaton:
    """Suffix automaton of several word sequences; every state knows how often its words occur."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, edges: dict, link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _exact(self, p: int, symbol: object) -> int:
        """The state reached from ``p`` whose longest word is one longer than that of ``p``."""
        q, length = self.next[p][symbol], self.length[p] + 1
        if self.length[q] == length:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], length)
        self.link[q] = clone
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: Sequence, times: int) -> None:
        last, edges, link = 0, self.next, self.link
        for symbol in sequence:
            if symbol in edges[last]:
                last = self._exact(last, symbol)
            else:
                p, last = last, self._state({}, 0, self.length[last] + 1)
                while p != -1 and symbol not in edges[p]:
                    edges[p][symbol] = last
                    p = link[p]
                if p != -1:
                    link[last] = self._exact(p, symbol)
            self.count[last] += times

    def close(self) -> None:
        """Hand the counts on to the suffixes; call it after the last ``add``."""
        for state in np.argsort(np.array(self.length))[:0:-1].tolist():
            self.count[self.link[state]] += self.count[state]

    def frequent(self, sequence: Iterable, window: int) -> Iterator[bool]:
        """For every symbol: do the last ``window`` of them occur at least twice? Matching statistics, held
        at the state that stands for the last ``window`` symbols."""
        state = matched = 0
        edges, link, length = self.next, self.link, self.length
        for symbol in sequence:
            while state and symbol not in edges[state]:
                state = link[state]
                matched = length[state]
            if symbol in edges[state]:
                state = edges[state][symbol]
                matched += 1
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            yield matched >= window and self.count[state] > 1


def shard_marks(segments: list[tuple[int, int, int, str]], window: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, content, mask) of the segments with repeated windows; ``segments``: anchor, content, count, text."""
    automaton, number = SuffixAutomaton(), {}
    sequences = []
    for _, _, times, text in segments:
        sequence = [number.setdefault(w, len(number)) for w in word_list(text)]
        automaton.add(sequence, times)
        sequences.append(sequence)
    automaton.close()
    for (anchor, content, _, _), sequence in zip(segments, sequences):
        mask = 0
        for at, again in enumerate(automaton.frequent(sequence, window)):
            if again:
                mask |= 1 << (at - window + 1)
        if mask:
            yield anchor, content, mask


def _marks_by_shard(segments: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, size, before = Rows(MARKS), [], 0, (None, None)
        for anchor, content, times, text in rows_of(batches, "anchor", "content", "n", "segment"):
            if (anchor, content) == before:  # fetched from a repeated row as well
                continue
            if anchor != before[0] and size >= SHARD_WORDS:
                for mark in shard_marks(shard, window):
                    yield from out.add(*mark)
                shard, size = [], 0
            before = (anchor, content)
            shard.append((anchor, content, times, text))
            size += text.count(" ") + 1
        for mark in shard_marks(shard, window):
            yield from out.add(*mark)
        yield from out.rest()

    laid_out = segments.repartition(F.col("anchor")).sortWithinPartitions("anchor", "content")
    return laid_out.mapInArrow(run, "anchor long, content long, mask int")


def _marks_by_window(segments: DataFrame, window: int) -> DataFrame:
    once = segments.dropDuplicates(["anchor", "content"])
    cut = once.select("anchor", "content", "n", F.split("segment", " ").alias("w"))
    places = F.sequence(F.lit(0), F.size("w") - window)
    cut = cut.select("anchor", "content", "n", "w", F.explode(places).alias("at"))
    cut = cut.withColumn("own", F.md5(F.array_join(F.slice("w", F.col("at") + 1, F.lit(window)), " "))).drop("w")
    again = cut.groupBy("anchor", "own").agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    marked = cut.join(again, ["anchor", "own"]).withColumn("bit", F.expr("shiftleft(1, at)"))
    return marked.groupBy("anchor", "content").agg(F.bit_or("bit").alias("mask"))


def _fetch(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The text of the ``wanted`` segments (anchor, content, n, kinds, id, h, start, windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(SEGMENTS)
        for frame, cuts in rows_of(batches, "packed", "cuts"):
            words = WORD.findall(text_of(frame))
            for c in cuts:
                segment = " ".join(words[c["start"] : c["start"] + c["windows"] + window - 1])
                yield from out.add(c["anchor"], c["content"], c["n"], c["kinds"], segment, size=len(segment))
        yield from out.rest()

    cut = F.struct("anchor", "content", "n", "kinds", "start", "windows")
    cuts = wanted.groupBy("id", "h").agg(F.collect_list(cut).alias("cuts"))
    # a repeated row has one text; its copies are one before they move
    texts = packed(rows).groupBy("id", "h").agg(F.first("packed").alias("packed"))
    found = texts.join(cuts, same_row(texts, cuts)).select("packed", "cuts")
    return found.mapInArrow(run, "anchor long, content long, n long, kinds long, segment string")


def repeated(docs: DataFrame, params: SubstringDedup = SubstringDedup()) -> DataFrame:
    """(id, h, marks): for every row with repeated windows, ``marks`` is an array of (start, mask); bit k
    of a mask says that the window at word start + k is repeated. For id and h see ``frames.keyed``;
    repeated rows are repeats of one another and share their marks."""
    with scratch(docs.sparkSession):
        return stored(_marks(keyed(docs).withColumn("id", F.col("id").cast("long")), params), "marks", keep=True)


def _marks(rows: DataFrame, params: SubstringDedup) -> DataFrame:
    window, spark = params.window, rows.sparkSession
    found = stored(anchors(rows, params), "anchors")
    place = F.struct("id", "h", "start", "windows")
    contents = found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    contents = stored(contents, "contents")
    tidy(spark)
    kinds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("all"))
    shared = stored(contents.join(kinds.filter(F.col("all") > 1), "anchor"), "shared")
    alike = shared.filter("kinds = 1").select(
        "anchor", "content", F.expr("int(shiftleft(1L, place.windows) - 1)").alias("mask")
    )
    wanted = shared.filter("kinds > 1").select("anchor", "content", "n", "kinds", "place.*")
    segments = stored(_fetch(rows, wanted, window), "segments")
    tidy(spark)
    marks = alike.union(_marks_by_shard(segments.filter(F.col("kinds") <= SHARD_SEGMENTS), window)).union(
        _marks_by_window(segments.filter(F.col("kinds") > SHARD_SEGMENTS), window)
    )
    marked = found.join(marks, ["anchor", "content"])
    return marked.groupBy("id", "h").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))


def removed_words(marks: Iterable[dict], n_words: int, window: int) -> np.ndarray:
    """Which words a repeated window covers."""
    edge = np.zeros(n_words + 1, np.int64)
    for mark in marks:
        start, mask = mark["start"], mark["mask"]
        while mask:
            low = (mask & -mask).bit_length() - 1
            edge[start + low] += 1
            edge[start + low + window] -= 1
            mask &= mask - 1
    return np.cumsum(edge[:-1]) > 0


def text_of(frame: bytes) -> str:
    return unpacked(frame).decode("utf-8", "surrogatepass")


def _with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``id``, ``packed`` text (and whether there is none), ``rest`` (the other columns) and the marks of
    every row."""
    text = F.col("text").cast("string")
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    hashed = F.xxhash64(F.coalesce(text, F.lit("")))
    whole = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("id"),
        hashed.alias("h"),
        text.isNull().alias("missing"),
        compressed(text).alias("packed"),
        rest.alias("rest"),
    )
    return whole.join(marks, same_row(whole, marks), "left").select(whole["id"], "missing", "packed", "rest", "marks")


DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]
)


def kept_words(docs: DataFrame, params: SubstringDedup = SubstringDedup()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed and ``kept``, the kept words joined by spaces.

    NULL and empty texts have no words. Windows are judged on the input. Repeated rows remove each other
    where they have a window. An empty table gives an empty result.
    """
    window = params.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(DIGEST)
        for doc, frame, marks in rows_of(batches, "id", "packed", "marks"):
            words = WORD.findall(text_of(frame))
            gone = removed_words(marks or (), len(words), window)
            kept = " ".join(w for w, g in zip(words, gone.tolist()) if not g) if marks else " ".join(words)
            yield from out.add(doc, len(words), int(gone.sum()), kept, size=len(kept))
        yield from out.rest()

    joined = _with_marks(docs.select("doc_id", "text"), repeated(docs, params))
    return joined.select("id", "packed", "marks").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string"
    )


def cut_out(text: str, gone: np.ndarray) -> str:
    """``text`` without the words that are ``gone`` and the white space after them."""
    keep, at = [], 0
    for match, lost in zip(WORD.finditer(text), gone.tolist()):
        if lost:
            keep.append(text[at : match.start()])
            at = match.end()
            while at < len(text) and text[at] in " \t\n\x0b\f\r":
                at += 1
    keep.append(text[at:])
    return "".join(keep)


def without_repeats(docs: DataFrame, params: SubstringDedup = SubstringDedup()) -> DataFrame:
    """The documents with their columns; repeated spans are cut out of ``text``, whose other characters,
    line breaks included, stay. A NULL text stays NULL; a text may become empty."""
    window = params.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("missing", "packed", "marks"))
            for missing, frame, marks in zip(*columns):
                text = None if missing else text_of(frame)
                if marks:
                    text = cut_out(text, removed_words(marks, len(word_list(text)), window))
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], ["rest", "text"])
        give_back()

    joined = _with_marks(docs, repeated(docs, params)).select("missing", "packed", "rest", "marks")
    out = joined.mapInArrow(run, StructType([joined.schema["rest"], StructField("text", StringType())]))
    kind = docs.schema["text"].dataType
    columns = [F.col("text").cast(kind).alias("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns]
    return out.select(*columns)
