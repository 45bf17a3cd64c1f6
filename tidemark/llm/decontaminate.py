"""Benchmark decontamination by q-gram lemma filtering.

Every window of ``length`` normalised characters of a benchmark text is a pattern. A place in a document
that is within ``k`` edits of a pattern of ``m`` characters shares at least m - q + 1 - k q of its q-grams,
all on diagonals (document position less benchmark position) at most ``k`` apart. So shared q-grams are
counted per benchmark text in bands of diagonals that overlap by more than ``k``; in a band that meets the
bound, the patterns that have enough of its q-grams are kept, and a banded alignment with that region
decides. No region within the edit budget is missed, whatever the length of the document or where in the
benchmark text the passage begins.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Rows, give_back, rows_of, small_batches

BLOCK_CHARS = 4_000_000  # benchmark characters that go to the tasks at once; more are taken in turns
FILTER_BITS = 22
AT_ONCE = 1024  # patterns aligned at once
PAIRS_AT_ONCE = 100_000  # of a place in a document and one in a benchmark text that have a q-gram in common
SPANS = 10_000  # of one benchmark text, before they are merged
BASE = 0x9E3779B97F4A7C15

FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]
)


@dataclass(frozen=True)
class Leaks:
    """``q``, pattern ``length`` and ``stride`` in normalised characters; ``rate``: edits allowed per
    character. Benchmark texts of fewer than ``least`` normalised characters are looked for as a whole,
    unchanged and between word bounds."""

    q: int = 12
    length: int = 80
    stride: int = 1
    rate: float = 0.06
    least: int = 40

    def edits(self, m: int) -> int:
        """The edit budget of a pattern; never so large that the lemma's bound is below one q-gram."""
        return max(0, min(int(m * self.rate), (m - self.q) // self.q))


def letters() -> np.ndarray:
    """For every code point its lower case if it is a letter or digit, else 0."""
    module = sys.modules.setdefault("_tidemark_letters", types.ModuleType("_tidemark_letters"))
    if not hasattr(module, "table"):
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalnum():
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        module.table = table
    return module.table


def normalise(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and digits, each run of other characters as one space; and their places."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    mapped = letters()[points]
    solid = mapped != 0
    if not solid.any():
        return mapped[:0], np.zeros(0, np.int64)
    gap = ~solid
    gap[1:] &= solid[:-1]  # the first character of each run
    last = len(solid) - 1 - int(solid[::-1].argmax())
    gap[0] = False
    gap[last + 1 :] = False
    place = np.flatnonzero(solid | gap)
    out = mapped[place]
    out[out == 0] = 32
    return out, place


def string(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, edits) in order; those that touch are one, with the most edits of them."""
    out: list[tuple[int, int, int]] = []
    for start, end, edits in sorted(spans):
        if out and start <= out[-1][1]:
            first, last, most = out[-1]
            out[-1] = (first, max(last, end), max(most, edits))
        else:
            out.append((start, end, edits))
    return out


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q-gram, put together from those of half the length."""
    n = len(codes) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    done, out, power, size = 0, None, codes.astype(np.uint64), 1
    rest = q
    while rest:
        if rest & 1:
            part = power[done : done + n]
            out = part.copy() if out is None else out * np.uint64(pow(BASE, size, 1 << 64)) + part
            done += size
        rest >>= 1
        if rest:
            power = power[: len(power) - size] * np.uint64(pow(BASE, size, 1 << 64)) + power[size:]
            size *= 2
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


class Patterns:
    """A block of benchmark texts and the places of their q-grams. A pattern is a window of a text."""

    def __init__(self, items: list[tuple[int | None, str | None]], params: Leaks):
        self.params, self.items, self.codes = params, [], []
        self.short: dict[str, list[int | None]] = {}
        for item, text in items:
            codes, _ = normalise(text)
            if len(codes) >= max(params.least, params.q):
                self.items.append(item)
                self.codes.append(codes)
            elif len(codes):
                self.short.setdefault(string(codes), []).append(item)
        self.short_words = sorted({s.count(" ") + 1 for s in self.short})
        self.size = np.array([min(params.length, len(c)) for c in self.codes], np.int64)
        self.budget = np.array([params.edits(int(m)) for m in self.size], np.int64)
        self.need = self.size - params.q + 1 - self.budget * params.q
        grams = [gram_hashes(c, params.q) for c in self.codes]
        sizes = [len(g) for g in grams]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.item = np.repeat(np.arange(len(grams)), sizes)[order]
        self.offset = np.concatenate([np.arange(n) for n in sizes])[order] if grams else np.zeros(0, np.int64)
        self.hashes, self.first, self.times = np.unique(hashes[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.hashes >> np.uint64(64 - FILTER_BITS)] = True
        self.width = int(self.budget.max(initial=0)) + 1
        self.longest = max(map(len, self.codes), default=0)

    def starts(self, i: int) -> np.ndarray:
        """Where the patterns of text ``i`` start; the last one ends with the text."""
        last = len(self.codes[i]) - int(self.size[i])
        return np.unique(np.append(np.arange(0, last + 1, self.params.stride), last))

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, start, end, edits) of the regions of ``text`` within the budget of a pattern; regions of
        one item that touch are one, with the edits of its worst pattern."""
        codes, place = normalise(text)
        found = self.find_short(codes)
        hashes = gram_hashes(codes, self.params.q)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)]) if len(self.hashes) else hashes[:0]
        if len(at):
            self.find_long(codes, hashes, at, found)
        out = [(item, *span) for item, spans in found.items() for span in merged(spans)]
        return [(item, int(place[start]), int(place[end - 1]) + 1, edits) for item, start, end, edits in out]

    def find_short(self, codes: np.ndarray) -> dict:
        """Places of the texts under ``least`` characters, unchanged and between word bounds."""
        found: dict = {}
        if self.short:
            text, gaps = string(codes), np.flatnonzero(codes == 32)
            begins, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(codes)]
            for n in self.short_words:
                for a, b in zip(begins, ends[n - 1 :]):
                    for item in self.short.get(text[a:b], ()):
                        found.setdefault(item, []).append((a, b, 0))
        return found

    def find_long(self, codes: np.ndarray, hashes: np.ndarray, at: np.ndarray, found: dict) -> None:
        gram = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[gram] == hashes[at]
        at, gram = at[same], gram[same]
        # In stretches that share what a pattern can take up, so each of its places lies whole in one of them; a
        # text that repeats a benchmark text's q-grams would else meet each with all its places at once.
        upto = np.cumsum(self.times[gram])
        reach = self.params.length + 2 * self.width + self.params.q
        start = 0
        while start < len(at):
            end = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PAIRS_AT_ONCE, "right"))
            end = max(end, int(np.searchsorted(at, at[start] + 2 * reach)))
            self.find_in_stretch(codes, at[start:end], gram[start:end], found)
            if end >= len(at):
                break
            start = int(np.searchsorted(at, at[end] - reach))

    def find_in_stretch(self, codes: np.ndarray, at: np.ndarray, gram: np.ndarray, found: dict) -> None:
        times = self.times[gram]
        at = np.repeat(at, times)
        entry = np.repeat(self.first[gram], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, offset = self.item[entry], self.offset[entry]
        diagonal = at - offset
        band = (diagonal + self.longest) // self.width  # not below 0
        bands = len(codes) // self.width + self.longest // self.width + 3
        # every diagonal counts for the band that starts at or before it and for the one before
        key = np.concatenate([item * bands + band + 1, item * bands + band])
        order = np.argsort(key, kind="stable")
        keys, first, counts = np.unique(key[order], return_index=True, return_counts=True)
        hit = counts >= self.need[keys // bands]
        for k, a, n in zip(keys[hit].tolist(), first[hit].tolist(), counts[hit].tolist()):
            i, b = divmod(k, bands)
            low = (b - 1) * self.width - self.longest
            own = order[a : a + n] % len(at)
            for start, end, edits in merged(self.regions(codes, i, offset[own], diagonal[own], low)):
                found.setdefault(self.items[i], []).append((start, end, edits))
            if len(found.get(self.items[i], ())) > SPANS:
                found[self.items[i]] = merged(found[self.items[i]])

    def regions(self, codes: np.ndarray, i: int, offsets: np.ndarray, diagonals: np.ndarray, low: int) -> list[tuple[int, int, int]]:
        """(start, end, edits) for each pattern of text ``i`` that has enough of the shared q-grams of the
        band from ``low`` and is within its budget there."""
        size, starts, offsets = int(self.size[i]), self.starts(i), np.sort(offsets)
        shared = np.searchsorted(offsets, starts + size - self.params.q, "right") - np.searchsorted(offsets, starts)
        starts = starts[shared >= self.need[i]]
        out = []
        for d in np.unique(diagonals).tolist() if len(starts) else ():
            equal = self.equal(codes, i, starts, d)
            out += [(a + d, a + d + size, 0) for a in starts[equal].tolist()]  # none is better
            starts = starts[~equal]
        for at in range(0, len(starts), AT_ONCE):
            out += self.align(codes, i, starts[at : at + AT_ONCE], low, low + 2 * self.width - 1)
        return out

    def equal(self, codes: np.ndarray, i: int, starts: np.ndarray, diagonal: int) -> np.ndarray:
        """Which patterns of text ``i`` occur unchanged on the diagonal."""
        whole, size = self.codes[i], int(self.size[i])
        a, b = max(0, -diagonal), min(len(whole), len(codes) - diagonal)
        sums = np.zeros(len(whole) + 1, np.int64)
        if a < b:
            sums[a + 1 : b + 1] = np.cumsum(whole[a:b] == codes[a + diagonal : b + diagonal])
            sums[b + 1 :] = sums[b]
        return sums[starts + size] - sums[starts] == size

    def align(self, codes: np.ndarray, i: int, starts: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
        """Best alignments of patterns of text ``i`` on diagonals ``low`` to ``high``, and ``budget`` beyond
        them, with free ends in the document: (start, end, edits) of those within the budget."""
        size, budget = int(self.size[i]), int(self.budget[i])
        low, high = low - budget, high + budget
        n, far = high - low + 1, size + len(codes) + 1
        steps = np.arange(n)
        begin = low + steps + starts[:, None]
        cost = np.zeros(begin.shape, np.int64)  # row 0: any diagonal may start, at its own place in the document
        cost[(begin < 0) | (begin > len(codes))] = far
        origin, last = begin, np.full((len(starts), 1), far)
        for j in range(size):
            x = begin + j  # document position before this row's step, by diagonal
            inside = (x >= 0) & (x < len(codes))
            other = codes[np.where(inside, x, 0)] != self.codes[i][starts + j][:, None]
            match = np.where(inside, cost + other, far)
            skip = np.hstack([cost[:, 1:] + 1, last])  # a pattern character without one of the document
            took = np.hstack([origin[:, 1:], last])
            new = np.where(skip < match, skip, match)
            source = np.where(skip < match, took, origin)
            new[(x + 1 < 0) | (x + 1 > len(codes))] = far
            # a document character without one of the pattern: one diagonal on, in the same row
            best = np.minimum.accumulate(new - steps, axis=1)
            winner = np.maximum.accumulate(np.where(new - steps == best, steps, 0), axis=1)
            cost, origin = best + steps, np.take_along_axis(source, winner, 1)
        end = cost.argmin(axis=1)
        rows = np.flatnonzero(cost.min(axis=1) <= budget)
        return [(int(origin[r, end[r]]), int(begin[r, end[r]]) + size, int(cost[r, end[r]])) for r in rows]


def blocks(benchmark: DataFrame, params: Leaks) -> Iterator:
    """Broadcast patterns of the whole benchmark, in blocks of bounded size."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = -(-chars // BLOCK_CHARS)
    for b in range(count):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).collect()
        patterns = Patterns([tuple(r) for r in block], params)
        if patterns.codes or patterns.short:
            yield benchmark.sparkSession.sparkContext.broadcast(patterns)


def leaks(docs: DataFrame, benchmark: DataFrame, params: Leaks = Leaks()) -> DataFrame:
    """A row per region of a document that holds a passage of a benchmark text: doc_id, item_id, start and
    end (character positions in the text), edits.

    NULL and empty texts have no regions, on either side. A passage that several items share is reported
    for each. Repeated rows are reported each. Without benchmark texts or documents the result is empty.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, start long, end long, edits long"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in blocks(benchmark, params):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found, patterns = Rows(FOUND), shared.value
            for doc, text in rows_of(batches, "doc_id", "text"):
                for region in patterns.find(text):
                    yield from found.add(doc, *region)
            yield from found.rest()

        out = out.union(rows.mapInArrow(run, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, params: Leaks = Leaks()) -> DataFrame:
    """The documents, with their columns, in which no passage of the benchmark is found."""
    for shared in blocks(benchmark, params):
        whole = small_batches(docs).select(F.struct("*").alias("doc"))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = shared.value
            for batch in batches:
                texts = batch.column("doc").field("text").to_pylist()
                clean = pa.array([not patterns.find(t) for t in texts], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("doc")], ["doc"]).filter(clean)
            give_back()

        docs = whole.mapInArrow(run, whole.schema).select("doc.*")
    return docs
