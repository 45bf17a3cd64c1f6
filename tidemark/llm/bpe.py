"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over words cuts every text into chunks, so equal passages of different documents give equal
chunks wherever they stand. Chunks that occur more than once are encoded once, from one of their places,
and their ids are joined to the others; a chunk that occurs once is encoded where it is. A document's ids
are those of its chunks in order. At each join the words on both sides are encoded as one; where that does
not agree with the chunks, the window grows until both its ends agree again, and replaces what they had.
"""

from __future__ import annotations

import os
import re
import sys
import types
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Rows, keyed, packed, rows_of, same_row, small_side, stored, unpacked

REACH = 32  # bytes under the rolling hash; a power of two
CUT_ONE_IN = 192  # mean words of a chunk
MULTIPLIER, MIX = 0x9E3779B1, 0x85EBCA77  # fixed odd numbers
MOST_WORDS = 1024  # a chunk is cut after so many words in any case
CACHED_WORDS = 320_000  # encodings a worker keeps; beyond that it forgets the half it met last

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
EDGE = re.compile(rb"[^ \t-\r]+")

PLACES = pa.schema(
    [("chunk", pa.binary()), ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]
)
CODES = pa.schema([("chunk", pa.binary()), ("ids", pa.binary())])


def process_cache() -> dict:
    """A dict that lives as long as the worker process, which serves many tasks."""
    module = sys.modules.setdefault("_tidemark_process_cache", types.ModuleType("_tidemark_process_cache"))
    return module.__dict__


@dataclass(frozen=True)
class Codec:
    """``path`` names a file of the tokenizers library that all executors can read."""

    path: str

    def load(self) -> Encoder:
        cache = process_cache()
        if self.path not in cache:
            cache[self.path] = Encoder(self.path)
        return cache[self.path]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.type = np.dtype(self.code)
        self.tokens = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.words: dict[bytes, bytes] = {}
        # a tokenizer that drops white space encodes words one by one; others need the whole chunk
        whole, apart = self.encode([b"a bc\n1"])[0], self.encode([b"a", b"bc", b"1", b"\t1 "])
        self.apart = whole == b"".join(apart[:3]) and apart[3] == apart[2]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        plain = [t.decode("utf-8", "surrogatepass") for t in texts]
        found = self.tokenizer.encode_batch_fast(plain, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def chunks(self, texts: list[bytes]) -> list[bytes]:
        if not self.apart:
            return self.encode(texts)
        split = [t.split() for t in texts]
        known = self.words
        if len(known) > CACHED_WORDS:  # frequent words were met early
            for word in list(known)[CACHED_WORDS // 2 :]:
                del known[word]
        if new := list({w for words in split for w in words if w not in known}):
            known.update(zip(new, self.encode(new)))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, self.type).tolist()
        if self.tokenizer.decoder is None:  # then the library puts a space between the tokens
            return " ".join(map(self.tokens.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)


def chunk_ends(text: bytes) -> list[int]:
    """Byte ends of the chunks of ``text``; each but the last ends before a word. None for an empty text."""
    if not text:
        return []
    raw = np.frombuffer(text, np.uint8)
    space = SPACE[raw]
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    candidates = starts[starts >= REACH]
    if not len(candidates):
        return [len(text)]
    rolled, size = raw.astype(np.uint32) + np.uint32(1), 1
    while size < REACH:  # a hash of the last REACH bytes, put together from those of half the length
        rolled = rolled[:-size] * np.uint32(pow(MULTIPLIER, size, 1 << 32)) + rolled[size:]
        size *= 2
    picked = rolled[candidates - REACH]
    picked ^= picked >> np.uint32(15)
    picked *= np.uint32(MIX)
    cuts = candidates[picked >> np.uint32(16) < (1 << 16) // CUT_ONE_IN]
    place = np.searchsorted(starts, cuts)
    bounds, more = [0 if space[0] else -1, *place.tolist(), len(starts)], []  # a first word at 0 is in no place
    if np.diff(bounds).max() > MOST_WORDS:
        for a, b in zip(bounds, bounds[1:]):
            more += [b, *range(a + MOST_WORDS, b, MOST_WORDS)]
        cuts = starts[sorted(set(more) - {len(starts)})]
    return [*cuts.tolist(), len(text)]


def chunk_list(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    ends = chunk_ends(raw)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _edge(chunk: bytes, words: int, last: bool) -> bytes:
    """The first or last ``words`` words of a chunk, with the white space around them."""
    found = list(EDGE.finditer(chunk)) if words > 1 or not last else []
    if last and words == 1:
        end = len(chunk.rstrip(b" \t\n\x0b\f\r"))
        start = max(chunk.rfind(c, 0, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\f", b"\r")) + 1
        return chunk[start:]
    if len(found) <= words:
        return chunk
    return chunk[found[-words].start() :] if last else chunk[: found[words - 1].end()]


def _first_word(chunk: bytes) -> bytes:
    match = EDGE.search(chunk)
    return chunk[: match.end()] if match else chunk


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def join_chunks(chunks: list[bytes], codes: list[bytes], encoder: Encoder) -> bytes:
    """The ids of the whole text from those of its chunks, with every join checked."""
    if len(chunks) < 2:
        return b"".join(codes)
    tails = [_edge(c, 1, True) for c in chunks[:-1]]
    heads = [_first_word(c) for c in chunks[1:]]
    whole = encoder.encode([a + b for a, b in zip(tails, heads)])
    left, right = encoder.chunks(tails), encoder.chunks(heads)
    if all(w == a + b for w, a, b in zip(whole, left, right)):
        return b"".join(codes)
    text, ids = chunks[0], np.frombuffer(codes[0], encoder.type)
    for chunk, code in zip(chunks[1:], codes[1:]):
        code, words = np.frombuffer(code, encoder.type), 1
        while True:
            tail, head = _edge(text, words, True), _edge(chunk, words, False)
            one, a, b = (np.frombuffer(x, encoder.type) for x in encoder.encode([tail + head, tail, head]))
            # a and b lack what stands around them, so their outer tokens may differ from the chunks'; the
            # window may start after x tokens of a, and stop before token y of b, where all three agree
            least_x = 0 if len(tail) == len(text) else len(a) - _common(a[::-1], ids[::-1]) + 1
            most_y = len(b) if len(head) == len(chunk) else _common(b, code) - 1
            x, y = _common(one, a), len(b) - _common(one[::-1], b[::-1])
            stop = len(one) - (len(b) - y)
            if len(tail) == len(text) and len(head) == len(chunk):
                x, y, stop = 0, len(b), len(one)
                break
            if least_x <= x and y <= most_y and x <= stop:
                break
            words *= 2
        ids = np.concatenate([ids[: len(ids) - (len(a) - x)], one[x:stop], code[y:]])
        text += chunk
    return ids.tobytes()


def encoded(docs: DataFrame, codec: Codec) -> DataFrame:
    """(id, ids, decoded): of every row the ids, as little-endian 32-bit integers, and their decoding.

    NULL texts count as empty and give no ids. Repeated rows are encoded alike and stay repeated. Special
    tokens' strings in a text become their ids, as in the library. An empty table gives an empty result.
    """
    rows = keyed(docs).withColumn("id", F.col("id").cast("long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(PLACES)
        for doc, h, text in rows_of(batches, "id", "h", "text"):
            start = 0
            for chunk in chunk_list(text):
                end = start + len(chunk)
                yield from out.add(xxhash.xxh3_128_digest(chunk), doc, h, start, end)
                start = end
        yield from out.rest()

    def encode_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, encoder = Rows(CODES), codec.load()
        for frame, cuts in rows_of(batches, "packed", "cuts"):
            text = unpacked(frame)
            for c, ids in zip(cuts, encoder.chunks([text[c["start"] : c["end"]] for c in cuts])):
                yield from out.add(c["chunk"], ids, size=len(ids))
        yield from out.rest()

    out_schema = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, encoder = Rows(out_schema, limit=500, max_bytes=4 << 20), codec.load()
        for doc, frame, found in rows_of(batches, "id", "packed", "chunks"):
            text = unpacked(frame)
            given = {c["start"]: (c["end"], c["ids"]) for c in found or ()}
            starts = sorted(given)
            chunks = [text[a : given[a][0]] for a in starts]
            codes = [given[a][1] for a in starts]
            own = [k for k, ids in enumerate(codes) if ids is None]
            for k, ids in zip(own, encoder.chunks([chunks[k] for k in own])):
                codes[k] = ids
            ids = join_chunks(chunks, codes, encoder)
            wide = np.frombuffer(ids, encoder.type).astype("<u4").tobytes()
            decoded = encoder.decode(ids)
            yield from out.add(doc, wide, decoded, size=len(wide) + len(decoded))
        yield from out.rest()

    places = stored(rows.mapInArrow(cut, "chunk binary, id long, h long, start int, end int"), "chunks")
    place = F.min(F.struct("id", "h", "start", "end")).alias("place")
    shared = places.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), place).filter("n > 1").select("chunk", "place.*")
    first = shared.groupBy("id", "h").agg(F.collect_list(F.struct("chunk", "start", "end")).alias("cuts"))
    texts = packed(rows)
    codes = texts.join(first, same_row(texts, first)).select("packed", "cuts")
    # a repeated row would encode its chunks again: the codes are told apart by their chunk alone
    codes = codes.mapInArrow(encode_shared, "chunk binary, ids binary").groupBy("chunk").agg(F.first("ids").alias("ids"))
    # copies of a repeated row have the same places: those few are made distinct before they are gathered
    again = rows.groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", "h")
    again = small_side(stored(again, "again"))
    twice = places.join(again, same_row(places, again), "left_semi").dropDuplicates(["id", "h", "start"])
    places = places.join(again, same_row(places, again), "left_anti").union(twice)
    found = places.join(codes, "chunk", "left").groupBy("id", "h")
    found = found.agg(F.collect_list(F.struct("start", "end", "ids")).alias("chunks"))
    # the documents are laid out by the same key as above, so that shuffle serves both joins
    whole = texts.join(found, same_row(texts, found), "left").select(texts["id"], "packed", "chunks")
    return whole.mapInArrow(assemble, "id long, ids binary, decoded string")


def digests(docs: DataFrame, codec: Codec) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of decoded text, for every row."""
    return encoded(docs, codec).select(
        F.col("id").alias("doc_id"),
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


