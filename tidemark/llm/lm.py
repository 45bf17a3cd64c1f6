"""LM scoring with a log-bilinear model.

The model predicts a symbol from the two before it: q = r[w1] C1 + r[w2] C2, and the probability of symbol s
is softmax(q . v[s] + b[s]). Symbols are the text end, the most frequent words, and classes of all other
words (by their first two bytes), so the softmax is over a bounded set and can be worked out exactly; a word
of a class then has its smoothed share of that class. Together the probabilities of all words that occur,
plus one word that does not, sum to one after any context.

Word counts come from all training texts. Training is noise-contrastive, in numpy, on all training texts:
each task trains a copy on its rows, from the same start, and the copies are averaged by their tokens in a
combining aggregate. The normaliser of every context is a table made by one matrix product per symbol.

Counts of the most frequent words go to all tasks, in a number bounded by ``head``. Tokens of other words
are joined to their counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import Rows, keyed, rows_of, stored

END = b""  # no word is empty
FLUSH = 300_000  # distinct words a counting task holds
SLICE = 1 << 15  # tokens whose vectors are in memory at once
BATCH_TOKENS = 100_000  # tokens of short texts that are scored together

COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])
SCORES = pa.schema(
    [
        ("id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base", pa.float64()), ("score", pa.float64()),
        ("tail", pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))),
    ]
)
SCORES_DDL = (
    "id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "tail array<struct<word: binary, times: long>>"
)


@dataclass(frozen=True)
class LogBilinear:
    """``words`` own symbols, ``classes`` of other words, ``head`` words whose counts every task gets."""

    words: int = 1024
    classes: int = 64
    head: int = 1 << 18
    width: int = 32
    noise: int = 32
    batch: int = 2048
    rate: float = 0.1
    seed: int = 7


@dataclass
class Vocabulary:
    """``index``: words of the head, most frequent first after the end. The first ``own`` are symbols."""

    index: dict[bytes, int]
    counts: np.ndarray
    own: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int
    symbol: np.ndarray | None = None  # of every head word
    _class: dict[bytes, int] = field(default_factory=dict)

    @property
    def symbols(self) -> int:
        return self.own + len(self.class_tokens)

    def class_of(self, word: bytes) -> int:
        start = word[:2]
        if (found := self._class.get(start)) is None:
            h = xxhash.xxh64_intdigest(start, 42)  # as Spark's xxhash64
            found = self._class[start] = (h - (1 << 64) if h >> 63 else h) % len(self.class_tokens)
        return found

    def symbol_counts(self) -> np.ndarray:
        return np.concatenate([self.counts[: self.own], self.class_tokens]).astype(np.float64)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place in the head (-1 for other words) and symbol of every token."""
        if self.symbol is None:
            classes = [self.class_of(w) + self.own for w in list(self.index)[self.own :]]
            self.symbol = np.array([*range(self.own), *classes], np.int64)
        place = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        symbol = self.symbol[place]
        other = np.flatnonzero(place < 0)
        of = self.class_of
        symbol[other] = np.fromiter((of(words[i]) for i in other.tolist()), np.int64, len(other)) + self.own
        return place, symbol


def tokens_of(text: str | None) -> list[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def class_of(word: Column, classes: int) -> Column:
    return F.pmod(F.xxhash64(F.substring(word, 1, 2)), F.lit(classes))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) over the ``text`` of all rows, the text end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = [pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())]
            counter.clear()
            return pa.RecordBatch.from_arrays(out, schema=COUNTS)

        for (text,) in rows_of(batches, "text"):
            counter.update(tokens_of(text))
            if len(counter) > FLUSH:
                yield flush()
        if counter:
            yield flush()

    return train.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, params: LogBilinear) -> Vocabulary:
    """What every task needs to know of the counts. The head is cut at a step of the counts' logarithms, so
    it has at most ``head`` words, and only the sizes of the steps are collected to find it."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.filter(F.length("word") > 0).groupBy(step.alias("step"))
    steps = steps.agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    least, taken = None, 0
    for row in sorted(steps, key=lambda r: -r.step):
        taken += row.words
        if taken > params.head:
            break
        least = row.step
    head = []
    if least is not None:
        head = counts.filter(F.length("word") > 0).filter(step >= least).collect()
        head = sorted(((bytes(r.word), r.n) for r in head), key=lambda x: (-x[1], x[0]))
    ends = sum(r.n for r in counts.filter(F.length("word") == 0).collect())  # one row at most
    head = [(END, ends), *head]
    own = min(len(head), params.words + 1)
    totals = counts.filter(F.length("word") > 0).groupBy(class_of(F.col("word"), params.classes).alias("c"))
    class_tokens, class_words = np.zeros(params.classes, np.int64), np.zeros(params.classes, np.int64)
    for row in totals.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("w")).collect():  # one row per class
        class_tokens[row.c], class_words[row.c] = row.n, row.w
    out = Vocabulary(
        {w: i for i, (w, _) in enumerate(head)},
        np.array([n for _, n in head], np.int64),
        own,
        class_tokens,
        class_words,
        sum(r.tokens for r in steps) + ends,
        sum(r.words for r in steps) + (ends > 0),
    )
    out.encode([])  # works out the symbols of the head, once
    for word, n in head[1:own]:  # symbols of their own are in no class
        c = out.class_of(word)
        class_tokens[c] -= n
        class_words[c] -= 1
    return out


@dataclass
class Model:
    r: np.ndarray  # vectors of context symbols
    c1: np.ndarray
    c2: np.ndarray
    v: np.ndarray  # vectors of predicted symbols; the last column is the bias

    def rows(self) -> np.ndarray:
        wide = [np.pad(m, ((0, 0), (0, self.v.shape[1] - m.shape[1]))) for m in (self.r, self.c1, self.c2, self.v)]
        return np.concatenate(wide)

    @staticmethod
    def of_rows(rows: np.ndarray, symbols: int, width: int) -> Model:
        cuts = np.cumsum([symbols, width, width])
        r, c1, c2, v = np.split(rows, cuts)
        return Model(r[:, :width], c1[:, :width], c2[:, :width], v)


def start_model(vocab: Vocabulary, params: LogBilinear) -> Model:
    """Small random vectors; the biases give the words' frequencies, so the first model is normalised."""
    rng, s, d = np.random.default_rng(params.seed), vocab.symbols, params.width
    counts = vocab.symbol_counts() + 1
    bias = np.log(counts / counts.sum())
    v = np.column_stack([rng.normal(0, 0.1, (s, d)), bias])
    return Model(rng.normal(0, 0.1, (s, d)), np.eye(d), np.eye(d) * 0.5, v)


def add_rows(into: np.ndarray, squares: np.ndarray, at: np.ndarray, grad: np.ndarray, rate: float) -> None:
    """An AdaGrad step on the rows ``at`` of ``into``; gradients of the same row are added first."""
    order = np.argsort(at.astype(np.uint16) if len(into) <= 1 << 16 else at, kind="stable")  # short keys sort by radix
    at = at[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    total, rows = np.add.reduceat(grad[order], first, axis=0), at[first]
    squares[rows] += total * total
    into[rows] -= rate * total / np.sqrt(squares[rows] + 1e-8)


class Trainer:
    """Noise-contrastive estimation: tell each symbol from ``noise`` drawn by frequency."""

    def __init__(self, model: Model, vocab: Vocabulary, params: LogBilinear):
        self.p, self.rng = params, np.random.default_rng(params.seed)
        self.m = Model(*(np.array(x, np.float32) for x in (model.r, model.c1, model.c2, model.v)))
        self.squares = [np.full_like(x, 0.1) for x in (self.m.r, self.m.c1, self.m.c2, self.m.v)]
        share = vocab.symbol_counts() + 1
        share /= share.sum()
        self.steps = np.cumsum(share)
        self.log_noise = np.log(share * params.noise).astype(np.float32)

    def step(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> None:
        m, k, rate = self.m, self.p.noise, self.p.rate
        d, n = m.c1.shape[0], len(w)
        drawn = np.minimum(np.searchsorted(self.steps, self.rng.random(k)), len(self.steps) - 1)
        r1, r2 = m.r[c1], m.r[c2]
        q = r1 @ m.c1 + r2 @ m.c2
        vw, vn = m.v[w], m.v[drawn]
        real = (q * vw[:, :d]).sum(1) + vw[:, d] - self.log_noise[w]
        fake = q @ vn[:, :d].T + vn[:, d] - self.log_noise[drawn]
        g_real = 1 / (1 + np.exp(-np.clip(real, -30, 30))) - 1
        g_fake = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))
        dq = g_real[:, None] * vw[:, :d] + g_fake @ vn[:, :d]
        grad_w = np.column_stack([g_real[:, None] * q, g_real])
        grad_n = np.column_stack([g_fake.T @ q, g_fake.sum(0)])
        scale = 1 / np.sqrt(n)
        d1, d2 = r1.T @ dq * scale, r2.T @ dq * scale
        g1, g2 = dq @ m.c1.T, dq @ m.c2.T
        add_rows(m.v, self.squares[3], np.concatenate([w, drawn]), np.concatenate([grad_w, grad_n]) * scale, rate)
        add_rows(m.r, self.squares[0], np.concatenate([c1, c2]), np.concatenate([g1, g2]) * scale, rate)
        for mat, sq, g in ((m.c1, self.squares[1], d1), (m.c2, self.squares[2], d2)):
            sq += g * g
            mat -= rate * 0.1 * g / np.sqrt(sq + 1e-8)


def contexts(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two before each; the text end stands before a text."""
    c1, c2 = np.zeros_like(symbols), np.zeros_like(symbols)
    c1[1:], c2[2:] = symbols[:-1], symbols[:-2]
    c2[starts] = 0
    return c1, c2


def blocks(texts: Iterator[tuple], at: int) -> Iterator[tuple[list, list[bytes], np.ndarray]]:
    """Rows, the tokens of their texts one after the other, and where each text starts."""
    rows, words, starts = [], [], []
    for row in texts:
        rows.append(row)
        starts.append(len(words))
        words += tokens_of(row[at])
        if len(words) >= BATCH_TOKENS:
            yield rows, words, np.array(starts)
            rows, words, starts = [], [], []
    if rows:
        yield rows, words, np.array(starts)


def train(texts: DataFrame, vocab: Vocabulary, params: LogBilinear) -> Model:
    """The average of the models that the tasks train on their rows."""
    first, width = start_model(vocab, params), params.width + 1
    shared = texts.sparkSession.sparkContext.broadcast((vocab, first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = shared.value
        trainer, seen = Trainer(model, vocab, params), 0
        for _, words, starts in blocks(rows_of(batches, "text"), 0):
            _, symbol = vocab.encode(words)
            c1, c2 = contexts(symbol, starts)
            order = trainer.rng.permutation(len(words))
            for a in range(0, len(words), params.batch):
                part = order[a : a + params.batch]
                trainer.step(symbol[part], c1[part], c2[part])
            seen += len(words)
        if seen:
            rows = trainer.m.rows().astype(np.float64) * seen
            names = ["row", "weight", *(f"x{i}" for i in range(width))]
            n = len(rows)
            columns = [np.arange(n), np.full(n, float(seen)), *rows.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    names = [f"x{i}" for i in range(width)]
    trained = texts.select("text").mapInArrow(run, "row long, weight double, " + ", ".join(f"{x} double" for x in names))
    rows = trained.groupBy("row").agg(*(F.sum(x).alias(x) for x in ["weight", *names])).collect()  # a row per symbol
    if not rows:
        return first
    table = np.zeros((len(rows), width))
    for r in rows:
        table[r.row] = np.array(r[2:]) / r.weight
    return Model.of_rows(table, vocab.symbols, params.width)


class Scorer:
    def __init__(self, model: Model, vocab: Vocabulary):
        self.q1 = (model.r @ model.c1).astype(np.float32)
        self.q2 = (model.r @ model.c2).astype(np.float32)
        self.v = model.v[:, :-1].astype(np.float32)
        self.bias = model.v[:, -1].astype(np.float32)
        self.log_z = np.empty((len(self.v), len(self.v)), np.float32)
        for c, q in enumerate(self.q1):
            logits = (q + self.q2) @ self.v.T + self.bias
            top = logits.max(axis=1, keepdims=True)
            self.log_z[c] = np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0]

    def log10(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        out = np.empty(len(w))
        for a in range(0, len(w), SLICE):
            s = slice(a, a + SLICE)
            q = self.q1[c1[s]] + self.q2[c2[s]]
            out[s] = np.einsum("ij,ij->i", q, self.v[w[s]]) + self.bias[w[s]] - self.log_z[c1[s], c2[s]]
        return out / np.log(10)


def scores(docs: DataFrame, params: LogBilinear = LogBilinear()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    NULL and empty texts are the end token alone. A row without an id is learned from. Repeated rows count
    as often as they occur, in training too, and stay repeated. Without training rows every token is
    unknown. An empty table gives an empty result.
    """
    rows = keyed(docs).select("id", "text").withColumn("held_out", held_out(F.col("id")))
    rows = rows.withColumn("id", F.col("id").cast("long"))
    learned = rows.filter(~F.col("held_out"))
    counts = stored(word_counts(learned), "counts")
    vocab = vocabulary(counts, params)
    scorer = Scorer(train(learned, vocab, params), vocab)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, scorer = shared.value
        out = Rows(SCORES)
        count = np.log10(vocab.counts + 1.0)
        mass = np.log10(vocab.class_tokens + vocab.class_words + 1.0)
        every = np.log10(vocab.tokens + vocab.distinct + 1.0)
        for rows, words, starts in blocks(rows_of(batches, "id", "held_out", "text"), 2):
            place, symbol = vocab.encode(words)
            c1, c2 = contexts(symbol, starts)
            score = scorer.log10(symbol, c1, c2)
            known = np.where(place >= 0, count[place], 0.0)  # what the tail lacks is joined on
            in_class = symbol >= vocab.own
            score[in_class] += known[in_class] - mass[symbol[in_class] - vocab.own]
            n_known = np.add.reduceat(((place >= 0) & (vocab.counts[place] > 0)).astype(np.int64), starts)
            base, score = np.add.reduceat(known - every, starts), np.add.reduceat(score, starts)
            bounds = [*starts.tolist(), len(words)]
            tails: list[Counter] = [Counter() for _ in rows]
            missing = np.flatnonzero(place < 0)
            for i, doc in zip(missing.tolist(), (np.searchsorted(starts, missing, "right") - 1).tolist()):
                tails[doc][words[i]] += 1
            for k, (doc, held, _) in enumerate(rows):
                tail = [{"word": w, "times": t} for w, t in tails[k].items()]
                n = bounds[k + 1] - bounds[k]
                yield from out.add(doc, held, n, int(n_known[k]), float(base[k]), float(score[k]), tail, size=20 * len(tail))
        yield from out.rest()

    scored = rows.mapInArrow(run, SCORES_DDL).withColumn("r", F.monotonically_increasing_id())
    scored = stored(scored, "scores")  # from here on a row's number is fixed
    tail = scored.select("r", F.explode("tail").alias("t")).select("r", "t.word", "t.times")
    more = F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
    tail = tail.join(counts, "word").groupBy("r").agg(more, F.sum("times").alias("known"))
    out = scored.drop("tail").join(tail, "r", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"), (F.col("score") + extra).alias("score"),
    )
