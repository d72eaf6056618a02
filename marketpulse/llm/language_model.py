"""Scores of a log-bilinear language model next to a unigram base.

Word counts come from all training documents. The end, every word with at least
``LEAST`` training occurrences and one unit for all other words are what a
log-bilinear network predicts from the words before: the sum of their vectors,
weighed by position, times an output vector for each unit. So the predicted
vocabulary grows with the corpus, up to ``PREDICTED`` words. The network is trained
in numpy inside Spark tasks by noise-contrastive estimation: in every round each
task runs over its part of the training documents from the same start, and the
weights are averaged by tokens.

Scoring normalises in two steps of batched matrix products. The most frequent
units are classes of their own, the others are dealt by frequency into classes of
like mass. A class is predicted by its units' mean vector, weighed by their
biases (the sum of their exponentials to first order), and a unit within its class
by a softmax over the class. A word of the other unit gets its share of smoothed
counts on top, so probabilities of all words, known or not, sum to one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketpulse.llm.common import stored, table, whole

FOLDS, HELD_OUT = 7, 2
#: At most so many words' counts are held by every task; the counts of the others are joined.
HEAD = 65_536
#: Words with so many training occurrences are predicted, the most frequent ones up to a bound on the weights
LEAST, PREDICTED = 32, 16384
#: Units that are predicted: 0 the end, 1 any other word, then the words by falling count
END, OTHER = 0, 1
#: Units that are a class of their own, and classes of the others
SINGLE, BINS = 64, 128
#: Vectors by hash for the words that are read but not predicted
HASHED = 384
ORDER, WIDTH = 3, 16
NOISE, BATCH, RATE, SEED = 32, 512, 0.3, 11
#: Rows that are normalised at once over classes, and within classes
STEP, SPAN = 1024, 1 << 16
#: Weights in a row of a task's answer
PIECE = 4096
#: Sixteenths of the training documents that each round covers, together all
ROUNDS = (range(0, 1), range(1, 4), range(4, 16))
#: A-Z to lower case, white space to spaces
BLANKS = "\t\n\x0b\x0c\r"
FOLDED = (f"ABCDEFGHIJKLMNOPQRSTUVWXYZ{BLANKS}", "abcdefghijklmnopqrstuvwxyz     ")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` over whole texts, A-Z in lower case."""
    text = whole(F.col("text"))
    ascii_only = reduce(lambda t, blank: F.replace(t, F.lit(blank), F.lit(" ")), BLANKS, F.lower(text))  # as translate does, in less time
    words = F.split(F.when(F.octet_length(text) == F.char_length(text), ascii_only).otherwise(F.translate(text, *FOLDED)), " ")
    return docs.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("c"))


def most_frequent(counts: DataFrame) -> list[tuple[str, int]]:
    """At most ``HEAD`` words: all with at least some count. The count is found on a
    histogram by eighths of its logarithm, so tasks send no more than those words."""
    eighth = F.floor(F.log2("c") * 8)
    n, least = 0, None
    for r in sorted(counts.groupBy(eighth.alias("eighth")).count().collect(), reverse=True):
        n += r["count"]
        if n > HEAD:
            break
        least = r["eighth"]
    words = counts.where(eighth >= least).collect() if least is not None else []
    return sorted(((r["word"], r["c"]) for r in words), key=lambda wc: (-wc[1], wc[0]))


def units_of(head: list[tuple[str, int]]) -> int:
    """How many units are predicted for words by falling count."""
    return 2 + sum(c >= LEAST for _, c in head[:PREDICTED])


class Vocabulary(dict):
    """Head words (bytes) to their place in the arrays; others to -1 - hash."""

    def __init__(self, head: list[tuple[str, int]], n_ends: int):
        super().__init__((w.encode(), i) for i, (w, _) in enumerate(head))
        self.words = pa.array(list(self), pa.large_binary())
        self.log_count = np.log10(np.array([c + 1 for _, c in head], np.float64))
        self.log_end = float(np.log10(n_ends + 1))
        self.units = units_of(head)
        self.unit_of = np.full(len(head), OTHER, np.int64)
        self.unit_of[:self.units - 2] = np.arange(2, self.units)
        hashed = np.array([self.units + zlib.crc32(w) % HASHED for w in self], np.int64)
        self.read_as = np.where(self.unit_of == OTHER, hashed, self.unit_of)

    def __missing__(self, word: bytes) -> int:
        return -1 - zlib.crc32(word) % HASHED


def tokens_of(vocabulary: Vocabulary, texts: list[str | None]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    flat = list(chain.from_iterable(words))
    if len(flat) < len(vocabulary):  # too few to make a table of the vocabulary for
        return words, [np.fromiter(map(vocabulary.__getitem__, w), np.int64, len(w)) for w in words]
    found = pc.index_in(pa.array(flat, pa.large_binary()), value_set=vocabulary.words)
    codes = found.fill_null(-1).to_numpy().astype(np.int64)
    unknown = np.flatnonzero(codes < 0)
    codes[unknown] = [vocabulary.__missing__(flat[i]) for i in unknown.tolist()]
    return words, np.split(codes, np.cumsum([len(w) for w in words])[:-1])


def contexts_of(vocabulary: Vocabulary, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` inputs before every token (row i: i + 1 back) and its unit, of
    all texts one after another, each closed by the end. Before a text the end is read."""
    flat = np.concatenate([np.concatenate([c, np.full(ORDER, len(vocabulary))]) for c in codes])  # the end, and room to look back
    read = np.append(vocabulary.read_as, END)
    write = np.append(vocabulary.unit_of, END)
    inputs = np.where(flat < 0, vocabulary.units - 1 - flat, read[np.maximum(flat, 0)])
    units = np.where(flat < 0, OTHER, write[np.maximum(flat, 0)])
    inputs = np.concatenate([np.full(ORDER, END), inputs])
    at = np.concatenate([np.arange(len(c) + 1) + start for c, start in zip(codes, np.cumsum([0] + [len(c) + ORDER for c in codes]))])
    return np.stack([inputs[at + ORDER - 1 - i] for i in range(ORDER)]), units[at]


class LogBilinear:
    """Weights as one vector, with views of its parts."""

    def __init__(self, weights: np.ndarray, units: int):
        self.weights, self.units, at = np.asarray(weights, np.float32), units, 0
        for name, shape in self.sizes(units).items():
            n = int(np.prod(shape))
            setattr(self, name, self.weights[at:at + n].reshape(shape))
            at += n

    @staticmethod
    def sizes(units: int) -> dict[str, tuple[int, ...]]:
        return {"read": (units + HASHED, WIDTH), "place": (ORDER, WIDTH), "write": (units, WIDTH), "bias": (units,)}

    @classmethod
    def start(cls, log_share: np.ndarray) -> LogBilinear:
        rng, sizes = np.random.default_rng(SEED), cls.sizes(len(log_share))
        model = cls(np.zeros(sum(int(np.prod(s)) for s in sizes.values()), np.float32), len(log_share))
        model.read[:] = rng.normal(0, 0.1, sizes["read"])
        model.write[:] = rng.normal(0, 0.1, sizes["write"])
        model.place[:] = 1
        model.bias[:] = log_share
        return model

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        out = self.read.take(contexts[0], axis=0)
        out *= self.place[0]
        for place, c in zip(self.place[1:], contexts[1:]):
            vectors = self.read.take(c, axis=0)
            vectors *= place
            out += vectors
        return out

    def learn(self, contexts: np.ndarray, units: np.ndarray, log_noise: np.ndarray, rng: np.random.Generator, squares: LogBilinear) -> None:
        """One pass of noise-contrastive estimation with Adagrad, whose sums of squares are
        ``squares``; a batch shares its noise and alters the vectors that it meets."""
        upto = np.cumsum(np.exp(log_noise.astype(np.float64)))
        order = rng.permutation(len(units))
        room = np.zeros(len(self.read), np.int64)
        offset = (self.bias - log_noise - np.log(NOISE)).astype(np.float32)  # alters with the bias
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            ctx, true = contexts.take(pick, axis=1), units[pick]
            noise = np.minimum(np.searchsorted(upto, rng.random(NOISE) * upto[-1], side="right"), self.units - 1)
            read, written, noised = [self.read.take(c, axis=0) for c in ctx], self.write.take(true, axis=0), self.write.take(noise, axis=0)
            hidden = read[0] * self.place[0]
            for place, vectors in zip(self.place[1:], read[1:]):
                hidden += vectors * place
            odds = np.einsum("ij,ij->i", hidden, written) + offset[true]
            off = hidden @ noised.T + offset[noise]
            g_true = _share(-odds)
            g_noise = -_share(off)
            back = g_true[:, None] * written + g_noise @ noised
            places = np.stack([np.einsum("ij,ij->j", back, vectors) for vectors in read]) / len(pick)
            rows, slots = _met(ctx, room)
            turned = _summed(slots.ravel(), (back[None] * self.place[:, None]).reshape(-1, WIDTH), len(rows)) / len(pick)
            _climb(self.read, squares.read, rows, turned)
            rows, slots = _met(np.concatenate([true, noise]), room)
            write = _summed(slots, np.concatenate([g_true[:, None] * hidden, g_noise.T @ hidden]), len(rows)) / len(pick)
            bias = np.bincount(slots, np.concatenate([g_true, g_noise.sum(axis=0)]), len(rows)) / len(pick)
            _climb(self.write, squares.write, rows, write)
            _climb(self.bias, squares.bias, rows, bias)
            offset[rows] = self.bias[rows] - log_noise[rows] - np.float32(np.log(NOISE))
            _climb(self.place, squares.place, slice(None), places)


def _share(odds: np.ndarray) -> np.ndarray:
    """The logistic function."""
    return 1 / (1 + np.exp(-np.clip(odds, np.float32(-30), np.float32(30))))


def _met(units: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units that occur, ascending, and for every occurrence its place among them;
    ``room`` has a place for every unit."""
    there = np.zeros(len(room), bool)
    there[units] = True
    rows = np.flatnonzero(there)
    room[rows] = np.arange(len(rows))
    return rows, room[units]


def _summed(slots: np.ndarray, vectors: np.ndarray, n: int) -> np.ndarray:
    flat = (slots[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, vectors.ravel(), n * WIDTH).reshape(n, WIDTH)


def _climb(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray | slice, step: np.ndarray) -> None:
    step = step.astype(np.float32)
    total = squares.take(rows, axis=0) if isinstance(rows, np.ndarray) else squares[rows].copy()
    total += step * step
    squares[rows] = total
    step *= np.float32(RATE)
    step /= np.sqrt(total)
    weights[rows] += step


def class_starts(log_share: np.ndarray) -> np.ndarray:
    """First unit of every class: ``SINGLE`` units alone, the others in ``BINS`` runs of like mass."""
    single = np.arange(min(SINGLE, len(log_share)))
    rest = np.cumsum(np.exp(log_share[SINGLE:].astype(np.float64)))
    if not len(rest):
        return single
    cuts = np.searchsorted(rest, rest[-1] * np.arange(BINS) / BINS)
    return np.concatenate([single, SINGLE + np.unique(cuts)])


class TwoSteps:
    """Log probabilities of a model: of a unit's class, and of the unit within it."""

    def __init__(self, model: LogBilinear, first: np.ndarray):
        self.model, self.first = model, first
        self.after = np.append(first[1:], model.units)
        self.class_of = np.repeat(np.arange(len(first)), self.after - first)
        bias = model.bias.astype(np.float64)
        top = np.maximum.reduceat(bias, first)
        mass = np.exp(bias - top[self.class_of])
        total = np.add.reduceat(mass, first)
        self.bias = (top + np.log(total)).astype(np.float32)
        mean = np.add.reduceat(mass[:, None] * model.write, first, axis=0) / total[:, None]
        self.write = np.ascontiguousarray(mean.T.astype(np.float32))
        self.inside = [np.ascontiguousarray(model.write[a:b].T) for a, b in zip(first, self.after)]

        # no score is further from 0 than a hidden vector's length times the longest vector, and the largest bias
        self.longest = float(np.sqrt((model.write.astype(np.float64) ** 2).sum(axis=1).max()))
        self.most = float(max(np.abs(self.bias).max(), np.abs(bias).max()))

    @staticmethod
    def _chosen(scores: np.ndarray, at: np.ndarray, far: bool) -> np.ndarray:
        if far:
            np.clip(scores, -80, 80, out=scores)  # within the exponentials of a float32
        chosen = scores[np.arange(len(scores)), at]
        np.exp(scores, out=scores)
        return chosen - np.log(scores @ np.ones(scores.shape[1], np.float32))

    def log10_probabilities(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        out = np.empty(len(units))
        for start in range(0, len(units), SPAN):
            own = units[start:start + SPAN]
            hidden, classes, logs = self.model.hidden(contexts[:, start:start + SPAN]), self.class_of[own], out[start:start + SPAN]
            far = float(np.sqrt(np.einsum("ij,ij->i", hidden, hidden).max())) * self.longest + self.most > 80
            for at in range(0, len(own), STEP):
                rows = slice(at, at + STEP)
                scores = hidden[rows] @ self.write
                scores += self.bias
                logs[rows] = self._chosen(scores, classes[rows], far)
            by_class = np.argsort(classes, kind="stable")
            ends = np.searchsorted(classes, np.arange(len(self.first) + 1), sorter=by_class)
            for c in np.flatnonzero((np.diff(ends) > 0) & (self.after - self.first > 1)):
                first, after = self.first[c], self.after[c]
                for at in range(ends[c], ends[c + 1], STEP):
                    rows = by_class[at:min(at + STEP, ends[c + 1])]
                    scores = hidden.take(rows, axis=0) @ self.inside[c]
                    scores += self.model.bias[first:after]
                    logs[rows] += self._chosen(scores, own.take(rows) - first, far)
        return out / np.log(10)


def _batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[list[list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield [c.to_pylist() for c in batch.slice(at, rows).columns]


def train(docs: DataFrame, vocabulary: Vocabulary, log_share: np.ndarray) -> LogBilinear:
    """Over all of ``docs``, each document in one of the rounds. Tasks answer in rows of
    ``PIECE`` weights, and what comes back to the driver is one average for each weight."""
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(vocabulary)
    model = LogBilinear.start(log_share)
    sixteenth = F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(16))
    for round_no, share in enumerate(ROUNDS):
        begin = sc.broadcast(model.weights)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = LogBilinear(begin.value.copy(), len(log_share))
            squares, n = LogBilinear(np.full_like(own.weights, 1e-3), own.units), 0
            rng = np.random.default_rng([SEED, round_no])
            for (texts,) in _batches(batches):
                contexts, units = contexts_of(known.value, tokens_of(known.value, texts)[1])
                own.learn(contexts, units, log_share, rng, squares)
                n += len(units)
            if n:
                pieces = [own.weights[at:at + PIECE].tobytes() for at in range(0, len(own.weights), PIECE)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary()), pa.array([n] * len(pieces), pa.int64())],
                                                 ["piece", "weights", "n"])

        def average(rows: pa.Table) -> pa.Table:
            n, total = 0, 0.0
            for weights, own in zip(rows["weights"], rows["n"].to_pylist()):
                total = total + np.frombuffer(weights.as_buffer(), np.float32).astype(np.float64) * own
                n += own
            return pa.table({"piece": rows["piece"].slice(0, 1), "weights": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

        part = docs.where((sixteenth >= share.start) & (sixteenth < share.stop)).select("text").mapInArrow(learn, "piece int, weights binary, n long")
        averages = part.groupBy("piece").applyInArrow(average, "piece int, weights binary").collect()
        if averages:
            weights = b"".join(bytes(r["weights"]) for r in sorted(averages, key=lambda r: r["piece"]))
            model = LogBilinear(np.frombuffer(weights, np.float32), len(log_share))
    return model


def scored(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10).

    Null and empty texts have one token, the end. Null ids count as the empty id in
    the split. Texts of any length are read whole. Without training documents every
    word is unknown and the base gives it probability 1. An empty table gives an
    empty result; columns other than ``doc_id`` and ``text`` are not looked at."""
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    learned = docs.where("not held_out")
    counts = stored(word_counts(learned), "word-counts")
    n_docs = learned.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, types = n_words + n_docs, n_types + (n_docs > 0)
    head = most_frequent(counts)
    vocabulary = Vocabulary(head, n_docs)
    predicted = [c for _, c in head[:vocabulary.units - 2]]
    other = n_words - sum(predicted) + n_types - len(predicted) + 1  # smoothed, and one unknown
    share = np.array([n_docs + 1, other, *predicted], np.float64)
    log_share = np.log(share / share.sum()).astype(np.float32)
    model = train(learned, vocabulary, log_share)
    first, log_rest = class_starts(log_share), float(np.log10(other))
    sc = docs.sparkSession.sparkContext
    known, weights = sc.broadcast(vocabulary), sc.broadcast(model.weights)
    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, tail array<struct<word: string, n: long>>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = known.value
        own = TwoSteps(LogBilinear(weights.value, vocab.units), first)
        log_count = np.append(vocab.log_count, vocab.log_end)
        for ids, texts, outs in _batches(batches):
            words, codes = tokens_of(vocab, texts)
            contexts, units = contexts_of(vocab, codes)
            lengths = np.array([len(c) + 1 for c in codes])
            starts = np.cumsum(lengths) - lengths
            flat = np.concatenate([np.append(c, len(vocab)) for c in codes])
            logs = np.where(flat < 0, 0.0, log_count[np.maximum(flat, 0)])
            likely = own.log10_probabilities(contexts, units) + (units == OTHER) * (logs - log_rest)
            tails = [Counter(w[i].decode("utf-8", "surrogatepass") for i in np.flatnonzero(c < 0)) for w, c in zip(words, codes)]
            n_known = np.add.reduceat(flat >= 0, starts) if vocab.log_end or len(vocab) else np.zeros(len(ids), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(lengths), pa.array(n_known.astype(np.int64)),
                pa.array(np.add.reduceat(logs, starts)), pa.array(np.add.reduceat(likely, starts)),
                pa.array([[{"word": w, "n": n} for w, n in t.items()] for t in tails], pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                [f.split()[0] for f in shape.split(", ", 6)])

    rows = docs.select("doc_id", "text", "held_out").mapInArrow(score, shape).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "head-scores")
    tail = rows.select("row", F.inline("tail")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more_logs"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("more_known"))
    more = F.coalesce("more_logs", F.lit(0.0))
    return rows.drop("tail").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(float(np.log10(total + types + 1)))).alias("base_score"), (F.col("score") + more).alias("score"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
