"""Language-model scores from a log-bilinear model that is trained by noise-contrastive estimation, in numpy.

Tokens are the words of a text (runs without white space, A-Z in lower case) and one end.  The model reads classes:
the ``TOP`` most frequent words are classes of their own, every other word belongs to one of ``ENDINGS`` classes by its
last three bytes, and the end is a class.  The score of a class after another is bilinear in their vectors,
``(C r) . q + b``; a word of a shared class has the class's probability times its add-one share of the class.

Training uses all training documents: their class pairs are counted in Spark, and noise-contrastive estimation runs
on the table of counts with the exact expectation over the noise (the class frequencies) in place of samples.  The
normalised log-probabilities of all classes after all classes are then one matrix product and a soft maximum.

Documents are coded once, in blocks of ``ROWS`` rows: distinct words with their counts, and each token as the number
of its word in the block.  Words of all blocks are counted and joined back by a shuffle on the word, where a word has
one row per block.  Counts cover all documents outside the held-out fold.

Null text counts as empty (its only token is the end).  A null doc_id is in training.  Rows that repeat are scored and
counted each.  Extra columns are ignored; an empty table gives an empty result; without any training token
all counts are 0 and the model knows the end alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.bytewords import SPACED, word_hashes, word_spans
from unirec.llm.text import id_remainder

ROWS = 2500  # documents of a block
TOP = 400
ENDINGS = 111
CLASSES = TOP + ENDINGS + 1
END = CLASSES - 1
NOISE = 10


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_remainder(doc_id, 7) == 2, F.lit(False))


# --- blocks -----------------------------------------------------------------------------------------------------

BLOCK = ("block long, doc_ids array<long>, train array<boolean>, sizes array<int>, codes binary, words array<binary>, "
         "times array<int>, endings array<int>")


def coded_blocks(docs: DataFrame) -> DataFrame:
    """One row per block: its documents, the word number of every token, and per distinct word the bytes, the
    number of times in training documents, and the class that its ending gives."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                data, begin, end, counts = word_spans(batch.column(2), SPACED)
                _, first, codes = np.unique(word_hashes(data, begin, end), return_index=True, return_inverse=True)
                # The most frequent words have the smallest numbers, so that most numbers need two bytes.
                order = np.argsort(-np.bincount(codes, minlength=len(first)), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                first, codes = first[order], place[codes]
                b, e = begin[first], end[first]
                weights = np.repeat(train, counts).astype(float)
                times = np.bincount(codes, weights, minlength=len(first)).astype(np.int32)
                ending = np.zeros(len(first), np.int64)
                for k in (3, 2, 1):
                    ending = ending * 256 + np.where(e - b >= k, data[np.maximum(e - k, 0)] if len(data) else 0, 0)
                sizes = e - b
                flat = data[np.repeat(b - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
                offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
                words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])

                def row(values):
                    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), row(batch.column(0)), row(batch.column(1)), row(pa.array(counts.astype(np.int32))),
                    pa.array([packed(codes)], pa.binary()), row(words), row(pa.array(times)),
                    row(pa.array((TOP + ending % ENDINGS).astype(np.int32)))],
                    names=["block", "doc_ids", "train", "sizes", "codes", "words", "times", "endings"])
                block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), "text")
    return stored(rows.mapInArrow(code, BLOCK), "token-blocks")


def packed(codes: np.ndarray) -> bytes:
    """Numbers as all their lower halves, then all their upper halves, which are mostly 0."""
    return (codes & 0xFFFF).astype("<u2").tobytes() + (codes >> 16).astype("<u2").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
    return low | high << 16


def class_pairs(blocks: DataFrame, top: dict[bytes, int]) -> DataFrame:
    """prev * CLASSES + next, n: over all training documents, each between two ends."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                train, sizes, codes, words, endings = (batch.column(c)[r] for c in range(5))
                classes = np.array(endings.values.to_numpy(), np.int64)
                known = pc.index_in(words.values, pa.array(list(top), pa.binary())) if top else None
                if known is not None:
                    at = pc.fill_null(known, -1).to_numpy()
                    classes = np.where(at >= 0, np.array(list(top.values()))[at], classes)
                kept = np.repeat(train.values.to_numpy(zero_copy_only=False).astype(bool), sizes.values.to_numpy())
                prev, this = sequences(classes[unpacked(codes.as_py())[kept]], sizes.values.to_numpy()[train.values.to_numpy(zero_copy_only=False).astype(bool)])
                total += np.bincount(prev * CLASSES + this, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    rows = blocks.select("train", "sizes", "codes", "words", "endings")
    return rows.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def sequences(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before and the class itself of every token, the end of each document included."""
    ends = np.cumsum(sizes)
    this = np.insert(classes, ends, END)
    return np.append(END, this[:-1])[:len(this)], this


# --- the model --------------------------------------------------------------------------------------------------

class LogBilinear:
    def __init__(self, frequencies: np.ndarray, size: int = 24, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = len(frequencies)
        self.noise = (frequencies + 1e-3) / (frequencies + 1e-3).sum()
        self.r, self.q = rng.normal(0, 0.3, (n, size)), rng.normal(0, 0.3, (n, size))
        self.c = np.eye(size)
        self.b = np.log(self.noise)

    def scores(self) -> np.ndarray:
        """All classes after all classes."""
        return self.r @ self.c @ self.q.T + self.b

    def fit(self, pairs: np.ndarray, steps: int = 250, rate: float = 0.05) -> None:
        """``pairs[p, w]``: how often w follows p.  Each step is a gradient of the whole objective, by Adam."""
        given = pairs.sum(1, keepdims=True)
        shift = np.log(NOISE * self.noise)
        weights = [self.r, self.c, self.q, self.b]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        for step in range(1, steps + 1):
            data = 1 / (1 + np.exp(np.clip(shift - self.scores(), -50, 50)))  # probability of "data, not noise"
            d = (given * (NOISE * self.noise) * data - pairs * (1 - data)) / max(1, pairs.sum())
            left = self.r @ self.c
            grads = [d @ self.q @ self.c.T, self.r.T @ d @ self.q, d.T @ left, d.sum(0)]
            now = rate * (1 - step / (steps + 1))
            for w, g, (m, v) in zip(weights, grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-12)

    def log10_probabilities(self) -> np.ndarray:
        """Normalised, classes x classes."""
        z = self.scores()
        z -= z.max(1, keepdims=True)
        return ((z - np.log(np.exp(z).sum(1, keepdims=True))) / np.log(10)).astype(np.float32)


# --- scores -----------------------------------------------------------------------------------------------------

def score_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    blocks = coded_blocks(docs)
    words = blocks.select("block", F.posexplode(F.arrays_zip("words", "times", "endings")).alias("code", "w"))
    words = words.select("block", "code", "w.words", "w.times", "w.endings")
    vocabulary = words.filter("times > 0").groupBy("words", "endings").agg(F.sum("times").alias("c"))
    vocabulary = stored(vocabulary, "vocabulary")
    best = vocabulary.orderBy(F.desc("c"), "words").limit(TOP).collect()  # a fixed number of rows
    top = {bytes(r.words): k for k, r in enumerate(best)}
    ends = blocks.agg(F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0))).first()[0]
    pairs = np.zeros(CLASSES * CLASSES)
    for r in class_pairs(blocks, top).collect():  # at most CLASSES * CLASSES numbers
        pairs[r.pair] = r.n
    pairs = pairs.reshape(CLASSES, CLASSES)
    model = LogBilinear(pairs.sum(0))
    model.fit(pairs)
    table = model.log10_probabilities()

    ranks = spark.createDataFrame([(w, k) for w, k in top.items()], "words binary, rank int")
    classed = vocabulary.join(F.broadcast(ranks), "words", "left")  # TOP rows
    classed = stored(classed.select("words", "c", F.coalesce("rank", "endings").alias("class")), "vocabulary-classes")
    shares = np.ones(CLASSES)
    for r in classed.filter(F.col("class") >= TOP).groupBy("class").agg((F.sum("c") + F.count("*") + 1).alias("n")).collect():  # ENDINGS rows
        shares[r["class"]] = r.n
    shares[:TOP] = shares[END] = 0  # no share: the class is the word
    n_all, v_all = classed.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_all, v_all = n_all + ends, v_all + (ends > 0)
    below = np.log10(n_all + v_all + 1)

    def score(key, block: pa.Table, found: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        doc_ids, train, sizes, codes = (block.column(c)[0] for c in ("doc_ids", "train", "sizes", "codes"))
        at = found.column("code").to_numpy()
        n_words = len(at)
        c, cls = np.zeros(n_words + 1, np.int64), np.full(n_words + 1, END)
        c[at], cls[at] = found.column("c").to_numpy(), found.column("class").to_numpy()
        c[n_words] = ends
        sizes = sizes.values.to_numpy()
        tokens = np.insert(unpacked(codes.as_py()), np.cumsum(sizes), n_words)
        this = cls[tokens]
        prev = np.append(END, this[:-1])
        log_c = np.log10(c + 1.0)
        inside = np.where(shares[cls] > 0, log_c - np.log10(np.maximum(shares[cls], 1)), 0.0)
        model_ = table[prev, this] + inside[tokens]
        first = np.append(0, np.cumsum(sizes + 1)[:-1])
        n_tokens = sizes.astype(np.int64) + 1
        return pa.table({
            "doc_id": doc_ids.values, "held_out": pc.invert(train.values), "n_tokens": n_tokens,
            "n_known": np.add.reduceat((c > 0)[tokens].astype(np.int64), first), "train_tokens": np.full(len(sizes), n_all, np.int64),
            "base_score": np.add.reduceat(log_c[tokens], first) - n_tokens * below, "score": np.add.reduceat(model_.astype(float), first)})

    counts = words.join(classed, "words", "left").select(
        F.col("block").alias("of_block"), "code", F.coalesce("c", F.lit(0)).cast("long").alias("c"), F.coalesce("class", "endings").cast("int").alias("class"))
    rows = blocks.select("block", "doc_ids", "train", "sizes", "codes").groupBy("block")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.cogroup(counts.groupBy("of_block")).applyInArrow(score, schema)
