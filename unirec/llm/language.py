"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

The network reads a word as bytes in both directions, labels every byte of it, and is trained by backpropagation through
time.  A document's probabilities pool the log-probabilities of all its positions: their mean per language, made a
distribution again.  Words are runs of ASCII letters and characters beyond ASCII, in lower case (digits, marks and
spaces carry no label); a word of more than ``PIECE`` bytes is read in pieces.  The network starts anew at each
piece, so every distinct piece is read once and counted as often as it occurs; no text is cut off.

Fitting uses a bounded sample: the ``docs_per_language`` documents per language with the smallest id hash, at most
``max_docs`` in all, of those with a label outside the held-out fold and a word to read.  Texts of at most ``MAX_BYTES``
bytes go first; where a language has too few, the beginnings of longer ones are learned from.
Prediction reads the text only, and all of it.

Null texts and texts without a letter are ``und`` with score 0.  Equal scores go to the language first by code point.
Without any training row every document is ``und``.  Extra columns are ignored; rows that repeat are predicted each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unirec.llm.slices import by_bytes
from unirec.llm.text import id_remainder
from unirec.llm.worker_memory import claim, give_back, remember

PIECE = 24
SLICE_BYTES = 2 << 20  # of texts that are worked on at a time
MEMO_PIECES = 200_000
MAX_BYTES = 50_000  # of a text to learn from
# Bytes as they are, but a space for what is neither an ASCII letter nor part of a character beyond ASCII.
SPACED = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)
UNKNOWN = "und"
READABLE = r"[^\x00-@\[-`{-\x7F]"  # a byte that is labelled


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Gru:
    """One direction.  Gates in the order reset, update, candidate."""

    inputs: np.ndarray  # 256 + 1 (padding) x 3H, the embedding times the input weights, biases included
    hidden: np.ndarray  # H x 3H

    def run(self, codes: np.ndarray, live: np.ndarray | None = None, keep: bool = False):
        """codes: steps x words; live, for training: where a word has not ended.  Returns the states after each step
        (steps x words x H)."""
        steps, n = codes.shape
        size = self.hidden.shape[0]
        h = np.zeros((n, size), np.float32)
        out = np.empty((steps, n, size), np.float32)
        trace = []
        for t in range(steps):
            x = self.inputs[codes[t]]
            rec = h @ self.hidden
            gates = sigmoid(x[:, :2 * size] + rec[:, :2 * size])
            reset, update = gates[:, :size], gates[:, size:]
            candidate = np.tanh(x[:, 2 * size:] + reset * rec[:, 2 * size:])
            new = candidate + update * (h - candidate)
            if keep:
                trace.append((h, reset, update, candidate, rec[:, 2 * size:]))
                new = np.where(live[t][:, None], new, h)
            h = new
            out[t] = h
        return (out, trace) if keep else out

    def back(self, codes, live, trace, d_out):
        """Backpropagation through time; returns the gradients of inputs and hidden."""
        size = self.hidden.shape[0]
        d_inputs, d_hidden = np.zeros_like(self.inputs), np.zeros_like(self.hidden)
        d_h = np.zeros_like(d_out[0])
        for t in range(len(trace) - 1, -1, -1):
            h, reset, update, candidate, rec_c = trace[t]
            d_h = d_h + d_out[t]
            on = live[t][:, None]
            d_new = d_h * on
            d_cand = d_new * (1 - update) * (1 - candidate ** 2)
            d_update = d_new * (h - candidate) * update * (1 - update)
            d_reset = d_cand * rec_c * reset * (1 - reset)
            d_gates = np.concatenate([d_reset, d_update, d_cand], 1)
            d_rec = np.concatenate([d_reset, d_update, d_cand * reset], 1)
            order = np.argsort(codes[t], kind="stable")
            values, first = np.unique(codes[t][order], return_index=True)
            d_inputs[values] += np.add.reduceat(d_gates[order], first, axis=0)
            d_hidden += h.T @ d_rec
            d_h = d_rec @ self.hidden.T + d_new * update + d_h * ~on
        return d_inputs, d_hidden


class ByteNet:
    """Both directions and the label of every position."""

    def __init__(self, languages: list[str], size: int = 10, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.parts = []
        for _ in range(2):
            self.parts.append(Gru(
                rng.normal(0, 0.3, (257, 3 * size)).astype(np.float32), rng.normal(0, size ** -0.5, (size, 3 * size)).astype(np.float32)))
        self.out = rng.normal(0, 0.1, (2 * size + 1, len(languages))).astype(np.float32)

    def weights(self) -> list[np.ndarray]:
        return [w for g in self.parts for w in (g.inputs, g.hidden)] + [self.out]

    def key(self) -> str:
        return hashlib.sha256(b"".join(w.tobytes() for w in self.weights())).hexdigest()

    def log_probabilities(self, states: np.ndarray) -> np.ndarray:
        z = states @ self.out[:-1] + self.out[-1]
        z -= z.max(-1, keepdims=True)
        return z - np.log(np.exp(z).sum(-1, keepdims=True))

    def word_sums(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Per piece the log-probabilities of its positions, added up (pieces x languages)."""
        out = np.zeros((len(begin), len(self.languages)), np.float32)
        for n in np.unique(size):
            if n == 0:
                continue
            at = np.flatnonzero(size == n)
            for start in range(0, len(at), 2048):
                rows = at[start:start + 2048]
                codes = data[begin[rows][None, :] + np.arange(n)[:, None]]
                ahead = self.parts[0].run(codes)
                behind = self.parts[1].run(codes[::-1])[::-1]
                out[rows] = self.log_probabilities(np.concatenate([ahead, behind], 2)).sum(0)
        return out

    def fit(self, words: list[bytes], labels: np.ndarray, chances: np.ndarray, steps: int, batch: int = 512, rate: float = 0.01) -> None:
        """Cross-entropy at every position, by backpropagation through time and Adam."""
        rng = np.random.default_rng(11)
        size = np.array([len(w) for w in words])
        padded = np.full((PIECE, len(words)), 256, np.int16)
        for i, w in enumerate(words):
            padded[:len(w), i] = np.frombuffer(w, np.uint8)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        picks = rng.choice(len(words), (steps, batch), p=chances / chances.sum())
        half = self.parts[0].hidden.shape[0]
        for step, pick in enumerate(picks, 1):
            n = size[pick]
            codes = padded[:n.max(), pick].astype(np.int64)
            live = np.arange(len(codes))[:, None] < n
            ahead, trace1 = self.parts[0].run(codes, live, keep=True)
            behind, trace2 = self.parts[1].run(codes[::-1], live[::-1], keep=True)
            states = np.concatenate([ahead, behind[::-1]], 2)
            d_z = np.exp(self.log_probabilities(states))
            d_z[:, np.arange(len(pick)), labels[pick]] -= 1
            d_z *= live[:, :, None] / live.sum()
            flat = states.reshape(-1, states.shape[-1])
            d_out = np.concatenate([flat.T @ d_z.reshape(len(flat), -1), d_z.sum((0, 1))[None]])
            d_states = d_z @ self.out[:-1].T
            grads = [*self.parts[0].back(codes, live, trace1, d_states[:, :, :half]),
                     *self.parts[1].back(codes[::-1], live[::-1], trace2, d_states[::-1, :, half:]), d_out]
            now = rate * (1 - step / (steps + 1))
            for w, g, (m, v) in zip(self.weights(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts, long ones in pieces, and the number of the text each belongs to."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    data = SPACED[np.frombuffer(lowered.buffers()[2] or b"", np.uint8)]
    spaced = pa.Array.from_buffers(pa.large_string(), len(lowered), [None, lowered.buffers()[1], pa.py_buffer(data)], offset=lowered.offset)
    lists = pc.split_pattern(spaced, " ")
    words, first = lists.flatten(), lists.offsets.to_numpy()
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    filled = pc.not_equal(pc.binary_length(words), 0)
    words, owner = words.filter(filled), owner[filled.to_numpy(zero_copy_only=False)]
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    size = np.diff(offsets)
    if not len(words) or size.max() <= PIECE:
        return words.cast(pa.large_binary()), owner
    parts = np.maximum(1, -(-size // PIECE))
    which = np.repeat(np.arange(len(words)), parts)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    bounds = np.append(offsets[which] + inner * PIECE, offsets[-1])
    return pa.Array.from_buffers(pa.large_binary(), len(which), [None, pa.py_buffer(bounds), words.buffers()[2]]), owner[which]


class Memory:
    """The sums of the pieces that a network has read: a row number for each piece, and one matrix that grows."""

    def __init__(self, languages: int):
        self.rows: dict[bytes, int] = {}
        self.sums = np.zeros((1024, languages), np.float32)

    def add(self, pieces: list[bytes], sums: np.ndarray) -> None:
        """The pieces that came first stay; beyond ``MEMO_PIECES`` none is added."""
        begin, n = len(self.rows), min(len(pieces), MEMO_PIECES - len(self.rows))
        if begin + n > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(len(self.sums), begin + n - len(self.sums)), self.sums.shape[1]), np.float32)])
        self.sums[begin:begin + n] = sums[:n]
        self.rows.update(zip(pieces[:n], range(begin, begin + n)))


@lru_cache(maxsize=1)
def memory(key: str, languages: int) -> Memory:
    """One for each Python worker and network."""
    remember("language", memory.cache_clear)
    return Memory(languages)


def known_sums(net: ByteNet, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log-probabilities and sizes of the distinct pieces; only pieces not met before are read."""
    known, pieces = memory(net.key(), len(net.languages)), distinct.to_pylist()
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    rows = np.fromiter((known.rows.get(p, -1) for p in pieces), np.int64, len(pieces))
    new = np.flatnonzero(rows < 0)
    out = known.sums[rows]
    if len(new):
        fresh = [pieces[i] for i in new.tolist()]
        data = np.frombuffer(b"".join(fresh), np.uint8)
        out[new] = net.word_sums(data, np.cumsum(size[new]) - size[new], size[new])
        known.add(fresh, out[new])
    return out, size


def predict(net: ByteNet, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    pieces, owner = pieces_of(texts)
    coded = pieces.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    sums, size = known_sums(net, coded.dictionary)
    total = np.stack([np.bincount(owner, sums[code, k], minlength=len(texts)) for k in range(len(net.languages))], 1)
    positions = np.bincount(owner, size[code], minlength=len(texts))
    mean = total / np.maximum(positions, 1)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
    best = p.argmax(1)
    names = [net.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
    return names, np.where(letters, p[np.arange(len(best)), best], 0.0)


def training_sample(docs: DataFrame, usable: Column, docs_per_language: int, max_docs: int) -> DataFrame:
    """text, lang of the bounded sample; the choice is made on ids, hashes and sizes alone, then the chosen texts are read.
    Texts that fit come first; of a longer one the beginning is learned from.  Equal rows count once."""
    long = F.octet_length("text") > MAX_BYTES
    read = F.when(long, F.substring("text", 1, MAX_BYTES // 4)).otherwise(F.col("text"))
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select("doc_id", "lang", read.alias("text"), F.xxhash64("text").alias("text_key"), long.alias("long")).filter(F.col("text").rlike(READABLE))
    key = ["lang", "doc_id", "text_key"]
    order = Window.partitionBy("lang").orderBy("long", F.xxhash64("doc_id"), "doc_id", "text_key")
    ids = rows.select(*key, "long").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= docs_per_language)
    ids = ids.orderBy("rank", "lang").limit(max_docs).select(*key)
    chosen = rows.join(F.broadcast(ids), key, "left_semi")  # at most max_docs ids
    return chosen.groupBy(*key).agg(F.min("text").alias("text")).select("lang", "text")


def train(sample: DataFrame, steps: int = 500, max_words: int = 400_000) -> ByteNet | None:
    """Fits a network to the sample; of more than ``max_words`` distinct words the most frequent are used."""
    rows = sorted((r.lang, r.text) for r in sample.collect())
    languages = sorted({lang for lang, _ in rows})
    counts: dict[tuple[bytes, int], int] = {}
    for k, language in enumerate(languages):
        pieces, _ = pieces_of(pa.array([t for lang, t in rows if lang == language], pa.string()))
        for item in pc.value_counts(pieces).to_pylist():
            if item["values"]:
                counts[item["values"], k] = item["counts"]
    if not counts:
        return None
    kept = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:max_words]
    labels = np.array([k for (_, k), _ in kept])
    chances = np.sqrt(np.array([n for _, n in kept], float))
    chances /= np.bincount(labels, chances, minlength=len(languages))[labels]  # languages alike
    net = ByteNet(languages)
    net.fit([w for (w, _), _ in kept], labels, chances, steps)
    return net


def identify(docs: DataFrame, net: ByteNet | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score."""
    if net is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    # Each text is sent once, whether it is kept or not.
    wanted = [*keep, *(["text"] if "text" not in keep else [])]
    place = wanted.index("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        for whole in batches:
            for batch in by_bytes(whole, place, SLICE_BYTES):
                names, scores = predict(net, batch.column(place))
                columns = [*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    rows = docs.select(*wanted)
    schema = rows.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(label, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_remainder(doc_id, 4) == 2, F.lit(False))


def language_model(docs: DataFrame, docs_per_language: int = 250, max_docs: int = 4000) -> ByteNet | None:
    net = train(training_sample(docs, ~held_out(F.col("doc_id")), docs_per_language, max_docs))
    give_back()  # the driver has many stages before it
    return net
