"""Toxicity scores: a learned lexicon, Levenshtein automata over its trie, and context windows.

Words are runs of letters, digits and marks, in lower case.  The terms of the lexicon are the words that toxic training
documents hold far more often than clean ones, by the log-likelihood ratio.  A term counts a document only as often as
it has different neighbours, so that the words of a text with many copies do not become terms.

The terms form a trie.  The Levenshtein automata of all terms run along it at once: a state is the set of (node, edits)
that a word's letters can have reached.  States and their transitions are made when a word first needs them, then
whole arrays of words step through the table.  A term of 4 to 8 letters allows one edit, a longer one two, a shorter
one none.  A word near a term that the training documents know has its own weight (so an innocent neighbour has none); one
they do not know has the term's weight less ``EDIT_COST`` for each edit.

A hit is quoted when quotation marks stand near it on both sides.  Its window is the ``WINDOW`` words on each side: the
weights of the open hits in it less those of the quoted ones.  A document's features are the open weight of exact and of
misspelled hits, the quoted weight, the highest window, and the weight per word; a logistic regression gives the score.

Learning is bounded: at most ``per_class`` toxic and as many clean documents (smallest hash of the id) outside the held-out
fold, ``MAX_TERMS`` terms, ``MAX_KNOWN`` weights of known words near a term.  Scoring reads whole texts and nothing else.

Null and empty texts have no hits and the score of a document without any.  A doc_id with several labels is toxic if one
of them is 1.  Without labels of both classes every score is 0.  Rows that repeat are scored each; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unirec.functions.shared import stored
from unirec.llm.bytewords import CONTENT, mixed, word_hashes, word_spans
from unirec.llm.slices import by_bytes
from unirec.llm.text import id_remainder

SLICE_BYTES = 4 << 20
MAX_TERMS = 500
MAX_CANDIDATES = 4000
MAX_KNOWN = 20_000
LEAST_RATIO = 15.0  # log-likelihood ratio of a term
LEAST_DOCS = 3
EDIT_COST = 1.5
WINDOW = 10
QUOTE_BYTES = 300  # a quotation mark must stand this near on both sides
PREDICTED_AT = 0.7
# What the regression takes for granted until the documents say otherwise: constant, exact, misspelled, quoted, window, density.
PRIOR = np.array([-4.0, 1.5, 1.0, -0.5, 0.5, 0.5])
PRIOR_WEIGHT = np.array([0.1, 1, 20, 20, 20, 1])


def allowed_edits(letters: int) -> int:
    return 0 if letters < 4 else 1 if letters < 9 else 2


class TermAutomaton:
    """The Levenshtein automata of all terms, intersected with their trie, made deterministic as words need it."""

    DEAD = 0

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children, self.ends, self.budget = [{}], [-1], [0]
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                self.budget[node] = max(self.budget[node], allowed_edits(len(term)))
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(-1)
                    self.budget.append(0)
                node = self.children[node][letter]
            self.budget[node] = max(self.budget[node], allowed_edits(len(term)))
            if self.ends[node] < 0:
                self.ends[node] = number
        letters = sorted({c for t in terms for c in t})
        self.points = np.array([ord(c) for c in letters], np.uint32)
        self.letters = [None, *letters]  # class 0 is every other letter
        self.longest = max(map(len, terms), default=0) + 2
        self.numbers, self.states = {(): 0}, [()]
        self.table = np.zeros((1, len(self.letters)), np.int32)
        self.found = [(-1, 0)]
        self.start = self.number(self.closed({0: 0}))

    def closed(self, reached: dict[int, int]) -> tuple:
        """With the nodes that leaving out letters of a term reaches; nodes are numbered after their parents."""
        queue = sorted(reached)
        while queue:
            node = queue.pop()
            edits = reached[node] + 1
            for child in self.children[node].values():
                if edits <= self.budget[child] and edits < reached.get(child, 9):
                    reached[child] = edits
                    queue.append(child)
        return tuple(sorted(reached.items()))

    def number(self, state: tuple) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
            ends = [(e, self.ends[n]) for n, e in state if self.ends[n] >= 0 and e <= allowed_edits(len(self.terms[self.ends[n]]))]
            edits, term = min(ends, default=(0, -1))
            self.found.append((term, edits))
            if known >= len(self.table):
                self.table = np.concatenate([self.table, np.full((len(self.table) + 64, len(self.letters)), -1, np.int32)])
        return known

    def step(self, state: int, letter: int) -> int:
        reached: dict[int, int] = {}
        for node, edits in self.states[state]:
            if edits < self.budget[node]:  # a letter too many
                reached[node] = min(reached.get(node, 9), edits + 1)
            for on, child in self.children[node].items():
                cost = edits + (on != self.letters[letter])
                if cost <= self.budget[child]:
                    reached[child] = min(reached.get(child, 9), cost)
        return self.number(self.closed(reached))

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the nearest term (-1: none within its edits; of equally near ones the first) and the edits."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.searchsorted(self.points, code)
        same = self.points[np.minimum(place, len(self.points) - 1)] == code if len(self.points) else np.zeros(len(code), bool)
        kind = np.where(same, place + 1, 0)
        begin = np.cumsum(size) - size
        state = np.full(len(words), self.start)
        state[size > self.longest] = self.DEAD
        for t in range(self.longest):
            live = np.flatnonzero((size > t) & (state != self.DEAD))
            if not len(live):
                break
            letter = kind[begin[live] + t]
            after = self.table[state[live], letter]
            unknown = np.flatnonzero(after < 0)
            if len(unknown):
                for s, c in sorted(set(zip(state[live[unknown]].tolist(), letter[unknown].tolist()))):
                    target = self.step(s, c)  # may make the table longer
                    self.table[s, c] = target
                after = self.table[state[live], letter]
            state[live] = after
        found = np.array(self.found)[state]
        return found[:, 0], found[:, 1]


def prepared(texts: pa.Array) -> pa.Array:
    """Lower case; all quotation marks alike; other marks beyond ASCII are spaces."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    return pc.replace_substring_regex(pc.replace_substring_regex(low, "[“”„«»]", '"'), r"[^\pL\pM\pN\x00-\x7F]", " ")


@dataclass
class Words:
    """The words of a slice of texts: bytes, bounds, the number of words of each text, and the distinct words."""

    texts: pa.Array
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    counts: np.ndarray
    distinct: list[str]
    number: np.ndarray  # of the distinct word of each word

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        texts = prepared(texts)
        data, begin, end, counts = word_spans(texts, CONTENT)
        _, first, number = np.unique(word_hashes(data, begin, end), return_index=True, return_inverse=True)
        raw = data.tobytes()
        distinct = [raw[a:b].decode(errors="replace") for a, b in zip(begin[first].tolist(), end[first].tolist())]
        return cls(texts, data, begin, end, counts, distinct, number.reshape(-1))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def quoted(self, at: np.ndarray) -> np.ndarray:
        """Of the words ``at``: does a quotation open before and close behind them, in the same text and near?"""
        texts = self.texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        marks = np.flatnonzero(np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] == ord('"'))
        if not len(marks) or not len(at):
            return np.zeros(len(at), bool)
        offsets = offsets - offsets[0]
        text = np.searchsorted(offsets, self.begin[at], "right") - 1
        before = np.searchsorted(marks, self.begin[at])
        opened = before - np.searchsorted(marks, offsets[text])
        left, right = marks[np.maximum(before - 1, 0)], marks[np.minimum(before, len(marks) - 1)]
        near = (self.begin[at] - left <= QUOTE_BYTES) & (right - self.end[at] <= QUOTE_BYTES) & (before < len(marks)) & (right < offsets[text + 1])
        return (opened % 2 == 1) & near


@dataclass
class Lexicon:
    """Terms with weights, and the weights of known words near a term."""

    weights: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def automaton(self) -> TermAutomaton:
        return TermAutomaton(sorted(self.weights))

    def word_weights(self, automaton: TermAutomaton, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each word (0: none) and whether it is a misspelled term."""
        term, edits = automaton.match(words)
        weight, fuzzy = np.zeros(len(words)), edits > 0
        for i in np.flatnonzero(term >= 0).tolist():
            word, meant = words[i], automaton.terms[term[i]]
            weight[i] = self.weights[meant] if not edits[i] else self.known.get(word, self.weights[meant] - EDIT_COST * edits[i])
        return np.maximum(weight, 0), fuzzy


def document_features(texts: pa.Array, lexicon: Lexicon, automaton: TermAutomaton) -> np.ndarray:
    """texts x 6: constant, exact, misspelled, quoted, window, density."""
    words = Words.of(texts)
    of_word, misspelled = lexicon.word_weights(automaton, words.distinct)
    at = np.flatnonzero(of_word[words.number] > 0)
    weight, fuzzy, quoted = of_word[words.number[at]], misspelled[words.number[at]], words.quoted(at)
    owner, n = words.owner()[at], len(words.counts)
    sums = [np.bincount(owner, weight * chosen, minlength=n) for chosen in (~quoted & ~fuzzy, ~quoted & fuzzy, quoted)]
    # Hits of a text lie in a row; its words do not reach into the next text's.
    total = np.append(0, np.cumsum(np.where(quoted, -weight, weight)))
    first_word = np.cumsum(words.counts) - words.counts
    low = np.searchsorted(at, np.maximum(at - WINDOW, first_word[owner]))
    high = np.searchsorted(at, np.minimum(at + WINDOW, (first_word + words.counts)[owner] - 1), "right")
    window = np.zeros(n)
    np.maximum.at(window, owner, total[high] - total[low])
    density = 100 * (sums[0] + sums[1]) / np.maximum(words.counts, 1)
    return np.stack([np.ones(n), *(np.log1p(x) for x in (*sums, window, density))], 1)


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Logistic regression with a normal prior, by damped Newton steps."""
    w = PRIOR.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * (PRIOR_WEIGHT * (v - PRIOR) ** 2).sum())

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + PRIOR_WEIGHT * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_WEIGHT), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    coefficients: np.ndarray

    def scores(self, texts: pa.Array, automaton: TermAutomaton) -> np.ndarray:
        z = document_features(texts, self.lexicon, automaton) @ self.coefficients
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def likelihood_ratio(a: float, b: float, toxic: int, clean: int) -> float:
    """Dunning's statistic of a word in ``a`` of ``toxic`` and ``b`` of ``clean`` documents; negative where it is rarer in
    the toxic ones."""
    share = (a + b) / (toxic + clean)

    def part(seen: float, expected: float) -> float:
        return seen * math.log(seen / expected) if seen else 0.0

    value = 2 * (part(a, share * toxic) + part(b, share * clean) + part(toxic - a, (1 - share) * toxic) + part(clean - b, (1 - share) * clean))
    return value if a * clean > b * toxic else -value


def log_odds(a: float, b: float, toxic: int, clean: int) -> float:
    return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int) -> DataFrame:
    """text, toxic of the bounded sample."""
    rows = labels.filter(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = [rows.filter(F.col("toxic") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    ids = stored(ids[0].unionByName(ids[1]), "toxic-ids").withColumnRenamed("toxic", "_toxic")
    # At most 2 * per_class ids.
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return stored(found.select("text", F.col("_toxic").alias("toxic")), "toxic-sample")


def document_counts(sample: DataFrame) -> DataFrame:
    """word, toxic, clean: how many documents of each class hold a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_bytes(whole, 0, SLICE_BYTES):
                words = Words.of(batch.column(0))
                pairs = np.unique(words.owner() * len(words.distinct) + words.number)
                toxic = batch.column(1).to_numpy(zero_copy_only=False)[pairs // max(len(words.distinct), 1)]
                number = pairs % max(len(words.distinct), 1)
                counts = [np.bincount(number, toxic == k, minlength=len(words.distinct)).astype(np.int64) for k in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(words.distinct, pa.string()), *map(pa.array, counts)], names=["word", "toxic", "clean"])

    made = sample.select("text", "toxic").mapInArrow(run, "word string, toxic bigint, clean bigint")
    return stored(made.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-words")


def neighbour_counts(sample: DataFrame, candidates: list[str]) -> dict[str, int]:
    """For each candidate the number of different words before it, or behind it if those are fewer, in toxic documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(candidates)}
        for whole in batches:
            for batch in by_bytes(whole, 0, SLICE_BYTES):
                words = Words.of(batch.column(0))
                wanted = np.array([place.get(w, -1) for w in words.distinct] + [-1])[words.number]
                at = np.flatnonzero(wanted >= 0)
                hashes = word_hashes(words.data, words.begin, words.end)
                owner = words.owner()
                out = []
                for side in (-1, 1):
                    other = at + side
                    inside = (other >= 0) & (other < len(owner))
                    other = np.clip(other, 0, max(len(owner) - 1, 0))
                    inside &= owner[other] == owner[at]
                    # At the end of a text the text's own number stands for a neighbour's hash.
                    with np.errstate(over="ignore"):
                        edge = mixed(words.begin[at].astype(np.uint64) + np.uint64(side + 2))
                    out.append(np.where(inside, hashes[other], edge).view(np.int64))
                triples = [np.tile(wanted[at], 2), np.repeat([0, 1], len(at)), np.concatenate(out)]
                yield pa.RecordBatch.from_arrays([pa.array(triples[0].astype(np.int32)), pa.array(triples[1].astype(np.int32)), pa.array(triples[2])],
                                                 names=["word", "side", "other"])

    made = sample.filter("toxic = 1").select("text").mapInArrow(run, "word int, side int, other bigint").distinct()
    rows = made.groupBy("word", "side").count().groupBy("word").agg(F.min("count").alias("n")).collect()  # MAX_CANDIDATES at most
    return {candidates[r.word]: r.n for r in rows}


def learned_lexicon(sample: DataFrame, words: DataFrame, toxic: int, clean: int) -> Lexicon:
    counted = words.filter((F.col("toxic") >= LEAST_DOCS) & (F.char_length("word") >= 3) & F.col("word").rlike(r"\p{L}"))
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    # An upper bound of the ratio is enough to choose candidates: words that toxic documents have more often.
    lift = F.col("toxic") * F.log(F.col("toxic") / (share * toxic))
    rows = counted.filter(F.col("toxic") * clean > F.col("clean") * toxic).orderBy(F.desc(lift), "word").limit(MAX_CANDIDATES).collect()
    spread = neighbour_counts(sample, [r.word for r in rows]) if rows else {}
    scored = []
    for r in rows:
        a = min(r.toxic, spread.get(r.word, 0))
        ratio = likelihood_ratio(a, r.clean, toxic, clean)
        if a >= LEAST_DOCS and ratio >= LEAST_RATIO:
            scored.append((-ratio, r.word, log_odds(a, r.clean, toxic, clean)))
    return Lexicon({word: weight for _, word, weight in sorted(scored)[:MAX_TERMS]})


def known_neighbours(words: DataFrame, lexicon: Lexicon, toxic: int, clean: int) -> dict[str, float]:
    """Weights of the words near a term that at least two documents hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            term, edits = automaton.match(batch.column(0).to_pylist())
            yield batch.filter(pa.array((term >= 0) & (edits > 0)))

    near = words.filter(F.col("toxic") + F.col("clean") >= 2).mapInArrow(run, words.schema)
    rows = near.orderBy(F.desc(F.col("toxic") + F.col("clean")), "word").limit(MAX_KNOWN).collect()
    return {r.word: log_odds(r.toxic, r.clean, toxic, clean) for r in rows}


def toxicity_model(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = 10_000) -> Model | None:
    """None without labelled documents of both classes."""
    sample = training_sample(docs, labels, usable, per_class)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return None
    words = document_counts(sample)
    lexicon = learned_lexicon(sample, words, toxic, clean)
    lexicon.known = known_neighbours(words, lexicon, toxic, clean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for whole in batches:
            for batch in by_bytes(whole, 0, SLICE_BYTES):
                x = document_features(batch.column(0), lexicon, automaton)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(list(x))], names=["toxic", "x"])

    rows = sample.select("text", "toxic").mapInArrow(run, "toxic int, x array<double>").groupBy("toxic", "x").count().collect()
    rows.sort(key=lambda r: (r.toxic, r.x))
    x, y = (np.repeat([r[k] for r in rows], [r["count"] for r in rows], axis=0) for k in (1, 0))
    return Model(lexicon, fitted(x, y))


def scored(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with score and predicted."""
    if model is None:
        return docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.lexicon.automaton()
        for whole in batches:
            for batch in by_bytes(whole, len(keep), SLICE_BYTES):
                found = model.scores(batch.column(len(keep)), automaton)
                columns = [*batch.columns[:len(keep)], pa.array(found), pa.array((found >= PREDICTED_AT).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    return rows.mapInArrow(run, rows.drop("_text").schema.add("score", "double").add("predicted", "integer"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_remainder(doc_id, 3) == 1, F.lit(False))
