import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unirec.llm.toxicity import (EDIT_COST, PRIOR, PRIOR_WEIGHT, QUOTE_BYTES, WINDOW, Lexicon, TermAutomaton, allowed_edits, document_features, fitted, held_out, likelihood_ratio,
                                 neighbour_counts, scored, toxicity_model, training_sample)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def nearest_term(word, terms):
    found = [(distance(word, t), i) for i, t in enumerate(terms)]
    found = [(d, i) for d, i in found if d <= allowed_edits(len(terms[i]))]
    d, i = min(found, default=(0, -1))
    return i, d


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(2, 11))) for _ in range(40)})
    words = ["", "a", "z" * 40] + terms + ["".join(rng.choice("abcé𝄞") for _ in range(rng.randint(1, 13))) for _ in range(1500)]
    for t in terms:
        for _ in range(10):
            w = list(t)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = rng.choice([[], ["b"], ["x"]])
            words.append("".join(w))
    term, edits = TermAutomaton(terms).match(words)
    assert list(zip(term.tolist(), edits.tolist())) == [nearest_term(w, terms) for w in words]
    term, _ = TermAutomaton([]).match(["a", "b"])
    assert term.tolist() == [-1, -1]


def words_of(text):
    """(word, begin, end) in the bytes of the lower-cased text."""
    low = "".join('"' if c in "“”„«»" else c for c in (text or "").lower())
    low = "".join(c if c.isascii() or c.isalnum() else " " for c in low)
    out, at, word = [], 0, None
    for c in low + " ":
        if c.isalnum():
            word = word or [at, ""]
            word[1] += c
        elif word:
            out.append((word[1], word[0], at))
            word = None
        at += len(c.encode())
    return low.encode(), out


def features_by_hand(text, lexicon):
    raw, words = words_of(text)
    terms = sorted(lexicon.weights)
    hits = []
    for k, (w, a, b) in enumerate(words):
        i, d = nearest_term(w, terms)
        if i < 0:
            continue
        weight = lexicon.weights[terms[i]] if d == 0 else lexicon.known.get(w, lexicon.weights[terms[i]] - EDIT_COST * d)
        if weight <= 0:
            continue
        left, right = raw.rfind(b'"', 0, a), raw.find(b'"', b)
        quoted = raw[:a].count(b'"') % 2 == 1 and a - left <= QUOTE_BYTES and right >= 0 and right - b <= QUOTE_BYTES
        hits.append((k, weight, d > 0, quoted))
    sums = [sum(w for _, w, f, q in hits if not q and not f), sum(w for _, w, f, q in hits if not q and f), sum(w for _, w, f, q in hits if q)]
    window = max([sum(-w if q else w for k, w, _, q in hits if abs(k - at) <= WINDOW) for at, *_ in hits], default=0)
    return [1, *(math.log1p(x) for x in (*sums, max(window, 0), 100 * (sums[0] + sums[1]) / max(len(words), 1)))]


def test_features_equal_a_plain_loop():
    lexicon = Lexicon({"rotten": 3.0, "blockhead": 4.0, "é": 1.0, "bad": 2.0}, {"rotted": -1.0, "gotten": 0.5})
    rng = random.Random(1)
    bank = ["rotten", "Rotten!", "roten", "rotted", "gotten", "blokhead", "blockhed", "x", "the", "bad", "bed", '"', '"rotten', '"', "“bad”", "É", "…", "—", "1", "a" * 400]
    texts = [" ".join(rng.choice(bank) for _ in range(rng.randint(0, 60))) for _ in range(200)] + ["", None, '"', "rotten", '"rotten"', 'he said "you rotten blockhead" and left']
    got = document_features(pa.array(texts, pa.string()), lexicon, lexicon.automaton())
    assert np.allclose(got, [features_by_hand(t, lexicon) for t in texts])
    assert document_features(pa.array([], pa.string()), lexicon, lexicon.automaton()).shape == (0, 6)


def corpus():
    rng = random.Random(9)
    bank = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(bank) for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grubworm", "nitwitted", "blighter"]))
        docs.append((i, " ".join(words), "clash"))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    # Copies of one toxic text: its words are no terms.
    docs += [(2000 + k, "entirely ordinary sentence around one blighter", "x") for k in range(60)]
    labels += [(2000 + k, 1, 1) for k in range(60)]
    return docs, labels


def test_held_out_and_misspelled(spark):
    docs, labels = corpus()
    extra = [(3000, "you gru8worm and nitwited blightr, you grubwurm", ""), (3001, None, None), (3002, "", ""), (None, "plain", ""), (3, docs[3][1], "again")]
    table = spark.createDataFrame(docs + extra, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels + [(None, 1, 1), (7, 1, None), (7, 0, 0), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity_model(table, marks, ~held_out(F.col("doc_id")))
    assert set(model.lexicon.weights) == {"grubworm", "nitwitted", "blighter"}
    out = scored(table, model, ["doc_id"]).collect()
    assert len(out) == len(docs) + len(extra) and out[0].asDict().keys() == {"doc_id", "score", "predicted"}
    got = {r.doc_id: r for r in out}
    assert all(got[i].predicted == (i % 6 == 0) for i in range(900))
    assert got[3000].predicted == 1 and got[3001].score == got[3002].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity_model(docs, marks, F.lit(True)) is None
    assert [tuple(r) for r in scored(docs, None, ["doc_id"]).collect()] == [(1, 0.0, 0), (2, 0.0, 0)]
    assert toxicity_model(docs.limit(0), marks, F.lit(True)) is None


def test_sample_is_bounded_and_spares_the_held_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    rows = training_sample(docs, marks, ~held_out(F.col("doc_id")), 20).collect()
    assert sorted(r.toxic for r in rows) == [0] * 20 + [1] * 20
    assert all(zlib.crc32(r.text[1:].encode()) % 3 != 1 for r in rows)


def test_neighbours(spark):
    sample = spark.createDataFrame([("x t y", 1), ("x t z", 1), ("x t y", 1), ("q t w", 0), ("t", 1)], "text string, toxic int")
    assert neighbour_counts(sample, ["t", "y", "none"]) == {"t": 2, "y": 1}
    assert likelihood_ratio(5, 0, 10, 90) > 15 and likelihood_ratio(0, 20, 10, 90) < 0


def test_regression_reaches_the_minimum():
    rng = np.random.default_rng(2)
    x = np.concatenate([np.ones((300, 1)), rng.random((300, 5))], 1)
    y = (x[:, 1] + 0.3 * rng.random(300) > 0.6).astype(float)
    w = fitted(x, y)
    assert np.abs(x.T @ (1 / (1 + np.exp(-x @ w)) - y) + PRIOR_WEIGHT * (w - PRIOR)).max() < 1e-5
    assert likelihood_ratio(1, 9, 10, 90) == pytest.approx(0, abs=1e-9)
