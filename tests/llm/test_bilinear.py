import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from unirec.llm import bilinear
from unirec.llm.bilinear import LogBilinear, score_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def check(spark, docs):
    df = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, words string").repartition(3)
    got = score_documents(df).collect()
    counts = Counter(t for d, x in docs if not held(d) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((d is None, d or 0), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), held(d), n,
                   sum(log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x))) for d, x in docs)
    have = sorted(((g.doc_id is None, g.doc_id or 0), g.n_tokens, g.n_known, g.held_out, g.train_tokens, g.base_score) for g in got)
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert [h[5] for h in have] == pytest.approx([w[5] for w in want])
    assert all(g.score < 0 and np.isfinite(g.score) for g in got)
    return got


def test_counts_and_base_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bilinear, "ROWS", 7)
    docs = [(i, " ".join(f"{'Le' if i % 2 else 'the'} word{(i * k) % 50}{'eau' if i % 2 else 'ing'}" for k in range(i % 23))) for i in range(200)]
    docs += [(300, None), (301, ""), (302, " \t\n"), (None, "no id here"), (5, "again"), (5, "again"), (303, "long " * 4000), (304, "É é xyz x z" * 3)]
    got = check(spark, docs)
    # Words follow words of their own language: the model is better than single counts on unseen documents.
    long = [g for g in got if g.held_out and g.n_tokens > 10]
    assert sum(g.score for g in long) > sum(g.base_score for g in long)


def test_empty_and_wordless_tables(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check(spark, [(1, None), (2, "")])
    only = next(i for i in range(100) if held(i))
    check(spark, [(only, "nothing is in training")])


def test_noise_contrastive_estimation_finds_the_distribution():
    rng = np.random.default_rng(0)
    truth = rng.dirichlet(np.ones(12), 12)
    pairs = truth * rng.integers(500, 5000, 12)[:, None]
    model = LogBilinear(pairs.sum(0))
    model.fit(pairs, steps=1500)
    got = 10.0 ** model.log10_probabilities()
    assert got.sum(1) == pytest.approx(np.ones(12), abs=1e-5)
    assert np.abs(got - truth).max() < 0.02
