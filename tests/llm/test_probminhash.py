import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from unirec.llm import probminhash
from unirec.llm.bytewords import SPACED, word_hashes, word_spans
from unirec.llm.probminhash import near_duplicates, registers

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(docs):
    """doc index -> set of indexes in its class."""
    sets = [shingle_set(t) for _, t in docs]
    top = list(range(len(docs)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] is None or sets[j] is None:
                same = docs[i] == docs[j]
            else:
                same = len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])
            if same:
                top[find(i)] = find(j)
    classes = defaultdict(list)
    for i in range(len(docs)):
        classes[find(i)].append(i)
    return list(classes.values())


def check(spark, docs):
    df = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, label string").repartition(3)
    got = near_duplicates(df).collect()
    assert len(got) == len(docs)
    want = Counter()
    for members in brute(docs):
        ids = [docs[i][0] for i in members]
        low = min((i for i in ids if i is not None), default=None)
        want.update((docs[i][0], low, len(members)) for i in members)
    assert Counter((g.doc_id, g.class_id, g.class_size) for g in got) == want
    assert sum(g.kept for g in got) == len(brute(docs))


def edited(rng, words, share):
    return [rng.choice("new other edit word".split()) + str(rng.randrange(99)) if rng.random() < share else w for w in words]


def test_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "BLOCK", 8)
    rng = random.Random(2)
    docs = []
    line = "the same line that very many of the texts have in common at their start "
    for g in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 8, 40, 150]))]
        for _ in range(rng.choice([1, 1, 2, 5, 40 if g == 3 else 3])):
            words = edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05]))
            docs.append((len(docs) * 3, line * (g % 2) + " ".join(words) + rng.choice(["", ".", "!\n"])))
    docs += [(9000, None), (9001, ""), (9002, "--"), (9003, "one"), (9004, "One!"), (9005, "one two"), (9, docs[3][1]), (9, docs[3][1]),
             (None, docs[20][1]), (9006, "again and again " * 3000), (9007, "again and again " * 2999)]
    check(spark, docs)


def test_repeated_lines(spark):
    """Plain Jaccard 0.8 or more and counts that differ: 40 pairs in each of three ways."""
    rng = random.Random(8)
    docs = []
    for g in range(40):
        words = [f"g{g}x{i}" for i in range(104)]  # 100 shingles
        line = [f"g{g}y{i}" for i in range(20)]
        for a, b in ((words, words + line * 20), (words, words + line * 100), (words + words[:54], words + words[:54] * 50)):
            tag = f"t{rng.randrange(10 ** 9)}"
            docs += [(len(docs), " ".join(tag + w for w in a)), (len(docs) + 1, " ".join(tag + w for w in b))]
    check(spark, docs)


def test_empty_and_single(spark):
    check(spark, [])
    check(spark, [(1, "a lone document with some words in it")])


@pytest.mark.parametrize("share", [0.3, 0.8, 0.95])
def test_registers_estimate_probability_jaccard(share):
    n = 2000
    both = int(n * share)
    a, b = np.arange(n), np.concatenate([np.arange(both), np.arange(n, 2 * n - both)])
    ids = np.concatenate([a, b]).astype(np.uint64)
    weight = 1 + np.log(1 + ids % 5).astype(float)
    kept = registers(ids, np.repeat([0, 1], n), weight, 2, m=4000)
    w = {int(i): x for i, x in zip(ids, weight)}
    total = [sum(w[i] for i in a.tolist()), sum(w[i] for i in b.tolist())]
    p, q = ({i: w[i] / t for i in s.tolist()} for s, t in zip((a, b), total))
    ratios = np.array([[p.get(d, 0), q.get(d, 0)] for d in set(p) | set(q)])
    want = sum(1 / np.maximum(ratios[:, 0] / x, ratios[:, 1] / y).sum() for x, y in ratios if x and y)
    assert (kept[0] == kept[1]).mean() == pytest.approx(want, abs=0.03)
    assert (kept[0] == kept[1]).all() is np.True_ or share < 1


def test_word_spans():
    texts = ["", " a  b\tC", None, "é-x", "end", "\n", "z"]
    data, begin, end, counts = word_spans(pa.array(texts), SPACED)
    assert [data[a:b].tobytes().decode() for a, b in zip(begin, end)] == ["a", "b", "c", "é-x", "end", "z"]
    assert counts.tolist() == [0, 3, 0, 1, 1, 0, 1]
    data, begin, end, counts = word_spans(pa.array(["x " * 50000 + "same", "same", "emas"]), SPACED)
    hashes = word_hashes(data, begin, end)
    assert hashes[-3] == hashes[-2] != hashes[-1] and len(set(hashes.tolist())) == 3
