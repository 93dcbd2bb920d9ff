import hashlib
import math

import numpy as np
import pytest

from unirec.llm.vector_codes import Codebooks, Coding, approximated, compress, exact_bound, trained

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(rows, coding=Coding()):
    """Plain Lloyd rounds in Python's integers."""
    kept = [(i, [math.floor(coding.scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(kept[0][1]) // coding.parts
    cut = [[v[p * width:(p + 1) * width] for p in range(coding.parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:coding.entries]] for p in range(coding.parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(coding.rounds):
        for p in range(coding.parts):
            mine = [best(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                group = [c[p] for c, m in zip(cut, mine) if m == k]
                if group:
                    books[p][k] = [sum(x) // len(group) for x in zip(*group)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [best(c[p], books[p]) for p in range(coding.parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + error
    return sorted(((i, label, code, error, totals[label], digest) for i, label, code, error in out), key=str)


def random_rows(n, width, seed=0, grain=8):
    rng = np.random.default_rng(seed)
    # Few distinct values: many ties and repeated vectors.
    return [(i, [float(x) for x in rng.integers(-grain, grain, width) / 256], int(rng.integers(0, 4)) or None) for i in range(n)]


@pytest.mark.parametrize("seed, width, grain", [(0, 16, 2), (1, 16, 9), (2, 64, 300)])
def test_equals_plain_lloyd(spark, seed, width, grain):
    rows = random_rows(220, width, seed, grain)
    rows += [(500, None, 1), (501, [0.0] * (width - 1) + [None], 1), (502, [math.nan] * width, 1), (503, [math.inf] + [0.0] * (width - 1), 2), (7, rows[7][1], 3), (None, rows[9][1], 3), (-5, rows[3][1], None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", code string").repartition(5)
    got = sorted((tuple(r) for r in compress(table).collect()), key=str)
    assert got == lloyd(rows)


def test_wide_numbers_are_exact(spark):
    rows = random_rows(60, 8, 3)
    rows += [(100, [1e30, -1e30] + [0.5] * 6, 1), (101, [9e8] * 8, 2), (102, [-7e6] * 8, 2), (2, [4e7] * 8, 3), (103, [3.0e38] * 8, None)]
    got = sorted((tuple(r) for r in compress(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = lloyd(rows)
    fits = {label: all(w[3] < 1 << 63 for w in want if w[1] == label) for label in {w[1] for w in want}}
    assert [(g[0], g[1], g[2], g[5]) for g in got] == [(w[0], w[1], w[2], w[5]) for w in want]
    assert [(g[3], g[4]) for g in got] == [(w[3] if w[3] < 1 << 63 else None, w[4] if fits[w[1]] and w[4] < 1 << 63 else None) for w in want]


def test_active_entries_agree_with_full_scan():
    rng = np.random.default_rng(5)
    for trial in range(30):
        points = rng.integers(-3, 4, (50, 8)).astype(float)
        old = Codebooks([[[int(x) for x in rng.integers(-3, 4, 4)] for _ in range(6)] for _ in range(2)])
        codes, near, _ = old.assign(points, None, None)
        entries = [[e if rng.random() < 0.5 else [int(x) for x in rng.integers(-3, 4, 4)] for e in b] for b in old.entries]
        now = Codebooks(entries, [[a != b for a, b in zip(x, y)] for x, y in zip(old.entries, entries)])
        some, full = now.assign(points, codes, near), Codebooks(entries).assign(points, None, None)
        assert (some[0] == full[0]).all() and (some[1] == full[1]).all()


def test_few_rows_other_lengths_and_empty(spark):
    rows = [(1, [0.5] * 8, 1), (2, [0.25] * 8, None), (3, [1.0] * 16, 1), (4, [1.0] * 7, 1), (5, [], 1)]
    got = compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    assert compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    _, books = trained(spark.createDataFrame(rows, SCHEMA))
    assert approximated("01" * 8, books) == [0.25] * 8
    assert (2 * exact_bound(8)) ** 2 * 8 <= 1 << 53


def test_doubles_beyond_the_range_of_floats_are_dropped(spark):
    rows = [(1, [1e300] * 8, 1), (2, [3.4e38] * 8, 1), (3, [0.1] * 8, 1)]
    got = compress(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    assert sorted(r.vec_id for r in got) == [2, 3]
