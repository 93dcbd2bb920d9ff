import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from unirec.llm.mixing import MOST, SHARE, WEIGHTS, hypergeometric, mix, permuted, taken_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Reshares the excess by weight until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, free, out = SHARE * sum(sizes.values()), set(order), {}
    while free:
        part = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if part[s] > MOST * sizes[s]}
        if not over:
            return out | part
        for s in over:
            out[s] = MOST * sizes[s]
            left -= out[s]
        free -= over
    return out


def rows_of(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range((i * 37) % 90)), "src%d" % (0 if i % 3 else i % 7)) for i in range(300)]
    rows += [(500, None, "src0"), (501, "", None), (502, "one two  three\nfour", None), (7, "again and again", "src1"), (7, "again and again", "src1"),
             (503, "v " * 5000, "long")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("block,shard", [(16, 40), (512, 4096)])
def test_targets_are_met_exactly(spark, block, shard):
    docs = rows_of(spark).withColumn("size", F.lit("clash")).withColumn("s", F.lit(1))
    got = taken_words(docs, block, shard, 5).collect()
    assert len(got) == docs.count()
    sizes, taken = Counter(), Counter()
    source = {(r.doc_id, len(WORD.findall(r.text or ""))): r.source for r in docs.collect()}
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = targets(sizes)
    for r in got:
        s = source[r.doc_id, r.size]
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = taken_words(docs, block, shard, 5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_shards_hold_disjoint_blocks_and_even_counts(spark):
    docs = rows_of(spark)
    rows, draws = mix(docs, 16, 8, 5)
    draws = draws.collect()
    blocks = defaultdict(set)
    seen = Counter()
    for d in draws:
        blocks[d.shard].add(d.place)
        seen.update((d.row_id, w, d.in_pass) for w in range(d.first_word, d.first_word + d.n_words))
    assert max(seen.values()) == 1
    counts = [len(b) for b in blocks.values()]
    assert max(counts) <= 8 and max(counts) - min(counts) <= 1
    assert all(b == set(range(len(b))) for b in blocks.values())


def test_empty_table(spark):
    assert taken_words(rows_of(spark).limit(0), 16, 8, 5).count() == 0


def test_permutation_is_one_to_one(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_hypergeometric_has_its_distribution(spark):
    n, good, draws, trials = 50, 20, 15, 20000
    k = hypergeometric((F.col("id") + 0.5) / trials, F.lit(n).cast("long"), F.lit(good).cast("long"), F.lit(draws).cast("long"))
    got = Counter(r.k for r in spark.range(trials).select(k.alias("k")).collect())
    from math import comb
    for x in range(draws + 1):
        assert got[x] / trials == pytest.approx(comb(good, x) * comb(n - good, draws - x) / comb(n, draws), abs=1e-3)
    edge = spark.range(1).select(
        hypergeometric(F.lit(0.5), F.lit(5).cast("long"), F.lit(5).cast("long"), F.lit(3).cast("long")).alias("a"),
        hypergeometric(F.lit(0.5), F.lit(5).cast("long"), F.lit(0).cast("long"), F.lit(3).cast("long")).alias("b")).first()
    assert edge.a == 3 and edge.b == 0


def test_shards_and_places_reach_the_result(spark):
    """The tree deals all blocks to shards of nearly one size, and each shard's order is a shuffle of its own."""
    rows = taken_words(rows_of(spark), 16, 40, 5).collect()
    at = defaultdict(lambda: defaultdict(int))
    for r in rows:
        pieces = [tuple(map(int, b.split(":"))) for b in r.blocks.split(",")] if r.blocks else []
        assert pieces == sorted(pieces) and sum(n for _, _, _, n in pieces) == r.taken
        for shard, place, first, n in pieces:
            assert 0 <= first and first + n <= r.size
            at[shard][place] += n
    assert len(at) > 3 and sorted(at) == list(range(len(at)))
    for places in at.values():
        assert sorted(places) == list(range(len(places))) and max(places.values()) <= 16
    sizes = [len(p) for p in at.values()]
    assert max(sizes) <= 40 and max(sizes) - min(sizes) <= 1
    # One document's blocks lie in many shards, and not in the order of its words.
    long = next(r for r in rows if r.doc_id == 503)
    pieces = [tuple(map(int, b.split(":"))) for b in long.blocks.split(",")]
    firsts = [first for _, _, first, _ in pieces]
    assert len({shard for shard, *_ in pieces}) > 3 and firsts != sorted(firsts)
    assert taken_words(rows_of(spark), 16, 40, 6).select("blocks").distinct().collect() != taken_words(rows_of(spark), 16, 40, 5).select("blocks").distinct().collect()
