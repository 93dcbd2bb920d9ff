import hashlib
import random
import re

from unirec.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(13, len(v))
            windows = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if n else set()
            at = [k for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in windows] if n else []
            if at and item is not None:
                ids.add(str(item))
            hit.update(p for k in at for p in range(k, k + n))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def check(spark, docs, items):
    d = spark.createDataFrame([(a, b, "x", "y") for a, b in docs], "doc_id long, text string, words string, item long".replace("item long", "v string"))
    b = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, print int")
    got = decontaminate(d, b).drop("text_key").collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, items)


def test_every_length_of_item_and_edge_rows(spark):
    rng = random.Random(1)
    vocabulary = ["alpha", "beta", "gamma", "delta", "été", "Straße", "x1"]
    items = [(n, " ".join(rng.choice(vocabulary) + str(rng.randrange(9)) for _ in range(n))) for n in range(0, 40)]
    items += [(100, None), (101, ""), (102, "!!"), (5, items[5][1]), (None, items[20][1]), (200, items[30][1]), (17, items[33][1])]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(5)):
            v = words(rng.choice(items)[1])
            a = rng.randrange(len(v) + 1)
            parts += v[a:a + rng.randrange(1, 30)] + [f"filler{rng.randrange(50)}" for _ in range(rng.randrange(20))]
        docs.append((i, " ".join(p.upper() if rng.random() < .1 else p for p in parts)))
    docs += [(500, None), (501, ""), (502, "\x00 --"), (7, "again"), (7, "again"), (None, items[25][1]), (503, (items[35][1] + ". ") * 60)]
    check(spark, docs, items)


def test_long_items_only(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = [(1, text), (2, " ".join(f"w{i}" for i in range(12))), (3, "a b " + " ".join(f"w{i}" for i in range(5, 18)) + " c"), (4, "w0 " * 50)]
    check(spark, docs, [(1, text), (2, "w0 " * 20)])


def test_empty_tables(spark):
    check(spark, [(1, "some words here")], [])
    check(spark, [], [(1, "some words here")])
    check(spark, [(1, "some words")], [(1, None), (2, "...")])
