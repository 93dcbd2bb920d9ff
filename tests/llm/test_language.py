import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unirec.llm.language import MAX_BYTES, PIECE, ByteNet, held_out, identify, language_model, pieces_of, predict, training_sample


def test_pieces_cover_whole_texts():
    texts = ["Ab, c1d", None, "", "É" * 50, "12 -", "x" * (2 * PIECE + 3)]
    pieces, owner = pieces_of(pa.array(texts))
    assert [p.decode(errors="replace") for p in pieces.to_pylist()[:3]] == ["ab", "c", "d"]
    assert b"".join(p for p, o in zip(pieces.to_pylist(), owner) if o == 3) == ("é" * 50).encode()
    assert [len(p) for p, o in zip(pieces.to_pylist(), owner) if o == 5] == [PIECE, PIECE, 3]
    assert set(owner.tolist()) == {0, 3, 5}


def test_gradients_equal_differences():
    net = ByteNet(["a", "b"], size=3)
    for g in net.parts:
        g.inputs, g.hidden = g.inputs.astype(np.float64), g.hidden.astype(np.float64)
    net.out = net.out.astype(np.float64)
    codes = np.array([[97, 98], [99, 256], [97, 256]])
    live = np.array([[1, 1], [1, 0], [1, 0]], bool)

    def loss():
        ahead, _ = net.parts[0].run(codes, live, keep=True)
        return float((ahead.astype(np.float64) * live[:, :, None]).sum())

    _, trace = net.parts[0].run(codes, live, keep=True)
    d_inputs, d_hidden = net.parts[0].back(codes, live, trace, np.ones((3, 2, 3)) * live[:, :, None])
    for array, grad, at in ((net.parts[0].inputs, d_inputs, (97, 4)), (net.parts[0].inputs, d_inputs, (98, 8)), (net.parts[0].hidden, d_hidden, (1, 2)), (net.parts[0].hidden, d_hidden, (0, 7))):
        old = array[at]
        array[at] = old + 1e-2
        up = loss()
        array[at] = old - 1e-2
        down = loss()
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = language_model(docs)
    got = identify(docs.withColumn("score", F.lit("clash")), net, ["doc_id", "lang"]).withColumn("held_out", held_out(F.col("doc_id"))).collect()
    held = [g for g in got if g.held_out]
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got)
    assert len(held) > 20 and np.mean([g.lang_pred == g.lang for g in held]) > 0.93
    assert all(0 <= g.score <= 1 for g in got)
    names, scores = predict(net, pa.array([None, "", "123 --", "the and of with that"], pa.string()))
    assert names[:3] == ["und"] * 3 and scores[:3].tolist() == [0, 0, 0] and names[3] == "en"


def test_sample_is_bounded_and_spares_the_held_out(spark):
    docs = spark.createDataFrame([(i, f"text {i}", None if i % 5 == 0 else "ab"[i % 2]) for i in range(200)] + [(None, "t", "a"), (3, None, "b")],
                                 "doc_id long, text string, lang string")
    rows = training_sample(docs, ~held_out(F.col("doc_id")), 10, 15).collect()
    assert 0 < len(rows) <= 15
    ids = [int(r.text.split()[1]) for r in rows]
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 and i % 5 for i in ids)


def test_long_and_empty_texts_leave_no_places_open(spark):
    rows = [(i, ["x " * MAX_BYTES, None, "", "12 -"][i % 4], "a") for i in range(60)] + [(i, f"fits {i}", "a") for i in range(60, 66)]
    rows += [(i, "only long ones " * MAX_BYTES, "b") for i in range(70, 73)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = training_sample(docs, F.lit(True), 5, 100).collect()
    assert sum(r.lang == "a" and r.text.startswith("fits") for r in got) == 5 and sum(r.lang == "a" for r in got) == 5
    assert sum(r.lang == "b" for r in got) == 3 and all(0 < len(r.text.encode()) <= MAX_BYTES for r in got)


def test_sample_of_a_repeated_id_is_the_same_each_time(spark):
    docs = spark.createDataFrame([(7, f"text {i}", "a") for i in range(300)] + [(7, "equal", "a")] * 50, "doc_id long, text string, lang string")
    first, second = (sorted(r.text for r in training_sample(docs.repartition(n, F.rand(n)), F.lit(True), 20, 10).collect()) for n in (3, 7))
    assert first == second and len(set(first)) == len(first) == 10


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_model(docs) is None
    assert identify(docs, None, ["doc_id"]).first() == (1, "und", 0.0)
    assert identify(docs.limit(0), None, ["doc_id"]).count() == 0


def test_memory_follows_the_slices():
    """300 texts of 160 kB, read in slices in a process of its own."""
    script = """
import resource, sys
import numpy as np, pyarrow as pa
from unirec.llm.language import SLICE_BYTES, ByteNet, predict
from unirec.llm.probminhash import ROWS, sliced_shingles
from unirec.llm.slices import by_bytes
rng = np.random.default_rng(1)
letters = np.frombuffer(b"abcdefghij     ", np.uint8)
texts = pa.array([letters[rng.integers(0, len(letters), 160_000)].tobytes().decode() for _ in range(300)])
net = ByteNet(["a", "b"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for part in by_bytes(pa.RecordBatch.from_arrays([texts], names=["t"]), 0, SLICE_BYTES):
    predict(net, part.column(0))
middle = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
sliced_shingles(texts)
print(middle - before, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - middle)
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    read, hashed = map(int, out.stdout.split())
    assert read < 500_000 and hashed < 700_000  # kB
