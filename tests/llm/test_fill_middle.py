import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unirec.llm import fill_middle
from unirec.llm.fill_middle import Rates, fill_in_middle, long_pieces, pieces, restored
from unirec.llm.slices import by_bytes


def by_hand(doc_id, text, transformed=90):
    text = text or ""
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= transformed:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", None, "a", "é𝄞é ß", "with <P> inside", "<M>", "<<S", "S><P", "line\n\r\0end", "𝄞" * 50, "word " * 400]


@pytest.mark.parametrize("slice_bytes", [2 << 20, 64])
def test_equals_plain_slicing(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", slice_bytes)
    rows = [(i if i % 7 else None, TEXTS[i % len(TEXTS)], "clash") for i in range(300)] + [(5, "same", ""), (5, "same", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)
    found = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = sorted((-1 if d is None else d, *by_hand(d, t), t or "") for d, t, _ in rows)
    key = lambda r: tuple((x is None, x) for x in r)
    got = [(-1 if r.doc_id is None else r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_long_text_in_segments_equals_whole(monkeypatch):
    text = "aß𝄞\n" * 500
    whole = [p[0].as_py() for p in pieces(pa.array([text]), pa.array([700]), pa.array([1500]))]
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 101)
    parts = [p[0].as_py() for p in long_pieces(pa.array([text]), 700, 1500)]
    assert parts == whole == [text[:700], text[700:1500], text[1500:]]


def test_empty_table_and_rates(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert fill_in_middle(empty).collect() == []
    docs = spark.createDataFrame([("x1", "abc")], "doc_id string, text string")
    assert fill_in_middle(docs, Rates(transformed=0)).first().output == "abc"


def test_slices_follow_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "bbbb", "c" * 50, "", "d"])], names=["t"])
    assert [s.num_rows for s in by_bytes(batch, 0, 6)] == [3, 1, 2]
    assert [s.num_rows for s in by_bytes(batch, 0, 100, 4)] == [4, 2]
    assert list(by_bytes(batch.slice(0, 0), 0, 6)) == []
