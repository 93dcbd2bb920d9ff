from collections import defaultdict

import pytest

from unirec.llm import sharding
from unirec.llm.sharding import assign_shards, write_shards


def rows_of():
    rows = [(i, "x" * (i * 37 % 500), "hot" if i % 3 else f"s{i % 11}") for i in range(400)]
    rows += [(1000, None, None), (1001, "", None), (1002, "y" * 5000, "hot"), (None, "no id", "a")]
    return rows + [(7, "same row", "hot")] * 50


@pytest.mark.parametrize("sent", [100_000, 0])
@pytest.mark.parametrize("key", [["doc_id"], ["source"]])
def test_shards_fit_and_hold_every_row(spark, monkeypatch, sent, key):
    monkeypatch.setattr(sharding, "SENT_LEAVES", sent)
    limit = 300 if key == ["doc_id"] else 4000
    docs = spark.createDataFrame([(*r, "clash") for r in rows_of()], "doc_id long, text string, source string, depth string")
    got = assign_shards(docs, limit, key).collect()
    assert sorted(((g.doc_id, g.text, g.source) for g in got), key=repr) == sorted(rows_of(), key=repr)
    shards = defaultdict(list)
    for g in got:
        shards[g.shard].append(g)
    for name, rows in shards.items():
        size = sum(len(r.text or "") for r in rows)
        assert size <= limit or len(rows) == 1
        assert {r.shard_bytes for r in rows} == {size}
    # Only oversized buckets split: the bucket above two sibling leaves is over the limit.
    plain = {n for n in shards if "+" not in n}
    for name in plain:
        if len(name) > 1:
            under = [n for n in shards if n.startswith(name[:-1])]
            assert sum(len(r.text or "") for n in under for r in shards[n]) > limit


def test_written_shards_read_back(spark, tmp_path):
    docs = spark.createDataFrame(rows_of(), "doc_id long, text string, source string")
    write_shards(docs, f"{tmp_path}/s", 4000, ["doc_id"])
    back = spark.read.schema("doc_id long, text string, source string, shard string").parquet(f"{tmp_path}/s")
    assert sorted(map(tuple, back.drop("shard").collect()), key=repr) == sorted(rows_of(), key=repr)


def test_one_shard_and_empty(spark):
    docs = spark.createDataFrame(rows_of(), "doc_id long, text string, source string")
    assert {r.shard for r in assign_shards(docs, 10 ** 9, ["doc_id"]).collect()} == {"b"}
    assert assign_shards(docs.limit(0), 100, ["doc_id"]).count() == 0
