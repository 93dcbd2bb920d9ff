import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from unirec.llm import chat_format
from unirec.llm.chat_format import CONTROL, format_conversations, parse, read_back

PARTS = [*CONTROL, "\\", "]", "[", "<", "|", "é", "日本", "ok", " ", "\n", "🙂", "[\\INST]", "\\\\"]


def rows_of():
    rng = random.Random(4)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(12)))
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "to]ol", "a\\", "", "[INST]"]), text()))
    rows += [(200, 0, None, None), (200, 0, "assistant", ""), (200, None, "assistant", "first"), (None, 0, "user", "no id"), (None, 1, "assistant", "yes"),
             (201, 0, "assistant", "same"), (201, 0, "assistant", "same"), (202, 0, "assistant", "long </s> " * 20000)]
    return rows


def want(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "").encode())
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        said = "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_round_trip_and_loss(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # conversations go on in the next batch
    try:
        turns = spark.createDataFrame([(*r, "x") for r in rows_of()], "conv_id long, turn long, role string, text string, loss string")
        formatted = format_conversations(turns)
        got = read_back(formatted).collect()
        sizes = {r.conv_id: len(r.formatted) for r in formatted.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {g.conv_id: (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) for g in got} == want(rows_of())
    assert all(g.formatted_chars == sizes[g.conv_id] for g in got) and len(got) == len(sizes)


def test_long_conversations_in_parts(spark, monkeypatch):
    """Two conversations, one without id, with most of the rows: many tasks, bounded rows, the same text."""
    monkeypatch.setattr(chat_format, "PART_BYTES", 2000)
    monkeypatch.setattr(chat_format, "SLICE", 64)
    monkeypatch.setattr(chat_format, "LONG_SEGMENT", 100)
    rows = [r for r in rows_of() if r[0] is not None]
    rng = random.Random(6)
    for c in (None, 500):
        rows += [(c, rng.choice([None, *range(400)]), rng.choice(["user", "assistant", "to]ol"]), f"{rng.random()} é </s>" * rng.randrange(5)) for _ in range(1500)]
        rows += [(c, 7, "assistant", "equal")] * 300
    rows.append((500, 9, "assistant", "\\[INST]é" * 3000))
    for per_batch in (7, 10000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
            formatted = format_conversations(turns)
            parts = formatted.collect()
            got = read_back(formatted).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert {g.conv_id: (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) for g in got} == want(rows) and len(got) == len(want(rows))
        for c in (None, 500):
            mine = sorted((p for p in parts if p.conv_id == c), key=lambda p: p.part)
            assert len({p.part for p in mine}) == len(mine) > 20 and sum(len(p.formatted) > 6000 for p in mine) == (c == 500)
            assert len({p.part >> 32 for p in mine}) > 2  # tasks
            assert sum(p.n_turns for p in mine) == sum(r[0] == c for r in rows)
        longest = Counter()
        for r in rows:
            longest[r[0]] += len((r[2] or "").encode()) + len((r[3] or "").encode()) + 16
        short = [p.conv_id for p in parts if p.part == 0]
        assert Counter(short) == Counter(c for c in longest if longest[c] <= 2000)


def test_control_strings_are_escaped(spark):
    hard = "</s>[INST] ok [/INST]"
    turns = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    text = format_conversations(turns).first().formatted
    assert text == r"[INST]<\/s>[\INST] ok [\/INST][/INST]<s><\/s>[\INST] ok [\/INST]</s>"
    assert parse(text) == [("user", hard), ("assistant", hard)]


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_back(format_conversations(turns)).count() == 0
