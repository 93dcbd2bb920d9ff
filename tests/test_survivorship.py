"""Golden records field by field: against a plain loop, in any order of batches, stored and in one go."""

import itertools
import random

import pytest

from unirec.functions.shared import new_folder
from unirec.operators.survivorship import Survivorship, field_states, golden_records, merge_states, provenance
from unirec.sinks.golden import SurvivorshipTable

SCHEMA = "id long, name string, size int, _source string, _event_type string, _event_timestamp string"
RULE = Survivorship(("id",), ("name", "size"), ("erp", "crm"), newest=("size",))


def events(n=160, seed=3):
    rng = random.Random(seed)
    return [(rng.randint(1, 12), rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]), rng.choice(["erp", "crm", "web", "old"]),
             "DELETE" if rng.random() < 0.12 else "UPDATE", f"2024-01-{rng.randint(1, 28):02d}T00:00:00.{k:06d}+00:00") for k in range(n)]


def by_hand(rows, rule=RULE):
    out = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        gone = {}
        for r in mine:
            if r[4] == "DELETE":
                gone[r[3]] = max(gone.get(r[3], ""), r[5])
        live = [r for r in mine if r[4] != "DELETE" and r[5] > gone.get(r[3], "")]
        if not live:
            continue
        trust = {s: i for i, s in enumerate(rule.sources)}
        record = []
        for i, field in ((1, "name"), (2, "size")):
            newest = {}
            for r in live:
                if r[i] is not None and (r[3] not in newest or r[5] > newest[r[3]][5]):
                    newest[r[3]] = r
            if field in rule.newest:
                best = max(newest.values(), key=lambda r: r[5], default=None)
            else:
                best = max(newest.values(), key=lambda r: (-trust.get(r[3], len(trust)), r[5]), default=None)
            record.append((best[i], best[3], best[5]) if best else (None, None, None))
        out[key] = tuple(record)
    return out


def found(states):
    values = {r["id"]: (r["name"], r["size"]) for r in golden_records(states, RULE).collect()}
    where = {(r["id"], r["field"]): (r["source"], r["time"]) for r in provenance(states, RULE).collect()}
    return {k: tuple((v, *where[k, f]) for v, f in zip(values[k], RULE.fields)) for k in values}


def test_equals_a_plain_loop(spark):
    rows = events()
    assert found(field_states(spark.createDataFrame(rows, SCHEMA), RULE)) == by_hand(rows)
    assert found(field_states(spark.createDataFrame([], SCHEMA), RULE)) == {}


def test_batches_merge_in_any_order(spark):
    rows = events(60, 8)
    rows += [(1, "tie", 9, "erp", "UPDATE", "2024-02-01T00:00:00+00:00"), (1, "eit", 8, "erp", "UPDATE", "2024-02-01T00:00:00+00:00")]
    parts = [field_states(spark.createDataFrame(rows[k::3], SCHEMA), RULE) for k in range(3)]
    results = []
    for order in list(itertools.permutations(range(3)))[::2]:
        state = parts[order[0]]
        for k in (order[1], order[2], order[1]):  # one of them twice
            state = merge_states(state, parts[k], RULE)
        results.append(sorted(found(state).items()))
    assert results[0] == results[1] == results[2] == sorted(found(field_states(spark.createDataFrame(rows, SCHEMA), RULE)).items())


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_stored_states(spark, order):
    rows = events(200, 5)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SurvivorshipTable(spark, new_folder(spark, "survivors"), schema, RULE, buckets=4)
    for number, k in enumerate(order):
        batch = rows[k::4] + [(None, "x", 1, "erp", "UPDATE", "2024-01-01T00:00:00+00:00")]
        table.write_events(spark.createDataFrame(batch, SCHEMA), number)
        if number % 2:
            table.compact([0, 1, 3] if number == 1 else None)
    table.write_events(spark.createDataFrame(rows[order[3]::4], SCHEMA), 3)
    assert found(table.read()) == by_hand(rows)
    assert table.records().columns == ["id", "name", "size"] and table.quarantine().count() == 3
