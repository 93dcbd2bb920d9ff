"""Field mapping: payload JSON of any source -> one typed canonical struct, without Python per row.

Two routes give the same answer.

* Direct route.  The payload is parsed once by ``from_json`` into a struct whose fields carry the
  source's own spellings and the canonical types.  It applies when every payload key that means
  something is spelled as declared, which is what a source writes all day long.
* General route.  The payload is parsed into key/value entries; keys are matched exactly, then in
  lower, then in upper case, and the last entry of a canonical field wins.  Rows take it when a key
  has another spelling, when a value needs its JSON kind to be judged, or when the payload is bad.

The choice is made per row by lazily evaluated ``when`` branches, so neither route costs the other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unirec.functions.values import (
    JsonValue, kind_of, lenient_text, no_value, string_token, text_of,
)
from unirec.operators.latest import PLACE
from unirec.spec import OTHER_MAPPINGS, SOURCE_MAPPINGS, EntitySpec

STRICT = "strict"
LENIENT = "lenient"
JSON_OPTIONS = {"allowSingleQuotes": "false"}
OP_CODES = {"identity": 0, "upper": 1, "lower": 2, "int": 3, "float": 4}
KEY_SEPARATOR = "\u0001"
# Text that every float grammar reads alike; anything else goes to the general route.
PLAIN_DECIMAL = r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


@dataclass(frozen=True)
class Target:
    """One canonical field to fill; ``hidden`` ones only take part in the strict check."""

    index: int
    name: str
    dtype: T.DataType
    ops: tuple[str, ...]
    hidden: bool = False

    def code(self, op: str) -> int:
        return self.index * len(OP_CODES) + OP_CODES[op]


@dataclass(frozen=True)
class SourceRule:
    """Compiled mapping list: every registered spelling, and the fields of the direct route."""

    group: str
    spellings: dict[str, tuple[str, str]]          # spelling -> (canonical field, op)
    direct: dict[str, tuple[str, str]] | None      # canonical field -> (source field, op)

    @property
    def forms(self) -> list[list[str]]:
        """The declared spellings, all in lower case, all in upper case; without repeats."""
        declared = [s for s, _ in self.direct.values()]
        forms: list[list[str]] = []
        for form in (declared, [s.lower() for s in declared], [s.upper() for s in declared]):
            if form not in forms:
                forms.append(form)
        return forms

    @property
    def has_casts(self) -> bool:
        return any(op in ("int", "float") for _, op in self.direct.values())


def compile_rules(spec: EntitySpec, groups: tuple[str, ...]) -> list[SourceRule]:
    types = {f.name: f.spark_type for f in spec.fields}
    rules = []
    for group in groups:
        spellings: dict[str, tuple[str, str]] = {}
        declared: dict[str, tuple[str, str]] = {}
        for m in spec.mappings(group):
            entry = (m.canonical_field, m.op)
            declared[m.source_field] = entry
            spellings.update({s: entry for s in (m.source_field, m.source_field.lower(), m.source_field.upper())})
        one_field_each = len({t for t, _ in declared.values()}) == len(declared)
        one_spelling_each = len({s.lower() for s in declared}) == len(declared)
        simple = all(t in types and _has_direct_form(op, types[t]) for t, op in declared.values())
        direct = None
        if declared and one_field_each and one_spelling_each and simple:
            direct = {t: (s, op) for s, (t, op) in declared.items()}
        rules.append(SourceRule(group, spellings, direct))
    return rules


def _has_direct_form(op: str, dtype: T.DataType) -> bool:
    needed = {"upper": T.StringType, "lower": T.StringType, "int": T.LongType, "float": T.DoubleType}
    return op == "identity" or isinstance(dtype, needed[op])


def compile_targets(spec: EntitySpec, rules: list[SourceRule]) -> list[Target]:
    ops: dict[str, set[str]] = {f.name: set() for f in spec.fields}
    for rule in rules:
        for name, op in rule.spellings.values():
            ops.setdefault(name, set()).add(op)
    types = {f.name: f.spark_type for f in spec.fields}
    return [
        Target(i, name, types.get(name, T.StringType()), tuple(sorted(used, key=OP_CODES.get)), name not in types)
        for i, (name, used) in enumerate(ops.items())
    ]


def _group_conditions(groups: tuple[str, ...]) -> dict[str, Column]:
    """Mapping list per row: by source name, every unnamed source (null too) uses the last list."""
    conditions = {g: F.col("source").eqNullSafe(s) for s, g in SOURCE_MAPPINGS.items() if g in groups}
    if OTHER_MAPPINGS in groups:
        named = [F.col("source").eqNullSafe(s) for s in SOURCE_MAPPINGS]
        conditions[OTHER_MAPPINGS] = ~reduce(or_, named)
    return conditions


# --- direct route -----------------------------------------------------------------------------


def _direct_type(op: str, dtype: T.DataType, mode: str) -> T.DataType:
    """Read as the canonical type where no JSON kind is lost by it, else as text or variant."""
    if op == "int" or isinstance(dtype, T.DecimalType):
        return T.VariantType()
    return dtype if op == "identity" and mode == STRICT else T.StringType()


def _parse_direct(rule: SourceRule, types: dict[str, T.DataType], mode: str) -> Column:
    """``from_json`` over all spellings of the source, renamed by position to ``f<field>_<form>``.

    The rename is needed because spellings that differ in letter case cannot be told apart by name.
    """
    written, renamed, seen = [], [], set()
    for f, form in enumerate(rule.forms):
        for i, ((target, (_, op)), spelling) in enumerate(zip(rule.direct.items(), form)):
            if spelling not in seen:
                seen.add(spelling)
                dtype = _direct_type(op, types[target], mode)
                written.append(T.StructField(spelling, dtype))
                renamed.append(T.StructField(f"f{i}_{f}", dtype))
    return F.from_json("payload", T.StructType(written), JSON_OPTIONS).cast(T.StructType(renamed))


def _direct_raw(rule: SourceRule) -> dict[str, Column]:
    """Parsed value per canonical field: at most one spelling of it is present on this route."""
    parsed, forms = F.col(f"_direct_{rule.group}"), rule.forms
    raw = {}
    for i, target in enumerate(rule.direct):
        spellings = [form[i] for form in forms]
        first_forms = [f for f, s in enumerate(spellings) if s not in spellings[:f]]
        columns = [parsed[f"f{i}_{f}"] for f in first_forms]
        raw[target] = F.coalesce(*columns) if len(columns) > 1 else columns[0]
    return raw


def _direct_value(raw: Column, op: str, dtype: T.DataType, mode: str) -> tuple[Column, Column | None]:
    """(value, doubtful): doubtful text needs its JSON kind and is left to the general route."""
    if op == "upper":
        return F.upper(raw), raw.eqNullSafe("false")
    if op == "lower":
        return F.lower(raw), None
    if op == "int":
        return JsonValue(raw, kind_of(raw), F.try_variant_get(raw, "$", "string")).cast_int()
    if isinstance(dtype, T.DecimalType):
        return JsonValue(raw, kind_of(raw), F.try_variant_get(raw, "$", "string")).as_type(dtype), None
    if op == "float":
        return raw.try_cast("double"), raw.isNotNull() & ~raw.rlike(PLAIN_DECIMAL)
    return (raw if mode == STRICT else lenient_text(raw, dtype)), None


def _only_this_form(keys: Column, form: list[str], rule: SourceRule) -> Column:
    """True when no payload key outside ``form`` matches a mapped field in some letter case."""
    rest = F.array_except(keys, F.array(*[F.lit(s) for s in form]))
    forms = F.array(*[F.lit(s) for s in rule.spellings])
    joined = F.array_join(rest, KEY_SEPARATOR)
    stray = (
        F.arrays_overlap(rest, forms)
        | F.arrays_overlap(F.split(F.lower(joined), KEY_SEPARATOR), forms)
        | F.arrays_overlap(F.split(F.upper(joined), KEY_SEPARATOR), forms)
    )
    return F.when(F.size(rest) == 0, True).otherwise(~stray)


def _one_json_value(payload: Column) -> Column:
    """False where text follows the JSON value.  An object with one closing brace, its last character, needs no second look;
    any other payload is read as the only element of an array."""
    plain = payload.endswith("}") & (F.length(payload) - F.length(F.replace(payload, F.lit("}"), F.lit(""))) == 1)
    alone = F.coalesce(F.json_array_length(F.concat(F.lit("["), payload, F.lit("]"))) == 1, F.lit(False))
    return F.when(plain, True).otherwise(alone)


# --- general route ----------------------------------------------------------------------------


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _general_value(op: str, v: JsonValue, dtype: T.DataType, mode: str) -> Column:
    """One JSON value after its transform, in a field of ``dtype``."""
    lenient = mode == LENIENT
    exact = isinstance(dtype, T.DecimalType)
    as_is = lenient_text(v.text, dtype) if lenient and not exact else v.as_type(dtype)
    if op in ("upper", "lower"):
        changed = F.upper(v.text) if op == "upper" else F.lower(v.text)
        converted = lenient_text(changed, dtype) if lenient and not exact else string_token(changed, dtype)
        return F.when(v.truthy, converted).otherwise(as_is)
    if op == "int":
        number = v.cast_int()[0]
        if isinstance(dtype, T.TimestampType):
            return F.timestamp_seconds(number)
        fits = (T.LongType, T.DoubleType, T.StringType, T.DecimalType)
        return number.try_cast(dtype) if isinstance(dtype, fits) else no_value(dtype)
    if op == "float" and exact:
        return v.cast_decimal(dtype)
    if op == "float":
        number = v.cast_float()[0]
        return number.cast(dtype) if isinstance(dtype, (T.DoubleType, T.StringType)) else no_value(dtype)
    return as_is


def _code_lookup(rules: list[SourceRule], targets: list[Target], conditions: dict[str, Column]) -> Column:
    """Spelling -> field and operation code, for the row's mapping list."""
    by_name = {t.name: t for t in targets}
    lookup = no_value(T.MapType(T.StringType(), T.IntegerType()))
    for rule in rules:
        if rule.spellings:
            pairs = [F.lit(x) for s, (name, op) in rule.spellings.items() for x in (s, by_name[name].code(op))]
            lookup = F.when(conditions[rule.group], F.create_map(*pairs)).otherwise(lookup)
    return lookup


def _refused(entries: Column, targets: list[Target]) -> Column | None:
    """A cast refused on any entry, also on one that a later entry of the same field replaces."""
    int_codes = [t.code(op) for t in targets for op in t.ops if op == "int"]
    float_codes = [t.code(op) for t in targets for op in t.ops if op == "float"]

    def refused(entry: Column) -> Column:
        v = JsonValue(entry["value"], entry["kind"], entry["text"])
        checks = [
            entry["code"].isin(codes) & cast(v)[1]
            for codes, cast in ((int_codes, JsonValue.cast_int), (float_codes, JsonValue.cast_float)) if codes
        ]
        return F.coalesce(reduce(or_, checks), F.lit(False))

    return F.exists(entries, refused) if int_codes or float_codes else None


def _general(rules: list[SourceRule], targets: list[Target], conditions: dict[str, Column], mode: str) -> Column:
    """The record by the general route, as struct(canonical, errors)."""
    def code(lookup: Column, key: Column) -> Column:
        forms = (key, F.lower(key), F.upper(key))
        return F.coalesce(*[F.try_element_at(lookup, k) for k in forms])

    def judged(entry: Column) -> Column:
        return F.struct(
            entry["code"].alias("code"), entry["value"].alias("value"), entry["kind"].alias("kind"),
            text_of(entry["value"], entry["kind"], F.col("payload"), entry["key"]).alias("text"),
        )

    def folded(members: Column) -> Column:
        """A key that is repeated exactly stands at its first place with its last value, as in a JSON object."""
        distinct = F.array_distinct(F.transform(members, lambda e: e["key"]))
        last = F.transform(distinct, lambda k: F.element_at(F.filter(members, lambda e: e["key"] == k), -1))
        return F.when(F.size(distinct) == F.size(members), members).otherwise(last)

    # Entries that name a field; the last one of the payload comes first.
    members = _let(F.map_entries(F.from_json("payload", "map<string,variant>", JSON_OPTIONS)), folded)
    entries = _let(_code_lookup(rules, targets, conditions), lambda lookup: F.transform(
        members,
        lambda e: F.struct(
            code(lookup, e["key"]).alias("code"), e["key"].alias("key"), e["value"].alias("value"),
            kind_of(e["value"]).alias("kind")),
    ))
    entries = F.transform(F.filter(F.reverse(entries), lambda e: e["code"].isNotNull()), judged)

    def field(es: Column, t: Target) -> Column:
        codes = [t.code(op) for op in t.ops]

        def typed(e: Column) -> Column:
            v = JsonValue(e["value"], e["kind"], e["text"])
            value = no_value(t.dtype)
            for op in t.ops:
                value = F.when(e["code"] == t.code(op), _general_value(op, v, t.dtype, mode)).otherwise(value)
            return F.struct(value.alias("value"), e["text"].alias("text"))

        if not codes:
            return F.struct(no_value(t.dtype).alias("value"), no_value(T.StringType()).alias("text"))
        return _let(F.get(F.filter(es, lambda e: e["code"].isin(codes)), F.lit(0)), typed)

    visible = [t for t in targets if not t.hidden]

    def record(es: Column) -> Column:
        fields = F.struct(*[field(es, t).alias(t.name) for t in visible])
        if mode == STRICT:
            check = _refused(es, targets)
            values = _let(fields, lambda r: F.struct(*[r[t.name]["value"].alias(t.name) for t in visible]))
            return F.struct(
                (values if check is None else F.when(~F.coalesce(check, F.lit(False)), values)).alias("canonical"))
        return _let(fields, lambda r: F.struct(
            F.struct(*[r[t.name]["value"].alias(t.name) for t in visible]).alias("canonical"),
            _errors([(t.name, r[t.name]["text"], r[t.name]["value"]) for t in visible]).alias("errors"),
        ))

    return _let(entries, record)


def _errors(checked: list[tuple[str, Column, Column]]) -> Column:
    """Names of the fields whose text is there but gave no value."""
    return F.array_compact(F.array(*[
        F.when(text.isNotNull() & value.isNull(), F.lit(name)) for name, text, value in checked
    ]))


def apply_canonical_mapping(
    df: DataFrame, spec: EntitySpec, mode: str = STRICT, sources: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add ``canonical`` (typed struct), ``canonical_payload`` (its JSON text) and, in lenient mode,
    ``_errors`` (names of the fields whose value was refused).

    ``strict``: one refused cast empties the whole record.  ``lenient``: only that field is emptied
    and strings are converted to the declared type.  ``sources`` narrows the mapping lists when the
    stream is known to hold only those sources.
    """
    if mode not in (STRICT, LENIENT):
        raise ValueError(f"mode must be {STRICT!r} or {LENIENT!r}, got {mode!r}")
    groups = (*SOURCE_MAPPINGS.values(), OTHER_MAPPINGS)
    if sources is not None:
        wanted = {SOURCE_MAPPINGS.get(s, OTHER_MAPPINGS) for s in sources}
        groups = tuple(g for g in groups if g in wanted)
    kept = [F.col(f"`{c}`") for c in df.columns]
    parses, record = _compile(spec, mode, groups)
    parsed = df.select(*kept, *parses)
    # A generator of one row: unlike a projection it is never copied into the filters above it, so the
    # record is worked out once per row.
    mapped = parsed.select(*kept, record.alias("_record")).select(*kept, F.inline_outer(F.array("_record")))
    if mode == LENIENT:
        mapped = mapped.withColumnRenamed("errors", "_errors")
    return mapped.withColumn("canonical_payload", F.to_json("canonical", {"ignoreNullFields": "false"}))


@lru_cache(maxsize=64)
def _compile(spec: EntitySpec, mode: str, groups: tuple[str, ...]) -> tuple[list[Column], Column]:
    """(parsed columns, record built from them); the expressions serve any number of plans."""
    rules = compile_rules(spec, groups)
    targets = compile_targets(spec, rules)
    types = {t.name: t.dtype for t in targets}
    conditions = _group_conditions(groups)
    direct_rules = [r for r in rules if r.direct]

    # One parse per row into the struct of its source, and the list of its keys.
    parses = [
        F.json_object_keys("payload").alias("_keys"),
        *[F.when(conditions[r.group], _parse_direct(r, types, mode)).alias(f"_direct_{r.group}") for r in direct_rules],
    ]

    # Direct values, and whether they may be used for this row.
    values: dict[str, list[Column]] = {t.name: [] for t in targets}
    texts: dict[str, list[Column]] = {t.name: [] for t in targets}
    settled = F.lit(False)
    for rule in direct_rules:
        keys = F.col("_keys")
        ok = F.lit(False)
        for form in reversed(rule.forms):
            ok = F.when(_only_this_form(keys, form, rule), True).otherwise(ok)
        if rule.has_casts and mode == STRICT:
            ok = ok & (F.size(F.array_distinct(keys)) == F.size(keys))
        for name, raw in _direct_raw(rule).items():
            op = rule.direct[name][1]
            value, doubtful = _direct_value(raw, op, types[name], mode)
            values[name].append(value)
            is_variant = isinstance(_direct_type(op, types[name], mode), T.VariantType)
            texts[name].append(F.try_variant_get(raw, "$", "string") if is_variant else raw.cast("string"))
            if doubtful is not None:
                ok = ok & ~doubtful
        settled = F.when(conditions[rule.group], F.coalesce(ok, F.lit(False))).otherwise(settled)
    visible = [t for t in targets if not t.hidden]

    def first(columns: list[Column], dtype: T.DataType) -> Column:
        return F.coalesce(*columns) if columns else no_value(dtype)

    direct = F.struct(*[first(values[t.name], t.dtype).alias(t.name) for t in visible])
    if mode == STRICT:
        answer = F.struct(direct.alias("canonical"))
    else:
        answer = _let(direct, lambda d: F.struct(
            d.alias("canonical"),
            _errors([(t.name, first(texts[t.name], T.StringType()), d[t.name]) for t in visible]).alias("errors"),
        ))
    empty = [F.struct(*[no_value(t.dtype).alias(t.name) for t in visible]).alias("canonical")]
    if mode == LENIENT:
        empty.append(F.array().cast("array<string>").alias("errors"))

    # The general route is evaluated only where the direct one may not be used.
    general = _general(rules, targets, conditions, mode)
    no_payload = F.col("payload").isNull() | (F.col("payload") == "")
    if mode == STRICT:
        no_payload |= ~_one_json_value(F.col("payload"))
    record = F.when(~no_payload, F.when(settled, answer).otherwise(general))
    return parses, F.coalesce(record, F.struct(*empty))


def expand_canonical_fields(
    df: DataFrame, spec: EntitySpec, ingest_date: date | Column | None = None, keep_position: bool = True,
) -> DataFrame:
    """One column per canonical field, then the metadata columns.

    ``keep_position`` carries the log position, so that later operators can break ties.
    """
    if ingest_date is None:
        ingest_date = F.current_date()
    elif isinstance(ingest_date, date):
        ingest_date = F.lit(ingest_date)
    position = []
    if keep_position and {"kafka_partition", "kafka_offset"} <= set(df.columns):
        position = [F.col("kafka_partition").alias("_partition"), F.col("kafka_offset").alias("_offset")]
    carried = [F.col(c) for c in ("_errors", PLACE) if c in df.columns]
    return df.select(
        *[F.col("canonical")[f.name].alias(f.name) for f in spec.fields],
        F.col("source").alias("_source"),
        F.col("event_type").alias("_event_type"),
        F.col("event_timestamp").alias("_event_timestamp"),
        ingest_date.alias("_ingest_date"),
        F.lit(True).alias("_is_golden"),
        *position,
        *carried,
    )


def canonicalise(
    events: DataFrame, spec: EntitySpec, mode: str = STRICT, ingest_date: date | Column | None = None,
    sources: tuple[str, ...] | None = None,
) -> DataFrame:
    """Decoded events -> canonical rows."""
    return expand_canonical_fields(apply_canonical_mapping(events, spec, mode, sources), spec, ingest_date)
