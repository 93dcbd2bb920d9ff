"""Canonical entity specification.

A spec is the hand-over document between modelling and execution: the canonical fields with their
declared types, the field mappings of every source, and the merge keys.  It is immutable; operators
compile it to Spark expressions once, when the plan is built.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import types as T

# Declared type name -> Spark type.  The lookup is case-sensitive; any other name is a string.
TYPE_MAP: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

# Transform hints in order of precedence -> operation name.
TRANSFORM_HINTS = (
    ("UPPER", "upper"),
    ("LOWER", "lower"),
    ("CAST AS INT", "int"),
    ("CAST AS FLOAT", "float"),
)

# Mapping list used for a source; every other source uses OTHER_MAPPINGS.
SOURCE_MAPPINGS = {"postgres": "pg_mappings", "sqlserver": "sql_mappings"}
OTHER_MAPPINGS = "td_mappings"


# Opt-in beside the names above: exact decimals of a given size.
DECIMAL_TYPE = re.compile(r"decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)")


def resolve_type(declared: str | None) -> T.DataType:
    sized = DECIMAL_TYPE.fullmatch(declared or "")
    if sized:
        precision, scale = map(int, sized.groups())
        if not 1 <= precision <= 38 or scale > precision:
            raise ValueError(f"{declared}: a decimal has 1 to 38 digits, of which the scale is a part")
        return T.DecimalType(precision, scale)
    return TYPE_MAP.get(declared or "string", T.StringType())


def resolve_transform(hint: str | None) -> str:
    """Operation for a free-text transform hint; an unknown hint keeps the value as it is."""
    text = (hint or "").upper()
    return next((op for needle, op in TRANSFORM_HINTS if needle in text), "identity")


@dataclass(frozen=True)
class CanonicalField:
    name: str
    data_type: str = "string"
    nullable: bool = True
    description: str = ""
    pii: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return resolve_type(self.data_type)


@dataclass(frozen=True)
class FieldMapping:
    source_field: str
    canonical_field: str
    transform: str | None = None

    @property
    def op(self) -> str:
        return resolve_transform(self.transform)


@dataclass(frozen=True)
class EntitySpec:
    name: str
    fields: tuple[CanonicalField, ...]
    pg_mappings: tuple[FieldMapping, ...] = field(default=())
    sql_mappings: tuple[FieldMapping, ...] = field(default=())
    td_mappings: tuple[FieldMapping, ...] = field(default=())
    merge_keys: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len({n.lower() for n in names}) != len(names):
            raise ValueError(f"{self.name}: canonical field names must differ, got {names}")
        missing = [k for k in self.merge_keys if k not in names]
        if missing:
            raise ValueError(f"{self.name}: merge keys {missing} are not canonical fields")

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(f.name, f.spark_type, True, {"description": f.description, "pii": f.pii})
            for f in self.fields
        ])

    def mappings(self, group: str) -> tuple[FieldMapping, ...]:
        return getattr(self, group)

    def keys(self) -> list[str]:
        """Declared merge keys, else the non-nullable ``*_id`` fields, else ``<entity>_id``."""
        if self.merge_keys:
            return list(self.merge_keys)
        guessed = [f.name for f in self.fields if not f.nullable and f.name.endswith("_id")]
        if guessed:
            return guessed
        default = f"{self.name}_id"
        if default not in self.field_names:
            raise ValueError(f"{self.name}: no merge keys declared and none can be derived")
        return [default]

    def with_merge_keys(self, columns: Sequence[str], group: str | None = None) -> EntitySpec:
        """The spec with the keys that a profile found: canonical fields, or columns of the sources of a mapping list."""
        named = {m.source_field.lower(): m.canonical_field for m in self.mappings(group)} if group else {}
        return replace(self, merge_keys=tuple(named.get(c.lower(), c) for c in columns))

    @classmethod
    def from_document(cls, name: str, doc: dict | str) -> EntitySpec:
        """Build a spec from its JSON form (canonical_schema, three mapping lists, merge_keys)."""
        body = json.loads(doc) if isinstance(doc, str) else doc
        groups = {
            group: tuple(
                FieldMapping(m.get("source_field", ""), m["canonical_field"], m.get("transform"))
                for m in body.get(group, [])
            )
            for group in (*SOURCE_MAPPINGS.values(), OTHER_MAPPINGS)
        }
        fields = tuple(
            CanonicalField(
                f["name"], f.get("data_type", "string"), f.get("nullable", True),
                f.get("description", ""), f.get("pii", False),
            )
            for f in body.get("canonical_schema", [])
        )
        return cls(name, fields, merge_keys=tuple(body.get("merge_keys") or ()), **groups)

    def to_document(self) -> dict:
        body = {
            "canonical_schema": [asdict(f) for f in self.fields],
            "merge_keys": list(self.merge_keys),
        }
        for source, group in (*SOURCE_MAPPINGS.items(), ("teradata", OTHER_MAPPINGS)):
            body[group] = [{"source": source, **asdict(m)} for m in self.mappings(group)]
        return body
