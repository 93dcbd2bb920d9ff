"""Value conversion between JSON values, their text, and canonical types.

``JsonValue`` wraps a variant column together with its JSON kind and text.  Every conversion returns
a column and, where a value can be refused, a boolean column that is true when it was.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted by the integer and float casts (blank-padded, digit groups joined by "_").
INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT_TEXT = (
    r"^\s*[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)
# Strings a JSON reader takes as a double.
JSON_DOUBLE_WORDS = {
    "NaN": "NaN",
    "+INF": "Infinity", "+Infinity": "Infinity", "Infinity": "Infinity",
    "-INF": "-Infinity", "-Infinity": "-Infinity",
}
# Integers that do not fit a long are held as DECIMAL(p,0) with at least this many digits.
WIDE_INTEGER = r"^DECIMAL\((19|2[0-9]|3[0-9]),0\)"


# Text of a decimal number.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def no_value(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def text_to_long(text: Column) -> Column:
    return F.regexp_replace(text, "_", "").try_cast("bigint")


def text_to_double(text: Column) -> Column:
    return F.regexp_replace(text, "_", "").try_cast("double")


def json_double_word(text: Column) -> Column:
    """Double for the special words of JSON text, null for any other string."""
    words = F.create_map(*[F.lit(x) for pair in JSON_DOUBLE_WORDS.items() for x in pair])
    return F.try_element_at(words, text).cast("double")


def string_token(text: Column, dtype: T.DataType) -> Column:
    """What a JSON *string* becomes in a field of this type: no string-to-number conversion."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.DoubleType):
        return json_double_word(text)
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        return text.try_cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return decimal_text(text, dtype)
    return no_value(dtype)


def decimal_text(text: Column, dtype: T.DecimalType) -> Column:
    """Exact, further digits rounded half up; null where the text is no number or does not fit.  Sources write decimals as
    text, because a JSON number may lose digits on its way."""
    return F.when(text.rlike(DECIMAL_TEXT), F.trim(text).try_cast(dtype))


def lenient_text(text: Column, dtype: T.DataType) -> Column:
    """What any scalar's text becomes when strings may be converted; null when it cannot be."""
    if isinstance(dtype, T.LongType):
        return F.regexp_replace(text, r"\.0+\s*$", "").try_cast("bigint")
    if isinstance(dtype, T.DoubleType):
        return F.when(text.rlike(FLOAT_TEXT), text_to_double(text))
    if isinstance(dtype, T.TimestampType):
        return F.coalesce(text.try_cast("timestamp"), F.timestamp_seconds(text.try_cast("bigint")))
    return text.try_cast(dtype)


@dataclass(frozen=True)
class JsonValue:
    value: Column   # variant
    kind: Column    # schema_of_variant text
    text: Column    # text of the value, null for JSON null

    @cached_property
    def is_number(self) -> Column:
        return self.kind.startswith("DECIMAL") | self.kind.isin("BIGINT", "DOUBLE")

    @cached_property
    def is_string(self) -> Column:
        return self.kind == "STRING"

    @cached_property
    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"

    @cached_property
    def is_nested(self) -> Column:
        return self.kind.startswith("OBJECT") | self.kind.startswith("ARRAY")

    def get(self, dtype: str) -> Column:
        return F.try_variant_get(self.value, "$", dtype)

    @cached_property
    def truthy(self) -> Column:
        return (
            F.when(self.is_string, self.text != "")
            .when(self.is_boolean, self.get("boolean"))
            .when(self.is_number, self.get("double") != 0)
            .when(self.is_nested, ~self.text.isin("{}", "[]"))
            .otherwise(False)
        )

    def as_type(self, dtype: T.DataType) -> Column:
        """The value in a field of this type, by JSON kind only (null when the kinds differ)."""
        if isinstance(dtype, T.StringType):
            return self.text
        if isinstance(dtype, T.LongType):
            return F.when(self.kind == "BIGINT", self.get("bigint"))
        if isinstance(dtype, T.DoubleType):
            return F.when(self.is_number, self.get("double")).when(
                self.is_string, json_double_word(self.text))
        if isinstance(dtype, T.BooleanType):
            return F.when(self.is_boolean, self.get("boolean"))
        if isinstance(dtype, T.DecimalType):
            return F.when(self.is_number, self.get(dtype.simpleString())).when(self.is_string, decimal_text(self.text, dtype))
        if isinstance(dtype, T.TimestampType):
            return F.when(self.is_string, string_token(self.text, dtype)).when(
                self.kind == "BIGINT", F.timestamp_seconds(self.get("bigint")))
        return F.when(self.is_string, string_token(self.text, dtype))

    def cast_int(self) -> tuple[Column, Column]:
        """Integer by truncation; (value, refused).  Too large for a long: null, not refused."""
        number = self.get("double")
        finite = self.is_number & ~F.isnan(number) & (F.abs(number) != float("inf"))
        value = (
            F.when(self.kind == "BIGINT", self.get("bigint"))
            .when(finite & self.kind.rlike(WIDE_INTEGER), self.get("decimal(38,0)").try_cast("bigint"))
            .when(finite & (F.abs(number) < 2.0 ** 63), number.try_cast("bigint"))
            .when(self.is_boolean, self.get("boolean").cast("bigint"))
            .when(self.is_string & self.text.rlike(INT_TEXT), text_to_long(self.text))
        )
        accepted = finite | self.is_boolean | (self.is_string & self.text.rlike(INT_TEXT))
        return value, self.text.isNotNull() & ~accepted

    def cast_float(self) -> tuple[Column, Column]:
        """Double; (value, refused)."""
        value = (
            F.when(self.is_number, self.get("double"))
            .when(self.is_boolean, self.get("boolean").cast("int").cast("double"))
            .when(self.is_string & self.text.rlike(FLOAT_TEXT), text_to_double(self.text))
        )
        accepted = self.is_number | self.is_boolean | (self.is_string & self.text.rlike(FLOAT_TEXT))
        return value, self.text.isNotNull() & ~accepted


    def cast_decimal(self, dtype: T.DecimalType) -> Column:
        """What ``cast_float`` accepts, as an exact decimal."""
        return (
            F.when(self.is_number, self.get(dtype.simpleString()))
            .when(self.is_boolean, self.get("boolean").cast("int").cast(dtype))
            .when(self.is_string & self.text.rlike(FLOAT_TEXT), decimal_text(F.regexp_replace(self.text, "_", ""), dtype))
        )


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def text_of(value: Column, kind: Column, payload: Column | None = None, key: Column | None = None) -> Column:
    """Text of a variant.  With the payload and its key a nested value keeps its key order."""
    plain = F.try_variant_get(value, "$", "string")
    fraction = kind.startswith("DECIMAL") & ~kind.rlike(WIDE_INTEGER)
    text = F.when(fraction, F.try_variant_get(value, "$", "double").cast("string"))
    if payload is not None and key is not None:
        nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
        path = F.concat(F.lit("$['"), key, F.lit("']"))
        text = text.when(nested, F.coalesce(F.call_function("get_json_object", payload, path), plain))
    return text.otherwise(plain)
