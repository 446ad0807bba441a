"""Lenient reading of fields of untyped JSON (VARIANT) values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def field(value: Column, name: str) -> Column:
    """A member as a VARIANT; null where the value is no object or lacks it."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def string_field(value: Column, *names: str) -> Column:
    """The first member that is a string or a number, as a string."""

    def one(n: str) -> Column:
        f = field(value, n)
        return F.when((_kind(f) == "STRING") | _is_number(_kind(f)), F.try_variant_get(f, "$", "string"))

    return F.coalesce(*[one(n) for n in names])


def bool_field(value: Column, *names: str) -> Column:
    """The first member that is a boolean or exactly ``true`` or ``false`` as text."""

    def one(n: str) -> Column:
        f = field(value, n)
        text = F.try_variant_get(f, "$", "string")
        return F.when((_kind(f) == "BOOLEAN") | ((_kind(f) == "STRING") & text.isin("true", "false")), text == "true")

    return F.coalesce(*[one(n) for n in names])


def number_field(value: Column, *names: str) -> Column:
    """The first member that is a number or numeric text, as a double."""

    def one(n: str) -> Column:
        f = field(value, n)
        text = F.try_variant_get(f, "$", "string")
        return F.when(_is_number(_kind(f)), F.try_variant_get(f, "$", "double")).when(
            (_kind(f) == "STRING") & ~text.rlike(r"^\s|\s$"), text.try_cast("double")
        )

    return F.coalesce(*[one(n) for n in names])


def string_array(value: Column) -> Column:
    """Strings of an array, or of a JSON text of strings only; else an empty array."""
    none = F.array().cast("array<string>")
    items = F.filter(F.try_variant_get(value, "$", "array<variant>"), lambda x: _kind(x) == "STRING")
    text = F.try_variant_get(value, "$", "string")
    parsed = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    strict = F.when(F.forall(parsed, lambda x: _kind(x) == "STRING"), parsed)
    plain = lambda a: F.transform(a, lambda x: F.try_variant_get(x, "$", "string"))
    return F.coalesce(F.when(_kind(value) == "STRING", plain(strict)).otherwise(plain(items)), none)


def _epoch_ms(number: Column) -> Column:
    """Below 10**13 a number is milliseconds already, else nanoseconds."""
    return F.when(number < 10_000_000_000_000, number).otherwise(F.call_function("div", number, F.lit(1_000_000)))


def timestamp_ms(value: Column, *names: str) -> Column:
    """Milliseconds of the first usable member: an integer, integer text or an ISO time (UTC where it has no zone).

    Nulls, floats and blanks fall through to the next name; a text that is no time raises.
    """

    def one(n: str) -> Column:
        f = field(value, n)
        text = F.trim(F.try_variant_get(f, "$", "string"))
        iso = text.rlike(r"^\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d:\d\d(\.\d+)?([Zz]|[+-]\d\d:\d\d)?$")
        time = F.unix_millis(F.try_to_timestamp(F.when(iso, text)))
        number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
        bad = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("bigint")
        from_text = F.when(text != "", F.coalesce(_epoch_ms(number), time, bad))
        return F.when(_kind(f) == "BIGINT", _epoch_ms(F.try_variant_get(f, "$", "bigint"))).when(_kind(f) == "STRING", from_text)

    return F.coalesce(*[one(n) for n in names])
