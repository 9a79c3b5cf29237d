"""Checks and strict casts on VARIANT values, which keep JSON types apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^\s*[+-]?\d+\s*$"
_FLOAT = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\s*$"


def at(value: Column, path: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, f"$.{path}", as_type)


def absent(value: Column) -> Column:
    """Not there, or JSON null: readers of nested JSON cannot tell these apart."""
    return value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))


def kind(value: Column) -> Column:
    """Type name of a scalar or array, such as BIGINT, STRING, BOOLEAN, DECIMAL(3,1)."""
    return F.schema_of_variant(value)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def array_of(value: Column) -> Column:
    """The elements, or null when the value is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


def missing_fields(value: Column, names: Sequence[str]) -> Column:
    """Sorted names that the object lacks."""
    return F.array_compact(
        F.array(*[F.when(absent(at(value, n)), F.lit(n)) for n in sorted(names)])
    )


def misaligned(sizes: Mapping[str, Column], expected: Column) -> Column:
    """``name -> size`` of the arrays whose size differs from the expected one."""
    pairs = [part for name, size in sizes.items() for part in (F.lit(name), size)]
    return F.map_filter(F.create_map(*pairs), lambda _, size: size != expected)


def absent_kind(name: Column) -> Column:
    """``absent`` told from the type name."""
    return name.isNull() | (name == "VOID")


def text(value: Column) -> Column:
    written = F.try_variant_get(value, "$", "string")
    return F.when(kind(value) == "BOOLEAN", F.initcap(written)).otherwise(written)


def strict_int(value: Column, name: Column | None = None) -> Column:
    """Whole number (bigint): numbers are cut towards zero, text must be an integer, no booleans.

    ``name`` is the type name where the caller has it in a column already.
    """
    name = kind(value) if name is None else name
    written = F.try_variant_get(value, "$", "string")
    return (
        F.when(name == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .when(name.startswith("DECIMAL"), F.try_variant_get(value, "$", "decimal(38,10)").try_cast("bigint"))
        .when(name.isin("DOUBLE", "FLOAT"), F.try_variant_get(value, "$", "double").try_cast("bigint"))
        .when((name == "STRING") & written.rlike(_INTEGER), F.trim(written).try_cast("bigint"))
    )


def strict_float(value: Column, name: Column | None = None) -> Column:
    """Double: numbers and numeric text, no booleans."""
    name = kind(value) if name is None else name
    written = F.try_variant_get(value, "$", "string")
    return F.when(
        (name == "BIGINT") | name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"),
        F.try_variant_get(value, "$", "double"),
    ).when((name == "STRING") & written.rlike(_FLOAT), F.trim(written).try_cast("double"))
