"""Literal tables, empty tables and typed projections."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DataType, DecimalType, MapType, NumericType, StringType,
    StructField, StructType,
)


_WIDE = decimal.Context(prec=80)


def as_field(field) -> StructField:
    """A ``StructField`` as is, or a ``(name, type[, nullable])`` tuple."""
    if isinstance(field, StructField):
        return field
    if isinstance(field, tuple) and len(field) in (2, 3) and isinstance(field[1], DataType):
        name, dtype = field[0], field[1]
        nullable = field[2] if len(field) == 3 else True
        return StructField(name, dtype, nullable)
    raise TypeError(f"cannot use {field!r} as a field")


def as_schema(fields) -> StructType:
    """A ``StructType``, a DDL string (``"a bigint, b string"``) or a list of fields."""
    if isinstance(fields, StructType):
        return fields
    if isinstance(fields, str):
        parsed = DataType.fromDDL(fields)
        if not isinstance(parsed, StructType):
            raise TypeError(f"{fields!r} is not a row schema")
        return parsed
    return StructType([as_field(f) for f in fields])


def as_row(value) -> Row:
    """A ``Row`` as is, a tuple or list spread into columns, anything else one column."""
    if isinstance(value, Row):
        return value
    if isinstance(value, (tuple, list)):
        return Row(*value)
    return Row(value)


#: Python types of a column's values, and the range of whole numbers by their bits.
_PYTHON = {"string": str, "boolean": bool, "float": (float, int), "double": (float, int),
           "date": datetime.date, "timestamp": datetime.datetime,
           "timestamp_ntz": datetime.datetime, "binary": (bytes, bytearray)}
_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


def _check(value, dtype: DataType, nullable: bool, name: str) -> None:
    """Raise unless ``value`` is a value of ``dtype``, inside lists and maps too."""
    if value is None:
        if not nullable:
            raise ValueError(f"NULL in column {name!r}, which may hold none")
        return
    kind = dtype.simpleString()
    if isinstance(dtype, ArrayType) and isinstance(value, (list, tuple)):
        for v in value:
            _check(v, dtype.elementType, dtype.containsNull, name)
        return
    if isinstance(dtype, MapType) and isinstance(value, dict):
        for k, v in value.items():
            _check(k, dtype.keyType, False, name)
            _check(v, dtype.valueType, dtype.valueContainsNull, name)
        return
    if kind in _BITS:
        good = type(value) is int and -1 << _BITS[kind] <= value < 1 << _BITS[kind]
    elif isinstance(dtype, DecimalType):
        try:
            number = decimal.Decimal(value) if type(value) in (int, decimal.Decimal) else None
        except decimal.InvalidOperation:
            number = None
        good = number is not None and number.is_finite() and \
            number == number.quantize(decimal.Decimal(1).scaleb(-dtype.scale), context=_WIDE) and \
            abs(number) < decimal.Decimal(10) ** (dtype.precision - dtype.scale)
    elif kind in _PYTHON:
        good = isinstance(value, _PYTHON[kind]) and (kind == "boolean" or type(value) is not bool)
        if kind == "date":
            good = good and not isinstance(value, datetime.datetime)
    else:
        return
    if not good:
        raise TypeError(f"{value!r} is no {kind} for column {name!r}")


def _literal(value) -> Column:
    if isinstance(value, dict):
        return F.create_map(*[_literal(x) for item in value.items() for x in item])
    if isinstance(value, (list, tuple)):
        return F.array(*[_literal(x) for x in value])
    return F.lit(value)


def create_df(spark: SparkSession, rows: Iterable, fields: Sequence) -> DataFrame:
    """A small literal table with a declared schema (dimension lists and the
    like), built JVM-side as ``inline`` over an array of literal structs. A value
    that is not of its column's type is refused (1.9 or "1" for an int, a number out
    of range), as is a NULL in a column that may not hold one."""
    schema = as_schema(fields)
    values = [tuple(as_row(r)) for r in rows]
    if not values:
        return create_empty_df(spark, schema)
    for value in values:
        if len(value) != len(schema.fields):
            raise ValueError(f"row {value!r} does not fit {schema.simpleString()}")
        for v, f in zip(value, schema.fields, strict=True):
            _check(v, f.dataType, f.nullable, f.name)
    structs = [F.struct(*[_literal(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(value, schema.fields)]) for value in values]
    return spark.range(1).select(F.inline(F.array(*structs))).to(schema)


def _placeholder(dtype: DataType):
    """A non-NULL literal of ``dtype`` (for an empty table's non-nullable
    fields; no row ever carries it), or None when there is no simple one."""
    if isinstance(dtype, (NumericType, BooleanType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (StringType, BinaryType)):
        return F.lit("").cast(dtype)
    if isinstance(dtype, (ArrayType, MapType)):
        return (F.array() if isinstance(dtype, ArrayType) else F.create_map()).cast(dtype)
    if isinstance(dtype, StructType):
        parts = [_placeholder(f.dataType) for f in dtype.fields]
        if any(p is None for p in parts):
            return None
        return F.struct(*[p.alias(f.name) for p, f in zip(parts, dtype.fields)])
    return None


def create_empty_df(spark: SparkSession, fields) -> DataFrame:
    """An empty table with a declared schema, as a plan that runs no job."""
    schema = as_schema(fields)
    columns = []
    for f in schema.fields:
        value = F.lit(None).cast(f.dataType) if f.nullable else _placeholder(f.dataType)
        if value is None:
            return spark.createDataFrame([], schema)
        columns.append(value.alias(f.name))
    return spark.range(0).select(*columns).to(schema)


#: Number types, each safe to read as any later one.
_WIDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _loses_nothing(source: DataType, target: DataType) -> bool:
    """Whether every value of ``source`` reads as ``target``: the same type, a
    wider number (floating point counts as wider than whole numbers), a
    timestamp for a date, a string for any simple value."""
    a, b = source.simpleString(), target.simpleString()
    if source == target or a == "void":
        return True
    if isinstance(source, StructType) and isinstance(target, StructType):
        return len(source) == len(target) and all(
            f.name.lower() == g.name.lower() and _loses_nothing(f.dataType, g.dataType)
            for f, g in zip(source, target))
    if isinstance(source, ArrayType) and isinstance(target, ArrayType):
        return _loses_nothing(source.elementType, target.elementType)
    if isinstance(source, MapType) and isinstance(target, MapType):
        return (_loses_nothing(source.keyType, target.keyType)
                and _loses_nothing(source.valueType, target.valueType))
    if isinstance(target, StringType):
        return not isinstance(source, (StructType, ArrayType, MapType, BinaryType))
    if isinstance(target, DecimalType):
        digits = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}.get(a)
        if isinstance(source, DecimalType):
            digits = source.precision - source.scale
            return source.scale <= target.scale and digits <= target.precision - target.scale
        return digits is not None and digits <= target.precision - target.scale
    if a in _WIDER and b in _WIDER:
        return _WIDER.index(a) <= _WIDER.index(b)
    return (a, b) in (("date", "timestamp"), ("date", "timestamp_ntz"))


def _bound(df: DataFrame, schema, bind) -> DataFrame:
    """The columns of ``schema`` by name, in its order; ``bind`` gives the column of a
    field whose type differs. Missing columns raise, and so does, when it is read, a
    NULL where the schema allows none (as a typed row would)."""
    present = {c.lower(): c for c in df.columns}
    out = []
    for field in as_schema(schema).fields:
        source = present.get(field.name.lower())
        if source is None:
            raise ValueError(f"column {field.name!r} is missing; have {df.columns}")
        column, found = F.col(f"`{source}`"), df.schema[source].dataType
        column = column if found == field.dataType else bind(column, found, field)
        if not field.nullable and df.schema[source].nullable:
            message = f"NULL in column '{field.name}', which may hold none"
            column = F.when(column.isNull(), F.raise_error(F.lit(message)).cast(field.dataType)) \
                .otherwise(column)
        out.append(column.alias(field.name))
    return df.select(*out)


def conform(df: DataFrame, schema) -> DataFrame:
    """Bind columns by name to ``schema``: reorder, drop extras, widen types. A
    cast that could lose something (a fraction, digits, a text that is no
    number) is refused before anything runs; ``parse_as`` makes such casts."""
    def bind(column: Column, found: DataType, field: StructField) -> Column:
        if not _loses_nothing(found, field.dataType):
            raise TypeError(f"column {field.name!r}: {found.simpleString()} does not fit "
                            f"{field.dataType.simpleString()}; use parse_as")
        return column.cast(field.dataType)

    return _bound(df, schema, bind)


def parse_as(df: DataFrame, schema, strict: bool = True) -> DataFrame:
    """``conform`` with parsing casts: ``strict=True`` casts as ANSI does (a bad
    value raises, a fraction is cut); ``strict=False`` makes a bad value NULL."""
    return _bound(df, schema, lambda column, _, field: column.cast(field.dataType) if strict
                  else column.try_cast(field.dataType))
