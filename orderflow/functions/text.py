"""String and list helpers used across the operators (built-in expressions only)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_STYLES = ["dd.MM.yyyy", "dd-MM-yyyy", "yyyy-MM-dd"]


def pick(values: Sequence, index: Column) -> Column:
    """values[index] for a 0-based integral index column (literal array lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def literal_map(mapping: Mapping) -> Column:
    """A literal MAP column from a Python dict (lookup with ``map[key]``)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(mapping: Mapping, key: Column) -> Column:
    """mapping[key] or NULL; a literal map keeps the rule JVM-side, no join."""
    return F.element_at(literal_map(mapping), key) if mapping else F.lit(None)


def fmt_date(d: Column, style: Column) -> Column:
    """Date as text in one of the register's three styles (0, 1, 2)."""
    return (F.when(style == 0, F.date_format(d, DATE_STYLES[0]))
            .when(style == 1, F.date_format(d, DATE_STYLES[1]))
            .otherwise(F.date_format(d, DATE_STYLES[2])))


def leading_int(text: Column) -> Column:
    """Integer read from the leading digits of a text ('12abc' -> 12), else NULL.

    A cell counts as numeric when it starts with a digit; the digits up to the
    first non-digit are the value.
    """
    digits = F.regexp_extract(text, r"^([0-9]+)", 1)
    return F.when(text.rlike("^[0-9]"), digits.try_cast("long"))


NUMBER_PREFIX = r"([0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?)"


def leading_number(text: Column) -> Column:
    """Decimal read from the leading numeric prefix, exponent included
    ('1234.50 INR' -> 1234.50, '1.2E+07' -> 12000000), NULL from 10^22 on."""
    num = F.regexp_extract(text, "^" + NUMBER_PREFIX, 1)
    return F.when(text.rlike("^[0-9]"), num.try_cast("decimal(28,6)"))


def blank_to_null(df):
    """Every text column with empty cells as NULL."""
    return df.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name)
                       if f.dataType.simpleString() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def literal_table(spark, rows, schema: list[tuple[str, str]]):
    """A small fixed table built JVM-side (an ``inline`` of literal structs), so
    no Python worker is involved when it is scanned or joined."""
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, schema)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
