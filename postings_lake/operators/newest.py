"""Newest-row-per-key deduplication."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StringType, StructField, StructType, VariantType

_RANK, _TIE = "__newest_rank", "__newest_tie"


def _canonical(c: Column, t: DataType) -> Column:
    """``c`` as a value that Spark's hashes read in full.

    The hashes pass over nulls, in arrays and structs too, do not see where an array
    ends, know no maps, and take 0.0 and -0.0, or texts equal under a collation, for
    equal. Fractions become text, collated texts bytes, elements and fields
    (is null, value) pairs, arrays get their length, maps become their entries'
    digests, sorted.
    """
    if isinstance(t, (FloatType, DoubleType, VariantType)):
        return c.cast("string")
    if isinstance(t, StringType) and t != StringType():
        return c.cast("binary")
    if isinstance(t, ArrayType):
        return F.struct(F.size(c).alias("n"), F.transform(c, lambda e: _marked(e, t.elementType)).alias("v"))
    if isinstance(t, StructType):
        inner = F.struct(*[_marked(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(t.fields)])
        return F.when(c.isNotNull(), inner)
    if isinstance(t, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            _marked(e["key"], t.keyType).alias("k"), _marked(e["value"], t.valueType).alias("v")))
        hashed = F.transform(entries, lambda e: F.struct(F.xxhash64(F.lit(1), e).alias("a"), F.xxhash64(F.lit(2), e).alias("b")))
        return F.struct(F.size(c).alias("n"), F.array_sort(hashed).alias("v"))
    return c


def _marked(c: Column, t: DataType) -> Column:
    """``(is null, value)``: nulls are told from absent and from neighbouring values."""
    return F.struct(c.isNull().alias("n"), _canonical(c, t).alias("v"))


def row_digest(fields: Sequence[StructField]) -> Column:
    """128-bit digest of a row, ``struct<a: bigint, b: bigint>``, that differs for rows
    that differ in any value, null, or place of a null, whatever the types.

    Two seeded hashes over one mask of the nulls and every value in canonical form.
    """
    if not fields:
        return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    mask = F.concat(*[F.when(F.col(f"`{f.name}`").isNull(), "0").otherwise("1") for f in fields])
    values = [_canonical(F.col(f"`{f.name}`"), f.dataType) for f in fields]
    return F.struct(F.xxhash64(F.lit(1), mask, *values).alias("a"), F.xxhash64(F.lit(2), mask, *reversed(values)).alias("b"))


def _order_value(df: DataFrame, order_col: str, order: str) -> Column:
    c = F.col(order_col)
    if order == "string":
        return c
    if order == "timestamp":
        if isinstance(df.schema[order_col].dataType, StringType):
            return F.try_to_timestamp(c)
        return c
    raise ValueError(f"order must be 'string' or 'timestamp', not {order!r}")


def newest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    *,
    order: str = "string",
    tie_break: bool = True,
    digest: str | None = None,
) -> DataFrame:
    """Keep, for every key, the row with the greatest ``order_col``.

    Nulls in ``order_col`` lose to any value but are kept when they are all a
    key has. ``order="string"`` compares the column as stored (ISO strings in
    one format sort in time order); ``order="timestamp"`` parses strings first
    and breaks parse ties with the raw value.

    ``keys`` is a set; list its most selective column first, since the first
    column leads the binary sort prefix (a low-cardinality first key turns
    every comparison into a full-row comparison).

    With ``tie_break`` rows that share key and order value are ordered by a 128-bit
    digest of all their columns (:func:`row_digest`), so only equal rows tie and reruns
    return the same rows, in whatever order they come. It is computed at the scan: of the
    other columns only those that the caller uses cross the shuffle. ``digest`` names a
    column that holds it already; then the other columns need not be read for it.

    The ``row_number() = 1`` filter is planned by Catalyst as a partial
    ``WindowGroupLimit`` before the shuffle and a final one after it: each map
    task forwards at most one row per key, so a key holding a large share of
    the rows costs no more shuffle than any other key.
    """
    keys = list(keys)
    ordering: list[Column] = [_order_value(df, order_col, order).desc_nulls_last()]
    if order == "timestamp":
        ordering.append(F.col(order_col).desc_nulls_last())
    if digest is not None:
        ordering.append(F.col(digest).asc())
    elif tie_break:
        rest = [f for f in df.schema.fields if f.name not in {*keys, order_col}]
        if rest:
            df = df.withColumn(_TIE, row_digest(rest))
            ordering.append(F.col(_TIE).asc())
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK, _TIE)
