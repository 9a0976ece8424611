"""Keys that say which row comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
_DECIMAL_BITS = 126  # decimal(38) holds a little more than this


def _bits(df: DataFrame, columns: tuple[str, ...]) -> list[int] | None:
    kinds = dict(df.dtypes)
    bits = [_BITS.get(kinds.get(c)) for c in columns]
    return bits if None not in bits and sum(bits) <= _DECIMAL_BITS else None


def _number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def order_key(df: DataFrame, *columns: str) -> Column:
    """One sortable value for key columns.

    Integral columns are put into one decimal, which a hash aggregation can
    hold; a struct, used for all others, forces a sort. The decimal has no
    room for signs behind the first column, so a negative key there is an
    error; cast such keys to decimal or string to have them in a struct.
    """
    bits = _bits(df, columns)
    if len(columns) == 1:
        return F.col(columns[0])
    if bits is None:
        return F.struct(*columns)
    key = F.col(columns[0]).cast("decimal(38,0)")
    for column, width in zip(columns[1:], bits[1:]):
        part = F.when(F.col(column) < 0, F.raise_error(F.lit(f"negative key in {column}")).cast("decimal(38,0)"))
        key = key * _number(2**width) + part.otherwise(F.col(column).cast("decimal(38,0)"))
    return key


def major_part(df: DataFrame, key: Column, *columns: str) -> Column:
    """The part of an ``order_key`` that ranks by its first column."""
    bits = _bits(df, columns)
    return key[columns[0]] if bits is None else key - key % _number(2 ** sum(bits[1:]))
