"""Unions, sorts and limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType, NullType

from fundlens.session import cut_lineage


def _holds(wide: DataType, given: DataType) -> bool:
    """True if every value of ``given`` is kept as it is in ``wide``."""
    if wide.simpleString() == given.simpleString() or isinstance(given, NullType):
        return True
    if isinstance(wide, DecimalType) and isinstance(given, DecimalType):
        digits = given.precision - given.scale
        return wide.scale >= given.scale and wide.precision - wide.scale >= digits
    if isinstance(given, IntegralType):
        return isinstance(wide, (IntegralType, DecimalType))
    return isinstance(given, (FloatType, DecimalType)) and isinstance(wide, DoubleType)


def stack(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by name of frames with the same columns.

    Numbers take the wider type; a decimal that meets a double becomes one. A missing
    or an extra column raises ValueError; a column whose common type would change
    values raises TypeError: cast it first.
    """
    columns = dfs[0].columns
    for df in dfs[1:]:
        if differing := set(columns) ^ set(df.columns):
            raise ValueError(f"columns that not all branches have: {sorted(differing)}")
    out = reduce(DataFrame.unionByName, dfs)
    for df in dfs:
        for field in df.schema.fields:
            common = out.schema[field.name].dataType
            if not _holds(common, field.dataType):
                raise TypeError(f"{field.name}: {field.dataType.simpleString()} does not fit {common.simpleString()}")
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION: whole rows once, NULLs equal. Copies collapse before the shuffle."""
    return stack([a, b]).distinct()


def concat_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both; a column that one side lacks is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)


def spread_sort(df: DataFrame, *order: Column) -> DataFrame:
    """Global sort whose partitions may split a run of equal keys.

    A sort places rows by ranges of its keys, so a key with very many rows would
    fill one task; the row id behind the keys lets a range end inside the run. The id
    is taken from written files: a task that runs again finds the same one.
    """
    return cut_lineage(df).orderBy(*order, F.monotonically_increasing_id())


def order_totals(df: DataFrame, col: str = "Total USD") -> DataFrame:
    """Largest first; NULL totals lead."""
    return spread_sort(df, F.col(f"`{col}`").desc_nulls_first())


def order_events(df: DataFrame, keys: list[str]) -> DataFrame:
    return spread_sort(df, *[F.col(k).asc_nulls_last() for k in keys])


def order_lookup(df: DataFrame, col: str = "group_id") -> DataFrame:
    """Sort ids as text: '10' comes before '2'."""
    return spread_sort(df, F.col(col).cast("string").asc())


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """The first rows in the given order, so that a preview can be repeated."""
    return df.orderBy(*order).limit(n)
