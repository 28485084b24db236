"""Row filters and projections. All of them reach the Parquet scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from fundlens import constants as K
from fundlens.functions.text import valid_address


def select_as(df: DataFrame, cols: dict[str, object]) -> DataFrame:
    """Project to ``{output: column name, Column or constant in F.lit}``."""
    return df.select(*[(c if isinstance(c, Column) else F.col(c)).alias(name) for name, c in cols.items()])


def drop_test_chains(df: DataFrame, col: str = "chain_id") -> DataFrame:
    """Leave out the test network; rows without a chain go too."""
    return df.where(F.col(col) != K.TEST_CHAIN_ID)


def above(df: DataFrame, col: str, least: float, inclusive: bool = False) -> DataFrame:
    c = F.col(col)
    return df.where(c >= least if inclusive else c > least)


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def where_in(df: DataFrame, col: str, values: list, negate: bool = False, lower: bool = False) -> DataFrame:
    c = F.lower(col) if lower else F.col(col)
    return df.where(~c.isin(values) if negate else c.isin(values))


def active_since(df: DataFrame, date: str = K.REPORT_START) -> DataFrame:
    """Rounds that end or start on or after ``date``, and all direct donation rounds."""
    # As text: a datetime literal would be read in the time zone of the driver's system.
    day = F.lit(date).cast("timestamp")
    return df.where(
        (F.col("donations_end_time") >= day)
        | (F.col("applications_start_time") >= day)
        | (F.col("strategy_name") == K.DIRECT_ALLOCATION_V2)
    )


def until(df: DataFrame, ts: str, now: datetime | Column | None = None) -> DataFrame:
    """Leave out rows of the future; pass ``now`` for a reproducible result.

    A ``now`` without a zone is in the zone of the session.
    """
    if now is None:
        now = F.current_timestamp()
    limit = now if isinstance(now, Column) else F.lit(now.isoformat(" ")).cast("timestamp")
    return df.where(F.col(ts) <= limit)


def drop_strategy(df: DataFrame, name: str, col: str = "strategy_name") -> DataFrame:
    """Leave out one strategy; rows without a strategy go too."""
    return df.where(F.col(col) != name)


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.where(F.col(col).like(pattern))


def valid_addresses(df: DataFrame, col: str) -> DataFrame:
    return df.where(valid_address(F.col(col)))


def require_title(df: DataFrame, col: str = "title") -> DataFrame:
    return df.where(F.col(col) != "")
