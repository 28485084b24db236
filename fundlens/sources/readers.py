"""Sources: files, remote relational tables, versioned schemas, lookups, ad-hoc SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fundlens import constants as K
from fundlens.functions.times import version_of
from fundlens.sources.files import list_folder


def read_table(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """Parquet table ``name`` under ``root``; a schema skips footer inference."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv_records(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Spreadsheet export with a header row; columns are found by their name in the header.

    A missing column and a value that does not fit its type raise. ``multi_line``
    allows line breaks inside quotes, at the price of one task per file.
    """
    wanted = StructType.fromDDL(schema)
    reader = spark.read.options(header=True, multiLine=multi_line)
    header = reader.csv(path).columns
    if missing := set(wanted.names) - set(header):
        raise ValueError(f"columns missing in the header: {sorted(missing)}")
    in_file = StructType([wanted[n] if n in wanted.names else StructField(n, StringType()) for n in header])
    # Files whose header has another order than the first one raise as well.
    rows = reader.options(enforceSchema=False, mode="FAILFAST").schema(in_file).csv(path)
    return rows.select(*[F.col(f"`{n}`") for n in wanted.names])


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Reader options; with a partition column the read runs as range queries in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    tables: dict[str, tuple[str, object, object, int] | list[str]],
    namespace: str = "",
    **properties: str,
) -> dict[str, DataFrame]:
    """Tables of a remote database, keyed by table name.

    Each table states how its read is divided: ``(column, lower, upper, partitions)``,
    or a list of predicates, one task each. Filters and column lists that callers add
    are pushed to the remote side.
    """
    prefix = f"{namespace}." if namespace else ""

    def read(table: str, division: tuple | list) -> DataFrame:
        if not division:
            raise ValueError(f"{table}: state a partition column with bounds, or predicates")
        if isinstance(division, list):
            return spark.read.jdbc(url, prefix + table, predicates=division, properties=properties)
        column, lower, upper, n = division
        options = jdbc_options(url, prefix + table, column, (lower, upper), n, **properties)
        return spark.read.format("jdbc").options(**options).load()

    return {table: read(table, division) for table, division in tables.items()}


def latest_version(df: DataFrame, version: str | Column, prefix: str = "chain_data_") -> DataFrame:
    """Rows of the newest schema version only.

    ``version`` holds names such as ``chain_data_86``. On a column that
    partitions the files, the scalar subquery also prunes the older directories.
    """
    name = F.col(version) if isinstance(version, str) else version
    number = version_of(name, prefix)
    newest = df.agg(F.max(number).alias("newest")).scalar()
    return df.where(number == newest)


def newest_schema(spark: SparkSession, root: str, prefix: str = "chain_data_") -> str:
    """Folder of the newest schema version under ``root``: names of the prefix and two or three digits.

    Versions are compared as numbers. Only the listing is read.
    """
    found = {path: re.fullmatch(re.escape(prefix) + r"(\d{2,3})", path.rsplit("/", 1)[1]) for path in list_folder(spark, root)}
    numbers = {path: int(match[1]) for path, match in found.items() if match}
    if not numbers:
        raise ValueError(f"no folder {prefix}N under {root}")
    return max(numbers, key=numbers.get)


def read_newest(spark: SparkSession, root: str, table: str, schema: str | None = None, prefix: str = "chain_data_") -> DataFrame:
    """Table of the newest schema version; the folders of older ones are never opened."""
    return read_table(spark, newest_schema(spark, root, prefix), table, schema)


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """``df`` itself, or an error if it has no row. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"empty {what}")
    return df


def _literal_table(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    values = ", ".join(f"({chain_id}, '{name}')" for chain_id, name in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(chain_id, chain_name)")


def chain_mapping(spark: SparkSession) -> DataFrame:
    """Chain id to lower-case chain name (a fixed list)."""
    return _literal_table(spark, K.CHAIN_SLUGS)


def chain_names(spark: SparkSession) -> DataFrame:
    """Chain id to display name (a fixed list)."""
    return _literal_table(spark, K.CHAIN_TITLES)


def run_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Ad-hoc SQL over named frames (``{name}`` in the text); nothing runs until an action."""
    return spark.sql(sql, **tables)
