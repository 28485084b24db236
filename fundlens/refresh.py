"""Run the refresh over landed tables: ``python -m fundlens.refresh --inputs DIR --root DIR``.

``DIR`` holds Parquet tables: the five base tables under ``indexer/`` and ``static/``, all others under
``others/``, with the columns of :data:`fundlens.sources.schemas.SCHEMAS`. Start it with ``spark-submit``
to choose the cluster; settings given there win.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fundlens.plans.base import PRIORITY, base_specs
from fundlens.plans.refresh import refresh_all
from fundlens.session import with_settings
from fundlens.sources.readers import read_table
from fundlens.sources.schemas import SCHEMAS
from fundlens.sources.writers import clean_versions

OTHERS = (
    "registry", "static_donations", "static_matching", "round_roles", "maci_contributions", "maci_rounds",
    "maci_round_roles", "external_events", "names",
)


def landed_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The columns of a landed table that the jobs know; a missing one raises. Types are those of the files."""
    rows = read_table(spark, folder, name)
    wanted = StructType.fromDDL(SCHEMAS[name]).names
    if missing := set(wanted) - set(rows.columns):
        raise ValueError(f"{folder}/{name} lacks columns: {sorted(missing)}")
    return rows.select(*[f"`{c}`" for c in wanted])


def landed_inputs(spark: SparkSession, folder: str) -> tuple[dict[str, dict[str, DataFrame]], dict[str, DataFrame]]:
    """(base_sources, others) of :func:`fundlens.plans.refresh.refresh_all` from one folder."""
    folder = folder.rstrip("/")
    base_sources = {name: {s: landed_table(spark, f"{folder}/{s}", name) for s in PRIORITY} for name in base_specs()}
    others = {name: landed_table(spark, f"{folder}/others", name) for name in OTHERS if name != "round_roles"}
    return base_sources, others | {"round_roles": base_sources["round_roles"][PRIORITY[0]]}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Rebuild, audit and publish all tables.")
    parser.add_argument("--inputs", required=True, help="folder of the landed tables")
    parser.add_argument("--root", required=True, help="folder of the published tables")
    parser.add_argument("--run", help="name of the run; a stopped run of that name is gone on with")
    parser.add_argument("--sample", type=int, help="a trial over so many rows of the large tables, published apart")
    parser.add_argument("--at-once", type=int, default=4, help="tables built at the same time")
    parser.add_argument("--input-bytes", type=int, help="size of the inputs, to size the shuffles")
    parser.add_argument("--keep", type=int, help="clean up: versions to keep of each table")
    parser.add_argument("--clean-after", type=float, default=7 * 86400, help="clean up: least age in seconds")
    given = parser.parse_args(arguments)
    builder = SparkSession.builder.appName("fundlens refresh").config("spark.scheduler.mode", "FAIR")
    spark = with_settings(builder, given.input_bytes).getOrCreate()
    audit = refresh_all(spark, *landed_inputs(spark, given.inputs), given.root, given.sample, given.run, given.at_once)
    for row in audit.orderBy("table_name").collect():
        print(*row, sep="\t")
    if given.keep is not None:
        for path in clean_versions(spark, given.root, given.keep, given.clean_after):
            print("removed", path, sep="\t")


if __name__ == "__main__":
    main()
