"""Writers of the warehouse layer."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from starmill import schemas
from starmill.plans.model import Warehouse

# A database takes far fewer writers than a cluster has tasks.
CONNECTIONS = 64
BATCH_ROWS = "10000"


def write_parquet(df: DataFrame, root: str, table: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(f"{root.rstrip('/')}/{table}")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    connections: int = CONNECTIONS,
) -> None:
    """Write to a database table; ``overwrite`` empties the table and keeps its keys.

    Emptying a dimension empties the facts that refer to it in the same command, which is
    what a database with declared foreign keys asks for. Load dimensions first then.

    Each task commits for itself, so a task that is run again after its commit was lost
    sends its rows again: the target's primary key is what rejects them, and a load with
    ``overwrite`` is how to start over. At most ``connections`` tasks write at a time.
    ``properties`` may hold any option of Spark's writer besides the login.
    """
    extra = {
        "numPartitions": str(connections), "batchsize": BATCH_ROWS, **(properties or {})
    }
    if mode == "overwrite":
        extra.setdefault("truncate", "true")
        if table in schemas.FOREIGN_KEY.values():
            extra.setdefault("cascadeTruncate", "true")
    df.write.jdbc(url=url, table=table, mode=mode, properties=extra)


def needs_wide_keys(warehouse: Warehouse) -> bool:
    """Does any table have more rows than the declared INT keys can number?"""
    return any(warehouse.size(name) > schemas.INT_MAX for name in schemas.TABLES)


def write_warehouse(
    warehouse: Warehouse,
    target: str,
    format: str = "parquet",
    mode: str = "append",
    wide_keys: bool | None = None,
    properties: Mapping[str, str] | None = None,
    release: bool = False,
    connections: int = CONNECTIONS,
) -> None:
    """Load all tables: Parquet folders at the same time, database tables in declared order,
    so that every parent precedes its children.

    ``wide_keys`` keeps surrogate keys as bigint instead of the declared INT. If not given,
    it follows from the tables' row counts, which are taken before anything is written.
    ``release`` deletes the staged tables afterwards, also when the load fails.
    """
    if format not in ("parquet", "jdbc"):
        raise ValueError(f"unknown format {format!r}")
    try:
        warehouse.prepare()
        if wide_keys is None:
            wide_keys = needs_wide_keys(warehouse)

        def write(name: str) -> None:
            df = schemas.conform(warehouse.table(name), name, wide_keys)
            if format == "parquet":
                write_parquet(df, target, name, mode)
            else:
                write_jdbc(df, target, name, mode, properties, connections)

        with ThreadPoolExecutor(len(schemas.TABLES) if format == "parquet" else 1) as pool:
            list(pool.map(write, schemas.TABLES))
    finally:
        if release:
            warehouse.release()
